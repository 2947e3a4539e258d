"""What of a series of jobs is done, what has changed since, and what must be done again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subloom.operators.ordered import numbered, previous
from subloom.session import joined


def staleness(stored: DataFrame, now: DataFrame, keys: list[str], digest: str) -> DataFrame:
    """(keys…, state) of digests (keys…, digest), one per key: ``fresh``, ``stale`` if they differ, ``gone`` if only the stored one is there, ``new`` if only the present one is.

    Null keys meet; a null digest equals no other.
    """
    rows = stored.select(*keys, F.col(digest).alias("_a"), F.lit(1).alias("_s")).unionByName(now.select(*keys, F.col(digest).alias("_a"), F.lit(0).alias("_s")))
    both = rows.groupBy(*keys).agg(*[F.max(F.when(F.col("_s") == s, F.col("_a"))).alias(f"_d{s}") for s in (0, 1)], *[F.count_if(F.col("_s") == s).alias(f"_n{s}") for s in (0, 1)])
    state = F.when(F.col("_n0") == 0, "gone").when(F.col("_n1") == 0, "new").when(F.coalesce(F.col("_d0") == F.col("_d1"), F.lit(False)), "fresh").otherwise("stale")
    return both.select(*keys, state.alias("state"))


def to_do(jobs: DataFrame, progress: DataFrame, keys: list[str], order: str, done: Column) -> DataFrame:
    """The jobs whose last progress row, that with the largest ``order``, isn't ``done``, or that have none."""
    columns = [c for c in progress.columns if c not in keys]
    last = progress.groupBy(*keys).agg(F.max(F.struct(order, *[c for c in columns if c != order])).alias("_l"))
    finished = last.select(*keys, *[F.col(f"_l.{c}") for c in columns]).where(F.coalesce(done, F.lit(False))).select(*keys, F.lit(True).alias("_done"))
    return joined(jobs, finished, keys, "left").where("_done is null").drop("_done")


def invalidated(rows: DataFrame, before: DataFrame, scope: list[str], keys: list[str], columns: list[str], cleared: list[str]) -> DataFrame:
    """The rows with the columns ``cleared`` emptied in every scope of which a row's ``columns`` have changed, or rows have come or gone, since ``before``; ``changed`` tells which.

    Both sides are (scope…, keys…, columns…), compared by sums of hashes of their rows, which are added up before anything is exchanged; null equals the empty string.
    """
    one = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in [*keys, *columns]])
    halves = [F.sum(F.shiftright(one, 32)).alias("_a"), F.sum(one.bitwiseAND(F.lit(0xFFFFFFFF))).alias("_b"), F.count("*").alias("_n")]
    now, then = rows.groupBy(*scope).agg(*halves), before.groupBy(*scope).agg(*[h.alias(n) for h, n in zip(halves, ("_c", "_d", "_m"))])
    same = joined(now, then, scope, "left").where((F.col("_a") == F.col("_c")) & (F.col("_b") == F.col("_d")) & (F.col("_n") == F.col("_m"))).select(*scope, F.lit(False).alias("_new"))
    out = joined(rows, same, scope, "left").withColumn("changed", F.coalesce("_new", F.lit(True))).drop("_new")
    return out.withColumns({c: F.when(~F.col("changed"), F.col(c)) for c in cleared})


def top_tracks(scores: DataFrame, cue: list[str], track: str, score: str) -> DataFrame:
    """(cue…, track, score, second, second_score, margin, state): the tracks of a cue with the highest mean score, ties by name.

    state: ``no_positive_track`` if no mean reaches 0, ``several_positive_tracks`` if more than one does, else ``single_positive_track``. A cue's tracks are few; their means are one value.
    """
    means = scores.where(F.col(track).isNotNull() & F.col(score).isNotNull()).groupBy(*cue, track).agg(F.avg(score).alias("_m"))
    each = means.groupBy(*cue).agg(F.array_sort(F.collect_list(F.struct((-F.col("_m")).alias("o"), F.col(track).alias("t")))).alias("_x"), F.count_if(F.col("_m") >= 0).alias("_p"))
    a, b = F.get("_x", F.lit(0)), F.get("_x", F.lit(1))
    state = F.when(F.col("_p") == 0, "no_positive_track").when(F.col("_p") > 1, "several_positive_tracks").otherwise("single_positive_track")
    return each.select(*cue, a["t"].alias(track), (-a["o"]).alias("score"), b["t"].alias("second"), (-b["o"]).alias("second_score"), (b["o"] - a["o"]).alias("margin"), state.alias("state"))


def unit_votes(rows: DataFrame, unit: list[str], pos: str, vote: str) -> DataFrame:
    """(unit…, rows, voted, share, first_vote): of each unit the rows, those with a vote, their share and the vote of the first row by ``pos``, which may be null."""
    full = F.coalesce(F.trim(F.col(vote)), F.lit("")) != ""
    out = rows.groupBy(*unit).agg(F.count("*").alias("rows"), F.count_if(full).alias("voted"), F.min(F.struct(F.col(pos), F.col(vote).alias("v"))).alias("_f"))
    return out.select(*unit, "rows", "voted", (F.col("voted") / F.col("rows")).alias("share"), F.col("_f.v").alias("first_vote"))


def classified(answers: DataFrame, role: str, confidence: str, catalog: DataFrame, least: float = 0.85) -> DataFrame:
    """The answers with ``known_role``, the catalogue's name (one column) of the same normal form, and ``state``: ``ok`` for one with ``least`` confidence or more, else ``review``."""
    from subloom.functions.texts import name_form

    known = catalog.select(F.col(catalog.columns[0]).alias("known_role")).where("known_role is not null").withColumn("_form", name_form(F.col("known_role"))).groupBy("_form").agg(F.min("known_role").alias("known_role"))
    out = answers.withColumn("_form", name_form(F.col(role))).join(known, "_form", "left").drop("_form")
    sure = F.col("known_role").isNotNull() & F.coalesce(F.col(confidence) >= least, F.lit(False)) & ~F.isnan(F.col(confidence))
    return out.withColumn("state", F.when(F.coalesce(sure, F.lit(False)), "ok").otherwise("review"))


def mapped_tracks(tracks: DataFrame, track: str, state: str, roles: DataFrame) -> DataFrame:
    """The rows of :func:`top_tracks` with ``mapped_role``, that of their track in ``roles`` (track, role), and ``track_role``: the same, but only where one track alone is positive.

    Of several roles of a track the smallest counts.
    """
    known = roles.groupBy(F.col(roles.columns[0]).alias("_t")).agg(F.min(roles.columns[1]).alias("mapped_role"))
    out = tracks.join(known, F.col(track) == F.col("_t"), "left").drop("_t")
    return out.withColumn("track_role", F.when(F.col(state) == "single_positive_track", F.col("mapped_role")))


def score_states(ranked: DataFrame, gates: DataFrame, role: str, seconds: str, least_seconds: float = 1.0, least_similarity: float = 0.0, least_margin: float = 0.08) -> DataFrame:
    """Ranked vectors (…, candidate, similarity, margin, seconds) with ``state``: ``too_short``, ``low_similarity``, ``ambiguous`` or ``eligible``, the first that holds.

    gates: (role, similarity_threshold, margin_threshold), which hold where they are above the least values; a role without gates has those. A vector without a second role is unambiguous.
    """
    asked = gates.select(F.col(role).alias("candidate"), "similarity_threshold", "margin_threshold")
    out = ranked.join(asked, "candidate", "left")
    gate = lambda c, least: F.greatest(F.coalesce(F.col(c), F.lit(least)), F.lit(least))
    state = (
        F.when(F.coalesce(F.col(seconds) < least_seconds, F.lit(True)), "too_short")
        .when(F.coalesce(F.col("similarity") < gate("similarity_threshold", least_similarity), F.lit(True)), "low_similarity")
        .when(F.col("margin") < gate("margin_threshold", least_margin), "ambiguous")
        .otherwise("eligible")
    )
    return out.withColumn("state", state).drop("similarity_threshold", "margin_threshold")


def counts_by_suffix(paths: DataFrame, path: str, kinds: dict[str, tuple[str, ...]], depth: int = 2) -> DataFrame:
    """(folder, kind, n): how many files of each kind, told by their suffix in any letter case, lie in each folder or up to ``depth`` folders below it; hidden ones don't count."""
    parts = F.filter(F.split(F.col(path), "/"), lambda x: x != "")
    rows = paths.where(F.col(path).isNotNull()).select(parts.alias("_p")).where(~F.exists("_p", lambda x: x.startswith(".")))
    name = F.lower(F.element_at("_p", F.lit(-1)))
    kind = None
    for k, suffixes in kinds.items():
        own = F.lit(False)
        for x in suffixes:
            own = own | name.endswith(x)
        kind = F.when(own, k) if kind is None else kind.when(own, k)
    folders = F.size("_p") - 1
    each = rows.withColumn("kind", kind).where("kind is not null").where(folders >= 1)
    above = each.select("kind", "_p", F.explode(F.sequence(F.greatest(F.lit(1), folders - depth), folders)).alias("_k"))
    return above.groupBy(F.array_join(F.slice("_p", 1, F.col("_k")), "/").alias("folder"), "kind").agg(F.count("*").alias("n"))


def files_of_episodes(files: DataFrame, name: str, episodes: DataFrame, episode: str) -> DataFrame:
    """(name, episode) of the files whose name holds the number of an episode, with or without zeros before it, at its begin or after a blank, a bracket, ``_``, ``-`` or ``ep``.

    All numbers of a name so placed are taken out and joined to the episodes as numbers; a number of a longer run of digits doesn't count. Each pair comes once.
    """
    numbers = F.regexp_extract_all(F.col(name), F.lit(r"(?:^|[\s_\[(-]|ep|EP)0?([0-9]{1,9})(?![0-9])"), F.lit(1))
    found = files.where(F.col(name).isNotNull()).select(name, F.explode(F.array_distinct(numbers)).alias("_x")).select(name, F.col("_x").try_cast("int").alias("_n"))
    known = episodes.select(episode, F.col(episode).cast("string").try_cast("int").alias("_n")).where("_n is not null").distinct()
    return found.join(known, "_n").select(name, episode).distinct()


def frame_gaps(rows: DataFrame, ids: list[str], frames: str, expected: int) -> DataFrame:
    """(ids…, frames, missing, duplicate): rows whose comma list names other than ``expected`` frames, or one twice; blank names don't count."""
    names = F.filter(F.transform(F.split(F.coalesce(F.col(frames), F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    out = rows.select(*ids, names.alias("_f"))
    out = out.select(*ids, F.size("_f").alias("frames"), F.greatest(F.lit(expected) - F.size(F.array_distinct("_f")), F.lit(0)).alias("missing"), (F.size("_f") > F.size(F.array_distinct("_f"))).alias("duplicate"))
    return out.where((F.col("frames") != expected) | F.col("duplicate"))


def leading(rows: DataFrame, scope: list[str], pos: str, columns: list[str], most: int) -> DataFrame:
    """(scope…, first, rows): the given columns of the first ``most`` rows of each scope by ``pos``, an integer that occurs once per scope, as a list, and how many rows there are.

    Rows are numbered over blocks of the order, so no scope is sorted whole.
    """
    shown = numbered(rows.select(*scope, F.col(pos).cast("bigint").alias("_o"), *[F.col(c).alias(f"_c_{c}") for c in columns]), scope, "_o", "_n")
    out = shown.groupBy(*scope).agg(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("_n") <= most, F.struct("_n", *[F.col(f"_c_{c}").alias(c) for c in columns])))), lambda x: F.struct(*[x[c].alias(c) for c in columns])).alias("first"),
        F.count("*").alias("rows"),
    )
    return out


def inspected(cues: DataFrame, keys: list[str], pos: str, text: str) -> DataFrame:
    """(keys…, entries, first_index, last_index, breaks, empty, state) of each file's cues: where numbers aren't consecutive, and how many cues have no text; ``review`` if any has none."""
    rows = previous(cues.select(*keys, pos, text), keys, pos, [], "_p")
    blank = F.coalesce(F.trim(F.col(text)), F.lit("")) == ""
    return rows.groupBy(*keys).agg(
        F.count("*").alias("entries"), F.min(pos).alias("first_index"), F.max(pos).alias("last_index"), F.count_if(F.col(pos) != F.col(f"_p.{pos}") + 1).alias("breaks"), F.count_if(blank).alias("empty")
    ).withColumn("state", F.when(F.col("empty") > 0, "review").otherwise("ok"))
