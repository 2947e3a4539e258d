"""Review rounds over labelled rows: what goes out to be reviewed, what comes back and whether it fits, samples, and the state of all checks together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subloom.functions import texts as T
from subloom.operators.dialogue import boundaries
from subloom.operators.keyed import all_reasons, by_place, drawn_by_hash, first_reason
from subloom.operators.ordered import previous
from subloom.session import joined


def same_text(a: Column, b: Column) -> Column:
    """Whether two values are equal, null being the empty string."""
    return F.coalesce(a.cast("string"), F.lit("")) == F.coalesce(b.cast("string"), F.lit(""))


def for_review(rows: DataFrame, status: str, settled: list[str], columns: list[str]) -> DataFrame:
    """The given columns of the rows whose ``status`` isn't among ``settled``; a row without a status isn't settled."""
    return rows.where(~F.coalesce(F.col(status).isin(*settled), F.lit(False))).select(*columns)


def reviewed(rows: DataFrame, reviews: DataFrame, keys: list[str], role: str, same: list[str], catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with the reviews' roles and ``changed``, (keys…, issue)) of reviews (keys…, role, same…) of labelled rows (keys…, role, same…).

    A review without a role says nothing. One whose key has several reviews (``duplicate``), is no row's (``unknown``), differs from the row in a column of ``same``
    (``source_differs``) or names a role that isn't in the catalogue (``role_unknown``; looked up by its normal form) changes nothing; each such review is
    one issue, the first that holds. The catalogue (one column) is looked up by a join.
    """
    given = reviews.where(T.strip(F.col(role)) != "").select(*keys, T.name_form(F.col(role)).alias("_form"), *[F.col(c).alias(f"_r_{c}") for c in same])
    once = given.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.min(c).alias(c) for c in given.columns if c not in keys])
    known = catalog.select(F.col(catalog.columns[0]).alias("_role")).where("_role is not null").withColumn("_form", T.name_form(F.col("_role"))).groupBy("_form").agg(F.min("_role").alias("_role"))
    looked_up = once.join(known, "_form", "left")
    own = rows.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in same]).withColumn("_own", F.lit(True))
    one = own.groupBy(*keys).agg(F.max("_own").alias("_own"), *[F.min(f"_o_{c}").alias(f"_o_{c}") for c in same])
    met = joined(looked_up, one, keys, "left")
    differs = reduce(lambda a, b: a | b, [~same_text(F.col(f"_r_{c}"), F.col(f"_o_{c}")) for c in same], F.lit(False))
    issue = first_reason((F.col("_n") > 1, "duplicate"), (F.col("_own").isNull(), "unknown"), (differs, "source_differs"), (F.col("_role").isNull(), "role_unknown"))
    judged = met.withColumn("issue", issue)
    good = judged.where("issue is null").select(*keys, F.col("_role").alias("_new"))
    out = joined(rows, good, keys, "left")
    changed = F.col("_new").isNotNull() & ~same_text(F.col("_new"), F.col(role))
    applied = out.withColumn("changed", changed).withColumn(role, F.coalesce("_new", role)).drop("_new")
    return applied, judged.where("issue is not null").select(*keys, "issue")


def blind_sample(rows: DataFrame, scope: list[str], ids: list[str], whole: Column, ratio: float, columns: list[str]) -> DataFrame:
    """The given columns, which should tell nothing of the labels, of the rows to be judged anew: all for which ``whole`` holds, of the others of each scope a share by hash."""
    light = rows.where(~F.coalesce(whole, F.lit(False)))
    return rows.where(F.coalesce(whole, F.lit(False))).select(*columns).unionByName(drawn_by_hash(light, scope, ids, ratio).select(*columns))


def sample_sufficiency(rows: DataFrame, scope: list[str], audited: Column, ratio: float) -> DataFrame:
    """(scope…, rows, required, audited, enough): whether the share ``ratio`` of each scope, one row at least, has been audited."""
    counts = rows.groupBy(*scope).agg(F.count("*").alias("rows"), F.count_if(F.coalesce(audited, F.lit(False))).alias("audited"))
    required = F.greatest(F.lit(1), F.ceil(F.col("rows") * F.lit(ratio))).cast("bigint")
    return counts.select(*scope, "rows", required.alias("required"), "audited", (F.col("audited") >= required).alias("enough"))


def source_integrity(source: DataFrame, given: DataFrame, keys: list[str], pos: str, columns: list[str]) -> DataFrame:
    """(keys…, place, issue): the rows in their order against the source's: ``missing``, ``added``, ``index_order`` or the name of a column that differs."""
    pairs = {"index_order": (pos, pos), **{c: (c, c) for c in columns}}
    found = by_place(source, given, keys, pos, pos, pairs)
    return found.select(*keys, "place", F.when(F.col("difference") == "only_left", "missing").when(F.col("difference") == "only_right", "added").otherwise(F.col("difference")).alias("issue"))


def continuity_issues(df: DataFrame, keys: list[str], pos: str, start: str, end: str, text: str, role: str, unit: str, risky: Column | None = None, explained: Column | None = None) -> DataFrame:
    """(keys…, pos, previous_pos, issue, decision): changes of role where the dialogue seems to go on.

    issue: ``role_switch_inside_semantic_unit`` where both rows name the same unit, ``role_switch_inside_likely_semantic_unit`` where the boundary says join,
    ``role_switch_at_ambiguous_semantic_boundary`` where it is to be reviewed with a join score of 2 or more, and
    ``role_switch_during_reaction_or_offscreen_continuation`` for a ``risky`` row. Rows that are ``explained``, or follow one that is, raise none.
    """
    rows = df.withColumn("_risky", F.coalesce(risky, F.lit(False)) if risky is not None else F.lit(False))
    rows = rows.withColumn("_told", F.coalesce(explained, F.lit(False)) if explained is not None else F.lit(False))
    rows = boundaries(rows, keys, pos, start, end, text)
    rows = previous(rows, keys, pos, [role, unit, "_told"], "_p")
    clean = lambda c: F.coalesce(T.strip(c), F.lit(""))
    own, before = clean(F.col(role)), clean(F.col(f"_p.{role}"))
    declared = (clean(F.col(unit)) != "") & (clean(F.col(unit)) == clean(F.col(f"_p.{unit}")))
    ambiguous = (F.col("decision") == "review") & (F.col("join_score") >= 2)
    issue = (
        F.when(declared, "role_switch_inside_semantic_unit")
        .when(F.col("decision") == "join", "role_switch_inside_likely_semantic_unit")
        .when(F.col("_risky") & ~ambiguous, "role_switch_during_reaction_or_offscreen_continuation")
        .when(ambiguous, "role_switch_at_ambiguous_semantic_boundary")
    )
    switched = F.col("_p").isNotNull() & (own != "") & (before != "") & (own != before) & ~F.col("_told") & ~F.coalesce(F.col("_p._told"), F.lit(False))
    return rows.where(switched).select(*keys, pos, F.col(f"_p.{pos}").alias(f"previous_{pos}"), issue.alias("issue"), "decision").where("issue is not null")


def vote_consistency(rows: DataFrame, ids: list[str], status: str, candidate: str, role: str, flag: str, eligible: list[str], advisory: list[str], other: list[str]) -> DataFrame:
    """(ids…, issue): statuses, candidates and conflict flags of a vote that contradict each other or the row's role, every issue that holds.

    A status out of the three lists is invalid and raises nothing else. An eligible vote needs a candidate, and its flag must say whether the candidate is another than the
    row's role; an advisory one needs a candidate and raises no flag; any other has no candidate.
    """
    s, c, r = (F.coalesce(T.strip(F.col(x)), F.lit("")) for x in (status, candidate, role))
    up = F.coalesce(T.truth(F.col(flag)), F.lit(False))
    sound = s.isin(*eligible, *advisory, *other)
    full, hint = s.isin(*eligible), s.isin(*advisory)
    apart = (r != "") & (T.name_form(c) != T.name_form(r))
    issues = all_reasons(
        (~sound, "invalid_status"),
        (full & (c == ""), "missing_candidate"),
        (full & (c != "") & apart & ~up, "conflict_flag_missing"),
        (full & (c != "") & ~apart & up, "stale_conflict_flag"),
        (hint & (c == ""), "advisory_missing_candidate"),
        (hint & up, "weak_vote_must_not_flag"),
        (sound & ~full & ~hint & (c != ""), "ineligible_has_candidate"),
    )
    return rows.select(*ids, F.explode(issues).alias("issue"))


def rollup(checks: dict[str, DataFrame], keys: list[str], every: DataFrame) -> DataFrame:
    """(keys…, issues, failed, passed): per key of ``every`` the number of issue rows of all checks, the names of those with any, and whether there are none."""
    counted = [df.groupBy(*keys).agg(F.count("*").alias("_k")).withColumn("_check", F.lit(name)) for name, df in checks.items()]
    found = reduce(lambda a, b: a.unionByName(b), counted).groupBy(*keys).agg(F.sum("_k").alias("_n"), F.array_sort(F.collect_set("_check")).alias("_failed"))
    out = joined(every.select(*keys).distinct(), found, keys, "left")
    return out.select(*keys, F.coalesce("_n", F.lit(0)).alias("issues"), F.coalesce("_failed", F.array().cast("array<string>")).alias("failed"), F.col("_n").isNull().alias("passed"))
