"""Vectors of voices: centroids, leave-one-out margins, thresholds, rankings and clusters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subloom.operators.ordered import carried, numbered
from subloom.session import joined

#: Roles whose centroids are held by every worker at once; more are taken in blocks.
HELD_ROLES = 10_000


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def unit(v: Column) -> Column:
    """The vector at length 1; null for a null, empty, zero or non-finite one."""
    n = F.sqrt(dot(v, v))
    # the length is repeated as an array: within a lambda it would be computed anew for each element
    scaled = F.zip_with(v, F.array_repeat(n, F.size(v)), lambda x, m: x.cast("double") / m)
    return F.when((n > 0) & ~F.isnan(n) & (n < float("inf")), scaled)


def vector_sums(df: DataFrame, keys: list[str], vector: str, weight: Column | None = None) -> DataFrame:
    """(keys…, total, n, w): the sums of the vectors of each key, dimension by dimension, with map-side combining."""
    w = F.lit(1.0) if weight is None else weight.cast("double")
    dims = df.select(*keys, w.alias("_w"), F.posexplode(vector).alias("_i", "_x"))
    sums = dims.groupBy(*keys, "_i").agg(F.sum(F.col("_x") * F.col("_w")).alias("_x"), F.count("*").alias("n"), F.sum("_w").alias("w"))
    # one entry per dimension
    gathered = sums.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_i", "_x"))).alias("_v"), F.max("n").alias("n"), F.max("w").alias("w"))
    return gathered.select(*keys, F.transform("_v", lambda x: x["_x"]).alias("total"), "n", "w")


def centroids(df: DataFrame, role: str, vector: str) -> DataFrame:
    """(role, centroid, n): the unit vector of the mean of a role's unit vectors."""
    units = df.select(role, unit(F.col(vector)).alias("_u")).where("_u is not null")
    return vector_sums(units, [role], "_u").select(role, unit(F.col("total")).alias("centroid"), "n")


def similarities(df: DataFrame, ids: list[str], vector: str, centres: DataFrame, role: str) -> DataFrame:
    """(ids…, candidate, similarity, second, second_similarity, margin): the two roles nearest to each vector, ties by role.

    The centroids are taken in blocks of HELD_ROLES, so what a worker holds is bounded; of each block the two best per row remain.
    """
    total = centres.count()
    blocks = max(1, -(-total // HELD_ROLES))
    parts = None
    name = dict(df.dtypes)
    kind = dict(centres.dtypes)[role]
    schema = ", ".join(f"{c} {name[c]}" for c in ids) + f", r1 {kind}, s1 double, r2 {kind}, s2 double"
    for b in range(blocks):
        own = centres.where(F.pmod(F.xxhash64(role), F.lit(blocks)) == b).select(role, "centroid").toPandas().sort_values(role, kind="stable")
        held = df.sparkSession.sparkContext.broadcast((own[role].tolist(), np.array(own["centroid"].tolist(), float).reshape(len(own), -1)))

        def run(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            roles, matrix = held.value
            for batch in batches:
                out = batch[ids].copy()
                v = np.array([np.asarray(x, float) for x in batch["_u"]]).reshape(len(batch), -1)
                sims = np.round(v @ matrix.T, 9) if len(roles) and len(batch) else np.zeros((len(batch), 0))
                order = np.argsort(-sims, 1, kind="stable")[:, :2]
                pick = lambda k: (
                    [roles[i] for i in order[:, k]] if sims.shape[1] > k else [None] * len(batch),
                    np.take_along_axis(sims, order[:, k : k + 1], 1)[:, 0] if sims.shape[1] > k else [None] * len(batch),
                )
                out["r1"], out["s1"] = pick(0)
                out["r2"], out["s2"] = pick(1)
                yield out

        made = df.select(*ids, unit(F.col(vector)).alias("_u")).where("_u is not null").mapInPandas(run, schema)
        parts = made if parts is None else parts.unionByName(made)
    if blocks > 1:
        each = parts.select(*ids, F.explode(F.array(F.struct((-F.col("s1")).alias("o"), F.col("r1").alias("r")), F.struct((-F.col("s2")).alias("o"), F.col("r2").alias("r")))).alias("x")).where("x.o is not null")
        best = each.groupBy(*ids).agg(F.min("x").alias("a"), F.slice(F.array_sort(F.collect_list("x")), 2, 1).alias("b"))  # two entries per block
        parts = best.select(*ids, F.col("a.r").alias("r1"), (-F.col("a.o")).alias("s1"), F.get("b", F.lit(0))["r"].alias("r2"), (-F.get("b", F.lit(0))["o"]).alias("s2"))
    return parts.select(*ids, F.col("r1").alias("candidate"), F.col("s1").alias("similarity"), F.col("r2").alias("second"), F.col("s2").alias("second_similarity"), (F.col("s1") - F.col("s2")).alias("margin"))


def left_out(df: DataFrame, ids: list[str], role: str, vector: str) -> DataFrame:
    """(ids…, role, own, impostor, margin): each vector's similarity to the centroid of its role without itself, and to the best other role.

    The centroid without a vector is the unit vector of the role's sum less that vector; a role of one vector has none, own is null.
    """
    units = df.select(*ids, role, unit(F.col(vector)).alias("_u")).where(F.col("_u").isNotNull() & F.col(role).isNotNull())
    sums = vector_sums(units, [role], "_u")
    without = units.join(sums, role).withColumn("_rest", unit(F.zip_with("total", "_u", lambda a, b: a - b)))
    own = without.select(*ids, role, F.when(F.col("n") > 1, F.round(dot(F.col("_rest"), F.col("_u")), 9)).alias("own"))
    top = similarities(units.withColumn("_v", F.col("_u")), [*ids, role], "_v", sums.select(role, unit(F.col("total")).alias("centroid")), role)
    other = top.select(*ids, role, F.when(F.col("candidate") != F.col(role), F.col("similarity")).otherwise(F.col("second_similarity")).alias("impostor"))
    return own.join(other, [*ids, role]).withColumn("margin", F.col("own") - F.col("impostor"))


def exact_percentiles(df: DataFrame, keys: list[str], wanted: dict[str, tuple[str, float]], digits: int = 9) -> DataFrame:
    """(keys…, name…, n_name…): for each name the percentile (column, share) of the non-null values of a key, linear between neighbours; null without values.

    Values are taken to ``digits`` decimal places, within 10**(18 - digits). Equal ones are counted first, the counts are carried along the line of values, and only the two values on
    either side of the place sought are kept: no key's values come together.
    """
    columns = list(dict.fromkeys(c for c, _ in wanted.values()))
    parts = []
    for c in columns:
        place = F.round(F.col(c) * 10**digits).cast("bigint")
        counts = df.where(F.col(c).isNotNull()).groupBy(*keys, place.alias("_x")).agg(F.count("*").alias("_k"))
        bits = max(20, digits * 3)  # a value of 1 spans a handful of blocks
        line = carried(counts, keys, "_x", F.col("_k"), "_before", "sum", bits).withColumn("_before", F.coalesce("_before", F.lit(0)))
        totals = counts.groupBy(*keys).agg(F.sum("_k").alias("_n"))
        line = joined(line, totals, keys)
        for name, (own, share) in wanted.items():
            if own != c:
                continue
            at = (F.col("_n") - 1) * F.lit(share)
            lo, hi = F.floor(at), F.ceil(at)
            holds = lambda k: (F.col("_before") <= k) & (k < F.col("_before") + F.col("_k"))
            low, high = F.max(F.when(holds(lo), F.col("_x"))), F.max(F.when(holds(hi), F.col("_x")))
            value = (low + (high - low) * (F.max(at) - F.max(lo))) / F.lit(float(10**digits))
            parts.append(line.groupBy(*keys).agg(value.alias("_v")).select(*keys, F.lit(name).alias("_name"), "_v"))
    every = parts[0]
    for x in parts[1:]:
        every = every.unionByName(x)
    return every.groupBy(*keys).agg(*[F.max(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in wanted])


def thresholds(margins: DataFrame, role: str, fallback: tuple[float, float] = (0.0, 0.08)) -> DataFrame:
    """(role, clips, similarity_threshold, margin_threshold, confusable) from :func:`left_out`.

    The similarity asked for is the 95th percentile of impostors plus 0.03, or the 10th of genuine ones if that is higher; the margin
    the 10th percentile of margins within 0.08 and 0.25; ``fallback`` where a role has no values for one of them. A role is confusable if its genuine 10th
    percentile doesn't reach that of impostors plus 0.03.
    """
    rows = margins.where("own is not null")
    found = exact_percentiles(rows, [role], {"g": ("own", 0.1), "i": ("impostor", 0.95), "m": ("margin", 0.1)})
    found = joined(rows.groupBy(role).agg(F.count("*").alias("clips")), found, [role])
    floor = F.col("i") + 0.03
    least = F.coalesce(F.greatest("g", floor), F.lit(fallback[0]))
    margin = F.least(F.greatest(F.coalesce("m", F.lit(fallback[1])), F.lit(0.08)), F.lit(0.25))
    return found.select(role, "clips", least.alias("similarity_threshold"), margin.alias("margin_threshold"), F.coalesce(F.col("g") < floor, F.lit(False)).alias("confusable"))


def kept_clips(margins: DataFrame, role: str, least_own: float = 0.3, least_margin: float = 0.08) -> DataFrame:
    """The rows of :func:`left_out` and ``kept``: a clip of a role of several drops out if it is too unlike the role's others or too little more like them than like another role.

    A clip that stands alone for its role, or that no other role is there to be compared with, stays.
    """
    weak = (F.col("own") < least_own) | F.coalesce(F.col("margin") < least_margin, F.lit(False))
    return margins.withColumn("kept", F.col("own").isNull() | ~weak)


def weighted_clusters(df: DataFrame, cluster: list[str], vector: str, weight: str, least: float) -> DataFrame:
    """(cluster…, centroid, n, weight): unit vectors summed by weight, of clusters with ``least`` weight or more."""
    units = df.select(*cluster, F.col(weight).alias("_w"), unit(F.col(vector)).alias("_u")).where(F.col("_u").isNotNull() & (F.col(weight) > 0))
    sums = vector_sums(units, cluster, "_u", F.col("_w"))
    return sums.where(F.col("w") >= least).select(*cluster, unit(F.col("total")).alias("centroid"), "n", F.col("w").alias("weight"))


def average_linkage(vectors: np.ndarray, threshold: float) -> np.ndarray:
    """Cluster numbers of unit vectors by average linkage of cosine similarity: pairs of clusters are joined while their mean similarity reaches ``threshold``.

    Nearest-neighbour chains: of unit vectors the mean similarity of two clusters is the product of their sums over that of their sizes, so sums
    are kept and no matrix of pairs. A cluster whose nearest one is below the threshold is finished, as joining others brings none nearer.
    Up to two vectors are one cluster. At equal similarities the chain's own predecessor is taken, else the first.
    """
    n = len(vectors)
    if n <= 2:
        return np.zeros(n, int)
    sums, size, first = np.array(vectors, float), np.ones(n), np.arange(n)
    mean = sums.copy()
    alive = np.ones(n, bool)
    merged = np.arange(n)
    chain: list[int] = []
    start, left = 0, n
    while left:
        if not chain:
            if 2 * left < len(alive):
                sums, mean, size, first, alive, start = sums[alive], mean[alive], size[alive], first[alive], alive[alive], 0
            start += int(np.argmax(alive[start:]))
            chain.append(start)
        i = chain[-1]
        sims = mean @ mean[i]
        sims[~alive] = -np.inf
        sims[i] = -np.inf
        j = int(np.argmax(sims))
        if len(chain) > 1 and sims[chain[-2]] >= sims[j] - 1e-12:
            j = chain[-2]
            del chain[-2:]
            i, j = min(i, j), max(i, j)
            sums[i] += sums[j]
            size[i] += size[j]
            mean[i] = sums[i] / size[i]
            alive[j] = False
            left -= 1
            merged[first[j]] = first[i]
        elif len(chain) == 1 and (left == 1 or sims[j] < threshold):
            alive[i] = False
            left -= 1
            chain.clear()
        else:
            chain.append(j)
    while (up := merged[merged]).tolist() != merged.tolist():
        merged = up
    return np.unique(merged, return_inverse=True)[1]


def clustered(df: DataFrame, scope: str, ident: str, vector: str, threshold: float = 0.7) -> DataFrame:
    """(scope, ident, cluster) by :func:`average_linkage` within each scope.

    A scope is clustered whole by one task, which holds its vectors; the time grows as the square of their number.
    """
    kinds = dict(df.dtypes)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ident, kind="stable")
        v = np.array([np.asarray(x, float) for x in pdf["_u"]])
        return pd.DataFrame({scope: pdf[scope].to_numpy(), ident: pdf[ident].to_numpy(), "cluster": average_linkage(v, threshold)})

    rows = df.select(scope, ident, unit(F.col(vector)).alias("_u")).where("_u is not null")
    return rows.groupBy(scope).applyInPandas(one, f"{scope} {kinds[scope]}, {ident} {kinds[ident]}, cluster long")


def nearest_exemplars(df: DataFrame, ids: list[str], vector: str, gallery: DataFrame, role: str, exemplar: str) -> DataFrame:
    """(ids…, candidate, similarity, second, second_similarity, margin): as :func:`similarities`, a role's similarity being that of its nearest exemplar.

    Exemplars are taken in blocks of HELD_ROLES; of each block the two best roles per row remain, and the best of a role over the blocks counts.
    """
    known = gallery.select(F.col(role).alias("r"), unit(F.col(exemplar)).alias("x")).where("x is not null and r is not null")
    blocks = max(1, -(-known.count() // HELD_ROLES))
    rows = df.select(*ids, unit(F.col(vector)).alias("_u")).where("_u is not null")
    types, kind = dict(df.dtypes), dict(known.dtypes)["r"]
    parts = None
    for b in range(blocks):
        own = known.where(F.pmod(F.xxhash64("r", "x"), F.lit(blocks)) == b).toPandas().sort_values("r", kind="stable")
        roles, starts = np.unique(own["r"].to_numpy(), return_index=True)
        held = df.sparkSession.sparkContext.broadcast((roles.tolist(), starts, np.array(own["x"].tolist(), float).reshape(len(own), -1)))

        def run(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            roles, starts, matrix = held.value
            for batch in batches:
                for at in range(0, len(batch) if roles else 0, 500):
                    part = batch[at : at + 500]
                    sims = np.maximum.reduceat(np.round(np.array([np.asarray(x, float) for x in part["_u"]]) @ matrix.T, 9), starts, axis=1)
                    for k in range(min(2, len(roles))):
                        best = np.argsort(-sims, 1, kind="stable")[:, k]
                        yield part[ids].assign(r=[roles[i] for i in best], s=np.take_along_axis(sims, best[:, None], 1)[:, 0])

        made = rows.mapInPandas(run, ", ".join(f"{c} {types[c]}" for c in ids) + f", r {kind}, s double")
        parts = made if parts is None else parts.unionByName(made)
    each = parts.groupBy(*ids, "r").agg(F.max("s").alias("s"))
    ranked = each.groupBy(*ids).agg(F.array_sort(F.collect_list(F.struct((-F.col("s")).alias("o"), "r"))).alias("x"))  # two entries per block
    a, z = F.get("x", F.lit(0)), F.get("x", F.lit(1))
    return ranked.select(*ids, a["r"].alias("candidate"), (-a["o"]).alias("similarity"), z["r"].alias("second"), (-z["o"]).alias("second_similarity"), (z["o"] - a["o"]).alias("margin"))


def cluster_rows(df: DataFrame, ids: list[str], cluster: list[str], vector: str, weight: str, centres: DataFrame, role: str, gates: DataFrame, least: float = 3.0, weak: float = 0.4) -> DataFrame:
    """(ids…, cluster…, candidate, row_candidate, row_similarity, row_margin, cluster_similarity, outlier, agreement): rows of clusters with ``least`` weight or more.

    candidate: the role nearest to the cluster's weighted sum; agreement: the share of the cluster's rows that are nearest to it too. A row is an outlier if
    it reaches the similarity and the margin that ``gates`` asks for another role, or if its similarity to the rest of the cluster is below ``weak``.
    gates: (role, similarity_threshold, margin_threshold); a role without them isn't strongly preferred.
    """
    rows = df.select(*ids, *cluster, F.col(weight).cast("double").alias("_w"), unit(F.col(vector)).alias("_u")).where(F.col("_u").isNotNull() & (F.col(weight) > 0))
    for c in cluster:
        rows = rows.where(F.col(c).isNotNull())
    sums = vector_sums(rows, cluster, "_u", F.col("_w")).where(F.col("w") >= least)
    whole = similarities(sums, cluster, "total", centres, role).select(*cluster, "candidate")
    single = similarities(rows, [*ids, *cluster], "_u", centres, role)
    single = single.select(*ids, *cluster, F.col("candidate").alias("row_candidate"), F.col("similarity").alias("row_similarity"), F.col("margin").alias("row_margin"))
    rest = unit(F.zip_with("total", F.zip_with("_u", F.array_repeat("_w", F.size("_u")), lambda x, w: x * w), lambda a, b: a - b))
    near = rows.join(sums, cluster).select(*ids, *cluster, F.when(F.col("n") > 1, F.round(dot(rest, F.col("_u")), 9)).alias("cluster_similarity"))
    asked = gates.select(F.col(role).alias("row_candidate"), "similarity_threshold", "margin_threshold")
    each = near.join(single, [*ids, *cluster]).join(whole, cluster).join(asked, "row_candidate", "left")
    strong = (F.col("row_candidate") != F.col("candidate")) & (F.col("row_similarity") >= F.col("similarity_threshold")) & (F.col("row_margin") >= F.col("margin_threshold"))
    outlier = F.coalesce(strong, F.lit(False)) | F.coalesce(F.col("cluster_similarity") < weak, F.lit(False))
    shares = each.groupBy(*cluster).agg(F.avg((F.col("row_candidate") == F.col("candidate")).cast("double")).alias("agreement"))
    return each.withColumn("outlier", outlier).join(shares, cluster).select(*ids, *cluster, "candidate", "row_candidate", "row_similarity", "row_margin", "cluster_similarity", "outlier", "agreement")


def settled_clusters(df: DataFrame, scope: str, ident: str, vector: str, clean: str, threshold: float = 0.7, least: float = 0.45) -> DataFrame:
    """(scope, ident, cluster, cluster_similarity, outlier, nearest, nearest_similarity): the clean vectors of a scope in clusters, every vector with its nearest one.

    cluster_similarity: that to the rest of the cluster, from three vectors on, else to its centroid; an outlier lies below ``least`` in a cluster of
    three or more. Two clean vectors are one cluster only if their similarity reaches ``threshold``. Vectors that aren't clean belong to no cluster.
    As in :func:`clustered` one task holds a scope.
    """
    kinds = dict(df.dtypes)
    length = lambda v: v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-12)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ident, kind="stable")
        v = np.array([np.asarray(x, float) for x in pdf["_u"]])
        at = np.flatnonzero(pdf["_ok"].to_numpy(bool))
        made = {c: np.full(len(v), None, object) for c in ("cluster", "cluster_similarity", "outlier", "nearest", "nearest_similarity")}
        if len(at):
            own = v[at]
            label = np.array([0, int(own[0] @ own[1] < threshold)]) if len(at) == 2 else average_linkage(own, threshold)
            size = np.bincount(label)
            sums = np.zeros((len(size), v.shape[1]))
            np.add.at(sums, label, own)
            rest = length(np.where(size[label][:, None] >= 3, sums[label] - own, sums[label]))
            near = np.round((rest * own).sum(1), 9)
            made["cluster"][at], made["cluster_similarity"][at], made["outlier"][at] = label.tolist(), near.tolist(), ((size[label] >= 3) & (near < least)).tolist()
            centres = length(sums)
            for k in range(0, len(v), 500):
                sims = np.round(v[k : k + 500] @ centres.T, 9)
                # of equally near clusters the larger number
                made["nearest"][k : k + 500], made["nearest_similarity"][k : k + 500] = (sims.shape[1] - 1 - sims[:, ::-1].argmax(1)).tolist(), sims.max(1).tolist()
        return pdf[[scope, ident]].assign(**made)

    rows = df.select(scope, ident, F.coalesce(F.col(clean), F.lit(False)).alias("_ok"), unit(F.col(vector)).alias("_u")).where("_u is not null")
    schema = f"{scope} {kinds[scope]}, {ident} {kinds[ident]}, cluster long, cluster_similarity double, outlier boolean, nearest long, nearest_similarity double"
    return rows.groupBy(scope).applyInPandas(one, schema)


def enrolled(clips: DataFrame, interval: list[str], order: str, refused: Column) -> DataFrame:
    """The clips and ``reject_reason``: that of ``refused`` (null for a sound clip), ``duplicate_interval`` for all but the first sound clip of an interval, else null.

    The first by ``order``; a clip that is refused takes no interval. Equal values of ``order`` in one interval count as one place.
    """
    first = clips.where(refused.isNull()).groupBy(*interval).agg(F.min(order).alias("_first"))
    rows = clips.withColumn("_why", refused)
    rows = joined(rows, first, interval, "left")
    return rows.withColumn("reject_reason", F.coalesce("_why", F.when(F.col(order) > F.col("_first"), "duplicate_interval"))).drop("_why", "_first")


def readiness(kept: DataFrame, role: str, episode: str, seconds: str, least_seconds: float = 8.0, least_clips: int = 3, least_episodes: int = 1) -> DataFrame:
    """(role, clips, seconds, episodes, issues, usable): whether enough is left of each role after :func:`kept_clips`, with (role, episode, seconds, kept).

    issues: ``insufficient_total_duration``, ``insufficient_clips``, ``insufficient_distinct_episodes``; a role of which nothing is left has all of them.
    """
    good = F.col("kept")
    out = kept.groupBy(role).agg(
        F.count_if(good).alias("clips"), F.coalesce(F.sum(F.when(good, F.col(seconds))), F.lit(0.0)).alias("seconds"), F.count_distinct(F.when(good & (F.col(episode) != ""), F.col(episode))).alias("episodes")
    )
    issues = F.array_compact(
        F.array(
            F.when(F.col("seconds") < least_seconds, "insufficient_total_duration"),
            F.when(F.col("clips") < least_clips, "insufficient_clips"),
            F.when(F.col("episodes") < least_episodes, "insufficient_distinct_episodes"),
        )
    )
    return out.withColumn("issues", issues).withColumn("usable", F.size("issues") == 0)


def half_similarity(windows: DataFrame, keys: list[str], pos: str, vector: str, least: int = 3) -> DataFrame:
    """(keys…, windows, similarity): how alike the two halves of a cue are, by the mean vectors of its first and its last windows; null under ``least`` windows.

    The first half has half of the windows, rounded down. Vectors are taken at length 1; null and zero ones don't count.
    """
    rows = windows.select(*keys, pos, unit(F.col(vector)).alias("_u")).where("_u is not null")
    rows = numbered(rows, keys, pos, "_n")
    totals = rows.groupBy(*keys).agg(F.count("*").alias("_k"))
    half = joined(rows, totals, keys).withColumn("_second", F.col("_n") > F.floor(F.col("_k") / 2))
    sums = vector_sums(half, [*keys, "_second"], "_u")
    both = sums.groupBy(*keys).agg(F.max(F.when(~F.col("_second"), F.struct("total"))).alias("_a"), F.max(F.when(F.col("_second"), F.struct("total"))).alias("_b"), F.sum("n").alias("windows"))
    alike = F.when(F.col("windows") >= least, F.round(dot(unit(F.col("_a.total")), unit(F.col("_b.total"))), 9))
    return both.select(*keys, "windows", alike.alias("similarity"))


def speakers_of(similarity: np.ndarray, most: int) -> np.ndarray:
    """Cluster numbers from the similarities of vectors by the eigenvectors of a graph of nearest neighbours.

    Each vector is linked to its ten nearest ones (a hundredth of all from a thousand on), links of one side counting half; the number of clusters follows
    from the largest gap between neighbouring eigenvalues of the Laplacian, ``most`` at the most. Groups are then found by k-means from the
    rows of the smallest eigenvectors, started at rows that lie as far apart as can be.
    """
    n = len(similarity)
    if n <= 2:
        return np.zeros(n, int)
    near = min(10, n - 2) if n < 1000 else n - int(0.99 * n)
    links = np.zeros((n, n))
    np.put_along_axis(links, np.argsort(similarity, 1, kind="stable")[:, -near:], 1.0, 1)
    links = (links + links.T) / 2
    np.fill_diagonal(links, 0)
    values, vectors = np.linalg.eigh(np.diag(links.sum(1)) - links)
    upper = max(1, min(most, n - 1))
    gaps = np.diff(values[: upper + 1])
    k = int(np.argmax(gaps)) + 1 if len(gaps) else 1
    if k == 1:
        return np.zeros(n, int)
    points = vectors[:, :k]
    chosen = [int(np.argmax((points**2).sum(1)))]
    far = ((points - points[chosen[0]]) ** 2).sum(1)
    while len(chosen) < k:
        chosen.append(int(np.argmax(far)))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(1))
    centres, label = points[chosen], np.full(n, -1)
    for _ in range(100):
        new = ((points[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        if (new == label).all():
            break
        label = new
        centres = np.array([points[label == c].mean(0) if (label == c).any() else centres[c] for c in range(k)])
    return np.unique(label, return_inverse=True)[1]


#: Vectors of a scope up to which :func:`spectral` takes it: a task holds their square.
SPECTRAL_SCOPE = 5000


def spectral(df: DataFrame, scope: str, ident: str, vector: str, most: int = 20) -> DataFrame:
    """(scope, ident, cluster) by :func:`speakers_of` within each scope; null for all of a scope of more than SPECTRAL_SCOPE vectors, which :func:`clustered` can take."""
    kinds = dict(df.dtypes)
    rows = df.select(scope, ident, unit(F.col(vector)).alias("_u")).where("_u is not null")
    sizes = rows.groupBy(scope).agg((F.count("*") <= SPECTRAL_SCOPE).alias("_fits"))
    rows = joined(rows, sizes, [scope])

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ident, kind="stable")
        v = np.array([np.asarray(x, float) for x in pdf["_u"]])
        return pdf[[scope, ident]].assign(cluster=speakers_of(np.round(v @ v.T, 9), most))

    made = rows.where("_fits").groupBy(scope).applyInPandas(one, f"{scope} {kinds[scope]}, {ident} {kinds[ident]}, cluster long")
    return made.unionByName(rows.where("not _fits").select(scope, ident, F.lit(None).cast("bigint").alias("cluster")))
