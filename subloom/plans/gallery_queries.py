"""Queries on galleries of vectors, with the embeddings as clips: their label as role, with an episode and a length that follow from their ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subloom.operators import spans
from subloom.operators import states as S
from subloom.operators import voices as V
from subloom.plans.cue_queries import CUES, TURNS, timed, turns
from subloom.plans.keyed_queries import _LEFT_OUT, _UNITS
from subloom.plans.registry import query
from subloom.session import table


def _clips(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", "label", "embedding", (F.col("vec_id") % 5).cast("string").alias("episode"), (1 + F.col("vec_id") % 3).cast("double").alias("seconds"))


_KEPT = _LEFT_OUT + """, kc AS (SELECT vec_id, label, own, impostor, own IS NULL OR NOT (own < 0.3 OR coalesce(own - impostor < 0.08, false)) AS kept FROM l)
"""


def _kept(spark: SparkSession, d: str) -> DataFrame:
    return V.kept_clips(V.left_out(_clips(spark, d), ["vec_id"], "label", "embedding"), "label")


@query(_KEPT + "SELECT vec_id, label, kept FROM kc")
def q_kept_clips(spark: SparkSession, d: str) -> DataFrame:
    return _kept(spark, d).select("vec_id", "label", "kept")


@query(_KEPT + """, g AS (SELECT label, count(*) FILTER (kept) AS clips, coalesce(sum(CASE WHEN kept THEN CAST(1 + vec_id % 3 AS DOUBLE) END), 0.0) AS seconds, count(DISTINCT CASE WHEN kept THEN vec_id % 5 END) AS episodes FROM kc GROUP BY 1),
i AS (SELECT *, list_filter([CASE WHEN seconds < 8 THEN 'insufficient_total_duration' END, CASE WHEN clips < 3 THEN 'insufficient_clips' END, CASE WHEN episodes < 1 THEN 'insufficient_distinct_episodes' END], lambda x: x IS NOT NULL) AS issues FROM g)
SELECT *, len(issues) = 0 AS usable FROM i""")
def q_readiness(spark: SparkSession, d: str) -> DataFrame:
    kept = _kept(spark, d).join(_clips(spark, d).select("vec_id", "episode", "seconds"), "vec_id")
    return V.readiness(kept, "label", "episode", "seconds")


@query("""
WITH c AS (SELECT turn_id, episode, start_timecode AS a, end_timecode AS z, CASE WHEN speaker IS NULL OR trim(speaker) = '' THEN 'missing_role' WHEN start_seconds IS NULL OR end_seconds IS NULL OR end_seconds <= start_seconds THEN 'no_interval'
  WHEN end_seconds - start_seconds < 1.0 OR end_seconds - start_seconds > 30.0 THEN 'duration_out_of_range' END AS why FROM speaker_turns),
f AS (SELECT episode, a, z, min(turn_id) AS k FROM c WHERE why IS NULL GROUP BY 1, 2, 3)
SELECT turn_id, coalesce(why, CASE WHEN turn_id > k THEN 'duplicate_interval' END) AS reject_reason FROM c LEFT JOIN f ON c.episode IS NOT DISTINCT FROM f.episode AND c.a IS NOT DISTINCT FROM f.a AND c.z IS NOT DISTINCT FROM f.z
""")
def q_enrolled(spark: SparkSession, d: str) -> DataFrame:
    length = F.col("end_seconds") - F.col("start_seconds")
    why = (
        F.when(F.coalesce(F.trim("speaker"), F.lit("")) == "", "missing_role")
        .when(F.coalesce(length <= 0, F.lit(True)), "no_interval")
        .when((length < 1.0) | (length > 30.0), "duration_out_of_range")
    )
    return V.enrolled(table(spark, d, "speaker_turns"), ["episode", "start_timecode", "end_timecode"], "turn_id", why).select("turn_id", "reject_reason")


_WINDOWS = "WITH e AS (SELECT vec_id // 8 AS cue, vec_id % 8 AS pos, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings WHERE embedding IS NOT NULL)"


@query(_WINDOWS + """, u AS (SELECT cue, pos, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM e WHERE list_dot_product(v, v) > 0),
n AS (SELECT *, row_number() OVER (PARTITION BY cue ORDER BY pos) AS n, count(*) OVER (PARTITION BY cue) AS k FROM u), x AS (SELECT cue, k, n > k // 2 AS h, unnest(u) AS x, generate_subscripts(u, 1) AS i FROM n),
s AS (SELECT cue, k, h, i, sum(x) AS x FROM x GROUP BY 1, 2, 3, 4), t AS (SELECT cue, k, h, list(x ORDER BY i) AS t FROM s GROUP BY 1, 2, 3)
SELECT a.cue, CAST(a.k AS BIGINT) AS windows, CASE WHEN a.k >= 3 THEN round(list_dot_product(a.t, b.t) / sqrt(list_dot_product(a.t, a.t)) / sqrt(list_dot_product(b.t, b.t)), 6) END AS similarity FROM t a JOIN t b ON a.cue = b.cue AND NOT a.h AND b.h
UNION ALL SELECT cue, CAST(k AS BIGINT), NULL FROM t WHERE k = 1""")
def q_half_similarity(spark: SparkSession, d: str) -> DataFrame:
    windows = table(spark, d, "embeddings").select(F.expr("vec_id div 8").alias("cue"), (F.col("vec_id") % 8).alias("pos"), "embedding")
    rows = V.half_similarity(windows, ["cue"], "pos", "embedding")
    return rows.select("cue", "windows", F.round("similarity", 6).alias("similarity"))


_EXEMPLARS = _UNITS + """, x AS (SELECT u.vec_id, o.label, max(round(list_dot_product(u.u, o.u), 9)) AS s FROM u, u o WHERE o.vec_id % 20 = 0 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, label) AS k FROM x)
SELECT a.vec_id, a.label AS candidate, round(a.s, 6) AS similarity, z.label AS "second", round(z.s, 6) AS second_similarity FROM r a LEFT JOIN r z ON a.vec_id = z.vec_id AND z.k = 2 WHERE a.k = 1
"""


@query(_EXEMPLARS)
def q_nearest_exemplars(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    gallery = e.where("vec_id % 20 = 0").select("label", "embedding")  # the gallery has a clip in twenty; all vectors are ranked
    rows = V.nearest_exemplars(e, ["vec_id"], "embedding", gallery, "label", "embedding")
    return rows.select("vec_id", "candidate", F.round("similarity", 6).alias("similarity"), "second", F.round("second_similarity", 6).alias("second_similarity"))


@query()
def q_cluster_rows(spark: SparkSession, d: str) -> DataFrame:
    clips = _clips(spark, d)
    gates = V.thresholds(V.left_out(clips, ["vec_id"], "label", "embedding"), "label")
    out = V.cluster_rows(clips, ["vec_id"], ["label", "episode"], "embedding", "seconds", V.centroids(clips, "label", "embedding").withColumnRenamed("label", "name"), "name", gates.withColumnRenamed("label", "name"))
    rounded = ("row_similarity", "row_margin", "cluster_similarity", "agreement")
    return out.select("vec_id", "label", "episode", "candidate", "row_candidate", *[F.round(c, 6).alias(c) for c in rounded], "outlier")


@query()
def q_settled_clusters(spark: SparkSession, d: str) -> DataFrame:
    rows = _clips(spark, d).withColumn("clean", F.col("vec_id") % 4 > 0)
    out = V.settled_clusters(rows, "label", "vec_id", "embedding", "clean", 0.3)
    return out.withColumn("cluster_similarity", F.round("cluster_similarity", 6)).withColumn("nearest_similarity", F.round("nearest_similarity", 6))


@query()
def q_spectral(spark: SparkSession, d: str) -> DataFrame:
    return V.spectral(table(spark, d, "embeddings"), "label", "vec_id", "embedding")


@query(CUES + TURNS + """, v AS (SELECT episode, cue_id, min(struct_pack(rs := rs, re := re)) AS v FROM timed c JOIN turns t USING (episode) WHERE t.rs <= c."start" + 150 AND c."start" + 150 <= t.re GROUP BY 1, 2)
SELECT c.episode, c.cue_id, v.v.rs AS voice_start, v.v.re AS voice_end FROM timed c LEFT JOIN v ON c.episode = v.episode AND c.cue_id = v.cue_id""")
def q_islands_at(spark: SparkSession, d: str) -> DataFrame:
    cues = timed(spark, d).select("episode", "cue_id", F.col("start").alias("s"), F.col("end").alias("e"))
    voice = turns(spark, d).select("episode", "rs", "re")
    energy = spans.merged(turns(spark, d).select("episode", F.col("rs").alias("s"), F.col("re").alias("e")), ["episode"], 80).withColumnsRenamed({"s": "rs", "e": "re"})
    return spans.islands_at(cues, voice, energy, ["episode"], "cue_id").select("episode", "cue_id", "voice_start", "voice_end")


@query(_LEFT_OUT + """, g AS (SELECT label, count(*) AS clips, quantile_cont(own, 0.1) AS g, quantile_cont(impostor, 0.95) + 0.03 AS f, quantile_cont(own - impostor, 0.1) AS m FROM l WHERE own IS NOT NULL GROUP BY 1),
th AS (SELECT label, greatest(g, f) AS st, least(greatest(m, 0.08), 0.25) AS mt FROM g)
SELECT b.vec_id, CASE WHEN 1 + b.vec_id % 3 < 2 THEN 'too_short' WHEN round(similarity, 6) < round(coalesce(st, 0.0), 6) THEN 'low_similarity' WHEN round(similarity - second_similarity, 6) < round(greatest(coalesce(mt, 0.08), 0.08), 6) THEN 'ambiguous' ELSE 'eligible' END AS state
FROM b LEFT JOIN th ON b.candidate = th.label
""")
def q_score_states(spark: SparkSession, d: str) -> DataFrame:
    clips = _clips(spark, d)
    gates = V.thresholds(V.left_out(clips, ["vec_id"], "label", "embedding"), "label")
    gates = gates.withColumn("similarity_threshold", F.round("similarity_threshold", 6)).withColumn("margin_threshold", F.round("margin_threshold", 6))
    ranked = V.similarities(clips, ["vec_id", "seconds"], "embedding", V.centroids(clips, "label", "embedding"), "label")
    ranked = ranked.withColumn("similarity", F.round("similarity", 6)).withColumn("margin", F.round("margin", 6))
    return S.score_states(ranked, gates, "label", "seconds", 2.0).select("vec_id", "state")
