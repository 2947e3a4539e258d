"""Queries on activity, with the turns as activity of one stem per speaker and the cues as what is expected."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subloom.operators import activity as A
from subloom.plans.cue_queries import CUES, TURNS, timed, turns
from subloom.plans.registry import query

KEYS = ["episode"]


def _activity(spark: SparkSession, d: str) -> DataFrame:
    return turns(spark, d).select("episode", F.col("speaker").alias("stem"), F.col("rs").alias("s"), F.col("re").alias("e"))


def _cues(spark: SparkSession, d: str) -> DataFrame:
    return timed(spark, d).select("episode", "cue_id", F.col("start").alias("s"), F.col("end").alias("e"))


def _merged(name: str, source: str, keys: str, bridge: int = 0) -> str:
    """CTEs that merge the intervals (keys, s, e) of ``source`` into ``name``."""
    return f""", {name}_r AS (SELECT {keys}, s, e, max(e) OVER (PARTITION BY {keys} ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {source}),
{name}_i AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach + {bridge} THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS i FROM {name}_r),
{name} AS (SELECT {keys}, min(s) AS s, max(e) AS e FROM {name}_i GROUP BY {keys}, i)"""


_BASE = CUES + TURNS + """, act AS (SELECT episode, speaker AS stem, rs AS s, re AS e FROM turns), spot AS (SELECT episode, cue_id, "start" AS s, "end" AS e FROM timed),
line AS (SELECT episode, max(e) AS w FROM act GROUP BY 1)"""
_STEMS = _BASE + _merged("m", "act", "episode, stem")
_PIECES = _STEMS + """, pc AS (SELECT a.episode, a.stem AS stem_a, b.stem AS stem_b, greatest(a.s, b.s) AS s, least(a.e, b.e) AS e FROM m a JOIN m b ON a.episode = b.episode AND a.stem < b.stem AND a.s < b.e AND b.s < a.e)"""


@query(_STEMS + """, o AS (SELECT episode, stem, CAST(sum(e - s) AS BIGINT) AS active_ms FROM m GROUP BY 1, 2)
SELECT o.episode, stem, active_ms, active_ms / w AS ratio, CASE WHEN active_ms / w > 0.6 THEN 'dense' ELSE 'passed' END AS state FROM o JOIN line ON o.episode = line.episode""")
def q_activity_ratios(spark: SparkSession, d: str) -> DataFrame:
    return A.activity_ratios(_activity(spark, d), KEYS, "stem")


@query(_PIECES + """, o AS (SELECT episode, stem_a, stem_b, CAST(sum(e - s) AS BIGINT) AS shared_ms FROM pc GROUP BY 1, 2, 3)
SELECT o.episode, stem_a, stem_b, shared_ms, shared_ms / w AS ratio, CASE WHEN shared_ms / w > 0.1 THEN 'overlapping' ELSE 'passed' END AS state FROM o JOIN line ON o.episode = line.episode""")
def q_shared_activity(spark: SparkSession, d: str) -> DataFrame:
    return A.shared_activity(_activity(spark, d), KEYS, "stem")


_JOINT = _PIECES + _merged("g", "pc", "episode, stem_a, stem_b", 80) + """, jt AS (SELECT g.episode, g.stem_a, g.stem_b, g.s, g.e, CAST(sum(pc.e - pc.s) AS BIGINT) AS active_ms
FROM g JOIN pc ON g.episode = pc.episode AND g.stem_a = pc.stem_a AND g.stem_b = pc.stem_b AND pc.s >= g.s AND pc.e <= g.e GROUP BY 1, 2, 3, 4, 5 HAVING sum(pc.e - pc.s) >= 80)
"""


@query(_JOINT + "SELECT * FROM jt")
def q_joint_activity(spark: SparkSession, d: str) -> DataFrame:
    return A.joint_activity(_activity(spark, d), KEYS, "stem")


@query(_JOINT + """SELECT * FROM jt WHERE NOT EXISTS (SELECT 1 FROM cues c WHERE c.episode = jt.episode AND c."end" > c."start" AND length(c.text) >= 12 AND c."start" - 40 <= jt.s AND c."end" + 40 >= jt.e)""")
def q_unreviewed_activity(spark: SparkSession, d: str) -> DataFrame:
    reviews = timed(spark, d).select("episode", "text", F.col("start").alias("s"), F.col("end").alias("e"))
    return A.unreviewed(A.joint_activity(_activity(spark, d), KEYS, "stem"), reviews, KEYS, ["stem_a", "stem_b"], F.length("text") >= 12)


_WHOLE = _BASE + _merged("w", "act", "episode")


@query(_WHOLE + """, x AS (SELECT episode, cue_id, greatest(s - 500, 0) AS s, e + 500 AS e FROM spot),
o AS (SELECT x.episode, cue_id, CAST(coalesce(sum(CASE WHEN w.s IS NOT NULL THEN least(x.e, w.e) - greatest(x.s, w.s) END), 0) AS BIGINT) AS active_ms FROM x LEFT JOIN w ON x.episode = w.episode AND x.s < w.e AND w.s < x.e GROUP BY 1, 2)
SELECT * FROM o WHERE active_ms < 60""")
def q_missed_cues(spark: SparkSession, d: str) -> DataFrame:
    return A.missed_cues(_cues(spark, d), _activity(spark, d), KEYS, "cue_id")


@query(_WHOLE + ", cv AS (SELECT episode, greatest(s - 500, 0) AS s, e + 500 AS e FROM spot)" + _merged("k", "cv", "episode") + """, t AS (SELECT episode, CAST(sum(e - s) AS BIGINT) AS active_ms FROM w GROUP BY 1),
b AS (SELECT w.episode, sum(least(w.e, k.e) - greatest(w.s, k.s)) AS n FROM w JOIN k ON w.episode = k.episode AND w.s < k.e AND k.s < w.e GROUP BY 1), r AS (SELECT t.episode, active_ms, CAST(active_ms - coalesce(n, 0) AS BIGINT) AS off_ms FROM t LEFT JOIN b ON t.episode = b.episode)
SELECT *, off_ms / active_ms AS ratio, CASE WHEN off_ms / active_ms > 0.1 THEN 'excessive' ELSE 'passed' END AS state FROM r""")
def q_off_cue_activity(spark: SparkSession, d: str) -> DataFrame:
    return A.off_cue_activity(_activity(spark, d), _cues(spark, d), KEYS)


@query(_STEMS + """, sc AS (SELECT episode, anonymous_speaker AS stem, "start" AS s, "end" AS e FROM timed WHERE trim(anonymous_speaker) <> '')""" + _merged("t", "sc", "episode, stem", 250) + """,
n AS (SELECT t.episode, t.stem, t.s, bool_or(m.s < greatest(t.s - 500, 0) AND t.s > 500) AS b FROM t LEFT JOIN m ON t.episode = m.episode AND t.stem = m.stem AND m.s < t.s + 500 AND greatest(t.s - 500, 0) < m.e GROUP BY 1, 2, 3)
SELECT episode, stem, s, CASE WHEN b IS NULL THEN 'no_activity' ELSE 'already_active' END AS reason FROM n WHERE b IS NULL OR b""")
def q_onset_faults(spark: SparkSession, d: str) -> DataFrame:
    cues = timed(spark, d).where("trim(anonymous_speaker) <> ''").select("episode", F.col("anonymous_speaker").alias("stem"), F.col("start").alias("s"), F.col("end").alias("e"))
    return A.onset_faults(cues, _activity(spark, d), KEYS, "stem")


@query(_BASE + _merged("m", "act", "episode", 80) + """, f AS (SELECT episode, greatest(min(s) - 2000, 0) AS a, max(e) + 2000 AS z FROM spot GROUP BY 1),
r AS (SELECT m.episode, greatest(s, a) AS s, least(e, z) AS e FROM m JOIN f ON m.episode = f.episode WHERE e - s >= 60 AND least(e, z) - greatest(s, a) >= 60), cv AS (SELECT episode, greatest(s - 40, 0) AS s, e + 40 AS e FROM spot)""" + _merged("k", "cv", "episode") + """,
c AS (SELECT r.episode, r.s AS rs, r.e AS re, greatest(r.s, k.s) AS s, least(r.e, k.e) AS e FROM r JOIN k ON r.episode = k.episode AND r.s < k.e AND k.s < r.e),
g AS (SELECT episode, coalesce(lag(e) OVER (PARTITION BY episode, rs ORDER BY s), rs) AS s, s AS e FROM c UNION ALL SELECT episode, max(e), max(re) FROM c GROUP BY episode, rs
UNION ALL SELECT episode, s, e FROM r WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.episode = r.episode AND c.rs = r.s)), fr AS (SELECT * FROM g WHERE e - s >= 60)
SELECT episode, s, e, (SELECT min(cue_id) FROM spot p WHERE p.episode = fr.episode AND p.e = (SELECT max(q.e) FROM spot q WHERE q.episode = fr.episode AND q.e <= fr.s + 40)) AS previous_cue,
(SELECT min(cue_id) FROM spot p WHERE p.episode = fr.episode AND p.s = (SELECT min(q.s) FROM spot q WHERE q.episode = fr.episode AND q.s >= fr.e - 40)) AS next_cue FROM fr""")
def q_unassigned_activity(spark: SparkSession, d: str) -> DataFrame:
    return A.unassigned_activity(_activity(spark, d), _cues(spark, d), KEYS, "cue_id")
