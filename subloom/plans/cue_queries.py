"""Queries over the order and the time of cues and turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subloom.operators import dialogue as D
from subloom.operators import schedules as S
from subloom.operators import spans
from subloom.operators.dialogue import ANSWERS, LEAD_INS, PREDICATES, SOFT, STRONG, TE_FORM, TERMINAL, WEAK
from subloom.operators.keyed import first_rows
from subloom.plans.registry import query
from subloom.plans.text_queries import B
from subloom.functions import texts as T
from subloom.session import table

KEYS = ["episode"]
CUES = """
WITH cues AS (SELECT episode, source_index, cue_id, "start", "end", role, text, semantic_unit, anonymous_speaker FROM
  (SELECT *, row_number() OVER (PARTITION BY episode, source_index ORDER BY cue_id) AS n FROM cue_labels) WHERE n = 1),
timed AS (SELECT * FROM cues WHERE "start" IS NOT NULL AND "end" > "start")
"""
TURNS = """, turns AS (SELECT turn_id, episode, speaker, CAST(round(start_seconds * 1000) AS BIGINT) AS rs, CAST(round(end_seconds * 1000) AS BIGINT) AS re FROM speaker_turns
  WHERE end_seconds > start_seconds AND trim(speaker) <> '')
"""


def cues(spark: SparkSession, d: str) -> DataFrame:
    """One row per (episode, source_index): of repeated rows that with the smallest cue_id."""
    df = table(spark, d, "cue_labels").select("episode", "source_index", "cue_id", "start", "end", "role", "text", "semantic_unit", "anonymous_speaker")
    return first_rows(df, ["episode", "source_index"], "cue_id")


def timed(spark: SparkSession, d: str) -> DataFrame:
    return cues(spark, d).where(F.col("start").isNotNull() & (F.col("end") > F.col("start")))


def turns(spark: SparkSession, d: str) -> DataFrame:
    ms = lambda c: F.round(F.col(c) * 1000).cast("bigint")
    df = table(spark, d, "speaker_turns").where((F.col("end_seconds") > F.col("start_seconds")) & (F.trim("speaker") != ""))
    return df.select("turn_id", "episode", "speaker", ms("start_seconds").alias("rs"), ms("end_seconds").alias("re"))


def _ends(x: str, endings) -> str:
    return "(" + " OR ".join(f"ends_with({x}, '{e}')" for e in endings) + ")"


_BOUNDARIES = (
    CUES
    + f""", p AS (SELECT *, regexp_replace(coalesce(text, ''), '{B}+', '', 'g') AS t, lag("end") OVER w AS pe, lag(regexp_replace(coalesce(text, ''), '{B}+', '', 'g')) OVER w AS pt, row_number() OVER w AS n FROM cues WINDOW w AS (PARTITION BY episode ORDER BY source_index)),
g AS (SELECT *, "start" - pe AS gap FROM p),
s AS (SELECT *,
  (CASE WHEN gap <= 650 THEN 1 ELSE 0 END) + (CASE WHEN {_ends('pt', SOFT)} THEN 4 ELSE 0 END) + (CASE WHEN {' OR '.join(f"length(replace(pt, '{b}', '')) > length(replace(pt, '{a}', ''))" for a, b in T.DELIMITERS)} THEN 4 ELSE 0 END)
  + (CASE WHEN {_ends('pt', STRONG)} THEN 3 WHEN {_ends('pt', TE_FORM)} THEN 1 WHEN {_ends('pt', WEAK)} THEN 2 ELSE 0 END) + (CASE WHEN pt IN ({', '.join(f"'{x}'" for x in LEAD_INS)}) THEN 2 ELSE 0 END) AS j,
  (CASE WHEN gap > 1200 THEN 2 ELSE 0 END) + (CASE WHEN {_ends('pt', PREDICATES)} THEN 2 ELSE 0 END) + (CASE WHEN {' OR '.join(f"starts_with(t, '{x}')" for x in ANSWERS)} THEN 3 ELSE 0 END) AS x FROM g),
k AS (SELECT *, CASE WHEN n = 1 THEN NULL WHEN pt = '' OR t = '' OR gap IS NULL THEN 0 WHEN {_ends('pt', TERMINAL)} THEN 1 WHEN gap > 1800 THEN 1 WHEN gap < -80 THEN 2 ELSE 3 END AS kind FROM s),
d AS (SELECT episode, source_index, cue_id, n, CASE kind WHEN 0 THEN 'split' WHEN 1 THEN 'split' WHEN 2 THEN 'review' WHEN 3 THEN CASE WHEN j >= 3 AND j - x >= 2 THEN 'join' WHEN x >= 3 AND j <= x THEN 'split' ELSE 'review' END END AS decision,
  CAST(CASE WHEN kind = 3 THEN j WHEN kind IS NOT NULL THEN 0 END AS INTEGER) AS join_score, CAST(CASE kind WHEN 0 THEN 0 WHEN 1 THEN 6 WHEN 2 THEN 4 WHEN 3 THEN x END AS INTEGER) AS split_score FROM k)
"""
)


@query(_BOUNDARIES + "SELECT episode, source_index, cue_id, decision, join_score, split_score FROM d")
def q_unit_boundaries(spark: SparkSession, d: str) -> DataFrame:
    return D.boundaries(cues(spark, d), KEYS, "source_index", "start", "end", "text").select("episode", "source_index", "cue_id", "decision", "join_score", "split_score")


@query(_BOUNDARIES + "SELECT episode, source_index, CAST(sum(CASE WHEN decision = 'join' THEN 0 ELSE 1 END) OVER (PARTITION BY episode ORDER BY source_index ROWS UNBOUNDED PRECEDING) AS BIGINT) AS unit_no FROM d")
def q_units(spark: SparkSession, d: str) -> DataFrame:
    return D.units(cues(spark, d), KEYS, "source_index", "start", "end", "text").select("episode", "source_index", "unit_no")


@query(CUES + ", p AS (SELECT *, lag(role) OVER w AS pr, lag(semantic_unit) OVER w AS pu FROM cues WINDOW w AS (PARTITION BY episode ORDER BY source_index)) SELECT episode, source_index, role, pr AS previous_role FROM p WHERE semantic_unit = pu AND semantic_unit <> '' AND role <> pr")
def q_role_switches(spark: SparkSession, d: str) -> DataFrame:
    return D.switches(cues(spark, d), KEYS, "source_index", "role", "semantic_unit").select("episode", "source_index", "role", "previous_role")


@query(
    CUES
    + """, p AS (SELECT *, CASE WHEN semantic_unit = lag(semantic_unit) OVER w AND role = lag(role) OVER w AND semantic_unit <> '' AND role <> '' THEN 0 ELSE 1 END AS o FROM cues WINDOW w AS (PARTITION BY episode ORDER BY source_index)),
g AS (SELECT *, sum(o) OVER (PARTITION BY episode ORDER BY source_index ROWS UNBOUNDED PRECEDING) AS g FROM p)
SELECT episode, min(semantic_unit) AS semantic_unit, min(role) AS role, min(source_index) AS first_source_index, count(*) AS n, min("start") AS "start", max("end") AS "end", string_agg(coalesce(text, ''), ' / ' ORDER BY source_index) AS text FROM g GROUP BY episode, g
"""
)
def q_group_in_a_row(spark: SparkSession, d: str) -> DataFrame:
    return D.groups_in_a_row(cues(spark, d), KEYS, "source_index", ["semantic_unit", "role"], "start", "end", "text")


@query(CUES + ", p AS (SELECT *, lag(role) OVER w AS pr, lag(semantic_unit) OVER w AS pu FROM cues WINDOW w AS (PARTITION BY episode ORDER BY source_index)) SELECT episode, source_index, CASE WHEN role = pr AND semantic_unit = pu AND semantic_unit <> '' THEN '' ELSE coalesce(role, '') END AS shown_role FROM p")
def q_repeat_suppress(spark: SparkSession, d: str) -> DataFrame:
    return D.shown_roles(cues(spark, d), KEYS, "source_index", "role", "semantic_unit").select("episode", "source_index", "shown_role")


@query(CUES + f", b AS (SELECT episode, source_index, CASE WHEN regexp_replace(role, '^{B}+|{B}+$', '', 'g') <> '' THEN role END AS r FROM cues) SELECT episode, source_index, last_value(r IGNORE NULLS) OVER (PARTITION BY episode ORDER BY source_index ROWS UNBOUNDED PRECEDING) AS filled FROM b")
def q_forward_fill(spark: SparkSession, d: str) -> DataFrame:
    return D.filled_forward(cues(spark, d), KEYS, "source_index", "role", "filled").select("episode", "source_index", "filled")


@query(CUES + ", p AS (SELECT episode, source_index AS before, lag(source_index) OVER (PARTITION BY episode ORDER BY source_index) AS after FROM cues) SELECT episode, after, before, before - after - 1 AS missing FROM p WHERE before > after + 1")
def q_index_gaps(spark: SparkSession, d: str) -> DataFrame:
    return D.index_gaps(cues(spark, d), KEYS, "source_index")


@query(CUES + "SELECT episode, source_index, list(coalesce(text, '')) OVER (PARTITION BY episode ORDER BY source_index ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS context FROM cues")
def q_context_window(spark: SparkSession, d: str) -> DataFrame:
    return D.context(cues(spark, d), KEYS, "source_index", "text", 2).select("episode", "source_index", "context")


@query("""
WITH e AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events)
SELECT user_id, event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS smoothed FROM e
""")
def q_moving_average(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("user_id", "event_id", "value")
    return D.moving_average(rows, ["user_id"], "event_id", "value", 2, "smoothed").select("user_id", "event_id", F.round("smoothed", 6).alias("smoothed"))


@query("""
WITH f AS (SELECT episode, speaker, min(start_seconds) AS s FROM speaker_turns WHERE speaker IS NOT NULL AND start_seconds IS NOT NULL GROUP BY 1, 2)
SELECT episode, speaker, 'Speaker' || lpad(CAST(row_number() OVER (PARTITION BY episode ORDER BY s, speaker) AS VARCHAR), 2, '0') AS named FROM f
""")
def q_speaker_names(spark: SparkSession, d: str) -> DataFrame:
    return D.speaker_names(table(spark, d, "speaker_turns"), KEYS, "speaker", "start_seconds")


@query(CUES + """, r AS (SELECT episode, source_index, "start", max("end") OVER (PARTITION BY episode ORDER BY source_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM timed) SELECT episode, source_index, reached - "start" AS overlap FROM r WHERE "start" < reached""")
def q_running_overlap(spark: SparkSession, d: str) -> DataFrame:
    from subloom.operators.ordered import carried

    rows = carried(timed(spark, d), KEYS, "source_index", F.col("end"), "reached")
    return rows.where(F.col("start") < F.col("reached")).select("episode", "source_index", (F.col("reached") - F.col("start")).alias("overlap"))


_PUSHED = CUES + """, a AS (SELECT episode, source_index, "start" AS t, "end" - "start" AS d, 50 + "end" - "start" AS a FROM timed),
s AS (SELECT *, sum(a) OVER w AS sm FROM a WINDOW w AS (PARTITION BY episode ORDER BY source_index ROWS UNBOUNDED PRECEDING)),
e AS (SELECT *, sm + greatest(0, max(t + d - sm) OVER (PARTITION BY episode ORDER BY source_index ROWS UNBOUNDED PRECEDING)) AS e FROM s),
p AS (SELECT *, greatest(t, coalesce(lag(e) OVER (PARTITION BY episode ORDER BY source_index), 0) + 50) AS st FROM e)
SELECT episode, source_index, CAST(st AS BIGINT) AS placed, CAST(st - t AS BIGINT) AS delay, CASE WHEN st - t > 1000 THEN 'abort' WHEN st - t >= 500 THEN 'warn' ELSE 'ok' END AS delay_state FROM p
"""


def _targets(spark: SparkSession, d: str) -> DataFrame:
    return timed(spark, d).select("episode", "source_index", F.col("start").alias("target"), (F.col("end") - F.col("start")).alias("length"))


@query(_PUSHED)
def q_push_schedule(spark: SparkSession, d: str) -> DataFrame:
    return S.pushed(_targets(spark, d), KEYS, "source_index", "target", "length").select("episode", "source_index", F.col("start").alias("placed"), "delay", "delay_state")


@query(CUES + """, n AS (SELECT episode, source_index, "start" AS s, "end" AS e, row_number() OVER (PARTITION BY episode ORDER BY source_index) AS i FROM timed),
m AS (SELECT *, 433 * i + max(s - 433 * i) OVER (PARTITION BY episode ORDER BY i ROWS UNBOUNDED PRECEDING) AS ns FROM n)
SELECT episode, source_index, ns AS new_start, least(greatest(e, ns + 400), coalesce(lead(ns) OVER (PARTITION BY episode ORDER BY i) - 33, greatest(e, ns + 400))) AS new_end FROM m
""")
def q_resolve_overlaps(spark: SparkSession, d: str) -> DataFrame:
    return S.separated(timed(spark, d), KEYS, "source_index", "start", "end").select("episode", "source_index", "new_start", "new_end")


_STEPS = CUES.replace("WITH", "WITH RECURSIVE", 1) + """, x AS (SELECT episode, source_index, "start" AS t, "end" AS z, row_number() OVER (PARTITION BY episode ORDER BY source_index) AS n FROM timed),
first AS (SELECT DISTINCT episode FROM x)"""


@query(_STEPS + """, y AS (SELECT *, z - t AS d, source_index % 7 = 0 AS h FROM x),
r AS (SELECT episode, 0 AS n, NULL::INTEGER AS source_index, NULL::BIGINT AS st, NULL::BOOLEAN AS manual, 0::BIGINT AS reached FROM first
UNION ALL SELECT q.episode, q.n, q.source_index, CASE WHEN q.m THEN q.t ELSE q.st END, q.m, CASE WHEN q.m THEN q.reached ELSE greatest(q.reached, q.st + q.d) END FROM
  (SELECT w.*, st - t > 1000 OR (h AND st > t) AS m FROM (SELECT y.episode, y.n::INTEGER AS n, y.source_index, y.t, y.d, y.h, r.reached, greatest(y.t, r.reached + 50) AS st FROM r JOIN y ON y.episode = r.episode AND y.n = r.n + 1) w) q)
SELECT episode, source_index, st AS "start", manual FROM r WHERE n > 0
""")
def q_push_with_escape(spark: SparkSession, d: str) -> DataFrame:
    rows = _targets(spark, d).withColumn("hard", F.col("source_index") % 7 == 0)
    return S.pushed_with_escape(rows, KEYS, "source_index", "target", "length", "hard")


@query(_STEPS + """, r AS (SELECT episode, 0 AS n, 0 AS c, 0::BIGINT AS k, NULL::BIGINT AS s, NULL::BIGINT AS e FROM first
UNION ALL SELECT q.episode, q.n, q.c + CASE WHEN cut THEN 1 ELSE 0 END, CASE WHEN cut THEN 1 ELSE q.k + 1 END, CASE WHEN cut THEN q.t ELSE q.s END, CASE WHEN cut THEN q.z ELSE greatest(q.e, q.z) END FROM
  (SELECT x.episode, x.n::INTEGER AS n, x.t, x.z, r.c, r.k, r.s, r.e, r.s IS NULL OR (r.e - r.s >= 12000 AND x.t - r.e >= 500) OR x.z - r.s >= 25000 AS cut FROM r JOIN x ON x.episode = r.episode AND x.n = r.n + 1) q)
SELECT episode, greatest(0, max(s) - 2000) AS chunk_start, max(e) + 2000 AS chunk_end, max(k) AS n FROM r WHERE n > 0 GROUP BY episode, c
""")
def q_chunks(spark: SparkSession, d: str) -> DataFrame:
    return S.chunks(timed(spark, d), KEYS, "source_index", "start", "end")


_PAIRS = CUES + TURNS + """, o AS (SELECT cue_id, turn_id, speaker, least("end", re) - greatest("start", rs) AS overlap FROM timed c JOIN turns t ON c.episode = t.episode AND c."start" < t.re AND t.rs < c."end")
"""


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    left = timed(spark, d).select("episode", "cue_id", F.col("start").alias("s"), F.col("end").alias("e"))
    return spans.overlaps(left, turns(spark, d), KEYS).select("cue_id", "turn_id", "speaker", spans.overlap_ms().alias("overlap"))


@query(_PAIRS + "SELECT * FROM o")
def q_overlap_join(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d)


@query(_PAIRS + """, b AS (SELECT cue_id, speaker, CAST(sum(overlap) AS BIGINT) AS overlap FROM o GROUP BY 1, 2),
r AS (SELECT *, CAST(sum(overlap) OVER (PARTITION BY cue_id) AS BIGINT) AS total, count(*) OVER (PARTITION BY cue_id) AS n, row_number() OVER (PARTITION BY cue_id ORDER BY overlap DESC, speaker) AS k FROM b)
SELECT cue_id, speaker, overlap, total, overlap / total AS ratio, CASE WHEN n = 1 THEN 'single' WHEN overlap / total >= 0.7 THEN 'dominant' ELSE 'multiple' END AS state FROM r WHERE k = 1
""")
def q_dominant_speaker(spark: SparkSession, d: str) -> DataFrame:
    return spans.dominant(_pairs(spark, d), ["cue_id"], "speaker")


@query(CUES + TURNS + """SELECT cue_id, count(*) AS turns_begun FROM timed c JOIN turns t ON c.episode = t.episode AND t.rs BETWEEN c."start" AND c."end" GROUP BY 1""")
def q_points_in_intervals(spark: SparkSession, d: str) -> DataFrame:
    left = timed(spark, d).select("episode", "cue_id", F.col("start").alias("s"), (F.col("end") + 1).alias("e"))
    points = turns(spark, d).select("episode", "turn_id", "rs", (F.col("rs") + 1).alias("re"))
    return spans.overlaps(left, points, KEYS).groupBy("cue_id").agg(F.count("*").alias("turns_begun"))


@query(CUES + """SELECT a.cue_id AS first_id, b.cue_id AS second_id, least(a."end", b."end") - greatest(a."start", b."start") AS overlap FROM timed a JOIN timed b ON a.episode = b.episode AND a.cue_id < b.cue_id AND a."start" < b."end" AND b."start" < a."end" WHERE a.role <> b.role""")
def q_pair_overlaps(spark: SparkSession, d: str) -> DataFrame:
    rows = timed(spark, d).select("episode", "cue_id", "role", F.col("start").alias("s"), F.col("end").alias("e"))
    other = rows.withColumnsRenamed({"cue_id": "other_id", "role": "other_role", "s": "rs", "e": "re"})
    met = spans.overlaps(rows, other, KEYS).where((F.col("cue_id") < F.col("other_id")) & (F.col("role") != F.col("other_role")))
    return met.select(F.col("cue_id").alias("first_id"), F.col("other_id").alias("second_id"), spans.overlap_ms().alias("overlap"))


_ISLANDS = """, r AS (SELECT episode, rs, re, max(re) OVER (PARTITION BY episode ORDER BY rs, re ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM turns),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR rs > reach + {bridge} THEN 1 ELSE 0 END) OVER (PARTITION BY episode ORDER BY rs, re ROWS UNBOUNDED PRECEDING) AS i FROM r),
m AS (SELECT episode, min(rs) AS s, max(re) AS e FROM i GROUP BY episode, i)
"""


@query(CUES + TURNS + _ISLANDS.format(bridge=250) + "SELECT episode, s, e FROM m WHERE e - s >= 60")
def q_bridged_islands(spark: SparkSession, d: str) -> DataFrame:
    return spans.merged(turns(spark, d).select("episode", F.col("rs").alias("s"), F.col("re").alias("e")), KEYS, 250, 60)


@query(CUES + TURNS + _ISLANDS.format(bridge=0) + """, c AS (SELECT t.episode, cue_id, "start" AS cs, "end" AS ce, greatest("start", s) AS s, least("end", e) AS e FROM timed t JOIN m ON t.episode = m.episode AND "start" < m.e AND m.s < "end"),
g AS (SELECT episode, cue_id, coalesce(lag(e) OVER (PARTITION BY episode, cue_id ORDER BY s), cs) AS s, s AS e FROM c UNION ALL SELECT episode, cue_id, max(e), max(ce) FROM c GROUP BY 1, 2
UNION ALL SELECT episode, cue_id, "start", "end" FROM timed WHERE cue_id NOT IN (SELECT cue_id FROM c)) SELECT * FROM g WHERE e > s
""")
def q_interval_subtract(spark: SparkSession, d: str) -> DataFrame:
    regions = timed(spark, d).select("episode", "cue_id", F.col("start").alias("s"), F.col("end").alias("e"))
    return spans.subtracted(regions, turns(spark, d).select("episode", F.col("rs").alias("s"), F.col("re").alias("e")), KEYS, "cue_id")


@query(CUES + TURNS + """, k AS (SELECT episode, cue_id, "start" AS p FROM timed),
pe AS (SELECT cue_id, max(re) AS prev_end FROM k JOIN turns USING (episode) WHERE re <= p GROUP BY 1), ns AS (SELECT cue_id, min(rs) AS next_start FROM k JOIN turns USING (episode) WHERE rs >= p GROUP BY 1)
SELECT k.cue_id, prev_end, (SELECT min(turn_id) FROM turns t WHERE t.episode = k.episode AND t.re = pe.prev_end) AS prev_id, next_start, (SELECT min(turn_id) FROM turns t WHERE t.episode = k.episode AND t.rs = ns.next_start) AS next_id
FROM k LEFT JOIN pe USING (cue_id) LEFT JOIN ns USING (cue_id)
""")
def q_previous_and_next(spark: SparkSession, d: str) -> DataFrame:
    points = timed(spark, d).select("episode", "cue_id", F.col("start").alias("p"))
    intervals = turns(spark, d).select("episode", F.col("turn_id").alias("id"), F.col("rs").alias("s"), F.col("re").alias("e"))
    return spans.previous_and_next(points, intervals, KEYS).select("cue_id", "prev_end", "prev_id", "next_start", "next_id")


@query(CUES + """, x AS (SELECT episode, "start" AS pt, 1 AS d FROM timed UNION ALL SELECT episode, "end", -1 FROM timed), g AS (SELECT episode, pt, sum(d) AS d FROM x GROUP BY 1, 2),
r AS (SELECT episode, lag(pt) OVER w AS s, pt AS e, sum(d) OVER (PARTITION BY episode ORDER BY pt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS depth FROM g WINDOW w AS (PARTITION BY episode ORDER BY pt))
SELECT episode, s, e, CAST(depth AS BIGINT) AS depth FROM r WHERE depth > 0
""")
def q_depth_sweep(spark: SparkSession, d: str) -> DataFrame:
    return spans.depth(timed(spark, d).select("episode", F.col("start").alias("s"), F.col("end").alias("e")), KEYS)


@query("""
WITH f AS (SELECT DISTINCT user_id, epoch_us(ts) // 60000000 AS fr FROM events), o AS (SELECT *, lag(fr) OVER (PARTITION BY user_id ORDER BY fr) AS p FROM f),
i AS (SELECT *, sum(CASE WHEN p IS NULL OR fr - p - 1 > 30 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY fr ROWS UNBOUNDED PRECEDING) AS i FROM o)
SELECT user_id, min(fr) AS "first", max(fr) AS "last", max(fr) - min(fr) + 1 AS frames FROM i GROUP BY user_id, i HAVING max(fr) - min(fr) + 1 >= 2
""")
def q_frame_runs(spark: SparkSession, d: str) -> DataFrame:
    frames = table(spark, d, "events").select("user_id", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 60_000_000).cast("bigint").alias("frame"))
    return spans.runs_of_frames(frames, ["user_id"], "frame", 30, 2)
