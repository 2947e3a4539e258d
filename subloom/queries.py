"""Queries of the core operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subloom.operators.copies import differences
from subloom.operators.islands import periods_and_gaps
from subloom.operators.malformed import judge_records
from subloom.session import table

from subloom.plans import activity_queries, cue_queries, evidence_queries, gallery_queries, keyed_queries, review_queries, state_queries, stream_queries, text_queries  # noqa: E402,F401
from subloom.plans.registry import QUERIES, SQL  # noqa: E402


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return judge_records(table(spark, d, "raw_turn_lines"))[1].select("line_id", "reason")


@query
def p2_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Every reason of each bad record."""
    return judge_records(table(spark, d, "raw_turn_lines"))[1].select("line_id", F.explode("reasons").alias("reason"))


@query
def p2_good_rows(spark: SparkSession, d: str) -> DataFrame:
    return judge_records(table(spark, d, "raw_turn_lines"))[0]


_CELL = r'"(?:[^"]|"")*"|[^"\t][^\t]*|'
_BLANK = r"[\s\p{Z}\x{85}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180E}\x{200B}-\x{200F}\x{2028}-\x{202E}\x{2060}-\x{2064}\x{2800}\x{3164}\x{FEFF}\x{FFA0}\x{AD}]*"
_PARSED = rf"""
WITH b AS (SELECT line_id, regexp_replace(coalesce(raw, ''), '\r\z', '') AS r FROM raw_turn_lines),
q AS (SELECT line_id, regexp_full_match(r, '(?s)(?:{_CELL})(?:\t(?:{_CELL}))*') AS sound, regexp_extract_all(r, '(?s)(?:^|\t)({_CELL})', 1) AS f FROM b),
u AS (SELECT line_id, sound, list_transform(f, lambda x: CASE WHEN starts_with(x, '"') THEN replace(substr(x, 2, length(x) - 2), '""', '"') ELSE x END) AS f FROM q),
n AS (SELECT *, CASE WHEN len(f) = 6 THEN TRY_CAST(trim(f[3]) AS DECIMAL(38, 9)) END AS s, CASE WHEN len(f) = 6 AND regexp_full_match(f[4], ' *[0-9]+(\.[0-9]+)? *') THEN TRY_CAST(trim(f[4]) AS DECIMAL(38, 9)) END AS e FROM u),
j AS (SELECT *, CASE WHEN NOT sound THEN 'quoting' WHEN len(f) <> 6 THEN 'column_count'
  WHEN NOT regexp_full_match(f[2], ' *[0-9]{{1,9}} *') OR TRY_CAST(trim(f[2]) AS BIGINT) < 1 THEN 'source_index'
  WHEN e IS NULL OR s IS NULL OR e <= s THEN 'end_seconds'
  WHEN regexp_full_match(f[6], '{_BLANK}') OR regexp_matches(f[6], '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x{{84}}\x{{86}}-\x{{9F}}]') THEN 'text' END AS reason FROM n)
"""
SQL["p2_found"] = _PARSED + "SELECT line_id, reason FROM j WHERE reason IS NOT NULL"
SQL["p2_good_rows"] = _PARSED + """
SELECT line_id, f[1] AS episode, CAST(trim(f[2]) AS INTEGER) AS source_index, CAST(trim(f[3]) AS DOUBLE) AS start_seconds,
  CAST(trim(f[4]) AS DOUBLE) AS end_seconds, f[5] AS speaker, f[6] AS text FROM j WHERE reason IS NULL
"""


@query
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return periods_and_gaps(table(spark, d, "cue_labels"), max_gap=1_800_000)


SQL["p4_found"] = """
WITH c AS (SELECT episode, "start" AS s, "end" AS e FROM cue_labels WHERE episode IS NOT NULL AND "end" > "start"),
r AS (SELECT *, max(e) OVER (PARTITION BY episode ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM c),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY episode ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM r),
p AS (SELECT episode, island, min(s) AS s, max(e) AS e FROM i GROUP BY 1, 2),
g AS (SELECT episode, lag(e) OVER (PARTITION BY episode ORDER BY s) AS s, s AS e FROM p)
SELECT episode, 'period' AS kind, s AS start_ms, e AS end_ms FROM p
UNION ALL SELECT episode, 'gap', s, e FROM g WHERE s IS NOT NULL AND e - s < 1800000
"""


@query
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    labels, script = table(spark, d, "cue_labels"), table(spark, d, "script_rows")
    columns = {"role": ("role", "名前"), "text": ("text", "台詞")}
    return differences(labels, script, ["episode", "source_index"], columns, ("labels", "script"))


SQL["p5_found"] = r"""
WITH l AS (SELECT DISTINCT episode, source_index, regexp_replace(coalesce(role, ''), '\r\n?', chr(10), 'g') AS r, regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g') AS t FROM cue_labels),
s AS (SELECT DISTINCT episode, source_index, regexp_replace(coalesce("名前", ''), '\r\n?', chr(10), 'g') AS r, regexp_replace(coalesce("台詞", ''), '\r\n?', chr(10), 'g') AS t FROM script_rows),
lk AS (SELECT episode, source_index, list_sort(list(DISTINCT r)) AS r, list_sort(list(DISTINCT t)) AS t FROM l GROUP BY 1, 2),
sk AS (SELECT episode, source_index, list_sort(list(DISTINCT r)) AS r, list_sort(list(DISTINCT t)) AS t FROM s GROUP BY 1, 2),
j AS (SELECT coalesce(lk.episode, sk.episode) AS episode, coalesce(lk.source_index, sk.source_index) AS source_index, lk.r AS lr, lk.t AS lt, sk.r AS sr, sk.t AS st
      FROM lk FULL JOIN sk ON lk.episode IS NOT DISTINCT FROM sk.episode AND lk.source_index IS NOT DISTINCT FROM sk.source_index)
SELECT episode, source_index, 'missing_in_script' AS difference FROM j WHERE sr IS NULL
UNION ALL SELECT episode, source_index, 'missing_in_labels' FROM j WHERE lr IS NULL
UNION ALL SELECT episode, source_index, 'role' FROM j WHERE lr <> sr
UNION ALL SELECT episode, source_index, 'text' FROM j WHERE lt <> st
"""
