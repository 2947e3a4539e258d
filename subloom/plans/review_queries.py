"""Queries on review rounds, with the script rows as reviews of the label rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subloom.operators import reviews as R
from subloom.operators.keyed import first_rows
from subloom.plans.cue_queries import _BOUNDARIES, CUES, KEYS, cues
from subloom.plans.registry import query
from subloom.session import table

ROW = ["episode", "source_index"]


@query("""SELECT cue_id, episode, source_index, "start", "end", text FROM cue_labels WHERE status IS NULL OR status NOT IN ('ok', 'manual')""")
def q_for_review(spark: SparkSession, d: str) -> DataFrame:
    return R.for_review(table(spark, d, "cue_labels"), "status", ["ok", "manual"], ["cue_id", "episode", "source_index", "start", "end", "text"])


def _reviewed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    reviews = table(spark, d, "script_rows").select(*ROW, F.col("名前").alias("role"), F.col("台詞").alias("text"))
    return R.reviewed(cues(spark, d).select(*ROW, "role", "text"), reviews, ROW, "role", ["text"], table(spark, d, "role_catalog").select("role"))


@query()
def q_reviewed(spark: SparkSession, d: str) -> DataFrame:
    return _reviewed(spark, d)[0]


@query()
def q_review_issues(spark: SparkSession, d: str) -> DataFrame:
    return _reviewed(spark, d)[1]


@query(CUES + """, x AS (SELECT c.episode, c.source_index, c."start", c."end", c.text, c.anonymous_speaker AS a, l.confidence < 0.7 AS w FROM cues c JOIN cue_labels l ON c.cue_id = l.cue_id WHERE c.anonymous_speaker IS NOT NULL),
h AS (SELECT *, ('0x' || substr(sha1(episode || '|' || CAST(source_index AS VARCHAR)), 1, 15))::BIGINT AS p FROM x WHERE NOT coalesce(w, false)),
r AS (SELECT *, row_number() OVER (PARTITION BY episode, a ORDER BY p) AS k, count(*) OVER (PARTITION BY episode, a) AS n FROM h)
SELECT episode, source_index, "start", "end", text FROM r WHERE k <= greatest(1, ceil(n * 0.2)) UNION ALL SELECT episode, source_index, "start", "end", text FROM x WHERE w
""")
def q_blind_sample(spark: SparkSession, d: str) -> DataFrame:
    rows = first_rows(table(spark, d, "cue_labels").select(*ROW, "cue_id", "start", "end", "text", "anonymous_speaker", "confidence"), ROW, "cue_id").where("anonymous_speaker is not null")
    return R.blind_sample(rows, ["episode", "anonymous_speaker"], ROW, F.col("confidence") < 0.7, 0.2, [*ROW, "start", "end", "text"])


@query("""
WITH g AS (SELECT episode, anonymous_speaker, count(*) AS rows, count(*) FILTER (status = 'manual') AS audited FROM cue_labels GROUP BY 1, 2)
SELECT episode, anonymous_speaker, rows, CAST(greatest(1, ceil(rows * 0.1)) AS BIGINT) AS required, audited, audited >= greatest(1, ceil(rows * 0.1)) AS enough FROM g
""")
def q_sample_sufficiency(spark: SparkSession, d: str) -> DataFrame:
    return R.sample_sufficiency(table(spark, d, "cue_labels"), ["episode", "anonymous_speaker"], F.col("status") == "manual", 0.1)


_SCRIPT = """, s AS (SELECT episode, source_index, "台詞" AS text FROM (SELECT *, row_number() OVER (PARTITION BY episode, source_index ORDER BY script_row_id) AS n FROM script_rows) WHERE n = 1),
a AS (SELECT episode, row_number() OVER (PARTITION BY episode ORDER BY source_index) AS place, source_index AS x, coalesce(text, '') AS t FROM cues),
b AS (SELECT episode, row_number() OVER (PARTITION BY episode ORDER BY source_index) AS place, source_index AS x, coalesce(text, '') AS t FROM s),
j AS (SELECT coalesce(a.episode, b.episode) AS episode, coalesce(a.place, b.place) AS place, a.x AS ax, b.x AS bx, a.t AS tt, b.t AS bt FROM a FULL JOIN b ON a.episode = b.episode AND a.place = b.place),
si AS (SELECT episode, place, 'missing' AS issue FROM j WHERE bx IS NULL UNION ALL SELECT episode, place, 'added' FROM j WHERE ax IS NULL UNION ALL SELECT episode, place, 'index_order' FROM j WHERE ax <> bx UNION ALL SELECT episode, place, 'text' FROM j WHERE tt <> bt)
"""


def _integrity(spark: SparkSession, d: str) -> DataFrame:
    script = first_rows(table(spark, d, "script_rows").select(*ROW, "script_row_id", F.col("台詞").alias("text")), ROW, "script_row_id")
    return R.source_integrity(cues(spark, d).select(*ROW, "text"), script.select(*ROW, "text"), KEYS, "source_index", ["text"])


@query(CUES + _SCRIPT + "SELECT * FROM si")
def q_source_integrity(spark: SparkSession, d: str) -> DataFrame:
    return _integrity(spark, d)


_CONTINUITY = _BOUNDARIES + """, y AS (SELECT d.*, c.role, c.semantic_unit AS u, lag(c.role) OVER w AS pr, lag(c.semantic_unit) OVER w AS pu, lag(d.source_index) OVER w AS previous_source_index FROM d JOIN cues c ON d.cue_id = c.cue_id WINDOW w AS (PARTITION BY d.episode ORDER BY d.source_index)),
ci AS (SELECT episode, source_index, previous_source_index, CASE WHEN u <> '' AND u = pu THEN 'role_switch_inside_semantic_unit' WHEN decision = 'join' THEN 'role_switch_inside_likely_semantic_unit' WHEN decision = 'review' AND join_score >= 2 THEN 'role_switch_at_ambiguous_semantic_boundary' END AS issue, decision
FROM y WHERE trim(role) <> '' AND trim(pr) <> '' AND trim(role) <> trim(pr))
"""


def _continuity(spark: SparkSession, d: str) -> DataFrame:
    return R.continuity_issues(cues(spark, d), KEYS, "source_index", "start", "end", "text", "role", "semantic_unit")


@query(_CONTINUITY + "SELECT * FROM ci WHERE issue IS NOT NULL")
def q_continuity_issues(spark: SparkSession, d: str) -> DataFrame:
    return _continuity(spark, d)


def _votes(spark: SparkSession, d: str) -> DataFrame:
    votes = table(spark, d, "voice_ensemble").select(
        "ens_id", "episode", "ensemble_status", "ensemble_candidate", "expected_role", F.when(F.col("failed_models_json") != "{}", "true").otherwise("false").alias("flag")
    )
    return R.vote_consistency(votes, ["ens_id", "episode"], "ensemble_status", "ensemble_candidate", "expected_role", "flag", ["consensus_all", "consensus_most"], ["model_disagreement"], ["insufficient_models", ""])


@query("""
WITH v AS (SELECT ens_id, episode, coalesce(trim(ensemble_status), '') AS s, coalesce(trim(ensemble_candidate), '') AS c, coalesce(trim(expected_role), '') AS r, coalesce(failed_models_json <> '{}', false) AS up FROM voice_ensemble),
k AS (SELECT *, s IN ('consensus_all', 'consensus_most') AS f, s = 'model_disagreement' AS h, s IN ('consensus_all', 'consensus_most', 'model_disagreement', 'insufficient_models', '') AS ok, r <> '' AND c <> r AS apart FROM v)
SELECT ens_id, episode, unnest(list_filter([CASE WHEN NOT ok THEN 'invalid_status' END, CASE WHEN f AND c = '' THEN 'missing_candidate' END, CASE WHEN f AND c <> '' AND apart AND NOT up THEN 'conflict_flag_missing' END,
  CASE WHEN f AND c <> '' AND NOT apart AND up THEN 'stale_conflict_flag' END, CASE WHEN h AND c = '' THEN 'advisory_missing_candidate' END, CASE WHEN h AND up THEN 'weak_vote_must_not_flag' END,
  CASE WHEN ok AND NOT f AND NOT h AND c <> '' THEN 'ineligible_has_candidate' END], lambda x: x IS NOT NULL)) AS issue FROM k
""")
def q_vote_consistency(spark: SparkSession, d: str) -> DataFrame:
    return _votes(spark, d)


@query(
    _CONTINUITY
    + _SCRIPT.replace("a AS (", "a2 AS (").replace("b AS (", "b2 AS (").replace("FROM a FULL JOIN b ON a.", "FROM a2 a FULL JOIN b2 b ON a.").replace(", s AS", ", s2 AS").replace("FROM s)", "FROM s2)")
    + """, f AS (SELECT episode, 'continuity' AS c, count(*) AS k FROM ci WHERE issue IS NOT NULL GROUP BY 1 UNION ALL SELECT episode, 'source_integrity', count(*) FROM si GROUP BY 1),
r AS (SELECT episode, CAST(sum(k) AS BIGINT) AS n, list_sort(list(c)) AS f FROM f GROUP BY 1), ep AS (SELECT DISTINCT episode FROM cues)
SELECT ep.episode, coalesce(n, 0) AS issues, coalesce(f, CAST([] AS VARCHAR[])) AS failed, n IS NULL AS passed FROM ep LEFT JOIN r ON ep.episode IS NOT DISTINCT FROM r.episode
"""
)
def q_checks_rollup(spark: SparkSession, d: str) -> DataFrame:
    return R.rollup({"continuity": _continuity(spark, d), "source_integrity": _integrity(spark, d)}, KEYS, cues(spark, d))
