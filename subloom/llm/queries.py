"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subloom.llm.consensus import consensus
from subloom.llm.cutoff import rates, scored
from subloom.llm.leaks import leaks
from subloom.llm.lookalike import form_sql, look_like_entries, visual_form
from subloom.llm.mixing import mix, shuffled_shards
from subloom.llm.mojibake import repair
from subloom.llm.nearest import nearest_in_time
from subloom.session import present, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    cues = table(spark, d, "cue_labels").where(F.col("end") > F.col("start"))
    turns = table(spark, d, "speaker_turns").where(F.col("end_seconds") > F.col("start_seconds"))
    return nearest_in_time(cues, turns, [("episode", "episode"), ("anonymous_speaker", "speaker")], "cue_id", "start", "turn_id", "start_seconds", 500)


SQL["p1_found"] = """
WITH c AS (SELECT cue_id, episode, anonymous_speaker AS sp, "start" * 1000 AS x FROM cue_labels
           WHERE "end" > "start" AND trim(anonymous_speaker) <> '' AND trim(episode) <> ''),
t AS (SELECT episode, speaker AS sp, CAST(round(start_seconds * 1000000) AS BIGINT) AS t, min(turn_id) AS turn_id FROM speaker_turns
      WHERE end_seconds > start_seconds AND trim(speaker) <> '' AND trim(episode) <> '' GROUP BY 1, 2, 3),
r AS (SELECT cue_id, turn_id, row_number() OVER (PARTITION BY cue_id ORDER BY abs(x - t), t) AS n
      FROM c JOIN t ON c.episode = t.episode AND c.sp = t.sp AND abs(x - t) <= 500000)
SELECT cue_id, turn_id FROM r WHERE n = 1
"""


@query
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    cues = table(spark, d, "cue_labels")
    roles = look_like_entries(cues, "cue_id", "role", table(spark, d, "role_catalog"), "role_id", "role")
    texts = look_like_entries(cues, "cue_id", "text", table(spark, d, "set_phrases"), "phrase_id", "text")
    return roles.select(F.lit("role").alias("field_name"), "cue_id", F.col("role_id").alias("ref_id")).unionByName(
        texts.select(F.lit("text").alias("field_name"), "cue_id", F.col("phrase_id").alias("ref_id"))
    )


@query
def p3_forms(spark: SparkSession, d: str) -> DataFrame:
    return visual_form(table(spark, d, "cue_labels").select("cue_id", "role", "text"), ["role", "text"])


SQL["p3_forms"] = f"SELECT cue_id, role, text, {form_sql('role')} AS role_form, {form_sql('text')} AS text_form FROM cue_labels"
SQL["p3_found"] = f"""
WITH c AS (SELECT cue_id, role, text, {form_sql('role')} AS rf, {form_sql('text')} AS tf FROM cue_labels)
SELECT 'role' AS field_name, cue_id, role_id AS ref_id FROM c JOIN role_catalog e ON c.rf = {form_sql('e.role')} AND c.role <> e.role
UNION ALL SELECT 'text', cue_id, phrase_id FROM c JOIN set_phrases e ON c.tf = {form_sql('e.text')} AND c.text <> e.text
"""


@query
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return repair(table(spark, d, "cue_labels"), "cue_id", "text").select("cue_id")


@query
def p7_restored(spark: SparkSession, d: str) -> DataFrame:
    return repair(table(spark, d, "cue_labels"), "cue_id", "text")


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text")


@query
def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).where("passage > 0").select("doc_id", "item_id")


@query
def p8_covered(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold half of an item or more, in whatever order its parts stand."""
    return _leaks(spark, d).where(2 * F.col("covered") >= F.col("item_signs")).select("doc_id", "item_id", "covered", "item_signs")


@query
def p8_leaked_items(spark: SparkSession, d: str) -> DataFrame:
    hits = _leaks(spark, d).groupBy("item_id").agg(F.count("*").alias("n_documents"), F.max(F.col("covered") / F.col("item_signs")).alias("most_covered"))
    return table(spark, d, "eval_items").select("item_id", "lang").join(hits, "item_id", "left").na.fill(0, ["n_documents"])


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return scored(table(spark, d, "documents"), "doc_id", "text", "source")


@query
def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).where("is_cut").select("doc_id")


@query
def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    return rates(_scored(spark, d), "source")


def _ensemble(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    kind = "map<string, struct<status: string, candidate: string>>"
    votes = F.transform(
        F.filter(F.map_entries(F.from_json("model_candidates_json", kind)), lambda e: (e["value"]["status"] == "eligible") & present(e["value"]["candidate"])),
        lambda e: F.struct(e["key"].alias("model"), e["value"]["candidate"].alias("label")),
    )
    return consensus(table(spark, d, "voice_ensemble"), "ens_id", votes)


@query
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _ensemble(spark, d)[0].where("n_votes >= 2").select("ens_id", F.col("consensus").alias("consensus_role"))


@query
def p6_agreement(spark: SparkSession, d: str) -> DataFrame:
    return _ensemble(spark, d)[0].withColumnRenamed("consensus", "consensus_role")


@query
def p6_reliability(spark: SparkSession, d: str) -> DataFrame:
    return _ensemble(spark, d)[1]


def _mixed(spark: SparkSession, d: str):
    return mix(table(spark, d, "documents"), "doc_id", "text", "source", table(spark, d, "mix_targets"))


@query
def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d).documents


@query
def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d).shares


@query
def p9_shards(spark: SparkSession, d: str) -> DataFrame:
    return shuffled_shards(_mixed(spark, d))
