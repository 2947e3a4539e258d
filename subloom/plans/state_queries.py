"""Queries on names and states of series of jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subloom.functions import texts as T
from subloom.functions import timecodes as C
from subloom.operators import evidence as E
from subloom.operators import states as S
from subloom.plans.cue_queries import CUES, cues
from subloom.plans.registry import query
from subloom.sources import catalogs as N
from subloom.session import table


@query("SELECT turn_id, episode, trim(speaker) AS speaker, CAST(round(start_seconds * 1000) AS BIGINT) AS start_ms, CAST(round(end_seconds * 1000) AS BIGINT) AS end_ms FROM speaker_turns WHERE trim(speaker) <> '' AND round(end_seconds * 1000) > round(start_seconds * 1000)")
def q_turn_rows(spark: SparkSession, d: str) -> DataFrame:
    return N.turn_rows(table(spark, d, "speaker_turns").where("start_seconds >= 0"), ("turn_id", "episode"))


@query("SELECT min(role) AS role FROM role_catalog WHERE trim(role) <> '' GROUP BY role_id")
def q_role_list(spark: SparkSession, d: str) -> DataFrame:
    known, several = N.role_names(table(spark, d, "role_catalog"), "role")
    return known.select("role").unionByName(several.select(F.explode("roles").alias("role")))


@query("""
WITH g AS (SELECT episode, count(*) AS n, max(CASE WHEN trim(coalesce(speaker, '')) = '' THEN 1 ELSE 0 END) AS a, max(CASE WHEN trim(coalesce(start_timecode, '')) = '' THEN 1 ELSE 0 END) AS b FROM speaker_turns GROUP BY 1)
SELECT episode, unnest(list_filter([CASE WHEN NOT coalesce(regexp_full_match(episode, '[0-9]{4}'), false) THEN 'not_four_digits' END, CASE WHEN n > 1 THEN 'duplicate' END, CASE WHEN a = 1 THEN 'missing_speaker' END, CASE WHEN b = 1 THEN 'missing_start_timecode' END], lambda x: x IS NOT NULL)) AS fault FROM g
""")
def q_manifest_faults(spark: SparkSession, d: str) -> DataFrame:
    return N.manifest_faults(table(spark, d, "speaker_turns"), "episode", ["speaker", "start_timecode"])


@query("SELECT CAST(cue_id AS VARCHAR) AS cue_id FROM cue_labels UNION ALL SELECT CAST(source_index AS VARCHAR) FROM script_rows WHERE source_index IS NOT NULL")
def q_cue_ids(spark: SparkSession, d: str) -> DataFrame:
    return N.cue_ids(table(spark, d, "cue_labels")).unionByName(N.cue_ids(table(spark, d, "script_rows")))




@query(CUES + """, a AS (SELECT episode, list(coalesce('=' || text, '') ORDER BY source_index) AS d FROM cues GROUP BY 1),
b AS (SELECT episode, list(coalesce('=' || "台詞", '') ORDER BY source_index) AS d FROM (SELECT *, row_number() OVER (PARTITION BY episode, source_index ORDER BY script_row_id) AS n FROM script_rows) WHERE n = 1 GROUP BY 1)
SELECT coalesce(a.episode, b.episode) AS episode, CASE WHEN a.d IS NULL THEN 'gone' WHEN b.d IS NULL THEN 'new' WHEN a.d = b.d THEN 'fresh' ELSE 'stale' END AS state FROM a FULL JOIN b ON a.episode = b.episode
""")
def q_staleness(spark: SparkSession, d: str) -> DataFrame:
    from subloom.operators.keyed import first_rows

    script = first_rows(table(spark, d, "script_rows").select("episode", "source_index", "script_row_id", F.col("台詞").alias("text")), ["episode", "source_index"], "script_row_id")
    return S.staleness(E.digests(script, ["episode"], "source_index", ["text"]), E.digests(cues(spark, d), ["episode"], "source_index", ["text"]), ["episode"], "digest")


@query("""
WITH l AS (SELECT episode, status, row_number() OVER (PARTITION BY episode ORDER BY cue_id DESC) AS n FROM cue_labels), e AS (SELECT DISTINCT episode FROM speaker_turns)
SELECT e.episode FROM e LEFT JOIN l ON e.episode = l.episode AND l.n = 1 WHERE NOT coalesce(l.status IN ('ok', 'manual'), false)
""")
def q_to_do(spark: SparkSession, d: str) -> DataFrame:
    jobs, progress = table(spark, d, "speaker_turns").select("episode").distinct(), table(spark, d, "cue_labels").select("episode", "cue_id", "status")
    return S.to_do(jobs, progress, ["episode"], "cue_id", F.col("status").isin("ok", "manual"))


@query(CUES + """, s AS (SELECT episode, source_index, "名前" AS r FROM (SELECT *, row_number() OVER (PARTITION BY episode, source_index ORDER BY script_row_id) AS n FROM script_rows) WHERE n = 1),
x AS (SELECT coalesce(c.episode, s.episode) AS episode, bool_or(c.episode IS NULL OR s.episode IS NULL OR coalesce(role, '') <> coalesce(r, '')) AS ch FROM cues c FULL JOIN s ON c.episode = s.episode AND c.source_index = s.source_index GROUP BY 1)
SELECT c.episode, source_index, CASE WHEN NOT ch THEN text END AS text, ch AS changed FROM cues c JOIN x ON c.episode = x.episode
""")
def q_invalidated(spark: SparkSession, d: str) -> DataFrame:
    from subloom.operators.keyed import first_rows

    before = first_rows(table(spark, d, "script_rows").select("episode", "source_index", "script_row_id", F.col("名前").alias("role")), ["episode", "source_index"], "script_row_id")
    out = S.invalidated(cues(spark, d).select("episode", "source_index", "role", "text"), before, ["episode"], ["source_index"], ["role"], ["text"])
    return out.select("episode", "source_index", "text", "changed")


@query("""
WITH m AS (SELECT user_id, event_type, avg(value - 50) AS m FROM events WHERE value IS NOT NULL AND event_type IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY m DESC, event_type) AS k, count(*) FILTER (m >= 0) OVER (PARTITION BY user_id) AS p FROM m)
SELECT a.user_id, a.event_type, round(a.m, 6) AS score, b.event_type AS "second", CASE WHEN a.p = 0 THEN 'no_positive_track' WHEN a.p > 1 THEN 'several_positive_tracks' ELSE 'single_positive_track' END AS state
FROM r a LEFT JOIN r b ON a.user_id = b.user_id AND b.k = 2 WHERE a.k = 1
""")
def q_top_tracks(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("user_id", "event_type", (F.col("value") - 50).alias("score"))
    return S.top_tracks(rows, ["user_id"], "event_type", "score").select("user_id", "event_type", F.round("score", 6).alias("score"), "second", "state")


@query(CUES + """, g AS (SELECT episode, semantic_unit, count(*) AS rows, count(*) FILTER (trim(anonymous_speaker) <> '') AS voted, first(anonymous_speaker ORDER BY source_index) AS first_vote FROM cues GROUP BY 1, 2)
SELECT *, voted / rows AS share FROM g""")
def q_unit_votes(spark: SparkSession, d: str) -> DataFrame:
    return S.unit_votes(cues(spark, d), ["episode", "semantic_unit"], "source_index", "anonymous_speaker")


@query()
def q_classified(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "cue_labels").select("cue_id", "role", "confidence")
    return S.classified(rows, "role", "confidence", table(spark, d, "role_catalog").select("role")).select("cue_id", "known_role", "state")


@query(r"""SELECT cue_id, coalesce(trim(role), 'REVIEW') AS role, coalesce(confidence, 0.0) AS confidence FROM cue_labels WHERE role IS NULL OR NOT regexp_matches(role, '[\x{3000}\x{A0}\x{200B}-\x{200F}\x{FEFF}\x{2000}-\x{200A}\x{202F}\x{205F}]')""")
def q_parsed_answers(spark: SparkSession, d: str) -> DataFrame:
    plain = table(spark, d, "cue_labels").where(F.col("role").isNull() | ~F.col("role").rlike(r"[\x{3000}\x{A0}\x{200B}-\x{200F}\x{FEFF}\x{2000}-\x{200A}\x{202F}\x{205F}]"))
    text = F.concat(F.lit("{not one} Answer: "), F.to_json(F.struct("role", "confidence")), F.lit(" {}"))
    return plain.select("cue_id", E.answers(text).alias("a")).select("cue_id", "a.role", "a.confidence")


@query("""
WITH g AS (SELECT turn_id, start_timecode AS a, end_timecode AS z, regexp_full_match(start_timecode, '[0-9]+:[0-9]{2}:[0-9]{2},[0-9]{3}') AS s, regexp_full_match(start_timecode, '[0-9]{1,2}:[0-9]{2}:[0-9]{2},[0-9]{3}') AND regexp_full_match(end_timecode, '[0-9]{1,2}:[0-9]{2}:[0-9]{2},[0-9]{3}') AS b FROM speaker_turns),
n AS (SELECT *, string_split(replace(a, ',', '.'), ':') AS p, string_split(replace(z, ',', '.'), ':') AS q FROM g)
SELECT turn_id, CASE WHEN s THEN CAST(round((CAST(p[1] AS DOUBLE) * 3600 + CAST(p[2] AS DOUBLE) * 60 + CAST(p[3] AS DOUBLE)) * 1000) AS BIGINT) END AS clock_ms,
CASE WHEN b THEN greatest(0, CAST(round((CAST(q[1] AS DOUBLE) * 3600 + CAST(q[2] AS DOUBLE) * 60 + CAST(q[3] AS DOUBLE)) * 1000) AS BIGINT) - CAST(round((CAST(p[1] AS DOUBLE) * 3600 + CAST(p[2] AS DOUBLE) * 60 + CAST(p[3] AS DOUBLE)) * 1000) AS BIGINT)) END AS length_ms FROM n
""")
def q_clock_and_length(spark: SparkSession, d: str) -> DataFrame:
    both = F.concat(F.col("start_timecode"), F.lit(" --> "), F.col("end_timecode"))
    return table(spark, d, "speaker_turns").select("turn_id", F.round(C.clock_seconds(F.col("start_timecode")) * 1000).cast("bigint").alias("clock_ms"), C.range_ms(both).alias("length_ms"))


@query("""
SELECT cue_id, CASE WHEN lower(trim(status)) IN ('1', 'true', 'yes', 'y', 'verified') THEN true WHEN trim(status) <> '' THEN false END AS truth, CASE WHEN source_index IS NOT NULL THEN [lpad(CAST(source_index AS VARCHAR), greatest(4, length(CAST(source_index AS VARCHAR)))::INTEGER, '0')] END AS episodes,
round(20 * log10(greatest(confidence, 1e-12)), 6) AS level FROM cue_labels
""")
def q_flags_and_levels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "cue_labels").select("cue_id", T.truth(F.col("status")).alias("truth"), T.episode_numbers(F.col("source_index").cast("string")).alias("episodes"), F.round(T.dbfs(F.col("confidence")), 6).alias("level"))


@query("""
WITH m AS (SELECT user_id, event_type, avg(value - 50) AS m FROM events WHERE value IS NOT NULL AND event_type IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY m DESC, event_type) AS k, count(*) FILTER (m >= 0) OVER (PARTITION BY user_id) AS p FROM m),
n AS (SELECT role_id, role FROM role_catalog), e AS (SELECT DISTINCT event_type FROM events), t AS (SELECT event_type, min(role) AS mapped_role FROM e JOIN n ON role_id % 7 = length(event_type) % 7 GROUP BY 1)
SELECT user_id, r.event_type, mapped_role, CASE WHEN p = 1 THEN mapped_role END AS track_role FROM r LEFT JOIN t ON r.event_type = t.event_type WHERE k = 1
""")
def q_mapped_tracks(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    tracks = S.top_tracks(events.select("user_id", "event_type", (F.col("value") - 50).alias("score")), ["user_id"], "event_type", "score")
    names = table(spark, d, "role_catalog").select((F.col("role_id") % 7).alias("n"), "role")
    roles = events.select("event_type", (F.length("event_type") % 7).alias("n")).distinct().join(F.broadcast(names), "n").select("event_type", "role")  # a fixed table
    return S.mapped_tracks(tracks, "event_type", "state", roles).select("user_id", "event_type", "mapped_role", "track_role")


@query("""
WITH p AS (SELECT list_filter(string_split(frame, '/'), lambda x: x <> '') AS p FROM cue_labels WHERE frame IS NOT NULL), q AS (SELECT p, len(p) - 1 AS k FROM p WHERE len(list_filter(p, lambda x: starts_with(x, '.'))) = 0 AND lower(p[-1]) LIKE '%.jpg' AND len(p) > 1),
e AS (SELECT p, unnest(range(greatest(1, k - 2), k + 1)) AS k FROM q) SELECT array_to_string(p[:k], '/') AS folder, 'image' AS kind, count(*) AS n FROM e GROUP BY 1
""")
def q_counts_by_suffix(spark: SparkSession, d: str) -> DataFrame:
    return S.counts_by_suffix(table(spark, d, "cue_labels"), "frame", {"image": (".jpg", ".jpeg", ".png")})


@query(r"""
WITH f AS (SELECT DISTINCT file_name FROM raw_turn_lines WHERE file_name IS NOT NULL), e AS (SELECT DISTINCT episode FROM cue_labels WHERE TRY_CAST(episode AS INTEGER) IS NOT NULL),
n AS (SELECT file_name, unnest(list_distinct(regexp_extract_all(file_name || ' ', '(?:^|[\s_\[(-]|ep|EP)0?([0-9]{1,9})[^0-9]', 1))) AS x FROM f)
SELECT DISTINCT file_name, episode FROM n JOIN e ON TRY_CAST(x AS INTEGER) = TRY_CAST(episode AS INTEGER)
""")
def q_files_of_episodes(spark: SparkSession, d: str) -> DataFrame:
    return S.files_of_episodes(table(spark, d, "raw_turn_lines").select("file_name"), "file_name", table(spark, d, "cue_labels"), "episode")


@query("""
WITH l AS (SELECT ens_id, list_filter(list_transform(string_split(coalesce(source_indices, ''), ','), lambda x: trim(x)), lambda x: x <> '') AS f FROM voice_ensemble),
n AS (SELECT ens_id, CAST(len(f) AS INTEGER) AS frames, CAST(greatest(2 - len(list_distinct(f)), 0) AS INTEGER) AS missing, len(f) > len(list_distinct(f)) AS duplicate FROM l)
SELECT * FROM n WHERE frames <> 2 OR duplicate
""")
def q_frame_gaps(spark: SparkSession, d: str) -> DataFrame:
    return S.frame_gaps(table(spark, d, "voice_ensemble"), ["ens_id"], "source_indices", 2)


@query(CUES + """, n AS (SELECT episode, anonymous_speaker, source_index, row_number() OVER (PARTITION BY episode, anonymous_speaker ORDER BY source_index) AS n FROM cues)
SELECT episode, anonymous_speaker, list(source_index ORDER BY source_index) FILTER (n <= 12) AS "first", count(*) AS rows FROM n GROUP BY 1, 2""")
def q_leading(spark: SparkSession, d: str) -> DataFrame:
    out = S.leading(cues(spark, d), ["episode", "anonymous_speaker"], "source_index", ["source_index"], 12)
    return out.withColumn("first", F.transform("first", lambda x: x["source_index"]))


@query(CUES + """, e AS (SELECT episode, source_index, lag(source_index) OVER (PARTITION BY episode ORDER BY source_index) AS p, text FROM cues)
SELECT episode, count(*) AS entries, min(source_index) AS first_index, max(source_index) AS last_index, count(*) FILTER (source_index <> p + 1) AS breaks, count(*) FILTER (trim(coalesce(text, '')) = '') AS empty,
CASE WHEN count(*) FILTER (trim(coalesce(text, '')) = '') > 0 THEN 'review' ELSE 'ok' END AS state FROM e GROUP BY 1""")
def q_inspected(spark: SparkSession, d: str) -> DataFrame:
    return S.inspected(cues(spark, d), ["episode"], "source_index", "text")
