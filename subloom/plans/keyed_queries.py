"""Queries over keys, votes, samples and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subloom.operators import keyed as K
from subloom.operators import roles as R
from subloom.operators import voices as V
from subloom.plans.cue_queries import CUES, cues
from subloom.plans.registry import query
from subloom.session import present, table


@query("""
WITH e AS (SELECT DISTINCT episode, source_index FROM cue_labels), g AS (SELECT episode, source_index, count(*) AS n FROM script_rows GROUP BY 1, 2)
SELECT episode, source_index, 'missing' AS state FROM e ANTI JOIN g USING (episode, source_index)
UNION ALL SELECT episode, source_index, 'unknown' FROM g ANTI JOIN e USING (episode, source_index)
UNION ALL SELECT episode, source_index, 'duplicate' FROM g WHERE n > 1
""")
def q_coverage(spark: SparkSession, d: str) -> DataFrame:
    return K.coverage(table(spark, d, "cue_labels"), table(spark, d, "script_rows"), ["episode", "source_index"])


@query("SELECT episode, source_index, count(*) AS n FROM cue_labels GROUP BY 1, 2 HAVING count(*) > 1")
def q_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return K.duplicates(table(spark, d, "cue_labels"), ["episode", "source_index"])


@query("SELECT * FROM (SELECT episode, source_index, cue_id, role, text FROM (SELECT *, row_number() OVER (PARTITION BY episode, source_index ORDER BY cue_id) AS n FROM cue_labels) WHERE n = 1)")
def q_first_rows(spark: SparkSession, d: str) -> DataFrame:
    return K.first_rows(table(spark, d, "cue_labels").select("episode", "source_index", "cue_id", "role", "text"), ["episode", "source_index"], "cue_id")


@query(CUES + """, u AS (SELECT episode, source_index, "名前" AS r, "台詞" AS t FROM (SELECT *, row_number() OVER (PARTITION BY episode, source_index ORDER BY script_row_id DESC) AS n FROM script_rows) WHERE n = 1),
j AS (SELECT c.*, u.r, u.t, u.episode IS NOT NULL AS hit FROM cues c LEFT JOIN u ON c.episode = u.episode AND c.source_index = u.source_index)
SELECT episode, source_index, CASE WHEN r <> '' THEN r ELSE role END AS role, CASE WHEN t <> '' THEN t ELSE text END AS text,
  CASE WHEN NOT hit THEN 'kept' WHEN (role <> '' AND r <> '' AND role <> r) OR (text <> '' AND t <> '' AND text <> t) THEN 'conflict' ELSE 'merged' END AS update_state FROM j
""")
def q_update_merge(spark: SparkSession, d: str) -> DataFrame:
    base = cues(spark, d).select("episode", "source_index", "role", "text")
    updates = table(spark, d, "script_rows").select("episode", "source_index", "script_row_id", F.col("名前").alias("role"), F.col("台詞").alias("text"))
    return K.updated(base, updates, ["episode", "source_index"], ["role", "text"], "script_row_id")


@query("""
WITH v AS (SELECT episode, unnest(string_split(source_indices, ',')) AS i, ensemble_status, ensemble_candidate, ens_id FROM voice_ensemble WHERE trim(source_indices) <> ''),
e AS (SELECT episode, TRY_CAST(trim(i) AS INTEGER) AS source_index, min(struct_pack(ens_id := ens_id, s := ensemble_status, c := ensemble_candidate)) AS x FROM v GROUP BY 1, 2),
j AS (SELECT c.cue_id, c.anonymous_speaker, c.diarization_status, c.role, x.s, x.c, e.x IS NULL AS absent FROM cue_labels c LEFT JOIN e ON c.episode = e.episode AND c.source_index = e.source_index)
SELECT cue_id, CASE WHEN trim(anonymous_speaker) = '' OR anonymous_speaker IS NULL THEN 'no_speaker' WHEN diarization_status <> 'single_speaker' THEN 'not_single' WHEN absent THEN 'no_vote'
  WHEN s = 'model_disagreement' OR s = 'insufficient_models' THEN 'no_consensus' WHEN c <> role THEN 'other_role' END AS pending_reason FROM j
""")
def q_pending_reasons(spark: SparkSession, d: str) -> DataFrame:
    votes = table(spark, d, "voice_ensemble").where("trim(source_indices) <> ''")
    each = votes.select("episode", F.explode(F.split("source_indices", ",")).alias("i"), "ens_id", F.col("ensemble_status").alias("s"), F.col("ensemble_candidate").alias("c"))
    one = each.select("episode", F.trim("i").try_cast("int").alias("source_index"), "ens_id", "s", "c").groupBy("episode", "source_index").agg(F.min(F.struct("ens_id", "s", "c")).alias("x"))
    rows = table(spark, d, "cue_labels").join(one, ["episode", "source_index"], "left")
    reason = K.first_reason(
        (~present(F.col("anonymous_speaker")), "no_speaker"),
        (F.col("diarization_status") != "single_speaker", "not_single"),
        (F.col("x").isNull(), "no_vote"),
        (F.col("x.s").isin("model_disagreement", "insufficient_models"), "no_consensus"),
        (F.col("x.c") != F.col("role"), "other_role"),
    )
    return rows.select("cue_id", reason.alias("pending_reason"))


@query("""
WITH r AS (SELECT cue_id, [CASE WHEN role IS NULL OR trim(role) = '' THEN 'no_role' END, CASE WHEN text IS NULL OR trim(text) = '' THEN 'no_text' END,
  CASE WHEN confidence < 0 OR confidence > 1 OR isnan(confidence) OR confidence IS NULL THEN 'confidence_range' END, CASE WHEN confidence < 0.85 AND status = 'ok' THEN 'ok_below_confidence' END,
  CASE WHEN "start" IS NULL OR "end" IS NULL THEN 'no_bounds' WHEN "end" <= "start" THEN 'bounds_order' END, CASE WHEN status IS NULL OR status NOT IN ('ok', 'manual', 'review') THEN 'status_domain' END] AS x FROM cue_labels)
SELECT cue_id, unnest(list_filter(x, lambda y: y IS NOT NULL)) AS issue FROM r
""")
def q_label_issues(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    issues = K.all_reasons(
        (~present(c("role")), "no_role"),
        (~present(c("text")), "no_text"),
        (c("confidence").isNull() | F.isnan("confidence") | (c("confidence") < 0) | (c("confidence") > 1), "confidence_range"),
        ((c("confidence") < 0.85) & (c("status") == "ok"), "ok_below_confidence"),
        (c("start").isNull() | c("end").isNull(), "no_bounds"),
        (c("end") <= c("start"), "bounds_order"),
        (c("status").isNull() | ~c("status").isin("ok", "manual", "review"), "status_domain"),
    )
    return table(spark, d, "cue_labels").select("cue_id", F.explode(issues).alias("issue"))


@query(CUES + """, s AS (SELECT episode, source_index, "名前" AS r, "台詞" AS t FROM (SELECT *, row_number() OVER (PARTITION BY episode, source_index ORDER BY script_row_id) AS n FROM script_rows) WHERE n = 1),
a AS (SELECT episode, row_number() OVER (PARTITION BY episode ORDER BY source_index) AS place, coalesce(role, '') AS r, coalesce(text, '') AS t FROM cues),
b AS (SELECT episode, row_number() OVER (PARTITION BY episode ORDER BY source_index) AS place, coalesce(r, '') AS r, coalesce(t, '') AS t FROM s),
j AS (SELECT coalesce(a.episode, b.episode) AS episode, coalesce(a.place, b.place) AS place, a.r AS ar, a.t AS tt, b.r AS br, b.t AS bt FROM a FULL JOIN b ON a.episode = b.episode AND a.place = b.place)
SELECT episode, place, 'only_left' AS difference FROM j WHERE br IS NULL UNION ALL SELECT episode, place, 'only_right' FROM j WHERE ar IS NULL
UNION ALL SELECT episode, place, 'role' FROM j WHERE ar <> br UNION ALL SELECT episode, place, 'text' FROM j WHERE tt <> bt
""")
def q_by_place(spark: SparkSession, d: str) -> DataFrame:
    script = K.first_rows(table(spark, d, "script_rows").select("episode", "source_index", "script_row_id", "名前", "台詞"), ["episode", "source_index"], "script_row_id")
    return K.by_place(cues(spark, d), script, ["episode"], "source_index", "source_index", {"role": ("role", "名前"), "text": ("text", "台詞")})


@query(CUES + "SELECT episode, anonymous_speaker AS value, count(DISTINCT role) AS n FROM cues WHERE anonymous_speaker <> '' AND role <> '' GROUP BY 1, 2 HAVING count(DISTINCT role) > 1")
def q_dependency_breaks(spark: SparkSession, d: str) -> DataFrame:
    return K.dependency_breaks(cues(spark, d), ["episode"], "anonymous_speaker", "role")


@query(CUES + """, c AS (SELECT episode, text, count(*) AS n FROM cues WHERE text <> '' GROUP BY 1, 2), r AS (SELECT *, CAST(sum(n) OVER (PARTITION BY episode) AS BIGINT) AS total, row_number() OVER (PARTITION BY episode ORDER BY n DESC, text) AS k FROM c)
SELECT episode, text AS value, n, total FROM r WHERE k = 1 AND n >= 2 AND total >= 5 AND n >= 0.05 * total
""")
def q_modal_text(spark: SparkSession, d: str) -> DataFrame:
    return K.modal(cues(spark, d), ["episode"], "text", least=2, share=0.05)


@query(CUES + """, h AS (SELECT episode, anonymous_speaker, source_index, ('0x' || substr(sha1(episode || '|' || CAST(source_index AS VARCHAR)), 1, 15))::BIGINT AS p FROM cues WHERE anonymous_speaker IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY episode, anonymous_speaker ORDER BY p) AS k, count(*) OVER (PARTITION BY episode, anonymous_speaker) AS n FROM h)
SELECT episode, anonymous_speaker, source_index FROM r WHERE k <= greatest(1, ceil(n * 0.2))
""")
def q_stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    rows = cues(spark, d).where("anonymous_speaker is not null").select("episode", "anonymous_speaker", "source_index")
    return K.drawn_by_hash(rows, ["episode", "anonymous_speaker"], ["episode", "source_index"], 0.2)


@query("SELECT status, count(*) AS n, count(DISTINCT episode) AS episodes FROM cue_labels GROUP BY 1")
def q_status_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "cue_labels").groupBy("status").agg(F.count("*").alias("n"), F.count_distinct("episode").alias("episodes"))


@query("""
SELECT episode, bool_and(status IN ('ok', 'manual')) AS all_settled, bool_or(status = 'review') AS any_review, count(*) AS cues, count(*) FILTER (status = 'review') AS review, count(DISTINCT role) AS roles,
  list_sort(list(DISTINCT status) FILTER (status IS NOT NULL)) AS statuses FROM cue_labels GROUP BY 1
""")
def q_episode_rollup(spark: SparkSession, d: str) -> DataFrame:
    settled = F.col("status").isin("ok", "manual")
    return table(spark, d, "cue_labels").groupBy("episode").agg(
        F.every(settled).alias("all_settled"),
        F.some(F.col("status") == "review").alias("any_review"),
        F.count("*").alias("cues"),
        F.count_if(F.col("status") == "review").alias("review"),
        F.count_distinct("role").alias("roles"),
        F.array_sort(F.collect_set("status")).alias("statuses"),
    )


@query("""
SELECT role, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'manual') AS manual, count(*) FILTER (status = 'review') AS review, count(*) FILTER (status IN ('ok', 'manual', 'review')) AS total
FROM cue_labels WHERE role IS NOT NULL GROUP BY 1
""")
def q_role_by_status(spark: SparkSession, d: str) -> DataFrame:
    return R.crossed(table(spark, d, "cue_labels"), "role", "status", ["ok", "manual", "review"])


@query("SELECT role, list_sort(list(DISTINCT episode)) AS episodes, count(DISTINCT episode) AS n_episodes, count(*) AS cues, min(episode) AS first_episode FROM cue_labels WHERE role <> '' GROUP BY 1")
def q_cast(spark: SparkSession, d: str) -> DataFrame:
    return R.cast_by_episode(table(spark, d, "cue_labels"), "role", "episode")


@query("""
WITH f AS (SELECT episode, role, min(source_index) AS "first" FROM cue_labels WHERE role <> '' GROUP BY 1, 2)
SELECT episode, role, "first", CAST(row_number() OVER (PARTITION BY episode ORDER BY "first", role) AS INTEGER) AS place FROM f
""")
def q_first_seen(spark: SparkSession, d: str) -> DataFrame:
    return R.first_seen(table(spark, d, "cue_labels"), ["episode"], "role", "source_index")


@query("""
WITH p AS (SELECT DISTINCT role, trim(role) AS n, list_filter(regexp_split_to_array(trim(role), '[ ・·\\x{3000}]+'), lambda x: x <> '') AS p FROM role_catalog),
a AS (SELECT DISTINCT role, unnest([n, p[1], p[-1]]) AS alias FROM p)
SELECT alias, min(role) AS role FROM a WHERE length(alias) >= 3 GROUP BY 1 HAVING count(*) = 1
""")
def q_aliases(spark: SparkSession, d: str) -> DataFrame:
    return R.aliases(table(spark, d, "role_catalog"), "role")


def _votes():
    kind = "map<string, struct<status: string, candidate: string>>"
    sound = F.filter(F.map_entries(F.from_json("model_candidates_json", kind)), lambda e: (e["value"]["status"] == "eligible") & present(e["value"]["candidate"]))
    return F.coalesce(F.transform(sound, lambda e: F.struct(e["key"].alias("model"), e["value"]["candidate"].alias("label"))), F.array())


@query("""
WITH m AS (SELECT ens_id, unnest(json_keys(model_candidates_json)) AS k, model_candidates_json AS j FROM voice_ensemble WHERE model_candidates_json IS NOT NULL),
v AS (SELECT ens_id, json_extract_string(j, '$."' || k || '".candidate') AS c FROM m WHERE json_extract_string(j, '$."' || k || '".status') = 'eligible'),
c AS (SELECT ens_id, c, count(*) AS n FROM v WHERE trim(c) <> '' GROUP BY 1, 2), r AS (SELECT *, sum(n) OVER (PARTITION BY ens_id) AS total, row_number() OVER (PARTITION BY ens_id ORDER BY n DESC, c) AS k FROM c)
SELECT e.ens_id, r.c AS label, CAST(coalesce(n, 0) AS INTEGER) AS n, CAST(coalesce(total, 0) AS INTEGER) AS total, CASE WHEN coalesce(total, 0) < 2 THEN 'insufficient' WHEN n = total THEN 'all' WHEN 2 * n > total THEN 'most' ELSE 'disagreement' END AS state
FROM voice_ensemble e LEFT JOIN r ON e.ens_id = r.ens_id AND r.k = 1
""")
def q_plain_votes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "voice_ensemble").select("ens_id", R.plain_votes(_votes()).alias("v")).select("ens_id", "v.label", "v.n", "v.total", "v.state")


_UNITS = """
WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings WHERE embedding IS NOT NULL),
u AS (SELECT vec_id, label, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM e WHERE list_dot_product(v, v) > 0),
d AS (SELECT label, unnest(u) AS x, generate_subscripts(u, 1) AS i FROM u), s AS (SELECT label, i, sum(x) AS x, count(*) AS n FROM d GROUP BY 1, 2),
t AS (SELECT label, list(x ORDER BY i) AS t, max(n) AS n FROM s GROUP BY 1), c AS (SELECT label, t, n, list_transform(t, lambda x: x / sqrt(list_dot_product(t, t))) AS c FROM t)
"""


@query(_UNITS + "SELECT label, list_transform(c, lambda x: round(x, 6)) AS centroid, n FROM c")
def q_centroids(spark: SparkSession, d: str) -> DataFrame:
    rows = V.centroids(table(spark, d, "embeddings"), "label", "embedding")
    return rows.select("label", F.transform("centroid", lambda x: F.round(x, 6)).alias("centroid"), "n")


_RANKED = _UNITS + """, k AS (SELECT u.vec_id, u.label AS own, c.label, round(list_dot_product(u.u, c.c), 9) AS s FROM u, c),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, label) AS k FROM k), b AS (SELECT a.vec_id, a.own, a.label AS candidate, a.s AS similarity, z.label AS "second", z.s AS second_similarity FROM r a JOIN r z ON a.vec_id = z.vec_id AND a.k = 1 AND z.k = 2)
"""


@query(_RANKED + 'SELECT vec_id, candidate, round(similarity, 6) AS similarity, "second", round(second_similarity, 6) AS second_similarity, round(similarity - second_similarity, 6) AS margin FROM b')
def q_top_two(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    rows = V.similarities(e, ["vec_id"], "embedding", V.centroids(e, "label", "embedding"), "label")
    return rows.select("vec_id", "candidate", F.round("similarity", 6).alias("similarity"), "second", F.round("second_similarity", 6).alias("second_similarity"), F.round("margin", 6).alias("margin"))


_LEFT_OUT = _RANKED + """, w AS (SELECT u.vec_id, u.label, n, u.u, list_transform(list_zip(c.t, u.u), lambda z: z[1] - z[2]) AS rest FROM u JOIN c ON u.label = c.label),
o AS (SELECT vec_id, label, CASE WHEN n > 1 THEN round(list_dot_product(rest, u) / sqrt(list_dot_product(rest, rest)), 9) END AS own FROM w),
l AS (SELECT o.vec_id, o.label, o.own, CASE WHEN b.candidate <> o.label THEN b.similarity ELSE b.second_similarity END AS impostor FROM o JOIN b USING (vec_id))
"""


@query(_LEFT_OUT + "SELECT vec_id, label, round(own, 6) AS own, round(impostor, 6) AS impostor, round(own - impostor, 6) AS margin FROM l")
def q_leave_one_out(spark: SparkSession, d: str) -> DataFrame:
    rows = V.left_out(table(spark, d, "embeddings"), ["vec_id"], "label", "embedding")
    return rows.select("vec_id", "label", *[F.round(c, 6).alias(c) for c in ("own", "impostor", "margin")])


@query(_LEFT_OUT + """, g AS (SELECT label, count(*) AS clips, quantile_cont(own, 0.1) AS g, quantile_cont(impostor, 0.95) + 0.03 AS f, quantile_cont(own - impostor, 0.1) AS m FROM l WHERE own IS NOT NULL GROUP BY 1)
SELECT label, clips, round(greatest(g, f), 6) AS similarity_threshold, round(least(greatest(m, 0.08), 0.25), 6) AS margin_threshold, g < f AS confusable FROM g
""")
def q_thresholds(spark: SparkSession, d: str) -> DataFrame:
    rows = V.thresholds(V.left_out(table(spark, d, "embeddings"), ["vec_id"], "label", "embedding"), "label")
    return rows.select("label", "clips", F.round("similarity_threshold", 6).alias("similarity_threshold"), F.round("margin_threshold", 6).alias("margin_threshold"), "confusable")


@query("""
WITH e AS (SELECT label, 1 + vec_id % 3 AS w, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings WHERE embedding IS NOT NULL), u AS (SELECT label, w, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM e),
d AS (SELECT label, w, unnest(u) AS x, generate_subscripts(u, 1) AS i FROM u), s AS (SELECT label, i, sum(x * w) AS x, count(*) AS n, CAST(sum(w) AS DOUBLE) AS w FROM d GROUP BY 1, 2),
t AS (SELECT label, list(x ORDER BY i) AS t, max(n) AS n, max(w) AS w FROM s GROUP BY 1) SELECT label, list_transform(t, lambda x: round(x / sqrt(list_dot_product(t, t)), 6)) AS centroid, n, w AS weight FROM t WHERE w >= 3
""")
def q_weighted_clusters(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").withColumn("seconds", (1 + F.col("vec_id") % 3).cast("double"))
    out = V.weighted_clusters(rows, ["label"], "embedding", "seconds", 3.0)
    return out.select("label", F.transform("centroid", lambda x: F.round(x, 6)).alias("centroid"), "n", "weight")


@query()
def q_average_linkage(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").withColumn("scope", F.col("label").cast("string"))
    return V.clustered(rows, "scope", "vec_id", "embedding", 0.3)


@query("""
WITH x AS (SELECT event_type, abs(value) / 100 AS x FROM events WHERE value IS NOT NULL)
SELECT event_type, count(*) AS samples, round(sqrt(avg(x * x)), 9) AS rms, max(x) AS peak, round(avg(CASE WHEN x >= 0.999 THEN 1.0 ELSE 0.0 END), 9) AS clipping_ratio, round(avg(CASE WHEN x < 0.0001 THEN 1.0 ELSE 0.0 END), 9) AS silence_ratio FROM x GROUP BY 1
""")
def q_levels(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("event_type", (F.col("value") / 100).alias("x"))
    out = K.levels(rows, ["event_type"], "x")
    return out.select("event_type", "samples", "peak", *[F.round(c, 9).alias(c) for c in ("rms", "clipping_ratio", "silence_ratio")])


@query("SELECT cue_id, c.episode, role FROM cue_labels c WHERE NOT EXISTS (SELECT 1 FROM voice_ensemble v WHERE v.episode IS NOT DISTINCT FROM c.episode AND v.ensemble_candidate IS NOT DISTINCT FROM c.role)")
def q_disjoint_keys(spark: SparkSession, d: str) -> DataFrame:
    taken = table(spark, d, "voice_ensemble").select("episode", F.col("ensemble_candidate").alias("role"))
    return K.disjoint_keys(table(spark, d, "cue_labels").select("cue_id", "episode", "role"), taken, ["episode", "role"])


@query("""
WITH e AS (SELECT episode, 'labels' AS p FROM cue_labels UNION SELECT episode, 'script' FROM script_rows UNION SELECT episode, 'turns' FROM speaker_turns),
g AS (SELECT episode, bool_or(p = 'labels') AS in_labels, bool_or(p = 'script') AS in_script, bool_or(p = 'turns') AS in_turns FROM e GROUP BY 1)
SELECT *, list_filter([CASE WHEN NOT in_labels THEN 'labels' END, CASE WHEN NOT in_script THEN 'script' END, CASE WHEN NOT in_turns THEN 'turns' END], lambda x: x IS NOT NULL) AS absent FROM g
""")
def q_by_episode(spark: SparkSession, d: str) -> DataFrame:
    return K.by_episode({"labels": table(spark, d, "cue_labels"), "script": table(spark, d, "script_rows"), "turns": table(spark, d, "speaker_turns")}, ["episode"])


@query("""
WITH a AS (SELECT cue_id AS k, episode, source_index, text, 'labels' AS plan FROM cue_labels UNION ALL SELECT script_row_id, episode, source_index, "台詞", 'script' FROM script_rows),
n AS (SELECT *, count(*) OVER (PARTITION BY k) AS nk, count(*) OVER (PARTITION BY episode, source_index, text) AS ns FROM a)
SELECT k, plan, nk > 1 OR (ns > 1 AND (episode IS NOT NULL OR source_index IS NOT NULL OR text IS NOT NULL)) AS duplicate FROM n
""")
def q_merged_plans(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "cue_labels").select(F.col("cue_id").alias("k"), "episode", "source_index", "text")
    script = table(spark, d, "script_rows").select(F.col("script_row_id").alias("k"), "episode", "source_index", F.col("台詞").alias("text"))
    return K.merged_plans({"labels": labels, "script": script}, "k", ["episode", "source_index", "text"]).select("k", "plan", "duplicate")
