"""Queries about the evidence for cues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subloom.functions.timecodes import stamp_ms
from subloom.operators import evidence as E
from subloom.operators import roles as R
from subloom.operators import transcripts as X
from subloom.operators.keyed import first_rows
from subloom.operators.ordered import previous
from subloom.operators.voices import exact_percentiles
from subloom.plans.cue_queries import CUES, TURNS, cues, timed, turns
from subloom.plans.registry import query
from subloom.session import table

MODELS = ["campplus", "ecapa512", "resnet34", "lyra96", "voxmini", "echo_s"]


@query(CUES + """, d AS (SELECT episode, source_index, "start" AS s, greatest("end" - "start", 0) AS n FROM cues WHERE "start" IS NOT NULL AND "end" IS NOT NULL)
SELECT episode, source_index, 'early' AS point, s + CAST(round_even(n * CAST(0.2 AS DOUBLE), 0) AS BIGINT) AS at_ms FROM d UNION ALL SELECT episode, source_index, 'middle', s + CAST(round_even(n * CAST(0.5 AS DOUBLE), 0) AS BIGINT) FROM d
UNION ALL SELECT episode, source_index, 'late', s + CAST(round_even(n * CAST(0.8 AS DOUBLE), 0) AS BIGINT) FROM d
""")
def q_frame_points(spark: SparkSession, d: str) -> DataFrame:
    return E.sample_points(cues(spark, d), ["episode", "source_index"], "start", "end")


@query(CUES + r""", p AS (SELECT *, lag("end") OVER (PARTITION BY episode ORDER BY source_index) AS pe, "end" - "start" AS n, length(regexp_replace(coalesce(text, ''), '[\s\x{3000}。、！？?!…，.,\-"'']', '', 'g')) AS k FROM timed),
q AS (SELECT episode, source_index, "start" - coalesce(pe, 0) AS gap_ms, k * 1000 / n AS density, n FROM p),
r AS (SELECT *, list_filter([CASE WHEN gap_ms > 3000 AND n < 500 THEN 'long_gap' END, CASE WHEN n < 200 THEN 'ultra_short' END, CASE WHEN density > 12 THEN 'high_density' END, CASE WHEN density < 2 AND n > 1500 THEN 'low_density' END], lambda x: x IS NOT NULL) AS reasons FROM q)
SELECT episode, source_index, gap_ms, density, reasons FROM r WHERE len(reasons) > 0
""")
def q_pace(spark: SparkSession, d: str) -> DataFrame:
    return E.pace(timed(spark, d), ["episode"], "source_index", "start", "end", "text")


@query(CUES + r""", s AS (SELECT episode, source_index, "台詞" AS h FROM (SELECT *, row_number() OVER (PARTITION BY episode, source_index ORDER BY script_row_id) AS n FROM script_rows) WHERE n = 1),
j AS (SELECT episode, source_index, regexp_replace(text, '[\s\x{3000}!?！？]', '', 'g') AS x, regexp_replace(h, '[\s\x{3000}!?！？]', '', 'g') AS h FROM cues JOIN s USING (episode, source_index))
SELECT episode, source_index, CASE WHEN x IS NOT NULL AND h IS NOT NULL THEN round(len(list_filter(string_split(x, ''), lambda c: c <> '' AND contains(h, c))) / greatest(length(x), 1), 9) END AS share FROM j
""")
def q_shared_signs(spark: SparkSession, d: str) -> DataFrame:
    from subloom.operators.keyed import first_rows

    script = first_rows(table(spark, d, "script_rows").select("episode", "source_index", "script_row_id", F.col("台詞").alias("heard")), ["episode", "source_index"], "script_row_id")
    both = cues(spark, d).join(script, ["episode", "source_index"])
    return both.select("episode", "source_index", F.round(E.shared_signs(F.col("text"), F.col("heard")), 9).alias("share"))


@query(CUES + TURNS + """, r AS (SELECT episode, speaker, rs, re, max(re) OVER (PARTITION BY episode, speaker ORDER BY rs, re ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM turns),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR rs > reach THEN 1 ELSE 0 END) OVER (PARTITION BY episode, speaker ORDER BY rs, re ROWS UNBOUNDED PRECEDING) AS i FROM r), m AS (SELECT episode, speaker, min(rs) AS s, max(re) AS e FROM i GROUP BY episode, speaker, i),
o AS (SELECT cue_id, sum(least("end", e) - greatest("start", s)) AS o FROM timed t JOIN m ON t.episode = m.episode AND t.anonymous_speaker = m.speaker AND "start" < e AND s < "end" GROUP BY 1)
SELECT t.cue_id, CAST(coalesce(o, 0) AS BIGINT) AS covered_ms, coalesce(o, 0) / ("end" - "start") AS share FROM timed t LEFT JOIN o USING (cue_id) WHERE anonymous_speaker IS NOT NULL
""")
def q_covered_share(spark: SparkSession, d: str) -> DataFrame:
    own = timed(spark, d).where("anonymous_speaker is not null").select("episode", F.col("anonymous_speaker").alias("speaker"), "cue_id", F.col("start").alias("s"), F.col("end").alias("e"))
    return E.covered_share(own, turns(spark, d).select("episode", "speaker", F.col("rs").alias("s"), F.col("re").alias("e")), ["episode", "speaker"], "cue_id")


_INSIDE = CUES + TURNS + """, k AS (SELECT turn_id, min(cue_id) AS cue_id FROM turns t JOIN timed c ON t.episode = c.episode AND c."start" - 100 <= t.rs AND t.re <= c."end" + 100 GROUP BY 1)
"""


def _inside(spark: SparkSession, d: str) -> DataFrame:
    inner = turns(spark, d).withColumnsRenamed({"rs": "s", "re": "e"})
    outer = timed(spark, d).select("episode", "cue_id", F.col("start").alias("rs"), F.col("end").alias("re"))
    return E.contained(inner, outer, ["episode"], 100).groupBy("turn_id").agg(F.min("cue_id").alias("cue_id"))


@query(_INSIDE + "SELECT * FROM k")
def q_contained_turns(spark: SparkSession, d: str) -> DataFrame:
    return _inside(spark, d)


@query(_INSIDE + "SELECT turn_id FROM turns WHERE turn_id NOT IN (SELECT turn_id FROM k)")
def q_uncontained_turns(spark: SparkSession, d: str) -> DataFrame:
    return turns(spark, d).select("turn_id").join(_inside(spark, d), "turn_id", "left_anti")


@query(CUES.replace("WITH", "WITH RECURSIVE", 1) + TURNS + """, x AS (SELECT episode, rs * 2 AS s, re * 2 AS e, speaker AS l, row_number() OVER (PARTITION BY episode ORDER BY rs * 4096 + turn_id % 4096) AS n, count(*) OVER (PARTITION BY episode) AS k FROM turns),
r AS (SELECT DISTINCT episode, 0 AS n, NULL::BIGINT AS k, NULL::BIGINT AS s, NULL::BIGINT AS e, NULL::VARCHAR AS l, NULL::BIGINT AS os, NULL::BIGINT AS oe, NULL::VARCHAR AS ol FROM x
UNION ALL SELECT q.episode, q.n, q.k, CASE WHEN same THEN q.s WHEN meets THEN q.mid ELSE q.xs END, CASE WHEN same THEN greatest(q.e, q.xe) ELSE q.xe END, q.xl, CASE WHEN NOT same THEN q.s END, CASE WHEN NOT same THEN CASE WHEN meets THEN q.mid ELSE q.e END END, CASE WHEN NOT same THEN q.l END FROM
  (SELECT x.episode, x.n::INTEGER AS n, x.k, x.s AS xs, x.e AS xe, x.l AS xl, r.s, r.e, r.l, (x.s + r.e) // 2 AS mid, coalesce(x.s <= r.e, false) AS meets, coalesce(x.s <= r.e AND x.l = r.l, false) AS same FROM r JOIN x ON x.episode = r.episode AND x.n = r.n + 1) q)
SELECT episode, os / 2 AS s, oe / 2 AS e, ol AS speaker FROM r WHERE os IS NOT NULL UNION ALL SELECT episode, s / 2, e / 2, l FROM r WHERE n = k
""")
def q_single_speaker(spark: SparkSession, d: str) -> DataFrame:
    return E.single_speaker(turns(spark, d).withColumn("pos", F.col("rs") * 4096 + F.pmod("turn_id", F.lit(4096))), ["episode"], "pos", "rs", "re", "speaker")


@query("""
WITH t AS (SELECT DISTINCT role AS t FROM role_catalog WHERE role <> ''), d AS (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL),
m AS (SELECT text, t, length(t) AS n FROM d JOIN t ON contains(text, t)), o AS (SELECT text, t, n, unnest(list_filter(range(1, length(text) - n + 2), lambda i: substr(text, i, n) = t)) AS i FROM m),
k AS (SELECT DISTINCT text, t FROM o WHERE NOT EXISTS (SELECT 1 FROM o p WHERE p.text = o.text AND p.n > o.n AND p.i <= o.i AND p.i + p.n >= o.i + o.n))
SELECT doc_id, t AS term FROM documents JOIN k ON documents.text = k.text
""")
def q_role_mentions(spark: SparkSession, d: str) -> DataFrame:
    return E.mentions(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "role_catalog"), "role")


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return R.relations(table(spark, d, "documents"), "title_code", "text")


@query()
def q_relations(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d)


@query()
def q_relation_report(spark: SparkSession, d: str) -> DataFrame:
    return R.relation_report(_edges(spark, d))


@query()
def q_addressed(spark: SparkSession, d: str) -> DataFrame:
    return R.addressed(table(spark, d, "cue_labels"), ["cue_id"], "text", _edges(spark, d), table(spark, d, "role_catalog").select("role"))


@query(CUES + """, d AS (SELECT episode, sha256(CAST(to_json(['=' || role, '=' || text, '=' || CAST("start" AS VARCHAR), '=' || CAST("end" AS VARCHAR)].list_transform(lambda v: coalesce(v, ''))) AS VARCHAR)) AS d,
  row_number() OVER (PARTITION BY episode ORDER BY source_index) AS n FROM cues),
b AS (SELECT episode, (n - 1) // 4096 AS b, sha256(string_agg(d, '' ORDER BY n)) AS d, count(*) AS k FROM d GROUP BY 1, 2)
SELECT episode, CAST(sum(k) AS BIGINT) AS rows, sha256(string_agg(d, '' ORDER BY b)) AS digest FROM b GROUP BY 1
""")
def q_episode_digests(spark: SparkSession, d: str) -> DataFrame:
    return E.digests(cues(spark, d), ["episode"], "source_index", ["role", "text", "start", "end"])


@query("SELECT DISTINCT role FROM cue_labels WHERE role IS NOT NULL EXCEPT SELECT role FROM role_catalog")
def q_unknown_roles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "cue_labels").where("role is not null").select("role").subtract(table(spark, d, "role_catalog").select("role"))


@query('SELECT role FROM cue_labels WHERE role IS NOT NULL INTERSECT SELECT "名前" FROM script_rows')
def q_shared_roles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "cue_labels").where("role is not null").select("role").intersect(table(spark, d, "script_rows").select(F.col("名前").alias("role")))


@query(CUES + """SELECT role, CAST(sum("end" - "start") AS BIGINT) AS spoken_ms, count(*) AS cues, count(DISTINCT episode) AS episodes, sum("end" - "start") >= 8000 AND count(*) >= 3 AS enough FROM timed WHERE role <> '' GROUP BY 1""")
def q_role_durations(spark: SparkSession, d: str) -> DataFrame:
    spoken = F.sum(F.col("end") - F.col("start"))
    return timed(spark, d).where("role <> ''").groupBy("role").agg(
        spoken.alias("spoken_ms"), F.count("*").alias("cues"), F.count_distinct("episode").alias("episodes"), ((spoken >= 8000) & (F.count("*") >= 3)).alias("enough")
    )


@query("""
WITH c AS (SELECT episode, role, count(*) AS n FROM cue_labels WHERE role <> '' GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY n DESC, role) AS k, sum(n) OVER (PARTITION BY episode) AS total FROM c)
SELECT episode, CAST(k AS INTEGER) AS place, role, n, n / total AS share FROM r WHERE k <= 2
""")
def q_top_roles(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    counts = table(spark, d, "cue_labels").where("role <> ''").groupBy("episode", "role").agg(F.count("*").alias("n"))
    # one row per role of an episode
    ranked = counts.withColumn("place", F.row_number().over(Window.partitionBy("episode").orderBy(F.desc("n"), "role"))).withColumn("total", F.sum("n").over(Window.partitionBy("episode")))
    return ranked.where("place <= 2").select("episode", "place", "role", "n", (F.col("n") / F.col("total")).alias("share"))


@query("""
WITH m AS (SELECT event_type, quantile_cont(value, 0.5) AS m FROM events GROUP BY 1) SELECT event_id, e.event_type, round(value - m, 6) AS off FROM events e JOIN m ON e.event_type = m.event_type WHERE abs(value - m) > 40
""")
def q_median_outliers(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select("event_id", "event_type", "value")
    middle = exact_percentiles(events, ["event_type"], {"m": ("value", 0.5)})
    return events.join(middle, "event_type").where(F.abs(F.col("value") - F.col("m")) > 40).select("event_id", "event_type", F.round(F.col("value") - F.col("m"), 6).alias("off"))


@query(
    "WITH m AS (SELECT ens_id, unnest(json_keys(model_candidates_json)) AS k FROM voice_ensemble WHERE model_candidates_json IS NOT NULL) SELECT ens_id, "
    + ", ".join(f"count(*) FILTER (k = '{m}') AS {m}" for m in MODELS)
    + f", count(*) FILTER (k IN ({', '.join(repr(m) for m in MODELS)})) AS total FROM m GROUP BY 1"
)
def q_models_by_row(spark: SparkSession, d: str) -> DataFrame:
    keys = F.map_keys(F.from_json("model_candidates_json", "map<string, string>"))
    return R.crossed(table(spark, d, "voice_ensemble").select("ens_id", F.explode(keys).alias("k")), "ens_id", "k", MODELS)


def _aligned(spark: SparkSession, d: str) -> DataFrame:
    """The cues on the letters of the script's rows, 80 ms a letter from the row's time on."""
    script = first_rows(table(spark, d, "script_rows").select("episode", "source_index", "script_row_id", F.col("台詞").alias("t"), F.col("タイムコード").alias("at")), ["episode", "source_index"], "script_row_id")
    letters = script.where("t is not null").select("episode", "source_index", stamp_ms(F.col("at")).alias("at"), F.posexplode(F.split(E.spoken(F.col("t")), "")).alias("i", "letter")).where("at is not null and letter <> ''")
    heard = letters.select("episode", (F.col("source_index").cast("bigint") * 100_000 + F.col("i")).alias("place"), "letter", (F.col("at") + 80 * F.col("i")).alias("s"), (F.col("at") + 80 * F.col("i") + 80).alias("e"))
    return X.aligned(cues(spark, d).select("episode", "source_index", "text"), heard, ["episode"], "source_index", "text")


@query()
def q_aligned(spark: SparkSession, d: str) -> DataFrame:
    return _aligned(spark, d)


@query(CUES + r""", b AS (SELECT episode, source_index, cue_id, "start" AS s, "end" - 700 * (source_index % 2) AS ls, "end" AS le, length(regexp_replace(coalesce(text, ''), '[\s\x{3000}。、！？?!…，.,\-"'']', '', 'g')) AS n, text,
  lead("start") OVER w AS ns, lead("end") OVER w AS ne, CASE WHEN source_index % 3 > 0 THEN "end" - 250 + 100 * (source_index % 5) END AS ee, CASE WHEN source_index % 4 > 0 THEN "end" + 30 END AS ve FROM timed WINDOW w AS (PARTITION BY episode ORDER BY source_index)),
c AS (SELECT *, le - ls > 600 AS lang, least(CASE WHEN le - ls > 600 THEN ls + 300 ELSE le END, s + n * 350 + 1200) AS ai FROM b),
f AS (SELECT *, CASE WHEN ee IS NOT NULL THEN CASE WHEN NOT lang AND ee < ai - 200 THEN ai + 50 ELSE ee END WHEN ve IS NOT NULL THEN ve ELSE ai END AS x FROM c),
g AS (SELECT *, CASE WHEN regexp_matches(text, '[っッ]') AND ve IS NOT NULL AND ns - x < 300 THEN ne ELSE x END AS y FROM f),
h AS (SELECT *, CASE WHEN n > 5 AND y - s < n * 60 THEN s + n * 60 ELSE y END AS z FROM g), k AS (SELECT *, CASE WHEN ee IS NOT NULL THEN least(ai + 100, z + 50) ELSE ai + 100 END AS q FROM h)
SELECT cue_id, CAST(CASE WHEN q < s + 300 THEN s + 600 ELSE q END AS BIGINT) AS new_end FROM k
""")
def q_clamped_ends(spark: SparkSession, d: str) -> DataFrame:
    rows = previous(timed(spark, d).withColumn("_back", -F.col("source_index")), ["episode"], "_back", ["start", "end"], "_next")
    i, end = F.col("source_index"), F.col("end")
    voice, energy = F.when(i % 4 > 0, end + 30), F.when(i % 3 > 0, end - 250 + 100 * (i % 5))
    letters = F.length(E.spoken(F.coalesce("text", F.lit(""))))
    made = X.clamped_end(F.col("start"), end - 700 * (i % 2), end, letters, F.col("text"), voice, F.col("_next.start"), F.col("_next.end"), energy)
    return rows.select("cue_id", made.alias("new_end"))
