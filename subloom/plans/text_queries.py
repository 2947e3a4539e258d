"""Queries over the text of cues and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subloom.functions import texts as T
from subloom.functions import timecodes as C
from subloom.operators import rules as R
from subloom.plans.registry import query
from subloom.session import table
from subloom.sources.subtitles import srt_blocks, srt_cues, srt_lenient

B = "[" + T.BLANKS.replace("\\x0B", "\\x{0B}") + "]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{B}+|{B}+$', '', 'g')"


_LINES = """
WITH b AS (SELECT cue_id, "end" - "start" AS ms, regexp_replace(text, '\\r\\n?', chr(10), 'g') AS t FROM cue_labels WHERE text IS NOT NULL),
l AS (SELECT *, string_split(t, chr(10)) AS l FROM b),
"""
def _tagless(x: str) -> str:
    return rf"regexp_replace({x}, '\{{[^{{}}]*\}}', '', 'g')"


def _shown(x: str) -> str:
    return rf"length(regexp_replace({_tagless(x)}, '^[\r\n]+|[\r\n]+$', '', 'g'))"


def _japanese(x: str) -> str:
    return rf"len(regexp_extract_all({_tagless(x)}, '[\x{{3040}}-\x{{30FF}}\x{{3400}}-\x{{9FFF}}]'))"


def _wide(x: str) -> str:
    bare = rf"regexp_replace({_tagless(x)}, '[\r\n]', '', 'g')"
    return f"(2 * length({bare}) - len(regexp_extract_all({bare}, '{T.half_width_class()}')))"


def _measures(extra: str) -> str:
    told = f"list_filter(list_transform(l, lambda x: {_strip('x')}), lambda x: x <> '')"
    merged = f"list_aggregate(list_transform(l, lambda x: {_strip('x')}), 'string_agg', '')"
    return (
        _LINES
        + f"""
m AS (SELECT *, {told} AS told, coalesce({merged}, '') AS merged FROM l),
f AS (SELECT *, len(told) = 2 AND len(list_filter(told, lambda x: NOT starts_with(x, '-'))) = 0 AS pair,
  length(merged) >= 2 AND starts_with(merged, '[') AND ends_with(merged, ']') AS screen,
  CAST(coalesce(list_sum(list_transform(l, lambda x: {_shown('x')})), 0) AS INTEGER) AS shown, {_wide('merged')} AS wide,
  len(list_filter(l, lambda x: {_japanese('x')} <= 2)) AS orphans,
  list_zip(list_transform(l[1:len(l) - 1], lambda x: regexp_replace(x, '{B}+$', '')), list_transform(l[2:], lambda x: regexp_replace(x, '^{B}+', ''))) AS joints,
  list_transform(l[2:], lambda x: regexp_replace(x, '^{B}+', '')) AS lowers FROM m)
"""
        + extra
    )


def _rules_sql(p: R.Profile) -> str:
    wide = (_wide if p.columns else _shown)("x")
    total = "wide" if p.columns else "shown"
    has = lambda pattern: f"CAST(regexp_matches(t, '{pattern}') AS INTEGER)"
    torn = " + ".join(f"len(list_filter(joints, lambda j: ends_with(j[1], '{a}') AND regexp_matches(j[2], '^({'|'.join(b)})')))" for a, b in R.PROTECTED)
    begins = " OR ".join(f"(starts_with(x, '{a}')" + (f" AND NOT regexp_matches(x, '^{a}({'|'.join(b)})')" if b else "") + ")" for a, b in R.PARTICLES)
    cps = f"(CASE WHEN ms > 0 THEN {total} / {2 if p.columns else 1}.0 / (ms / 1000.0) ELSE 0 END)"
    japanese = r"[\x{3040}-\x{30FF}\x{3400}-\x{9FFF}]"
    rows = [
        ("EDGE_SPACE", "warning", has(r"(^|\n)[ \t]+|[ \t]+($|\n)")),
        ("MULTI_SPACE", "warning", has(" {2,}")),
        ("TOO_MANY_LINES", "blocker", "CAST(NOT screen AND len(l) > 2 AS INTEGER)"),
        ("LINE_WIDTH", "blocker", f"len(list_filter(l, lambda x: {wide} > {p.line_limit}))"),
        ("CUE_WIDTH", "blocker", f"CAST({total} > {p.cue_limit} AS INTEGER)"),
        ("PROTECTED_BREAK", "blocker", f"CASE WHEN len(l) > 1 THEN {torn} ELSE 0 END"),
        ("LINE_START_PARTICLE", "review", f"CASE WHEN len(l) > 1 THEN len(list_filter(lowers, lambda x: {begins})) ELSE 0 END"),
        ("FULLWIDTH_DIGIT", "blocker", has("[０-９]")),
        ("CPS", "blocker", f"CAST({cps} >= {p.blocker_cps} AS INTEGER)"),
        ("CPS", "warning", f"CAST({cps} > {p.warning_cps} AND {cps} < {p.blocker_cps} AS INTEGER)"),
    ]
    if p.columns:
        rows += [
            ("JP_PERIOD", "warning", has("。")),
            ("JP_COMMA", "warning", has("、")),
            ("ELLIPSIS", "warning", has(r"……|\.{2,}|．{2,}")),
            ("DIALOGUE_DASH_SPACE", "warning", f"CAST(pair AND len(list_filter(l, lambda x: NOT starts_with({_strip('x')}, '- '))) > 0 AS INTEGER)"),
            ("UNNEEDED_LINE_BREAK", "warning", f"CAST(len(l) > 1 AND {total} <= {p.line_limit} AND NOT pair AND NOT screen AS INTEGER)"),
            ("ORPHAN_LINE", "warning", "CASE WHEN len(l) > 1 THEN orphans ELSE 0 END"),
            ("SEMANTIC_SPACE", "warning", "CAST(regexp_matches(merged, 'わかった(いいだろう|そうだ|任せろ|行くぞ|もう)') AS INTEGER)"),
            ("SEMANTIC_BOUNDARY", "warning", f"CAST(regexp_matches(merged, '挨拶はいい{japanese}') AS INTEGER)"),
            ("COMMAND_BOUNDARY", "review", f"CAST(regexp_matches(merged, 'なさい{japanese}') AS INTEGER)"),
        ]
    else:
        taboo = {}
        for term, rule in R.TABOO:
            taboo.setdefault(rule, []).append(f"CAST(contains(t, '{term}') AS INTEGER)")
        rows += [
            ("JP_PERIOD", "blocker", has("。")),
            ("SENTENCE_FINAL_DOT", "blocker", has(rf"\.{B}*$")),
            ("JP_COMMA", "blocker", has("[、，]")),
            ("ASCII_COMMA", "blocker", has(",")),
            ("FULLWIDTH_QUESTION_EXCLAMATION", "blocker", has("[？！]")),
            ("STACKED_PUNCTUATION", "blocker", has(r"[?!]{2,}|! \?|\? !")),
            ("FULLWIDTH_QUOTES", "blocker", has("[「」『』]")),
            ("FULLWIDTH_ELLIPSIS", "blocker", has("…|．{2,}")),
            ("OVERLONG_ELLIPSIS", "warning", f"CASE WHEN regexp_matches(t, '…|．{{2,}}') THEN 0 ELSE {has(r'\.{4,}')} END"),
            ("LOOKALIKE_DASH", "blocker", f"len(regexp_extract_all(t, '[{R.LOOKALIKE_DASHES}]'))"),
            ("PARENTHESIS_IN_DIALOGUE", "blocker", f"CASE WHEN screen THEN 0 ELSE {has('[（）()]')} END"),
            ("DUAL_SPEAKER_SPACE", "blocker", f"CASE WHEN pair THEN len(list_filter(l, lambda x: starts_with({_strip('x')}, '- '))) ELSE 0 END"),
            ("ORPHAN_LINE", "warning", "CASE WHEN len(l) > 1 AND NOT pair THEN orphans ELSE 0 END"),
            *[(rule, "warning", " + ".join(terms)) for rule, terms in taboo.items()],
        ]
    each = "\nUNION ALL ".join(f"SELECT cue_id, '{r}' AS rule_id, '{s}' AS severity, CAST({n} AS INTEGER) AS findings FROM f" for r, s, n in rows)
    return _measures(f", r AS ({each}) SELECT * FROM r WHERE findings > 0")


def _issues(spark: SparkSession, d: str, p: R.Profile) -> DataFrame:
    return R.audit(table(spark, d, "cue_labels"), ["cue_id"], "text", p, F.col("end") - F.col("start"))


@query(_rules_sql(R.SHORT_DRAMA))
def q_rule_issues_short_drama(spark: SparkSession, d: str) -> DataFrame:
    return _issues(spark, d, R.SHORT_DRAMA)


@query(_rules_sql(R.POST_DUB))
def q_rule_issues_post_dub(spark: SparkSession, d: str) -> DataFrame:
    return _issues(spark, d, R.POST_DUB)


@query(f"SELECT rule_id, severity, count(*) AS cues, CAST(sum(findings) AS BIGINT) AS findings FROM ({_rules_sql(R.SHORT_DRAMA)}) GROUP BY 1, 2")
def q_rule_counts(spark: SparkSession, d: str) -> DataFrame:
    return _issues(spark, d, R.SHORT_DRAMA).groupBy("rule_id", "severity").agg(F.count("*").alias("cues"), F.sum("findings").alias("findings"))


@query(
    _measures(f""" SELECT cue_id, CAST(len(l) AS INTEGER) AS n_lines, shown AS shown_length, CAST({_wide('t')} AS INTEGER) AS columns_wide,
  CAST({_japanese('t')} AS INTEGER) AS japanese, pair AS two_speakers, screen AS screen_text,
  len(list_filter(l, lambda x: regexp_matches(x, '^{B}*[-－‐‑–—]'))) >= 2 AS dual_dialogue,
  {' OR '.join(f"length(replace(t, '{b}', '')) > length(replace(t, '{a}', ''))" for a, b in T.DELIMITERS)} AS unclosed,
  translate(t, '０１２３４５６７８９', '0123456789') AS digits_folded FROM f""")
)
def q_text_measures(spark: SparkSession, d: str) -> DataFrame:
    cues = table(spark, d, "cue_labels").where("text is not null").select("cue_id", T.plain_line_ends(F.col("text")).alias("t")).withColumn("l", F.split("t", "\n"))
    t, rows = F.col("t"), F.col("l")
    return cues.select(
        "cue_id",
        F.size(rows).alias("n_lines"),
        F.aggregate(rows, F.lit(0), lambda a, x: a + T.shown_length(x)).alias("shown_length"),
        T.columns_wide(t).alias("columns_wide"),
        T.japanese_letters(t).alias("japanese"),
        T.two_speakers(rows).alias("two_speakers"),
        T.screen_text(rows).alias("screen_text"),
        T.dual_dialogue(rows).alias("dual_dialogue"),
        T.unclosed(t).alias("unclosed"),
        T.ascii_digits(t).alias("digits_folded"),
    )


@query(r"""
SELECT cue_id, text, regexp_replace(replace(translate(regexp_replace(replace(text, '。', ''), '[、，,]', ' ', 'g'), '？！「」『』．０１２３４５６７８９', '?!｢｣｢｣.0123456789'), '…', '...'), '\.{4,}', '...', 'g') AS proposed
FROM cue_labels WHERE text IS NOT NULL
""")
def q_proposed_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "cue_labels").where("text is not null").select("cue_id", "text", R.proposed(F.col("text")).alias("proposed"))


@query(rf"""
WITH l AS (SELECT cue_id, unnest(string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10))) AS x, generate_subscripts(string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)), 1) AS line_no FROM cue_labels WHERE text IS NOT NULL),
c AS (SELECT cue_id, line_no, x, unnest(range(1, length(x) + 1)) AS column_no FROM l WHERE regexp_matches(x, '[{R.LOOKALIKE_DASHES}-]'))
SELECT cue_id, CAST(line_no AS INTEGER) AS line_no, CAST(column_no AS INTEGER) AS column_no, x[column_no] AS sign, 'U+' || upper(lpad(to_hex(unicode(x[column_no])), 4, '0')) AS codepoint
FROM c WHERE regexp_matches(x[column_no], '[{R.LOOKALIKE_DASHES}-]') AND NOT (x[column_no] = '-' AND column_no = 1 AND regexp_matches(x, '^-[^{T.BLANKS}]'))
""")
def q_lookalike_marks(spark: SparkSession, d: str) -> DataFrame:
    return R.lookalike_marks(table(spark, d, "cue_labels"), ["cue_id"], "text")


_SRT = rf"""
WITH s AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '^\x{{FEFF}}', ''), '\r\n?', chr(10), 'g'), '^\s+|\s+$', '', 'g') AS t FROM documents WHERE doc_kind = 'subtitle' AND text IS NOT NULL),
k AS (SELECT doc_id, list_filter(string_split_regex(t, '\n(?:[ \t]*\n)+'), lambda b: {_strip('b')} <> '') AS bs FROM s),
b AS (SELECT doc_id, unnest(bs) AS b, generate_subscripts(bs, 1) AS block_no FROM k),
r AS (SELECT doc_id, block_no, string_split(b, chr(10)) AS r FROM b),
h AS (SELECT *, {_strip('r[1]')} AS i, coalesce({_strip('r[2]')}, '') AS tm, coalesce(list_aggregate(r[3:], 'string_agg', chr(10)), '') AS text FROM r),
p AS (SELECT *, regexp_extract(tm, '^(\d{{1,2}}:\d{{2}}:\d{{2}}[,.]\d{{3}})\s*-->\s*(\d{{1,2}}:\d{{2}}:\d{{2}}[,.]\d{{3}})(?:\s+.*)?$', ['a', 'z']) AS g FROM h),
q AS (SELECT *, regexp_extract(g.a, '^(\d{{1,2}}):(\d{{2}}):(\d{{2}})[,.](\d{{3}})$', ['h', 'm', 's', 'f']) AS a, regexp_extract(g.z, '^(\d{{1,2}}):(\d{{2}}):(\d{{2}})[,.](\d{{3}})$', ['h', 'm', 's', 'f']) AS z FROM p),
v AS (SELECT *, TRY_CAST(i AS BIGINT) AS source_index,
  CASE WHEN TRY_CAST(a.m AS INT) < 60 AND TRY_CAST(a.s AS INT) < 60 THEN ((TRY_CAST(a.h AS BIGINT) * 60 + TRY_CAST(a.m AS BIGINT)) * 60 + TRY_CAST(a.s AS BIGINT)) * 1000 + TRY_CAST(a.f AS BIGINT) END AS start_ms,
  CASE WHEN TRY_CAST(z.m AS INT) < 60 AND TRY_CAST(z.s AS INT) < 60 THEN ((TRY_CAST(z.h AS BIGINT) * 60 + TRY_CAST(z.m AS BIGINT)) * 60 + TRY_CAST(z.s AS BIGINT)) * 1000 + TRY_CAST(z.f AS BIGINT) END AS end_ms FROM q),
f AS (SELECT doc_id, CAST(block_no AS INTEGER) AS block_no, source_index, start_ms, end_ms, text, CASE WHEN len(r) < 3 OR NOT regexp_matches(i, '^\d+$') THEN 'index'
  WHEN start_ms IS NULL OR end_ms IS NULL THEN 'range' WHEN end_ms < start_ms THEN 'order' WHEN text = '' THEN 'text' END AS fault FROM v)
"""


def _subtitles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("doc_kind = 'subtitle'")


@query(_SRT + "SELECT * FROM f")
def q_srt_blocks(spark: SparkSession, d: str) -> DataFrame:
    return srt_blocks(_subtitles(spark, d), ["doc_id"], "text")


@query(_SRT + ", n AS (SELECT doc_id FROM f GROUP BY 1 HAVING count(fault) = 0 AND count(*) = count(DISTINCT source_index)) SELECT doc_id, block_no AS ord, source_index, start_ms, end_ms, text FROM f WHERE doc_id IN (SELECT doc_id FROM n)")
def q_srt_strict(spark: SparkSession, d: str) -> DataFrame:
    return srt_cues(_subtitles(spark, d), ["doc_id"], "text", strict=True)


@query(_SRT + "SELECT doc_id, block_no AS ord, source_index, start_ms, end_ms, text FROM f WHERE fault IS NULL")
def q_srt_tolerant(spark: SparkSession, d: str) -> DataFrame:
    return srt_cues(_subtitles(spark, d), ["doc_id"], "text", strict=False)


@query(r"""
WITH p AS (SELECT turn_id, start_timecode, regexp_extract(trim(start_timecode), '^(\d{1,2}):(\d{2}):(\d{2})[,.](\d{3})$', ['h', 'm', 's', 'f']) AS g, start_seconds FROM speaker_turns),
q AS (SELECT turn_id, ((TRY_CAST(g.h AS BIGINT) * 60 + TRY_CAST(g.m AS BIGINT)) * 60 + TRY_CAST(g.s AS BIGINT)) * 1000 + TRY_CAST(g.f AS BIGINT) AS ms, CAST(floor(start_seconds * 1000 + 1e-6) AS BIGINT) AS cut FROM p)
SELECT turn_id, ms AS timecode_ms, cut AS seconds_ms, CASE WHEN cut IS NULL THEN NULL ELSE
  CASE WHEN greatest(cut, 0) // 3600000 < 100 THEN lpad(CAST(greatest(cut, 0) // 3600000 AS VARCHAR), 2, '0') ELSE CAST(greatest(cut, 0) // 3600000 AS VARCHAR) END || ':' || lpad(CAST(greatest(cut, 0) // 60000 % 60 AS VARCHAR), 2, '0') || ':' ||
  lpad(CAST(greatest(cut, 0) // 1000 % 60 AS VARCHAR), 2, '0') || ',' || lpad(CAST(greatest(cut, 0) % 1000 AS VARCHAR), 3, '0') END AS stamp FROM q
""")
def q_timecodes(spark: SparkSession, d: str) -> DataFrame:
    cut = F.floor(F.col("start_seconds") * 1000 + 1e-6).cast("bigint")
    turns = table(spark, d, "speaker_turns")
    return turns.select("turn_id", C.stamp_ms(F.col("start_timecode")).alias("timecode_ms"), cut.alias("seconds_ms"), F.when(cut.isNotNull(), C.stamp(cut)).alias("stamp"))


@query("""
SELECT ens_id, CAST(trim(unnest(string_split(source_indices, ','))) AS INTEGER) AS source_index FROM voice_ensemble WHERE trim(source_indices) <> ''
""")
def q_expanded_indices(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "voice_ensemble").where("trim(source_indices) <> ''").select("ens_id", F.explode(T.expand_ranges(F.col("source_indices"))).alias("source_index"))


@query(r"SELECT DISTINCT role, regexp_replace(trim(regexp_replace(role, '\s+', ' ', 'g')), '', '') AS shown FROM role_catalog")
def q_role_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "role_catalog").select("role", T.name_form(F.col("role")).alias("shown")).distinct()


@query(r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(regexp_replace(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '^\x{FEFF}', ''), '^\s+|\s+$', '', 'g'), '\n(?:[ \t]*\n)+'), lambda b: true) AS b FROM documents WHERE doc_kind = 'subtitle' AND text IS NOT NULL),
r AS (SELECT doc_id, list_filter(list_transform(b, lambda x: list_filter(list_transform(string_split(x, chr(10)), lambda l: regexp_replace(l, '^[\s\x{3000}\x{A0}]+|[\s\x{3000}\x{A0}]+$', '', 'g')), lambda l: l <> '')), lambda l: len(list_filter(l, lambda y: contains(y, '-->'))) > 0) AS r FROM d),
e AS (SELECT doc_id, unnest(r) AS l, generate_subscripts(r, 1) AS cue_id FROM r),
a AS (SELECT doc_id, CAST(cue_id AS INTEGER) AS cue_id, l, list_position(list_transform(l, lambda y: contains(y, '-->')), true) AS p FROM e)
SELECT doc_id, cue_id, array_to_string(l[p + 1:], ' ') AS text FROM a
""")
def q_srt_lenient(spark: SparkSession, d: str) -> DataFrame:
    return srt_lenient(_subtitles(spark, d), ["doc_id"], "text").select("doc_id", "cue_id", "text")


@query(r"""
SELECT cue_id, 'cluster:' || episode || ':' || anonymous_speaker AS given, CASE WHEN anonymous_speaker IS NOT NULL AND episode IS NOT NULL THEN lpad(episode, CAST(greatest(4, length(episode)) AS INTEGER), '0') || ':' || anonymous_speaker END AS cluster_key,
nullif(regexp_extract(frame, '(?:^|/)([0-9]{6})\.jpg$', 1), '') AS frame_no, list_distinct(regexp_extract_all(lower(frame), '[a-z]+')).list_sort() AS tokens FROM cue_labels
""")
def q_cluster_keys(spark: SparkSession, d: str) -> DataFrame:
    given = F.concat(F.lit("cluster:"), F.col("episode"), F.lit(":"), F.col("anonymous_speaker"))
    number = F.nullif(F.regexp_extract("frame", r"(?:^|/)([0-9]{6})\.jpg\z", 1), F.lit(""))
    return table(spark, d, "cue_labels").select("cue_id", given.alias("given"), T.cluster_key(given).alias("cluster_key"), number.alias("frame_no"), F.array_sort(T.letter_tokens(F.col("frame"))).alias("tokens"))
