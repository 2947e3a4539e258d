"""Text rules of subtitles: each cue gives a row for every rule it breaks.

A profile is data: which rules hold, how severe they are and their limits. One pass over the cues evaluates all rules
of a profile as an array of findings, which is exploded; nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subloom.functions import texts as T

BLOCKER, WARNING, REVIEW = "blocker", "warning", "review"

#: Dashes taken for the long-vowel sign.
LOOKALIKE_DASHES = "―—–−－ｰ"
#: Terms that are not to be used, with the rule that says so.
TABOO = (
    ("陳虎", "NAME_TABOO"),
    ("妻よ", "TITLE_TABOO"),
    ("ア強", "TITLE_TABOO"),
    ("東子", "TITLE_TABOO"),
    ("顔を叩く", "GLOSSARY_TABOO"),
    ("白い月光", "GLOSSARY_TABOO"),
    ("普通で自信のある男", "GLOSSARY_TABOO"),
    ("三十年河の東", "GLOSSARY_TABOO"),
    ("木が倒れると猿が散る", "GLOSSARY_TABOO"),
)
#: The end of a line and the begin of the next that may not be parted.
PROTECTED = (
    ("て", ("いる", "いく", "くる", "しまう", "みる", "見せる", "ください", "ほしい", "やる", "おく", "ある", "ない")),
    ("で", ("も",)),
    ("ダ", ("メ",)),
    ("なけ", ("れば",)),
    ("なく", ("なる",)),
)
#: Particles that shouldn't open a line, and what may follow them. Not as patterns that look ahead: the SQL that must give the same rows has none.
PARTICLES = (
    ("は", ("るか", "ず", "い", "じめ", "っ", "め", "な", "や", "ら", "ん")),
    ("も", ("う", "っと", "し", "の", "ら", "て", "った")),
    ("と", ("んだ", "ころ", "てもかく")),
    ("を", ()),
)


@dataclass(frozen=True)
class Profile:
    name: str
    line_limit: int
    cue_limit: int
    columns: bool  # widths in columns, else in characters
    blocker_cps: float
    warning_cps: float


SHORT_DRAMA = Profile("short_drama", 11, 22, False, 29.9999, 20.0001)
POST_DUB = Profile("post_dub", 24, 48, True, 14.9999, 10.0001)


def _findings(p: Profile) -> list[tuple[str, str, Column]]:
    """(rule, severity, number of findings) over the columns _t (text), _l (lines), _ms (length of time)."""
    t, rows = F.col("_t"), F.col("_l")
    screen, pair, many = T.screen_text(rows), T.two_speakers(rows), F.size(rows) > 1
    has = lambda pattern: t.rlike(pattern).cast("int")
    wide = T.columns_wide if p.columns else T.shown_length
    merged = F.array_join(F.transform(rows, T.strip), "")
    total = T.columns_wide(merged) if p.columns else F.aggregate(rows, F.lit(0), lambda a, x: a + T.shown_length(x))
    over = F.size(F.filter(rows, lambda x: wide(x) > p.line_limit))
    orphans = F.size(F.filter(rows, lambda x: T.japanese_letters(x) <= 2))
    uppers = F.transform(F.slice(rows, 1, F.greatest(F.size(rows) - 1, F.lit(0))), lambda x: F.regexp_replace(x, f"[{T.BLANKS}]+\\z", ""))
    lowers = F.transform(F.slice(rows, 2, F.size(rows)), lambda x: F.regexp_replace(x, f"^[{T.BLANKS}]+", ""))
    joints = F.arrays_zip(uppers.alias("u"), lowers.alias("d"))

    def parted(a: str, b: tuple[str, ...]) -> Column:
        return F.size(F.filter(joints, lambda j: j["u"].endswith(a) & j["d"].rlike("^(" + "|".join(b) + ")")))

    torn = sum((parted(a, b) for a, b in PROTECTED), F.lit(0))

    def begins(x: Column) -> Column:
        out = F.lit(False)
        for particle, follow in PARTICLES:
            out = out | (x.startswith(particle) & (~x.rlike(f"^{particle}({'|'.join(follow)})") if follow else F.lit(True)))
        return out

    cps = F.when(F.col("_ms") > 0, total / (2 if p.columns else 1) / (F.col("_ms") / 1000))
    when = lambda condition, n: F.when(condition, n).otherwise(0)
    shared = [
        ("EDGE_SPACE", WARNING, has(r"(^|\n)[ \t]+|[ \t]+(\z|\n)")),
        ("MULTI_SPACE", WARNING, has(r" {2,}")),
        ("TOO_MANY_LINES", BLOCKER, when(~screen & (F.size(rows) > 2), 1)),
        ("LINE_WIDTH", BLOCKER, over),
        ("CUE_WIDTH", BLOCKER, (total > p.cue_limit).cast("int")),
        ("PROTECTED_BREAK", BLOCKER, when(many, torn)),
        ("LINE_START_PARTICLE", REVIEW, when(many, F.size(F.filter(lowers, begins)))),
        ("FULLWIDTH_DIGIT", BLOCKER, has("[０-９]")),
        ("CPS", BLOCKER, (F.coalesce(cps, F.lit(0.0)) >= p.blocker_cps).cast("int")),
        ("CPS", WARNING, ((F.coalesce(cps, F.lit(0.0)) > p.warning_cps) & (F.coalesce(cps, F.lit(0.0)) < p.blocker_cps)).cast("int")),
    ]
    if p.columns:
        return shared + [
            ("JP_PERIOD", WARNING, has("。")),
            ("JP_COMMA", WARNING, has("、")),
            ("ELLIPSIS", WARNING, has(r"……|\.{2,}|．{2,}")),
            ("DIALOGUE_DASH_SPACE", WARNING, when(pair & F.exists(rows, lambda x: ~T.strip(x).startswith("- ")), 1)),
            ("UNNEEDED_LINE_BREAK", WARNING, when(many & (total <= p.line_limit) & ~pair & ~screen, 1)),
            ("ORPHAN_LINE", WARNING, when(many, orphans)),
            ("SEMANTIC_SPACE", WARNING, merged.rlike("わかった(いいだろう|そうだ|任せろ|行くぞ|もう)").cast("int")),
            ("SEMANTIC_BOUNDARY", WARNING, merged.rlike("挨拶はいい" + T.JAPANESE).cast("int")),
            ("COMMAND_BOUNDARY", REVIEW, merged.rlike("なさい" + T.JAPANESE).cast("int")),
        ]
    wide_dots = t.rlike(r"…|．{2,}")
    return shared + [
        ("JP_PERIOD", BLOCKER, has("。")),
        ("SENTENCE_FINAL_DOT", BLOCKER, has(rf"\.[{T.BLANKS}]*\z")),
        ("JP_COMMA", BLOCKER, has("[、，]")),
        ("ASCII_COMMA", BLOCKER, has(",")),
        ("FULLWIDTH_QUESTION_EXCLAMATION", BLOCKER, has("[？！]")),
        ("STACKED_PUNCTUATION", BLOCKER, has(r"[?!]{2,}|! \?|\? !")),
        ("FULLWIDTH_QUOTES", BLOCKER, has("[「」『』]")),
        ("FULLWIDTH_ELLIPSIS", BLOCKER, wide_dots.cast("int")),
        ("OVERLONG_ELLIPSIS", WARNING, when(~wide_dots, has(r"\.{4,}"))),
        ("LOOKALIKE_DASH", BLOCKER, T.count_of(t, f"[{LOOKALIKE_DASHES}]")),
        ("PARENTHESIS_IN_DIALOGUE", BLOCKER, when(~screen, has("[（）()]"))),
        ("DUAL_SPEAKER_SPACE", BLOCKER, when(pair, F.size(F.filter(rows, lambda x: T.strip(x).startswith("- "))))),
        ("ORPHAN_LINE", WARNING, when(many & ~pair, orphans)),
        *[(rule, WARNING, sum((F.contains(t, F.lit(term)).cast("int") for term, r in TABOO if r == rule), F.lit(0))) for rule in dict.fromkeys(r for _, r in TABOO)],
    ]


def audit(df: DataFrame, key: list[str], text: str, profile: Profile, duration_ms: Column | None = None) -> DataFrame:
    """(key…, rule_id, severity, findings) of every rule of a profile that a cue breaks.

    ``findings`` counts the places (lines, characters) the rule speaks of, 1 for rules about the whole cue. A null
    text breaks no rule; without ``duration_ms`` or where it isn't positive reading speed isn't judged.
    """
    base = df.where(F.col(text).isNotNull()).select(*key, F.col(text).alias("_t"), (F.lit(None).cast("bigint") if duration_ms is None else duration_ms).alias("_ms"))
    base = base.withColumn("_t", T.plain_line_ends(F.col("_t"))).withColumn("_l", F.split("_t", "\n"))
    found = F.array(*[F.struct(F.lit(r).alias("rule_id"), F.lit(s).alias("severity"), n.cast("int").alias("findings")) for r, s, n in _findings(profile)])
    return base.select(*key, F.explode(F.filter(found, lambda x: x["findings"] > 0)).alias("f")).select(*key, "f.rule_id", "f.severity", "f.findings")


def proposed(text: Column) -> Column:
    """The text as the short-drama profile wants it, where a rule has one way to mend it."""
    out = F.replace(text, F.lit("。"), F.lit(""))
    out = F.regexp_replace(out, "[、，,]", " ")
    out = F.translate(out, "？！「」『』．０１２３４５６７８９", "?!｢｣｢｣.0123456789")
    return F.regexp_replace(F.replace(out, F.lit("…"), F.lit("...")), r"\.{4,}", "...")


def lookalike_marks(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """(key…, line_no, column_no, sign, codepoint) of each dash or hyphen that may stand for the long-vowel sign.

    A hyphen that opens a line and is followed by text marks a speaker and isn't meant.
    """
    sign = f"[{LOOKALIKE_DASHES}-]"
    each = df.where(F.col(text).isNotNull()).select(*key, F.posexplode(T.lines(F.col(text))).alias("_no", "_line"))
    each = each.where(F.col("_line").rlike(sign)).select(*key, "_no", "_line", F.posexplode(F.split("_line", "")).alias("_at", "sign"))
    speaker = (F.col("sign") == "-") & (F.col("_at") == 0) & F.col("_line").rlike(f"^-[^{T.BLANKS}]")
    hit = each.where(F.col("sign").rlike(sign) & ~speaker)
    return hit.select(*key, (F.col("_no") + 1).alias("line_no"), (F.col("_at") + 1).alias("column_no"), "sign", F.concat(F.lit("U+"), F.hex(F.encode("sign", "UTF-16BE"))).alias("codepoint"))
