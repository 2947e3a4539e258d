"""Ordered rows of dialogue: boundaries of utterances, units, switches, groups, fills, names and context."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subloom.functions import texts as T
from subloom.operators.ordered import carried, previous, with_neighbours

#: How the text before a boundary ends or the text after it begins.
TERMINAL = "。！？?!…」』】）)"
SOFT = "、，,:：；;"
STRONG = ("から", "ので", "けど", "けれど", "けれども", "のに", "ながら", "つつ", "について", "によると", "件ですが", "それと", "なら", "れば", "たら", "なくて", "くて", "を", "へ", "が")
TE_FORM = ("して", "えて", "けて", "せて", "れて", "いで", "んで", "って", "て", "で")
WEAK = ("の", "と", "に", "は", "も", "時", "時には", "前に", "後に")
PREDICATES = (
    "でした", "ました", "ません", "でしょう", "だろう", "だった", "なかった", "なのよ", "なのね", "なの", "です", "ます",
    "である", "だろ", "んだ", "のだ", "ない", "いる", "ある", "する", "した", "なる", "なった",
)
LEAD_INS = (
    "上官", "大佐", "司令官", "隊長", "社長", "先生", "それと", "他に", "ところで", "その前に", "やっと", "つまり", "ただ",
    "そして", "しかし", "でも", "だから", "Commander",
)
ANSWERS = (
    "はい", "いいえ", "ええ", "うん", "ううん", "いや", "違う", "そうだ", "そうです", "そうか", "分かった", "わかった", "よし",
    "さて", "何？", "なに？", "え？", "は？", "ちょっと！",
)


def _ends(c: Column, endings) -> Column:
    return c.rlike("(?:" + "|".join(map(re.escape, endings)) + r")\z")


def _begins(c: Column, openings) -> Column:
    return c.rlike("^(?:" + "|".join(map(re.escape, openings)) + ")")


def boundary(before: Column, after: Column, gap_ms: Column) -> Column:
    """Whether an utterance goes on over a boundary: a struct of decision (join, split, review), join_score and split_score.

    Both texts are without blanks. A missing text or time splits; a terminal sign or a pause over 1800 ms splits, an overlap of
    more than 80 ms is to be reviewed; else the evidence for either is added up.
    """
    points = lambda condition, n: F.when(condition, n).otherwise(0)
    grammar = F.when(_ends(before, STRONG), 3).when(_ends(before, TE_FORM), 1).when(_ends(before, WEAK), 2).otherwise(0)
    join = points(gap_ms <= 650, 1) + points(_ends(before, SOFT), 4) + points(T.unclosed(before), 4) + grammar + points(before.isin(*LEAD_INS), 2)
    split = points(gap_ms > 1200, 2) + points(_ends(before, PREDICATES), 2) + points(_begins(after, ANSWERS), 3)
    scored = F.struct(
        F.when((join >= 3) & (join - split >= 2), "join").when((split >= 3) & (join <= split), "split").otherwise("review").alias("decision"),
        join.alias("join_score"),
        split.alias("split_score"),
    )
    fixed = lambda decision, n: F.struct(F.lit(decision).alias("decision"), F.lit(0).alias("join_score"), F.lit(n).alias("split_score"))
    return (
        F.when(F.coalesce(before, F.lit("")).isin("") | F.coalesce(after, F.lit("")).isin("") | gap_ms.isNull(), fixed("split", 0))
        .when(_ends(before, TERMINAL), fixed("split", 6))
        .when(gap_ms > 1800, fixed("split", 6))
        .when(gap_ms < -80, fixed("review", 4))
        .otherwise(scored)
    )


def boundaries(df: DataFrame, keys: list[str], pos: str, start: str, end: str, text: str) -> DataFrame:
    """Add ``decision``, ``join_score``, ``split_score`` of the boundary before each row; null for the first of a key."""
    rows = previous(df, keys, pos, [end, text], "_prev")
    bare = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), f"[{T.BLANKS}]+", "")
    texts = rows.withColumn("_t", F.explode(F.array(F.struct(bare(F.col(f"_prev.{text}")).alias("a"), bare(F.col(text)).alias("b")))))
    judged = F.when(F.col("_prev").isNotNull(), boundary(F.col("_t.a"), F.col("_t.b"), F.col(start) - F.col(f"_prev.{end}")))
    # an array of one, exploded, is worked out once; a plain column would be for each of its fields
    judged = texts.withColumn("_b", F.explode(F.array(judged)))
    return judged.select(*df.columns, "_b.decision", "_b.join_score", "_b.split_score")


def labelled(df: DataFrame, keys: list[str], pos: str, opens: Column, out: str) -> DataFrame:
    """Add ``out``: the number of the island the row is in, from 1; ``opens`` is true where one begins."""
    rows = df.withColumn("_o", F.coalesce(opens, F.lit(False)).cast("bigint"))
    return carried(rows, keys, pos, F.col("_o"), "_before", "sum").withColumn(out, F.coalesce("_before", F.lit(0)) + F.col("_o")).drop("_o", "_before")


def units(df: DataFrame, keys: list[str], pos: str, start: str, end: str, text: str) -> DataFrame:
    """:func:`boundaries` and ``unit_no``: rows joined over their boundaries are one unit, numbered from 1."""
    rows = boundaries(df, keys, pos, start, end, text)
    return labelled(rows, keys, pos, F.col("decision").isNull() | (F.col("decision") != "join"), "unit_no")


def groups_in_a_row(df: DataFrame, keys: list[str], pos: str, same: list[str], start: str, end: str, text: str) -> DataFrame:
    """(keys…, same…, first_pos, n, start, end, text): adjacent rows with equal, non-empty ``same`` merged, texts joined by " / ".

    A group's texts make one value, so they are gathered; rows with an empty value of ``same`` stay alone.
    """
    rows = previous(df, keys, pos, same, "_prev")
    equal = F.lit(True)
    for c in same:
        equal = equal & (F.col(c) == F.col(f"_prev.{c}")) & (F.coalesce(F.col(c), F.lit("")) != "")
    rows = labelled(rows, keys, pos, F.col("_prev").isNull() | ~F.coalesce(equal, F.lit(False)), "_g")
    part = F.struct(F.col(pos).alias("p"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return rows.groupBy(*keys, "_g").agg(
        *[F.min(c).alias(c) for c in same],
        F.min(pos).alias(f"first_{pos}"),
        F.count("*").alias("n"),
        F.min(start).alias(start),
        F.max(end).alias(end),
        F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["t"]), " / ").alias(text),
    ).drop("_g")


def shown_roles(df: DataFrame, keys: list[str], pos: str, role: str, unit: str) -> DataFrame:
    """Add ``shown_role``: the role, but empty where role and non-empty unit are those of the row before."""
    rows = previous(df, keys, pos, [role, unit], "_prev")
    repeated = (F.col(role) == F.col(f"_prev.{role}")) & (F.col(unit) == F.col(f"_prev.{unit}")) & (F.col(unit) != "")
    return rows.withColumn("shown_role", F.when(F.coalesce(repeated, F.lit(False)), "").otherwise(F.coalesce(F.col(role), F.lit("")))).drop("_prev")


def switches(df: DataFrame, keys: list[str], pos: str, role: str, unit: str) -> DataFrame:
    """The rows on which the role changes within a unit, with the role before."""
    rows = previous(df, keys, pos, [role, unit], "_prev")
    changed = (F.col(unit) == F.col(f"_prev.{unit}")) & (F.col(unit) != "") & (F.col(role) != F.col(f"_prev.{role}"))
    return rows.where(changed).select(*df.columns, F.col(f"_prev.{role}").alias("previous_role"))


def filled_forward(df: DataFrame, keys: list[str], pos: str, column: str, out: str) -> DataFrame:
    """Add ``out``: the value of ``column``, where blank that of the last row before that isn't."""
    value = F.when(F.coalesce(T.strip(F.col(column)), F.lit("")) != "", F.col(column))
    rows = carried(df, keys, pos, F.when(value.isNotNull(), F.struct(F.col(pos).alias("p"), value.alias("v"))), "_last")
    return rows.withColumn(out, F.coalesce(value, F.col("_last.v"))).drop("_last")


def index_gaps(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """(keys…, after, before, missing): where the numbers of a key aren't consecutive."""
    rows = previous(df.select(*keys, pos).distinct(), keys, pos, [], "_prev")
    return rows.where(F.col(pos) > F.col(f"_prev.{pos}") + 1).select(*keys, F.col(f"_prev.{pos}").alias("after"), F.col(pos).alias("before"), (F.col(pos) - F.col(f"_prev.{pos}") - 1).alias("missing"))


def context(df: DataFrame, keys: list[str], pos: str, text: str, around: int) -> DataFrame:
    """Add ``context``: the texts of up to ``around`` rows on either side and the row's own, in order."""
    return with_neighbours(df, keys, pos, F.coalesce(F.col(text), F.lit("")), around, around, "context")


def moving_average(df: DataFrame, keys: list[str], pos: str, value: str, around: int, out: str) -> DataFrame:
    """Add ``out``: the mean of ``value`` over the row and up to ``around`` rows on either side; nulls don't count."""
    rows = with_neighbours(df, keys, pos, F.col(value).cast("double"), around, around, "_near")  # collect_list leaves out nulls
    return rows.withColumn(out, F.when(F.size("_near") > 0, F.aggregate("_near", F.lit(0.0), lambda a, x: a + x) / F.size("_near"))).drop("_near")


def speaker_names(df: DataFrame, keys: list[str], speaker: str, start: str) -> DataFrame:
    """(keys…, speaker, named): speakers named SpeakerNN in the order of their first start, ties by name."""
    first = df.where(F.col(speaker).isNotNull() & F.col(start).isNotNull()).groupBy(*keys, speaker).agg(F.min(start).alias("_s"))
    w = Window.partitionBy(*keys).orderBy("_s", speaker)  # one row per speaker
    return first.select(*keys, speaker, F.format_string("Speaker%02d", F.row_number().over(w)).alias("named"))
