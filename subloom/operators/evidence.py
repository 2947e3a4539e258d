"""Evidence about cues: places to look at, pace, coverage by turns, mentions of roles, digests of whole tables."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from subloom.functions import texts as T
from subloom.operators.dialogue import labelled
from subloom.operators.ordered import carried, numbered
from subloom.operators.schedules import per_key
from subloom.operators.spans import merged, overlap_ms, overlaps

#: Signs that aren't spoken.
UNSPOKEN = r"[\s　。、！？?!…，.,\-\"']"
#: Terms that are held by every worker at once; more are taken in blocks.
HELD_TERMS = 100_000
#: Rows of a block that is digested as one.
DIGEST_BLOCK = 4096


def sample_points(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """(keys…, point, at_ms): the places at 20, 50 and 80 % of each interval, halves rounded to even."""
    length = F.greatest(F.col(end) - F.col(start), F.lit(0))
    point = lambda name, share: F.struct(F.lit(name).alias("point"), (F.col(start) + F.bround(length * F.lit(share)).cast("bigint")).alias("at_ms"))
    each = F.explode(F.array(point("early", 0.2), point("middle", 0.5), point("late", 0.8)))
    return df.where(F.col(start).isNotNull() & F.col(end).isNotNull()).select(*keys, each.alias("p")).select(*keys, "p.point", "p.at_ms")


def pace(df: DataFrame, keys: list[str], pos: str, start: str, end: str, text: str) -> DataFrame:
    """(keys…, pos, gap_ms, density, reasons): why a cue's time looks wrong for its text, rows without a reason left out.

    gap_ms is the time since the end of the row before, from 0 for the first; density: spoken signs per second.
    """
    rows = carried(df, keys, pos, F.struct(pos, F.col(end).alias("e")), "_p")
    length = F.col(end) - F.col(start)
    signs = F.length(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), UNSPOKEN, ""))
    rows = rows.withColumn("gap_ms", F.col(start) - F.coalesce("_p.e", F.lit(0))).withColumn("density", F.when(length > 0, signs * 1000 / length).otherwise(0.0))
    reasons = F.array_compact(
        F.array(
            F.when((F.col("gap_ms") > 3000) & (length < 500), "long_gap"),
            F.when(length < 200, "ultra_short"),
            F.when(F.col("density") > 12, "high_density"),
            F.when((F.col("density") < 2) & (length > 1500), "low_density"),
        )
    )
    return rows.select(*keys, pos, "gap_ms", "density", reasons.alias("reasons")).where(F.size("reasons") > 0)


def shared_signs(expected: Column, heard: Column) -> Column:
    """The share of the signs of ``expected`` that occur anywhere in ``heard``, blanks and marks apart; null if either is null."""
    clean = lambda c: F.regexp_replace(c, r"[\s　!?！？]", "")
    signs = F.filter(F.split(clean(expected), ""), lambda x: x != "")
    return F.when(expected.isNotNull() & heard.isNotNull(), F.size(F.filter(signs, lambda x: F.contains(clean(heard), x))) / F.greatest(F.size(signs), F.lit(1)))


def covered_share(intervals: DataFrame, covers: DataFrame, keys: list[str], ident: str) -> DataFrame:
    """(ident, covered_ms, share) of intervals (keys, ident, s, e) by covers (keys, s, e), overlaps of covers counted once."""
    whole = merged(covers, keys).withColumnsRenamed({"s": "rs", "e": "re"})
    met = overlaps(intervals, whole, keys).select(ident, overlap_ms().alias("o")).groupBy(ident).agg(F.sum("o").alias("covered_ms"))
    out = intervals.select(ident, "s", "e").join(met, ident, "left").withColumn("covered_ms", F.coalesce("covered_ms", F.lit(0)))
    return out.select(ident, "covered_ms", (F.col("covered_ms") / (F.col("e") - F.col("s"))).alias("share"))


def contained(inner: DataFrame, outer: DataFrame, keys: list[str], tolerance: int) -> DataFrame:
    """Pairs of an inner (keys, s, e, …) and an outer (keys, rs, re, …) interval that holds it, ``tolerance`` over at either end."""
    wide = outer.withColumn("rs", F.col("rs") - tolerance).withColumn("re", F.col("re") + tolerance)
    return overlaps(inner, wide, keys).where((F.col("rs") <= F.col("s")) & (F.col("e") <= F.col("re"))).withColumn("rs", F.col("rs") + tolerance).withColumn("re", F.col("re") - tolerance)


def single_speaker(df: DataFrame, keys: list[str], pos: str, start: str, end: str, label: str) -> DataFrame:
    """(keys…, s, e, label): segments in their order made disjoint: equal labels that meet are merged, others share an overlap at its middle.

    After a shared overlap the later segment's own end holds. Where a segment begins after all ends before it nothing is
    handed on, so the segments are folded from one such place to the next. Times are doubled inside so that middles are whole.
    """
    rows = df.select(*keys, pos, (F.col(start) * 2).alias("s"), (F.col(end) * 2).alias("e"), F.col(label).alias("l")).where("e > s and l is not null")
    rows = carried(rows, keys, pos, F.col("e"), "_reach")
    rows = labelled(rows, keys, pos, F.col("_reach").isNull() | (F.col("s") > F.col("_reach")), "_part").drop("_reach")

    n = len(keys)

    def fold(state, key, row):
        if row is None:
            return None, [(*key[:n], *state)]
        _, s, e, own = row
        if state is None:
            return (s, e, own), []
        begin, reach, other = state
        if s > reach:
            return (s, e, own), [(*key[:n], *state)]
        if own == other:
            return (begin, max(reach, e), own), []
        middle = (s + reach) // 2
        return (middle, e, own), [(*key[:n], begin, middle, other)]

    types = dict(df.dtypes)
    rows = rows.select(*keys, "_part", pos, "s", "e", "l")
    out = per_key(rows, [*keys, "_part"], [pos], fold, ", ".join(f"{k} {types[k]}" for k in keys) + f", s bigint, e bigint, l {types[label]}")
    return out.select(*keys, (F.col("s") / 2).alias("s"), (F.col("e") / 2).alias("e"), F.col("l").alias(label))


def _outermost(found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The (start, end, term) that lie inside no longer one, in order; ones that overlap only in part all stay."""
    out, reach = [], -1
    for x in sorted(found, key=lambda x: (x[0], -x[1])):
        if x[1] > reach:
            out.append(x)
            reach = x[1]
    return out


def mentions(df: DataFrame, key: str, text: str, terms: DataFrame, term: str) -> DataFrame:
    """(key, term): which terms stand in each text, each once per row; an occurrence inside that of a longer term doesn't count.

    Occurrences that overlap only in part all count. The terms are taken in blocks of HELD_TERMS and found by one automaton each, so no text meets
    every term by itself; with several blocks the occurrences of a text, at most one per character and block, are gathered and compared.
    """
    known = terms.select(F.col(term).alias("t")).where(F.coalesce(F.col("t"), F.lit("")) != "").distinct()
    blocks = max(1, -(-known.count() // HELD_TERMS))
    kind = dict(df.dtypes)[key]
    texts = df.select(F.col(key).alias("k"), F.col(text).alias("t")).where(F.col("t").isNotNull())
    spans = "array<struct<s: bigint, e: bigint, term: string>>"
    places = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64()), ("term", pa.string())]))

    def search(source: DataFrame, first: str, kind: str, block: int) -> DataFrame:
        """(first, x) from (first, t): the outermost occurrences of the block's terms in each text that has any."""
        own = [r["t"] for r in known.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == block).collect()]
        held = df.sparkSession.sparkContext.broadcast(own)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import ahocorasick

            automaton = ahocorasick.Automaton()
            for t in held.value:
                automaton.add_word(t, t)
            automaton.make_automaton()
            for batch in batches:
                met = [_outermost([(e + 1 - len(x), e + 1, x) for e, x in automaton.iter(t)]) if held.value else [] for t in batch.column(1).to_pylist()]
                at = [i for i, m in enumerate(met) if m]
                x = pa.array([[{"s": s, "e": e, "term": t} for s, e, t in met[i]] for i in at], places)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), x], names=[first, "x"])

        return source.select(first, "t").mapInArrow(run, f"{first} {kind}, x {spans}")

    if blocks == 1:
        found = search(texts, "k", kind, 0)
        return found.select(F.col("k").alias(key), F.explode(F.array_distinct(F.transform("x", lambda x: x["term"]))).alias("term"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met = [sorted({t for _, _, t in _outermost([(x["s"], x["e"], x["term"]) for b in each for x in b])}) for each in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(met, pa.list_(pa.string()))], names=["h", "terms"])

    marked = texts.withColumn("h", F.sha2("t", 256))
    once = marked.select("h", "t")
    parts = None
    for b in range(blocks):
        made = search(once, "h", "string", b)
        parts = made if parts is None else parts.unionByName(made)
    # equal texts have equal occurrences, so a block gives one list per text
    each = parts.distinct().groupBy("h").agg(F.collect_list("x").alias("xs"))
    final = each.mapInArrow(compare, "h string, terms array<string>")
    return marked.select("k", "h").join(final, "h").select(F.col("k").alias(key), F.explode("terms").alias("term"))


def digests(df: DataFrame, keys: list[str], pos: str, columns: list[str]) -> DataFrame:
    """(keys…, rows, digest): one SHA-256 per key over its rows in order, null told apart from empty.

    Rows are digested, then blocks of DIGEST_BLOCK of their digests, then the blocks', so no key is gathered row by row.
    """
    row = F.sha2(F.to_json(F.array(*[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in columns])), 256)
    rows = numbered(df.select(*keys, pos, row.alias("_d")), keys, pos, "_n").withColumn("_b", F.expr(f"(_n - 1) div {DIGEST_BLOCK}"))
    joined = lambda order: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "_d"))), lambda x: x["_d"]), ""), 256)
    blocks = rows.groupBy(*keys, "_b").agg(joined("_n").alias("_d"), F.count("*").alias("_k"))
    return blocks.groupBy(*keys).agg(F.sum("_k").alias("rows"), joined("_b").alias("digest"))


_BRACES = re.compile(r'"(?:[^"\\]|\\.)*"|[{}]', re.S)


def _enclosed(text: str, at: int) -> str | None:
    """The part of a text from the brace at ``at`` to the one that closes it; braces in quotes don't count."""
    depth = 0
    for m in _BRACES.finditer(text, at):
        depth += {"{": 1, "}": -1}.get(m.group(), 0)
        if depth == 0:
            return text[at : m.end()]
    return None


def parsed_answer(text: str | None) -> tuple[str, float]:
    """(role, confidence) from the first part of a model's answer that is a JSON object; ("REVIEW", 0) if there is none.

    A number over 1 is a percentage; one that is absent, no number or below 0 counts as 0.
    """
    text, at = text or "", -1
    while (at := text.find("{", at + 1)) >= 0:
        try:
            value = json.loads(_enclosed(text, at) or "")
        except ValueError:
            continue
        given = pd.to_numeric(pd.Series([value.get("confidence")]), errors="coerce").fillna(0.0).iloc[0]
        return str(value.get("role", "REVIEW")).strip(), float(np.clip(given / 100 if given > 1 else given, 0.0, 1.0))
    return "REVIEW", 0.0


@F.pandas_udf(StructType([StructField("role", StringType()), StructField("confidence", DoubleType())]))
def answers(texts: pd.Series) -> pd.DataFrame:
    """:func:`parsed_answer` of a column."""
    return pd.DataFrame([parsed_answer(t) for t in texts], columns=["role", "confidence"])


def spoken(c: Column) -> Column:
    """A text without blanks and marks."""
    return F.regexp_replace(c, UNSPOKEN, "")


def expected_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns in their order, missing ones as empty strings; line ends as LF."""
    return df.select(*[T.plain_line_ends(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns])
