"""Schedules in which each row may push the next: closed forms where there are, ordered folds where there aren't."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from subloom.operators.dialogue import labelled
from subloom.operators.ordered import carried, numbered

GAP_MS, WARN_MS, ABORT_MS = 50, 500, 1000


def pushed(df: DataFrame, keys: list[str], pos: str, target: str, length: str, overlap: str | None = None, gap: int = GAP_MS) -> DataFrame:
    """Add ``start``, ``delay`` and ``delay_state``: each row starts at its target or ``gap`` after the end reached so far, whichever is later.

    The end reached is 0 at first and never falls; rows with ``overlap`` keep their target. With a = gap + length (0 for
    overlaps) and A its running sum, the end reached is A + max(0, running max of target + length - A), so two running
    values replace the loop. Null targets or lengths count as 0. delay_state: ``warn`` from 500 ms, ``abort`` over 1000 ms.
    """
    free = F.coalesce(F.col(overlap), F.lit(False)) if overlap else F.lit(False)
    t, d = F.coalesce(F.col(target), F.lit(0)).cast("bigint"), F.coalesce(F.col(length), F.lit(0)).cast("bigint")
    rows = df.withColumn("_t", t).withColumn("_d", d).withColumn("_free", free).withColumn("_a", F.when(F.col("_free"), 0).otherwise(F.col("_d") + gap))
    rows = carried(rows, keys, pos, F.col("_a"), "_sum", "sum").withColumn("_sum", F.coalesce("_sum", F.lit(0)))
    rows = carried(rows, keys, pos, F.col("_t") + F.col("_d") - F.col("_sum") - F.col("_a"), "_max")
    reached = F.col("_sum") + F.greatest(F.lit(0), F.coalesce("_max", F.lit(0)))
    rows = rows.withColumn("start", F.when(F.col("_free"), F.col("_t")).otherwise(F.greatest(F.col("_t"), reached + gap)))
    rows = rows.withColumn("delay", F.col("start") - F.col("_t"))
    state = F.when(F.col("delay") > ABORT_MS, "abort").when(F.col("delay") >= WARN_MS, "warn").otherwise("ok")
    return rows.withColumn("delay_state", state).select(*df.columns, "start", "delay", "delay_state")


def separated(df: DataFrame, keys: list[str], pos: str, start: str, end: str, least: int = 400, gap: int = 33) -> DataFrame:
    """Add ``new_start`` and ``new_end``: no row starts before ``least + gap`` after the one before, each lasts ``least`` or more and ends ``gap`` before the next.

    With k = least + gap and i the row's number, new_start is k*i + the running max of start - k*i.
    """
    k = least + gap
    rows = numbered(df, keys, pos, "_i").withColumn("_x", F.col(start) - k * F.col("_i"))
    rows = carried(rows, keys, pos, F.col("_x"), "_max").withColumn("new_start", k * F.col("_i") + F.greatest("_x", F.coalesce("_max", F.col("_x"))))
    rows = carried(rows.withColumn("_back", -F.col("_i")), keys, "_back", F.struct("_back", "new_start"), "_next")
    lasting = F.greatest(F.col(end), F.col("new_start") + least)
    return rows.withColumn("new_end", F.least(lasting, F.coalesce(F.col("_next.new_start") - gap, lasting))).select(*df.columns, "new_start", "new_end")


def per_key(df: DataFrame, keys: list[str], order: list[str], fold, schema: str) -> DataFrame:
    """A fold over the sorted rows of each key, fed batch by batch: a task holds one batch and the fold's state, not a whole key.

    ``fold`` gets the state (None at first), the key and the row's other columns, or None after the last row, and returns the new state and the rows to emit, all as tuples.
    """
    others = [c for c in df.columns if c not in keys]
    rows = df.select(*keys, *others).repartition(*keys).sortWithinPartitions(*keys, *order)
    width, out_schema = len(keys), to_arrow_schema(T.StructType.fromDDL(schema))

    def made(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out) if out else [()] * len(out_schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out_schema)], names=out_schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                key = row[:width]
                if key != now:
                    if state is not None:
                        out += fold(state, now, None)[1]
                    now, state = key, None
                state, more = fold(state, key, row[width:])
                out += more
            yield made(out)
        if state is not None:
            yield made(fold(state, now, None)[1])

    return rows.mapInArrow(run, schema)


def pushed_with_escape(df: DataFrame, keys: list[str], pos: str, target: str, length: str, hard: str, gap: int = GAP_MS, most: int = ABORT_MS) -> DataFrame:
    """(keys…, pos, start, manual): as :func:`pushed`, but a row that would be late by more than ``most``, or at all if ``hard``, is left to be placed by hand
    and pushes nothing.

    A row that :func:`pushed` doesn't delay isn't delayed here either, for rows that push nothing only lower the end
    reached; so the rows are folded from one such row to the next, each stretch by itself.
    """
    rows = pushed(df.select(*keys, pos, target, length, hard), keys, pos, target, length, None, gap)
    rows = labelled(rows, keys, pos, F.col("delay") == 0, "_chain")

    n = len(keys)

    def fold(reached, key, row):
        if row is None:
            return None, []
        place, at, size, fixed = row
        start = max(at, (reached or 0) + gap)
        if start - at > most or (fixed and start > at):
            return reached or 0, [(*key[:n], place, at, True)]
        return max(reached or 0, start + size), [(*key[:n], place, start, False)]

    rows = rows.select(*keys, "_chain", pos, F.coalesce(target, F.lit(0)).cast("bigint").alias("t"), F.coalesce(length, F.lit(0)).cast("bigint").alias("d"), F.coalesce(hard, F.lit(False)).alias("h"))
    types = dict(df.dtypes)
    return per_key(rows, [*keys, "_chain"], [pos], fold, ", ".join(f"{c} {types[c]}" for c in [*keys, pos]) + ", start bigint, manual boolean")


def chunks(df: DataFrame, keys: list[str], pos: str, start: str, end: str, soft: int = 12_000, pause: int = 500, hard: int = 25_000, margin: int = 2_000) -> DataFrame:
    """(keys…, chunk_start, chunk_end, n): rows in their order gathered into chunks, cut at a pause of ``pause`` after ``soft`` or in any case after ``hard``.

    A pause of ``hard`` always cuts, so the rows are folded from one such pause to the next.
    """

    n = len(keys)

    def fold(state, key, row):
        close = lambda x: [(*key[:n], max(0, x[0] - margin), x[1] + margin, x[2])]
        if row is None:
            return None, close(state)
        _, s, e = row
        if state is None:
            return (s, e, 1), []
        begin, reach, count = state
        if (reach - begin >= soft and s - reach >= pause) or e - begin >= hard:
            return (s, e, 1), close(state)
        return (begin, max(reach, e), count + 1), []

    rows = df.select(*keys, pos, F.col(start).cast("bigint").alias("s"), F.col(end).cast("bigint").alias("e")).where("e > s")
    rows = carried(rows, keys, pos, F.col("e"), "_reach")
    rows = labelled(rows, keys, pos, F.col("_reach").isNull() | (F.col("s") - F.col("_reach") >= hard), "_part").drop("_reach")
    types = dict(df.dtypes)
    return per_key(rows.select(*keys, "_part", pos, "s", "e"), [*keys, "_part"], [pos], fold, ", ".join(f"{c} {types[c]}" for c in keys) + ", chunk_start bigint, chunk_end bigint, n bigint")
