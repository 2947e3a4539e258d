"""Continuous periods and gaps of time intervals per entity, without a whole entity in one task.

The intervals of each block of an entity's time line are merged by themselves, in the one window over them; then only the merged
stretches take over the running maximum of earlier ends from block to block (see :mod:`subloom.operators.ordered`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subloom.operators.ordered import BITS, carry_over
from subloom.session import checkpointed, joined, require_columns


def sound_intervals(df: DataFrame, entity: str, start: str, end: str) -> DataFrame:
    """(entity, start, end) as BIGINT of the rows with both bounds present, end after start, entity present."""
    require_columns(df, entity, start, end)
    return df.select(F.col(entity).alias("_e"), F.col(start).cast("bigint").alias("_s"), F.col(end).cast("bigint").alias("_t")).where(
        F.col("_e").isNotNull() & (F.col("_t") > F.col("_s"))
    )


def stretches(df: DataFrame, keys: list[str], bridge: int = 0) -> DataFrame:
    """(keys…, s, e, reach): the intervals (keys, s, e) merged where they overlap, touch or leave at most ``bridge``; reach: the end before, null for the first.

    Bounds are BIGINT, each end after its start. The blocks' merged stretches are written once.
    """
    rows = df.groupBy(*keys, "s").agg(F.max("e").alias("e")).withColumn("_b", F.shiftright("s", BITS))
    w = Window.partitionBy(*keys, "_b").orderBy("s")
    rows = rows.withColumn("_r", F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    opens = F.col("_r").isNull() | (F.col("s") > F.col("_r") + bridge)
    rows = rows.withColumn("_n", F.sum(opens.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    own = checkpointed(rows.groupBy(*keys, "_b", "_n").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.max(F.when(opens, F.col("_r"))).alias("_r")).drop("_n"))
    # what earlier blocks reach can only swallow the first stretches of a block
    own = joined(own, carry_over(own.groupBy(*keys, "_b").agg(F.max("e").alias("_m0")), keys, ["max"]), [*keys, "_b"])
    own = own.withColumn("reach", F.greatest("_r", "_carry0")).drop("_r", "_carry0")
    own = own.withColumn("_open", F.col("reach").isNull() | (F.col("s") > F.col("reach") + bridge))
    opened = own.groupBy(*keys, "_b").agg(F.max(F.when(F.col("_open"), F.col("s"))).alias("_m0"))
    own = joined(own, carry_over(opened, keys, ["max"]), [*keys, "_b"])
    own = own.withColumn("_i", F.when(F.col("_open"), F.col("s")).otherwise(F.col("_carry0")))
    whole = own.groupBy(*keys, "_i").agg(F.max("e").alias("e"), F.max(F.when(F.col("_open"), F.col("reach"))).alias("reach"))
    return whole.select(*keys, F.col("_i").alias("s"), "e", "reach")


def periods_and_gaps(df: DataFrame, entity: str = "episode", start: str = "start", end: str = "end", max_gap: int | None = None) -> DataFrame:
    """Merge overlapping, nested and touching intervals of each entity and list the gaps between them.

    Returns (entity, kind, start_ms, end_ms): kind ``period`` for each longest stretch covered without a
    break, kind ``gap`` for the uncovered stretch between two consecutive periods, if shorter than
    ``max_gap`` (None: all). Rows with a null entity, a null bound or an end not after the start are left
    out; repeated rows change nothing; other columns are ignored. An empty table gives no rows.
    """
    rows = sound_intervals(df, entity, start, end).withColumnsRenamed({"_s": "s", "_t": "e"})
    islands = stretches(rows, ["_e"])
    short = F.col("reach").isNotNull() if max_gap is None else (F.col("reach").isNotNull() & (F.col("s") - F.col("reach") < max_gap))
    kinds = F.array(
        F.struct(F.lit("period").alias("kind"), F.col("s").alias("start_ms"), F.col("e").alias("end_ms")),
        F.when(short, F.struct(F.lit("gap").alias("kind"), F.col("reach").alias("start_ms"), F.col("s").alias("end_ms"))),
    )
    return islands.select(F.col("_e").alias(entity), F.explode(F.array_compact(kinds)).alias("k")).select(entity, "k.kind", "k.start_ms", "k.end_ms")
