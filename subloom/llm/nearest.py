"""Pairs of records nearest in time within a tolerance, for the same entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subloom.session import present, require_columns

#: Microseconds; both sides are compared on this grid.
MS = 1000


def nearest_in_time(
    left: DataFrame,
    right: DataFrame,
    keys: list[tuple[str, str]],
    left_id: str,
    left_ms: str,
    right_id: str,
    right_seconds: str,
    tolerance_ms: int = 500,
) -> DataFrame:
    """(left_id, right_id) of each left row and the right row nearest to it in time, if within the tolerance.

    The distinct right times of an entity become neighbour intervals, bounded by the midpoints to the times
    before and after and by the tolerance; each left time lies in at most one of them. The intervals are indexed
    by the cells of width 2 * tolerance that they touch, and left times look them up by entity and cell.

    Of right rows at the same time the smallest id counts; exactly between two times the earlier one counts.
    Rows with a missing key, time or id have no partner, right rows without a partner don't appear; repeated left rows each
    count. Neighbours farther than 2 * tolerance can't bound an interval, so they are looked for in cells of the
    time line, each with a margin of that size, never over a whole entity. Other columns are ignored.
    """
    require_columns(left, left_id, left_ms, *[a for a, _ in keys])
    require_columns(right, right_id, right_seconds, *[b for _, b in keys])
    tol = tolerance_ms * MS
    cell = 2 * tol
    block = 32 * cell
    names = [f"_k{i}" for i in range(len(keys))]
    keyed = lambda df, side: [F.col(pair[side]).cast("string").alias(n) for pair, n in zip(keys, names)]
    ok = F.lit(True)
    for n in names:
        ok = ok & present(F.col(n))
    us = F.expr(f"try_cast(round(`{right_seconds}` * 1000000) as bigint)")
    times = (
        right.select(*keyed(right, 1), us.alias("_t"), F.col(right_id).alias("_rid"))
        .where(ok & F.col("_t").isNotNull() & F.col("_rid").isNotNull())
        .groupBy(*names, "_t")
        .agg(F.min("_rid").alias("_rid"))
    )
    floor = lambda c, width: F.expr(f"{c} div {width} - if({c} % {width} < 0, 1, 0)")
    marked = times.withColumn("_own", floor("_t", block)).withColumn(
        "_blk", F.explode(F.array_distinct(F.array("_own", floor(f"(_t - {cell})", block), floor(f"(_t + {cell})", block))))
    )
    w = Window.partitionBy(*names, "_blk").orderBy("_t")
    bounded = (
        marked.withColumn("_prev", F.lag("_t").over(w))
        .withColumn("_next", F.lead("_t").over(w))
        .where(F.col("_blk") == F.col("_own"))
        # twice the time, so that midpoints are whole: prev + t < 2x <= t + next
        .withColumn("_lo", F.greatest(2 * (F.col("_t") - tol) - 1, F.coalesce(F.col("_prev") + F.col("_t"), F.lit(-(2**62)))))
        .withColumn("_hi", F.least(2 * (F.col("_t") + tol), F.coalesce(F.col("_t") + F.col("_next"), F.lit(2**62))))
    )
    index = bounded.select(*names, "_rid", "_lo", "_hi", F.explode(F.sequence(floor("_lo", 2 * cell), floor("_hi", 2 * cell))).alias("_cell"))
    points = (
        left.select(*keyed(left, 0), F.col(left_id).alias("_lid"), (F.col(left_ms).cast("bigint") * (2 * MS)).alias("_x"))
        .where(ok & F.col("_x").isNotNull() & F.col("_lid").isNotNull())
        .withColumn("_cell", floor("_x", 2 * cell))
    )
    inside = (F.col("_lo") < F.col("_x")) & (F.col("_x") <= F.col("_hi"))
    return points.join(index, [*names, "_cell"]).where(inside).select(F.col("_lid").alias(left_id), F.col("_rid").alias(right_id))
