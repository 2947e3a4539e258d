"""Joins and arithmetic of time intervals per entity, by cells of the time line instead of all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subloom.operators.islands import stretches
from subloom.operators.ordered import carried, carried_together
from subloom.session import joined

#: Width of a cell of the time line in milliseconds.
CELL = 10_000


def _cells(df: DataFrame, start: str, end: str, cell: int) -> DataFrame:
    """One row per cell that [start, end) touches; a point touches one."""
    last = F.greatest(F.col(end) - 1, F.col(start))
    return df.withColumn("_cell", F.explode(F.sequence(F.floor(F.col(start) / cell), F.floor(last / cell))))


def overlaps(left: DataFrame, right: DataFrame, keys: list[str], cell: int = CELL, inclusive: bool = False) -> DataFrame:
    """Pairs of a left (keys, s, e, …) and a right (keys, rs, re, …) interval that overlap, each pair once.

    Both sides are laid out over the cells they touch and joined by key and cell; a pair is emitted only in the cell in which its
    overlap begins. ``inclusive``: intervals that touch count as well. Rows with a null key or bound have no partner.
    """
    grow = 1 if inclusive else 0
    a = _cells(left.where(F.col("s").isNotNull() & F.col("e").isNotNull()).withColumn("_e", F.col("e") + grow), "s", "_e", cell)
    b = _cells(right.where(F.col("rs").isNotNull() & F.col("re").isNotNull()).withColumn("_re", F.col("re") + grow), "rs", "_re", cell)
    met = a.join(b, [*keys, "_cell"]).where((F.col("s") < F.col("_re")) & (F.col("rs") < F.col("_e")))
    return met.where(F.col("_cell") == F.floor(F.greatest("s", "rs") / cell)).drop("_cell", "_e", "_re")


def overlap_ms() -> Column:
    return F.greatest(F.least("e", "re") - F.greatest("s", "rs"), F.lit(0))


def dominant(pairs: DataFrame, ids: list[str], speaker: str, share: float = 0.7) -> DataFrame:
    """(ids…, speaker, overlap, total, ratio, state) from pairs with an ``overlap``: the speaker with most overlap, ties by name.

    state: ``single`` for one speaker, ``dominant`` from ``share`` of the total, else ``multiple``.
    """
    by = pairs.groupBy(*ids, speaker).agg(F.sum("overlap").alias("overlap"))
    top = by.groupBy(*ids).agg(F.min(F.struct((-F.col("overlap")).alias("o"), F.col(speaker).alias("n"))).alias("_t"), F.sum("overlap").alias("total"), F.count("*").alias("_n"))
    out = top.select(*ids, F.col("_t.n").alias(speaker), (-F.col("_t.o")).alias("overlap"), "total", ((-F.col("_t.o")) / F.col("total")).alias("ratio"), "_n")
    return out.withColumn("state", F.when(F.col("_n") == 1, "single").when(F.col("ratio") >= share, "dominant").otherwise("multiple")).drop("_n")


def merged(df: DataFrame, keys: list[str], bridge: int = 0, least: int = 0) -> DataFrame:
    """(keys…, s, e): intervals (keys, s, e) merged where they overlap, touch or leave at most ``bridge``; shorter than ``least`` dropped."""
    return stretches(df.where("e > s"), keys, bridge).where(F.col("e") - F.col("s") >= least).select(*keys, "s", "e")


def subtracted(regions: DataFrame, covers: DataFrame, keys: list[str], region: str, cell: int = CELL) -> DataFrame:
    """(keys…, region, s, e): what of each region (keys, region, s, e) no cover (keys, s, e) covers. A region stands once for its key.

    Merged covers know the end of the one before, so what is free before a cover follows from the pair, and what is free after the last one from its end.
    """
    whole = stretches(covers.where("e > s"), keys).withColumnsRenamed({"s": "rs", "e": "re"})
    ids = [*keys, region]
    met = overlaps(regions.select(*ids, "s", "e"), whole, keys, cell)
    before = met.select(*ids, F.greatest("s", "reach").alias("s"), F.col("rs").alias("e"))  # the greatest leaves out a null
    last = met.groupBy(*ids).agg(F.max("re").alias("_re"))
    after = joined(regions.select(*ids, "s", "e"), last, ids, "left").select(*ids, F.coalesce("_re", "s").alias("s"), "e")
    return before.unionByName(after).where("e > s")


def previous_and_next(points: DataFrame, intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``prev_end`` (of the interval (keys, id, s, e) that ends last at or before the point ``p``) and ``next_start`` (that starts first at or after it), with ids.

    Points and ends are ordered together; only the latest end and the earliest start are carried along the line.
    """
    ends = intervals.groupBy(*keys, F.col("e").alias("at")).agg(F.min("id").alias("id"))
    starts = intervals.groupBy(*keys, F.col("s").alias("at")).agg(F.min("id").alias("id"))
    spots = points.select(*keys, F.col("p").alias("at")).distinct()

    def nearest(marks: DataFrame, sign: int, out: str) -> DataFrame:
        # an odd place for points, an even one for marks: a mark at a point's time comes before it in either direction
        line = marks.select(*keys, (F.col("at") * 2 * sign).alias("pos"), F.struct("at", "id").alias("m")).unionByName(
            spots.select(*keys, (F.col("at") * 2 * sign + 1).alias("pos"), F.lit(None).cast("struct<at:bigint,id:bigint>").alias("m"))
        )
        last = carried(line, keys, "pos", F.when(F.col("m").isNotNull(), F.struct("pos", "m")), "_l")
        return last.where(F.col("m").isNull()).select(*keys, ((F.col("pos") - 1) / 2 * sign).cast("bigint").alias("p"), F.col("_l.m").alias(out))

    both = nearest(ends, 1, "_a").join(nearest(starts, -1, "_b"), [*keys, "p"])
    made = both.select(*keys, "p", F.col("_a.at").alias("prev_end"), F.col("_a.id").alias("prev_id"), F.col("_b.at").alias("next_start"), F.col("_b.id").alias("next_id"))
    return points.join(made, [*keys, "p"], "left")


def islands_at(df: DataFrame, voice: DataFrame, energy: DataFrame, keys: list[str], ident: str) -> DataFrame:
    """(keys…, ident, voice_start, voice_end, energy_start, energy_end): the islands (keys, rs, re) of two kinds that belong to each interval (keys, ident, s, e).

    Of the voice the first island that holds s + 150 ms; of the energy the last one that begins by e + 100 ms and, where there is such a voice island,
    comes within 200 ms of it. Energy islands are disjoint, as :func:`merged` makes them.
    """
    rows = df.select(*keys, ident, "s", "e")
    at = F.col("s") + 150
    held = overlaps(rows.select(*keys, ident, at.alias("s"), at.alias("e")), voice.select(*keys, "rs", "re"), keys, inclusive=True)
    first = held.groupBy(*keys, ident).agg(F.min(F.struct("rs", "re")).alias("_v"))
    by = F.col("e") + 100
    points = rows.join(first, [*keys, ident], "left").withColumn("p", F.least(by, F.col("_v.re") + 200))
    # the latest start at or before the point, with its island's end
    found = previous_and_next(points, energy.select(*keys, F.col("re").alias("id"), F.col("rs").alias("s"), F.col("rs").alias("e")), keys)
    near = F.col("_v").isNull() | (F.col("prev_id") >= F.col("_v.rs") - 200)
    return found.select(*keys, ident, F.col("_v.rs").alias("voice_start"), F.col("_v.re").alias("voice_end"), F.when(near, F.col("prev_end")).alias("energy_start"), F.when(near, F.col("prev_id")).alias("energy_end"))


def depth(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys…, s, e, depth): the stretches between consecutive bounds of intervals (keys, s, e) and how many cover each; zero depth left out."""
    ends = df.where("e > s").select(*keys, F.explode(F.array(F.struct(F.col("s").alias("at"), F.lit(1).alias("d")), F.struct(F.col("e").alias("at"), F.lit(-1).alias("d")))).alias("x"))
    steps = ends.groupBy(*keys, "x.at").agg(F.sum("x.d").cast("bigint").alias("d"))
    line = carried_together(steps, keys, "at", {"depth": (F.col("d"), "sum"), "s": (F.col("at"), "max")})
    return line.where("depth > 0").select(*keys, "s", F.col("at").alias("e"), "depth")


def runs_of_frames(df: DataFrame, keys: list[str], frame: str, bridge: int, least: int) -> DataFrame:
    """(keys…, first, last, frames): runs of frame numbers, gaps of up to ``bridge`` missing frames bridged, runs of fewer than ``least`` frames dropped."""
    spans = df.select(*keys, F.col(frame).cast("bigint").alias("s"), (F.col(frame).cast("bigint") + 1).alias("e")).distinct()
    return merged(spans, keys, bridge, least).select(*keys, F.col("s").alias("first"), (F.col("e") - 1).alias("last"), (F.col("e") - F.col("s")).alias("frames"))
