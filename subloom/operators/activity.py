"""Audio activity of stems against each other and against cues, on intervals of a time line in milliseconds.

Activity is (keys…, stem, s, e), cues are (keys…, ident, s, e), BIGINT bounds; intervals whose end isn't after their start and rows
with a null bound count for nothing. All joins go over cells of the time line (:mod:`subloom.operators.spans`), and stretches are merged
block by block, so neither a long stem nor a stem of all rows is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subloom.operators.evidence import contained
from subloom.operators.spans import merged, overlap_ms, overlaps, previous_and_next, subtracted
from subloom.session import checkpointed

#: The share of the time line above which a stem is too dense, and above which two stems speak at once too often.
DENSE, TOGETHER = 0.60, 0.10


def activity_ratios(activity: DataFrame, keys: list[str], stem: str, most: float = DENSE) -> DataFrame:
    """(keys…, stem, active_ms, ratio, state): how much of the time up to the last end of its key a stem is active; ``dense`` above ``most``, else ``passed``."""
    own = merged(activity, [*keys, stem]).groupBy(*keys, stem).agg(F.sum(F.col("e") - F.col("s")).alias("active_ms"))
    whole = activity.where("e > s").groupBy(*keys).agg(F.max("e").alias("_w"))
    out = own.join(whole, keys).withColumn("ratio", F.col("active_ms") / F.col("_w"))
    return out.select(*keys, stem, "active_ms", "ratio", F.when(F.col("ratio") > most, "dense").otherwise("passed").alias("state"))


def _together(activity: DataFrame, keys: list[str], stem: str) -> DataFrame:
    """(keys…, stem_a, stem_b, s, e): where two stems of a key are active at once, stem_a before stem_b; pieces of a pair are disjoint."""
    whole = merged(activity, [*keys, stem])
    left = whole.withColumnRenamed(stem, "stem_a")
    right = whole.withColumnsRenamed({stem: "stem_b", "s": "rs", "e": "re"})
    met = overlaps(left, right, keys).where("stem_a < stem_b")
    return met.select(*keys, "stem_a", "stem_b", F.greatest("s", "rs").alias("s"), F.least("e", "re").alias("e"))


def shared_activity(activity: DataFrame, keys: list[str], stem: str, most: float = TOGETHER) -> DataFrame:
    """(keys…, stem_a, stem_b, shared_ms, ratio, state): how much of the time line two stems are active at once; pairs that never are have no row."""
    both = _together(activity, keys, stem).groupBy(*keys, "stem_a", "stem_b").agg(F.sum(F.col("e") - F.col("s")).alias("shared_ms"))
    whole = activity.where("e > s").groupBy(*keys).agg(F.max("e").alias("_w"))
    out = both.join(whole, keys).withColumn("ratio", F.col("shared_ms") / F.col("_w"))
    return out.select(*keys, "stem_a", "stem_b", "shared_ms", "ratio", F.when(F.col("ratio") > most, "overlapping").otherwise("passed").alias("state"))


def joint_activity(activity: DataFrame, keys: list[str], stem: str, bridge: int = 80, least: int = 80) -> DataFrame:
    """(keys…, stem_a, stem_b, s, e, active_ms): stretches in which two stems are active at once, pauses up to ``bridge`` within them, with ``least`` active or more."""
    pieces = _together(activity, keys, stem)
    pair = [*keys, "stem_a", "stem_b"]
    groups = merged(pieces, pair, bridge).withColumnsRenamed({"s": "rs", "e": "re"})
    inside = overlaps(pieces, groups, pair).groupBy(*pair, "rs", "re").agg(F.sum(F.col("e") - F.col("s")).alias("active_ms"))
    return inside.where(F.col("active_ms") >= least).select(*pair, F.col("rs").alias("s"), F.col("re").alias("e"), "active_ms")


def unreviewed(found: DataFrame, reviews: DataFrame, keys: list[str], ident: list[str], accepted: Column, tolerance: int = 40) -> DataFrame:
    """The rows of ``found`` (keys…, ident…, s, e) that no review (keys…, s, e) that is ``accepted`` contains, ``tolerance`` over at either end."""
    good = reviews.where(F.coalesce(accepted, F.lit(False))).select(*keys, F.col("s").alias("rs"), F.col("e").alias("re"))
    held = contained(found.select(*keys, *ident, "s", "e"), good, keys, tolerance).select(*keys, *ident, "s", "e").distinct()
    return found.join(held, [*keys, *ident, "s", "e"], "left_anti")


def missed_cues(cues: DataFrame, activity: DataFrame, keys: list[str], ident: str, least: int = 60, tolerance: int = 500) -> DataFrame:
    """(keys…, ident, active_ms): cues around which, ``tolerance`` over at either end, there is less than ``least`` of activity of any stem."""
    wide = cues.where("e > s").select(*keys, ident, F.greatest(F.col("s") - tolerance, F.lit(0)).alias("s"), (F.col("e") + tolerance).alias("e"))
    whole = merged(activity, keys).withColumnsRenamed({"s": "rs", "e": "re"})
    met = overlaps(wide, whole, keys).select(*keys, ident, overlap_ms().alias("o")).groupBy(*keys, ident).agg(F.sum("o").alias("_o"))
    out = wide.select(*keys, ident).join(met, [*keys, ident], "left").withColumn("active_ms", F.coalesce("_o", F.lit(0)).cast("bigint"))
    return out.where(F.col("active_ms") < least).select(*keys, ident, "active_ms")


def off_cue_activity(activity: DataFrame, cues: DataFrame, keys: list[str], tolerance: int = 500, most: float = 0.10) -> DataFrame:
    """(keys…, active_ms, off_ms, ratio, state): how much of a key's activity lies outside all cues, ``tolerance`` over at either end; ``excessive`` above ``most``."""
    whole = merged(activity, keys).withColumn("_region", F.col("s"))
    covers = cues.where("e > s").select(*keys, F.greatest(F.col("s") - tolerance, F.lit(0)).alias("s"), (F.col("e") + tolerance).alias("e"))
    off = subtracted(whole, covers, keys, "_region").groupBy(*keys).agg(F.sum(F.col("e") - F.col("s")).alias("_off"))
    total = whole.groupBy(*keys).agg(F.sum(F.col("e") - F.col("s")).alias("active_ms"))
    out = total.join(off, keys, "left").withColumn("off_ms", F.coalesce("_off", F.lit(0)).cast("bigint")).withColumn("ratio", F.col("off_ms") / F.col("active_ms"))
    return out.select(*keys, "active_ms", "off_ms", "ratio", F.when(F.col("ratio") > most, "excessive").otherwise("passed").alias("state"))


def onset_faults(cues: DataFrame, activity: DataFrame, keys: list[str], stem: str, join: int = 250, tolerance: int = 500) -> DataFrame:
    """(keys…, stem, s, reason) of the acoustic turns whose start no activity of the stem begins near.

    Cues (keys…, stem, s, e) of a stem that follow within ``join`` are one turn. reason: ``no_activity`` within ``tolerance`` of its start, or ``already_active`` where
    the stem has been active since before that time and at its begin.
    """
    ids = [*keys, stem]
    turns = merged(cues, ids, join)
    near = turns.select(*ids, F.col("s").alias("at"), F.greatest(F.col("s") - tolerance, F.lit(0)).alias("s"), (F.col("s") + tolerance).alias("e"))
    whole = merged(activity, ids).withColumnsRenamed({"s": "rs", "e": "re"})
    met = overlaps(near, whole, ids).groupBy(*ids, "at").agg(F.max((F.col("rs") < F.col("s")) & (F.col("s") > 0)).alias("_before"))
    out = near.select(*ids, "at").join(met, [*ids, "at"], "left")
    reason = F.when(F.col("_before").isNull(), "no_activity").when(F.col("_before"), "already_active")
    return out.select(*ids, F.col("at").alias("s"), reason.alias("reason")).where("reason is not null")


def unassigned_activity(activity: DataFrame, cues: DataFrame, keys: list[str], ident: str, around: int = 2000, bridge: int = 80, least: int = 60, tolerance: int = 40) -> DataFrame:
    """(keys…, s, e, previous_cue, next_cue): activity near the cues of a key that no cue covers.

    Activity is merged over pauses of ``bridge``, and only looked at from ``around`` before the first cue to ``around`` after the last; what is left beside
    the cues, ``tolerance`` over at either end, counts from ``least`` on. The cue before is the one that ends last by the begin of the stretch, the cue after the
    one that starts first from its end on, each by ``tolerance``.
    """
    sound = cues.where("e > s")
    frame = sound.groupBy(*keys).agg(F.greatest(F.min("s") - around, F.lit(0)).alias("_a"), (F.max("e") + around).alias("_z"))
    regions = merged(activity, keys, bridge, least).join(frame, keys)
    regions = regions.select(*keys, F.col("s").alias("_region"), F.greatest("s", "_a").alias("s"), F.least("e", "_z").alias("e")).where(F.col("e") - F.col("s") >= least)
    covers = sound.select(*keys, F.greatest(F.col("s") - tolerance, F.lit(0)).alias("s"), (F.col("e") + tolerance).alias("e"))
    free = subtracted(regions, covers, keys, "_region").where(F.col("e") - F.col("s") >= least).drop("_region")
    marks = sound.select(*keys, F.col(ident).alias("id"), "s", "e")
    free = checkpointed(free)  # read three times
    spots = free.select(*keys, F.explode(F.array(F.col("s") + tolerance, F.col("e") - tolerance)).alias("p")).distinct()
    found = previous_and_next(spots, marks, keys)
    before = found.select(*keys, (F.col("p") - tolerance).alias("s"), F.col("prev_id").alias("previous_cue"))
    after = found.select(*keys, (F.col("p") + tolerance).alias("e"), F.col("next_id").alias("next_cue"))
    return free.join(before, [*keys, "s"]).join(after, [*keys, "e"]).select(*keys, "s", "e", "previous_cue", "next_cue")
