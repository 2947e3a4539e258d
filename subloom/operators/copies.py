"""Differences between two copies of the same rows, found through a checksum matrix."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subloom.session import checkpointed

#: Buckets of keys, unless the caller gives another number: more than most tables have keys, so that few equal keys share a bucket with an unequal one.
BUCKETS = 1 << 32
#: Up to so many unequal buckets are sent to every worker, so that equal rows aren't exchanged.
HELD_BUCKETS = 500_000


def plain_text(c: Column) -> Column:
    """Null as the empty string, every line end as LF."""
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), "\r\n?", "\n")


def key_hash(keys: list[str]) -> Column:
    """The hash of a key; which of its parts are null is hashed as well, since the hash function passes nulls over."""
    return F.xxhash64(*keys, *[F.col(k).isNull() for k in keys])


def _matrix(sides: list[DataFrame], keys: list[str], columns: list[str], buckets: int) -> DataFrame:
    """(_bucket, _u0, _u1, …): the unequal buckets of keys, and which cells of keys and columns are unequal in them.

    A cell is the sum of two 64-bit hashes, each in halves so that no sum overflows, over the distinct rows of the left side less that over those of
    the right: only hashes are exchanged here, one row of them per row, equal rows within a task once. A row that both sides have adds
    nothing to any cell, so only the others are summed. A column's sum is 0 only if the same (key, value) pairs occur as often among the distinct rows
    of either side, so cells of 0 hold no difference; repeats that disagree can at most make a cell look unequal.
    """
    key = key_hash(keys)
    values = [F.xxhash64(F.lit(i), key, plain_text(F.col(c))).alias(f"_v{i}") for i, c in enumerate(columns)]
    narrow = [df.select(key.alias("_k"), *values, F.lit(side).alias("_side")) for side, df in enumerate(sides)]
    # the keys' own sums tell keys apart that only one side has
    cells = ["_k", *[f"_v{i}" for i in range(len(columns))]]
    both = narrow[0].unionByName(narrow[1]).groupBy(*cells).agg(F.max((F.col("_side") == 0).cast("int")).alias("_l"), F.max(F.col("_side")).alias("_r"))
    lone = both.where(F.col("_l") != F.col("_r")).withColumn("_sign", F.col("_l") - F.col("_r"))
    halves = []
    for i, c in enumerate(cells):
        for seed in (1, 2):
            h = F.xxhash64(F.lit(seed), "_k", c)
            halves += [F.sum(F.col("_sign") * part).alias(f"_s{i}{seed}{n}") for n, part in enumerate((F.shiftright(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF))))]
    sums = lone.groupBy(F.pmod("_k", F.lit(buckets)).alias("_bucket")).agg(*halves)
    unequal = [reduce(lambda a, b: a | b, [F.col(f"_s{i}{seed}{n}") != 0 for seed in (1, 2) for n in (0, 1)]) for i in range(len(cells))]
    return sums.select("_bucket", *[u.alias(f"_u{i}") for i, u in enumerate(unequal)]).where(reduce(lambda a, b: a | b, [F.col(f"_u{i}") for i in range(len(cells))]))


def differences(left: DataFrame, right: DataFrame, keys: list[str], columns: dict[str, tuple[str, str]], names=("left", "right"), buckets: int = BUCKETS) -> DataFrame:
    """Rows missing on either side and fields that differ: (keys…, difference).

    ``columns`` maps a field's name to its column on the left and on the right. ``difference`` is
    ``missing_in_<left>``, ``missing_in_<right>`` or a field's name. Null equals the empty string and CRLF or CR
    equals LF; any other difference counts. Each key counts once however often its row is repeated; if the
    repeats of a key disagree, a field differs unless both sides hold the same set of values. Null keys are keys
    like any other. Other columns are ignored.

    Both sides are summed into a matrix of column by bucket of keys; values are read and compared only for the
    cells of which the sums differ, as (column, key, value) rows in one exchange, so a hot key or bucket is
    pre-aggregated and no group is gathered.
    """
    sides = [
        (df.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], *[F.col(pair[side]).alias(f"_col{i}") for i, pair in enumerate(columns.values())]))
        for side, df in enumerate((left, right))
    ]
    keyed = [f"_key{i}" for i in range(len(keys))]
    tags = {tag: f"_col{i}" for i, tag in enumerate(columns)}
    unequal = checkpointed(_matrix(sides, keyed, list(tags.values()), buckets))
    if unequal.count() <= HELD_BUCKETS:  # else rows and unequal buckets meet by an exchange
        unequal = F.broadcast(unequal)
    located = []
    for side, df in enumerate(sides):
        bucket = F.pmod(key_hash(keyed), F.lit(buckets))
        # the key itself comes along from every unequal bucket, a value only from the unequal cells
        entries = [F.struct(F.lit("").alias("column"), F.lit("").alias("_v"))] + [
            F.when(F.col(f"_u{i + 1}"), F.struct(F.lit(t).alias("column"), plain_text(F.col(c)).alias("_v"))) for i, (t, c) in enumerate(tags.items())
        ]
        hit = df.withColumn("_bucket", bucket).join(unequal, "_bucket")
        located.append(hit.select(*keyed, F.explode(F.array_compact(F.array(*entries))).alias("_e")).select(*keyed, "_e.column", "_e._v", F.lit(side).alias("_side")))
    values = located[0].unionByName(located[1]).groupBy(*keyed, "column", "_v").agg(F.max((F.col("_side") == 0).cast("int")).alias("_l"), F.max((F.col("_side") == 1).cast("int")).alias("_r"))
    per_key = values.groupBy(*keyed).agg(
        F.max("_l").alias("_l"),
        F.max("_r").alias("_r"),
        *[F.max(F.when((F.col("column") == t) & (F.col("_l") != F.col("_r")), 1).otherwise(0)).alias(f"_d{i}") for i, t in enumerate(columns)],
    )
    found = F.when(F.col("_l") == 0, F.array(F.lit(f"missing_in_{names[0]}"))).when(F.col("_r") == 0, F.array(F.lit(f"missing_in_{names[1]}"))).otherwise(
        F.array_compact(F.array(*[F.when(F.col(f"_d{i}") == 1, F.lit(t)) for i, t in enumerate(columns)]))
    )
    return per_key.select(*[F.col(f"_key{i}").alias(k) for i, k in enumerate(keys)], F.explode(found).alias("difference"))
