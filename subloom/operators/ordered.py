"""Running values, numbers and neighbours of ordered rows per key, without a whole key in one task.

Positions are integers that occur once per key. The line of positions is cut into blocks of 2**20; what one block
hands on to the next is carried over a tree of blocks, 4096 children per node. Every window then sorts a group whose
size is bounded by the block width, whatever share of all rows a key holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subloom.session import checkpointed, joined

#: Bits of a position within a block, unless the caller gives others, and bits by which each further level of blocks is wider.
BITS, STEP = 20, 12
#: Up to so many blocks of all keys together, those of a key are taken in one step and sent to every worker.
FEW_BLOCKS = 100_000
#: Rows of a block of numbered rows.
BLOCK = 4096


def carried(df: DataFrame, keys: list[str], pos: str, val: Column, out: str, how: str = "max", bits: int = BITS) -> DataFrame:
    """Add ``out``: the max, min or sum of ``val`` over the rows of the same ``keys`` with a smaller ``pos``; see :func:`carried_together`."""
    return carried_together(df, keys, pos, {out: (val, how)}, bits)


def carried_together(df: DataFrame, keys: list[str], pos: str, wanted: dict[str, tuple[Column, str]], bits: int = BITS) -> DataFrame:
    """Add for each name in ``wanted`` the max, min or sum (value, how) over the rows of the same ``keys`` with a smaller ``pos``.

    ``pos`` is a BIGINT or INT that occurs once per key; a value may be null (ignored) or a struct (max, min).
    The result is null where no smaller position has a value. A null key is a key like any other; rows without a position have no place in
    the order and are left out. ``bits``: the width of a block. The blocks' values, one row each, are written once.
    """
    base = df.where(F.col(pos).isNotNull()).withColumn("_b", F.shiftright(F.col(pos).cast("bigint"), bits))
    base = base.withColumns({f"_val{i}": val for i, (val, _) in enumerate(wanted.values())})
    hows = [how for _, how in wanted.values()]
    w = Window.partitionBy(*keys, "_b").orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    rows = base.withColumns({f"_in{i}": _folds(how)[0](f"_val{i}").over(w) for i, how in enumerate(hows)})
    blocks = base.groupBy(*keys, "_b").agg(*[_folds(how)[0](f"_val{i}").alias(f"_m{i}") for i, how in enumerate(hows)])
    rows = joined(rows, carry_over(blocks, keys, hows), [*keys, "_b"])
    made = rows.withColumns({out: _folds(how)[1](f"_in{i}", f"_carry{i}") for i, (out, how) in enumerate(zip(wanted, hows))})
    return made.drop("_b", *[f"{x}{i}" for i in range(len(hows)) for x in ("_val", "_in", "_carry")])


def _folds(how: str):
    """(the aggregate, how two of its results are put together)."""
    if how == "sum":
        return F.sum, lambda a, b: F.when(F.col(a).isNull() & F.col(b).isNull(), None).otherwise(F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
    sign = {"max": lambda a, b: a > b, "min": lambda a, b: a < b}[how]
    return {"max": F.max, "min": F.min}[how], lambda a, b: F.when(F.col(b).isNull() | sign(F.col(a), F.col(b)), F.col(a)).otherwise(F.col(b))


def carry_over(blocks: DataFrame, keys: list[str], hows: list[str]) -> DataFrame:
    """(keys…, _b, _carry0, …) from (keys…, _b, _m0, …), one row per block: the folds of all blocks of the key before each one."""
    blocks = checkpointed(blocks)
    before = (Window.unboundedPreceding, -1)
    ahead = lambda w, out: [_folds(how)[0](f"_m{i}").over(w).alias(f"{out}{i}") for i, how in enumerate(hows)]
    if blocks.count() <= FEW_BLOCKS:
        return F.broadcast(blocks.select(*keys, "_b", *ahead(Window.partitionBy(*keys).orderBy("_b").rowsBetween(*before), "_carry")))
    # level by level, so that no key's blocks come together
    sums = [blocks.withColumnRenamed("_b", "_b0")]
    for level in (1, 2):
        sums[-1] = sums[-1].withColumn(f"_b{level}", F.shiftright(f"_b{level - 1}", STEP))
        sums.append(sums[-1].groupBy(*keys, f"_b{level}").agg(*[_folds(how)[0](f"_m{i}").alias(f"_m{i}") for i, how in enumerate(hows)]))
    carry = sums[2].select(*keys, "_b2", *ahead(Window.partitionBy(*keys).orderBy("_b2").rowsBetween(*before), "_carry"))
    for level in (1, 0):
        w = Window.partitionBy(*keys, f"_b{level + 1}").orderBy(f"_b{level}").rowsBetween(*before)
        inner = sums[level].select("*", *ahead(w, "_in"))
        put = [_folds(how)[1](f"_in{i}", f"_carry{i}").alias(f"_carry{i}") for i, how in enumerate(hows)]
        carry = joined(inner, carry, [*keys, f"_b{level + 1}"]).select(*keys, f"_b{level}", *put)
    return carry.withColumnRenamed("_b0", "_b")


def previous(df: DataFrame, keys: list[str], pos: str, columns: list[str], out: str = "prev") -> DataFrame:
    """Add ``out``: a struct of ``pos`` and ``columns`` of the row before, null for the first of a key."""
    return carried(df, keys, pos, F.struct(pos, *[c for c in columns if c != pos]), out)


def numbered(df: DataFrame, keys: list[str], pos: str, out: str = "n") -> DataFrame:
    """Add ``out``: the number of the row in its key, from 1."""
    return carried(df, keys, pos, F.lit(1).cast("bigint"), "_seen", "sum").withColumn(out, F.coalesce("_seen", F.lit(0)) + 1).drop("_seen")


def with_neighbours(df: DataFrame, keys: list[str], pos: str, values: Column, before: int, after: int, out: str = "around") -> DataFrame:
    """Add ``out``: ``values`` of the rows from ``before`` rows before to ``after`` rows after, in order, the row itself included.

    Rows are numbered and laid out in blocks of BLOCK rows, each with the margins that its rows look at.
    """
    rows = numbered(df.withColumn("_v", values), keys, pos, "_n")
    own = F.expr(f"_n div {BLOCK}")
    near = F.array_distinct(F.array(own, F.expr(f"(_n + {before}) div {BLOCK}"), F.expr(f"greatest(_n - {after}, 0L) div {BLOCK}")))
    laid = rows.withColumn("_own", own).withColumn("_blk", F.explode(near))
    w = Window.partitionBy(*keys, "_blk").orderBy("_n").rowsBetween(-before, after)
    return laid.withColumn(out, F.collect_list("_v").over(w)).where(F.col("_blk") == F.col("_own")).drop("_v", "_n", "_own", "_blk")
