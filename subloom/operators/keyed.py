"""Keyed merges and comparisons: coverage, update-merges, ordered reasons, reconciliation by place, dependencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subloom.operators.ordered import carried, numbered

#: Rows of a block of hashes, on average, when a scope is drawn from.
ROWS_PER_BLOCK = 4096


def first_rows(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key, that with the smallest ``order``; unlike a window it combines before the exchange."""
    rest = [c for c in df.columns if c not in keys and c != order]
    one = df.groupBy(*keys).agg(F.min(F.struct(order, *rest)).alias("_r"))
    return one.select(*keys, f"_r.{order}", *[f"_r.{c}" for c in rest])


def coverage(expected: DataFrame, given: DataFrame, keys: list[str]) -> DataFrame:
    """(keys…, state): ``missing`` (expected, not given), ``unknown`` (given, not expected) or ``duplicate`` (given more than once)."""
    a = expected.select(*keys).distinct().withColumn("_x", F.lit(1)).withColumn("_n", F.lit(0).cast("bigint"))
    b = given.groupBy(*keys).agg(F.count("*").alias("_n")).withColumn("_x", F.lit(0))
    both = a.unionByName(b).groupBy(*keys).agg(F.max("_x").alias("_x"), F.sum("_n").alias("_n"))
    states = F.array_compact(
        F.array(F.when((F.col("_x") == 1) & (F.col("_n") == 0), "missing"), F.when((F.col("_x") == 0) & (F.col("_n") > 0), "unknown"), F.when(F.col("_n") > 1, "duplicate"))
    )
    return both.select(*keys, F.explode(states).alias("state"))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys…, n) of the keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def updated(base: DataFrame, updates: DataFrame, keys: list[str], columns: list[str], order: str) -> DataFrame:
    """The base rows with ``columns`` taken from the last update of their key, and ``update_state``: kept, merged or conflict.

    ``conflict``: the base had another non-empty value in a column. Of several updates of a key that with the largest
    ``order`` holds; an empty or null new value changes nothing.
    """
    last = updates.groupBy(*keys).agg(F.max(F.struct(order, *columns)).alias("_u"))
    rows = base.join(last, keys, "left")
    new = lambda c: F.when(F.coalesce(F.col(f"_u.{c}"), F.lit("")) != "", F.col(f"_u.{c}"))
    clash = F.lit(False)
    for c in columns:
        clash = clash | (F.coalesce(F.col(c), F.lit("")) != "") & new(c).isNotNull() & (F.col(c) != new(c))
    state = F.when(F.col("_u").isNull(), "kept").when(F.coalesce(clash, F.lit(False)), "conflict").otherwise("merged")
    kept = [c for c in base.columns if c not in columns]
    return rows.select(*kept, *[F.coalesce(new(c), F.col(c)).alias(c) for c in columns], state.alias("update_state"))


def first_reason(*rules: tuple[Column, str]) -> Column:
    """The name of the first rule that holds, null if none does; a rule that is null doesn't hold."""
    out = None
    for condition, name in rules:
        c = F.coalesce(condition, F.lit(False))
        out = F.when(c, name) if out is None else out.when(c, name)
    return out


def all_reasons(*rules: tuple[Column, str]) -> Column:
    """The names of all rules that hold, as an array."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for c, n in rules]))


def by_place(left: DataFrame, right: DataFrame, keys: list[str], left_pos: str, right_pos: str, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """(keys…, place, difference): the n-th row of a key on the left against the n-th on the right: a column that differs, or a row without a counterpart.

    Null equals the empty string.
    """
    a = numbered(left.select(*keys, F.col(left_pos).alias("_p"), *[F.col(x).alias(f"_a{i}") for i, (x, _) in enumerate(columns.values())]), keys, "_p", "place").drop("_p")
    b = numbered(right.select(*keys, F.col(right_pos).alias("_p"), *[F.col(y).alias(f"_b{i}") for i, (_, y) in enumerate(columns.values())]), keys, "_p", "place").drop("_p")
    both = a.withColumn("_l", F.lit(1)).join(b.withColumn("_r", F.lit(1)), [*keys, "place"], "full")
    same = lambda i: F.coalesce(F.col(f"_a{i}").cast("string"), F.lit("")) == F.coalesce(F.col(f"_b{i}").cast("string"), F.lit(""))
    found = F.when(F.col("_r").isNull(), F.array(F.lit("only_left"))).when(F.col("_l").isNull(), F.array(F.lit("only_right"))).otherwise(
        all_reasons(*[(~same(i), name) for i, name in enumerate(columns)])
    )
    return both.select(*keys, "place", F.explode(found).alias("difference"))


def dependency_breaks(df: DataFrame, scope: list[str], a: str, b: str) -> DataFrame:
    """(scope…, value, n): values of ``a`` that go with more than one value of ``b``; empty values don't count."""
    full = df.where((F.coalesce(F.col(a), F.lit("")) != "") & (F.coalesce(F.col(b), F.lit("")) != ""))
    return full.select(*scope, F.col(a).alias("value"), b).distinct().groupBy(*scope, "value").agg(F.count("*").alias("n")).where("n > 1")


def modal(df: DataFrame, scope: list[str], column: str, least: int = 4, share: float = 0.7, rows: int = 5) -> DataFrame:
    """(scope…, value, n, total): the commonest non-empty value, where it fills ``share`` of ``rows`` or more rows and occurs ``least`` times; ties by value."""
    counts = df.where(F.coalesce(F.col(column), F.lit("")) != "").groupBy(*scope, column).agg(F.count("*").alias("n"))
    top = counts.groupBy(*scope).agg(F.min(F.struct((-F.col("n")).alias("o"), F.col(column).alias("v"))).alias("_t"), F.sum("n").alias("total"))
    out = top.select(*scope, F.col("_t.v").alias("value"), (-F.col("_t.o")).alias("n"), "total")
    return out.where((F.col("n") >= least) & (F.col("total") >= rows) & (F.col("n") >= share * F.col("total")))


def drawn_by_hash(df: DataFrame, scope: list[str], ids: list[str], ratio: float) -> DataFrame:
    """Of each scope the ceil(ratio * n) rows, one at least, with the smallest SHA-1 of their ids joined by "|".

    The place in the order is the leading 60 bits of the hash, so that no scope is sorted in one task; rows of equal ids
    are drawn together.
    """
    digest = F.sha1(F.concat_ws("|", *[F.col(c).cast("string") for c in ids]))
    rows = df.withColumn("_sha", digest).withColumn("_pos", F.conv(F.substring("_sha", 1, 15), 16, 10).cast("bigint"))
    places = rows.groupBy(*scope, "_pos").agg(F.count("*").alias("_k"))
    # the hashes fill the whole range: blocks so wide that each holds some thousand of them
    bits = 60 - (df.count() // ROWS_PER_BLOCK).bit_length()
    ranked = carried(places, scope, "_pos", F.col("_k"), "_before", "sum", bits)
    quota = places.groupBy(*scope).agg(F.greatest(F.lit(1), F.ceil(F.sum("_k") * ratio)).alias("_quota"))
    chosen = ranked.join(quota, scope).where(F.coalesce("_before", F.lit(0)) < F.col("_quota")).select(*scope, "_pos")
    return rows.join(chosen, [*scope, "_pos"], "left_semi").drop("_sha", "_pos")


def levels(samples: DataFrame, keys: list[str], value: str, clip: float = 0.999, quiet: float = 1e-4) -> DataFrame:
    """(keys…, samples, rms, peak, clipping_ratio, silence_ratio) of the samples of each key, values of -1 to 1; nulls don't count."""
    x = F.abs(F.col(value).cast("double"))
    share = lambda c: F.avg(c.cast("double"))
    return samples.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.count("*").alias("samples"), F.sqrt(F.avg(x * x)).alias("rms"), F.max(x).alias("peak"), share(x >= clip).alias("clipping_ratio"), share(x < quiet).alias("silence_ratio")
    )


def disjoint_keys(df: DataFrame, taken: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys no row of ``taken`` has, null keys being keys like any other: what may be used without leaking from one set into the other."""
    other = taken.select(*[F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)]).distinct()
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & df[k].eqNullSafe(other[f"_o{i}"])
    return df.join(other, same, "left_anti")


def by_episode(parts: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """(keys…, in_<name>…, absent): which of the parts have rows of each key, and the names of those that have none, in order."""
    tagged = None
    for name, df in parts.items():
        own = df.select(*keys).distinct().withColumn("_part", F.lit(name))
        tagged = own if tagged is None else tagged.unionByName(own)
    has = tagged.groupBy(*keys).agg(*[F.max(F.col("_part") == n).alias(f"in_{n}") for n in parts])
    return has.withColumn("absent", F.array_compact(F.array(*[F.when(~F.col(f"in_{n}"), F.lit(n)) for n in parts])))


def merged_plans(parts: dict[str, DataFrame], key: str, same: list[str]) -> DataFrame:
    """The rows of all parts by name with ``plan`` and ``duplicate``: true for a row whose key or whose values of ``same`` another row of any part has too.

    Null keys and rows in which all of ``same`` are null are no duplicates of each other. Rows are told apart by hashes of 128 bits, counted before they meet the rows.
    """
    every = None
    for name, df in parts.items():
        own = df.withColumn("plan", F.lit(name))
        every = own if every is None else every.unionByName(own, allowMissingColumns=True)
    told = F.to_json(F.struct(*same), {"ignoreNullFields": "false"})
    full = F.coalesce(*[F.col(c).cast("string") for c in same]).isNotNull()
    rows = every.withColumn("_same", F.when(full, F.struct(F.xxhash64(told).alias("a"), F.xxhash64(F.lit(1), told).alias("b"))))
    keys = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_k")).where("_k > 1").select(F.col(key).alias("_key"), F.lit(True).alias("_twice"))
    values = rows.where("_same is not null").groupBy("_same").agg(F.count("*").alias("_k")).where("_k > 1").select(F.col("_same").alias("_value"), F.lit(True).alias("_alike"))
    out = rows.join(keys, F.col(key) == F.col("_key"), "left").join(values, F.col("_same") == F.col("_value"), "left")
    return out.withColumn("duplicate", F.coalesce("_twice", "_alike", F.lit(False))).drop("_same", "_key", "_twice", "_value", "_alike")
