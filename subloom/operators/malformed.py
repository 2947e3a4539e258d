"""Separate records that can't be read from those that can, each with its reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subloom.session import require_columns

#: The fields of a record, in order.
TURN_FIELDS = ("episode", "source_index", "start_seconds", "end_seconds", "speaker", "text")

#: The rules, in the order in which a reason is chosen. kind: how the cell is judged; column 0: the whole record.
TURN_RULES = (
    (1, 0, "quoting", "layout", ""),
    (2, 0, "column_count", "width", ""),
    (3, 2, "source_index", "pattern", r"^ *(?=0*[1-9])[0-9]{1,9} *\z"),
    (4, 4, "end_seconds", "after", r"^ *[0-9]+(?:\.[0-9]+)? *\z"),
    (5, 6, "text", "content", r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x84\x86-\x9F]"),
)
#: Blanks of any kind, invisible ones included.
BLANK = r"[\s\p{Z}\x85ᅟᅠ᠎​-‏ -  -⁤⠀ㅤ﻿ﾠ­]"


def split_fields(record: Column, sep: str = "\t") -> Column:
    """The fields of a record as ARRAY<STRUCT<value, broken>>; ``broken``: the field breaks the quoting.

    Pieces between separators are joined again while a quoted field is open: a field that begins with a
    quote is closed at the first piece after which its quotes are even in number. A trailing CR isn't content.
    """
    quotes = lambda s: F.length(s) - F.length(F.replace(s, F.lit('"'), F.lit("")))
    body = F.regexp_replace(record, r"\r\z", "")
    zero = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"))

    def step(acc: Column, piece: Column) -> Column:
        joined = F.when(acc["open"].isNotNull(), F.concat(acc["open"], F.lit(sep), piece)).otherwise(piece)
        still = joined.startswith('"') & (quotes(joined) % 2 == 1)
        return F.struct(
            F.when(still, acc["done"]).otherwise(F.concat(acc["done"], F.array(joined))).alias("done"),
            F.when(still, joined).alias("open"),
        )

    def finish(acc: Column) -> Column:
        return F.when(acc["open"].isNotNull(), F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"])

    def unquote(field: Column) -> Column:
        quoted = field.startswith('"')
        inner = field.substr(F.lit(2), F.greatest(F.length(field) - 2, F.lit(0)))
        bare = F.replace(inner, F.lit('""'), F.lit(""))
        sound = (F.length(field) >= 2) & field.endswith('"') & ~F.contains(bare, F.lit('"'))
        return F.struct(
            F.when(quoted, F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(field).alias("value"), (quoted & ~sound).alias("broken")
        )

    plain = ~F.contains(body, F.lit('"'))
    pieces = F.split(body, sep)
    return F.transform(F.when(plain, pieces).otherwise(F.aggregate(pieces, zero, step, finish)), unquote)


def rule_table(spark: SparkSession, rules=TURN_RULES) -> DataFrame:
    """The rules as a table; its size is that of ``rules``, so a broadcast is bounded."""
    return spark.createDataFrame(list(rules), "priority int, column_no int, reason string, kind string, pattern string")


def judge_records(df: DataFrame, key: str = "line_id", raw: str = "raw", fields=TURN_FIELDS, rules=TURN_RULES) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of the records in ``raw``.

    ``bad`` has ``key``, ``reason``, the first rule by priority that the record breaks, and ``reasons``, all of them in that order; ``good`` has ``key``
    and the typed fields. Cells are exploded into (row, column, value), joined to the rule table, judged, and the
    failures of a row aggregated; the good rows are those without a failure (anti-join). Every input row gives
    exactly one row in one of the two, also when it is repeated or its key is null; a null record counts as an
    empty one. Other columns of the input are ignored.
    """
    require_columns(df, key, raw)
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("_key"), F.xxhash64(F.col(raw)).alias("_sum"), F.col(raw).alias("_raw"))
    parsed = rows.select("_key", "_sum", split_fields(F.coalesce("_raw", F.lit(""))).alias("_f"))
    whole = F.struct(F.lit(0).alias("column_no"), F.lit(None).cast("string").alias("value"))
    numbered = F.transform("_f", lambda x, i: F.struct((i + 1).cast("int").alias("column_no"), x["value"].alias("value")))
    wide = F.size("_f") == len(fields)
    cells = parsed.select(
        "_key",
        "_sum",
        F.exists("_f", lambda x: x["broken"]).alias("_torn"),
        wide.alias("_wide"),
        F.when(wide, F.col("_f")[fields.index("start_seconds")]["value"]).alias("_start"),
        F.explode(F.concat(F.array(whole), F.when(wide, numbered).otherwise(F.array().cast("array<struct<column_no:int,value:string>>")))).alias("_c"),
    ).select("*", "_c.column_no", "_c.value")
    number = lambda c: F.expr(f"try_cast(trim({c}) as decimal(38,9))")
    patterned = lambda c: F.expr(f"value rlike {c}")
    blank = F.regexp_replace(F.col("value"), BLANK + "+", "") == ""
    fails = (
        F.when(F.col("kind") == "layout", F.col("_torn"))
        .when(F.col("kind") == "width", ~F.col("_wide"))
        .when(F.col("kind") == "pattern", ~patterned("pattern"))
        .when(F.col("kind") == "after", ~(patterned("pattern") & F.coalesce(number("value") > number("_start"), F.lit(False))))
        .when(F.col("kind") == "content", blank | patterned("pattern"))
    )
    errors = (
        cells.join(F.broadcast(rule_table(spark, rules)), "column_no")
        .where(fails)
        .groupBy(F.col("_key").alias("_ekey"), F.col("_sum").alias("_esum"))
        .agg(F.transform(F.array_sort(F.collect_set(F.struct("priority", "reason"))), lambda x: x["reason"]).alias("reasons"))  # one per rule at most
    )
    same = F.col("_key").eqNullSafe(F.col("_ekey")) & (F.col("_sum") == F.col("_esum"))
    bad = rows.join(errors, same).select(F.col("_key").alias(key), F.col("reasons")[0].alias("reason"), "reasons")
    clean = rows.join(errors, same, "left_anti").select("_key", split_fields(F.coalesce("_raw", F.lit(""))).alias("_f"))
    kinds = {"source_index": "int", "start_seconds": "double", "end_seconds": "double"}
    typed = [
        (F.expr(f"try_cast(trim(_f[{i}].value) as {kinds[name]})") if name in kinds else F.col("_f")[i]["value"]).alias(name)
        for i, name in enumerate(fields)
    ]
    return clean.select(F.col("_key").alias(key), *typed), bad
