"""Queries over sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subloom.plans.registry import query
from subloom.session import table
from subloom.streaming.resume import sessions


@query("""
WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events),
i AS (SELECT *, sum(CASE WHEN p IS NULL OR epoch_us(ts) - epoch_us(p) >= 1800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS i FROM e)
SELECT user_id, epoch_us(min(ts)) AS session_start, epoch_us(max(ts)) + 1800000000 AS session_end, count(*) AS n FROM i GROUP BY user_id, i
""")
def q_sessions(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    out = sessions(events, ["user_id"], "ts", "30 minutes", "1 hour")
    return out.select("user_id", F.unix_micros("session_start").alias("session_start"), F.unix_micros("session_end").alias("session_end"), "n")


@query("""
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, count(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2
""")
def q_lineitem_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(price), 2).alias("sum_disc_price"), F.count("*").alias("n")
    )
