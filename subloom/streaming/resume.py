"""Streams that can be stopped and taken up again: appending only what is new, and sessions of turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from subloom.sources.tables import append_new


def append_stream(source: DataFrame, path: str, keys: list[str], checkpoint: str) -> StreamingQuery:
    """Append the rows of a stream to ``path``, each key once, also when a batch is repeated or a key comes again.

    The query ends when all data that is there has been taken up; a later call with the same checkpoint goes on from there.
    """

    def write(batch: DataFrame, _: int) -> None:
        append_new(batch.sparkSession, batch, path, keys)

    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sessions(source: DataFrame, keys: list[str], at: str, pause: str, late: str) -> DataFrame:
    """(keys…, session_start, session_end, n) of rows not more than ``pause`` apart; rows later than ``late`` are given up.

    Works on a stream, where a session comes out once the watermark has passed its end, and on a table.
    """
    rows = source.withWatermark(at, late) if source.isStreaming else source
    grouped = rows.groupBy(*keys, F.session_window(at, pause).alias("w")).agg(F.count("*").alias("n"))
    return grouped.select(*keys, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def read_stream(spark: SparkSession, path: str, like: DataFrame, files: int = 1) -> DataFrame:
    """The Parquet files that appear below ``path``, ``files`` at a time, with the columns of ``like``."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files).parquet(path)
