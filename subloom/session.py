"""Session helpers shared by all operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller injects its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("subloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder named in ``spark.checkpoint.dir``.

    A folder of our own is set only where a local session names none (tests); it goes with the process. On a cluster it would lie on one machine, so a
    session without the setting is refused there.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir names no shared folder")
            folder = tempfile.mkdtemp(prefix="subloom-ckpt-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined(rows: DataFrame, other: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An inner or left join on ``keys`` in which null keys meet."""
    renamed = other.withColumnsRenamed({k: f"_o{i}" for i, k in enumerate(keys)})
    met = F.lit(True)
    for i, k in enumerate(keys):
        met = met & rows[k].eqNullSafe(renamed[f"_o{i}"])
    return rows.join(renamed, met, how).drop(*[f"_o{i}" for i in range(len(keys))])


def present(c):
    """True where a string is neither null nor blank."""
    return F.coalesce(F.trim(c) != "", F.lit(False))


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
