"""Tab-separated tables with checked columns, spreadsheets by the standard library, and manifests; writing them safely."""

from __future__ import annotations

import io
import json
import os
import re
import tempfile
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subloom.session import joined, require_columns


def read_tsv(spark: SparkSession, path: str, required: tuple[str, ...] = (), optional: tuple[str, ...] = ()) -> DataFrame:
    """All columns as strings, missing optional ones as empty strings; a missing required column is an error."""
    df = spark.read.option("sep", "\t").option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("nullValue", "\x00").option("emptyValue", "").csv(path)
    df = df.withColumnsRenamed({c: c.lstrip("﻿") for c in df.columns})
    require_columns(df, *required)
    return df.withColumns({c: F.lit("") for c in optional if c not in df.columns}).na.fill("")


def write_tsv(df: DataFrame, path: str, fields: list[str]) -> None:
    """The given fields in their order, missing ones empty; an existing path is an error."""
    row = [F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) if f in df.columns else F.lit("").alias(f) for f in fields]
    df.select(*row).write.mode("errorifexists").option("sep", "\t").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_json(report: dict, path: str) -> None:
    """A small report of the driver as JSON, put in place at once: a reader finds the old file or the new one."""
    folder, name = os.path.split(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    handle, made = tempfile.mkstemp(prefix=f".{name}.", dir=folder)
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as f:
            json.dump(report, f, ensure_ascii=False, indent=2)
        os.replace(made, path)
    except BaseException:
        os.unlink(made)
        raise


def write_lines(df: DataFrame, path: str) -> None:
    """One JSON object a line, nulls written as such; an existing path is an error."""
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def write_report(df: DataFrame, path: str, headers: dict[str, str]) -> None:
    """The columns of ``headers`` in their order, under the names it gives them, as CSV; an existing path is an error."""
    require_columns(df, *headers)
    df.select(*[F.col(c).alias(shown) for c, shown in headers.items()]).write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)


def write_subtitles(texts: DataFrame, key: str, srt: str, path: str) -> None:
    """The SubRip text of each key in a folder of its own, with a byte order mark; an existing path is an error."""
    texts.select(F.col(key), F.concat(F.lit("\ufeff"), F.col(srt)).alias("value")).write.mode("errorifexists").partitionBy(key).text(path)


def refuse_changes(rows: DataFrame, before: DataFrame, keys: list[str], locked: str, column: str) -> DataFrame:
    """The rows, or an error with their number if a row that is ``locked`` before has another value of ``column`` now or is gone; run before writing."""
    held = before.where(F.coalesce(F.col(locked), F.lit(False))).select(*keys, F.col(column).alias("_held"))
    now = rows.select(*keys, F.struct(F.col(column).alias("v")).alias("_now"))
    broken = joined(held, now, keys, "left").where(F.col("_now").isNull() | ~F.col("_now.v").eqNullSafe(F.col("_held"))).count()
    if broken:
        raise ValueError(f"{broken} locked rows would be changed")
    return rows


def append_new(spark: SparkSession, df: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Append the rows whose keys ``path`` doesn't hold yet, once per key, and return them as they were to be written.

    Keys compare null-safely. A first call creates the path.
    """
    fresh = df.dropDuplicates(keys)
    try:
        done = spark.read.parquet(path).select(*[F.col(k).alias(f"_{k}") for k in keys])
    except Exception as e:  # the path doesn't exist yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        done = None
    if done is not None:
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        fresh = fresh.join(done, same, "left_anti")
    fresh.write.mode("append").parquet(path)
    return fresh


_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref).group():
        n = n * 26 + ord(c) - 64
    return n


def sheet_cells(data: bytes) -> list[tuple[int, int, str]]:
    """(row, column, value) of the first sheet of a workbook, both from 1; blank cells are left out."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
        sheets = sorted((n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n).group()))
        out = []
        for c in ElementTree.fromstring(z.read(sheets[0])).iter(f"{_MAIN}c"):
            ref, kind = c.get("r"), c.get("t")
            if kind == "inlineStr":
                value = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
            else:
                v = c.find(f"{_MAIN}v")
                value = "" if v is None else shared[int(v.text)] if kind == "s" else v.text or ""
            if value != "":
                out.append((int(re.search(r"\d+", ref).group()), _column(ref), value))
        return out


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """(path, row_no, column_no, value) of the first sheets of all workbooks below ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xlsx").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                cells = sheet_cells(data)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(cells), pa.string()), pa.array([c[0] for c in cells], pa.int32()), pa.array([c[1] for c in cells], pa.int32()), pa.array([c[2] for c in cells], pa.string())],
                    names=["path", "row_no", "column_no", "value"],
                )

    return files.mapInArrow(run, "path string, row_no int, column_no int, value string")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A JSON document or lines of JSON as rows."""
    return spark.read.option("multiLine", True).json(path)
