"""Subtitle texts as rows of cues: SubRip and Advanced SubStation, and the decoding of their files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subloom.functions import texts as T
from subloom.functions import timecodes as C

_RANGE = r"^(\d{1,2}:\d{2}:\d{2}[,.]\d{3})\s*-->\s*(\d{1,2}:\d{2}:\d{2}[,.]\d{3})(?:\s+.*)?\z"
#: The encodings a file is tried in, in this order.
ENCODINGS = ("utf-8-sig", "utf-16", "cp932", "shift_jis")


def decoded(files: DataFrame, content: str = "content", encodings: tuple[str, ...] = ENCODINGS) -> DataFrame:
    """Add ``text`` and ``encoding``: the content of each file in the first encoding that fits; both null if none does.

    UTF-16 is taken only with a byte-order mark: without one nearly every file of even length would fit.
    """
    rest = [f for f in files.schema.fields if f.name != content]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read(data: bytes | None) -> tuple[str | None, str | None]:
            for name in encodings if data is not None else ():
                if name == "utf-16" and data[:2] not in (b"\xff\xfe", b"\xfe\xff"):
                    continue
                try:
                    return data.decode(name), name
                except UnicodeDecodeError:
                    continue
            return None, None

        for batch in batches:
            made = [read(x) for x in batch.column(content).to_pylist()]
            own = [batch.column(f.name) for f in rest]
            yield pa.RecordBatch.from_arrays([*own, pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.string())], names=[*[f.name for f in rest], "text", "encoding"])

    return files.mapInArrow(run, f"{ddl}, text string, encoding string")


def subtitle_files(spark: SparkSession, path: str, suffix: str = "srt") -> DataFrame:
    """(path, text, encoding) of all files below ``path`` with the suffix, in any letter case, without resource forks."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    name = F.element_at(F.split("path", "/"), -1)
    return decoded(files.where(F.lower(name).endswith("." + suffix.lower()) & ~name.startswith("._")))


def mended(text: Column) -> Column:
    """SubRip text with a blank line put before every cue number that follows text without one."""
    return F.regexp_replace(text, r"(?<=[^\n])\n(?=\d{1,4}\n\d{1,2}:\d{2}:\d{2}[,.]\d{3}\s*-->)", "\n\n")


def _blocks(text: Column) -> Column:
    clean = F.regexp_replace(T.plain_line_ends(F.regexp_replace(text, r"^\x{FEFF}", "")), r"^\s+|\s+\z", "")
    return F.filter(F.split(clean, r"\n(?:[ \t]*\n)+"), lambda b: T.strip(b) != "")


def srt_blocks(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """(key…, block_no, source_index, start_ms, end_ms, text, fault) of every block of a SubRip text.

    ``fault`` is the first that holds of ``index`` (no number in the first of three or more lines), ``range`` (no valid pair of
    times, which may be followed by settings), ``order`` (the end before the start) and ``text`` (nothing to
    show), else null. A null or blank text has no blocks.
    """
    # an array of one, exploded, is worked out once; a plain column would be for each use of it
    once = lambda c: F.explode(F.array(c))
    each = df.select(*key, F.posexplode(_blocks(F.col(text))).alias("_no", "_b")).select(*key, "_no", once(F.split("_b", "\n")).alias("_r"))
    time = T.strip(F.try_element_at("_r", F.lit(2)))
    parts = once(F.struct(F.regexp_extract(time, _RANGE, 1).alias("a"), F.regexp_extract(time, _RANGE, 2).alias("z"), T.strip(F.col("_r")[0]).alias("i")))
    times = each.select(*key, "_no", "_r", parts.alias("_p")).select(
        *key, "_no", "_r", "_p", once(F.struct(C.stamp_ms(F.col("_p.a")).alias("start_ms"), C.stamp_ms(F.col("_p.z")).alias("end_ms"))).alias("_t")
    )
    body = F.array_join(F.slice("_r", 3, F.greatest(F.size("_r") - 2, F.lit(0))), "\n")
    out = times.select(
        *key,
        (F.col("_no") + 1).alias("block_no"),
        F.col("_p.i").try_cast("bigint").alias("source_index"),
        "_t.start_ms",
        "_t.end_ms",
        body.alias("text"),
        (F.size("_r") >= 3).alias("_long"),
        F.col("_p.i").rlike(r"^\d+\z").alias("_numbered"),
    )
    fault = (
        F.when(~F.col("_long") | ~F.col("_numbered"), "index")
        .when(F.col("start_ms").isNull() | F.col("end_ms").isNull(), "range")
        .when(F.col("end_ms") < F.col("start_ms"), "order")
        .when(F.col("text") == "", "text")
    )
    return out.withColumn("fault", fault).drop("_long", "_numbered")


def srt_cues(df: DataFrame, key: list[str], text: str, strict: bool = True) -> DataFrame:
    """(key…, ord, source_index, start_ms, end_ms, text) of SubRip texts.

    ``strict``: a text with any faulty block or a repeated index gives no cues at all; else faulty blocks are left out.
    """
    blocks = srt_blocks(df, key, text)
    if not strict:
        good = blocks.where("fault is null")
        return good.select(*key, F.col("block_no").alias("ord"), "source_index", "start_ms", "end_ms", "text")
    # a text is one row of the input, so its blocks are judged where it is read
    cue = F.struct("block_no", "source_index", "start_ms", "end_ms", "text")
    whole = blocks.groupBy(*key).agg(
        F.max(F.col("fault").isNotNull()).alias("_bad"), F.count("*").alias("_n"), F.count_distinct("source_index").alias("_k"), F.array_sort(F.collect_list(cue)).alias("_c")
    )
    sound = whole.where(~F.col("_bad") & (F.col("_n") == F.col("_k")))
    return sound.select(*key, F.explode("_c").alias("c")).select(*key, F.col("c.block_no").alias("ord"), "c.source_index", "c.start_ms", "c.end_ms", "c.text")


def srt_lenient(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """(key…, cue_id, start_seconds, end_seconds, text): the cues of SubRip texts whatever stands before their times, numbered from 1 for each text.

    Of a block the first line with an arrow counts, the lines after it are the text, joined by blanks; a block without such a line is no cue. Times
    may be hours, minutes and seconds, or fewer parts; a malformed one is null.
    """
    kept = F.filter(F.transform(_blocks(F.col(text)), lambda b: F.filter(F.transform(F.split(b, "\n"), T.strip), lambda x: x != "")), lambda rows: F.exists(rows, lambda x: F.contains(x, F.lit("-->"))))
    at = F.array_position(F.transform("_r", lambda x: F.contains(x, F.lit("-->"))), True).cast("int")
    each = df.select(*key, F.posexplode(kept).alias("_no", "_r")).withColumn("_at", at)
    parts = F.transform(F.split(F.element_at("_r", F.col("_at")), "-->"), T.strip)
    time = lambda i: F.when(F.size(parts) == 2, C.clock_seconds(parts[i]))
    body = F.array_join(F.slice("_r", F.col("_at") + 1, F.size("_r") - F.col("_at")), " ")
    return each.select(*key, (F.col("_no") + 1).alias("cue_id"), time(0).alias("start_seconds"), time(1).alias("end_seconds"), body.alias("text"))


def ass_cues(df: DataFrame, key: list[str], text: str) -> DataFrame:
    """(key…, line_no, start_ms, end_ms, lines, fault) of the dialogue lines of an ASS text; ``fault``: too few fields."""
    each = df.select(*key, F.posexplode(T.lines(F.col(text))).alias("_no", "_l")).where(F.col("_l").startswith("Dialogue:"))
    parts = F.split(F.regexp_replace("_l", r"^Dialogue:\s*", ""), ",", 10)
    row = each.withColumn("_p", parts).withColumn("_ok", F.size("_p") == 10)
    at = lambda i: F.when(F.col("_ok"), F.col("_p")[i])
    return row.select(
        *key,
        (F.col("_no") + 1).alias("line_no"),
        C.ass_ms(at(1)).alias("start_ms"),
        C.ass_ms(at(2)).alias("end_ms"),
        F.split(at(9), r"\\[Nn]").alias("lines"),
        F.when(~F.col("_ok"), "fields").alias("fault"),
    )


def rttm_turns(df: DataFrame, line: str = "value") -> DataFrame:
    """(file, speaker, start_ms, end_ms) of the SPEAKER lines of RTTM text; turns without length are left out."""
    p = F.split(T.strip(F.col(line)), f"[{T.BLANKS}]+")
    row = df.select(p.alias("p")).where((F.size("p") >= 8) & (F.col("p")[0] == "SPEAKER"))
    ms = lambda c: F.round(c.try_cast("decimal(20,6)") * 1000).cast("bigint")
    out = row.select(F.col("p")[1].alias("file"), F.col("p")[7].alias("speaker"), ms(F.col("p")[3]).alias("start_ms"), ms(F.col("p")[3].try_cast("decimal(20,6)") + F.col("p")[4].try_cast("decimal(20,6)")).alias("end_ms"))
    return out.where("end_ms > start_ms")


def srt_text(cues: DataFrame, key: list[str], order: str, start_ms: str, end_ms: str, text: str) -> DataFrame:
    """(key…, srt): the cues of each key as one SubRip text, numbered from 1. A file is one value, so its cues are gathered."""
    block = F.struct(F.col(order).alias("o"), C.stamp(F.col(start_ms)).alias("s"), C.stamp(F.col(end_ms)).alias("e"), F.col(text).alias("t"))
    gathered = cues.groupBy(*key).agg(F.array_sort(F.collect_list(block)).alias("_c"))
    shown = F.transform("_c", lambda c, i: F.concat((i + 1).cast("string"), F.lit("\n"), c["s"], F.lit(" --> "), c["e"], F.lit("\n"), F.coalesce(c["t"], F.lit("")), F.lit("\n")))
    return gathered.select(*key, F.array_join(shown, "\n").alias("srt"))
