"""One consistent form for text that looks the same but differs in its characters."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subloom.session import require_columns

#: Characters that print as nothing, as an RE2 class.
INVISIBLE = (
    r"[\x{00}-\x{08}\x{0E}-\x{1F}\x{7F}\x{AD}\x{034F}\x{061C}\x{180B}-\x{180F}\x{200B}-\x{200F}\x{202A}-\x{202E}"
    r"\x{2060}-\x{206F}\x{FE00}-\x{FE0F}\x{FEFF}\x{FFF9}-\x{FFFB}\x{E0000}-\x{E0FFF}]"
)
#: Letters of other scripts with the shape of a Latin letter, then that letter.
LETTERS = (
    ("АВЕЅІЈКМНОРСТУХҮԌԚԜӀ", "ABESIJKMHOPCTYXYGQWI"),
    ("аеоѕіјкрсухһԁԛԝѵӏ", "aeosijkpcyxhdqwvl"),
    ("ЁЇёїӐӑӒӓ", "ËÏëïĂăÄä"),
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳ", "ABEZHIKMNOPTYXCj"),
    ("οορνχϲ", "ooρvxc"),
    ("ΆΈΊΌΎόϊϋ", "ÁÉÍÓÝóïü"),
    ("ρ", "p"),
    ("ɑɡıȷʋ", "agijv"),
    ("ᎪᏴᎬᎻᎫᏦᎷᎢᏃᏟᎠ", "ABEHJKMTZCD"),
    ("ᏀᏞᏢᏒᏚᏙᎳᎥᎩ", "GLPRSVWiy"),
    ("ՕՍՏօոսհց", "OUSonuhg"),
    ("ⲀⲂⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲌⲟⲣⲥ", "ABHIKMNOPCTYXZopc"),
)
#: Characters of East Asian scripts with the shape of a katakana letter or another sign, then that sign.
SIGNS = (
    ("八二力夕工口卜才", "ハニカタエロトオ"),
    ("りへべぺ", "リヘベペ"),
    ("一—―–−‒‐‑─━", "ーーーーーーーーーー"),
    ("·•∙⋅‧", "・・・・・"),
    ("゛゜", "゙゚"),
)
#: Supplementary radicals and the ideographs of the same shape.
RADICALS = ("⺟⺠⻁⻄⻅⻈⻋⻓⻔⻘⻙⻚⻛⻜⻝⻢⻤⻥⻦⻨⻩⻬⻮⻰⻳", "母民虎西见讠车长门青韦页风飞食马鬼鱼鸟麦黄齐齿龙龟")


@lru_cache
def compatible_forms() -> tuple[str, str]:
    """Characters that differ from another one only in width, as a radical or as a kind of blank, and those others.

    By rule, from the Unicode data: every single-character wide, narrow, no-break or unmarked compatibility
    decomposition, and every space separator. Raised, lowered, circled and squared forms look different and stay.
    """
    a, b = [], []
    for code in range(0x80, sys.maxunicode + 1):
        c = chr(code)
        kind, _, rest = unicodedata.decomposition(c).partition(" ")
        if unicodedata.category(c) == "Zs":
            a.append(c), b.append(" ")
        elif kind in ("<wide>", "<narrow>", "<compat>", "<noBreak>", "<font>") and " " not in rest and not 0xFB50 <= code <= 0xFEFF:
            a.append(c), b.append(unicodedata.normalize("NFKC", chr(int(rest, 16))))
    pairs = [(x, y) for x, y in zip(a, b) if len(y) == 1 and x != y]
    return "".join(x for x, _ in pairs), "".join(y for _, y in pairs)


def _literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _class(chars: str) -> str:
    """An RE2 class of the characters, as ranges."""
    runs: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if runs and runs[-1][1] == code - 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in runs) + "]"


def _translated(expr: str, wide: str, plain: str) -> str:
    """translate() for the values that hold one of the characters: it builds its table anew for each value."""
    return f"CASE WHEN regexp_matches({expr}, '{_class(wide)}') THEN translate({expr}, {_literal(wide)}, {_literal(plain)}) ELSE {expr} END"


@lru_cache
def form_sql(column: str) -> str:
    """The consistent form of a column as a DuckDB expression."""
    pairs = dict(zip(*compatible_forms()))
    once = dict(zip("".join(a for a, _ in (*LETTERS, *SIGNS, RADICALS)), "".join(b for _, b in (*LETTERS, *SIGNS, RADICALS))))
    alike = {a: once.get(b, b) for a, b in once.items()}
    width = {a: b for a, b in pairs.items() if 0xFF00 <= ord(a) <= 0xFFEF or b == " "}
    rest = {a: b for a, b in pairs.items() if a not in width}
    bare = f"regexp_replace(translate({column}, chr(9), ' '), {_literal(INVISIBLE)}, '', 'g')"
    expr = bare
    for table in (width, rest):
        expr = f"list_transform([{expr}], lambda x: {_translated('x', ''.join(table), ''.join(table.values()))})[1]"
    expr = f"list_transform([nfc_normalize({expr})], lambda x: {_translated('x', ''.join(alike), ''.join(alike.values()))})[1]"
    return f"nfc_normalize({expr})"


def visual_form(df: DataFrame, columns: list[str], suffix: str = "_form") -> DataFrame:
    """Add <column><suffix>: the consistent form of each text column, null for null.

    Two texts have the same form if they differ only in the width of characters, in how marks are composed, in
    invisible characters, in the kind of blank or in characters of the same shape; letter case, marks, digits and
    line breaks stay as they are. DuckDB runs the expressions on the Arrow batches of each partition; no rows move.
    A column of the input named like a result is an error.
    """
    require_columns(df, *columns)
    clash = [c + suffix for c in columns if c + suffix in df.columns]
    if clash:
        raise ValueError(f"columns exist: {', '.join(clash)}")
    schema = T.StructType([*df.schema.fields, *[T.StructField(c + suffix, T.StringType()) for c in columns]])
    exprs = ", ".join(f"{form_sql(f'c{i}')} AS c{i}" for i in range(len(columns)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1, "memory_limit": "512MB"})
        for batch in batches:
            texts = pa.table({f"c{i}": batch.column(c).cast(pa.string()) for i, c in enumerate(columns)})
            texts = texts.append_column("n", pa.array(range(batch.num_rows), pa.int64()))
            con.register("texts", texts)
            forms = con.sql(f"SELECT {exprs} FROM texts ORDER BY n").to_arrow_table()
            con.unregister("texts")
            made = [forms.column(i).combine_chunks().cast(pa.string()) for i in range(len(columns))]
            made = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in made]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *[c + suffix for c in columns]])

    return df.mapInArrow(run, schema)


def look_like_entries(df: DataFrame, key: str, column: str, entries: DataFrame, entry_id: str, entry_text: str) -> DataFrame:
    """(key, entry_id) of the values that look like an entry but aren't its exact characters.

    Both sides meet in their consistent form. Distinct values are formed and matched once and then joined to
    their rows, so a value that a third of the rows hold is worked on once. Null values and entries have no
    match; repeated rows each count.
    """
    values = df.select(F.col(column).alias("_v")).where(F.col("_v").isNotNull()).distinct()
    formed = visual_form(values, ["_v"], "_f")
    known = visual_form(entries.select(F.col(entry_id).alias("_id"), F.col(entry_text).alias("_e")).where(F.col("_e").isNotNull()), ["_e"], "_f")
    met = formed.join(known, F.col("_v_f") == F.col("_e_f")).where(F.col("_v") != F.col("_e")).select("_v", "_id")
    return df.select(F.col(key).alias("_key"), F.col(column).alias("_v")).join(met, "_v").select(F.col("_key").alias(key), F.col("_id").alias(entry_id))
