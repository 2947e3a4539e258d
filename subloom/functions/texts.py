"""Measures and predicates of subtitle text, as JVM expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Blanks as the rules know them, style tags, letters of Japanese text, dashes that open a line of dialogue.
BLANKS = r" \t\n\x0B\f\r\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
TAGS = r"\{[^{}]*\}"
JAPANESE = r"[\x{3040}-\x{30FF}\x{3400}-\x{9FFF}]"
DIALOGUE_DASH = r"^[" + BLANKS + r"]*[-－‐‑–—]"
#: Pairs of delimiters.
DELIMITERS = ("「」", "『』", "（）", "()", "【】")


def strip(c: Column) -> Column:
    """Without blanks of any kind at both ends."""
    return F.regexp_replace(c, f"^[{BLANKS}]+|[{BLANKS}]+\\z", "")


def lines(c: Column) -> Column:
    """The lines of a text, whatever ends them; one empty line for an empty text."""
    return F.split(F.regexp_replace(c, "\r\n?", "\n"), "\n")


def plain_line_ends(c: Column) -> Column:
    return F.regexp_replace(c, "\r\n?", "\n")


def count_of(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern)).cast("int")


def without_tags(c: Column) -> Column:
    return F.regexp_replace(c, TAGS, "")


def shown_length(line: Column) -> Column:
    """Characters of a line that are shown."""
    return F.length(F.regexp_replace(without_tags(line), r"^[\r\n]+|[\r\n]+\z", ""))


@lru_cache
def half_width_class() -> str:
    """A regex class of the characters that take one column: ASCII and those that Unicode calls half-width."""
    half = [c for c in range(0x80, 0x10000) if unicodedata.east_asian_width(chr(c)) == "H"]
    runs: list[list[int]] = []
    for c in half:
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return r"[\x00-\x7F" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in runs) + "]"


def columns_wide(c: Column) -> Column:
    """Columns a text takes: one for a half-width character, two for any other, none for line ends."""
    bare = F.regexp_replace(without_tags(c), r"[\r\n]", "")
    return 2 * F.length(bare) - count_of(bare, half_width_class())


def japanese_letters(c: Column) -> Column:
    return count_of(without_tags(c), JAPANESE)


def ascii_digits(c: Column) -> Column:
    """Full-width digits as ASCII ones; nothing else changes."""
    return F.translate(c, "０１２３４５６７８９", "0123456789")


def _told(rows: Column) -> Column:
    return F.filter(F.transform(rows, strip), lambda x: x != "")


def two_speakers(rows: Column) -> Column:
    """Exactly two lines with text, both beginning with a hyphen."""
    told = _told(rows)
    return (F.size(told) == 2) & F.forall(told, lambda x: x.startswith("-"))


def dual_dialogue(rows: Column) -> Column:
    """Two or more lines that begin with a dash of any kind."""
    return F.size(F.filter(rows, lambda x: x.rlike(DIALOGUE_DASH))) >= 2


def screen_text(rows: Column) -> Column:
    """All lines together stand in square brackets."""
    merged = F.array_join(F.transform(rows, strip), "")
    return (F.length(merged) >= 2) & merged.startswith("[") & merged.endswith("]")


def unclosed(c: Column) -> Column:
    """Some delimiter is opened more often than closed."""
    out = F.lit(False)
    count = lambda sign: F.length(c) - F.length(F.replace(c, F.lit(sign), F.lit("")))
    for a, b in DELIMITERS:
        out = out | (count(a) > count(b))
    return out


def truth(c: Column) -> Column:
    """The text of a truth value; null for none."""
    low = F.lower(strip(c))
    return F.when(low.isin("1", "true", "yes", "y", "verified"), True).when(low != "", False)


def expand_ranges(c: Column) -> Column:
    """``1,2,5-7`` as an array of numbers in the order written; null if a part is malformed or descends."""
    parts = F.filter(F.transform(F.split(c, ","), strip), lambda p: p != "")
    low = lambda p: F.regexp_extract(p, r"^(\d+)", 1).try_cast("int")
    high = lambda p: F.coalesce(F.regexp_extract(p, r"-(\d+)\z", 1).try_cast("int"), low(p))
    sound = F.forall(parts, lambda p: p.rlike(r"^\d+(-\d+)?\z") & (low(p) <= high(p)))
    return F.when(sound, F.flatten(F.transform(parts, lambda p: F.when(low(p) <= high(p), F.sequence(low(p), high(p))))))


def episode_of_file(name: Column) -> Column:
    """The episode number at the end of a subtitle's file name; null if there is none."""
    return F.regexp_extract(name, r"(?i)(?:_|\b)(\d{1,4})(?=\.(?:srt|ass)\z)", 1).try_cast("int")


def episode_numbers(c: Column, digits: int = 4) -> Column:
    """``1,3-5`` as the episodes named, padded with zeros to ``digits``, each once and in ascending order; null if a part is malformed or descends."""
    numbers = expand_ranges(c)
    return F.transform(F.array_sort(F.array_distinct(numbers)), lambda n: F.when(n >= 10**digits, n.cast("string")).otherwise(F.lpad(n.cast("string"), digits, "0")))


def four_digits(name: Column) -> Column:
    """The first run of exactly four digits that opens a name or follows an underscore and that no digit follows; null if there is none."""
    return F.nullif(F.regexp_extract(name, r"(?:^|_)(\d{4})(?=\D|\z)", 1), F.lit(""))


def last_four_digits(name: Column) -> Column:
    """The last four digits between underscores, hyphens or the ends of a name; null if there are none."""
    return F.try_element_at(F.regexp_extract_all(name, F.lit(r"(?:^|[_-])(\d{4})(?=\z|[_-])"), F.lit(1)), F.lit(-1))


def cluster_key(c: Column) -> Column:
    """``cluster:<episode>:<speaker>`` as ``<episode of four digits>:<speaker>``; what has no such form stays as it is."""
    episode, speaker = F.regexp_extract(c, r"^cluster:(.*):([^:]*)\z", 1), F.regexp_extract(c, r"^cluster:(.*):([^:]*)\z", 2)
    return F.when(c.rlike(r"^cluster:(.*):([^:]*)\z"), F.concat(F.when(F.length(episode) < 4, F.lpad(episode, 4, "0")).otherwise(episode), F.lit(":"), speaker)).otherwise(c)


def safe_name(c: Column) -> Column:
    """A name without the characters that file systems refuse, each run of them as one underscore, without blanks, points and underscores at its ends; ``unnamed`` if nothing is left."""
    clean = F.regexp_replace(F.regexp_replace(c, r"[\\\\/:*?\"<>|\x00-\x1f]+", "_"), r"^[ ._]+|[ ._]+\z", "")
    return F.when(clean == "", "unnamed").otherwise(clean)


def letter_tokens(c: Column) -> Column:
    """The distinct runs of the letters a to z of a name in any letter case, in the order in which they first stand."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("[a-z]+"), F.lit(0)))


def dbfs(amplitude: Column) -> Column:
    """An amplitude of at most 1 in decibels of full scale; silence as that of 1e-12."""
    return 20 * F.log10(F.greatest(amplitude.cast("double"), F.lit(1e-12)))


def _normal(form: str, fold: bool, blanks: str) -> Column:
    @F.pandas_udf(StringType())
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(s):
            if s is None:
                return None
            s = unicodedata.normalize(form, s)
            s = "".join(s.split()) if blanks == "none" else " ".join(s.split()) if blanks == "single" else s.strip()
            return s.casefold() if fold else s

        for batch in batches:
            yield batch.map(one, na_action="ignore")

    return made


#: Unicode normal forms have no built-in function; these run on Arrow batches.
compact = _normal("NFKC", False, "none")
name_form = _normal("NFKC", False, "single")
evidence_form = _normal("NFKC", True, "none")
folded_form = _normal("NFKC", True, "ends")
composed_form = _normal("NFC", False, "ends")
