"""Lines of text placed on the time line of what was heard."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subloom.operators.evidence import spoken

#: Letters that may be passed over to find the next one of a line, and the share of a line's letters that must be found.
AHEAD, ENOUGH = 40, 0.40


def followed(heard: str, line: str, at: int, ahead: int = AHEAD, enough: float = ENOUGH) -> tuple[list[int], int]:
    """(places of the line's letters in what was heard, where the next line is sought from).

    Letter by letter the nearest equal one is taken, at most ``ahead`` places on; a letter that isn't found is passed over. If fewer than ``enough`` of the letters
    are found the line has no places, and the next one is sought from where this one was.
    """
    places, begin = [], at
    for letter in line:
        place = heard.find(letter, at, at + ahead)
        if place >= 0:
            places.append(place)
            at = place + 1
    if not places or len(places) < enough * len(line):
        return [], begin
    return places, at


def aligned(lines: DataFrame, letters: DataFrame, keys: list[str], pos: str, text: str) -> DataFrame:
    """(keys…, pos, start_ms, last_start_ms, end_ms, letters, found) of lines (keys…, pos, text) on letters (keys…, place, letter, s, e).

    Times are null for a line of which too little is found (see :func:`followed`); ``letters`` are those of the line that are spoken. Lines are taken in the order of ``pos``, each one sought from
    where the one before ended, so the lines and letters of a key are one value, as those of one recording are: they are folded in one task. Null texts have no letters.
    """
    rows = lines.select(*keys, pos, F.coalesce(spoken(F.col(text)), F.lit("")).alias("_line"))
    kinds = dict(lines.dtypes)

    def one(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        theirs = theirs.sort_values("place", kind="stable")
        heard, s, e = "".join(theirs["letter"]), theirs["s"].to_numpy(), theirs["e"].to_numpy()
        out, at = [], 0
        for row in mine.sort_values(pos, kind="stable").itertuples(index=False):
            places, at = followed(heard, row[-1], at)
            span = (s[places[0]], s[places[-1]], e[places[-1]]) if places else (None, None, None)
            out.append((*row[:-1], *span, len(row[-1]), len(places)))
        return pd.DataFrame(out, columns=[*keys, pos, "start_ms", "last_start_ms", "end_ms", "letters", "found"]).astype({c: "Int64" for c in ("start_ms", "last_start_ms", "end_ms")})

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*keys, pos]) + ", start_ms bigint, last_start_ms bigint, end_ms bigint, letters int, found int"
    single = letters.where(F.length("letter") == 1)
    return rows.groupBy(*keys).cogroup(single.groupBy(*keys)).applyInPandas(one, schema)


def clamped_end(start: Column, last_start: Column, last_end: Column, letters: Column, text: Column, voice_end: Column, next_voice_start: Column, next_voice_end: Column, energy_end: Column) -> Column:
    """Where a line ends, in milliseconds, from what the alignment, the voice and the energy of the recording say; all but the first four may be null.

    A last letter of more than 600 ms is taken for 300; a line lasts at most 350 ms a letter and 1200 more. The energy's end holds, or the alignment's and 50 ms where it lies
    more than 200 ms later and the last letter was sound; without energy the voice's end. A line with a small っ goes on into the next voice that begins within 300 ms. More than five letters take 60 ms
    each at least. The end found so is put off by 50 ms with energy, but not beyond 100 ms after the alignment's; without energy it is 100 ms after the alignment's. A line of under 300 ms lasts 600.
    """
    drawn_out = last_end - last_start > 600
    spoken_end = F.least(F.when(drawn_out, last_start + 300).otherwise(last_end), start + letters * 350 + 1200)
    by_energy = F.when(~drawn_out & (energy_end < spoken_end - 200), spoken_end + 50).otherwise(energy_end)
    end = F.coalesce(by_energy, voice_end, spoken_end)
    goes_on = F.coalesce(text.rlike("[っッ]") & voice_end.isNotNull() & (next_voice_start - end < 300), F.lit(False))
    end = F.when(goes_on, next_voice_end).otherwise(end)
    end = F.when((letters > 5) & (end - start < letters * 60), start + letters * 60).otherwise(end)
    end = F.when(energy_end.isNotNull(), F.least(spoken_end + 100, end + 50)).otherwise(spoken_end + 100)
    return F.when(end < start + 300, start + 600).otherwise(end).cast("bigint")
