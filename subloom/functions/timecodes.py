"""Times of subtitles as whole milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STAMP = r"^(\d{1,2}):(\d{2}):(\d{2})[,.](\d{3})\z"
_ASS = r"^(\d+):(\d{2}):(\d{2})[.](\d{2})\z"


def _number(c: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(c, pattern, group).try_cast("bigint")


def stamp_ms(c: Column) -> Column:
    """``H:MM:SS,mmm`` or ``H:MM:SS.mmm`` as milliseconds; null if malformed or with 60 or more minutes or seconds."""
    c = F.trim(c)
    h, m, s, ms = (_number(c, _STAMP, g) for g in (1, 2, 3, 4))
    return F.when(c.rlike(_STAMP) & (m < 60) & (s < 60), ((h * 60 + m) * 60 + s) * 1000 + ms)


def ass_ms(c: Column) -> Column:
    """``H:MM:SS.cc`` as milliseconds; null if malformed."""
    c = F.trim(c)
    h, m, s, cs = (_number(c, _ASS, g) for g in (1, 2, 3, 4))
    return F.when(c.rlike(_ASS), ((h * 60 + m) * 60 + s) * 1000 + cs * 10)


def clock_seconds(c: Column) -> Column:
    """``H:M:S``, ``M:S`` or ``S`` with a fraction after point or comma as seconds; null if malformed or negative."""
    parts = F.split(F.replace(F.trim(c), F.lit(","), F.lit(".")), ":")
    n = F.size(parts)
    sound = (n <= 3) & F.forall(parts, lambda p: p.rlike(r"^\d+(\.\d+)?\z"))
    return F.when(sound, F.aggregate(parts, F.lit(0.0), lambda acc, p: acc * 60 + p.try_cast("double")))


def stamp(ms: Column, sep: str = ",") -> Column:
    """Milliseconds as ``HH:MM:SS,mmm``; negative ones as zero, hours as many digits as they need."""
    ms = F.greatest(ms.cast("bigint"), F.lit(0).cast("bigint"))
    h = F.floor(ms / 3_600_000)
    # lpad would cut hours of more digits
    hours = F.when(h < 100, F.lpad(h.cast("string"), 2, "0")).otherwise(h.cast("string"))
    part = lambda div, mod, width: F.lpad((F.floor(ms / div) % mod).cast("string"), width, "0")
    return F.concat(hours, F.lit(":"), part(60_000, 60, 2), F.lit(":"), part(1000, 60, 2), F.lit(sep), part(1, 1000, 3))


def range_ms(timecode: Column) -> Column:
    """The length of ``start --> end`` or ``start|end`` (the latter in centiseconds); null if malformed, 0 if the end comes first."""
    arrow = F.split(timecode, r"\s*-->\s*")
    bar = F.split(timecode, r"\|")
    length = F.when(F.contains(timecode, F.lit("-->")) & (F.size(arrow) == 2), stamp_ms(arrow[1]) - stamp_ms(arrow[0])).when(
        F.size(bar) == 2, ass_ms(F.try_element_at(bar, F.lit(2))) - ass_ms(bar[0])
    )
    return F.when(length.isNotNull(), F.greatest(length, F.lit(0)))
