"""Evaluation texts that leaked into a corpus, whole, in part, reordered or with small edits.

Both sides are reduced to their letters and digits (compatibility forms, case-folded), which are the tokens here: the texts are of
languages with and without blanks. The corpus is scanned once: every window of 16 signs is hashed (Karp-Rabin) and joined to the windows
of the items, which each worker holds up to a size; beyond it a filter of the items' windows picks the documents whose seeds
are exchanged and joined. The shared seeds of a pair are grown into tiles by greedy string tiling, the longest first and without overlap; the
tiles give the covered share of the item in whatever order its parts stand, and the matches are the places from which the longest
almost literal passage is measured exactly.
"""

from __future__ import annotations

import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subloom.session import checkpointed, require_columns

SEED = 16
#: Up to so many signs of items are held by every worker, so that no text of the corpus is exchanged; beyond, seeds are joined by an exchange.
HELD_SIGNS = 4_000_000
#: Bits of the table that is asked before the held seeds are.
MASK_BITS = 24
#: Bits of the filter for each sign of items that aren't held, and the most it has; the fuller it is the more windows the join has to tell apart.
FILTER_SHARE, FILTER_MOST = 64, 1 << 30
#: Pairs of a document's and an item's equal seeds that are laid out at once.
PAIRS = 1_000_000
BASE = 0x9E3779B97F4A7C15 | 1
GAP, ODD = 0, 0xFFFFFFFF
#: What follows each text of the corpus and each item: never the same, so that no window with an end in it is shared.
TEXT_END, ITEM_END = 0x110000, 0x110001


def signs(text: str) -> str:
    """The letters and digits of a text without regard to width, composition and case."""
    return "".join(c for c in unicodedata.normalize("NFKC", text).casefold() if c.isalnum())


@lru_cache
def _sign_table() -> np.ndarray:
    """What :func:`signs` makes of each character by itself: a code, GAP for nothing, ODD where it depends on others or isn't one."""
    out = np.zeros(0x110001, np.uint32)
    for code in range(0x110000):
        c = chr(code)
        if 0xD800 <= code < 0xE000 or unicodedata.category(c) in ("Cn", "Co"):
            continue
        made = signs(c)
        if unicodedata.combining(c) or c in "ﾞﾟ" or len(made) > 1 or 0x1100 <= code < 0x1200:
            out[code] = ODD
        elif made:
            out[code] = ord(made)
    return out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def batch_signs(texts: list[str], end: int = TEXT_END) -> tuple[np.ndarray, np.ndarray]:
    """(signs of all texts in a row, each followed by ``end``; where each text begins)."""
    table = _sign_table()
    raw = _codes("\U0010ffff".join(t.replace("\U0010ffff", "") for t in texts) + "\U0010ffff")
    made = table[raw]
    ends = np.flatnonzero(raw == 0x10FFFF)
    if (made == ODD).any():
        odd = set(np.searchsorted(ends, np.flatnonzero(made == ODD)).tolist())
        texts = [signs(t) if i in odd else t for i, t in enumerate(texts)]
        raw = _codes("\U0010ffff".join(t.replace("\U0010ffff", "") for t in texts) + "\U0010ffff")
        made = table[raw]
        ends = np.flatnonzero(raw == 0x10FFFF)
        made[made == ODD] = raw[made == ODD]  # what still has no simple form is kept as it is
    made[ends] = end
    kept = made != GAP
    starts = np.concatenate([[0], np.cumsum(kept)[ends]])[:-1]
    return made[kept], starts


def window_hashes(c: np.ndarray) -> np.ndarray:
    """Karp-Rabin hashes of all windows of SEED signs, by doubling."""
    h, step, power = c.astype(np.uint64) + np.uint64(1), 1, BASE
    while step < SEED:
        h = h[:-step] * np.uint64(power) + h[step:] if len(h) > step else h[:0]
        step, power = step * 2, power * power % 2**64
    return h ^ (h >> np.uint64(31))


def in_a_row(d: np.ndarray, i: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start in the document, in the item, number of seeds) of the matches: seeds, or ``n`` seeds each, that go on along one diagonal."""
    n = np.ones(len(d), np.int64) if n is None else n
    order = np.lexsort((d, d - i))
    d, i, n = d[order], i[order], n[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] - i[1:] != d[:-1] - i[:-1]) | (d[1:] != d[:-1] + n[:-1])
    first = np.flatnonzero(new)
    return d[first], i[first], np.add.reduceat(n, first) if len(first) else n


class Items:
    """Items with the hashes of their windows in order, ready for lookups."""

    def __init__(self, ids: list, texts: list[str], bits: int = MASK_BITS):
        self.ids = ids
        self.signs, self.starts = batch_signs(texts, ITEM_END)
        self.ends = np.append(self.starts[1:], len(self.signs)) - 1
        h = window_hashes(self.signs)
        # windows with an end in them can't be met by any text
        at = np.flatnonzero(self.ends[np.searchsorted(self.ends, np.arange(len(h)))] >= np.arange(len(h)) + SEED) if len(h) else np.zeros(0, np.int64)
        order = np.argsort(h[at], kind="stable")
        self.at = at[order]
        self.hashes = h[at][order]
        self.bits = bits
        self.mask = np.zeros(1 << bits, bool)
        self.mask[self.hashes >> np.uint64(64 - bits)] = True


def matches(c: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start in c, start in the items' signs, length) of all longest matches of SEED signs or more.

    Equal seeds are laid out PAIRS at a time, so that signs that repeat on both sides take no more memory than their matches.
    """
    h = window_hashes(c)
    near = np.flatnonzero(items.mask[h >> np.uint64(64 - items.bits)])
    lo = np.searchsorted(items.hashes, h[near], "left")
    n = np.searchsorted(items.hashes, h[near], "right") - lo
    near, lo, n = near[n > 0], lo[n > 0], n[n > 0]
    upto = np.cumsum(n)
    parts = []
    begin = 0
    while begin < len(near):
        end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + PAIRS, "right")))
        x, k = slice(begin, end), n[begin:end]
        offset = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        parts.append(in_a_row(np.repeat(near[x], k), items.at[np.repeat(lo[x], k) + offset]))
        begin = end
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none
    a, b, k = parts[0] if len(parts) == 1 else in_a_row(*(np.concatenate(x) for x in zip(*parts)))
    return a, b, k + SEED - 1


def tiles(a: np.ndarray, b: np.ndarray, length: np.ndarray) -> list[tuple[int, int, int]]:
    """Greedy string tiling of matches (doc[a:a+length], item[b:b+length]): (start in doc, start in item, length), none overlapping.

    The longest match is marked first, of equal ones that which comes first in the document, then in the item; what it covers of the others
    is cut off, and they wait again with what is left.
    """
    if not len(a):
        return []
    heap = [(-int(n), int(x), int(y)) for x, y, n in zip(a, b, length)]
    heapq.heapify(heap)
    lo_d, lo_i = int(a.min()), int(b.min())
    mark_d = np.zeros(int((a + length).max()) - lo_d, bool)
    mark_i = np.zeros(int((b + length).max()) - lo_i, bool)
    out = []
    while heap:
        n, x, y = heapq.heappop(heap)
        n = -n
        taken = mark_d[x - lo_d : x - lo_d + n] | mark_i[y - lo_i : y - lo_i + n]
        if not taken.any():
            mark_d[x - lo_d : x - lo_d + n] = mark_i[y - lo_i : y - lo_i + n] = True
            out.append((x, y, n))
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[True], taken, [True]]).astype(np.int8)))
        for s, e in zip(edge[::2], edge[1::2]):
            if e - s >= SEED:
                heapq.heappush(heap, (-int(e - s), x + int(s), y + int(s)))
    return out


def _reach(a: list[int], b: list[int], most: int) -> list[int]:
    """How far into ``b`` an alignment of the beginnings of ``a`` and ``b`` comes with 0, 1, … ``most`` edits."""
    na, nb = len(a), len(b)

    def slide(x: int, y: int) -> int:
        while x < na and y < nb and a[x] == b[y]:
            x += 1
            y += 1
        return y

    front = {0: slide(0, 0)}  # diagonal (y - x) -> furthest y
    out = [front[0]]
    for _ in range(most):
        new: dict[int, int] = {}
        for k, y in front.items():
            x = y - k
            for dk, yy, xx in ((k, y + 1, x + 1), (k + 1, y + 1, x), (k - 1, y, x + 1)):
                if yy <= nb and xx <= na and new.get(dk, -1) < yy:
                    new[dk] = yy
        front = {k: slide(y - k, y) for k, y in new.items()}
        out.append(max([out[-1], *front.values()]))
    return out


def least_seeds(least: int, per_edit: int) -> int:
    """Seeds that any sufficient passage shares with its item: what its edits can't have destroyed."""
    return max(1, min(n - SEED + 1 - SEED * (n // per_edit) for n in range(least, 2 * least)))


def _met(own: np.ndarray, other: np.ndarray, own_at: np.ndarray, other_at: np.ndarray, width: int, shift: int) -> np.ndarray:
    """Which of the ``width`` pairs of signs from ``own_at`` on stand within ``shift`` of the same place from ``other_at`` on."""
    windows = np.lib.stride_tricks.sliding_window_view
    mine = windows(own, width)[own_at]
    theirs = windows(other, width + 2 * shift)[other_at - shift]
    met = np.zeros(mine.shape, bool)
    for k in range(2 * shift + 1):
        met |= mine == theirs[:, k : k + width]
    return met


def _pairs(c: np.ndarray, pad: int, empty: int) -> np.ndarray:
    """Hashes of neighbouring signs, between two margins that match nothing but by chance."""
    g = ((c[:-1].astype(np.uint32) * np.uint32(2654435761) + c[1:].astype(np.uint32) * np.uint32(40503)) >> np.uint32(15)).astype(np.uint16)
    return np.concatenate([np.full(pad, empty, np.uint16), g, np.full(pad + 1, empty, np.uint16)])


def _promising(c: np.ndarray, own: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray, least: int, per_edit: int) -> np.ndarray:
    """Whether a match (c[a:a+n], own[b:b+n]) of a document and an item can belong to a sufficient passage of ``least`` to 2 * ``least`` signs.

    An edit destroys at most two of the item's pairs of neighbouring signs and shifts the rest by one at most; so
    the pairs before and after the match that aren't met nearby give a lower bound of the edits. First the nearest
    pairs of both sides are looked at (the passage goes on by half of what is missing on one of them), then all.
    """
    edits, reach = (2 * least) // per_edit, 2 * least
    pad = reach + 2 * edits + 2
    doc, item = _pairs(c, pad, 1), _pairs(own, pad, 2)
    back_doc, back_item = np.ascontiguousarray(doc[::-1]), np.ascontiguousarray(item[::-1])

    def sides(x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        after = _met(item, doc, pad + b[x] + n[x] - 1, pad + a[x] + n[x] - 1, width, edits)
        before = _met(back_item, back_doc, len(item) - pad - b[x], len(doc) - pad - a[x], width, edits)
        return before, after

    out = np.zeros(len(a), bool)
    near = 4 * edits
    short = (least - n + 1) // 2 < near
    for at in range(0, len(a), 4096):
        x = np.arange(at, min(at + 4096, len(a)))
        before, after = sides(x, near)
        out[x] = short[x] | (np.maximum(before.sum(1), after.sum(1)) >= near - 2 * edits)
    todo = np.flatnonzero(out)
    for at in range(0, len(todo), 1024):
        x = todo[at : at + 1024]
        # cost of going on by 0, 1, … signs: twice the lost pairs' share of an edit, less the edits that the length allows
        cost = [np.concatenate([np.zeros((len(x), 1)), np.cumsum(~m, 1)], 1) * per_edit / 2 - np.arange(reach + 1) for m in sides(x, reach)]
        onward = np.minimum.accumulate(cost[1][:, ::-1], 1)[:, ::-1]
        missing = np.clip(least - n[x][:, None] - np.arange(reach + 1), 0, reach)
        best = (cost[0] + np.take_along_axis(onward, missing, 1)).min(1)
        out[x] = (best <= n[x]) | (n[x] >= least)
    return out


def passage(doc: np.ndarray, item: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray, least: int, per_edit: int) -> tuple[int, int]:
    """(length in the item, edits) of the longest passage with at most one edit per ``per_edit`` signs, if of ``least`` signs or more; else (0, 0).

    It is sought from all given matches, the longest first. A passage of twice ``least`` or more holds a shorter one that also suffices, so the
    edits looked for are bounded.
    """
    most = (2 * least) // per_edit
    margin = 2 * least + most
    best, span = (0, 0), (0, 0)
    order = np.lexsort((b, a, -length))
    a, b, length = a[order], b[order], length[order]

    def extend(x: int, y: int, n: int) -> None:
        nonlocal best, span
        if span[0] <= y and y + n <= span[1]:
            return  # part of the passage found so far
        left = _reach(doc[max(0, x - margin - most) : x][::-1].tolist(), item[max(0, y - margin) : y][::-1].tolist(), most)
        right = _reach(doc[x + n : x + n + margin + most].tolist(), item[y + n : y + n + margin].tolist(), most)
        for p, l in enumerate(left):
            for q, r in enumerate(right):
                size = l + n + r
                if size >= least and (p + q) * per_edit <= size and (size, -p - q) > (best[0], -best[1]):
                    best, span = (size, p + q), (y - l, y + n + r)

    for x, y, n in zip(a.tolist(), b.tolist(), length.tolist()):
        extend(x, y, n)
    return best


def judged(items: Items, texts: list[str], few: int, least: int, per_edit: int, min_cover: float) -> list[tuple]:
    """(number of the text, id of the item, covered, signs of the item, passage, edits) of the pairs that suffice."""
    c, starts = batch_signs(texts)
    a, b, n = matches(c, items)
    if not len(a):
        return []
    many = len(items.ids)
    pair = (np.searchsorted(starts, a, "right") - 1) * many + np.searchsorted(items.starts, b, "right") - 1
    order = np.lexsort((b, a, pair))
    a, b, n, pair = a[order], b[order], n[order], pair[order]
    heads = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    sizes = (items.ends - items.starts)[pair[heads] % many]
    # what seeds can cover is at most SEED signs each
    seeds = np.add.reduceat(n - SEED + 1, heads)
    keep = np.repeat((seeds >= few) | (seeds * SEED >= min_cover * sizes), np.diff(np.append(heads, len(a))))
    a, b, n, pair = a[keep], b[keep], n[keep], pair[keep]
    if not len(a):
        return []
    heads = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    sizes = (items.ends - items.starts)[pair[heads] % many]
    hopeful = _promising(c, items.signs, a, b, n, least, per_edit)
    good = np.logical_or.reduceat(hopeful, heads) | (np.add.reduceat(n, heads) >= min_cover * sizes)
    edges = np.append(heads, len(a))
    rows = []
    for h in np.flatnonzero(good):
        x = slice(edges[h], edges[h + 1])
        k, m = divmod(int(pair[edges[h]]), many)
        doc = c[starts[k] : starts[k + 1] - 1 if k + 1 < len(starts) else len(c) - 1]
        own = items.signs[items.starts[m] : items.ends[m]]
        at, to, size = a[x] - starts[k], b[x] - items.starts[m], n[x]
        # equal hashes are only a hint
        same = np.array([np.array_equal(doc[p : p + z], own[q : q + z]) for p, q, z in zip(at, to, size)], bool)
        covered = sum(z for _, _, z in tiles(at[same], to[same], size[same]))
        look = same & hopeful[x]
        found, edits = passage(doc, own, at[look], to[look], size[look], least, per_edit) if look.any() else (0, 0)
        if found or covered >= min_cover * len(own):
            rows.append((k, items.ids[m], int(covered), len(own), int(found), int(edits)))
    return rows


def _slots(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of hashes in a filter of 2**bits bits."""
    return h >> np.uint64(64 - bits), (h * np.uint64(BASE)) >> np.uint64(64 - bits)


def _has(words: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0


def _signed(df: DataFrame) -> DataFrame:
    """(i, s) from (i, t): the signs of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([signs(t) for t in batch.column(1).to_pylist()], pa.string())], names=["i", "s"])

    return df.mapInArrow(run, "i bigint, s string")


def _fingerprint():
    return F.struct(F.xxhash64("s").alias("a"), F.xxhash64(F.lit(1), "s").alias("b"))


def _filter(items: DataFrame, bits: int) -> np.ndarray:
    """A filter of 2**bits bits that holds the seeds of the items (s), put together on the workers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, _ = batch_signs(batch.column(0).to_pylist(), ITEM_END)
            slot = np.unique(np.concatenate(_slots(window_hashes(c), bits)))
            word, first = np.unique(slot >> np.uint64(6), return_index=True)
            if len(word):
                held = np.bitwise_or.reduceat(np.uint64(1) << (slot & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(held.view(np.int64))], names=["word", "held"])

    made = items.select("s").mapInArrow(run, "word bigint, held bigint").groupBy("word").agg(F.bit_or("held").alias("held")).toArrow()
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[made.column("word").to_numpy()] = made.column("held").to_numpy().view(np.uint64)
    return words


def _seeds(items: DataFrame) -> DataFrame:
    """(h, j, m): the hashes of each item's windows and how many of them have it, from (j, s)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, text in enumerate(batch.column(1).to_pylist()):
                h, m = np.unique(window_hashes(_codes(text)), return_counts=True)
                own = batch.column(0).take(pa.array(np.full(len(h), at)))
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), own, pa.array(m)], names=["h", "j", "m"])

    return items.select("j", "s").mapInArrow(run, "h bigint, j struct<a: bigint, b: bigint>, m bigint")


def leaks(docs: DataFrame, doc_id: str, doc_text: str, items: DataFrame, item_id: str, item_text: str, least: int = 110, per_edit: int = 20, min_cover: float = 0.5) -> DataFrame:
    """(doc_id, item_id, covered, item_signs, passage, edits) of the documents that hold an item, wholly or in part.

    ``covered``: signs of the item under tiles of at least 16 signs, in any order; ``passage``: signs of the longest
    run of the item that stands in the document with at most one in ``per_edit`` changed, missing or added (0 if
    under ``least``). A pair is returned for such a passage or for a coverage of ``min_cover`` or more. Null and
    empty texts match nothing; items shorter than 16 signs can't be found; repeated documents and items each count.
    Items of more than HELD_SIGNS signs give the same rows by an exchange of the documents that share enough seeds with them.
    """
    require_columns(docs, doc_id, doc_text)
    require_columns(items, item_id, item_text)
    known = _signed(items.select(F.col(item_id).cast("bigint").alias("i"), F.col(item_text).alias("t")).where(F.col("t").isNotNull())).where(F.length("s") >= SEED)
    sizes = known.agg(F.sum(F.length("s")).alias("n"), F.min(F.length("s")).alias("least")).first()
    texts = docs.select(F.col(doc_id).alias("k"), F.col(doc_text).alias("t")).where(F.col("t").isNotNull())
    rule = (least_seeds(least, per_edit), least, per_edit, min_cover)
    total = int(sizes["n"] or 0)
    out = _by_held_items(texts, known, rule) if total <= HELD_SIGNS else _by_exchange(texts, known, rule, total, int(sizes["least"]))
    return out.withColumnsRenamed({"k": doc_id, "i": item_id})


_FOUND = "covered int, item_signs int, passage int, edits int"


def _columns(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array([r[j] for r in rows], pa.int32()) for j in range(2, 6)]


def _by_held_items(texts: DataFrame, known: DataFrame, rule: tuple) -> DataFrame:
    own = known.select("i", "s").toArrow()
    held = texts.sparkSession.sparkContext.broadcast((own.column("i").to_pylist(), own.column("s").to_pylist()))  # of HELD_SIGNS signs at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*held.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = judged(items, batch.column(1).slice(at, 512).to_pylist(), *rule) if items.ids else []
                keys = batch.column(0).slice(at, 512).take(pa.array([r[0] for r in rows], pa.int64()))
                yield pa.RecordBatch.from_arrays([keys, pa.array([r[1] for r in rows], pa.int64()), *_columns(rows)], names=["k", "i", "covered", "item_signs", "passage", "edits"])

    return texts.mapInArrow(run, f"k {dict(texts.dtypes)['k']}, i bigint, {_FOUND}")


def _by_exchange(texts: DataFrame, known: DataFrame, rule: tuple, total: int, shortest: int) -> DataFrame:
    """The documents that a filter of the items' seeds lets through are written once; their seeds are joined to those of the items, and equal texts are compared once."""
    few, _, _, min_cover = rule
    known = checkpointed(known.withColumn("j", _fingerprint()))
    own = known.select("j", "s").dropDuplicates(["j"])
    bits = max(16, (min(FILTER_MOST, total * FILTER_SHARE) - 1).bit_length())
    held = texts.sparkSession.sparkContext.broadcast(_filter(own, bits))  # of FILTER_MOST bits at most
    hits = min(few, max(1, int(np.ceil(min_cover * shortest / SEED))))  # as many of a document's windows are in the tiles or the passage of a pair

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = held.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                keys, part = batch.column(0).slice(at, 512), batch.column(1).slice(at, 512).to_pylist()
                c, starts = batch_signs(part)
                h = window_hashes(c)
                first, second = _slots(h, bits)
                near = np.flatnonzero(_has(words, first))
                near = near[_has(words, second[near])]
                doc = np.searchsorted(starts, near, "right") - 1
                keep = np.flatnonzero(np.bincount(doc, minlength=len(part)) >= hits)
                ends = np.append(starts[1:], len(c)) - 1
                found = [np.unique(h[near[doc == j]]).view(np.int64) for j in keep]
                text = [c[starts[j] : ends[j]].astype("<u4").tobytes().decode("utf-32-le") for j in keep]
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(keep, pa.int64())), pa.array(text, pa.string()), pa.array(found, pa.list_(pa.int64()))], names=["k", "s", "hs"])

    near = checkpointed(texts.mapInArrow(scan, f"k {dict(texts.dtypes)['k']}, s string, hs array<bigint>").withColumn("g", _fingerprint()))
    once = near.select("g", "s", "hs").dropDuplicates(["g"])
    shared = once.select("g", F.explode("hs").alias("h")).join(_seeds(own), "h").groupBy("g", "j").agg(F.sum("m").alias("n"))
    pairs = shared.join(own.withColumnRenamed("s", "item"), "j").where((F.col("n") >= few) | (F.col("n") * SEED >= min_cover * F.length("item")))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at, (text, item) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                rows += [(at, *r[1:]) for r in judged(Items([0], [item], 16), [text], *rule)]
            keep = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep), *_columns(rows)], names=["g", "j", "covered", "item_signs", "passage", "edits"])

    pair = "struct<a: bigint, b: bigint>"
    found = pairs.join(once.select("g", "s"), "g").select("g", "j", "s", "item").mapInArrow(verify, f"g {pair}, j {pair}, {_FOUND}")
    return near.select("k", "g").join(found, "g").join(known.select("i", "j"), "j").select("k", "i", "covered", "item_signs", "passage", "edits")
