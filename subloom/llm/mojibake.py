"""Text that was decoded with the wrong encoding: found and restored through a hidden Markov model.

The model has one clean state and one state per encoding pair. A state emits characters given the character
before; its counts come from the whole corpus itself: the clean state counts the texts as they are, the state of a pair
counts the same texts after the pair's damage. Counts are kept in tables of a fixed size (exact for single
characters of the basic plane, hashed for pairs of characters), so what is broadcast doesn't grow with the data.
A first model looks at single characters only: given the character before, damage that is in the corpus would
explain itself. Texts that it restores or that hold a lost character are left out of the next one: their counts are subtracted.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subloom.session import checkpointed, require_columns

#: The encoding the text was written in, the one it was read in, and how many times over.
PAIRS = (
    ("utf-8", "cp1252", 1),
    ("utf-8", "cp1252", 2),
    ("utf-8", "latin-1", 1),
    ("utf-8", "cp1251", 1),
    ("utf-8", "koi8-r", 1),
    ("utf-8", "mac_roman", 1),
    ("utf-8", "cp437", 1),
    ("utf-8", "cp850", 1),
    ("utf-8", "cp932", 1),
    ("utf-8", "gb18030", 1),
    ("cp932", "cp1252", 1),
    ("cp932", "latin-1", 1),
    ("cp932", "gb18030", 1),
    ("cp932", "utf-8", 1),
    ("euc_jp", "latin-1", 1),
    ("euc_jp", "cp932", 1),
    ("euc_jp", "gb18030", 1),
    ("euc_jp", "utf-8", 1),
    ("gb18030", "latin-1", 1),
    ("gb18030", "cp932", 1),
    ("gb18030", "utf-8", 1),
    ("cp1252", "cp850", 1),
    ("cp1252", "cp437", 1),
    ("cp1252", "mac_roman", 1),
    ("cp1252", "cp1251", 1),
    ("cp1252", "utf-8", 1),
    ("cp1252", "cp932", 1),
)
STATES = 1 + len(PAIRS)
#: Sizes of the tables of counts: single characters, and hashed pairs of characters.
SINGLE, DOUBLE = 1 << 16, 1 << 18
#: Probabilities of starting in and entering a given damaged state, and of leaving it; weight of the single-character estimate.
START, ENTER, LEAVE, BACKOFF = 1e-3, 1e-4, 0.02, 4.0
#: Weight of texts of Western alphabets in the damaged states of UTF-8.
WESTERN = 8
#: The first of these two in the first round, in which a text that is left out for nothing does little harm.
READY = 1e-2
#: How much more probable in the clean state a restored span must be, in logarithms.
MARGIN = 3.0
#: A character is known if it makes up this share of all clean ones; so much of a restored span must be known.
KNOWN, FAMILIAR = 2e-5, 0.8
#: A span that can't be restored and shows no trace of a decoder counts from so many characters beyond ASCII.
BARE = 6
#: No text holds these characters on purpose: the first stands where a decoder gave up, the others where it met a byte without a character.
LOST = "�"
TRACES = (LOST, *(chr(c) for c in range(0x80, 0xA0) if c != 0x85))
ROWS = 2048
#: At most so many tasks count, each of which returns no more than the tables' slots.
COUNTERS = 256


@lru_cache
def _byte_table(name: str) -> tuple[str, object]:
    """A one-byte encoding as (its 256 characters, a map to write them); bytes it leaves undefined stay control characters, as common decoders do."""
    read = []
    for b in range(256):
        try:
            read.append(bytes([b]).decode(name))
        except UnicodeDecodeError:
            read.append(chr(b))
    return "".join(read), codecs.charmap_build("".join(read))


ONE_BYTE = ("cp1252", "latin-1", "cp1251", "koi8-r", "mac_roman", "cp437", "cp850")


def _write(text: str, name: str) -> bytes | None:
    """The bytes of a text, or None if the encoding lacks a character."""
    try:
        if name in ONE_BYTE:
            return codecs.charmap_encode(text, "strict", _byte_table(name)[1])[0]
        return text.encode(name)
    except UnicodeEncodeError:
        return None


def _read(data: bytes, name: str, errors: str = "replace") -> str | None:
    if name in ONE_BYTE:
        return codecs.charmap_decode(data, "strict", _byte_table(name)[0])[0]
    try:
        return data.decode(name, errors)
    except UnicodeDecodeError:
        return None


def damage(text: str, pair: int) -> str | None:
    """What comes of a text by a pair; None if the text can't be written in its encoding."""
    written, read, times = PAIRS[pair]
    for _ in range(times):
        data = _write(text, written)
        if data is None:
            return None
        text = _read(data, read)
    return text


def restore(text: str, pair: int) -> str | None:
    """The text before the damage of a pair, if that can be undone without loss; else None."""
    written, read, times = PAIRS[pair]
    now = text
    for _ in range(times):
        data = _write(now, read)
        now = None if data is None else _read(data, written, "strict")
        if now is None:
            return None
    return now if damage(now, pair) == text else None


def _codes(text: str) -> np.ndarray:
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), SINGLE - 1).astype(np.int64)


def _double(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    return ((before * 2654435761 + now * 40503) >> 7) & (DOUBLE - 1)


def _count(texts: list[str]) -> np.ndarray:
    """Counts of the states over some texts: [STATES, SINGLE + DOUBLE]. Each text counts by itself, so counts of parts add up to that of the whole."""
    out = np.zeros((STATES, SINGLE + DOUBLE), np.int64)

    def add(state: int, text: str, times: int = 1) -> None:
        c = _codes("\n" + text)
        out[state, :SINGLE] += times * np.bincount(c[1:], minlength=SINGLE)
        out[state, SINGLE:] += times * np.bincount(_double(c[:-1], c[1:]), minlength=DOUBLE)

    def hurt(state: int, lines: list[bytes], times: int = 1) -> None:
        if lines:
            written, read, over = PAIRS[state - 1]
            # a decoder takes what is cut off by a line break as that alone, but what is cut off by the end with all that is left
            text = _read(b"\n".join(lines) + b"\n\n\n\n", read)
            for _ in range(over - 1):
                text = _read(_write(text, written) or b"", read)
            add(state, text[:-3], times)

    if texts:
        add(0, "\n".join(texts) + "\n")
    writable: dict[str, list[bytes]] = {}
    other = [t for t in texts if not t.isascii()]
    for name in dict.fromkeys(p[0] for p in PAIRS):
        writable[name] = [b for t in other if (b := _write(t, name)) is not None]
    # texts of Western alphabets hold few damaged characters each: where both are written, they count as much as all others
    western = [t.decode("cp1252", "ignore").encode() for t in writable["cp1252"]]
    for i, (written, _, _) in enumerate(PAIRS):
        hurt(i + 1, writable[written])
        if written == "utf-8":
            hurt(i + 1, western, WESTERN - 1)
    return out


def _counts(texts: DataFrame) -> np.ndarray:
    """The counts over a column ``t`` of texts, summed over all partitions, as whole numbers; how many there are is that of the tables' slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = None, [], 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                held.append(t)
                size += len(t)
                if size > 1_000_000:
                    total, held, size = _count(held) + (0 if total is None else total), [], 0
        if held:
            total = _count(held) + (0 if total is None else total)
        if total is not None:
            flat = total.ravel()
            at = np.flatnonzero(flat)
            for i in range(0, len(at), 100_000):
                part = at[i : i + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(flat[part])], names=["slot", "n"])

    made = texts.coalesce(COUNTERS).mapInArrow(run, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(STATES * (SINGLE + DOUBLE), np.int64)
    out[made.column("slot").to_numpy()] = made.column("n").to_numpy()
    return out.reshape(STATES, SINGLE + DOUBLE)


class Model:
    """The emissions of all states; :meth:`label` gives the most probable states of texts."""

    def __init__(self, counts: np.ndarray, alone: bool = False):
        self.alone = alone
        self.start, self.enter = (np.log(READY), np.log(READY)) if alone else (np.log(START), np.log(ENTER))
        single = counts[:, :SINGLE].T + np.float32(0)
        total = single.sum(0)
        p = (single + 0.5) / (total + 0.5 * SINGLE)
        p[[ord(c) for c in TRACES], 0] = 1e-12
        self.single = p.astype(np.float32)
        self.logs = np.log(self.single)
        self.seen = single.astype(np.float32)
        self.known = single[:, 0] >= max(3.0, KNOWN * float(total[0]))
        self.double = np.ascontiguousarray(counts[:, SINGLE:].T)

    def emissions(self, before: np.ndarray, now: np.ndarray) -> np.ndarray:
        """Log-probabilities [n, STATES] of characters, each given the one before."""
        if self.alone:
            return self.logs[now]
        pair = self.double[_double(before, now)]
        pair[(now == ord(LOST)) | ((now >= 0x80) & (now < 0xA0) & (now != 0x85)), 0] = 0
        return np.log((pair + BACKOFF * self.single[now]) / (np.maximum(self.seen[before], pair) + BACKOFF))

    def label(self, texts: list[str]) -> list[np.ndarray | None]:
        """The state of each character, or None for a text that is clean throughout."""
        out: list[np.ndarray | None] = [None] * len(texts)
        todo = [i for i, t in enumerate(texts) if t and not t.isascii()]
        todo.sort(key=lambda i: len(texts[i]))
        enter, start, leave, stay = self.enter, self.start, np.log(LEAVE), np.log(1 - LEAVE)
        if not todo:
            return out
        # each pair of neighbouring characters is worked out once
        codes = _codes("\n" + "\n".join(texts[i] for i in todo))
        distinct, which = np.unique(codes[:-1] << 16 | codes[1:], return_inverse=True)
        known = self.emissions(distinct >> 16, distinct & 0xFFFF)
        gains = np.maximum(known[:, 1:] - known[:, :1], 0)
        lengths = np.array([len(texts[i]) for i in todo])
        begins = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        # no path through a damaged state can win if its gains don't pay for the way in
        most = np.concatenate([[0.0], np.cumsum(gains.max(1)[which], dtype=np.float64)])
        hopeful = [j for j in np.flatnonzero(most[begins + lengths] - most[begins] + start > -1e-6) if gains[which[begins[j] : begins[j] + lengths[j]]].sum(0).max() + start > 0]
        at = 0
        while at < len(hopeful):
            end = at + 1
            while end < len(hopeful) and (end + 1 - at) * lengths[hopeful[end]] <= 60_000:
                end += 1
            keep = [todo[j] for j in hopeful[at:end]]
            pieces = [known[which[begins[j] : begins[j] + lengths[j]]] for j in hopeful[at:end]]
            at = end
            n = len(keep)
            width = max(len(p) for p in pieces)
            grid = np.zeros((width, n, STATES), np.float32)
            for j, p in enumerate(pieces):
                grid[: len(p), j] = p
            score = np.full((n, STATES), start, np.float32)
            score[:, 0] = 0
            score += grid[0]
            from_clean = np.zeros((width, n, STATES), bool)
            to_clean = np.zeros((width, n), np.int16)

            def advance(t: int, score: np.ndarray) -> np.ndarray:
                best = score[:, 1:].argmax(1) + 1
                out_of = score[np.arange(n), best] + leave
                to_clean[t] = np.where(score[:, 0] >= out_of, 0, best)
                inward, held = score[:, :1] + enter, score + stay
                from_clean[t] = inward > held
                new = np.maximum(inward, held)
                new[:, 0] = np.maximum(score[:, 0], out_of)
                return new + grid[t]

            sizes = np.array([len(p) for p in pieces])
            last = np.zeros(n, np.int64)
            for t in range(width):
                if t:
                    score = advance(t, score)
                # a text's path ends where the text does, not in the padding
                ended = np.flatnonzero(sizes == t + 1)
                last[ended] = score[ended].argmax(1)
            for j, i in enumerate(keep):
                length, state = len(pieces[j]), int(last[j])
                path = np.zeros(length, np.int16)
                for t in range(length - 1, -1, -1):
                    path[t] = state
                    if state == 0:
                        state = int(to_clean[t, j])
                    elif from_clean[t, j, state]:
                        state = 0
                if path.any():
                    out[i] = path
        return out

    def clean_score(self, text: str) -> float:
        """The log-probability of a text in the clean state."""
        c = _codes("\n" + text)
        before, now = c[:-1], c[1:]
        if self.alone:
            return float(self.logs[now, 0].sum())
        pair = self.double[_double(before, now), 0]
        pair[(now == ord(LOST)) | ((now >= 0x80) & (now < 0xA0) & (now != 0x85))] = 0
        return float(np.log((pair + BACKOFF * self.single[now, 0]) / (np.maximum(self.seen[before, 0], pair) + BACKOFF)).sum())

    def familiar(self, text: str) -> bool:
        """Nearly all characters of a text beyond ASCII are ones that clean texts hold."""
        other = [c for c in text if not c.isascii()]
        return not other or sum(bool(self.known[min(ord(c), SINGLE - 1)]) for c in other) >= FAMILIAR * len(other)

    def judge(self, text: str, path: np.ndarray) -> tuple[str, bool, str] | None:
        """(restored text, whether all of it was, the pairs) from the labelled spans; None if no span is damaged.

        A span that its inverse leaves as it is, or doesn't make more like a clean text of known characters, has no damage. Where a state's
        own inverse doesn't help, those of the other pairs read in the same encoding are tried.
        """
        cuts = np.flatnonzero(np.diff(path)) + 1
        made, whole, pairs = [], True, []
        for a, b in zip([0, *cuts], [*cuts, len(text)]):
            span, state = text[a:b], int(path[a]) - 1
            if state < 0 or span.isascii():
                made.append(span)
                continue
            best, pair, readable = None, state, False
            if LOST not in span:
                least = self.clean_score(text) + MARGIN
                for p in [state, *[q for q in range(len(PAIRS)) if q != state and PAIRS[q][1] == PAIRS[state][1]]]:
                    back = restore(span, p)
                    readable |= p == state and back is not None
                    if back is not None and back != span and self.familiar(back) and self.clean_score(text[:a] + back + text[b:]) >= least:
                        best, pair = back, p
                        break
            traced = any(c in span for c in TRACES)
            if best is None and not traced and (readable or sum(not c.isascii() for c in span) < BARE):
                made.append(span)
                continue
            pairs.append(" read as ".join(PAIRS[pair][:2]))
            whole &= best is not None
            made.append(span if best is None else best)
        return ("".join(made), whole, "|".join(dict.fromkeys(pairs))) if pairs else None


def fit(texts: DataFrame) -> np.ndarray:
    """The counts of the final model over a DataFrame with one column ``t`` of texts, all of which are counted."""
    texts = texts.where(F.col("t").isNotNull())
    whole = _counts(texts)
    counts = whole.astype(np.float32)
    for alone in (True, False):
        known = texts.sparkSession.sparkContext.broadcast(counts)

        def unsound(batches: Iterator[pa.RecordBatch], known=known, alone=alone) -> Iterator[pa.RecordBatch]:
            model = Model(known.value, alone)
            for batch in batches:
                for i in range(0, batch.num_rows, ROWS):
                    part = batch.column(0)[i : i + ROWS].to_pylist()
                    labels = model.label(part)
                    left = [t for t, x in zip(part, labels) if LOST in t or (x is not None and (m := model.judge(t, x)) is not None and m[1])]
                    yield pa.RecordBatch.from_arrays([pa.array(left, pa.string())], names=["t"])

        counts = (whole - _counts(texts.mapInArrow(unsound, "t string"))).astype(np.float32)
    return counts


def repair(df: DataFrame, key: str, column: str, sample: int | None = None) -> DataFrame:
    """(key, <column>_restored, restored, encodings) of the rows whose text is garbled, wholly or in part.

    ``restored`` is true if every damaged span could be turned back without loss; spans that can't stay as they
    are. ``encodings`` names the pairs found. Null and empty texts are never garbled, and a text of ASCII alone can't be told from a sound
    one; texts are judged whole, whatever their length. Repeated rows each count; other columns are ignored. The model is fitted on all texts; only a caller
    that names a ``sample`` has it fitted on about so many.
    """
    require_columns(df, key, column)
    texts = df.select(F.col(key).alias("_k"), F.col(column).alias("t")).where(F.col("t").isNotNull())
    taught = texts
    if sample is not None:
        share = min(1.0, sample / max(1, df.count()))
        taught = checkpointed(texts.where(F.xxhash64(F.lit(7), "_k", "t") <= min(2**63 - 1, int(-(2**63) + share * 2**64))))
    counts = df.sparkSession.sparkContext.broadcast(fit(taught.select("t")))
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(counts.value)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                keys = batch.column(0).slice(i, ROWS)
                part = batch.column(1).slice(i, ROWS).to_pylist()
                labels = model.label(part)
                hit = [j for j, x in enumerate(labels) if x is not None]
                judged = [model.judge(part[j], labels[j]) for j in hit]
                hit = [j for j, m in zip(hit, judged) if m]
                made = [m for m in judged if m]
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(hit, pa.int64())), pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.bool_()), pa.array([m[2] for m in made], pa.string())],
                    names=["k", "r", "w", "e"],
                )

    made = texts.mapInArrow(run, f"k {kind}, r string, w boolean, e string")
    return made.select(F.col("k").alias(key), F.col("r").alias(f"{column}_restored"), F.col("w").alias("restored"), F.col("e").alias("encodings"))
