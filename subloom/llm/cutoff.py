"""Texts that stop before they are finished, found by a classifier that is taught on texts cut on purpose.

A bounded sample of the texts serves as intact examples; each of them is also cut at random places, with and without a mark
at the break. Hashed closing characters, punctuation, the shape of the last lines and the distance to the source's length
limits are the features of a logistic regression; sampled texts that a fit on the other texts takes for cut are left out of the last
one. Limits are counted over all distinct texts, and every text is scored. The texts are read once: what is needed of each, its
end and its lengths, is written, and the whole text only of the sample.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subloom.session import checkpointed, require_columns

#: Texts of the sample; the classifier is fitted on them on the driver.
SAMPLE = 8000
#: Artificial cuts of each sampled text.
CUTS = 3
DIMENSIONS = 1 << 18
#: Marks left at a break and how often; one that also ends sound texts is put there rarely.
MARKS = {"": 0.6, "...": 0.14, "�": 0.14, " ...": 0.02, "[...]": 0.02, "-": 0.02, "\n": 0.02, "」": 0.01, "…": 0.005, "……": 0.005}
#: A length is taken for a limit of its source if so many distinct texts have exactly that length, and this share of the source's distinct texts.
LIMIT_TEXTS, LIMIT_SHARE = 6, 0.01
#: Sizes in bytes that a source may transfer its texts in, the bytes by which a broken character may shift the end, and how far beyond chance (in standard
#: deviations) the texts that end there must be.
BLOCKS, SHIFT, CLEAR = tuple(1 << k for k in range(6, 17)), 3, 8.0
#: Characters at the end of a text that its features are taken from.
TAIL = 160
#: Limits of up to so many sources are sent to every worker.
HELD_SOURCES = 10_000
#: The sample is cleaned of texts that really are cut: each part is judged by a fit on the others, this many times, and kept below this probability.
FOLDS, ROUNDS, SOUND = 3, 3, 0.3
#: Probability from which a text counts as cut: far more of the examples than of real texts are cut.
BAR = 0.9
_TRAIL = re.compile(r"[\s.…。．!！?？」』”\"’'）)\]】〕》>♪*—–\-・、，,;:；：�]+\Z")
_ENDING = re.compile(r"[.…。．!！?？」』”\")）\]】〕♪]\Z")
_SHAPES = [(re.compile(a), b) for a, b in ((r"[0-9]+", "9"), (r"[ぁ-ゖ]+", "h"), (r"[ァ-ヺー]+", "k"), (r"[㐀-鿿々]+", "c"), (r"[A-ZÀ-Þ]+", "A"), (r"[a-zß-ÿœ]+", "a"))]


def _shape(line: str) -> str:
    for pattern, sign in _SHAPES:
        line = pattern.sub(sign, line)
    return line[-16:]


def _slots(names: list[str]) -> list[int]:
    return [crc32(x.encode("utf-8", "surrogatepass")) & (DIMENSIONS - 1) for x in names]


def _off(size: int, limits: list[int]) -> int:
    """How far a size is from the nearest of the limits, between two equally near ones from the smaller; at most 4 either way."""
    return max(-4, min(4, size - min(limits, key=lambda x: (abs(size - x), x))))


def at_limits(chars: int, size: int, last: str, limits: tuple) -> list[int]:
    """Slots of the features that tell how far a text of ``chars`` characters and ``size`` bytes is from the nearest of its source's limits.

    limits: lengths in characters, in bytes, and the size of a block; each may be None.
    """
    char_limits, byte_limits, block = limits
    out = []
    if char_limits:
        out += [f"C{_off(chars, char_limits)}", f"C{chars in char_limits}|{last}"]
    if byte_limits:
        out.append(f"B{_off(size, byte_limits)}")
    if block:
        near = (size + SHIFT) % block < 2 * SHIFT
        out += [f"P{near}", f"P{near}|{last}"]
    return _slots(out)


def closing(text: str) -> list[int]:
    """Slots of the features of a text's end; no more than its last TAIL characters are looked at."""
    tail = text[-TAIL:]
    seen = tail.rstrip(" \t\r\n　")
    core = _TRAIL.sub("", seen)
    mark = seen[len(core) :]
    out = [f"r{seen[-k:]}" for k in range(1, 7)]
    out += [f"c{core[-k:]}" for k in (1, 2, 3, 4, 6)]
    low = core[-6:].lower()
    out += [f"i{low[-k:]}|{mark[:1]}" for k in (2, 4, 6)]
    out += [f"m{mark[:6]}", f"m{mark[:6]}|{core[-1:]}", f"m{mark[:6]}|{core[-2:]}", f"m{mark[:6]}|{core[-3:]}"]
    lines = seen.split("\n")
    last, before = lines[-1], lines[-2] if len(lines) > 1 else ""
    shape = _shape(last)
    out += [f"s{shape}", f"s{_shape(before)}|{shape}", f"n{min(len(last), 12)}|{mark[:1]}"]
    word = re.search(r"[A-Za-zÀ-ÿ’']+\Z", core)
    script = _shape(core[-1:])
    out += [f"w{word.group()}|{mark[:2]}" if word else f"k{script}|{mark[:2]}", f"t{script}|{mark[:1]}|{tail[len(seen):][:2]!r}"]
    # a subtitle's text follows a line with times
    cue = "-->" in before or (len(lines) > 2 and "-->" in lines[-3 if before else -2])
    out += [f"q{cue}|{'-->' in last}|{mark[:1]}|{script}", f"q{cue}|{mark[:1]}|{core[-2:]}"]
    return _slots(out)


def _padded(rows: list[list[int]]) -> np.ndarray:
    """Slots as an array; slot DIMENSIONS has no weight."""
    out = np.full((len(rows), max(map(len, rows))), DIMENSIONS, np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def train(x: np.ndarray, y: np.ndarray, epochs: int = 4, rate: float = 0.15, decay: float = 1e-6, seed: int = 1) -> np.ndarray:
    """Weights of a logistic regression by AdaGrad; the last weight is the intercept."""
    rng = np.random.default_rng(seed)
    w = np.zeros(DIMENSIONS + 2)
    g2 = np.full(DIMENSIONS + 2, 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), 128):
            b = order[at : at + 128]
            p = 1 / (1 + np.exp(-(w[x[b]].sum(1) + w[-1])))
            d = p - y[b]
            slots = np.append(x[b].ravel(), np.full(len(b), DIMENSIONS + 1))
            grad = np.append(np.repeat(d, x.shape[1]), d)
            used, back = np.unique(slots, return_inverse=True)
            step = np.bincount(back, grad) + decay * w[used]
            g2[used] += step * step
            w[used] -= rate * step / np.sqrt(g2[used])
            w[DIMENSIONS] = 0
    return w


def cut(text: str, rng: random.Random) -> str | None:
    """The text cut at a random place, perhaps with a mark at the break; None if what is left may be finished."""
    if len(text) < 24:
        return None
    at = rng.randrange(12, len(text))
    left, right = text[:at], text[at:]
    bare = left.rstrip()
    last = bare.rsplit("\n", 1)[-1]
    whole_line = right[:1] in ("\n", "\r") or left != bare
    if _ENDING.search(bare) or not bare or not right.strip() or _TRAIL.sub("", right) == "":
        return None
    if whole_line and not (last.isdigit() or "-->" in last or right[:1].isascii() and right[:1].isalpha()) and "\n" in (left[len(bare) :] + right[:1]):
        return None
    return left + rng.choices(list(MARKS), list(MARKS.values()))[0]


def fit(sample: list[tuple[str, tuple]], seed: int = 7) -> tuple[np.ndarray, dict]:
    """(weights, figures on held-out texts) from (text, limits of its source) examples, in a fixed order."""
    rng = random.Random(seed)
    held = max(1, len(sample) // 10)
    own, artificial = [], []
    for text, limits in sample:
        chars, size, block = limits
        own.append((closing(text), at_limits(len(text), len(text.encode()), text[-1:], limits)))
        made = []
        for _ in range(CUTS):
            part = cut(text, rng)
            if part is None:
                continue
            # as a field limit would have cut it, or at no limit at all
            at = rng.random()
            n, length = len(part.encode()), len(part)
            if block and 0.3 <= at < 0.45:
                n = block * -(-n // block)
            limited = at_limits(length, n, part[-1:], ([length] if chars and at < 0.15 else chars, [n] if size and 0.15 <= at < 0.3 else size, block))
            made.append((closing(part), limited))
        artificial.append(made)
    kept = np.ones(len(sample), bool)
    fold = np.arange(len(sample)) % FOLDS

    # which texts are intact is judged by their ends alone: most texts at a limit are cut
    def learn(chosen: np.ndarray, whole: bool) -> np.ndarray | None:
        rows = [(own[i], 0) for i in np.flatnonzero(chosen & kept)] + [(r, 1) for i in np.flatnonzero(chosen) for r in artificial[i]]
        y = np.array([y for _, y in rows], float)
        return train(_padded([a + b if whole else a for (a, b), _ in rows]), y) if 0 < y.sum() < len(y) else None

    for _ in range(ROUNDS):
        judged = np.zeros(len(sample))
        for k in range(FOLDS):
            if (w := learn(fold != k, False)) is None:
                return np.zeros(DIMENSIONS + 2), {"texts": len(sample), "held_out": 0}
            at = np.flatnonzero(fold == k)
            judged[at] = score(w, [own[i][0] for i in at])
        kept = judged < SOUND
    w = learn(np.arange(len(sample)) >= held, True)
    if w is None:
        return np.zeros(DIMENSIONS + 2), {"texts": len(sample), "held_out": 0}
    a, b = score(w, [x + y for x, y in own[:held]]), [x + y for m in artificial[:held] for x, y in m]
    found = score(w, b) >= BAR if b else np.zeros(0)
    return w, {"texts": len(sample), "held_out": held, "cut_found": float(np.mean(found)) if len(found) else 0.0, "intact_taken": float((a >= BAR).mean())}


def score(w: np.ndarray, rows: list[list[int]]) -> np.ndarray:
    """Probabilities of being cut."""
    if not rows:
        return np.zeros(0)
    return 1 / (1 + np.exp(-np.clip(w[_padded(rows)].sum(1) + w[-1], -40, 40)))


def _limits(texts: DataFrame) -> DataFrame:
    """(s, chars, bytes, block) from (s, h, c, b), the hash and the lengths of each text: per source the lengths that enough of its distinct texts have to be limits, in order; LIMIT_SHARE
    bounds their number. block: the size of BLOCKS whose multiples the lengths in bytes meet most clearly beyond chance, if any."""
    # copies of a text tell nothing of a limit: each text counts once for its source
    texts = texts.select("s", "h", "c", "b").distinct()
    sizes = texts.select("s", F.explode(F.array(F.struct(F.lit("c").alias("u"), F.col("c").alias("n")), F.struct(F.lit("b").alias("u"), F.col("b").alias("n")))).alias("x"))
    counted = sizes.groupBy("s", "x.u", "x.n").agg(F.count("*").alias("k"))
    totals = counted.where("u = 'c'").groupBy("s").agg(F.sum("k").alias("all"))
    common = counted.where(F.col("k") >= LIMIT_TEXTS).join(totals, "s").where(F.col("k") >= LIMIT_SHARE * F.col("all"))
    each = lambda u: F.array_sort(F.collect_list(F.when(F.col("u") == u, F.col("n"))))
    lengths = common.groupBy("s").agg(each("c").alias("chars"), each("b").alias("bytes"))
    hits = [F.count_if((F.col("b") > m) & ((F.col("b") + SHIFT) % m < 2 * SHIFT)).alias(f"_h{m}") for m in BLOCKS] + [F.count_if(F.col("b") > m).alias(f"_n{m}") for m in BLOCKS]
    beyond = []
    for m in BLOCKS:
        chance = F.col(f"_n{m}") * F.lit(2 * SHIFT / m)
        more = F.col(f"_h{m}") - chance
        clear = more / F.sqrt(F.greatest(chance, F.lit(1.0)))
        beyond.append(F.when((clear >= CLEAR) & (F.col(f"_h{m}") >= LIMIT_TEXTS) & (more >= LIMIT_SHARE * F.col("_all")), F.struct(clear.alias("z"), F.lit(m).alias("m"))))
    blocks = texts.groupBy("s").agg(F.count("*").alias("_all"), *hits).select("s", F.array_max(F.array_compact(F.array(*beyond)))["m"].alias("block"))
    return lengths.join(blocks.where("block is not null"), "s", "full")


def scored(df: DataFrame, key: str, text: str, source: str, sample: int = SAMPLE) -> DataFrame:
    """(key, source, p_cut, is_cut) of every text: the probability that it breaks off before it is finished.

    Null and blank texts aren't texts that stop early: their ``p_cut`` is 0. A null source is a source of its own.
    At most ``sample`` texts, drawn by their hashes, are fetched for the fit; every text is scored by its closing characters and its whole length. Repeated rows each count.
    """
    require_columns(df, key, text, source)
    spark = df.sparkSession
    share = min(1.0, 1.1 * sample / max(1, df.count()))
    lot = F.xxhash64(F.lit(11), "k", "t")
    sound = F.col("t").rlike(r"(?U)[^\s\x1c-\x1f]")
    drawn = sound & (lot <= min(2**63 - 1, int(-(2**63) + share * 2**64)))
    rows = df.select(F.col(key).alias("k"), F.col(source).cast("string").alias("s"), F.col(text).alias("t"))
    ends = rows.select(
        "k", "s", F.xxhash64("t").alias("h"), F.length("t").alias("c"), F.octet_length("t").alias("b"), F.expr(f"right(t, {TAIL})").alias("tail"), F.coalesce(sound, F.lit(False)).alias("ok"),
        F.when(drawn, lot).alias("lot"), F.when(drawn, F.col("t")).alias("whole"),
    )
    ends = checkpointed(ends.withColumn("s", F.coalesce("s", F.lit("\0"))))
    limits = _limits(ends.where("c is not null"))
    few = limits.limit(HELD_SOURCES + 1).collect()
    if len(few) <= HELD_SOURCES:  # else the limits are joined by an exchange
        limits = F.broadcast(spark.createDataFrame(few, limits.schema))
    limited = ends.join(limits, "s", "left")
    examples = limited.where("lot is not null").dropDuplicates(["lot"]).select("lot", "whole", "chars", "bytes", "block").toPandas()
    chosen = examples.sort_values("lot", kind="stable")[:sample]
    listed = lambda x: None if x is None else [int(n) for n in x]
    size = lambda x: None if x is None or x != x else int(x)
    weights, _ = fit([(t, (listed(c), listed(b), size(m))) for t, c, b, m in zip(chosen["whole"], chosen["chars"], chosen["bytes"], chosen["block"])])
    held = spark.sparkContext.broadcast(weights.astype(np.float32))
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tails, chars, sizes, good, *own = (batch.column(i).to_pylist() for i in range(2, 9))
            p = score(held.value, [closing(t or "") + at_limits(c or 0, b or 0, (t or "")[-1:], x) for t, c, b, x in zip(tails, chars, sizes, zip(*own))])
            p = np.where(good, p, 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.string()), pa.array(p, pa.float64())], names=["k", "s", "p"])

    made = limited.select("k", F.nullif("s", F.lit("\0")).alias("s"), "tail", "c", "b", "ok", "chars", "bytes", "block").mapInArrow(run, f"k {kind}, s string, p double")
    return made.select(F.col("k").alias(key), F.col("s").alias(source), F.col("p").alias("p_cut"), (F.col("p") >= BAR).alias("is_cut"))


def rates(judged: DataFrame, source: str) -> DataFrame:
    """(source, texts, cut, rate) from :func:`scored`."""
    return judged.groupBy(source).agg(F.count("*").alias("texts"), F.sum(F.col("is_cut").cast("bigint")).alias("cut"), F.avg(F.col("is_cut").cast("double")).alias("rate"))
