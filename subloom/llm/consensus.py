"""Consensus of annotators who disagree, with a reliability of each of them.

A competence-and-spamming mixture: an annotator's label is truthful with the annotator's competence, else a guess. A guess
comes from the annotator's own guess distribution or, with a probability of the annotator's own, repeats the
distractor of the item, a wrong label that its guessers share (with none of these the model is the plain mixture). Expectation-
maximisation over the patterns of votes yields competences, guess distributions and the labels' probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subloom.session import checkpointed, require_columns

ROUNDS, SETTLED = 30, 1e-4
#: Pseudo-counts: of a guess of each label, of votes, of guesses.
GUESS, VOTES, GUESSES = 0.1, 2.0, 1.0
#: Up to so many (annotator, label) pairs the parameters are held by every worker; beyond, they are joined to the votes.
HELD_PAIRS = 2_000_000


def expect(size: np.ndarray, label: np.ndarray, t: np.ndarray, k: np.ndarray, x: np.ndarray, labels: int) -> tuple[np.ndarray, ...]:
    """(probability of each vote's label, of the vote being truthful, repeating the distractor, an own guess).

    ``size``: votes of each item; the other arrays hold the votes item by item: label, competence, share of
    repeated guesses and guess probability of the annotator for that label. A true label or distractor that nobody
    voted for is one more possibility with the weight of all labels without a vote.
    """
    first = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
    out = np.zeros((4, len(label)))
    for n in np.unique(size):
        if n == 0:
            continue
        items = np.flatnonzero(size == n)
        step = max(1, 2_000_000 // int((n + 1) ** 2))
        for at in range(0, len(items), step):
            rows = first[items[at : at + step]][:, None] + np.arange(n)
            lab = label[rows]
            slot = (lab[:, :, None] == lab[:, None, :]).argmax(2)
            taken = slot == np.arange(n)
            weight = np.where(taken, 0.0, -np.inf)
            weight = np.concatenate([weight, np.log(np.maximum(labels - taken.sum(1), 1))[:, None]], 1)
            lp = weight[:, :, None] + weight[:, None, :]
            each = np.arange(len(rows))
            truth = t[rows]
            echo = (1 - truth) * k[rows]
            own = (1 - truth) * (1 - k[rows]) * x[rows]
            for v in range(n):
                s = slot[:, v]
                p = np.broadcast_to(own[:, v][:, None, None], lp.shape).copy()
                p[each, s, :] += truth[:, v][:, None]
                p[each, :, s] += echo[:, v][:, None]
                lp += np.log(p)
            post = np.exp(lp - lp.max((1, 2), keepdims=True))
            post /= post.sum((1, 2), keepdims=True)
            by_truth = post.sum(2)
            for v in range(n):
                s = slot[:, v]
                both = post[each, s, s]
                row, column = by_truth[each, s], post[each, :, s].sum(1)
                a, b, c = truth[:, v], echo[:, v], own[:, v]
                r_t = (row - both) * a / (a + c) + both * a / (a + b + c)
                r_d = (column - both) * b / (b + c) + both * b / (a + b + c)
                out[:, rows[:, v]] = row, r_t, r_d, 1 - r_t - r_d
    return tuple(out)


def _lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, pa.StructArray]:
    column = batch.column(batch.schema.get_field_index(name))
    return np.diff(column.offsets.to_numpy()), column.flatten()


def _numbers(flat: pa.StructArray, name: str) -> np.ndarray:
    return flat.field(name).to_numpy(zero_copy_only=False)


class _Held:
    """The parameters on a worker."""

    def __init__(self, params: dict):
        self.p = params

    def of(self, flat: pa.StructArray) -> tuple[np.ndarray, ...]:
        m = np.searchsorted(self.p["models"], _numbers(flat, "m"))
        pair = np.searchsorted(self.p["pairs"], _numbers(flat, "p"))
        return self.p["competence"][m], self.p["echo"][m], self.p["guess"][pair]


def _start(models: np.ndarray, pairs: np.ndarray, labels: int) -> dict:
    return {
        "models": models,
        "pairs": pairs,
        "competence": np.full(len(models), 0.7),
        "echo": np.full(len(models), 0.3),
        "guess": np.full(len(pairs), 1 / max(labels, 1)),
        "labels": labels,
    }


def _fit_held(patterns: DataFrame, params: dict, owner: np.ndarray) -> dict:
    """EM in which only sums by annotator and by (annotator, label) leave the workers."""
    sc = patterns.sparkSession.sparkContext
    labels = params["labels"]
    for _ in range(ROUNDS):
        held = sc.broadcast(params)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            keep = _Held(held.value)
            p = held.value
            sums = np.zeros((4, len(p["models"])))
            own = np.zeros(len(p["pairs"]))
            for batch in batches:
                size, flat = _lists(batch, "votes")
                w = np.repeat(batch.column(batch.schema.get_field_index("n")).to_numpy(), size)
                _, r_t, r_d, r_s = expect(size, _numbers(flat, "l"), *keep.of(flat), labels)
                m = np.searchsorted(p["models"], _numbers(flat, "m"))
                for i, r in enumerate((np.ones_like(r_t), r_t, r_d, r_s)):
                    sums[i] += np.bincount(m, r * w, len(p["models"]))
                own += np.bincount(np.searchsorted(p["pairs"], _numbers(flat, "p")), r_s * w, len(own))
            slots = np.concatenate([np.arange(sums.size), sums.size + np.flatnonzero(own)])
            yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(np.concatenate([sums.ravel(), own[own != 0]]))], names=["slot", "v"])

        made = patterns.mapInArrow(run, "slot bigint, v double").groupBy("slot").agg(F.sum("v").alias("v")).toArrow()
        total = np.zeros(4 * len(params["models"]) + len(params["pairs"]))
        total[made.column("slot").to_numpy()] = made.column("v").to_numpy()
        held.unpersist()
        n, r_t, r_d, r_s = total[: 4 * len(params["models"])].reshape(4, -1)
        own = total[4 * len(params["models"]) :]
        new = dict(params)
        new["competence"] = (r_t + VOTES / 2) / (n + VOTES)
        new["echo"] = (r_d + 0.3 * GUESSES) / (r_d + r_s + GUESSES)
        new["guess"] = (own + GUESS) / (r_s[owner] + GUESS * labels)
        moved = np.abs(new["competence"] - params["competence"]).max() if len(n) else 0
        params = new
        if moved < SETTLED:
            break
    return params


def _judged(rows: DataFrame, held, labels: int) -> DataFrame:
    """Add ``_r``: per vote the label's probability and the responsibilities, from held parameters or those in the votes."""
    schema = rows.schema
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = _Held(held.value) if held is not None else None
        for batch in batches:
            size, flat = _lists(batch, "votes")
            given = keep.of(flat) if keep else tuple(_numbers(flat, c) for c in ("t", "k", "x"))
            made = expect(size, _numbers(flat, "l"), *given, labels)
            offsets = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
            structs = pa.StructArray.from_arrays([pa.array(v) for v in made], names=["post", "t", "d", "s"])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, structs)], names=[*names, "_r"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return rows.mapInArrow(run, ddl + ", _r array<struct<post:double,t:double,d:double,s:double>>")


def _joined(rows: DataFrame, models: DataFrame, pairs: DataFrame, keys: list[str]) -> DataFrame:
    """The rows with the parameters of each vote in it, brought by joins."""
    votes = rows.select(*keys, F.posexplode("votes").alias("i", "v")).select(*keys, "i", "v.m", "v.l", "v.p")
    full = votes.join(pairs.select("p", "x"), "p").join(models.select("m", "t", "k"), "m")
    gathered = full.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("i", "m", "l", "p", "t", "k", "x"))).alias("votes"))
    return gathered  # an item's votes are one row of the input, so no group is larger than that


def _fit_joined(patterns: DataFrame, models: DataFrame, pairs: DataFrame, labels: int) -> tuple[DataFrame, DataFrame]:
    models = models.select("m", F.lit(0.7).alias("t"), F.lit(0.3).alias("k"))
    pairs = pairs.select("p", "m", F.lit(1 / max(labels, 1)).alias("x"))
    for _ in range(ROUNDS):
        judged = _judged(_joined(patterns, models, pairs, ["id", "n"]), None, labels)
        votes = judged.select("n", F.explode(F.arrays_zip("votes", "_r")).alias("z")).select("n", "z.votes.m", "z.votes.p", "z._r.t", "z._r.d", "z._r.s")
        by_pair = checkpointed(votes.groupBy("p", "m").agg(*[F.sum(F.col("n") * F.col(c)).alias(c) for c in "tds"], F.sum("n").alias("n")))
        by_model = by_pair.groupBy("m").agg(*[F.sum(c).alias(c) for c in "tdsn"])
        new = checkpointed(
            by_model.select("m", "s", ((F.col("t") + VOTES / 2) / (F.col("n") + VOTES)).alias("t"), ((F.col("d") + 0.3 * GUESSES) / (F.col("d") + F.col("s") + GUESSES)).alias("k"))
        )
        pairs = by_pair.select("p", "m", F.col("s").alias("o")).join(new.select("m", "s"), "m").select("p", "m", ((F.col("o") + GUESS) / (F.col("s") + GUESS * labels)).alias("x"))
        moved = new.join(models.select("m", F.col("t").alias("old")), "m").agg(F.max(F.abs(F.col("t") - F.col("old")))).first()[0] or 0
        models = new.select("m", "t", "k")
        if moved < SETTLED:
            break
    return models, pairs


def consensus(df: DataFrame, key: str, votes: Column, held_pairs: int = HELD_PAIRS) -> tuple[DataFrame, DataFrame]:
    """(items, annotators) from ``votes``, an ARRAY<STRUCT<model, label>> with at most one vote of a model per item.

    items: (key, n_votes, consensus, agreement, probability), one row per input row: the label that the votes support best, the share
    of votes for it and its probability; null without votes. Of equally probable labels the smallest counts. annotators: (model, votes,
    reliability, shared_guesses). Only items of two votes or more teach the model, identical patterns of votes once
    with their number. Null votes and null labels don't count; repeated items each count; other columns are ignored.
    """
    require_columns(df, key)
    sound = F.filter(F.coalesce(votes, F.array()), lambda v: v["model"].isNotNull() & v["label"].isNotNull())
    ordered = F.array_sort(F.transform(sound, lambda v: F.struct(v["label"].alias("label"), v["model"].alias("model"))))
    hashed = F.transform("_o", lambda v: F.struct(F.xxhash64(v["model"]).alias("m"), F.xxhash64(v["label"]).alias("l"), F.xxhash64(v["model"], v["label"]).alias("p")))
    rows = checkpointed(df.select(F.col(key).alias("_key"), ordered.alias("_o")).withColumn("votes", hashed))  # the votes are taken out of their column once
    taught = rows.where(F.size("votes") >= 2)
    patterns = checkpointed(taught.groupBy(F.col("votes")).agg(F.count("*").alias("n")).withColumn("id", F.monotonically_increasing_id()))
    each = taught.select(F.explode(F.arrays_zip("_o", "votes")).alias("z")).select("z._o.model", "z.votes.m", "z.votes.p", "z.votes.l")
    pairs = checkpointed(each.groupBy("p", "m", "l").agg(F.min("model").alias("model"), F.count("*").alias("n")))
    labels = pairs.select("l").distinct().count()
    known = pairs.groupBy("m").agg(F.min("model").alias("model"), F.sum("n").alias("votes"))
    if pairs.count() <= held_pairs:
        table = pairs.select("p", "m").toPandas().sort_values("p")
        models = np.sort(table["m"].unique())
        params = _start(models, table["p"].to_numpy(), labels)
        params = _fit_held(patterns, params, np.searchsorted(models, table["m"].to_numpy()))
        spark = df.sparkSession
        made = [(int(m), float(t), float(k)) for m, t, k in zip(params["models"], params["competence"], params["echo"])]
        fitted = spark.createDataFrame(made, "m bigint, t double, k double")
        # a lone vote may be one that taught nothing: a label or annotator of its own gets what no vote would change
        alone = rows.where(F.size("votes") < 2)
        judged = _judged(taught.select("_key", "_o", "votes"), spark.sparkContext.broadcast(params), labels)
    else:
        fitted, guesses = _fit_joined(patterns, known.select("m"), pairs.select("p", "m"), labels)
        alone = rows.where(F.size("votes") < 2)
        numbered = checkpointed(taught.withColumn("_id", F.struct(F.xxhash64("_key"), F.monotonically_increasing_id())))
        judged = _judged(_joined(numbered, fitted, guesses, ["_id", "_key", "_o"]).drop("_id"), None, labels)
    posts = F.transform("_r", lambda r: r["post"])
    best = F.array_position(posts, F.array_max(posts)).cast("int")
    label = F.col("_o")[best - 1]["label"]
    same = F.size(F.filter("_o", lambda v: v["label"] == F.col("consensus")))
    items = judged.select("_key", "_o", label.alias("consensus"), F.array_max(posts).alias("probability")).unionByName(
        alone.select("_key", "_o", F.when(F.size("_o") > 0, F.col("_o")[0]["label"]).alias("consensus"), F.lit(None).cast("double").alias("probability"))
    )
    items = items.select(
        F.col("_key").alias(key), F.size("_o").alias("n_votes"), "consensus", F.when(F.size("_o") > 0, same / F.size("_o")).alias("agreement"), "probability"
    )
    annotators = known.join(fitted, "m", "left").select("model", "votes", F.col("t").alias("reliability"), F.col("k").alias("shared_guesses"))
    return items, annotators
