"""Documents mixed by source to target shares of all tokens, dealt out to shards.

Each source is cut at random into blocks. From exact token quotas follows how many of a source's blocks are used: all of them a whole number of
times, then some once more, drawn at random, the last one only up to the document where the quota ends. The used blocks of all sources are dealt
out to the shards by a splitting tree: at each node they are halved together, and how many of each source go left is drawn
from the multivariate hypergeometric distribution, so the numbers of every level are exact. Each shard then takes disjoint runs of
the permuted blocks and shuffles their documents by itself. Chosen documents, shares and shards all come from the blocks so dealt. The driver holds
numbers of blocks, which grow with the shards, never documents.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subloom.session import checkpointed, require_columns

#: The vocabulary that token counts come from, unless another file is named.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the pattern of pieces that goes with the vocabulary.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Places in a source's random order.
PLACES = 2**63
#: Tokens of a shard, unless their number is given; fewest blocks of a source of many documents, and blocks for each shard.
SHARD_TOKENS, LEAST_SHARDS, LEAST_BLOCKS, BLOCKS_PER_SHARD = 2**28, 16, 1024, 4
#: Up to so many dealt blocks are sent to every worker; beyond, documents and blocks meet by an exchange.
HELD_BLOCKS = 1_000_000
#: Sizes of texts that a task remembers, so that copies are encoded once.
REMEMBERED = 100_000


@lru_cache(maxsize=2)
def _encoding(lines: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines.splitlines() if line.strip())}
    return tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


def token_sizes(df: DataFrame, text: str, keep: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns ``keep``, a 128-bit fingerprint of the text (h1, h2) and its number of tokens; null texts are left out."""
    rows = df.where(F.col(text).isNotNull()).select(*keep, F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"), F.col(text).alias("_text"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    with open(vocabulary, "rb") as f:
        held = df.sparkSession.sparkContext.broadcast(f.read())  # the file of a vocabulary, read where the query is made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(held.value).encode_ordinary
        known: dict[tuple[int, int], int] = {}
        for batch in batches:
            n = batch.num_columns
            sizes = []
            for a, b, t in zip(*(batch.column(i).to_pylist() for i in (n - 3, n - 2, n - 1))):
                size = known.get((a, b))
                if size is None:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    size = known[a, b] = len(encode(t))
                sizes.append(size)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes, pa.int64())], names=[*batch.schema.names[:-1], "n_tokens"])

    return rows.mapInArrow(run, ddl + ", n_tokens bigint")


def split_blocks(blocks: dict[str, int], shards: int, rng: np.random.Generator) -> list[dict[str, int]]:
    """How many blocks of each source every shard gets: a tree of halvings, each drawn without replacement."""
    names = list(blocks)

    def halve(counts: np.ndarray, n: int) -> list[np.ndarray]:
        if n == 1:
            return [counts]
        left_n = n // 2
        take = int(counts.sum()) * left_n // n
        left = rng.multivariate_hypergeometric(counts, take, method="marginals") if counts.sum() else counts * 0
        return halve(left, left_n) + halve(counts - left, n - left_n)

    return [dict(zip(names, map(int, c))) for c in halve(np.array([blocks[s] for s in names], np.int64), shards)]


def _block(blocks) -> Column:
    """The block of a document's place in its source's random order."""
    return F.least(F.floor(F.col("_u") / F.lit(float(PLACES)) * blocks), blocks - 1).cast("int")


def _cuts(docs: DataFrame, rests: list[tuple[str, int, float]]) -> dict[str, int]:
    """For each source the place up to which documents of the named block are used, so that their tokens come nearest to the rest; -1 for none.

    One block of each source is put in order, which has a small share of a shard's tokens.
    """
    if not rests:
        return {}
    wanted = docs.sparkSession.createDataFrame(rests, "source string, _block int, _rest double")
    last = docs.join(F.broadcast(wanted), ["source", "_block"])  # as many rows as targets
    w = Window.partitionBy("source").orderBy("_u", "_id").rowsBetween(Window.unboundedPreceding, 0)
    taken = last.withColumn("_sum", F.sum("n_tokens").over(w)).where(F.col("_sum") - F.col("n_tokens") / 2 <= F.col("_rest"))
    ends = {r["source"]: r["u"] for r in taken.groupBy("source").agg(F.max("_u").alias("u")).collect()}
    return {s: ends.get(s, -1) for s, _, _ in rests}


class Mix:
    """The chosen documents, their uses by shard and the actual shares; see :func:`mix`."""

    def __init__(self, documents: DataFrame, copies: DataFrame, shares: DataFrame, shards: int):
        self.documents, self.copies, self.shares, self.shards = documents, copies, shares, shards


def mix(docs: DataFrame, doc_id: str, text: str, source: str, targets: DataFrame, total_tokens: int | None = None, shards: int | None = None, seed: int = 1, vocabulary: str = VOCABULARY) -> Mix:
    """Documents by source in the target shares of ``total_tokens`` tokens, none used more than its source's max_repeats times.

    ``targets``: (source, target_share, max_repeats). Without ``total_tokens`` the mix is the largest that the repeats allow; more than that is an error.
    A document that stands in the table several times, under whatever id, is one document: the smallest id stands for
    it. Null or tokenless texts and sources without a target aren't used; a target without documents gets no tokens, and the other shares keep
    their proportions. Each source ends within half a document of its quota. Without ``shards`` their number follows from the tokens, SHARD_TOKENS each.

    documents: (doc_id, source, n_tokens, repeats). copies: (shard, place, doc_id, source, copy, n_tokens), one row per
    use, in random order within a shard by ``place``. shares: (source, target_share, actual_share, tokens, available_tokens, documents, uses, max_repeats).
    """
    require_columns(docs, doc_id, text, source)
    require_columns(targets, "source", "target_share", "max_repeats")
    spark = docs.sparkSession
    wanted = targets.where((F.col("target_share") > 0) & (F.col("max_repeats") > 0) & F.col("source").isNotNull())
    goals = {r["source"]: (float(r["target_share"]), int(r["max_repeats"])) for r in wanted.select("source", "target_share", "max_repeats").collect()}
    if not goals:
        raise ValueError("no source has a target")
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(source).alias("source"), F.col(text).alias("_t")).where(F.col("source").isin(list(goals)) & F.col("_id").isNotNull())
    sized = token_sizes(rows, "_t", ["_id", "source"], vocabulary).where(F.col("n_tokens") > 0)
    one = sized.groupBy("h1", "h2").agg(F.min(F.struct("_id", "source", "n_tokens")).alias("d"))
    known = checkpointed(one.select("d.*", F.shiftrightunsigned(F.xxhash64(F.lit(seed), "d._id", "h1"), 1).alias("_u")))
    have = {r["source"]: (int(r["n"]), int(r["k"])) for r in known.groupBy("source").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("k")).collect()}
    active = {s: g for s, g in goals.items() if s in have}
    whole = sum(share for share, _ in active.values())
    most = min((have[s][0] * r / (share / whole) for s, (share, r) in active.items()), default=0.0)
    total = most if total_tokens is None else float(total_tokens)
    if total > most * (1 + 1e-9):
        raise ValueError(f"{total:.0f} tokens can't be had within the repeats; at most {most:.0f}")
    quota = {s: total * share / whole for s, (share, _) in active.items()}
    full = {s: min(int(quota[s] / have[s][0] + 1e-9), active[s][1]) for s in active}
    rest = {s: quota[s] - full[s] * have[s][0] if full[s] < active[s][1] else 0.0 for s in active}
    shards = shards or max(LEAST_SHARDS, -(-int(total) // SHARD_TOKENS))
    fewest = {s: max(LEAST_BLOCKS, BLOCKS_PER_SHARD * shards, BLOCKS_PER_SHARD * have[s][0] // SHARD_TOKENS) for s in active}
    blocks = {s: int(min(fewest[s], max(1, have[s][1] // 8))) for s in active}
    sizes = spark.createDataFrame([(s, b) for s, b in blocks.items()] or [("", 1)], "source string, _blocks int")
    cut_up = known.join(F.broadcast(sizes), "source").withColumn("_block", _block(F.col("_blocks"))).drop("_blocks")  # as many rows as targets
    sums = cut_up.groupBy("source", "_block").agg(F.sum("n_tokens").alias("n")).toPandas()

    rng = np.random.default_rng(seed)
    once_more, ends_in = {}, []
    for s in active:
        own = sums[sums["source"] == s]
        tokens = np.zeros(blocks[s], np.int64)
        tokens[own["_block"].to_numpy()] = own["n"].to_numpy()
        order = rng.permutation(blocks[s])
        done = np.cumsum(tokens[order])
        k = int(np.searchsorted(done, rest[s], "right")) if rest[s] > 0 else 0
        once_more[s] = order[:k]
        if rest[s] > 0 and k < len(order):
            ends_in.append((s, int(order[k]), float(rest[s] - (done[k - 1] if k else 0))))
    ends = _cuts(cut_up, ends_in)
    parts = {s: (b, ends[s]) for s, b, _ in ends_in if ends[s] >= 0}
    units = {}
    for s in active:
        each = [(np.arange(blocks[s]), c) for c in range(full[s])] + [(once_more[s], full[s])]
        if s in parts:
            each.append((np.array([parts[s][0]]), full[s]))
        block = np.concatenate([b for b, _ in each])
        copy = np.concatenate([np.full(len(b), c) for b, c in each])
        upto = np.full(len(block), PLACES - 1, np.int64)
        if s in parts:
            upto[-1] = parts[s][1]
        at = rng.permutation(len(block))
        units[s] = (block[at], copy[at], upto[at])
    dealt = split_blocks({s: len(u[0]) for s, u in units.items()}, shards, rng)
    frames = [
        pd.DataFrame({"source": s, "_block": u[0].astype(np.int32), "copy": u[1].astype(np.int32), "_upto": u[2], "shard": np.repeat(np.arange(shards, dtype=np.int32), [d[s] for d in dealt])})
        for s, u in units.items()
    ]
    places = pd.concat(frames) if frames else pd.DataFrame({"source": [], "_block": [], "copy": [], "_upto": [], "shard": []})
    table = spark.createDataFrame(places, "source string, _block int, copy int, _upto bigint, shard int")
    uses = table.groupBy("source", "_block").agg(F.array_sort(F.collect_list("_upto")).alias("_upto"))  # a block is used at most max_repeats times
    if len(places) <= HELD_BLOCKS:
        table, uses = F.broadcast(table), F.broadcast(uses)
    repeats = F.size(F.filter("_upto", lambda x: x >= F.col("_u")))
    documents = cut_up.join(uses, ["source", "_block"]).withColumn("repeats", repeats).where("repeats > 0").select(F.col("_id").alias(doc_id), "source", "n_tokens", "repeats")
    copies = cut_up.join(table, ["source", "_block"]).where(F.col("_u") <= F.col("_upto")).select(
        "shard", F.xxhash64(F.lit(seed), "shard", "_id", "copy").alias("place"), F.col("_id").alias(doc_id), "source", "copy", "n_tokens"
    )
    sums = documents.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("documents"), F.sum("repeats").alias("uses"))
    available = spark.createDataFrame([(s, *have.get(s, (0, 0))[:1]) for s in goals], "source string, available_tokens bigint")
    shares = wanted.select("source", "target_share", "max_repeats").join(available, "source", "left").join(sums, "source", "left").na.fill(0)
    everything = shares.agg(F.sum("tokens").alias("_all"))
    shares = shares.join(F.broadcast(everything)).select(  # one row
        "source", "target_share", F.when(F.col("_all") > 0, F.col("tokens") / F.col("_all")).otherwise(0.0).alias("actual_share"), "tokens", "available_tokens", "documents", "uses", "max_repeats"
    )
    return Mix(documents, copies, shares, shards)


def shuffled_shards(mixed: Mix) -> DataFrame:
    """The uses with each shard in one partition and in its own order, ready to be written."""
    return mixed.copies.repartition(mixed.shards, "shard").sortWithinPartitions("shard", "place")
