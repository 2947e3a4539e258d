import os
import random

import numpy as np
import pytest

from subloom.llm import mixing as M

pytestmark = pytest.mark.skipif(not os.path.exists(M.VOCABULARY), reason="no vocabulary")
D, T = "doc_id bigint, text string, source string, copy string", "source string, target_share double, max_repeats int, tokens string"


def docs(rng):
    out = []
    for s, n in (("big", 600), ("mid", 250), ("small", 40)):
        out += [(len(out) + i, " ".join(rng.choice(["letter", "ship", "手紙", "港"]) + str(rng.randrange(999)) for _ in range(rng.randrange(5, 40))), s, "x") for i in range(n)]
    return out


def test_shares_repeats_and_shards(spark):
    rows = docs(random.Random(15))
    targets = spark.createDataFrame([("big", 0.5, 2, ""), ("mid", 0.3, 2, ""), ("small", 0.15, 5, ""), ("absent", 0.05, 3, ""), (None, 0.1, 1, "")], T)
    df = spark.createDataFrame(rows + [(9999, rows[0][1], "big", ""), (5000, None, "big", ""), (5001, "", "mid", ""), (5002, "other", None, ""), (5003, "free", "untargeted", "")], D)
    m = M.mix(df, "doc_id", "text", "source", targets, shards=5, seed=3)
    shares = {r["source"]: r for r in m.shares.collect()}
    assert abs(shares["big"]["actual_share"] - 0.5 / 0.95) < 0.01 and abs(shares["small"]["actual_share"] - 0.15 / 0.95) < 0.01
    assert shares["absent"]["tokens"] == 0 and set(shares) == {"big", "mid", "small", "absent"}
    used = m.documents.collect()
    assert all(r["repeats"] <= shares[r["source"]]["max_repeats"] for r in used)
    assert {r["doc_id"] for r in used} <= {r[0] for r in rows} and len({r["doc_id"] for r in used}) == len(used)
    copies = m.copies.collect()
    assert len(copies) == sum(r["repeats"] for r in used) == len({(r["doc_id"], r["copy"]) for r in copies})
    assert {r["shard"] for r in copies} == set(range(5))
    per = {k: sum(r["n_tokens"] for r in copies if r["shard"] == k) for k in range(5)}
    assert max(per.values()) < 2 * min(per.values())
    again = M.mix(df.repartition(7), "doc_id", "text", "source", targets, shards=5, seed=3)
    assert sorted(map(tuple, again.copies.select("shard", "place", "doc_id").collect())) == sorted((r["shard"], r["place"], r["doc_id"]) for r in copies)


@pytest.mark.parametrize("held", [M.HELD_BLOCKS, 0])
@pytest.mark.parametrize("times", [1, 4])
def test_documents_shares_and_shards_come_from_one_draw(spark, monkeypatch, held, times):
    monkeypatch.setattr(M, "HELD_BLOCKS", held)
    monkeypatch.setattr(M, "SHARD_TOKENS", 2000)
    rng = random.Random(17)
    rows = [r for _ in range(times) for r in docs(rng)]
    df = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], D)
    targets = spark.createDataFrame([("big", 0.4, 2, ""), ("mid", 0.4, 3, ""), ("small", 0.2, 7, "")], T)
    m = M.mix(df, "doc_id", "text", "source", targets)
    shares = {r["source"]: r for r in m.shares.collect()}
    uses, used = m.copies.collect(), {r["doc_id"]: r for r in m.documents.collect()}
    total = sum(r["n_tokens"] for r in uses)
    assert m.shards == max(16, -(-total // 2000)) or abs(m.shards - total / 2000) < 2
    longest = max(r["n_tokens"] for r in uses)
    most = min(shares[s]["available_tokens"] * k / w for s, w, k in (("big", 0.4, 2), ("mid", 0.4, 3), ("small", 0.2, 7)))
    for s, w in (("big", 0.4), ("mid", 0.4), ("small", 0.2)):
        own = [r for r in uses if r["source"] == s]
        assert sum(r["n_tokens"] for r in own) == shares[s]["tokens"] == sum(r["n_tokens"] * r["repeats"] for r in used.values() if r["source"] == s)
        assert abs(shares[s]["tokens"] - most * w) <= longest / 2 + 1
    assert all(sum(1 for r in uses if r["doc_id"] == k) == r["repeats"] for k, r in list(used.items())[:40])


def test_total_and_errors(spark):
    df = spark.createDataFrame(docs(random.Random(16)), D)
    targets = spark.createDataFrame([("big", 0.5, 1, ""), ("small", 0.5, 9, "")], T)
    m = M.mix(df, "doc_id", "text", "source", targets, total_tokens=4000)
    got = {r["source"]: r["tokens"] for r in m.shares.collect()}
    assert all(abs(v - 2000) < 150 for v in got.values())
    with pytest.raises(ValueError):
        M.mix(df, "doc_id", "text", "source", targets, total_tokens=10**9)
    with pytest.raises(ValueError):
        M.mix(df, "doc_id", "text", "source", targets.limit(0))
    empty = M.mix(df.limit(0), "doc_id", "text", "source", targets)
    assert empty.documents.count() == empty.copies.count() == 0 and empty.shares.count() == 2


def test_splitting_tree_is_exact_and_fair():
    rng = np.random.default_rng(1)
    sums = np.zeros((7, 2))
    for _ in range(300):
        dealt = M.split_blocks({"a": 70, "b": 35}, 7, rng)
        counts = np.array([[d["a"], d["b"]] for d in dealt])
        assert counts.sum(0).tolist() == [70, 35] and set(counts.sum(1)) == {15}
        sums += counts
    assert np.allclose(sums / 300, [10, 5], atol=0.5)


def test_token_sizes_match_the_tokenizer(spark):
    with open(M.VOCABULARY, "rb") as f:
        encode = M._encoding(f.read()).encode_ordinary
    texts = ["Hello there, 港の手紙", "", None, "x" * 20_000, "Hello there, 港の手紙"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["n_tokens"] for r in M.token_sizes(df, "t", ["i"]).collect()}
    assert got == {i: len(encode(t)) for i, t in enumerate(texts) if t is not None}
