import random

import pytest

from subloom.operators import ordered, spans
from subloom.operators.islands import periods_and_gaps
from subloom.operators.ordered import BITS, STEP, carried, numbered, previous, with_neighbours

S = "episode string, start bigint, end bigint, kind string"


def brute(rows, max_gap=None):
    out = []
    for ep in {r[0] for r in rows if r[0] is not None}:
        spans_ = sorted((s, e) for x, s, e, *_ in rows if x == ep and s is not None and e is not None and e > s)
        merged = []
        for s, e in spans_:
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        out += [(ep, "period", s, e) for s, e in merged]
        out += [(ep, "gap", a[1], b[0]) for a, b in zip(merged, merged[1:]) if max_gap is None or b[0] - a[1] < max_gap]
    return sorted(out, key=repr)


@pytest.mark.parametrize("few", [100_000, 0])
def test_periods_against_brute_force_over_block_bounds(spark, rows, monkeypatch, few):
    monkeypatch.setattr(ordered, "FEW_BLOCKS", few)
    rng = random.Random(1)
    width = 1 << BITS
    data = []
    for _ in range(400):
        ep = rng.choice(["a", "a", "a", "b", None])
        s = rng.choice([rng.randrange(0, 40), rng.randrange(-5 * width, 5 * width), (1 << (BITS + STEP)) * rng.randrange(0, 3) + rng.randrange(50)])
        data.append((ep, s, rng.choice([None, s, s - 3, s + rng.randrange(1, 30), s + rng.randrange(1, 3 * width)]), "x"))
    data += data[:50]
    got = rows(periods_and_gaps(spark.createDataFrame(data, S)), "episode", "kind", "start_ms", "end_ms")
    assert got == brute(data)
    got = rows(periods_and_gaps(spark.createDataFrame(data, S), max_gap=1000), "episode", "kind", "start_ms", "end_ms")
    assert got == brute(data, 1000)


def test_periods_empty_touching_and_nested(spark, rows):
    assert rows(periods_and_gaps(spark.createDataFrame([], S))) == []
    df = spark.createDataFrame([("a", 0, 10, ""), ("a", 10, 20, ""), ("a", 2, 3, ""), ("a", 25, 30, "")], S)
    assert rows(periods_and_gaps(df)) == [("a", "gap", 20, 25), ("a", "period", 0, 20), ("a", "period", 25, 30)]


@pytest.mark.parametrize("few", [100_000, 0])
def test_running_values_and_neighbours(spark, rows, monkeypatch, few):
    monkeypatch.setattr(ordered, "FEW_BLOCKS", few)
    pos = [0, 5, 6, 1 << 20, (1 << 20) + 1, 1 << 33, (1 << 45) + 7]
    df = spark.createDataFrame([("k", p, i) for i, p in enumerate(pos)], "k string, p bigint, v bigint")
    total = {r["p"]: r["s"] for r in carried(df, ["k"], "p", df["v"], "s", "sum").collect()}
    assert [total[p] for p in pos] == [None, 0, 1, 3, 6, 10, 15]
    before = {r["p"]: r["prev"] and r["prev"]["p"] for r in previous(df, ["k"], "p", ["v"]).collect()}
    assert [before[p] for p in pos] == [None, *pos[:-1]]
    assert sorted(r["n"] for r in numbered(df, ["k"], "p").collect()) == list(range(1, 8))
    around = {r["p"]: r["around"] for r in with_neighbours(df, ["k"], "p", df["v"], 1, 1).collect()}
    assert [around[p] for p in pos] == [[0, 1], [0, 1, 2], [1, 2, 3], [2, 3, 4], [3, 4, 5], [4, 5, 6], [5, 6]]


def test_null_keys_are_a_key_and_rows_without_a_position_are_left_out(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 1 << 21, 6), ("k", 3, 7), ("k", None, 8)], "k string, p bigint, v bigint")
    got = {(r["k"], r["p"]): r["s"] for r in carried(df, ["k"], "p", df["v"], "s").collect()}
    assert got == {(None, 1): None, (None, 1 << 21): 5, ("k", 3): None}


def test_bridged_stretches_against_brute_force(spark, rows):
    rng = random.Random(3)
    width = 1 << BITS
    data = [(rng.choice("ab"), s := rng.randrange(0, 4 * width), s + rng.randrange(1, width // 2)) for _ in range(60)]
    for bridge in (0, width // 20):
        want = []
        for k in "ab":
            merged = []
            for s, e in sorted(x[1:] for x in data if x[0] == k):
                if merged and s <= merged[-1][1] + bridge:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            want += [(k, s, e) for s, e in merged]
        assert rows(spans.merged(spark.createDataFrame(data, "k string, s bigint, e bigint"), ["k"], bridge)) == sorted(want, key=repr)


def test_neighbours_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(ordered, "BLOCK", 3)
    df = spark.createDataFrame([("k", p) for p in range(20)], "k string, p bigint")
    got = {r["p"]: r["around"] for r in with_neighbours(df, ["k"], "p", df["p"], 2, 2).collect()}
    assert got == {p: [x for x in range(p - 2, p + 3) if 0 <= x < 20] for p in range(20)}


def test_overlap_join_and_subtraction_against_brute_force(spark, rows):
    rng = random.Random(2)
    make = lambda n: [("e%d" % rng.randrange(2), i, s := rng.randrange(0, 60_000), s + rng.randrange(1, 25_000)) for i in range(n)]
    a, b = make(40), make(40)
    left = spark.createDataFrame(a, "episode string, id int, s bigint, e bigint")
    right = spark.createDataFrame(b, "episode string, rid int, rs bigint, re bigint")
    got = rows(spans.overlaps(left, right, ["episode"]), "id", "rid")
    assert got == sorted(((x[1], y[1]) for x in a for y in b if x[0] == y[0] and x[2] < y[3] and y[2] < x[3]), key=repr)
    free = spans.subtracted(left, right.withColumnsRenamed({"rs": "s", "re": "e"}), ["episode"], "id")
    seen = {}
    for r in free.collect():
        seen.setdefault(r["id"], set()).update(range(r["s"], r["e"]))
    for ep, i, s, e in a:
        want = set(range(s, e)) - {t for y in b if y[0] == ep for t in range(max(s, y[2]), min(e, y[3]))}
        assert seen.get(i, set()) == want
    deep = spans.depth(left, ["episode"]).collect()
    assert sum((r["e"] - r["s"]) * r["depth"] for r in deep) == sum(x[3] - x[2] for x in a)


def test_previous_and_next(spark, rows):
    points = spark.createDataFrame([("x", 10), ("x", 35), ("y", 1)], "k string, p bigint")
    marks = spark.createDataFrame([("x", 1, 0, 10), ("x", 2, 35, 40), ("x", 3, 12, 20)], "k string, id bigint, s bigint, e bigint")
    got = rows(spans.previous_and_next(points, marks, ["k"]), "k", "p", "prev_end", "prev_id", "next_start", "next_id")
    assert got == [("x", 10, 10, 1, 12, 3), ("x", 35, 20, 3, 35, 2), ("y", 1, None, None, None, None)]
