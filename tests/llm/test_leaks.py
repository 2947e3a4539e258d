import random
import string
import tracemalloc

import numpy as np

from subloom.llm import leaks as L

D, I = "doc_id bigint, text string, item_id string", "item_id bigint, text string, doc_id string"


def letters(rng, n):
    return "".join(rng.choice(string.ascii_lowercase) for _ in range(n))


def edited(rng, s, edits):
    s = list(s)
    for at in sorted(rng.sample(range(2, len(s) - 2), edits), reverse=True):
        kind = rng.randrange(3)
        if kind == 0:
            s[at] = "Z" if s[at] != "z" else "y"
        elif kind == 1:
            s.insert(at, "q")
        else:
            del s[at]
    return "".join(s)


def run(spark, docs, items, **kw):
    df = L.leaks(spark.createDataFrame(docs, D), "doc_id", "text", spark.createDataFrame(items, I), "item_id", "text", **kw)
    return {(r["doc_id"], r["item_id"]): r for r in df.collect()}


def test_planted_passages(spark):
    rng = random.Random(10)
    items = [(i, letters(rng, 400), "") for i in range(12)]
    docs, want = [], set()
    for k in range(300):
        i, size = rng.randrange(12), rng.choice([60, 90, 98, 116, 130, 220, 400])
        at = rng.randrange(0, 400 - size + 1)
        part = items[i][1][at : at + size]
        edits = rng.choice([0, 0, size // 25, size // 20, size // 8])
        shown = edited(rng, part, edits) if edits else part
        styled = " ".join(shown[j : j + 7] for j in range(0, len(shown), 7)).upper() if k % 2 else shown
        docs.append((k, letters(rng, 80) + " ... " + styled + "!" + letters(rng, 50), ""))
        if size >= 116 and edits <= size // 25:
            want.add((k, i))
        if size <= 98:  # a few more signs can be had for five edits
            docs[-1] = (*docs[-1][:2], "short")
    got = run(spark, docs, items, min_cover=2.0)
    assert want <= set(got)
    assert not [k for k in got if docs[k[0]][2] == "short"]
    assert all(r["passage"] >= 110 and r["edits"] * 20 <= r["passage"] for r in got.values())


def test_reordered_parts_count_as_coverage(spark):
    rng = random.Random(11)
    text = letters(rng, 300)
    parts = [text[i : i + 50] for i in range(0, 300, 50)]
    parts.reverse()
    got = run(spark, [(1, " x ".join(parts), ""), (2, letters(rng, 300), "")], [(5, text, "")])
    assert set(got) == {(1, 5)} and got[1, 5]["covered"] >= 280 and got[1, 5]["passage"] == 0


def test_width_marks_nulls_repeats_and_blocks(spark, monkeypatch):
    rng = random.Random(12)
    kana = "".join(rng.choice("アイウエオカキクケコガギグゲゴ") for _ in range(150))
    wide = "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in "abc123")
    import unicodedata

    docs = [(1, unicodedata.normalize("NFD", kana) + wide, ""), (1, kana, ""), (2, None, ""), (3, "", ""), (None, kana, ""), (4, "終" * 60_000, "")]
    items = [(7, kana, ""), (7, kana, ""), (8, None, ""), (9, "short", ""), (10, letters(rng, 200), "")]
    hits = L.leaks(spark.createDataFrame(docs, D), "doc_id", "text", spark.createDataFrame(items, I), "item_id", "text")
    assert sorted(((r["doc_id"], r["item_id"]) for r in hits.collect()), key=repr) == [(1, 7)] * 4 + [(None, 7)] * 2
    monkeypatch.setattr(L, "HELD_SIGNS", 0)
    assert L.leaks(spark.createDataFrame(docs, D), "doc_id", "text", spark.createDataFrame(items, I), "item_id", "text").count() == 6
    assert run(spark, [], items) == {} and run(spark, docs, []) == {}


def test_tiles_are_greedy_and_disjoint():
    # item 0..99; the document holds 40..99, then 0..59: the longer run is marked first, the other is cut
    d = np.concatenate([np.arange(0, 60 - 15), np.arange(60, 120 - 15)])
    i = np.concatenate([np.arange(40, 100 - 15), np.arange(0, 60 - 15)])
    a, b, n = L.in_a_row(d, i)
    out = L.tiles(a, b, n + 15)
    assert sorted(n for _, _, n in out) == [40, 60]
    used = [x for _, b, n in out for x in range(b, b + n)]
    assert len(used) == len(set(used)) == 100


def test_planted_reordered_items_are_all_covered(spark, monkeypatch):
    rng = random.Random(13)
    items = [(i, letters(rng, rng.randrange(120, 400)), "") for i in range(20)]
    docs, want = [], set()
    for k in range(200):
        i = rng.randrange(20)
        text = items[i][1]
        cuts = sorted(rng.sample(range(20, len(text) - 20), 3))
        parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        rng.shuffle(parts)
        kept = parts if k % 2 else parts[:1]
        docs.append((k, letters(rng, 300) + "".join(f" {p} {letters(rng, 5)}" for p in kept), ""))
        if sum(len(p) for p in kept if len(p) >= 16) * 2 >= len(text):
            want.add((k, i))
    got = run(spark, docs, items)
    assert len(want) > 90 and want <= set(got)
    assert all(r["covered"] <= r["item_signs"] for r in got.values())
    monkeypatch.setattr(L, "HELD_SIGNS", 0)
    assert run(spark, docs, items) == got


def test_an_item_at_both_ends_has_no_more_signs_than_it_has(spark):
    rng = random.Random(14)
    short, other = letters(rng, 109), letters(rng, 130)
    for items in ([(1, other, ""), (2, short, "")], [(2, short, ""), (1, other, "")], [(2, short, "")]):
        got = run(spark, [(1, "before " + short, ""), (2, short, "")], items, min_cover=2.0)
        assert got == {}
    got = run(spark, [(1, "before " + short, "")], [(2, short, "")])
    assert got[1, 2]["covered"] == 109 and got[1, 2]["passage"] == 0


def test_matches_are_the_same_in_small_parts(monkeypatch):
    rng = random.Random(15)
    for _ in range(60):
        c = np.array([rng.randrange(2) + 97 for _ in range(rng.randrange(20, 300))], np.uint32)
        own = np.array([rng.randrange(2) + 97 for _ in range(rng.randrange(20, 200))], np.uint32)
        if rng.random() < 0.5:
            c[:], own[:] = 97, 97
        monkeypatch.setattr(L, "PAIRS", 1_000_000)
        items = L.Items([1], ["".join(map(chr, own))], 16)
        whole = sorted(zip(*(x.tolist() for x in L.matches(c, items))))
        monkeypatch.setattr(L, "PAIRS", 7)
        assert sorted(zip(*(x.tolist() for x in L.matches(c, items)))) == whole
        for a, b, n in whole:
            assert (c[a : a + n] == own[b : b + n]).all()
            assert a == 0 or b == 0 or c[a - 1] != own[b - 1]


def test_repeated_signs_take_little_memory():
    tracemalloc.start()
    got = L.judged(L.Items([7], ["終" * 8000], 16), ["終" * 8000], L.least_seeds(110, 20), 110, 20, 0.5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == [(0, 7, 8000, 8000, 8000, 0)] and peak < 200e6


def test_shortest_passages_keep_seeds():
    assert L.least_seeds(110, 20) == 9
