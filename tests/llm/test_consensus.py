import random

import numpy as np
from pyspark.sql import functions as F

from subloom.llm.consensus import consensus, expect

S = "item int, votes array<struct<model:string,label:string>>, label string"


def simulated(n, rng):
    good, labels = {"a": 0.95, "b": 0.9, "c": 0.85, "x": 0.4, "y": 0.4}, [f"L{i}" for i in range(40)]
    truth, data = [], []
    for i in range(n):
        t = rng.choice(labels)
        trap = rng.choice([x for x in labels if x != t])
        votes = []
        for m, p in good.items():
            if rng.random() < 0.15:
                continue
            votes.append((m, t if rng.random() < p else trap if m in "xy" and rng.random() < 0.8 else rng.choice(labels)))
        truth.append(t)
        data.append((i, votes, "clash"))
    return truth, data


def test_reliability_and_accuracy_on_known_truth(spark):
    truth, data = simulated(1500, random.Random(6))
    items, models = consensus(spark.createDataFrame(data, S), "item", F.col("votes"))
    got = {r["item"]: r for r in items.collect()}
    scored = [(truth[i], v) for i, v, _ in data if len(v) >= 2]
    hits = np.mean([got[i]["consensus"] == truth[i] for i, v, _ in data if len(v) >= 2])
    plain = np.mean([max(sorted({l for _, l in v}), key=[l for _, l in v].count) == t for t, v in scored])
    assert hits > plain and hits > 0.93
    found = {r["model"]: r for r in models.collect()}
    for m, p in {"a": 0.95, "b": 0.9, "c": 0.85, "x": 0.4, "y": 0.4}.items():
        assert abs(found[m]["reliability"] - p) < 0.06
    assert min(found[m]["shared_guesses"] for m in "xy") > max(found[m]["shared_guesses"] for m in "abc")


def test_joined_parameters_give_the_same(spark):
    _, data = simulated(120, random.Random(7))
    df = spark.createDataFrame(data, S)
    a = {r["item"]: r for r in consensus(df, "item", F.col("votes"))[0].collect()}
    b = {r["item"]: r for r in consensus(df, "item", F.col("votes"), held_pairs=0)[0].collect()}
    assert all(a[i]["consensus"] == b[i]["consensus"] and abs((a[i]["probability"] or 0) - (b[i]["probability"] or 0)) < 1e-6 for i in a)


def test_nulls_ties_repeats_and_empty(spark):
    data = [(1, None, ""), (2, [], ""), (3, [("a", "L")], ""), (4, [("a", None), (None, "L")], ""), (5, [("a", "Q"), ("b", "P")], ""), (5, [("a", "Q"), ("b", "P")], ""), (None, [("a", "Q"), ("b", "Q")], "")]
    items, _ = consensus(spark.createDataFrame(data, S), "item", F.col("votes"))
    got = sorted(((r["item"], r["n_votes"], r["consensus"], r["agreement"]) for r in items.collect()), key=repr)
    assert len(got) == 7
    assert (1, 0, None, None) in got and (2, 0, None, None) in got and (4, 0, None, None) in got and (3, 1, "L", 1.0) in got and (None, 2, "Q", 1.0) in got
    assert [g[2] for g in got if g[0] == 5][0] in ("P", "Q") and len({g[2] for g in got if g[0] == 5}) == 1
    items, models = consensus(spark.createDataFrame([], S), "item", F.col("votes"))
    assert items.count() == models.count() == 0


def test_expectation_by_enumeration():
    rng = np.random.default_rng(8)
    label, labels = np.array([1, 1, 2, 5]), 7
    t, k, x = rng.uniform(0.2, 0.9, 4), rng.uniform(0.1, 0.9, 4), rng.uniform(0.05, 0.3, 4)
    p = np.zeros((labels, labels))
    names = [1, 2, 5, 10, 11, 12, 13]
    for a, true in enumerate(names):
        for b, trap in enumerate(names):
            p[a, b] = np.prod([t[v] * (label[v] == true) + (1 - t[v]) * (k[v] * (label[v] == trap) + (1 - k[v]) * x[v]) for v in range(4)])
    p /= p.sum()
    post, r_t, r_d, r_s = expect(np.array([4]), label, t, k, x, labels)
    assert np.allclose(post, [p[names.index(l)].sum() for l in label])
    assert np.allclose(r_t + r_d + r_s, 1)
