import numpy as np

from subloom.operators import voices as V


def unit_rows(v):
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def test_nearest_exemplars(spark, monkeypatch):
    rng = np.random.default_rng(7)
    v, x, roles = rng.normal(size=(20, 4)), rng.normal(size=(30, 4)), [f"r{i % 4}" for i in range(30)]
    df = spark.createDataFrame([(i, a.tolist()) for i, a in enumerate(v)] + [(99, None)], "i int, v array<double>")
    gallery = spark.createDataFrame([(r, a.tolist()) for r, a in zip(roles, x)], "r string, e array<double>")
    sims = unit_rows(v) @ unit_rows(x).T
    best = [sorted(((max(s for s, r in zip(row, roles) if r == own), own) for own in set(roles)), reverse=True) for row in sims]
    for held in (100, 7):
        monkeypatch.setattr(V, "HELD_ROLES", held)
        got = {r["i"]: r for r in V.nearest_exemplars(df, ["i"], "v", gallery, "r", "e").collect()}
        assert set(got) == set(range(20))
        assert all((got[i]["candidate"], got[i]["second"]) == (b[0][1], b[1][1]) and abs(got[i]["margin"] - b[0][0] + b[1][0]) < 1e-8 for i, b in enumerate(best))


def test_cluster_rows(spark):
    rows = [(1, "c", [1.0, 0.1, 0.0], 2.0), (2, "c", [1.0, -0.1, 0.0], 2.0), (3, "c", [0.1, 1.0, 0.0], 1.0), (4, "c", [0.3, 0.0, -1.0], 0.5), (5, "short", [1.0, 0.0, 0.0], 2.9), (6, "one", [0.0, 1.0, 0.0], 3.0), (7, "c", None, 9.0)]
    df = spark.createDataFrame(rows, "i int, c string, v array<double>, w double")
    centres = spark.createDataFrame([("A", [1.0, 0.0, 0.0]), ("B", [0.0, 1.0, 0.0])], "role string, centroid array<double>")
    gates = spark.createDataFrame([("A", 0.7, 0.1), ("B", 0.7, 0.1)], "role string, similarity_threshold double, margin_threshold double")
    got = {r["i"]: r for r in V.cluster_rows(df, ["i"], ["c"], "v", "w", centres, "role", gates).collect()}
    assert set(got) == {1, 2, 3, 4, 6}
    assert {i: r["outlier"] for i, r in got.items()} == {1: False, 2: False, 3: True, 4: True, 6: False}
    assert {r["agreement"] for i, r in got.items() if i < 6} == {0.75} and got[6]["agreement"] == 1.0 and got[6]["cluster_similarity"] is None
    u = {i: np.array(v) / np.linalg.norm(v) * w for i, c, v, w in rows if c == "c" and v}
    rest = u[1] + u[2] + u[4]
    assert got[3]["row_candidate"] == "B" and got[3]["candidate"] == "A" and abs(got[3]["cluster_similarity"] - u[3] @ rest / np.linalg.norm(rest)) < 1e-8


def test_settled_clusters(spark):
    near = lambda x, d: (np.eye(3)[x] + np.array(d)).tolist()
    rows = [("e", 1, near(0, [0, 0.1, 0]), True), ("e", 2, near(0, [0, -0.1, 0]), True), ("e", 3, near(0, [0, 0, 0.1]), True), ("e", 4, near(1, [0, 0, 0]), True), ("e", 5, near(1, [0, 0, 0.2]), False), ("e", 6, None, True)]
    rows += [("two", 1, near(0, [0, 0, 0]), True), ("two", 2, near(1, [0, 0, 0]), True), ("none", 1, near(0, [0, 0, 0]), False)]
    got = {(r["s"], r["i"]): r for r in V.settled_clusters(spark.createDataFrame(rows, "s string, i int, v array<double>, ok boolean"), "s", "i", "v", "ok").collect()}
    of = lambda column, *keys: [got[k][column] for k in keys]
    e = [("e", i) for i in range(1, 6)]
    assert set(got) == {*e, ("two", 1), ("two", 2), ("none", 1)}
    assert of("cluster", *e) == [0, 0, 0, 1, None] and of("nearest", *e) == [0, 0, 0, 1, 1] and of("outlier", *e) == [False] * 4 + [None]
    u = unit_rows(np.array([r[2] for r in rows[:3]]))
    assert abs(got["e", 1]["cluster_similarity"] - u[0] @ (u[1] + u[2]) / np.linalg.norm(u[1] + u[2])) < 1e-8
    assert of("cluster", ("two", 1), ("two", 2), ("none", 1)) == [0, 1, None] and of("nearest", ("none", 1)) == [None]
    far = [("e", i, [0.62, *(1.0 if k == i else 0.0 for k in range(4))], True) for i in range(4)]
    bad = V.settled_clusters(spark.createDataFrame(far, "s string, i int, v array<double>, ok boolean"), "s", "i", "v", "ok", threshold=0.2, least=0.6)
    assert [r["outlier"] for r in bad.collect()] == [True] * 4


def test_percentiles_by_counts(spark):
    rng = np.random.default_rng(9)
    data = [(k, float(round(x, 6))) for k, n in (("a", 200), ("b", 7), ("c", 1)) for x in rng.normal(size=n)] + [("a", 0.25)] * 50 + [("d", None), (None, -3.5), (None, 4.5)]
    got = {r["k"]: r for r in V.exact_percentiles(spark.createDataFrame(data, "k string, v double"), ["k"], {"low": ("v", 0.1), "mid": ("v", 0.5), "high": ("v", 0.95)}).collect()}
    for k in ("a", "b", "c", None):
        own = [x for key, x in data if key == k and x is not None]
        for name, share in (("low", 10), ("mid", 50), ("high", 95)):
            assert abs(got[k][name] - np.percentile(own, share)) < 1e-8


def test_what_is_left_of_roles(spark, rows):
    clips = [("A", 1, "m", "0", "9", None), ("A", 2, "m", "0", "9", None), ("A", 3, "m", "0", "9", "short"), ("A", 4, None, None, None, None), ("A", 5, None, None, None, None)]
    df = spark.createDataFrame(clips, "role string, n int, path string, a string, z string, why string")
    got = V.enrolled(df, ["path", "a", "z"], "n", df["why"])
    assert rows(got, "n", "reject_reason") == [(1, None), (2, "duplicate_interval"), (3, "short"), (4, None), (5, "duplicate_interval")]
    kept = [("A", "1", 5.0, True), ("A", "2", 5.0, True), ("A", "2", 1.0, True), ("B", "1", 20.0, False), ("C", "", 9.0, True)]
    out = rows(V.readiness(spark.createDataFrame(kept, "role string, ep string, sec double, kept boolean"), "role", "ep", "sec"), "role", "clips", "issues", "usable")
    assert out == [("A", 3, [], True), ("B", 0, ["insufficient_total_duration", "insufficient_clips", "insufficient_distinct_episodes"], False), ("C", 1, ["insufficient_clips", "insufficient_distinct_episodes"], False)]


def test_halves_and_spectral_groups(spark):
    rng = np.random.default_rng(10)
    rows_ = [("x", i, [1.0, 0.0] if i < 2 else [0.6, 0.8]) for i in range(5)] + [("y", 0, [1.0, 0.0]), ("y", 1, [0.0, 1.0]), ("z", 0, None), ("z", 1, [0.0, 0.0])]
    got = {r["k"]: (r["windows"], r["similarity"]) for r in V.half_similarity(spark.createDataFrame(rows_, "k string, n int, v array<double>"), ["k"], "n", "v").collect()}
    assert got == {"x": (5, 0.6), "y": (2, None)}
    groups = [(int(100 * c + i), (np.eye(3)[c] + rng.normal(size=3) * 0.05).tolist(), "s") for c in range(3) for i in range(25)]
    df = spark.createDataFrame(groups, "i int, v array<double>, s string")
    label = {r["i"]: r["cluster"] for r in V.spectral(df, "s", "i", "v").collect()}
    assert [len({label[100 * c + i] for i in range(25)}) for c in range(3)] == [1, 1, 1] and len(set(label.values())) == 3
