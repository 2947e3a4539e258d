import numpy as np

from subloom.operators import voices as V
from subloom.plans.keyed_queries import q_average_linkage


def unit_rows(v):
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def greedy(v, threshold):
    groups = [[i] for i in range(len(v))]
    while len(groups) > 1:
        best, a, b = max((np.mean(v[x] @ v[y].T), -i, -j) for i, x in enumerate(groups) for j, y in enumerate(groups) if i < j)
        if best < threshold:
            break
        groups[-a] += groups.pop(-b)
    return {frozenset(g) for g in groups}


def test_average_linkage_equals_the_greedy_one():
    rng = np.random.default_rng(5)
    for threshold in (-0.2, 0.3, 0.7, 0.9):
        for n in (3, 10, 25):
            v = unit_rows(rng.normal(size=(n, 4)))
            got = V.average_linkage(v, threshold)
            assert {frozenset(np.flatnonzero(got == c).tolist()) for c in set(got.tolist())} == greedy(v, threshold)
    same = np.repeat(np.eye(3), 50, 0)
    assert V.average_linkage(same, 0.7).tolist() == np.repeat([0, 1, 2], 50).tolist()
    assert V.average_linkage(np.zeros((0, 3)), 0.7).tolist() == []


def test_a_label_is_clustered_whole(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(100 * i + label, (np.eye(4)[i % 2] + rng.normal(size=4) * 0.05).astype(float).tolist(), label) for i in range(20) for label in (0, 1)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = q_average_linkage(spark, str(tmp_path)).collect()
    assert len(got) == 40
    assert {r["scope"]: len({x["cluster"] for x in got if x["scope"] == r["scope"]}) for r in got} == {"0": 2, "1": 2}
    assert len({(r["scope"], r["vec_id"] // 100 % 2, r["cluster"]) for r in got}) == 4
