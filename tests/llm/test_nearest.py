import random

from subloom.llm.nearest import nearest_in_time

L = "cue_id bigint, episode string, spk string, start bigint, turn_id string"
R = "turn_id bigint, episode string, speaker string, start_seconds double, cue_id string"


def run(spark, a, b, tol=500):
    df = nearest_in_time(spark.createDataFrame(a, L), spark.createDataFrame(b, R), [("episode", "episode"), ("spk", "speaker")], "cue_id", "start", "turn_id", "start_seconds", tol)
    return sorted((r["cue_id"], r["turn_id"]) for r in df.collect())


def brute(a, b, tol=500):
    out = []
    for cid, ep, sp, s, _ in a:
        if cid is None or not (ep or "").strip() or not (sp or "").strip() or s is None:
            continue
        near = [(abs(s * 1000 - round(t * 1e6)), round(t * 1e6), i) for i, e, p, t, _ in b if i is not None and (e, p) == (ep, sp) and t is not None and t == t]
        near = [x for x in near if x[0] <= tol * 1000]
        if near:
            out.append((cid, min(near)[2]))
    return sorted(out)


def test_against_brute_force(spark):
    rng = random.Random(5)
    span = [2_000, 40_000, 200_000]
    a = [(i, rng.choice(["e", "f", None, " "]), rng.choice(["s", "t", None, ""]), rng.choice([None, rng.randrange(-500, rng.choice(span))]), "x") for i in range(400)]
    b = [(i, rng.choice(["e", "f", None]), rng.choice(["s", "t", None]), rng.choice([None, float("nan"), rng.randrange(-400, 20_000) / 10_000, rng.randrange(0, 2_000_000) / 10_000]), "x") for i in range(400)]
    b += [(i + 1000, *r[1:]) for i, r in enumerate(b[:100])]
    a += a[:30]
    assert run(spark, a, b) == brute(a, b)
    assert run(spark, a, b, 3) == brute(a, b, 3)


def test_bounds_ties_and_empty(spark):
    b = [(7, "e", "s", 1.0, ""), (5, "e", "s", 1.0, ""), (6, "e", "s", 2.0, "")]
    a = [(1, "e", "s", 500, ""), (2, "e", "s", 499, ""), (3, "e", "s", 1500, ""), (4, "e", "s", 1501, ""), (5, "e", "s", 2500, ""), (6, "e", "s", 2501, "")]
    assert run(spark, a, b) == [(1, 5), (3, 5), (4, 6), (5, 6)]
    assert run(spark, a, []) == run(spark, [], b) == []
