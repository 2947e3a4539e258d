import random

from pyspark.sql import functions as F

from subloom.operators import activity as A

ACT, CUE = "k string, stem string, s bigint, e bigint, ratio string", "k string, cue_id int, s bigint, e bigint, stem string, state string"


def frames(intervals):
    return {t for s, e in intervals if s is not None and e is not None for t in range(s, e)}


def data(rng):
    act = [(rng.choice("xy"), rng.choice("abc"), s := rng.randrange(0, 3000), s + rng.randrange(1, 400), "clash") for _ in range(40)]
    cues = [(rng.choice("xy"), i, s := rng.randrange(0, 3600), s + rng.randrange(1, 300), rng.choice("abc"), "") for i in range(25)]
    return act + [("x", "a", None, 5, ""), ("x", "a", 9, 9, ""), act[0]], cues + [("y", 99, 5, None, "a", "")]


def test_against_frames(spark):
    rng = random.Random(21)
    act, cues = data(rng)
    a, c = spark.createDataFrame(act, ACT), spark.createDataFrame(cues, CUE)
    by = {(k, st): frames([x[2:4] for x in act if x[:2] == (k, st)]) for k in "xy" for st in "abc"}
    line = {k: max(max(v) + 1 for (kk, _), v in by.items() if kk == k and v) for k in "xy"}
    got = {(r["k"], r["stem"]): (r["active_ms"], round(r["ratio"], 9)) for r in A.activity_ratios(a, ["k"], "stem").collect()}
    assert got == {x: (len(v), round(len(v) / line[x[0]], 9)) for x, v in by.items() if v}
    both = {(k, p, q): by[k, p] & by[k, q] for k in "xy" for p in "abc" for q in "abc" if p < q}
    got = {(r["k"], r["stem_a"], r["stem_b"]): r["shared_ms"] for r in A.shared_activity(a, ["k"], "stem").collect()}
    assert got == {x: len(v) for x, v in both.items() if v}
    want = set()
    for x, v in both.items():
        group = []
        for t in [*sorted(v), None]:
            if group and (t is None or t - group[-1] - 1 > 80):
                if len(group) >= 80:
                    want.add((*x, group[0], group[-1] + 1, len(group)))
                group = []
            group.append(t)
    joint = A.joint_activity(a, ["k"], "stem")
    assert {tuple(r) for r in joint.select("k", "stem_a", "stem_b", "s", "e", "active_ms").collect()} == want
    any_ = {k: set().union(*(v for (kk, _), v in by.items() if kk == k)) for k in "xy"}
    sound = [x for x in cues if x[3] is not None and x[3] > x[2]]
    missed = {(r["k"], r["cue_id"]): r["active_ms"] for r in A.missed_cues(c, a, ["k"], "cue_id", 60, 20).collect()}
    near = {(k, i): len(any_[k] & set(range(max(0, s - 20), e + 20))) for k, i, s, e, *_ in sound}
    assert missed == {x: n for x, n in near.items() if n < 60}
    off = {r["k"]: (r["active_ms"], r["off_ms"]) for r in A.off_cue_activity(a, c, ["k"], 20).collect()}
    assert off == {k: (len(v), len(v - frames([(x[2] - 20, x[3] + 20) for x in sound if x[0] == k]))) for k, v in any_.items()}
    free = A.unassigned_activity(a, c, ["k"], "cue_id", 100, 0, 10, 5).collect()
    want = {}
    for k in "xy":
        own = [x for x in sound if x[0] == k]
        lo, hi = max(0, min(x[2] for x in own) - 100), max(x[3] for x in own) + 100
        spans, run = [], []
        for t in [*sorted(any_[k]), None]:
            if run and (t is None or t != run[-1] + 1):
                if len(run) >= 10:
                    spans.append((max(run[0], lo), min(run[-1] + 1, hi)))
                run = []
            run.append(t)
        left = frames([x for x in spans if x[1] - x[0] >= 10]) - frames([(max(0, x[2] - 5), x[3] + 5) for x in own])
        run = []
        for t in [*sorted(left), None]:
            if run and (t is None or t != run[-1] + 1):
                if len(run) >= 10:
                    s, e = run[0], run[-1] + 1
                    before = max((x[3] for x in own if x[3] <= s + 5), default=None)
                    after = min((x[2] for x in own if x[2] >= e - 5), default=None)
                    want[k, s, e] = (min((x[1] for x in own if x[3] == before), default=None), min((x[1] for x in own if x[2] == after), default=None))
                run = []
            run.append(t)
    assert {(r["k"], r["s"], r["e"]): (r["previous_cue"], r["next_cue"]) for r in free} == want


def test_onsets_reviews_and_empty_tables(spark, rows):
    act = spark.createDataFrame([("x", "a", 0, 400, ""), ("x", "a", 1000, 3000, ""), ("x", "b", 9000, 9500, "")], ACT)
    cues = spark.createDataFrame([("x", 1, 980, 1500, "a", ""), ("x", 2, 1600, 2600, "a", ""), ("x", 3, 2900, 3100, "a", ""), ("x", 4, 5000, 5100, "b", ""), ("x", 5, 9000, 9100, "b", "")], CUE)
    assert rows(A.onset_faults(cues, act, ["k"], "stem"), "stem", "s", "reason") == [("a", 2900, "already_active"), ("b", 5000, "no_activity")]
    found = spark.createDataFrame([("x", 1, 100, 200), ("x", 2, 500, 900), (None, 3, 1, 2)], "k string, id int, s bigint, e bigint")
    notes = spark.createDataFrame([("x", 130, 190, "heard it there"), ("x", 480, 950, "no"), ("x", 480, 950, None)], "k string, s bigint, e bigint, note string")
    assert rows(A.unreviewed(found, notes, ["k"], ["id"], F.length("note") > 5), "id") == [(2,), (3,)]
    none = spark.createDataFrame([], ACT)
    assert A.joint_activity(none, ["k"], "stem").count() == A.activity_ratios(none, ["k"], "stem").count() == 0
    assert A.missed_cues(cues, none, ["k"], "cue_id").count() == 5 and A.unassigned_activity(none, cues, ["k"], "cue_id").count() == 0
