import random

from subloom.operators import copies
from subloom.operators.copies import differences

L = "episode string, source_index int, role string, text string, difference string"
R = "episode string, source_index int, who string, said string, difference string"
C = {"role": ("role", "who"), "text": ("text", "said")}


def run(spark, a, b, **kw):
    df = differences(spark.createDataFrame(a, L), spark.createDataFrame(b, R), ["episode", "source_index"], C, ("labels", "script"), **kw)
    return sorted(((r["episode"], r["source_index"], r["difference"]) for r in df.collect()), key=repr)


def norm(x):
    return (x or "").replace("\r\n", "\n").replace("\r", "\n")


def brute(a, b):
    out = []
    side = lambda rows: {k: [{norm(r[c]) for r in rows if r[:2] == k} for c in (2, 3)] for k in {r[:2] for r in rows}}
    x, y = side(a), side(b)
    for k in x.keys() | y.keys():
        if k not in y:
            out.append((*k, "missing_in_script"))
        elif k not in x:
            out.append((*k, "missing_in_labels"))
        else:
            out += [(*k, n) for i, n in enumerate(("role", "text")) if x[k][i] != y[k][i]]
    return sorted(out, key=repr)


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    values = [None, "", "a", "a ", "a\nb", "a\r\nb", "a\rb", "A", "長い" * 2000]
    make = lambda n: [(rng.choice(["e1", "e2", None]), rng.choice([1, 2, 3, 4, 5, 6, 7, 8, None]), rng.choice(values), rng.choice(values), "x") for _ in range(n)]
    a = make(40)
    b = [r if rng.random() < 0.7 else make(1)[0] for r in a] + make(5) + a[:4]
    for buckets in (1, 3, 64, copies.BUCKETS):
        assert run(spark, a, b, buckets=buckets) == brute(a, b)
    monkeypatch.setattr(copies, "HELD_BUCKETS", 0)
    assert run(spark, a, b) == brute(a, b)


def test_empty_and_equal(spark):
    a = [("e", 1, None, "x\r\ny", "")]
    b = [("e", 1, "", "x\ny", "other")] * 3
    assert run(spark, a, b) == []
    assert run(spark, a, []) == [("e", 1, "missing_in_script")]
    assert run(spark, [], b) == [("e", 1, "missing_in_labels")]
    assert run(spark, [], []) == []


def test_null_parts_of_a_key_are_told_apart(spark):
    kind = "a string, b string, v string"
    left, right = spark.createDataFrame([(None, "x", "1")], kind), spark.createDataFrame([("x", None, "1")], kind)
    got = differences(left, right, ["a", "b"], {"v": ("v", "v")}).collect()
    assert sorted(((r["a"], r["b"], r["difference"]) for r in got), key=repr) == sorted([(None, "x", "missing_in_right"), ("x", None, "missing_in_left")], key=repr)
