import random

from subloom.operators import spans


def by_hand(s, e, voice, energy):
    v = next(((a, b) for a, b in voice if a <= s + 150 <= b), None)
    last = None
    for a, b in energy:
        if v and (b < v[0] - 200 or a > v[1] + 200):
            continue
        if a <= e + 100:
            last = (a, b)
    return (*(v or (None, None)), *(last or (None, None)))


def disjoint(rng, n):
    marks = sorted(rng.sample(range(0, 40_000, 50), 2 * n))
    return list(zip(marks[::2], marks[1::2]))


def test_islands_at_equals_the_loop(spark):
    rng = random.Random(19)
    voice, energy = ({k: disjoint(rng, n) for k in "ab"} for n in (12, 40))
    cues = [(k, i, s, s + rng.randrange(0, 4000)) for k in "abc" for i, s in enumerate(rng.randrange(-200, 41_000) // 50 * 50 for _ in range(60))]
    table = lambda islands: spark.createDataFrame([(k, *x) for k, own in islands.items() for x in own], "k string, rs bigint, re bigint")
    df = spark.createDataFrame(cues, "k string, i int, s bigint, e bigint")
    got = {tuple(r)[:2]: tuple(r)[2:] for r in spans.islands_at(df, table(voice), table(energy), ["k"], "i").collect()}
    want = {(k, i): by_hand(s, e, voice.get(k, []), energy.get(k, [])) for k, i, s, e in cues}
    assert got == want and sum(x[0] is not None for x in want.values()) > 20 and sum(x[2] is None for x in want.values()) > 60
