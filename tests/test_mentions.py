import random

from subloom.operators import evidence as E


def by_hand(texts, terms):
    out = []
    for key, text in texts:
        places = {(i, i + len(t), t) for t in terms if t for i in range(len(text or "")) if text.startswith(t, i)}
        inside = lambda p: any(q[0] <= p[0] and p[1] <= q[1] and q != p for q in places)
        out += [(key, t) for t in {p[2] for p in places if not inside(p)}]
    return sorted(out)


def found(spark, texts, terms):
    df, known = spark.createDataFrame(texts, "id int, text string"), spark.createDataFrame([(t,) for t in terms], "role string")
    return sorted(map(tuple, E.mentions(df, "id", "text", known, "role").collect()))


def test_terms_that_overlap_in_part_all_count(spark):
    texts = [(1, "ABCE"), (2, "ハルカトレア"), (3, "ABx"), (4, ""), (5, None), (6, "BCE AB"), (7, "😀ABCE")]
    got = found(spark, texts, ["AB", "BC", "BCE", "ハルカ", "カトレア", "カト", "", None])
    assert got == [(1, "AB"), (1, "BCE"), (2, "カトレア"), (2, "ハルカ"), (3, "AB"), (6, "AB"), (6, "BCE"), (7, "AB"), (7, "BCE")]
    assert found(spark, texts, []) == []


def test_mentions_do_not_depend_on_the_blocks(spark, monkeypatch):
    rng = random.Random(18)
    word = lambda a, b: "".join(rng.choices("ABCあ", k=rng.randrange(a, b)))
    texts, terms = [(i, word(0, 14)) for i in range(150)], sorted({word(1, 5) for _ in range(40)})
    texts += [(150, texts[7][1]), (7, texts[7][1])]
    assert found(spark, texts, terms) == by_hand(texts, terms)
    monkeypatch.setattr(E, "HELD_TERMS", 8)
    assert found(spark, texts, terms) == by_hand(texts, terms)
