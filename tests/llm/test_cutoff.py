import random

from subloom.llm import cutoff as C

S = "doc_id bigint, text string, source string, is_cut string"


def sentence(rng):
    who, what, where = (rng.choice(x) for x in (["船長", "執事", "監督", "副長"], ["手紙を隠した", "楽譜を燃やした", "指輪を見つけた", "封筒を破った"], ["港で", "書斎で", "地下室で", "屋上で"]))
    return f"{who}は{where}{what}。"


def data(rng, n):
    out, cut = [], set()
    for i in range(n):
        t = "".join(sentence(rng) for _ in range(rng.randrange(6, 30))) + rng.choice(["", "", "\n以上", "\n（続く）"])
        source = rng.choice(["a", "b", "limit"])
        if source == "limit" and len(t) > 200:
            t = t[:200]
            if not t.endswith(("。", "以上", "）", "\n")):
                cut.add(i)
        elif rng.random() < 0.05:
            t = t[: rng.randrange(30, len(t) - 10)]
            if not t.endswith("。"):
                t += rng.choice(["", "...", "�"])
                cut.add(i)
        out.append((i, t, source, "clash"))
    return out, cut


def test_held_out_texts(spark):
    rows, cut = data(random.Random(13), 3000)
    got = {r["doc_id"]: r for r in C.scored(spark.createDataFrame(rows, S), "doc_id", "text", "source").collect()}
    found = {i for i, r in got.items() if r["is_cut"]}
    assert len(got) == 3000
    assert len(found & cut) >= 0.95 * len(cut) and len(found - cut) <= 0.05 * len(cut)
    by = {r["source"]: r for r in C.rates(C.scored(spark.createDataFrame(rows, S), "doc_id", "text", "source"), "source").collect()}
    assert by["limit"]["rate"] > 3 * by["a"]["rate"] and sum(r["texts"] for r in by.values()) == 3000


def test_nulls_empty_and_long(spark):
    rows = [(1, None, "a", ""), (2, "", None, ""), (3, " \n", "a", ""), (4, "終わった。" * 20_000, None, ""), (5, "x", "a", ""), (5, "x", "a", "")]
    got = C.scored(spark.createDataFrame(rows, S), "doc_id", "text", "source").collect()
    assert len(got) == 6 and all(r["p_cut"] == 0 for r in got if r["doc_id"] in (1, 2, 3))
    assert C.scored(spark.createDataFrame([], S), "doc_id", "text", "source").count() == 0


def test_cut_leaves_finished_texts_alone():
    rng = random.Random(14)
    for _ in range(500):
        made = C.cut("船長は港で泣いた。副長は笑った。" * 3, rng)
        assert made is None or not made.rstrip().endswith("。")
