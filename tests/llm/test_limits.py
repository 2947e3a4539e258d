import random

from pyspark.sql import functions as F

from subloom.llm import cutoff as C


def texts(rng, n, length):
    return ["".join(rng.choices("あいうえおかきくけこ", k=length(rng))) for _ in range(n)]


def limits(spark, rows):
    df = spark.createDataFrame(rows, "s string, t string").select("s", F.xxhash64("t").alias("h"), F.length("t").alias("c"), F.octet_length("t").alias("b"))
    return {r["s"]: r["chars"] for r in C._limits(df).collect()}


def test_copies_of_a_text_are_no_limit(spark):
    rng = random.Random(15)
    free = lambda r: r.randrange(300, 3000)
    rows = [("a", t) for t in texts(rng, 200, free) + texts(rng, 90, lambda r: 250)] + [("a", "写し" * 20)] * 150
    assert limits(spark, rows) == {"a": [250]}
    assert limits(spark, [("b", "写し" * 20)] * 500) == {}


def test_every_limit_of_a_source_counts(spark):
    rng = random.Random(16)
    rows = [("a", t) for t in texts(rng, 200, lambda r: r.randrange(300, 3000)) + texts(rng, 90, lambda r: 250) + texts(rng, 40, lambda r: 120)]
    assert limits(spark, rows) == {"a": [120, 250]}
    at = lambda n, held: set(C.at_limits(n, 3 * n, "あ", (held, None, None)))
    assert at(120, [120, 250]) == at(250, [120, 250]) == at(250, [250]) != at(120, [250])
    assert at(249, [120, 250]) == at(249, [250]) and at(121, [120, 250]) == at(121, [120])


def test_texts_at_the_limit_are_found_beside_copies(spark):
    rng = random.Random(17)
    say = lambda k: "".join(rng.choice(["船長は", "執事は", "監督は"]) + rng.choice(["港で", "書斎で", "地下室で"]) + rng.choice(["泣いた。", "歌った。", "手紙を隠した。"]) for _ in range(k))
    whole = [say(rng.randrange(4, 20)) for _ in range(1200)]
    rows = [(i, t[:130], "a") for i, t in enumerate(whole)] + [(2000 + i, "同じ話の写しです。", "a") for i in range(900)]
    got = {r["doc_id"]: r for r in C.scored(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), "doc_id", "text", "source").where(F.col("doc_id") < 2000).collect()}
    cut = {i for i, t in enumerate(whole) if len(t) > 130 and t[129] != "。"}
    found = {i for i, r in got.items() if r["is_cut"]}
    assert len(found & cut) >= 0.98 * len(cut) and len(found - cut) <= 0.02 * len(cut)


def test_block_sizes_are_learned_from_the_lengths(spark):
    rng = random.Random(18)
    free = ["x" * rng.randrange(300, 9000) + str(i) for i in range(2000)]
    rows = [("free", t) for t in free]
    for s, m in (("small", 512), ("large", 4096)):
        rows += [(s, t) for t in free[:900]] + [(s, f"{i:06d}" + "y" * (m * rng.randrange(1, 9) - 6 + rng.randrange(-3, 3))) for i in range(150)]
    df = spark.createDataFrame(rows, "s string, t string").select("s", F.xxhash64("t").alias("h"), F.length("t").alias("c"), F.octet_length("t").alias("b"))
    assert {r["s"]: r["block"] for r in C._limits(df).collect() if r["block"]} == {"small": 512, "large": 4096}
    near = lambda n: set(C.at_limits(n, n, "x", (None, None, 512)))
    assert near(1024) == near(1021) == near(1026) != near(1027) == near(700)
    assert C.at_limits(1024, 1024, "x", (None, None, None)) == []


def test_limits_joined_by_an_exchange_give_the_same(spark, monkeypatch):
    rng = random.Random(19)
    rows = [(i, t[:90] if i % 3 else t, f"s{i % 4}") for i, t in enumerate(texts(rng, 400, lambda r: r.randrange(60, 300)))] + [(900, None, None), (901, "", "s1")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    want = {r["doc_id"]: r["p_cut"] for r in C.scored(df, "doc_id", "text", "source").collect()}
    monkeypatch.setattr(C, "HELD_SOURCES", 0)
    got = {r["doc_id"]: r["p_cut"] for r in C.scored(df, "doc_id", "text", "source").collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)
