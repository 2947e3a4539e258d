import numpy as np
import pytest
from pyspark.sql import functions as F

from subloom.functions import texts as T
from subloom.functions import timecodes as C
from subloom.operators import dialogue as D
from subloom.operators import keyed as K
from subloom.operators import roles as R
from subloom.operators import rules
from subloom.operators import schedules as S
from subloom.operators import voices as V


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expr(F.col("c")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, ms",
    [("00:00:01,300", 1300), ("1:02:03.004", 3723004), ("00:60:00,000", None), ("100:00:00,000", None), ("0:00:01", None), ("", None), (None, None), (" 00:00:02,000 ", 2000)],
)
def test_stamps(spark, text, ms):
    assert one(spark, text, C.stamp_ms) == ms


def test_other_times(spark):
    assert one(spark, "1:02:03.45", C.ass_ms) == 3723450 and one(spark, "1:02:03.4", C.ass_ms) is None
    assert one(spark, "1:30,5", C.clock_seconds) == 90.5 and one(spark, "1:2:3:4", C.clock_seconds) is None and one(spark, "-3", C.clock_seconds) is None
    assert one(spark, 3723004, C.stamp, "bigint") == "01:02:03,004" and one(spark, -5, C.stamp, "bigint") == "00:00:00,000" and one(spark, 360_000_000, C.stamp, "bigint") == "100:00:00,000"
    assert one(spark, "00:00:01,000 --> 00:00:02,500", C.range_ms) == 1500 and one(spark, "0:00:01.00|0:00:00.50", C.range_ms) == 0 and one(spark, "x", C.range_ms) is None


def test_text_measures(spark):
    assert one(spark, "ＡbｱアA{\\i1}", T.columns_wide) == 7
    assert one(spark, "1,2,5-7", T.expand_ranges) == [1, 2, 5, 6, 7] and one(spark, "7-5", T.expand_ranges) is None
    assert one(spark, "x_0012.srt", T.episode_of_file) == 12 and one(spark, "12.txt", T.episode_of_file) is None
    assert one(spark, "「a", T.unclosed) and not one(spark, "「a」", T.unclosed)
    assert one(spark, " Verified ", T.truth) is True and one(spark, "", T.truth) is None and one(spark, "no", T.truth) is False
    assert one(spark, "Ａ　b ", T.name_form) == "A b" and one(spark, "Ｓtraße x", T.evidence_form) == "strassex" and one(spark, None, T.compact) is None
    assert one(spark, "- a\n-b", lambda c: T.two_speakers(T.lines(c))) and one(spark, "[a\nb]", lambda c: T.screen_text(T.lines(c)))


@pytest.mark.parametrize(
    "text, n",
    [("終末世界サイコ―!", 1), ("終末世界サイコー!", 0), ("コーヒー", 0), ("-先に行って\n-すぐ追いつく", 0), ("サイコ-", 1), ("サイコｰ", 1), ("サイコ—", 1), ("サイコ−", 1), ("サイコ－", 1), ("- 台詞", 1), ("A-B", 1)],
)
def test_lookalike_marks(spark, text, n):
    assert rules.lookalike_marks(spark.createDataFrame([(1, text)], "i int, t string"), ["i"], "t").count() == n


def test_rules_of_both_profiles(spark):
    broken = lambda text, p, ms=None: {(r["rule_id"], r["severity"]) for r in rules.audit(spark.createDataFrame([(1, text, ms)], "i int, t string, ms bigint"), ["i"], "t", p, F.col("ms")).collect()}
    sd, cms = rules.SHORT_DRAMA, rules.POST_DUB
    assert broken("行くぞ", sd) == set() and broken(None, sd) == set()
    assert ("JP_PERIOD", "blocker") in broken("行くぞ。", sd) and ("JP_PERIOD", "warning") in broken("行くぞ。", cms)
    assert ("DUAL_SPEAKER_SPACE", "blocker") in broken("- あ\n- い", sd) and ("DIALOGUE_DASH_SPACE", "warning") in broken("-あ\n-い", cms)
    assert ("FULLWIDTH_ELLIPSIS", "blocker") in broken("待って…", sd) and ("ELLIPSIS", "warning") in broken("待って……", cms) and ("OVERLONG_ELLIPSIS", "warning") in broken("a....b", sd)
    assert ("PROTECTED_BREAK", "blocker") in broken("見て\nください", sd) and ("LINE_START_PARTICLE", "review") in broken("私\nはそう思う", sd)
    assert ("LINE_START_PARTICLE", "review") not in broken("私達\nはるかかなた", sd)
    assert ("CPS", "blocker") in broken("あ" * 11, sd, 300) and ("CPS", "warning") in broken("あ" * 11, sd, 500)
    assert ("GLOSSARY_TABOO", "warning") in broken("白い月光", sd) and ("LINE_WIDTH", "blocker") in broken("あ" * 12, sd) and ("LINE_WIDTH", "blocker") not in broken("あ" * 12, cms)
    assert one(spark, "１２。、！…", rules.proposed) == "12 !..."


def cues(spark, texts, gaps=None):
    rows, t = [], 0
    for i, x in enumerate(texts):
        t += (gaps or {}).get(i, 0)
        rows.append(("e", i + 1, t, t + 1000, x))
        t += 1000
    return spark.createDataFrame(rows, "episode string, ord int, s bigint, e bigint, text string")


@pytest.mark.parametrize(
    "texts, gaps, decisions",
    [
        (["Commander", "about the report", "Understood."], {}, [None, "join", "review"]),
        (["死にそうな時", "家族と", "愛する人が待ってるのが", "原動力だった"], {}, [None, "join", "join", "join"]),
        (["勘弁してよ", "ヴァージルは結婚するんだ"], {}, [None, "review"]),
        (["話は終わっていない", "いいえ、終わりです"], {}, [None, "split"]),
        (["そして", "行く"], {1: -200}, [None, "review"]),
        (["そして", None], {}, [None, "split"]),
        (["終わり。", "次"], {}, [None, "split"]),
    ],
)
def test_boundaries(spark, texts, gaps, decisions):
    got = D.boundaries(cues(spark, texts, gaps), ["episode"], "ord", "s", "e", "text").orderBy("ord").collect()
    assert [r["decision"] for r in got] == decisions


def loop(rows, gap):
    end, out = 0, []
    for t, d, free in rows:
        start = t if free else max(t, end + gap)
        if not free:
            end = max(end, start + d)
        else:
            end = max(end, t + d)
        out.append(start)
    return out


def test_push_schedule_equals_the_loop(spark):
    rng = np.random.default_rng(1)
    data = [(f"k{k}", i, int(t), int(rng.integers(1, 900)), bool(rng.random() < 0.2)) for k in range(20) for i, t in enumerate(np.sort(rng.integers(0, 9000, 12)))]
    df = spark.createDataFrame(data, "k string, i int, t bigint, d bigint, o boolean")
    got = {(r["k"], r["i"]): r["start"] for r in S.pushed(df, ["k"], "i", "t", "d", "o").collect()}
    for k in range(20):
        own = [r for r in data if r[0] == f"k{k}"]
        assert [got[r[0], r[1]] for r in own] == loop([r[2:] for r in own], 50)


def test_push_with_escape_equals_the_loop(spark):
    rng = np.random.default_rng(2)
    data = [(f"k{k}", i, int(t), int(rng.integers(1, 2500)), bool(rng.random() < 0.3)) for k in range(20) for i, t in enumerate(np.sort(rng.integers(0, 20_000, 15)))]
    df = spark.createDataFrame(data, "k string, i bigint, t bigint, d bigint, h boolean")
    got = {(r["k"], r["i"]): (r["start"], r["manual"]) for r in S.pushed_with_escape(df, ["k"], "i", "t", "d", "h").collect()}
    for k in range(20):
        end = 0
        for key, i, t, d, hard in [r for r in data if r[0] == f"k{k}"]:
            start = max(t, end + 50)
            manual = start - t > 1000 or (hard and start > t)
            assert got[key, i] == (t if manual else start, manual)
            if not manual:
                end = max(end, start + d)


def test_separation_equals_the_loop(spark):
    rng = np.random.default_rng(3)
    data = [("k", i, int(s), int(s + rng.integers(1, 900))) for i, s in enumerate(np.sort(rng.integers(0, 6000, 30)))]
    got = S.separated(spark.createDataFrame(data, "k string, i int, s bigint, e bigint"), ["k"], "i", "s", "e").orderBy("i").collect()
    start = None
    for r, (_, _, s, e) in zip(got, data):
        start = s if start is None else max(s, start + 433)
        assert r["new_start"] == start
    assert all(b["new_start"] - a["new_end"] >= 33 for a, b in zip(got, got[1:]))


def test_chunks(spark):
    rows = [("k", i, i * 3000, i * 3000 + 2000) for i in range(12)] + [("k", 12, 200_000, 201_000)]
    got = sorted((r["chunk_start"], r["chunk_end"], r["n"]) for r in S.chunks(spark.createDataFrame(rows, "k string, i int, s bigint, e bigint"), ["k"], "i", "s", "e").collect())
    assert [g[2] for g in got] == [5, 5, 2, 1] and got[-1] == (198_000, 203_000, 1)


def test_keyed(spark, rows):
    a = spark.createDataFrame([("e", 1), ("e", 2), ("e", 2)], "k string, i int")
    b = spark.createDataFrame([("e", 2), ("e", 2), ("e", 3)], "k string, i int")
    assert rows(K.coverage(a, b, ["k", "i"])) == [("e", 1, "missing"), ("e", 2, "duplicate"), ("e", 3, "unknown")]
    base = spark.createDataFrame([(1, "a", "x"), (2, "", "y"), (3, "c", None)], "i int, r string, t string")
    new = spark.createDataFrame([(1, 1, "b", ""), (1, 2, "z", None), (2, 1, "q", "y")], "i int, o int, r string, t string")
    assert rows(K.updated(base, new, ["i"], ["r", "t"], "o"), "i", "r", "t", "update_state") == [(1, "z", "x", "conflict"), (2, "q", "y", "merged"), (3, "c", None, "kept")]
    drawn = K.drawn_by_hash(spark.createDataFrame([("s", i) for i in range(50)], "s string, i int"), ["s"], ["i"], 0.2)
    assert drawn.count() == 10


def test_roles(spark, rows):
    people = spark.createDataFrame([("Anna Lee", "Danteの弟。"), ("Bo Lee", "Anna's mother"), ("Al", None)], "n string, about string")
    assert rows(R.aliases(people, "n"), "alias", "role") == [("Anna Lee", "Anna Lee"), ("Anna", "Anna Lee"), ("Bo Lee", "Bo Lee")]
    got = rows(R.relations(people, "n", "about"), "role", "relation", "other", "derived")
    assert ("Anna Lee", "younger_brother_of", "Dante", False) in got and ("Anna", "child_of_mother", "Bo Lee", True) in got and ("Bo Lee", "mother_of", "Anna", False) in got
    votes = spark.createDataFrame([([("a", "X"), ("b", "X"), ("c", "Y")],), ([("a", "X"), ("b", "Y")],), ([("a", "X")],), ([],), ([("a", "X"), ("b", "X")],)], "v array<struct<model:string,label:string>>")
    assert [r["s"]["state"] for r in votes.select(R.plain_votes(F.col("v")).alias("s")).collect()] == ["most", "disagreement", "insufficient", "insufficient", "all"]


def test_voices(spark):
    df = spark.createDataFrame([(i, "A" if i < 4 else "B", v, 1.0) for i, v in enumerate([[1.0, 0.1], [1.0, 0.0], [0.9, 0.1], [1.0, -0.1], [0.0, 1.0], [0.1, 1.0], [0.0, 0.0], None])], "i int, r string, v array<double>, w double")
    top = {r["i"]: r for r in V.similarities(df, ["i"], "v", V.centroids(df, "r", "v"), "r").collect()}
    assert set(top) == set(range(6)) and top[0]["candidate"] == "A" and top[5]["candidate"] == "B" and top[0]["second"] == "B"
    left = {r["i"]: r for r in V.left_out(df, ["i"], "r", "v").collect()}
    others = np.array([[1.0, 0.0], np.array([0.9, 0.1]) / np.hypot(0.9, 0.1), np.array([1.0, -0.1]) / np.hypot(1, 0.1)]).sum(0)
    mine = np.array([1.0, 0.1]) / np.hypot(1, 0.1)
    assert abs(left[0]["own"] - others @ mine / np.linalg.norm(others)) < 1e-8
    assert V.average_linkage(np.eye(3), 0.5).tolist() == [0, 1, 2] and len(set(V.average_linkage(np.array([[1, 0], [0.99, 0.1], [0, 1.0]]), 0.7).tolist())) == 2


def test_similarities_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, f"r{i % 7}", rng.normal(size=5).tolist()) for i in range(40)], "i int, r string, v array<double>")
    centres = V.centroids(df, "r", "v")
    whole = sorted(map(tuple, V.similarities(df, ["i"], "v", centres, "r").collect()))
    monkeypatch.setattr(V, "HELD_ROLES", 3)
    assert sorted(map(tuple, V.similarities(df, ["i"], "v", centres, "r").collect())) == whole
