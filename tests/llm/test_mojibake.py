import random

import pytest

from subloom.llm import mojibake as M

CLEAN = ["店主が薬を奪った", "あの男とエレベーターで話した", "船長は孤独に負けた", "母さんなら書斎だ", "律师把贵重的药 留在钟楼", "管家把假的照片留在教堂", "La fiancée a caché la clé à l’hôtel.",
         "De manhã, a irmã dele não esqueceu o relógio.", "Der Kapitän öffnete die Tür.", "El médico firmó el pañuelo en la estación.", "Who buried the letter?", "次回 ﾍﾞｰﾀ班の秘密", "¡Ojalá!", "Ωチーム 応答を", "気温は３℃だ"]


def corpus(rng, n=1500):
    noun = ["手紙", "楽譜", "指輪", "カメラ", "封筒", "日記", "遺言状", "台本"]
    verb = ["を隠した", "を燃やした", "を捨てたのは監督だ", "のことは忘れて", "を見つけた"]
    out = [rng.choice(CLEAN) for _ in range(n // 2)]
    return out + [rng.choice(["昨日", "港で", "地下室で", "真っ先に"]) + rng.choice(noun) + rng.choice(verb) for _ in range(n // 2)]


@pytest.mark.parametrize("pair", range(len(M.PAIRS)))
def test_round_trip_of_every_pair(pair):
    for text in CLEAN:
        hurt = M.damage(text, pair)
        if hurt is not None and M.LOST not in hurt and hurt != text:
            assert M.restore(hurt, pair) in (text, None)


def test_planted_damage_is_found_and_restored(spark):
    rng = random.Random(9)
    texts = corpus(rng)
    rows, hurt = [], {}
    for i, t in enumerate(texts):
        if i % 15 == 0 and not t.isascii():
            pair = M.PAIRS.index(rng.choice([("utf-8", "cp1252", 1), ("utf-8", "cp932", 1), ("cp932", "latin-1", 1), ("euc_jp", "latin-1", 1), ("utf-8", "koi8-r", 1)]))
            made = M.damage(t, pair)
            if made is not None and made != t:
                hurt[i] = (t, made)
                t = made
        rows.append((i, t, "x"))
    rows += [(100_000, None, ""), (100_001, "", ""), (100_002, "手紙を隠した" * 3000, ""), (None, M.damage("楽譜を燃やした", 0), "")]
    df = spark.createDataFrame(rows, "cue_id int, text string, restored string")
    got = {r["cue_id"]: r for r in M.repair(df, "cue_id", "text").collect()}
    found = set(got) - {None}
    assert None in got
    assert len(found & set(hurt)) >= 0.97 * len(hurt) and len(found - set(hurt)) <= 0.02 * len(hurt) + 1
    good = [i for i in hurt if i in got and got[i]["restored"]]
    assert all(got[i]["text_restored"] == hurt[i][0] for i in good) and len(good) > 0.5 * len(hurt)


def test_a_part_of_the_texts_teaches_enough(spark):
    rng = random.Random(10)
    rows, hurt = [], {}
    for i, t in enumerate(corpus(rng, 6000)):
        if i % 20 == 0 and not t.isascii() and (made := M.damage(t, 0 if i % 40 else 8)) not in (None, t):
            hurt[i], t = t, made
        rows.append((i, t))
    df = spark.createDataFrame(rows, "cue_id int, text string")
    for sample in (100_000, 1500):
        got = {r["cue_id"]: r for r in M.repair(df, "cue_id", "text", sample).collect()}
        assert len(set(got) & set(hurt)) >= 0.97 * len(hurt) and len(set(got) - set(hurt)) <= 0.02 * len(hurt) + 1
        assert all(got[i]["text_restored"] == hurt[i] for i in hurt if i in got and got[i]["restored"])


def test_empty_and_ascii(spark):
    df = spark.createDataFrame([], "cue_id int, text string")
    assert M.repair(df, "cue_id", "text").count() == 0
    df = spark.createDataFrame([(1, "plain"), (2, None)], "cue_id int, text string")
    assert M.repair(df, "cue_id", "text").count() == 0
