import unicodedata

import pytest

from subloom.llm.lookalike import look_like_entries, visual_form

ENTRIES = "ref int, name string, cue_id string"


def forms(spark, texts):
    df = visual_form(spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "i int, t string, role string"), ["t"])
    return [r["t_form"] for r in df.orderBy("i").collect()]


def test_forms_that_meet(spark):
    pairs = [
        ("Ｍｉｒａ　２", "Mira 2"),
        ("ｸﾞﾚﾀ", "グレタ"),
        ("グレタ", unicodedata.normalize("NFD", "グレタ")),
        ("ク゛レタ", "グレタ"),
        ("René", "René"),
        ("Bеth​ Нale", "Beth Hale"),
        ("ΖΟΕ", "ZOE"),
        ("水⁠穂︎谷", "⽔穂谷"),
        ("力タカナ一", "カタカナー"),
        ("a b", "a b"),
        ("凌清⽉", "凌清月"),
        ("е́", "é"),
    ]
    assert forms(spark, [a for a, _ in pairs]) == forms(spark, [b for _, b in pairs])


def test_real_differences_stay(spark):
    texts = ["Rene", "René", "MIRA", "Mira", "ハルカ", "バルカ", "パルカ", "セオ2", "セオ3", "セオ²", "②", "2", "O", "0", "a b", "ab", "a\nb"]
    assert len(set(forms(spark, texts))) == len(texts)


def test_nulls_empty_long_and_clashes(spark):
    assert forms(spark, [None, "", "ｱ" * 100_000]) == [None, "", "ア" * 100_000]
    assert forms(spark, []) == []
    with pytest.raises(ValueError):
        visual_form(spark.createDataFrame([("a", "b")], "t string, t_form string"), ["t"])


def test_entries(spark, rows):
    cues = spark.createDataFrame([(1, "Ｂeth", "n"), (2, "Beth", "n"), (3, None, "n"), (4, "Ｂeth", "n"), (5, "beth", "n"), (6, "", "n")], "cue_id int, role string, name string")
    entries = spark.createDataFrame([(10, "Beth", ""), (11, "BETH", ""), (12, None, "")], ENTRIES)
    assert rows(look_like_entries(cues, "cue_id", "role", entries, "ref", "name"), "cue_id", "ref") == [(1, 10), (4, 10)]
    assert rows(look_like_entries(cues.limit(0), "cue_id", "role", entries, "ref", "name")) == []
    assert rows(look_like_entries(cues, "cue_id", "role", entries.limit(0), "ref", "name")) == []
