import numpy as np

from subloom.llm import mojibake as M

CLEAN = ["店主が薬を奪った", "律师把贵重的药 留在钟楼", "La fiancée a caché la clé à l’hôtel.", "Der Kapitän öffnete die Tür.", "Who buried it?", "次回 ﾍﾞｰﾀ班の秘密", "Ωチーム 応答を", "気温は３℃だ", "Ты где, Анна"]


def test_the_model_is_fitted_on_all_texts(spark, monkeypatch):
    seen = []

    def fit(texts):
        seen.append(texts.count())
        return np.zeros((M.STATES, M.SINGLE + M.DOUBLE), np.float32)

    monkeypatch.setattr(M, "fit", fit)
    M.repair(spark.range(150_000).selectExpr("id", "concat('手紙', id) as t"), "id", "t")
    assert seen == [150_000]


def test_counts_of_parts_add_up():
    texts = [*CLEAN, "", *(h for t in CLEAN for i in range(len(M.PAIRS)) if (h := M.damage(t, i)) is not None)]
    assert (sum(M._count(texts[i : i + 7]) for i in range(0, len(texts), 7)) == M._count(texts)).all()
    assert not M._count([]).any()
