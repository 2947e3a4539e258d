import random

from pyspark.sql import functions as F

from subloom.functions import texts as T
from subloom.operators import keyed as K
from subloom.operators import reviews as R
from subloom.operators import transcripts as X
from subloom.sources.subtitles import srt_lenient

ROW = "episode string, n int, role string, text string, changed string"


def test_reviews_change_only_what_they_fit(spark, rows):
    own = [("e", 1, "A", "x", ""), ("e", 2, None, "y", ""), ("e", 3, "B", None, ""), (None, 4, "B", "z", ""), ("e", 5, "A", "x", "")]
    back = [("e", 1, "Ｂ ", "x", ""), ("e", 2, "A", "other", ""), ("e", 3, "Who", "", ""), (None, 4, "A", "z", ""), ("e", 5, "A", "x", ""), ("e", 5, "B", "x", ""), ("e", 9, "A", "", ""), ("e", 2, " ", "", ""), ("e", 2, None, "", "")]
    df, given = spark.createDataFrame(own, ROW).drop("changed"), spark.createDataFrame(back, ROW)
    out, issues = R.reviewed(df, given, ["episode", "n"], "role", ["text"], spark.createDataFrame([("A",), ("B",), (None,)], "name string"))
    assert rows(issues, "episode", "n", "issue") == [("e", 2, "source_differs"), ("e", 3, "role_unknown"), ("e", 5, "duplicate"), ("e", 9, "unknown")]
    assert rows(out, "n", "role", "changed") == [(1, "B", True), (2, None, False), (3, "B", False), (4, "A", True), (5, "A", False)]


def test_samples_integrity_and_rollup(spark, rows):
    df = spark.createDataFrame([("e", i, "a" if i % 2 else "b", i % 10 == 0) for i in range(40)] + [("f", 1, None, None)], "episode string, n int, sp string, whole boolean")
    drawn = R.blind_sample(df, ["episode", "sp"], ["episode", "n"], F.col("whole"), 0.25, ["episode", "n"])
    got = {r["n"] for r in drawn.where("episode = 'e'").collect()}
    assert {0, 10, 20, 30} <= got and len(got) == 4 + 5 + 4 and drawn.columns == ["episode", "n"]
    enough = {(r["episode"], r["sp"]): (r["rows"], r["required"], r["audited"], r["enough"]) for r in R.sample_sufficiency(df, ["episode", "sp"], F.col("whole"), 0.2).collect()}
    assert enough == {("e", "a"): (20, 4, 0, False), ("e", "b"): (20, 4, 4, True), ("f", None): (1, 1, 0, False)}
    source = spark.createDataFrame([("e", 1, "x"), ("e", 2, "y"), ("e", 4, None)], "episode string, n int, text string")
    given = spark.createDataFrame([("e", 1, "x"), ("e", 3, "z"), ("e", 4, ""), ("e", 5, "")], "episode string, n int, text string")
    found = R.source_integrity(source, given, ["episode"], "n", ["text"])
    assert rows(found, "place", "issue") == [(2, "index_order"), (2, "text"), (4, "added")]
    every = spark.createDataFrame([("e",), ("g",), (None,)], "episode string")
    assert rows(R.rollup({"a": found, "b": found.limit(0)}, ["episode"], every), "episode", "issues", "failed", "passed") == [("e", 3, ["a"], False), ("g", 0, [], True), (None, 0, [], True)]


def test_votes_that_contradict_themselves(spark, rows):
    data = [(1, "ok", "A", "A", "false"), (2, "ok", "A", "B", None), (3, "ok", " ", "B", "1"), (4, "hint", "A", "B", "yes"), (5, "no", "A", "B", ""), (6, "??", "A", "B", "true"), (7, "ok", "Ａ", "A", "true"), (8, None, None, None, None)]
    df = spark.createDataFrame(data, "i int, s string, c string, r string, f string")
    got = rows(R.vote_consistency(df, ["i"], "s", "c", "r", "f", ["ok"], ["hint"], ["no", ""]), "i", "issue")
    assert got == [(2, "conflict_flag_missing"), (3, "missing_candidate"), (4, "weak_vote_must_not_flag"), (5, "ineligible_has_candidate"), (6, "invalid_status"), (7, "stale_conflict_flag")]


def test_continuity(spark, rows):
    data = [("e", 1, 0, 900, "死にそうな時", "A", "U1", False), ("e", 2, 900, 1500, "家族と", "B", "U1", False), ("e", 3, 1500, 2000, "帰ろう", "C", "U2", False), ("e", 4, 2000, 2500, "はい。", "D", None, True), ("e", 5, 9000, 9500, "次だ", "A", "U3", False)]
    df = spark.createDataFrame(data, "k string, n int, s bigint, z bigint, t string, r string, u string, told boolean")
    args = (["k"], "n", "s", "z", "t", "r", "u")
    got = rows(R.continuity_issues(df, *args), "n", "issue")
    assert (2, "role_switch_inside_semantic_unit") in got and not any(n == 5 for n, _ in got)
    assert rows(R.continuity_issues(df, *args, risky=F.col("n") == 5), "n", "issue")[-1] == (5, "role_switch_during_reaction_or_offscreen_continuation")
    assert not [n for n, _ in rows(R.continuity_issues(df, *args, risky=F.col("n") == 5, explained=F.col("told")), "n", "issue") if n in (4, 5)]


def test_lines_are_followed(spark):
    def plain(heard, line, at):
        places, begin = [], at
        for c in line:
            for k in range(at, min(at + 40, len(heard))):
                if heard[k] == c:
                    places.append(k)
                    at = k + 1
                    break
        return (places, at) if places and len(places) / len(line) >= 0.4 else ([], begin)

    rng = random.Random(23)
    for _ in range(500):
        heard, line = ("".join(rng.choices("abcde", k=rng.randrange(n))) for n in (80, 12))
        at = rng.randrange(10)
        assert X.followed(heard, line, at) == plain(heard, line, at)
    lines = spark.createDataFrame([("e", 1, "ab c"), ("e", 2, "zzz"), ("e", 3, "ca"), ("f", 1, "ab"), ("e", 4, None)], "k string, n int, t string")
    letters = spark.createDataFrame([("e", i, c, 100 * i, 100 * i + 90) for i, c in enumerate("abcxca")] + [("g", 0, "a", 0, 1)], "k string, place bigint, letter string, s bigint, e bigint")
    got = {(r["k"], r["n"]): (r["start_ms"], r["last_start_ms"], r["end_ms"], r["letters"], r["found"]) for r in X.aligned(lines, letters, ["k"], "n", "t").collect()}
    assert got == {("e", 1): (0, 200, 290, 3, 3), ("e", 2): (None, None, None, 3, 0), ("e", 3): (400, 500, 590, 2, 2), ("e", 4): (None, None, None, 0, 0), ("f", 1): (None, None, None, 2, 0)}


def test_names_keys_levels_and_plans(spark, rows):
    df = spark.createDataFrame([("1,3-5,3", "x_0012.mp4", "cluster:7:Speaker01", ' a/b:*c. '), ("5-3", "ep-0100-0002_x", "cluster:12345:a:b", "..."), (None, None, None, None)], "r string, n string, c string, f string")
    got = rows(df.select(T.episode_numbers(F.col("r")), T.four_digits(F.col("n")), T.last_four_digits(F.col("n")), T.cluster_key(F.col("c")), T.safe_name(F.col("f")), T.letter_tokens(F.col("n"))))
    assert got == [(None, None, "0002", "12345:a:b", "unnamed", ["ep", "x"]), (None, None, None, None, None, None), (["0001", "0003", "0004", "0005"], "0012", None, "0007:Speaker01", "a_b_c", ["x", "mp"])]
    sound = K.levels(spark.createDataFrame([("a", 1.0), ("a", -0.5), ("a", 0.0), ("a", None)], "k string, v double"), ["k"], "v").first()
    assert (sound["samples"], sound["peak"]) == (3, 1.0) and abs(sound["rms"] - (1.25 / 3) ** 0.5) < 1e-12 and abs(sound["silence_ratio"] - 1 / 3) < 1e-12
    a, b = spark.createDataFrame([(1, "x"), (2, "y"), (None, None)], "k int, v string"), spark.createDataFrame([(2, "z"), (3, "x"), (None, None)], "k int, v string")
    assert rows(K.merged_plans({"a": a, "b": b}, "k", ["v"]), "k", "plan", "duplicate") == [(1, "a", True), (2, "a", True), (2, "b", True), (3, "b", True), (None, "a", False), (None, "b", False)]
    assert rows(K.disjoint_keys(a, b, ["k"]), "k") == [(1,)]
    assert rows(K.by_episode({"a": a, "b": b}, ["k"]), "k", "absent") == [(1, ["b"]), (2, []), (3, ["a"]), (None, [])]


def test_lenient_subrip(spark, rows):
    df = spark.createDataFrame([(1, "note\n1\n00:00:01,500 --> 2.25\nA\n b\n\nno times\n\n1:02 --> x\nC"), (2, None), (3, "")], "i int, t string")
    assert rows(srt_lenient(df, ["i"], "t"), "cue_id", "start_seconds", "end_seconds", "text") == [(1, 1.5, 2.25, "A b"), (2, 62.0, None, "C")]
