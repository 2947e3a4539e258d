import json

import pytest
from pyspark.sql import functions as F

from subloom.operators import states as S
from subloom.sources import catalogs as N
from subloom.sources import tables as B


def test_staleness_to_do_and_invalidated(spark, rows):
    a = spark.createDataFrame([("x", "1"), ("y", "2"), ("z", None), (None, "5")], "k string, d string")
    b = spark.createDataFrame([("x", "1"), ("y", "3"), ("z", None), (None, "5"), ("w", "4")], "k string, d string")
    assert rows(S.staleness(a, b, ["k"], "d"), "k", "state") == [("w", "new"), ("x", "fresh"), ("y", "stale"), ("z", "stale"), (None, "fresh")]
    assert rows(S.staleness(a, b.limit(0), ["k"], "d"), "state") == [("gone",)] * 4
    jobs = spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "k string")
    log = spark.createDataFrame([("x", 1, "failed"), ("x", 2, "passed"), ("y", 1, "passed"), ("y", 3, "failed"), (None, 1, "passed")], "k string, n int, s string")
    assert rows(S.to_do(jobs, log, ["k"], "n", F.col("s") == "passed"), "k") == [("y",), ("z",)]
    now = spark.createDataFrame([("x", 1, "A", "n"), ("x", 2, None, "n"), ("y", 1, "B", "n"), (None, 1, "C", "n"), ("w", 1, "D", "n")], "k string, n int, r string, note string")
    then = spark.createDataFrame([("x", 1, "A"), ("x", 2, ""), ("y", 1, "b"), (None, 1, "C"), ("v", 1, "E")], "k string, n int, r string")
    got = rows(S.invalidated(now, then, ["k"], ["n"], ["r"], ["note"]), "k", "n", "note", "changed")
    assert got == [("w", 1, None, True), ("x", 1, "n", False), ("x", 2, "n", False), ("y", 1, None, True), (None, 1, "n", False)]


def test_tracks_units_and_answers(spark, rows):
    data = [("a", "t1", 1.0), ("a", "t1", 3.0), ("a", "t2", 2.0), ("b", "t1", -1.0), ("c", "t2", 0.5), ("c", "t1", -2.0), ("d", None, 1.0), ("e", "t1", None)]
    got = rows(S.top_tracks(spark.createDataFrame(data, "c string, t string, s double"), ["c"], "t", "s"), "c", "t", "score", "second", "state")
    assert got == [("a", "t1", 2.0, "t2", "several_positive_tracks"), ("b", "t1", -1.0, None, "no_positive_track"), ("c", "t2", 0.5, "t1", "single_positive_track")]
    units = spark.createDataFrame([("u", 2, "A"), ("u", 1, None), ("v", 1, " "), (None, 1, "B")], "u string, n int, v string")
    assert rows(S.unit_votes(units, ["u"], "n", "v"), "u", "rows", "voted", "first_vote") == [("u", 2, 1, None), ("v", 1, 0, " "), (None, 1, 1, "B")]
    said = spark.createDataFrame([(1, "Ａnn", 0.9), (2, "Ann", 0.5), (3, "Who", 0.9), (4, None, 0.9), (5, "Ann", None), (6, "Ann", float("nan"))], "i int, r string, c double")
    assert rows(S.classified(said, "r", "c", spark.createDataFrame([("Ann",), (None,)], "n string")), "i", "known_role", "state") == [(1, "Ann", "ok"), (2, "Ann", "review"), (3, None, "review"), (4, None, "review"), (5, "Ann", "review"), (6, "Ann", "review")]


def test_names_and_lists(spark, rows):
    turns = spark.createDataFrame([("A ", "0:01", "2,5", 9), ("B", "3", "3", 9), ("", "1", "2", 9), ("C", "x", "2", 9), (None, None, None, 9)], "speaker_label string, start string, end string, start_ms int")
    assert rows(N.turn_rows(turns), "speaker", "start_ms", "end_ms") == [("A", 1000, 2500)]
    with pytest.raises(ValueError):
        N.turn_rows(turns.drop("end"))
    known, several = N.role_names(spark.createDataFrame([("Ann",), ("Ａnn",), ("Bo ",), ("Bo",), (None,), (" ",)], "n string"), "n", spark.createDataFrame([("Bo",), ("男性音声",)], "g string"))
    assert rows(known, "role") == [("Bo",), ("男性音声",)] and rows(several, "roles") == [(["Ann", "Ａnn"],)]
    listed = spark.createDataFrame([("0001", "v"), ("0001", "v"), ("12", None), (None, " ")], "e string, video string")
    assert rows(N.manifest_faults(listed, "e", ["video"]), "episode", "fault") == [("0001", "duplicate"), ("12", "missing_video"), ("12", "not_four_digits"), (None, "missing_video"), (None, "not_four_digits")]
    assert rows(N.cue_ids(spark.createDataFrame([(1, "a"), (None, "b")], "source_index int, t string"))) == [("1",)]


def test_sinks(spark, rows, tmp_path):
    df = spark.createDataFrame([("0001", 1, "A", True), ("0001", 2, None, False)], "e string, n int, r string, locked boolean")
    B.write_lines(df, str(tmp_path / "lines"))
    assert rows(spark.read.json(str(tmp_path / "lines")), "n", "r") == [(1, "A"), (2, None)]
    B.write_report(df, str(tmp_path / "report"), {"n": "番号", "r": "角色"})
    assert spark.read.option("header", True).csv(str(tmp_path / "report")).columns == ["番号", "角色"]
    with pytest.raises(Exception):
        B.write_report(df, str(tmp_path / "report"), {"n": "番号"})
    B.write_json({"a": "港"}, str(tmp_path / "r.json"))
    B.write_json({"a": "灯"}, str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text("utf-8")) == {"a": "灯"} and len(list(tmp_path.glob(".r.json*"))) == 0
    B.write_subtitles(spark.createDataFrame([("0001", "1\n00:00:00,000 --> 00:00:01,000\nx\n")], "e string, srt string"), "e", "srt", str(tmp_path / "srt"))
    assert next((tmp_path / "srt" / "e=0001").glob("*.txt")).read_text("utf-8").startswith("﻿1\n00:00")
    assert B.refuse_changes(df, df, ["e", "n"], "locked", "r") is df
    with pytest.raises(ValueError):
        B.refuse_changes(df.where("n = 2"), df, ["e", "n"], "locked", "r")
    with pytest.raises(ValueError):
        B.refuse_changes(df.withColumn("r", F.lit("B")), df, ["e", "n"], "locked", "r")


def test_files_frames_suffixes_and_leading_rows(spark, rows):
    files = spark.createDataFrame([("1.srt",), ("show_01.srt",), ("ep12 (1).srt",), ("x111.srt",), ("a1.srt",), (None,)], "f string")
    episodes = spark.createDataFrame([("0001",), ("12",), ("x",), (None,)], "e string")
    assert rows(S.files_of_episodes(files, "f", episodes, "e")) == [("1.srt", "0001"), ("ep12 (1).srt", "0001"), ("ep12 (1).srt", "12"), ("show_01.srt", "0001")]
    frames = spark.createDataFrame([(1, "a, b"), (2, "a,a"), (3, " "), (4, None), (5, "a,b,c")], "i int, f string")
    assert rows(S.frame_gaps(frames, ["i"], "f", 2)) == [(2, 2, 1, True), (3, 0, 2, False), (4, 0, 2, False), (5, 3, 0, False)]
    paths = spark.createDataFrame([("/a/b/c/d/x.MP4",), ("a/y.srt",), ("a/.z/q.srt",), ("r.srt",), (None,)], "p string")
    assert rows(S.counts_by_suffix(paths, "p", {"video": (".mp4",), "subtitle": (".srt", ".ass")})) == [("a", "subtitle", 1), ("a/b", "video", 1), ("a/b/c", "video", 1), ("a/b/c/d", "video", 1)]
    df = spark.createDataFrame([("k", i * 3_000_000, f"t{i}") for i in range(6)] + [(None, 1, None)], "k string, n bigint, t string")
    got = {r["k"]: ([x["t"] for x in r["first"]], r["rows"]) for r in S.leading(df, ["k"], "n", ["t"], 4).collect()}
    assert got == {"k": (["t0", "t1", "t2", "t3"], 6), None: ([None], 1)}
    cues = spark.createDataFrame([("k", 1, "a"), ("k", 2, " "), ("k", 5, "b"), ("m", 3, "c")], "k string, n int, t string")
    assert rows(S.inspected(cues, ["k"], "n", "t")) == [("k", 3, 1, 5, 1, 1, "review"), ("m", 1, 3, 3, 0, 0, "ok")]


def test_states_of_scores_and_tracks(spark, rows):
    ranked = spark.createDataFrame([(1, "A", 0.9, 0.2, 3.0), (2, "A", 0.5, 0.2, 3.0), (3, "A", 0.9, 0.05, 3.0), (4, "B", 0.1, None, 3.0), (5, "A", 0.9, 0.2, 0.5), (6, "A", None, None, None)], "i int, candidate string, similarity double, margin double, sec double")
    gates = spark.createDataFrame([("A", 0.6, 0.1)], "r string, similarity_threshold double, margin_threshold double")
    assert rows(S.score_states(ranked, gates, "r", "sec"), "i", "state") == [(1, "eligible"), (2, "low_similarity"), (3, "ambiguous"), (4, "eligible"), (5, "too_short"), (6, "too_short")]
    tracks = spark.createDataFrame([("t", "single_positive_track"), ("t", "several_positive_tracks"), ("u", "single_positive_track")], "t string, s string")
    assert rows(S.mapped_tracks(tracks, "t", "s", spark.createDataFrame([("t", "B"), ("t", "A")], "t string, r string")), "t", "mapped_role", "track_role") == [("t", "A", "A"), ("t", "A", None), ("u", None, None)]
