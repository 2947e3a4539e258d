import io
import zipfile

import pytest

from subloom.sources import subtitles as S
from subloom.sources import tables as B
from subloom.streaming.resume import append_stream, read_stream, sessions

SRT = "\ufeff40\r\n01:02:03,004 --> 01:02:05,000\r\n港の灯\r\nが消えた\r\n\r\n\r\n12\r\n00:10:00,000 --> 00:10:00,750 position:50%\r\nWho left?\r\n"


def test_srt(spark, rows):
    df = spark.createDataFrame([(1, SRT), (2, "1\n00:00:05,000 --> 00:00:04,000\nx\n\n2\n00:00:05,000 --> 00:00:06,000\ny"), (3, ""), (4, None), (5, "a\nb\nc\n\n2\nz\ny\n\n3\n00:00:01,000 --> 00:00:02,000")], "i int, t string")
    assert rows(S.srt_cues(df, ["i"], "t"), "i", "source_index", "start_ms", "end_ms", "text") == [(1, 12, 600000, 600750, "Who left?"), (1, 40, 3723004, 3725000, "港の灯\nが消えた")]
    assert rows(S.srt_cues(df, ["i"], "t", strict=False), "i", "source_index") == [(1, 12), (1, 40), (2, 2)]
    assert rows(S.srt_blocks(df, ["i"], "t").where("fault is not null"), "i", "block_no", "fault") == [(2, 1, "order"), (5, 1, "index"), (5, 2, "range"), (5, 3, "index")]


def test_srt_written_and_read_again(spark, rows):
    cues = spark.createDataFrame([("e", 2, 1000, 2000, "b"), ("e", 1, 0, 500, "a\nc")], "k string, o int, s bigint, e bigint, t string")
    text = S.srt_text(cues, ["k"], "o", "s", "e", "t")
    assert rows(S.srt_cues(text, ["k"], "srt"), "ord", "source_index", "start_ms", "end_ms", "text") == [(1, 1, 0, 500, "a\nc"), (2, 2, 1000, 2000, "b")]


def test_ass_rttm_and_mending(spark, rows):
    ass = spark.createDataFrame([(1, "[Events]\nDialogue: 0,0:00:01.00,0:00:02.50,D,,0,0,0,,a, b\\Nc\nDialogue: 0,x")], "i int, t string")
    got = S.ass_cues(ass, ["i"], "t").orderBy("line_no").collect()
    assert (got[0]["start_ms"], got[0]["end_ms"], got[0]["lines"]) == (1000, 2500, ["a, b", "c"]) and got[1]["fault"] == "fields"
    lines = spark.createDataFrame([("SPEAKER f 1 1.5 0.25 <NA> <NA> A <NA> <NA>",), ("SPEAKER f 1 2 0 <NA> <NA> B <NA> <NA>",), ("x",)], "value string")
    assert rows(S.rttm_turns(lines)) == [("f", "A", 1500, 1750)]
    torn = spark.createDataFrame([("1\n00:00:01,000 --> 00:00:02,000\na\n2\n00:00:03,000 --> 00:00:04,000\nb",)], "t string")
    assert S.srt_cues(torn.select(S.mended(torn["t"]).alias("t")), [], "t", strict=False).count() == 2


def test_encodings(spark, tmp_path, rows):
    text = "1\n00:00:01,000 --> 00:00:02,000\n並ばなくて\n"
    for name, codec in (("a.srt", "utf-8-sig"), ("b.SRT", "utf-16"), ("c.srt", "cp932"), ("._d.srt", "utf-8"), ("e.txt", "utf-8")):
        (tmp_path / name).write_bytes(text.encode(codec))
    (tmp_path / "f.srt").write_bytes(b"\xff\x80\xff")
    got = {r["path"][-5:]: (r["text"], r["encoding"]) for r in S.subtitle_files(spark, str(tmp_path)).collect()}
    assert got == {"a.srt": (text, "utf-8-sig"), "b.SRT": (text, "utf-16"), "c.srt": (text, "cp932"), "f.srt": got["f.srt"]}


def test_tsv_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([("1", 'a\n"b"\tc'), ("2", None)], "k string, text string")
    B.write_tsv(df, str(tmp_path / "t"), ["k", "text", "extra"])
    back = B.read_tsv(spark, str(tmp_path / "t"), ("k", "text"), ("more",))
    assert rows(back, "k", "text", "extra", "more") == [("1", 'a\n"b"\tc', "", ""), ("2", "", "", "")]
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        B.write_tsv(df, str(tmp_path / "t"), ["k"])
    with pytest.raises(ValueError):
        B.read_tsv(spark, str(tmp_path / "t"), ("absent",))


def test_sheet_cells():
    out = io.BytesIO()
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>名前</t></si><si><r><t>a</t></r><r><t>b</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="AB1" t="s"><v>1</v></c></row><row r="3"><c r="B3" t="inlineStr"><is><t>x</t></is></c><c r="C3"><v>5</v></c><c r="D3"/></row></sheetData></worksheet>')
    assert B.sheet_cells(out.getvalue()) == [(1, 1, "名前"), (1, 28, "ab"), (3, 2, "x"), (3, 3, "5")]


def test_append_and_streams(spark, tmp_path):
    source, target, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    df = spark.createDataFrame([("e", i, None if i == 3 else "x") for i in range(6)], "k string, i int, v string")
    df.where("i < 4").coalesce(1).write.parquet(source)
    append_stream(read_stream(spark, source, df), target, ["k", "i"], mark).awaitTermination()
    assert spark.read.parquet(target).count() == 4
    df.where("i >= 2").coalesce(1).write.mode("append").parquet(source)
    append_stream(read_stream(spark, source, df), target, ["k", "i"], mark).awaitTermination()
    assert sorted(r["i"] for r in spark.read.parquet(target).collect()) == list(range(6))
    times = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:10:00"), ("a", "2024-01-01 02:00:00")], "u string, t string").selectExpr("u", "cast(t as timestamp) t")
    assert sorted(r["n"] for r in sessions(times, ["u"], "t", "30 minutes", "1 hour").collect()) == [1, 2]
