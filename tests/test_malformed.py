import random

from subloom.operators.malformed import judge_records

S = "line_id bigint, raw string, reason string"
OK = "0001\t5\t1.0\t2.5\tS\ttext"


def reasons(spark, raws):
    good, bad = judge_records(spark.createDataFrame([(i, r, "clash") for i, r in enumerate(raws)], S))
    return {r["line_id"]: r["reason"] for r in bad.collect()}, {r["line_id"]: r for r in good.collect()}


def test_each_reason(spark):
    cases = {
        OK: None,
        OK + "\r": None,
        "0001\t 05 \t1.0\t 2.5 \tS\ttext": None,
        '0001\t5\t1.0\t2.5\t"S"\t"a\tb\n""c"""': None,
        '0001\t5\t1.0\t2.5\tS\ta "b" c': None,
        '0001\t5\t1.0\t2.5\tS\t"open': "quoting",
        '0001\t5\t1.0\t2.5\tS\t"a"b': "quoting",
        '0001\t5\t1.0\t2.5\tS\t"a "b" c"': "quoting",
        '0001\t5\t1.0\t2.5\tS\t"': "quoting",
        "0001\t5\t1.0\t2.5\tS": "column_count",
        OK + "\t": "column_count",
        "": "column_count",
        None: "column_count",
        OK.replace("\t5\t", "\t0\t"): "source_index",
        OK.replace("\t5\t", "\t1234567890\t"): "source_index",
        OK.replace("\t5\t", "\t５\t"): "source_index",
        OK.replace("2.5", "1.0"): "end_seconds",
        OK.replace("2.5", "2."): "end_seconds",
        OK.replace("2.5", "NaN"): "end_seconds",
        OK.replace("text", "　\xa0"): "text",
        OK.replace("text", ""): "text",
        OK.replace("text", '""'): "text",
        OK.replace("text", "a\x01"): "text",
        OK.replace("text", '"a\nb"'): None,
    }
    bad, good = reasons(spark, list(cases))
    assert [bad.get(i) for i in range(len(cases))] == list(cases.values())
    assert set(bad) | set(good) == set(range(len(cases)))
    assert good[3]["text"] == 'a\tb\n"c"' and good[3]["speaker"] == "S" and good[2]["source_index"] == 5 and good[0]["end_seconds"] == 2.5


def test_repeats_null_keys_long_and_empty(spark):
    long = "0001\t5\t1.0\t2.5\tS\t" + '"' + '""x' * 50_000 + '"'
    df = spark.createDataFrame([(1, "x", ""), (1, "x", ""), (None, "x", ""), (2, long, ""), (None, OK, "")], S)
    good, bad = judge_records(df)
    assert sorted((r["line_id"], r["reason"]) for r in bad.collect() if r["line_id"]) == [(1, "column_count")] * 2 and bad.count() == 3
    assert good.count() == 2 and max(len(r["text"]) for r in good.collect()) == 100_000
    good, bad = judge_records(spark.createDataFrame([], S))
    assert good.count() == bad.count() == 0


def parse(raw):
    """The quoting by the letter, sign by sign."""
    raw = raw[:-1] if raw.endswith("\r") else raw
    fields, i = [], 0
    while True:
        if raw[i : i + 1] == '"':
            j, value = i + 1, ""
            while True:
                if j >= len(raw):
                    return None
                if raw[j] == '"':
                    if raw[j + 1 : j + 2] == '"':
                        value, j = value + '"', j + 2
                        continue
                    break
                value, j = value + raw[j], j + 1
            j += 1
            if j < len(raw) and raw[j] != "\t":
                return None
        else:
            j = raw.find("\t", i)
            j = len(raw) if j < 0 else j
            value = raw[i:j]
        fields.append(value)
        if j >= len(raw):
            return fields
        i = j + 1


def test_quoting_against_a_scanner(spark):
    rng = random.Random(3)
    raws = ["".join(rng.choice('"\t\ta\n"') for _ in range(rng.randrange(0, 14))) for _ in range(500)]
    bad, _ = reasons(spark, raws)
    for i, raw in enumerate(raws):
        fields = parse(raw)
        assert (bad.get(i) == "quoting") == (fields is None), raw
        if fields is not None:
            assert (bad.get(i) == "column_count") == (len(fields) != 6), raw
