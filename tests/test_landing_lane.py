"""Lines that don't fit their schema: plain scans stop, checked ones keep them apart."""

import pytest
from pyspark.sql import functions as F

from courtstats.operators import quality as Q
from courtstats.sources import landing as L
from courtstats.sources import tables as T

SCHEMA = "a long, b string, c array<int>, d struct<x:int>"
GOOD = ['{"a":1,"b":"x","c":[1],"d":{"x":2}}', '{"a":null,"extra":9}', "{}", ' {"b":"é\\n"} ']
BAD = {
    '{"a":2,"b":': "not a JSON object",
    "plain words": "not a JSON object",
    "[1, 2]": "not a JSON object",
    '{"a":"oops","b":"y"}': "type of a",
    '{"a":1.5,"c":["x"]}': "type of a, c",
    '{"d":{"x":"far"},"a":1}': "type of d",
}


def land(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_every_line_is_good_or_has_a_reason(spark, tmp_path, rows):
    land(tmp_path / "log" / "0", "one.json", *GOOD, "", *BAD)
    parsed = L.parse_lines(L.landing_lines(spark, str(tmp_path), "log"), SCHEMA)
    reasons = {r["line"]: r["reason"] for r in parsed.collect()}
    assert reasons == {**dict.fromkeys(GOOD), **BAD, "": "blank"}
    assert L.good_lines(parsed).count() == len(GOOD)
    assert {r["line"] for r in L.quarantined(parsed).collect()} == set(BAD)
    # Good lines are read as a plain scan reads them.
    land(tmp_path / "fine" / "0", "one.json", *GOOD)
    plain = L.scan_landing(spark, str(tmp_path), "fine", SCHEMA)
    assert rows(L.good_lines(parsed)) == rows(plain)


@pytest.mark.parametrize("line", list(BAD))
def test_plain_scans_stop_at_a_bad_line(spark, tmp_path, line):
    land(tmp_path / "log" / "0", "one.json", GOOD[0], line)
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILED_READ"):
        L.scan_landing(spark, str(tmp_path), "log", SCHEMA).collect()
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILED_READ"):
        L.scan_dimension(spark, str(tmp_path / "log" / "0"), SCHEMA).collect()


def test_streams_and_csv_stop_too(spark, tmp_path):
    land(tmp_path / "log" / "0", "one.json", '{"a":"oops"}')
    stream = L.stream_landing(spark, str(tmp_path / "log" / "0"), "a long")
    query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILED_READ"):
        query.awaitTermination()
    land(tmp_path / "csv", "one.csv", "id,d", "7,x")
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILED_READ"):
        T.scan_csv(spark, str(tmp_path / "csv"), "id string, d int").collect()


def test_load_keeps_both_lanes_and_reconciles(spark, tmp_path, rows):
    root, target, lane = str(tmp_path / "in"), str(tmp_path / "good"), str(tmp_path / "lane")
    land(tmp_path / "in" / "log" / "0", "one.json", *GOOD, *list(BAD)[:2])
    land(tmp_path / "in" / "log" / "1", "two.json", *list(BAD)[2:], "")

    def load():
        L.load_landing(spark, root, "log", SCHEMA, target, lane, str(tmp_path / "cp"), [0, 1], files_per_batch=1)

    load()
    load()  # nothing new
    land(tmp_path / "in" / "log" / "0", "three.json", GOOD[0])
    load()
    good, kept = spark.read.parquet(target), spark.read.parquet(lane)
    assert good.count() == len(GOOD) + 1 and kept.count() == len(BAD)
    parsed = L.parse_lines(L.landing_lines(spark, root, "log", [0, 1]), SCHEMA)
    counts = L.reconcile(parsed, good, kept)
    assert sorted(tuple(r)[1:] for r in counts.collect()) == [(1, 0, 1, 0, True), (5, 1, 0, 4, True), (6, 0, 4, 2, True)]
    lost = L.reconcile(parsed, good.limit(0), kept)
    assert rows(lost.where("loaded = 0").select("adds_up").distinct()) == [(False,), (True,)]


def test_column_profile_and_report(spark, rows):
    df = spark.createDataFrame(
        [(1, "x", [1], 0.5), (2, "x", None, None), (None, "y", [2], 1.5), (2, None, [2], -1.0)],
        "a int, `b c` string, l array<int>, d double",
    )
    found = {r["column_name"]: r for r in Q.column_profile(df).collect()}
    a, b, nested = found["a"], found["b c"], found["l"]
    assert (a["rows"], a["nulls"], a["null_share"], a["smallest"], a["largest"], a["distinct_values"]) == (4, 1, 0.25, "1", "2", 2)
    assert [(e["item"], e["count"]) for e in b["frequent"]][0] == ("x", 2)
    assert (nested["nulls"], nested["smallest"], nested["distinct_values"], nested["frequent"]) == (1, None, 0, [])
    empty = Q.column_profile(df.limit(0), ["a"]).first()
    assert (empty["rows"], empty["nulls"], empty["null_share"], empty["smallest"]) == (0, 0, None, None)
    assert rows(Q.column_report(df, ["a", "z"])) == [("a", True, "int"), ("z", False, None)]
