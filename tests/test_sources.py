import json
import os
import re

import pytest
from panel_helpers import at
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cadenza.sources import payloads, tables
from cadenza.streaming import ingest


def write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode(encoding))


def test_mixed_encodings_and_drifting_headers(spark, folder):
    write(f"{folder}/history_1.csv", "spot_num,ymd,hh,vol\nA-01,20240101,7,10\n", "utf-8-sig")
    write(f"{folder}/history_2.csv", "spot_num,ymd,hh,vol,이름\n007,20240101,8,5,성산로\n", "cp949")
    write(f"{folder}/history_3.csv", "spot_num,ymd,hh,vol,이름\nB,20240101,8,5,사직로\n", "utf-8")
    write(f"{folder}/other.csv", "a\n1\n")
    got = tables.read_history(spark, f"{folder}/history*.csv")
    rows = {r.spot_num: r for r in got.collect()}
    assert set(rows) == {"A-01", "007", "B"}
    assert rows["007"]["이름"] == "성산로" and rows["B"]["이름"] == "사직로" and rows["A-01"]["이름"] is None
    assert rows["007"].source_file == "history_2.csv"
    known = tables.read_history(spark, f"{folder}/history_2.csv", encoding=tables.KOREAN)
    assert known.first()["이름"] == "성산로"
    with pytest.raises(Exception, match="absent_x|PATH_NOT_FOUND|no file"):
        tables.read_history(spark, f"{folder}/absent_x*.csv")


def test_columns_are_matched_by_name(spark, folder):
    write(f"{folder}/a 1.csv", "spot_num,ymd,hh,vol\nA,20240101,7,10\n")
    write(f"{folder}/b[2].csv", "\nymd, spot_num ,hh,lane_num,vol\n20240102,B,8,3,5\n", "utf-8-sig")
    write(f"{folder}/c.csv", "vol,\"hh\",ymd,이름,spot_num\n6,9,20240103,\"성산로, 남\",C\n", "cp949")
    write(f"{folder}/d.csv", "spot_num,ymd,hh,vol\nD,20240104,7,1\n")
    write(f"{folder}/empty.csv", "")
    got = tables.read_history(spark, f"{folder}/*.csv")
    rows = {r.spot_num: (r.ymd, r.hh, r.vol, r.lane_num, r["이름"], r.source_file) for r in got.collect()}
    assert rows == {
        "A": ("20240101", "7", "10", None, None, "a 1.csv"), "B": ("20240102", "8", "5", "3", None, "b[2].csv"),
        "C": ("20240103", "9", "6", None, "성산로, 남", "c.csv"), "D": ("20240104", "7", "1", None, None, "d.csv")}
    assert got.count() == 4 and [r.vol for r in got.select("vol").orderBy("vol").collect()] == ["1", "10", "5", "6"]
    assert len(tables.csv_layouts(spark, f"{folder}/*.csv")) == 3  # scans: one per header, not per file
    typed = tables.read_csv(spark, f"{folder}/*.csv", schema="vol double, lane_num int, absent string")
    assert sorted((r.vol, r.lane_num, r.absent) for r in typed.collect() if r.lane_num) == [(5.0, 3, None)]
    assert typed.agg(F.sum("vol")).first()[0] == 22.0


def test_repeated_and_blank_headers_get_names(spark, folder):
    write(f"{folder}/a.csv", ",v,v\n1,2,3\n")
    got = tables.read_csv(spark, f"{folder}/*.csv")
    assert len(set(got.columns)) == 3 and tuple(got.first()) == ("1", "2", "3")


def test_undecodable_file_is_an_error(spark, folder):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/bad.csv", "wb") as f:
        f.write(b"a,b\n\xff\xff,1\n")
    with pytest.raises(UnicodeError):
        tables.read_csv(spark, f"{folder}/*.csv")


def test_panel_roundtrip(spark, series, folder):
    df = series({"007": [1, 2], "b": [3]}).withColumn("temp_c", F.lit("x"))
    typed = tables.as_panel(df)
    assert typed.schema["temp_c"].dataType.simpleString() == "double"
    tables.write_panel(typed, f"{folder}/p")
    assert tables.read_panel(spark, f"{folder}/p").count() == 3
    df.withColumn("datetime", F.col("datetime").cast("string")).write.option("header", True).csv(f"{folder}/c")
    back = tables.read_panel(spark, f"{folder}/c", "csv")
    assert {(r.spot_num, r.datetime, r.vol) for r in back.collect()} == {("007", at(0), 1.0), ("007", at(1), 2.0), ("b", at(0), 3.0)}
    with pytest.raises(ValueError):
        tables.as_panel(df.drop("datetime"))


def test_metrics_and_records(spark, folder):
    write(f"{folder}/metrics_a.csv", " model , MAE,RMSE,MAPE\nx,1,2,3\n", "utf-8-sig")
    write(f"{folder}/metrics_b.csv", "model,RMSE,MAE,MAPE\ny,bad,1,3\n")
    got = {r.model: r for r in tables.read_metrics(spark, f"{folder}/metrics*.csv").collect()}
    assert got["x"].RMSE == 2.0 and got["y"].RMSE is None and got["y"].metrics_file == "metrics_b.csv"
    tables.write_records(spark.createDataFrame([("강", (1.5,))], "n string, m struct<a:double>"), f"{folder}/r")
    assert tables.read_records(spark, f"{folder}/r").first().m.a == 1.5
    write(f"{folder}/one/state.json", json.dumps({"spot_index": 3, "ymd": "20240101"}, indent=2))
    assert tables.read_records(spark, f"{folder}/one/state.json").first().spot_index == 3
    tables.write_report(spark.range(3), f"{folder}/report")
    assert len([f for f in os.listdir(f"{folder}/report") if f.endswith(".csv")]) == 1


def xml(rows="", code="INFO-000", total="2"):
    return (f"<Readings><list_total_count>{total}</list_total_count><RESULT><CODE>{code}</CODE>"
            f"<MESSAGE> fine </MESSAGE></RESULT>{rows}</Readings>")


CELL = "<row><spot_num>Z</spot_num><lane_num> 1 </lane_num><vol>12</vol><odd>q</odd></row>"


@pytest.fixture
def parsed(spark):
    data = [
        ("a", "20240101", "07", None, xml(CELL + "<row><hh>8</hh><vol></vol></row>")),
        ("b", "20240101", "07", None, xml("", total="abc")), ("c", "20240101", "07", 1, xml(CELL, code="ERROR-300")),
        ("d", "20240101", "07", 1, "quota\nexceeded" * 40),
    ]
    df = spark.createDataFrame(data, ingest.REQUEST_SCHEMA)
    return payloads.parse_payloads(df)


def test_payloads(parsed):
    got = {r.spot_num: r for r in parsed.collect()}
    assert (got["a"].service, got["a"].total_count, got["a"].code, got["a"].message) == ("Readings", 2, "INFO-000", "fine")
    assert got["a"].rows == [{"spot_num": "Z", "lane_num": "1", "vol": "12", "odd": "q"}, {"hh": "8", "vol": ""}]
    assert got["b"].total_count is None and got["b"].rows == [] and got["b"].error is None
    assert len(got["d"].error) == 200 and "\n" not in got["d"].error and got["d"].rows == []
    assert payloads.quarantined(parsed).count() == 1


def test_volume_rows(parsed):
    got = payloads.volume_rows(parsed).orderBy("row_no").collect()
    assert [(r.spot_num, r.ymd, r.hh, r.lane_num, r.vol, r.extra) for r in got] == [
        ("Z", "20240101", 7.0, 1.0, 12.0, {"odd": "q"}), ("a", "20240101", 8.0, None, None, {})]


def test_pages_of_one_unit_are_kept_apart(spark):
    data = [("a", "20240101", "07", start, xml(CELL)) for start in (1, 1001, 1001)]
    rows = payloads.volume_rows(payloads.parse_payloads(spark.createDataFrame(data, ingest.REQUEST_SCHEMA)))
    assert sorted(r.row_no for r in rows.drop("extra").dropDuplicates().collect()) == [1, 1001]


def test_spot_rows(spark, parsed):
    with pytest.raises(PySparkException):
        payloads.spot_rows(parsed).collect()
    row = "<row><spot_num>A-01</spot_num><spot_nm>x</spot_nm><grs80tm_x>1.5</grs80tm_x><grs80tm_y>?</grs80tm_y></row>"
    fine = payloads.parse_payloads(spark.createDataFrame([(xml(row),)], "payload string"))
    assert tuple(payloads.spot_rows(fine).first()) == ("A-01", "x", 1.5, None)


@pytest.mark.parametrize("text, want", [("0-23", list(range(24))), ("0,6, 12", [0, 6, 12]), ("7", [7])])
def test_hours(text, want):
    assert ingest.parse_hours(text) == want


def test_pending_work(spark):
    spots = spark.createDataFrame([("b",), ("a",), ("c",)], "spot_num string")
    assert ingest.pending_work(spots, "20240228", "20240301").count() == 3 * 3 * 24
    done = spark.createDataFrame([("a", "20240228", "06")], "spot_num string, ymd string, hh string")
    left = ingest.pending_work(spots, "20240228", "20240228", "6,7", done, only=["a", "c"])
    assert {tuple(r) for r in left.collect()} == {("a", "20240228", "07"), ("c", "20240228", "06"), ("c", "20240228", "07")}
    assert {r.spot_num for r in ingest.pending_work(spots, "20240101", "20240101", "0", first_spots=2).collect()} == {"a", "b"}


@pytest.mark.parametrize("spots, first, last, calls", [(13, "20240101", "20240630", 56784), (11, "20240101", "20241231", 96624)])
def test_published_call_counters(spark, spots, first, last, calls):
    table = spark.range(spots).select(F.col("id").cast("string").alias("spot_num"))
    assert ingest.pending_work(table, first, last).count() == calls


def test_ingest_resumes_and_drops_redelivered_units(spark, folder):
    def deliver(name, units):
        spark.createDataFrame([(s, "20240101", h, 1, xml(CELL * n)) for s, h, n in units], ingest.REQUEST_SCHEMA).coalesce(
            1).write.parquet(f"{folder}/in/{name}")

    def run():
        return ingest.ingest(spark, f"{folder}/in/*", f"{folder}/out", f"{folder}/state")

    deliver("1", [("a", "01", 2), ("a", "02", 0)])
    run()
    run()
    assert tuple(ingest.progress(ingest.completed_units(spark, f"{folder}/out")).first()) == (2, 2)
    deliver("2", [("a", "02", 0), ("a", "03", 1)])
    deliver("3", [("a", "01", 2)])
    run()
    assert ingest.completed_units(spark, f"{folder}/out").count() == 5
    rows = ingest.ingested_rows(spark, f"{folder}/out")
    assert sorted((r.hh, r.row_no) for r in rows.collect()) == [(1.0, 1), (1.0, 2), (3.0, 1)]


def test_append_history(spark, folder):
    rows = spark.createDataFrame([("a", "20240101", 1.0)], "spot_num string, ymd string, vol double")
    tables.append_history(rows, f"{folder}/h")
    tables.append_history(rows, f"{folder}/h")
    assert spark.read.parquet(f"{folder}/h").count() == 2
    assert os.path.isdir(f"{folder}/h/ymd=20240101")


BARE = "<row><lane_num>1</lane_num><vol>12</vol></row>"


def test_corrected_deliveries_broken_responses_and_a_fresh_checkpoint(spark, folder):
    def deliver(name, payloads_):
        data = [(s, "20240101", h, 1, p) for s, h, p in payloads_]
        spark.createDataFrame(data, ingest.REQUEST_SCHEMA).coalesce(1).write.parquet(f"{folder}/in/{name}")

    deliver("1", [("a", "01", xml(BARE)), ("a", "02", "<html>busy"), ("b", "01", xml(BARE))])
    ingest.ingest(spark, f"{folder}/in/1", f"{folder}/out", f"{folder}/state1")
    assert {(r.spot_num, r.hh) for r in ingest.completed_units(spark, f"{folder}/out").collect()} == {("a", "01"), ("b", "01")}
    before = ingest.ingested_rows(spark, f"{folder}/out").where("spot_num = 'b'").collect()
    corrected = re.sub(r"<vol>[^<]*</vol>", "<vol>77</vol>", xml(BARE))
    deliver("2", [("a", "01", corrected), ("a", "02", xml(BARE))])
    ingest.ingest(spark, f"{folder}/in/2", f"{folder}/out", f"{folder}/state2")  # starts at batch 0 again
    rows = ingest.ingested_rows(spark, f"{folder}/out")
    assert [r.vol for r in rows.where("spot_num = 'a' AND hh = 1").collect()] == [77.0]
    assert rows.where("spot_num = 'a' AND hh = 2").count() == 1
    assert rows.where("spot_num = 'b'").collect() == before
