"""Landed files, writers and streams in fresh folders."""

import json
from datetime import date, datetime, timedelta
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from panelcast.plans import bronze
from panelcast.schemas import LOAD_ZONAL, MissingColumns
from panelcast.session import settle, shared_folder
from panelcast.sources import readers as rd
from panelcast.sources import sinks as sk
from panelcast.streaming.hourly import stream_hourly
from panelcast.streaming.upserts import stream_upsert

REPORT = """\\\\Hourly demand by zone
\\\\Created at 2024-01-05
\\\\MW
Date,Hour,Ontario Demand,East,West,Zone Total,Diff
2024-01-01,1,100,40,60,100,0
2024-01-01,24,110, 50 ,n/a,110,0
2024-01-02,2,120,50,70,120,0
2024-01-02,bad,1,1,1,1,1
not a date,3,1,1,1,1,1
"""


@pytest.fixture
def report(tmp_path):
    path = tmp_path / "2024.csv"
    path.write_text(REPORT)
    return str(path)


def test_report_rows_and_bad_lines(spark, report):
    rows = rd.read_report_csv(spark, report).orderBy("Date", "Hour").collect()
    assert [(r.Date, r.Hour) for r in rows] == [(date(2024, 1, 1), 1), (date(2024, 1, 1), 24), (date(2024, 1, 2), 2)]
    assert (rows[1].East, rows[1].West) == (50.0, None)
    clipped = rd.read_report_csv(spark, report, start=date(2024, 1, 2), end=date(2024, 1, 2))
    assert clipped.count() == 1


def test_several_reports_are_one_table(spark, tmp_path, report):
    (tmp_path / "2025.csv").write_text(REPORT.replace("2024-01-0", "2025-01-0"))
    assert rd.read_report_csv(spark, [report, str(tmp_path / "2025.csv")]).count() == 6


def test_feed_header_metadata_and_required_columns(spark, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text("\\\\Realtime\n\\\\Created 2024\n\\\\MW\nDate, Hour ,Interval, EAST\n2024-01-01,1,1,5\n2024-01-01,1,x,5\n")
    feed = rd.read_interval_feed(spark, str(path), ["Date", "Hour", "Interval", "EAST"])
    assert [tuple(r) for r in feed.collect()] == [(date(2024, 1, 1), 1, 1, 5.0)]
    assert rd.feed_metadata(spark, str(path)).count() == 3
    with pytest.raises(MissingColumns):
        rd.read_interval_feed(spark, str(path), ["WEST"])


def test_geojson_pages(spark, tmp_path):
    for page in (1, 2):
        body = {"features": [{"properties": {"UTC_DATE": f"2024-01-0{page}T05:00:00Z", "TEMP": "-3.5", "WIND_SPEED": "x"}}]}
        (tmp_path / f"p{page}.json").write_text(json.dumps(body, indent=2))
    rows = rd.read_geojson_features(spark, str(tmp_path), zone="East").orderBy("UTC_DATE").collect()
    assert [(r.ZONE, r.TEMP, r.WIND_SPEED) for r in rows] == [("East", -3.5, None)] * 2
    assert rows[0].UTC_DATE == datetime(2024, 1, 1, 5)


def test_parallel_arrays(spark, tmp_path):
    body = {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00", None], "temperature_2m": [1.0, None, 2.0]}}
    (tmp_path / "w.json").write_text(json.dumps(body, indent=1))
    rows = rd.read_columnar_json(spark, str(tmp_path), ["temperature_2m", "cloud_cover"]).orderBy("time").collect()
    assert [(r.temperature_2m, r.cloud_cover) for r in rows] == [(1.0, None), (None, None)]


def test_first_archive_wins(spark, tmp_path):
    (tmp_path / "a.csv").write_text("datetime,v\n2024-01-01 00:00:00,1\nbad,2\n2024-03-01 00:00:00,3\n")
    names = [str(tmp_path / "none.parquet"), str(tmp_path / "a.csv")]
    got = rd.read_first_available(spark, names, "datetime", end=datetime(2024, 2, 1))
    assert [r.v for r in got.collect()] == ["1"]
    with pytest.raises(FileNotFoundError):
        rd.read_first_available(spark, names[:1])


def test_report_to_bronze_twice_gives_one_row_per_key(spark, tmp_path, report):
    totals, zonal = str(tmp_path / "totals"), str(tmp_path / "zonal")
    rows = rd.read_report_csv(spark, report)
    for now in (datetime(2024, 1, 5), datetime(2024, 1, 6)):
        bronze.load_demand(spark, rows, now, totals, zonal)
    found = spark.read.parquet(zonal)
    assert sorted(r.zone for r in found.select("zone").distinct().collect()) == ["East", "Ontario", "West"]
    assert found.count() == found.select("zone", "datetime").distinct().count() == 8
    assert found.agg(F.min("ingestion_time")).first()[0] == datetime(2024, 1, 6)
    # hour 1 of a Toronto day starts at midnight local, five in UTC
    assert spark.read.parquet(totals).agg(F.min("datetime")).first()[0] == datetime(2024, 1, 1, 5)


def test_weather_gets_a_mean_zone(spark):
    rows = [("East", datetime(2024, 1, 1, 5), 1.0), ("West", datetime(2024, 1, 1, 5), 3.0), ("West", datetime(2024, 1, 1, 6), 7.0)]
    pages = spark.createDataFrame(rows, "ZONE string, UTC_DATE timestamp, TEMP double")
    for c in ("DEW_POINT_TEMP", "RELATIVE_HUMIDITY", "WIND_SPEED", "PRECIP_AMOUNT"):
        pages = pages.withColumn(c, F.lit(1.0))
    got = bronze.weather_table(pages.unionByName(pages), datetime(2024, 2, 1))
    mean = got.filter("zone = 'Ontario'").orderBy("datetime").collect()
    assert [r.temperature_c for r in mean] == [2.0, 7.0]
    assert mean[0].datetime_local == datetime(2024, 1, 1, 0)
    assert got.count() == 5


def test_upsert_touches_only_listed_columns_and_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    day = {"d": F.to_date("at")}
    rows = [(datetime(2024, 1, n), n, n * 10.0, "old") for n in (1, 2, 3)]
    base = spark.createDataFrame(rows, "at timestamp, k int, v double, note string")
    sk.upsert(spark, path, base, ["at", "k"], ["v"], day)
    before = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "t" / "d=2024-01-01").iterdir()}
    change = [(datetime(2024, 1, 2), 2, 99.0, "new"), (datetime(2024, 1, 9), 9, 1.0, "new")]
    source = spark.createDataFrame(change, base.schema)
    for _ in range(2):
        sk.upsert(spark, path, source, ["at", "k"], ["v"], day)
    got = {r.k: (r.v, r.note) for r in spark.read.parquet(path).collect()}
    assert got == {1: (10.0, "old"), 2: (99.0, "old"), 3: (30.0, "old"), 9: (1.0, "new")}
    after = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "t" / "d=2024-01-01").iterdir()}
    assert before == after


def _files(path) -> set[str]:
    return {str(f) for f in path.rglob("*.parquet")}


def test_upsert_leaves_files_without_its_keys_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.range(0, 1000, 1, 10).selectExpr("id AS k", "id * 1.0D AS v", "id % 2 AS part")
    sk.append_evolving(base, path, ["part"])
    before = _files(tmp_path / "t")
    assert len(before) == 20
    change = spark.createDataFrame([(105, -1.0, 1), (107, -2.0, 1), (5000, 9.0, 0)], "k long, v double, part long")
    fresh = change.withColumn("part", F.col("part"))
    held = sk.touched_files(spark, path, fresh, ["k"])
    assert len(held) == 1 and {urlparse(f).path for f in held} <= before
    sk.upsert(spark, path, change, "k", ["v"], {"part": F.col("k") % 2})
    assert before - _files(tmp_path / "t") == {urlparse(f).path for f in held}
    got = {r.k: (r.v, r.part) for r in spark.read.parquet(path).collect()}
    assert len(got) == 1001 and got[105] == (-1.0, 1) and got[107] == (-2.0, 1) and got[5000] == (9.0, 0) and got[106] == (106.0, 0)
    # keys of no file: nothing is rewritten; nothing to load: nothing changes
    before = _files(tmp_path / "t")
    sk.upsert(spark, path, spark.createDataFrame([(-3, 0.0, 1)], change.schema), "k", ["v"], {"part": F.col("k") % 2})
    assert before < _files(tmp_path / "t")
    before = _files(tmp_path / "t")
    sk.upsert(spark, path, change.limit(0), "k", ["v"], {"part": F.col("k") % 2})
    assert before == _files(tmp_path / "t")


def test_upsert_mends_a_load_that_was_lost_half_way(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sk.upsert(spark, path, spark.range(20).selectExpr("id AS k", "0.0D AS v"), "k", ["v"])
    change = spark.createDataFrame([(3, 1.0), (4, 2.0), (30, 3.0)], "k long, v double")
    monkeypatch.setattr(sk, "_remove", lambda *_: None)  # lost before the replaced files go
    sk.upsert(spark, path, change, "k", ["v"])
    assert spark.read.parquet(path).count() > 21
    monkeypatch.undo()
    sk.upsert(spark, path, change, "k", ["v"])
    got = {r.k: r.v for r in spark.read.parquet(path).collect()}
    assert spark.read.parquet(path).count() == len(got) == 21
    assert (got[3], got[4], got[30], got[5]) == (1.0, 2.0, 3.0, 0.0)


def test_upsert_moves_a_row_whose_directory_changes(spark, tmp_path):
    path, day = str(tmp_path / "t"), {"d": F.to_date("at")}
    schema = "k int, at timestamp, v double"
    sk.upsert(spark, path, spark.createDataFrame([(1, datetime(2024, 1, 1), 1.0), (2, datetime(2024, 1, 2), 2.0)], schema), "k", ["v"], day)
    sk.upsert(spark, path, spark.createDataFrame([(1, datetime(2024, 1, 5), 7.0)], schema), "k", ["v", "at"], day)
    assert sorted((r.k, str(r.d), r.v) for r in spark.read.parquet(path).collect()) == [(1, "2024-01-05", 7.0), (2, "2024-01-02", 2.0)]


@pytest.mark.parametrize("whole", [0, 60, 1 << 20])
def test_files_of_any_size_are_read_by_their_own_header(spark, tmp_path, monkeypatch, whole):
    texts = {
        "a.csv": "\\\\ Report\r\nDate,Hour,EAST\r\n2024-01-01,1,5\r\n2024-01-01,2,n/a\r\n",
        "b.csv": "Hour,WEST,Date\n" + "".join(f"{h},{h * 10},2024-01-02\n" for h in range(1, 9)),
        "c.csv": "Date , Hour , EAST , WEST\n2024-01-03,1,7,8",
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text, newline="")
    monkeypatch.setattr(rd._with_header, "__defaults__", (whole,))
    rows = {(str(r.Date), r.Hour): (r.EAST, r.WEST) for r in rd.read_report_csv(spark, str(tmp_path)).collect()}
    assert len(rows) == 11
    assert rows["2024-01-01", 1] == (5.0, None) and rows["2024-01-01", 2] == (None, None)
    assert rows["2024-01-02", 8] == (None, 80.0) and rows["2024-01-03", 1] == (7.0, 8.0)


def test_ordinary_report_files_meet_their_header_without_a_join(spark, report):
    plan = rd.read_report_csv(spark, report, columns=["Date", "Hour"])._jdf.queryExecution().optimizedPlan().toString()
    small = plan.split("Union")[1].split("Join")[0]
    assert "explode" in small and "Aggregate" not in small


def test_upsert_takes_the_last_of_repeated_source_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    source = spark.createDataFrame([(1, 1.0, 1), (1, 2.0, 2)], "k int, v double, seq int")
    sk.upsert(spark, path, source, ["k"], ["v", "seq"], order="seq")
    sk.upsert(spark, path, source.withColumn("v", F.col("v") * 10), ["k"], ["v", "seq"], order="seq")
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(1, 20.0, 2)]


def test_rerun_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    sk.write_partitioned(spark.range(10).selectExpr("id", "id % 2 AS p"), path, ["p"])
    sk.write_partitioned(spark.range(3).selectExpr("id + 100 AS id", "0L AS p"), path, ["p"], replace=False)
    assert spark.read.parquet(path).groupBy("p").count().orderBy("p").collect() == [(0, 3), (1, 5)]
    sk.write_partitioned(spark.range(4).selectExpr("id", "'x' AS extra"), path)
    assert spark.read.parquet(path).columns == ["id", "extra"]


def test_append_adds_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    sk.append_evolving(spark.range(1), path)
    sk.append_evolving(spark.range(1).withColumn("extra", F.lit(5)), path)
    assert sorted((r.extra or 0) for r in sk.read_evolving(spark, path).collect()) == [0, 5]


def test_catalog_table_is_made_once(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS panel_test LOCATION '{tmp_path}/db'")
    try:
        for _ in range(2):
            sk.ensure_table(spark, "panel_test.zonal", LOAD_ZONAL, ["zone"], comment="it's raw")
        assert set(spark.table("panel_test.zonal").columns) == set(LOAD_ZONAL.fieldNames())
    finally:
        spark.sql("DROP DATABASE panel_test CASCADE")


def test_exports(spark, tmp_path):
    table = spark.createDataFrame([("a", 1.5)], "k string, v double")
    sk.export_metrics(table, str(tmp_path / "c"), "csv")
    sk.export_metrics(table, str(tmp_path / "j"), "json")
    assert spark.read.csv(str(tmp_path / "c"), header=True, inferSchema=True).collect() == table.collect()
    assert spark.read.schema(table.schema).json(str(tmp_path / "j")).collect() == table.collect()
    with pytest.raises(ValueError):
        sk.export_metrics(table, str(tmp_path / "x"), "xml")


def test_settled_rows_are_read_from_the_shared_folder(spark):
    out = settle(spark.range(5).withColumn("v", F.lit(None).cast("double")))
    assert out.count() == 5 and out.schema["v"].dataType.simpleString() == "double"
    folder = shared_folder(spark).split(":")[-1].strip("/")
    assert all(folder in f for f in out.inputFiles())


def _intervals(hours, skip=()):
    start = datetime(2024, 1, 1)
    rows = []
    for h in range(hours):
        for i in range(1, 13):
            if (h, i) not in skip:
                rows.append(("a", start + timedelta(hours=h), i, float(h + i)))
    return rows


SCHEMA = "zone string, timestamp timestamp, interval int, demand_mw double"


def _run_stream(spark, base, parts):
    out = None
    for n, rows in enumerate(parts):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
        feed = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
        query = (
            stream_hourly(feed, watermark="1 hour")
            .writeStream.outputMode("append")
            .option("checkpointLocation", f"{base}/state")
            .trigger(availableNow=True)
            .format("parquet")
            .start(f"{base}/out")
        )
        query.awaitTermination()
        out = spark.read.parquet(f"{base}/out")
    return sorted((r.datetime.hour, r.interval_count, r.demand_mw) for r in out.collect())


def test_stream_emits_complete_hours_once_the_watermark_passes(spark, tmp_path):
    rows = _intervals(6, skip={(1, 5)})
    cut = [r for r in rows if r[1].hour < 3], [r for r in rows if r[1].hour >= 3]
    got = _run_stream(spark, str(tmp_path), cut)
    # the newest time is 05:00, so hours that end by 04:00 are final; hour 1 lacks an interval
    assert got == [(0, 12, 6.5), (2, 12, 8.5), (3, 12, 9.5)]


def test_repeated_interval_does_not_complete_an_hour(spark, tmp_path):
    rows = _intervals(6, skip={(0, 12)}) + [("a", datetime(2024, 1, 1), 11, 1.0)]
    assert 0 not in [h for h, *_ in _run_stream(spark, str(tmp_path), [rows])]


def test_stream_upsert_is_idempotent(spark, tmp_path):
    base = str(tmp_path)
    first = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    first.write.parquet(f"{base}/in")
    for state in ("s1", "s2"):  # the second state replays everything
        feed = spark.readStream.schema(first.schema).parquet(f"{base}/in")
        stream_upsert(feed, f"{base}/t", "k", ["v"], f"{base}/{state}").trigger(availableNow=True).start().awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(f"{base}/t").collect())) == [(1, 1.0), (2, 2.0)]
