"""Guards, reports and metrics on hand-made rows."""

import math

import pytest
from pyspark.sql import functions as F

from frames import series
from panelcast.functions import scalars as sc
from panelcast.operators import aggregate as ag
from panelcast.operators.gram import gram
from panelcast.operators import evaluation as ev
from panelcast.operators import projection as pr
from panelcast.operators import quality as q
from panelcast.schemas import MissingColumns, require_columns


def pairs(spark, rows):
    return spark.createDataFrame(rows, "y double, p double")


def test_metrics_by_hand(spark):
    row = ev.metrics(pairs(spark, [(10.0, 12.0), (20.0, 18.0), (0.0, 1.0)]), "y", "p").first()
    assert row.observations == 3
    assert row.mae == pytest.approx(5 / 3)
    assert row.rmse == pytest.approx(math.sqrt(3.0))
    assert row.mape == pytest.approx(15.0)
    assert row.wape == pytest.approx(5 / 30 * 100)
    assert row.bias == pytest.approx(1 / 3)
    assert row.r2 == pytest.approx(1 - 9 / 200)


def test_metrics_of_no_one_or_flat_rows(spark):
    nothing = ev.metrics(pairs(spark, [(None, 1.0), (float("nan"), 2.0), (float("inf"), 1.0)]), "y", "p").first()
    assert nothing.observations == 0 and nothing.mae is None
    assert ev.metrics(pairs(spark, [(1.0, 1.0)]), "y", "p").first().r2 is None
    assert ev.metrics(pairs(spark, [(2.0, 2.0), (2.0, 2.0)]), "y", "p").first().r2 == 1.0
    assert ev.metrics(pairs(spark, [(2.0, 3.0), (2.0, 2.0)]), "y", "p").first().r2 == 0.0
    zero = ev.metrics(pairs(spark, [(0.0, 0.0)]), "y", "p").first()
    assert zero.mape is None and zero.smape is None and zero.wape is None


def test_full_metrics_count_a_zero_actual_as_outside(spark):
    row = ev.metrics_full(pairs(spark, [(0.0, 1.0), (100.0, 100.5)]), "y", "p").first()
    assert row.coverage_1pct == 50.0
    assert row.error_q50 == 0.75


def test_pinball_and_coverage(spark):
    df = spark.createDataFrame([(10.0, 8.0, 12.0), (20.0, 21.0, 25.0)], "y double, lo double, hi double")
    losses = ev.pinball(df, "y", {"lo": 0.1, "hi": 0.9}).first()
    assert losses.pinball_lo == pytest.approx((0.1 * 2 + 0.9 * 1) / 2)
    band = ev.interval_coverage(df, "y", "lo", "hi").first()
    assert band.coverage_pct == 50.0 and band.mean_width == 4.0


def test_reconciled_total_is_the_sum_of_the_zones(spark):
    rows = [("a", 1, 2, 10.0, 11.0), ("b", 1, 2, 5.0, 4.0), ("All", 1, 2, 16.0, 15.5)]
    df = spark.createDataFrame(rows, "zone string, issue_datetime int, target_datetime int, y double, p double")
    both = ev.reconcile_bottom_up(df, "y", "p", "All")
    row = both.first()
    assert (row.bottomup_actual_mw, row.bottomup_predicted_mw) == (15.0, 15.0)
    assert ev.coherence(both).first().coherence_gap_mw == 1.0


def test_verdicts(spark):
    df = spark.createDataFrame(
        [("24h", 1.9, 0.4), ("24h", 2.2, -0.9), ("7d", 4.0, 1.0)], "model_type string, mape double, bias_pct double"
    )
    got = [(r.verdict, r.bias_class) for r in ev.verdict(df).orderBy("mape").collect()]
    assert got == [("excellent", "negligible"), ("acceptable", "slight"), ("insufficient", "significant")]


def test_missing_temperature_reads_as_zero_degree_hours(spark):
    df = spark.createDataFrame([(None,), (10.0,), (25.0,)], "t double")
    got = df.select(sc.hdd("t"), sc.cdd("t"), sc.hdd("t", null_safe=True)).collect()
    assert [tuple(r) for r in got] == [(0.0, 0.0, None), (8.0, 0.0, 8.0), (0.0, 7.0, 0.0)]


def test_relative_change_guards_its_base(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, 4.0), (5.0, 1e-7)], "a double, b double")
    got = df.select(sc.pct_change("a", "b"), sc.pct_change("a", "b", 100.0, 1e-6), sc.safe_ratio("a", "b")).collect()
    assert tuple(got[0]) == (None, None, None)
    assert tuple(got[1]) == (0.25, 25.0, 1.25)
    assert got[2][1] is None and got[2][0] is not None


def test_wet_bulb_at_a_published_point(spark):
    got = spark.createDataFrame([(20.0, 50.0)], "t double, rh double").select(sc.wet_bulb("t", "rh")).first()[0]
    assert got == pytest.approx(13.7, abs=0.05)


def test_bad_text_becomes_null(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "v string")
    assert [r.v for r in pr.coerce_numeric(df, ["v"]).collect()] == [1.5, None, None]


def test_strict_labels_fail_the_job(spark):
    df = spark.createDataFrame([(" EAST ",), ("WEST",)], "zone string")
    assert [r.zone for r in pr.map_labels(df, "zone", {"EAST": "East"}).collect()] == ["East", "WEST"]
    with pytest.raises(Exception, match="no label for WEST"):
        pr.map_labels(df, "zone", {"EAST": "East"}, strict=True).collect()


def test_aggregate_zones_are_left_out_in_any_case(spark):
    names = ["Diff", "ZONE TOTAL", "zone_total", "Market", "total", "East", "Totals"]
    df = spark.createDataFrame([(n,) for n in names], "zone string")
    assert sorted(r.zone for r in pr.exclude_aggregates(df).collect()) == ["East", "Totals"]


def test_missing_columns_raise(spark):
    with pytest.raises(MissingColumns, match="b"):
        require_columns(spark.range(1), ["id", "b"])
    with pytest.raises(MissingColumns):
        pr.select_ordered(spark.range(1), ["nope"])


def test_duplicates(spark):
    rows = [("a", 1, None, "x"), ("a", 2, 5.0, None), ("b", 1, 7.0, "y")]
    df = spark.createDataFrame(rows, "k string, seq int, v double, s string")
    merged = {r.k: (r.v, r.s) for r in q.coalesce_duplicates(df, "k", "seq").collect()}
    assert merged == {"a": (5.0, "x"), "b": (7.0, "y")}
    assert [r.k for r in q.duplicate_keys(df, "k").collect()] == ["a"]
    with pytest.raises(ValueError, match="duplicate"):
        q.require_unique(df, "k")
    assert q.require_unique(df, ["k", "seq"]) is df
    assert q.dedup_any(df, "k").count() == 2


def test_bounds_can_fail_the_job(spark):
    df = spark.createDataFrame([(1, 1), (25, 13)], "hour int, interval int")
    assert tuple(q.check_bounds(df).first()) == (2, 1, 1)
    with pytest.raises(Exception, match="out of range"):
        q.check_bounds(df, strict=True).collect()


def test_gap_is_flagged_after_the_hole(spark):
    df = series(spark, [1.0, 2.0, 3.0, 4.0]).filter("y <> 2")
    assert [r.is_gap for r in q.gaps(df, "zone", "datetime").orderBy("datetime").collect()] == [0, 1, 0]


def test_weighted_zone_renormalises_and_weighted_sum_does_not(spark):
    rows = [("a", 1, 10.0), ("b", 1, None), ("a", 2, 10.0), ("b", 2, 20.0), ("c", 2, 99.0)]
    df = spark.createDataFrame(rows, "zone string, t int, v double")
    weights = {"a": 0.25, "b": 0.75}
    mean = {r.t: r.v for r in ag.weighted_zone(df, "t", ["v"], weights, "All").collect()}
    total = {r.t: r.weighted_v for r in ag.weighted_sum(df, "t", ["v"], weights).collect()}
    assert mean == {1: 10.0, 2: 17.5}
    assert total == {1: None, 2: 17.5}


def test_reference_zone_weights_sum_to_one(spark):
    row = ag.check_weights(ag.zone_dimension(spark)).first()
    assert row.is_valid == 1 and row.total_weight == pytest.approx(1.0)
    assert 43 < row.latitude < 46 and -82 < row.longitude < -76


def test_samples_repeat(spark):
    df = spark.range(5000)
    one, two = ag.sample(df, 0.2, "id"), ag.sample(df.repartition(13), 0.2, "id")
    assert one.exceptAll(two).isEmpty() and 900 < one.count() < 1100
    assert ag.sample_n(df, 7, "id").collect() == ag.sample_n(df.repartition(5), 7, "id").collect()


@pytest.mark.parametrize("block", [1, 3, 12])
def test_collinear_pairs_do_not_depend_on_blocks(spark, monkeypatch, block):
    df = spark.range(200).selectExpr("id AS a", "id * 2 + id % 3 AS b", "id % 7 AS c", "-id AS d")
    monkeypatch.setattr(ag, "gram", lambda rows, names: gram(rows, names, block=block))
    pairs = {(r.feature_1, r.feature_2): r.correlation for r in ag.collinear_pairs(df, ["a", "b", "c", "d"]).collect()}
    exact = df.selectExpr("abs(corr(a, b)) AS ab", "abs(corr(b, d)) AS bd").first()
    assert set(pairs) == {("a", "b"), ("a", "d"), ("b", "d")}
    assert (pairs["a", "b"], pairs["a", "d"], pairs["b", "d"]) == pytest.approx((exact.ab, 1.0, exact.bd))
