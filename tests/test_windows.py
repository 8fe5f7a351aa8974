"""Blocked windows give what plain windows give, on gappy and skewed panels."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from frames import gappy_panel, series
from panelcast.operators import blocks as bl
from panelcast.operators import series as sr
from panelcast.operators import windows as wn



def whole():
    """The plain window over a whole series."""
    return Window.partitionBy("zone").orderBy("datetime")


@pytest.fixture(scope="module")
def panel(spark):
    return gappy_panel(spark).cache()


def same(a, b):
    columns = a.columns
    b = b.select(*columns)
    assert a.count() == b.count()
    rounded = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in a.dtypes]
    left, right = a.select(*rounded), b.select(*rounded)
    assert left.exceptAll(right).isEmpty()
    assert right.exceptAll(left).isEmpty()


def test_row_numbers_match_one_window(panel):
    plain = panel.withColumn("_rn", (F.row_number().over(whole()) - 1).cast("bigint"))
    same(plain, bl.number_rows(panel, "zone", "datetime", cell=2 * bl.DAY).drop("_t"))


@pytest.mark.parametrize("width_days", [1, 3, 28])
def test_checked_lags(panel, width_days):
    lags = [1, 3, 24]
    plain = panel.withColumns(
        {f"demand_lag_{n}h": wn.checked_shift("datetime", "y", n, whole()) for n in lags}
    )
    same(plain, wn.lag_checked(panel, "zone", "datetime", "y", lags, width=width_days * bl.DAY))


def test_checked_lead(panel):
    plain = panel.withColumn("ahead", wn.checked_shift("datetime", "y", -24, whole()))
    same(plain, wn.lead_checked(panel, "zone", "datetime", {"y": "ahead"}, 24, width=2 * bl.DAY))


@pytest.mark.parametrize("rows", [16, 100, 5000])
def test_rolling_windows(panel, rows):
    funcs = ("mean", "min", "max", "std")
    plain = panel.withColumns(wn.rolling_columns(whole(), "y", "r", [3, 72], funcs, False))
    same(plain, wn.rolling_past(panel, "zone", "datetime", "y", [3, 72], funcs, "r", rows=rows))
    plain = panel.withColumns(wn.rolling_columns(whole(), "y", "r", [3, 72], funcs, True))
    same(plain, wn.rolling_trailing(panel, "zone", "datetime", "y", [3, 72], funcs, "r", rows=rows))


def test_positional_lag(panel):
    plain = panel.withColumns({f"t_{n}h": F.lag("t", n).over(whole()) for n in (1, 40)})
    same(plain, wn.lag_rows(panel, "zone", "datetime", {"t": "t"}, [1, 40], rows=25))


def test_exact_lag_is_a_lookup_by_time(panel):
    earlier = panel.select("zone", (F.col("datetime") + F.expr("INTERVAL 24 HOURS")).alias("datetime"), F.col("y").alias("lag_exact_24h"))
    plain = panel.join(earlier, ["zone", "datetime"], "left").select(*panel.columns, "lag_exact_24h")
    same(plain, wn.lag_exact(panel, "zone", "datetime", "y", [24], width=2 * bl.DAY))


def test_checked_and_exact_lag_agree_without_gaps(spark):
    full = series(spark, [float(i * i % 37) for i in range(200)])
    checked = wn.lag_checked(full, "zone", "datetime", "y", [24], stem="l", width=bl.DAY)
    same(checked, wn.lag_exact(full, "zone", "datetime", "y", [24], stem="l", width=bl.DAY))


def test_lag_across_a_gap_is_null(spark):
    holed = series(spark, [1.0, 2.0, 3.0, 4.0]).filter("y <> 3")
    found = {r.y: r.demand_lag_1h for r in wn.lag_checked(holed, "zone", "datetime", "y", [1]).collect()}
    assert found == {1.0: None, 2.0: 1.0, 4.0: None}


def test_start_of_series_is_partial_and_std_of_one_row_is_null(spark):
    out = wn.rolling_past(series(spark, [1.0, 2.0, 6.0]), "zone", "datetime", "y", [3], ("mean", "std"), "r")
    rows = [(r.r_mean_3h, r.r_std_3h) for r in out.orderBy("datetime").collect()]
    assert rows[0] == (None, None)
    assert rows[1] == (1.0, None)
    assert rows[2][0] == 1.5


def test_rolling_sum_counts_missing_as_zero(spark):
    out = wn.rolling_sum0(series(spark, [1.0, None, 2.0]), "zone", "datetime", "y", [2], "s")
    assert [r.s_sum_2h for r in out.orderBy("datetime").collect()] == [1.0, 1.0, 2.0]


def test_zscore_of_a_constant_series_is_null(spark):
    both = series(spark, [5.0, 5.0], "flat").unionByName(series(spark, [1.0, 3.0], "moving"))
    found = {(r.zone, r.y): r.demand_normalized for r in wn.zscore(both, "zone", "y").collect()}
    assert found[("flat", 5.0)] is None
    assert found[("moving", 3.0)] == pytest.approx(2**-0.5)


def test_rows_without_a_time_are_kept(spark):
    rows = [("a", None, 1.0), ("a", None, 2.0)]
    df = spark.createDataFrame(rows, "zone string, datetime timestamp, y double")
    assert wn.lag_checked(df, "zone", "datetime", "y", [1]).count() == 2


def test_hot_series_spreads_over_blocks(panel):
    """The window runs per block; no block holds more than a block and its halo."""
    cut = bl._spread(bl.number_rows(panel, "zone", "datetime"), F.col("_rn"), 100, 24, 0)
    sizes = cut.groupBy("zone", "_block").count()
    assert sizes.filter("zone = 'hot'").count() > 10
    assert sizes.agg(F.max("count")).first()[0] <= 124


def test_interpolation_fills_two_hours_of_any_inner_gap(spark):
    df = series(spark, [1.0, None, None, None, None, 6.0, None])
    out = sr.interpolate_linear(df, "zone", "datetime", "y")
    assert [r.y for r in out.orderBy("datetime").collect()] == [1.0, 2.0, 3.0, None, None, 6.0, None]


def test_interpolation_across_blocks(spark):
    values = [0.0, *[None] * 60, 61.0]
    out = sr.interpolate_linear(series(spark, values), "zone", "datetime", "y", limit=50, width=bl.DAY)
    got = [r.y for r in out.orderBy("datetime").collect()]
    assert got[:51] == pytest.approx([float(i) for i in range(51)])
    assert got[51:61] == [None] * 10


def test_grid_holds_every_hour(spark):
    holed = series(spark, [float(i) for i in range(80)]).filter("y not in (5, 6, 70)")
    grid = sr.regularize(holed, "zone", "datetime", width=bl.DAY)
    assert grid.count() == 80
    assert grid.filter("y is null").count() == 3
