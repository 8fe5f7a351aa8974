"""Whole jobs and models: properties that hold whatever the numbers are."""

from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from frames import START, gappy_panel
from panelcast.operators import modelling as ml
from panelcast.operators import recursive, trees
from panelcast.operators import splits as sp
from panelcast.operators.joins import attach, expand_horizons, join_target
from panelcast.operators.series import demand_features_at
from panelcast.operators.windows import lag_exact
from panelcast.plans import gold
from panelcast.plans.monitoring import append_evaluation, evaluation_tables
from panelcast.plans.panels import Tables, forecast_panel, hourly_panel


@pytest.fixture(scope="module")
def weather_panel(spark):
    base = gappy_panel(spark, days=25).na.drop()
    return base.select(
        "zone", "datetime", F.col("y").alias("demand_mw"), F.col("t").alias("temperature_c"),
        (F.col("t") - 3).alias("dew_point_c"), (F.abs("t") * 3).alias("relative_humidity_pct"),
        F.abs("y").alias("wind_speed_kmh"), F.greatest("t", F.lit(0.0)).alias("precipitation_mm"),
    ).cache()


def test_expansion_equals_expand_and_join(spark, weather_panel):
    names = {"demand_mw": "target_demand_mw", "temperature_c": "weather_target_temperature_c"}
    slim = weather_panel.select("zone", "datetime", "demand_mw", "temperature_c")
    joined = join_target(expand_horizons(slim, "datetime", 1, 48), slim, names)
    gathered = gold.expand_with_targets(slim, names, 1, 48, width=4 * 24 * 3600).select(*joined.columns)
    assert gathered.count() == slim.count() * 48
    assert gathered.exceptAll(joined).isEmpty() and joined.exceptAll(gathered).isEmpty()


def test_small_blocks_do_not_change_the_feature_tables(weather_panel):
    for build in (gold.features_24h, lambda p, **k: gold.features_7d(p, hi=3, **k)):
        wide, narrow = build(weather_panel), build(weather_panel, rows=400)
        rounded = [F.round(c, 8).alias(c) if k == "double" else F.col(c) for c, k in wide.dtypes]
        assert wide.select(*rounded).exceptAll(narrow.select(*rounded)).isEmpty()


def test_feature_tables_have_their_columns(weather_panel):
    day, week = gold.features_24h(weather_panel), gold.features_7d(weather_panel, hi=2)
    assert len(gold.FEATURES_24H) == 157
    assert set(gold.FEATURES_24H) <= set(day.columns)
    assert {"forecast_horizon_sqrt", "forecast_horizon_log1p"} <= set(week.columns)
    assert len(day.columns) == len(set(day.columns))


def test_repeated_keys_are_merged_before_the_windows(weather_panel):
    stamped = weather_panel.withColumn("ingestion_time", F.lit(1))
    again = stamped.withColumns({"demand_mw": F.col("demand_mw") + 5, "ingestion_time": F.lit(2)})
    clean = gold.clean_panel(stamped.unionByName(again), order="ingestion_time")
    assert clean.exceptAll(gold.clean_panel(weather_panel)).isEmpty()


def test_local_time_zone_moves_the_calendar(weather_panel):
    utc = gold.features_24h(weather_panel).select("zone", "issue_datetime", F.col("issue_hour").alias("u"))
    local = gold.features_24h(weather_panel, tz="America/Toronto").select("zone", "issue_datetime", "issue_hour")
    off = utc.join(local, ["zone", "issue_datetime"]).select(F.pmod(F.col("u") - F.col("issue_hour"), F.lit(24)))
    assert [r[0] for r in off.distinct().collect()] == [5]


def test_attach_keeps_every_row_of_a_hot_key(spark):
    rows = spark.range(3000).selectExpr("CASE WHEN id % 3 > 0 THEN 'hot' WHEN id % 2 = 0 THEN 'cold' END AS k", "7 AS same")
    stats = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
    out = attach(rows, stats, "k")
    assert out.count() == 3000
    assert {(r.k, r.v) for r in out.distinct().collect()} == {("hot", 1), ("cold", 2), (None, None)}


@pytest.fixture(scope="module")
def training(spark, small):
    rows = forecast_panel(Tables(spark, small).events).dropna(subset=["prediction_mw"])
    return rows.withColumnsRenamed({"prediction_mw": "naive"}).cache()


def test_contributions_add_up_to_the_prediction(training):
    rows = training.dropna()
    model = ml.fit_point(rows, ["naive", "lag_168_mw"], "target_demand_mw", "linear", regParam=0.0)
    coefficients, intercept = ml.linear_parts(model)
    keys = ["zone", "issue_datetime", "target_datetime"]
    parts = ml.contributions(rows, coefficients, intercept, ids=keys)
    total = parts.groupBy(*keys).agg((F.sum("shap_value") + F.max("base_value")).alias("total"))
    gap = ml.predict(model, rows).join(total, keys).select(F.max(F.abs(F.col("total") - F.col("prediction_mw"))))
    assert gap.first()[0] < 1e-6


def test_boosted_model_survives_missing_inputs_and_new_zones(spark, training):
    model = ml.fit_point(training.withColumn("void", F.lit(None).cast("double")), ["zone", "naive", "lag_168_mw", "void"], "target_demand_mw", maxIter=2, maxDepth=2)
    assert "void" not in ml.model_inputs(model)
    fresh = training.limit(5).withColumns({"zone": F.lit("new"), "naive": F.lit(None).cast("double"), "void": F.lit(None).cast("double")})
    assert ml.predict(model, fresh).filter("prediction_mw is null").count() == 0
    shares = ml.feature_importance(model, training).toPandas()
    assert shares["gain_pct"].sum() == pytest.approx(100.0)


def test_splits_do_not_leak(spark):
    rows = [("z", START + timedelta(hours=6 * i)) for i in range(4 * 200)]
    df = spark.createDataFrame(rows, "zone string, issue_datetime timestamp")
    df = df.withColumn("target_datetime", F.col("issue_datetime") + F.expr("INTERVAL 48 HOURS"))
    split = sp.require_no_leak(sp.purged_split(df))
    assert {r.split for r in split.select("split").distinct().collect()} == {"train", "validation", "test"}
    with pytest.raises(ValueError, match="empty"):
        sp.require_no_leak(sp.purged_split(df.filter(F.col("issue_datetime") < F.lit(START + timedelta(days=20)))))


def test_folds_tile_the_end_of_the_data(spark):
    rows = [("z", START + timedelta(days=i)) for i in range(200)]
    df = spark.createDataFrame(rows, "zone string, issue_datetime timestamp")
    table = sp.walk_forward_folds(df).orderBy("fold").collect()
    assert [r.test_rows for r in table] == [30] * 5
    assert table[-1].test_end == START + timedelta(days=199)
    assert all(a.test_end == b.test_start for a, b in zip(table, table[1:]))
    assert table[0].train_rows == 199 - 150


def test_purged_backtest_trains_on_less(spark):
    rows = [("z", START + timedelta(days=i), float(i), float(i % 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "zone string, issue_datetime timestamp, y double, x double")
    df = df.withColumn("target_datetime", F.col("issue_datetime") + F.expr("INTERVAL 10 DAYS"))
    seen = {True: [], False: []}

    def fit(purge):
        def inner(train):
            seen[purge].append(train.count())
            return ml.fit_point(train, ["x"], "y", "linear")

        return inner

    for purge in (True, False):
        assert ml.backtest(df, fit(purge), k=2, purge=purge).count() == 60
    assert [a - b for a, b in zip(seen[False], seen[True])] == [10, 10]


def test_recursive_scoring_matches_a_plain_loop(spark):
    values = [50.0 + (i * 7 % 24) for i in range(400)]
    at = [START + timedelta(hours=i) for i in range(400)]
    history = spark.createDataFrame([("a", t, v) for t, v in zip(at, values)], "zone string, datetime timestamp, demand_mw double")
    ref = at[-1]
    ahead = [ref + timedelta(hours=i) for i in range(1, 40)]
    targets = spark.createDataFrame([("a", t, 2.0) for t in ahead], "zone string, target_datetime timestamp, heat double")
    weights = {"demand_lag_1h": 0.5, "demand_rolling_mean_3h": 0.4, "heat": 1.0}
    got = recursive.score_recursive(weights, 3.0, history, targets, ref).orderBy("target_datetime").collect()
    series = pd.Series(values, index=pd.DatetimeIndex(at))
    for t in ahead[:24]:
        now = pd.Timestamp(t) - pd.Timedelta(hours=1)
        mean3 = series.loc[now - pd.Timedelta(hours=2) : now].mean()
        series.loc[pd.Timestamp(t)] = 3.0 + 0.5 * series[now - pd.Timedelta(hours=1)] + 0.4 * mean3 + 2.0
    assert len(got) == 24
    assert [r.predicted_demand_mw for r in got] == pytest.approx([series[pd.Timestamp(r.target_datetime)] for r in got])


def test_direct_scoring_needs_every_input(spark):
    rows = [("a", START + timedelta(hours=i), float(i), float(i)) for i in range(50)]
    history = spark.createDataFrame(rows, "zone string, datetime timestamp, y double, x double")
    model = ml.fit_point(history, ["x"], "y", "linear")
    targets = history.select("zone", F.col("datetime").alias("target_datetime"))
    with pytest.raises(ValueError, match="missing features: x"):
        ml.score_direct(model, targets, targets.select("zone").distinct(), START)


def test_features_at_a_time_equal_window_features_of_that_row(spark, weather_panel):
    full = weather_panel.filter("zone = 'hot'")
    ref = full.agg(F.max("datetime")).first()[0]
    at = demand_features_at(full, "zone", "datetime", "demand_mw", ref).first()
    row = lag_exact(full, "zone", "datetime", "demand_mw", [1, 24, 168], stem="l").filter(F.col("datetime") == F.lit(ref)).first()
    assert (at.demand_lag_1h, at.demand_lag_24h, at.demand_lag_168h) == (row.l_1h, row.l_24h, row.l_168h)


def test_evaluation_tables_append(spark, small, tmp_path):
    rows = forecast_panel(Tables(spark, small).events).filter("forecast_horizon_hours in (1, 24)")
    for run in ("r1", "r2"):
        append_evaluation(evaluation_tables(rows, "7d", run, datetime(2024, 2, 1)), str(tmp_path))
    names = {p.name for p in tmp_path.iterdir()}
    assert names == {
        "model_performance_global", "model_performance_by_zone", "model_performance_by_time",
        "model_performance_by_horizon", "model_error_distribution", "model_predictions_sample",
    }
    table = spark.read.parquet(str(tmp_path / "model_performance_global"))
    assert sorted(r.model_run_id for r in table.collect()) == ["r1", "r2"]


def test_heavy_windows_keep_their_task_count(spark, small):
    """Small inputs are not merged into one task before the rows multiply."""
    panel = hourly_panel(Tables(spark, small).events)
    gathered = gold.expand_with_targets(panel.select("zone", "datetime", "demand_mw"), {"demand_mw": "target"}, 1, 5)
    assert "REPARTITION_BY_NUM" in gathered._jdf.queryExecution().executedPlan().toString()


def test_recursive_steps_of_a_linear_model_equal_the_fold(spark):
    at = [START + timedelta(hours=i) for i in range(400)]
    rows = [(z, t, 50.0 + (i * k % 24)) for z, k in (("a", 7), ("b", 5)) for i, t in enumerate(at)]
    history = spark.createDataFrame(rows, "zone string, datetime timestamp, demand_mw double")
    ref = at[-1]
    # series b lacks one hour
    ahead = [(z, ref + timedelta(hours=i), float(i)) for z in "ab" for i in range(1, 9) if (z, i) != ("b", 3)]
    targets = spark.createDataFrame(ahead, "zone string, target_datetime timestamp, heat double")
    train = history.selectExpr("zone", "demand_mw AS demand_lag_1h", "demand_mw % 5 AS heat", "demand_mw * 0.9 + (demand_mw % 5) AS y")
    model = ml.fit_point(train, ["demand_lag_1h", "heat"], "y", "linear")
    weights, base = ml.linear_parts(model)
    fold = recursive.score_recursive(weights, base, history, targets, ref, hours=8).collect()
    steps = recursive.score_recursive_model(model, ["demand_lag_1h", "heat"], history, targets, ref, hours=8, settle_every=3).collect()
    as_dict = lambda found: {(r.zone, r.target_datetime): r.predicted_demand_mw for r in found}
    assert len(fold) == len(ahead)
    for place, value in as_dict(fold).items():
        if place[0] == "a" or place[1] < ref + timedelta(hours=4):  # after a gap an unknown lag is filled by each in its way
            assert as_dict(steps)[place] == pytest.approx(value)
    assert {(z, t) for z, t, _ in ahead} == set(as_dict(steps))


def test_first_recursive_hour_of_trees_equals_a_plain_prediction(spark):
    at = [START + timedelta(hours=i) for i in range(400)]
    history = spark.createDataFrame([("a", t, 50.0 + (i * 7 % 24)) for i, t in enumerate(at)], "zone string, datetime timestamp, demand_mw double")
    ref = at[-1]
    targets = spark.createDataFrame([("a", ref + timedelta(hours=i)) for i in range(1, 4)], "zone string, target_datetime timestamp")
    train = history.selectExpr("demand_mw AS demand_lag_1h", "demand_mw + 1 AS demand_rolling_max_3h", "demand_mw * 2 AS y")
    model = ml.fit_point(train, ["demand_lag_1h", "demand_rolling_max_3h"], "y", "gbt", maxIter=3, maxDepth=2)
    got = recursive.score_recursive_model(model, ["demand_lag_1h", "demand_rolling_max_3h"], history, targets, ref, hours=3)
    first = {r.target_datetime: r.predicted_demand_mw for r in got.collect()}[ref + timedelta(hours=1)]
    values = [r.demand_mw for r in history.orderBy("datetime").collect()]
    row = spark.createDataFrame([(values[-2], max(values[-3:]))], "demand_lag_1h double, demand_rolling_max_3h double")
    assert first == pytest.approx(ml.predict(model, row).first().prediction_mw)


def test_trees_as_expressions_predict_like_the_pipeline(spark):
    rows = [(["x", "y", "z"][i % 3], float(i % 17), float(i % 5) if i % 7 else None, float((i % 17) * 3 + (i % 5) + 10 * (i % 3))) for i in range(300)]
    df = spark.createDataFrame(rows, "zone string, a double, b double, target double")
    model = ml.fit_point(df, ["zone", "a", "b"], "target", "gbt", maxIter=4, maxDepth=3)
    forest = trees.forest_of(model)
    assert len(forest.trees) == 4 and set(forest.inputs()) <= {"zone", "a", "b"}
    more = df.union(spark.createDataFrame([("new", 3.0, None, 0.0), (None, float("nan"), 2.0, 0.0)], df.schema))
    scored = model.transform(more).withColumn("own", forest.prediction(lambda n: forest.input(n, F.col(n))))
    assert scored.agg(F.max(F.abs(F.col("own") - F.col("prediction_mw")))).first()[0] < 1e-9
    assert scored.where("own IS NULL").count() == 0


def test_recursive_trees_in_one_expression_equal_the_steps(spark):
    start = datetime(2024, 1, 1)
    history = spark.createDataFrame([("z", start + timedelta(hours=h), 100.0 + (h * 37) % 50) for h in range(200)], "zone string, datetime timestamp, demand_mw double")
    ref = start + timedelta(hours=199)
    targets = spark.createDataFrame([("z", ref + timedelta(hours=h), float(h % 3)) for h in range(1, 7)], "zone string, target_datetime timestamp, heat double")
    known = spark.createDataFrame([("z", 100.0 + i % 50, 150.0 - i % 9, float(i % 3), 90.0 + (i * 7) % 60) for i in range(200)], "zone string, demand_lag_1h double, demand_rolling_max_3h double, heat double, target double")
    inputs = ["zone", "demand_lag_1h", "demand_rolling_max_3h", "heat"]
    model = ml.fit_point(known, inputs, "target", "gbt", maxIter=3, maxDepth=3)
    fold = recursive.score_recursive_trees(trees.forest_of(model), history, targets, ref, hours=6).orderBy("target_datetime").collect()
    steps = recursive.score_recursive_model(model, inputs, history, targets, ref, hours=6).orderBy("target_datetime").collect()
    assert len(fold) == 6
    assert [r.predicted_demand_mw for r in fold] == pytest.approx([r.predicted_demand_mw for r in steps])


def test_targets_of_a_five_minute_panel_gather_a_bounded_list(spark, monkeypatch):
    start = datetime(2024, 1, 1)
    rows = [("z", start + timedelta(minutes=5 * i), float(i)) for i in range(12 * 30)]
    panel = spark.createDataFrame(rows, "zone string, datetime timestamp, demand_mw double")
    longest = []

    def gather(*args, real=gold.over_time_blocks, **options):
        out = real(*args, **options)
        longest.append(out.agg(F.max(F.size("_coming"))).first()[0])
        return out

    monkeypatch.setattr(gold, "over_time_blocks", gather)
    out = gold.expand_with_targets(panel, {"demand_mw": "ahead"}, hi=24)
    assert longest == [24]
    assert out.columns == ["zone", "datetime", "demand_mw", "forecast_horizon_hours", "ahead", "target_datetime"]
    got = {(r.datetime, r.forecast_horizon_hours): r.ahead for r in out.collect()}
    values = {t: v for _, t, v in rows}
    assert got == {(t, h): values.get(t + timedelta(hours=h)) for t in values for h in range(1, 25)}
