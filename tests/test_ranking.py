"""Order statistics against NumPy and pandas."""

import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelcast.operators import joins
from panelcast.operators import ranking as rk
from panelcast.session import settle

SHARES = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.75, "e": 0.99, "f": 1.0}


def exact(values):
    return [float(np.percentile(values, p * 100)) for p in SHARES.values()]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e6, 1e6).map(lambda v: round(v, 2)), min_size=1, max_size=60))
def test_percentiles_of_small_sets(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "y double")
    assert list(rk.percentiles(df, "y", SHARES).first()) == pytest.approx(exact(values), abs=1e-6)


@pytest.mark.parametrize("accuracy", [20, 100, 10_000])
def test_percentiles_survive_a_coarse_sketch_and_ties(spark, accuracy):
    rng = random.Random(3)
    values = [42.0] * 4000 + [rng.gauss(0, 1) ** 3 * 1e4 for _ in range(6000)]
    rng.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "y double").repartition(7)
    got = rk.percentiles(df, "y", SHARES, accuracy=accuracy).first()
    assert list(got) == pytest.approx(exact(values), abs=1e-6)


def test_percentiles_by_group_with_null_group_and_missing_values(spark):
    rows = [("a", 1.0), ("a", 3.0), ("a", None), (None, 5.0), (None, 9.0), ("b", float("nan")), ("b", 2.0)]
    df = spark.createDataFrame(rows, "g string, y double")
    got = {r.g: r.m for r in rk.percentiles(df, "y", {"m": 0.5}, "g").collect()}
    assert got == {"a": 2.0, None: 7.0, "b": 2.0}


def test_average_ranks_share_ties(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (3.0,), (1.0,)], "s double")
    assert sorted(r.s_rank for r in rk.rank_average(df, "s").collect()) == [1.5, 1.5, 3.0, 4.0]


@pytest.mark.parametrize("parts", [1, 3, 20])
def test_ranks_and_shares_match_pandas(spark, parts):
    rng = random.Random(5)
    values = [float(rng.choice([1e9, 7, 7, 7, rng.randint(0, 300)])) for _ in range(900)]
    frame = pd.DataFrame({"id": range(len(values)), "v": values})
    df = spark.createDataFrame(frame).repartition(5)
    ranks = {r.id: r.v_rank for r in rk.rank_average(df, "v", parts=parts).collect()}
    assert ranks == frame.set_index("id")["v"].rank(ascending=False).to_dict()
    shares = rk.cumulative_share(df, "v", ties=["id"], parts=parts).orderBy(F.desc("v"), "id").toPandas()
    expected = (frame.sort_values(["v", "id"], ascending=[False, True])["v"] / sum(values) * 100).cumsum()
    assert shares["cumulative_v_pct"].tolist() == pytest.approx(expected.tolist())


@pytest.mark.parametrize("ordered", [1, 10, 200])
def test_percentiles_order_a_bounded_number_of_values(spark, monkeypatch, ordered):
    """However large the group, no more values than asked for are left to be ordered."""
    rng = random.Random(8)
    values = {"many": [rng.gauss(0, 1) for _ in range(20_000)], "hot": [7.0] * 9000 + [rng.random() * 20 for _ in range(9000)]}
    values |= {"few": [1.0, 5.0], "same": [3.0] * 500}
    df = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs], "g string, y double").repartition(6)
    left = []

    def narrowed(merged, keys, most, real=rk._narrowed):
        found = real(merged, keys, most)
        left.append(max(r["count"] for r in found.groupBy(*keys).count().collect()))
        return found

    monkeypatch.setattr(rk, "_narrowed", narrowed)
    got = {r.g: r for r in rk.percentiles(df, "y", SHARES, "g", accuracy=20, ordered=max(ordered, 2)).collect()}
    for g, vs in values.items():
        assert [got[g][n] for n in SHARES] == pytest.approx(exact(vs), abs=1e-9)
    assert len(left) == 1 and left[0] <= max(ordered, 2)
    whole = rk.percentiles(df, "y", SHARES, accuracy=20, ordered=max(ordered, 2)).first()
    assert list(whole) == pytest.approx(exact([v for vs in values.values() for v in vs]), abs=1e-9)


def test_an_outlier_and_a_hot_value_leave_parts_even(spark):
    rows = [(1e12,)] + [(5.0,)] * 10_000 + [(float(i % 9973) / 7,) for i in range(20_000)]
    df = spark.createDataFrame(rows, "v double").repartition(8)
    sizes = sorted(r["count"] for r in rk.range_parts(df, [F.desc("v")], 8).groupBy("_part").count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 2 * np.median(sizes)
    counted = df.groupBy("v").count()
    merged = sorted(r["count"] for r in rk.range_parts(counted, [F.desc("v")], 8).groupBy("_part").count().collect())
    assert merged[-1] <= 2 * np.median(merged)
    frame = pd.DataFrame(rows, columns=["v"])
    shares = rk.cumulative_share(df, "v", parts=8).toPandas().sort_values("cumulative_v_pct")
    expected = (frame["v"].sort_values(ascending=False) / frame["v"].sum() * 100).cumsum()
    assert shares["cumulative_v_pct"].tolist() == pytest.approx(expected.tolist())


def test_attach_copies_only_heavy_keys(spark):
    rows = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k", "id AS v").repartition(4)
    stats = settle(rows.groupBy("k").agg(F.count("*").alias("n")))
    heavy = settle(rows.limit(1).select(joins.heavy_keys(rows, ["k"]).alias("h"))).first().h
    assert len(heavy) == 1
    out = joins.attach(rows, stats, "k", salts=16)
    assert out.count() == 30_000 and out.filter("n <> CASE WHEN k = -1 THEN 10000 ELSE 1 END").count() == 0
    # the side of the stats: one copy of each key, and 16 of the heavy one
    side = stats.withColumn("c", F.when(F.array_contains(joins.heavy_keys(rows, ["k"]), joins.key_hash(["k"])), 16).otherwise(1))
    assert side.agg(F.sum("c")).first()[0] == 20_000 + 16
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "approx_top_k" in plan and "Join LeftOuter" in plan


def test_top_n_takes_each_groups_own_number(spark):
    rows = [(g, i) for g in "abc" for i in range(10)]
    df = spark.createDataFrame(rows, "g string, v int")
    top = rk.top_n_per_group(df, "g", [F.col("v").desc()], {"a": 3, "b": 1})
    assert sorted((r.g, r.v) for r in top.collect()) == [("a", 7), ("a", 8), ("a", 9), ("b", 9)]
    assert rk.top_n_per_group(df, "g", [F.col("v").desc()], 2).count() == 6


def test_top_n_is_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS g", "id AS v")
    plan = rk.top_n_per_group(df, "g", [F.col("v").desc()], {1: 2})._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_latest_row_per_key(spark):
    rows = [("a", 1, 10.0), ("a", 3, None), ("b", 2, 5.0)]
    df = spark.createDataFrame(rows, "k string, at int, v double")
    assert sorted(tuple(r) for r in rk.latest_per_key(df, "k", "at").collect()) == [("a", 3, None), ("b", 2, 5.0)]
