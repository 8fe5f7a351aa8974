"""Products of columns, nested fits and the number of features, against NumPy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import aggregate as ag
from panelcast.operators import gram as gr
from panelcast.operators import modelling as ml
from panelcast.plans import selection as se


@pytest.fixture(scope="module")
def table(spark):
    """Three inputs, a sum of two of them, a constant, a column without values, and a target; some values are missing."""
    rng = np.random.default_rng(4)
    a, b, c = rng.normal(5, 2, 400), rng.normal(-3, 1, 400), rng.normal(100, 30, 400)
    y = 2 * a - b + 0.1 * c + rng.normal(0, 0.5, 400)
    rows = [[float(v) for v in r] for r in np.column_stack([a, b, c, a + 2 * b, np.full(400, 7.0), y])]
    for i in range(0, 400, 9):
        rows[i][i % 3] = None if i % 2 else float("nan")
    frame = spark.createDataFrame([(*r, None) for r in rows], "a double, b double, c double, sum double, flat double, y double, none double")
    return frame.repartition(5).cache(), np.array([[np.nan if v is None else v for v in r] for r in rows], dtype=float)


NAMES = ["a", "b", "c", "sum", "flat", "y"]


def filled(values):
    return np.where(np.isnan(values), np.nanmean(values, axis=0), values)


@pytest.mark.parametrize("block", [1, 2, 4, 100])
def test_products_match_numpy(table, block):
    df, values = table
    g = gr.gram(df, [*NAMES, "none"], block=block)
    beside = filled(values) - np.nanmean(values, axis=0)
    assert g.rows == 400 and g.means[-1] == 0 and not g.products[-1].any()
    assert np.allclose(g.means[:-1], np.nanmean(values, axis=0)) and np.allclose(g.products[:-1, :-1], beside.T @ beside, atol=1e-6)


def test_products_of_nothing(table):
    g = gr.gram(table[0].limit(0), NAMES)
    assert g.rows == 0 and not g.products.any() and np.isnan(g.correlations()).all()
    fit = gr.nested_fits(g, "y", ["a", "b"], [0, 2])[2]
    assert fit.coefficients == [0.0, 0.0] and fit.intercept == 0.0


def test_every_nested_fit_is_the_least_squares_fit(table):
    df, values = table
    order = ["flat", "a", "c", "b", "sum"]
    fits = gr.nested_fits(gr.gram(df, NAMES), "y", order, range(6))
    x = filled(values)
    for n in range(6):
        inputs = x[:, [NAMES.index(c) for c in order[:n]]]
        want = np.column_stack([np.ones(400), inputs]) @ np.linalg.lstsq(np.column_stack([np.ones(400), inputs]), x[:, -1], rcond=None)[0]
        got = fits[n].intercept + inputs @ np.array(fits[n].coefficients) if n else np.full(400, fits[n].intercept)
        assert np.allclose(got, want, atol=1e-6)
        rows = df.select(fits[n].prediction().alias("p")).agg(F.avg("p")).first()[0]
        assert rows == pytest.approx(want.mean())


def test_correlations_and_pairs_of_many_columns(spark):
    rng = random.Random(1)
    rows = [[rng.random() for _ in range(30)] for _ in range(60)]
    for r in rows:
        r[7] = 3 * r[2] + 1
        r[9] = -r[2]
    rows[5][4] = None
    names = [f"f{i}" for i in range(30)]
    df = spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{n} double" for n in names))
    pairs = ag.collinear_pairs(df, names).collect()
    assert sorted((r.feature_1, r.feature_2) for r in pairs) == [("f2", "f7"), ("f2", "f9"), ("f7", "f9")]
    known = np.array([r for r in rows if None not in r], dtype=float)
    want = np.abs(np.corrcoef(known.T)[0])
    got = {r.feature: r.correlation for r in ag.corr_with_target(df, names[1:], "f0").collect()}
    assert [got[n] for n in names[1:]] == pytest.approx(want[1:].tolist())


@pytest.fixture(scope="module")
def split(spark):
    """A training and a validation set with mandatory features, useful ones and noise."""
    rng = np.random.default_rng(9)
    n = 600
    hour = rng.integers(0, 24, n)
    columns = {
        "target_hour_sin": np.sin(hour / 12 * np.pi),
        "target_hour_cos": np.cos(hour / 12 * np.pi),
        "lag": rng.normal(50, 10, n),
        "wind": rng.normal(0, 1, n),
        **{f"noise{i}": rng.normal(0, 1, n) for i in range(4)},
    }
    y = 100 + 3 * columns["lag"] + 5 * columns["wind"] + 20 * columns["target_hour_sin"] + rng.normal(0, 1, n)
    zone = rng.integers(0, 3, n)
    rows = [(["north", "south", "west"][z], *map(float, r)) for z, r in zip(zone, np.column_stack([*columns.values(), y]))]
    names = ["zone", *columns, "target_demand_mw"]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], ["i", *names])
    return df.where("i < 400").cache(), df.where("i >= 400").cache(), {**columns, "zone": zone.astype(float)}, y


RANKED = ["lag", "target_hour_sin", "wind", "noise0", "noise1", "noise2", "noise3"]


def test_numbers_of_features_are_compared_by_fitted_models(split):
    train, validation, columns, y = split
    results = se.compare_feature_counts(train, validation, RANKED, [1, 3, 5, 99])
    got = {r.requested_feature_count: r for r in results.collect()}
    assert sorted(got) == [1, 3, 5, 7]
    for n, row in got.items():
        features = ml.keep_mandatory(RANKED, n, [*columns])
        assert row.actual_feature_count == len(features) and {"zone", "target_hour_sin", "target_hour_cos"} <= set(features)
        x = np.column_stack([np.ones(600), *[columns[f] for f in features]])
        predicted = x[400:] @ np.linalg.lstsq(x[:400], y[:400], rcond=None)[0]
        error = np.abs(predicted - y[400:])
        assert row.wape == pytest.approx(error.sum() / np.abs(y[400:]).sum() * 100) and row.mae == pytest.approx(error.mean())
    chosen = ml.choose_features(results).first()
    near = [n for n, r in got.items() if r.wape <= min(r.wape for r in got.values()) + 0.05]
    assert chosen.requested_feature_count == min(near) == 3


def test_numbers_of_features_with_any_model(split):
    train, validation, *_ = split

    def fit(rows, features):
        return ml.fit_point(rows, features, "target_demand_mw", "linear", settled=True, regParam=0.0)

    one = se.compare_feature_counts(train, validation, RANKED, [1, 3])
    two = se.compare_fitted_counts(train, validation, RANKED, [1, 3], fit)
    wape = [{r.requested_feature_count: r.wape for r in x.collect()} for x in (one, two)]
    assert wape[0] == pytest.approx(wape[1], abs=1e-6)


def test_features_are_ranked_by_correlation(split):
    ranked = se.by_correlation(split[0], [*RANKED, "target_hour_cos"])
    assert ranked[0] == "lag" and set(ranked) == {*RANKED, "target_hour_cos"}
