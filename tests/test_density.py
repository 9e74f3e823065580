"""The density against a plain numpy computation."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from earshot.operators.density import bandwidth, density, summary, value_counts


def _brute(values):
    values = np.asarray(values, dtype=float)
    sd = values.std(ddof=1)
    q1, q3 = np.quantile(values, [0.25, 0.75])
    spread = min(sd, (q3 - q1) / 1.34) or sd or abs(values[0]) or 1.0
    h = 0.9 * spread * len(values) ** -0.2
    x = np.linspace(values.min(), values.max(), 512)
    kernels = np.exp(-0.5 * ((x[:, None] - values[None, :]) / h) ** 2)
    return x, kernels.sum(axis=1) / (len(values) * h * np.sqrt(2 * np.pi)), (q1, q3, sd, h)


def _frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(4)


CASES = {
    "spread": np.random.default_rng(1).normal(120, 30, 700).round(2).tolist(),
    "clustered": [0.5 + i * 1e-9 for i in range(50)] + [0.0, 1.0],
    "heavy value": [1.0] * 60 + [2.0, 3.0, 4.0, 5.0],
    "one value": [7.0] * 5,
    "all zero": [0.0] * 3,
    "two": [1.0, 4.0],
    "negative": [-3.0, -1.0, 0.0, 2.0, 2.0],
}


@pytest.mark.parametrize("name", CASES)
def test_density_equals_brute_force(spark, name):
    x, y, _ = _brute(CASES[name])
    got = density(_frame(spark, CASES[name]), "x").orderBy("point").collect()
    assert [r.point for r in got] == list(range(512))
    np.testing.assert_allclose([r.x for r in got], x, rtol=1e-12)
    np.testing.assert_allclose([r.density for r in got], y, rtol=1e-9)


@pytest.mark.parametrize("values", [[], [None, None], [3.0], [None, 3.0]])
def test_fewer_than_two_values_have_no_density(spark, values):
    assert density(_frame(spark, values), "x").count() == 0


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.floats(-1e6, 1e6, allow_nan=False).map(lambda v: round(v, 3) + 0.0),
        min_size=2,
        max_size=60,
    )
)
def test_summary_equals_brute_force(spark, values):
    _, _, (q1, q3, sd, h) = _brute(values)
    pairs = value_counts(_frame(spark, values), "x")
    row = summary(pairs).collect()[0]
    assert row.total == len(values)
    assert (row.lo, row.hi) == (min(values), max(values))
    assert row.q1 == pytest.approx(q1, rel=1e-9, abs=1e-9)
    assert row.q3 == pytest.approx(q3, rel=1e-9, abs=1e-9)
    assert row.sd == pytest.approx(sd, rel=1e-9, abs=1e-9)


def test_hot_value_is_one_pair(spark):
    frame = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.col("id") % 7))
    pairs = value_counts(frame.toDF("x"), "x")
    assert pairs.count() == 7
    assert bandwidth(pairs).collect()[0].total == 30000


def test_infinite_values_are_left_out(spark):
    finite = [1.0, 2.0, 2.5, 7.0]
    odd = [*finite, float("inf"), float("-inf"), float("nan")]
    own = [tuple(r) for r in density(_frame(spark, odd), "x").orderBy("point").collect()]
    plain = [tuple(r) for r in density(_frame(spark, finite), "x").orderBy("point").collect()]
    assert np.array(own) == pytest.approx(np.array(plain))


def test_values_crowded_near_zero_are_spread(spark):
    """Of 200,000 distinct values below 0.001 no task ranks more than a few."""
    from earshot.operators import density as module

    values = spark.range(0, 200000, 1, 4).selectExpr("(id + 1) * 4.9e-9 AS x")
    pairs = module.value_counts(values, "x")
    row = summary(pairs).first()
    x = (np.arange(200000) + 1) * 4.9e-9
    assert (row.q1, row.q3) == pytest.approx(tuple(np.quantile(x, [0.25, 0.75])), rel=1e-12)
    assert row.sd == pytest.approx(x.std(ddof=1), rel=1e-9)
    bins = module._binned(pairs).groupBy("bin").count().agg(F.max("count")).first()[0]
    assert bins < 200000 / 100
