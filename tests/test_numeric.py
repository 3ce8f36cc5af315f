"""Sums and rounding without caps, and the same in any order."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from saleswright.functions.numeric import exact_mean, exact_sum, round_half_up
from saleswright.operators.exploration import correlation_matrix, iqr_outliers, monthly_period_trend, top_outliers

NAN, INF = float("nan"), float("inf")


def total(spark, values, parts=3):
    rows = spark.createDataFrame([(v,) for v in values], "sales double").repartition(parts)
    return rows.agg(exact_sum("sales").alias("s"), exact_mean("sales").alias("m")).first()


@pytest.mark.parametrize(
    "values, expected",
    [
        ([2e12] * 500, 1e15),
        ([1e17] * 3, 3e17),
        ([1e300, 1e300], 2e300),
        ([0.00004] * 10, 0.0004),
        ([0.1, 0.2, NAN], 0.3),
        ([1.0, INF], INF),
        ([-1e17, 1e17, 0.01], 0.01),
        ([NAN, None], None),
        ([], None),
    ],
)
def test_sum(spark, values, expected):
    got = total(spark, values)["s"]
    assert got == expected if expected is None or math.isinf(expected) else math.isclose(got, expected, rel_tol=1e-15)


def test_sum_is_the_same_in_any_order(spark):
    values = [random.Random(k).uniform(-1, 1) * 10.0 ** (k % 40 - 15) for k in range(800)]
    found = set()
    for seed in range(3):
        random.Random(seed).shuffle(values)
        found.add(total(spark, values, parts=seed + 2)["s"])
    assert len(found) == 1 and math.isclose(found.pop(), math.fsum(values), rel_tol=1e-12)


def test_mean_ignores_nan(spark):
    assert total(spark, [1.0, 2.0, NAN])["m"] == 1.5


@pytest.mark.parametrize("value", [1e15, 1e17, 1e300, -1e17, -1e300, 2.5, -2.5, 1.005, 0.0])
def test_rounding_has_no_cap(spark, value):
    got = spark.range(1).select(round_half_up(f"{value!r}D").alias("r")).first()["r"]
    assert math.isclose(got, value, rel_tol=0.01) and (abs(value) < 1e15 or got == value)


def test_nan_is_missing_not_large(spark):
    rows = [(float(k), float(k), k) for k in range(1, 11)] + [(NAN, 3.0, 11)]
    df = spark.createDataFrame(rows, "sales double, other double, order_id int")
    found = iqr_outliers(df).first()
    assert found["outlier_count"] == 0 and found["max_outlier"] is None and found["total_count"] == 11
    assert top_outliers(df).count() == 0
    r = correlation_matrix(df, ["sales", "other"]).where("x = 'sales' AND y = 'other'").first()["r"]
    assert math.isclose(r, 1.0)


def test_unknown_month_has_no_period(spark):
    df = spark.createDataFrame([(None, None, 1.0), (2017, 3, 2.0)], "order_year int, order_month int, sales double")
    assert {r["period"] for r in monthly_period_trend(df).collect()} == {None, "2017-03"}


def test_reports_that_fail_while_running(spark):
    from saleswright.plans.reports import REPORTS, Failure, compute_reports, plan_reports

    df = spark.createDataFrame([("a", "x")], "category string, sales string")
    found = compute_reports(spark, plan_reports(df, {"category_performance": REPORTS["category_performance"]}))
    assert isinstance(found["category_performance"], Failure)


def test_open_date_order_is_told(spark, caplog):
    from saleswright.operators.cleaning import convert_dates

    df = spark.createDataFrame([("08/11/2017",), ("15/04/2018",), ("04/15/2018",)], "order_date string")
    with caplog.at_level("WARNING"):
        convert_dates(df, ["order_date"], on_error="null")
    assert "order_date" in caplog.text
    with pytest.raises(ValueError, match="order_date"):
        convert_dates(df, ["order_date"], on_error="null", on_ambiguous="error")
    assert df.select(F.count("*")).first()[0] == 3
