"""Exact quantiles and box statistics against NumPy."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleswright.functions import quantiles as q

PROBS = (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0)


def _samples():
    rng = random.Random(7)
    return {
        "money": [round(rng.lognormvariate(4, 1.5), 2) for _ in range(3000)],
        "hot value": [19.99] * 1000 + [round(rng.uniform(0, 100), 2) for _ in range(2000)],
        "signed": [float(rng.randint(-50, 50)) for _ in range(999)],
        "constant": [7.5] * 10,
        "one": [3.25],
        "two": [-1.0, 4.0],
        "wide": [10.0**e for e in range(-8, 18)],
        "close": [1e9 + i / 100 for i in range(500)],
    }


SAMPLES = _samples()


def _brute(values, probs):
    return [float(x) for x in np.quantile(values, probs)]


def _frame(spark, groups):
    rows = [(g, v) for g, values in groups.items() for v in values]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "g string, v double").repartition(5)


@pytest.mark.parametrize("name", sorted(SAMPLES))
def test_overall(spark, name):
    values = SAMPLES[name]
    row = q.exact_quantiles(_frame(spark, {name: values}), "v", PROBS).first()
    assert row["count"] == len(values)
    assert row.quantiles == _brute(values, PROBS)


def test_grouped(spark):
    groups = {**SAMPLES, None: [1.0, 2.0, 4.0]}
    rows = q.exact_quantiles(_frame(spark, groups), "v", PROBS, ["g"]).collect()
    assert {r.g: r.quantiles for r in rows} == {g: _brute(v, PROBS) for g, v in groups.items()}


@pytest.mark.parametrize("value", ["1.5e9D + id", "1D + id * 1e-9D"])
def test_close_values_are_told_apart(spark, value):
    """A million values far from zero: no cell, hence no task, holds more than a few of them."""
    df = spark.range(1_000_000).select(F.expr(value).alias("v"))
    row = q.exact_quantiles(df, "v", (0.5,)).first()
    assert row["count"] == 1_000_000
    expected = df.agg(F.expr("percentile(v, 0.5)")).first()[0]
    assert row.quantiles[0] == pytest.approx(expected, rel=1e-15)
    rows = q._bucketed(df, "v", [])
    boxes = q._histogram(rows, []).select("_b", F.struct("_min", "_max").alias("w"))
    cells = rows.join(boxes, "_b").groupBy(q._cell(F.col("_x"), F.col("w"))).count()
    assert cells.agg(F.max("count")).first()[0] <= 100


def test_nulls_and_nan_are_ignored(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (1.0,), (3.0,)], "v double")
    row = q.exact_quantiles(df, "v", (0.5,)).first()
    assert (row["count"], row.quantiles) == (2, [2.0])


def test_empty(spark):
    df = spark.createDataFrame([], "v double, g string")
    row = q.exact_quantiles(df, "v", (0.5,)).first()
    assert (row["count"], row.quantiles) == (0, [None])
    assert q.exact_quantiles(df, "v", (0.5,), ["g"]).count() == 0
    assert q.box_summary(df, "v").count() <= 1


def _box(values):
    lo, q1, median, q3, hi = _brute(values, (0, 0.25, 0.5, 0.75, 1))
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = [v for v in values if low <= v <= high]
    return (len(values), lo, q1, median, q3, hi, min(inside), max(inside), len(values) - len(inside))


def test_box_summary(spark):
    df = _frame(spark, SAMPLES)
    names = ("count", "min", "q1", "median", "q3", "max", "whisker_low", "whisker_high", "outlier_count")
    got = {r.g: tuple(r[n] for n in names) for r in q.box_summary(df, "v", ["g"]).collect()}
    assert got == {g: _box(v) for g, v in SAMPLES.items()}
    overall = q.box_summary(_frame(spark, {"money": SAMPLES["money"]}), "v").first()
    assert tuple(overall[n] for n in names) == _box(SAMPLES["money"])


def test_sketch_is_close(spark):
    df = _frame(spark, {"money": SAMPLES["money"]})
    edges = df.select(q.approx_edges(df, "v", (0.25, 0.75)).alias("e")).first().e
    assert edges == pytest.approx(_brute(SAMPLES["money"], (0.25, 0.75)), rel=0.02)
