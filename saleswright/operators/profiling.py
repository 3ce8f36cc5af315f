"""Completeness, distinctness and summary statistics of any frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswright.functions.missing import column, is_missing, missing_by_column
from saleswright.functions.numeric import percent_of
from saleswright.functions.quantiles import exact_quantiles
from saleswright.operators.filters import numeric_columns

PREVIEW_ROWS = 20


def _share(part: str, whole: str) -> Column:
    return percent_of(F.col(part).cast("double"), F.col(whole).cast("double"))


def dataset_overview(df: DataFrame) -> DataFrame:
    """Rows, columns, missing cells and their percentage, as one row."""
    totals = missing_by_column(df).agg(
        F.max("row_count").alias("rows"), F.count("*").alias("columns"), F.sum("null_count").alias("null_cells")
    )
    cells = (F.col("rows") * F.col("columns")).cast("double")
    return totals.withColumn("null_pct", percent_of(F.col("null_cells").cast("double"), cells))


def _comparable(df: DataFrame, field: T.StructField) -> Column:
    """A text that is equal exactly when two values are; -0.0 and 0.0 are one value."""
    value = column(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        value = F.when(~F.isnan(value), value + F.lit(0.0))
    return value.cast("string")


def distinct_counts(df: DataFrame) -> DataFrame:
    """Exact number of distinct known values of every column: ``(position, distinct_count)``.

    All columns share one shuffle of their distinct values. Counting them column by
    column in one aggregate would instead copy each whole row once per column.
    """
    texts = df.select(*[_comparable(df, f).alias(f"c{i}") for i, f in enumerate(df.schema)])
    long = texts.unpivot([], texts.columns, "name", "value").where(F.col("value").isNotNull())
    position = F.substring("name", 2, 9).cast("int").alias("position")
    return long.distinct().groupBy(position).agg(F.count("*").alias("distinct_count"))


def approx_distinct_counts(df: DataFrame) -> DataFrame:
    """The same by sketches: one scan, no shuffle of values."""
    sketches = df.agg(
        *[
            F.approx_count_distinct(F.when(~is_missing(df, c), column(c))).alias(f"c{i}")
            for i, c in enumerate(df.columns)
        ]
    )
    entries = [
        F.struct(F.lit(i).alias("position"), F.col(f"c{i}").alias("distinct_count"))
        for i in range(len(df.columns))
    ]
    return sketches.select(F.inline(F.array(*entries)))


def data_quality_profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Per column: type, known, missing and distinct values, with percentages.

    ``exact=False`` uses sketches, for a first look at a very large table.
    """
    distinct = distinct_counts(df) if exact else approx_distinct_counts(df)
    joined = missing_by_column(df).join(distinct, "position", "left")
    full = joined.withColumn("distinct_count", F.coalesce("distinct_count", F.lit(0)))
    return full.orderBy("position").select(
        "column",
        "dtype",
        (F.col("row_count") - F.col("null_count")).alias("non_null"),
        "null_count",
        _share("null_count", "row_count").alias("null_pct"),
        "distinct_count",
        _share("distinct_count", "row_count").alias("distinct_pct"),
    )


def missing_columns(df: DataFrame) -> DataFrame:
    """The columns with missing values and how many; needs no distinct counting."""
    found = missing_by_column(df).where(F.col("null_count") > 0)
    return found.orderBy("position").select("column", "null_count")


def describe_numeric(df: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per numeric column.

    Moments come from one aggregate row; the quartiles of all columns are exact and
    share two scans.
    """
    names = numeric_columns(df)
    values = df.select(*[F.when(~is_missing(df, c), column(c).cast("double")).alias(c) for c in names])
    moments = values.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(column(c)).alias("count"),
                F.avg(column(c)).alias("mean"),
                F.stddev_samp(column(c)).alias("std"),
                F.min(column(c)).alias("min"),
                F.max(column(c)).alias("max"),
            ).alias(f"s{i}")
            for i, c in enumerate(names)
        ]
    ).select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(names))])))
    long = values.unpivot([], names, "column", "value")
    quartiles = exact_quantiles(long, "value", (0.25, 0.5, 0.75), ["column"]).select(
        "column", *[F.col("quantiles")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))]
    )
    return moments.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def preview(df: DataFrame, key: str = "row_id", rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows by ``key``; other columns break ties."""
    order = [key, *[c for c in df.columns if c != key]] if key in df.columns else df.columns
    return df.orderBy(*order).limit(rows)
