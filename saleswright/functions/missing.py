"""What counts as missing, and how much of it there is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswright.functions.dates import is_temporal


def column(name: str) -> Column:
    """A column by its exact name, whatever characters are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN in a floating-point column."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column(name).isNull() | F.isnan(column(name))
    return column(name).isNull()


def kind_of(dtype: T.DataType) -> str:
    if isinstance(dtype, T.NumericType):
        return "numeric"
    return "temporal" if is_temporal(dtype) else "text"


def missing_by_column(df: DataFrame) -> DataFrame:
    """``(position, column, dtype, kind, null_count, row_count)``, from one aggregate row.

    However many columns there are, it is one scan and one row per task.
    """
    counts = [F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)]
    totals = df.agg(F.count("*").alias("rows"), *counts)
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.lit(kind_of(f.dataType)).alias("kind"),
            F.col(f"m{i}").alias("null_count"),
            F.col("rows").alias("row_count"),
        )
        for i, f in enumerate(df.schema)
    ]
    return totals.select(F.inline(F.array(*entries)))
