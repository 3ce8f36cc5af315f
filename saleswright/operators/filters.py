"""Row filters, filter choices and column selection."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswright.functions.dates import is_temporal
from saleswright.functions.quantiles import quantile_edges
from saleswright.functions.rows import literal_rows

ALL = "All"


@dataclass(frozen=True)
class SalesFilter:
    """Equality choices; ``"All"`` (or a column the data lacks) is no condition."""

    category: str = ALL
    region: str = ALL
    segment: str = ALL
    year: int | str = ALL

    def predicates(self, df: DataFrame) -> list[Column]:
        found = []
        for f in fields(self):
            value, column = getattr(self, f.name), "order_year" if f.name == "year" else f.name
            if value == ALL or column not in df.columns:
                continue
            if f.name == "year":
                found += _year_predicates(df, int(value))
            else:
                found.append(F.col(column) == F.lit(value))
        return found


def _year_predicates(df: DataFrame, year: int) -> list[Column]:
    """The stored year prunes partitions; the date range reaches the file statistics."""
    found = [F.col("order_year") == F.lit(year)]
    if "order_date" in df.columns and is_temporal(df.schema["order_date"].dataType):
        kind = df.schema["order_date"].dataType
        start, end = (F.lit(dt.datetime(y, 1, 1).isoformat(sep=" ")).cast(kind) for y in (year, year + 1))
        found += [F.col("order_date") >= start, F.col("order_date") < end]
    return found


def apply_filters(df: DataFrame, choice: SalesFilter) -> DataFrame:
    """Rows that meet every choice."""
    predicates = choice.predicates(df)
    return df.where(reduce(Column.__and__, predicates)) if predicates else df


def filter_options(df: DataFrame) -> DataFrame:
    """The values each filter can take, ``"All"`` first: ``(filter, value)``.

    One scan: the four columns are unpivoted and made distinct before the shuffle.
    """
    sources = {"category": "category", "region": "region", "segment": "segment", "year": "order_year"}
    present = {name: col for name, col in sources.items() if col in df.columns}
    texts = df.select(*[F.col(c).cast("string").alias(name) for name, c in present.items()])
    values = texts.unpivot([], list(present), "filter", "value").where(F.col("value").isNotNull()).distinct()
    rank = F.when(F.col("value") == ALL, 0).otherwise(1)
    columns = {"filter": "string", "value": "string"}
    names = literal_rows(df.sparkSession, columns, [(n, ALL) for n in present])
    return names.unionByName(values).distinct().orderBy("filter", rank, "value")


def range_filter_quantile(df: DataFrame, value: str = "sales", p: float = 0.95) -> DataFrame:
    """Rows strictly below the ``p`` quantile of ``value``."""
    return df.where(F.col(value) < quantile_edges(df, value, (p,))[0])


def project_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The requested columns that exist, in the requested order."""
    return df.select([c for c in columns if c in df.columns])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def select_numeric(df: DataFrame) -> DataFrame:
    """Numeric columns only."""
    return df.select(numeric_columns(df))


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Rows with a value in every column of ``subset``."""
    return df.dropna(subset=list(subset))
