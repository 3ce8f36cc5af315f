"""Calendar, shipping-time and price-tier columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.functions.dates import elapsed_days, is_temporal, month_name, weekday_name
from saleswright.functions.numeric import nan_to_null
from saleswright.functions.quantiles import approx_edges, exact_quantiles, quantile_edges

QUARTILES = (0.25, 0.5, 0.75)

# Tier labels from the lowest quarter up, and the label for a missing sale.
TIERS = ("Low", "Medium", "High", "Premium")
UNKNOWN_TIER = "Unknown"

CALENDAR = {
    "order_year": F.year,
    "order_month": F.month,
    "order_month_name": month_name,
    "order_quarter": F.quarter,
    "order_day_of_week": weekday_name,
}


def _is_temporal(df: DataFrame, name: str) -> bool:
    return name in df.columns and is_temporal(df.schema[name].dataType)


def calendar_feature(df: DataFrame, name: str) -> DataFrame:
    """One of the ``CALENDAR`` columns from ``order_date``."""
    return df.withColumn(name, CALENDAR[name](F.col("order_date")))


def order_year(df: DataFrame) -> DataFrame:
    return calendar_feature(df, "order_year")


def order_month(df: DataFrame) -> DataFrame:
    return calendar_feature(df, "order_month")


def order_month_name(df: DataFrame) -> DataFrame:
    return calendar_feature(df, "order_month_name")


def order_quarter(df: DataFrame) -> DataFrame:
    return calendar_feature(df, "order_quarter")


def order_day_of_week(df: DataFrame) -> DataFrame:
    return calendar_feature(df, "order_day_of_week")


def shipping_days(df: DataFrame) -> DataFrame:
    """Elapsed days between order and shipment, rounded down."""
    return df.withColumn("shipping_days", elapsed_days(F.col("order_date"), F.col("ship_date")))


def sales_quartiles(df: DataFrame) -> DataFrame:
    """Q1, Q2 and Q3 of ``sales`` as one row."""
    q = exact_quantiles(df, "sales", QUARTILES)
    return q.select(*[F.col("quantiles")[i].alias(f"q{i + 1}") for i in range(3)])


def tier_of(sales: Column, edges: list[Column]) -> Column:
    """The tier of a sale: an edge belongs to the tier below it. NaN is missing, not large."""
    sales = nan_to_null(sales.cast("double"))
    low, medium, high, premium = TIERS
    return (
        F.when(sales <= edges[0], low)
        .when(sales <= edges[1], medium)
        .when(sales <= edges[2], high)
        .when(sales > edges[2], premium)
        .otherwise(UNKNOWN_TIER)
    )


def sales_tier(df: DataFrame, edges: list[float] | None = None, approximate: bool = False) -> DataFrame:
    """Tier by the quartiles of the whole column, or by known ``edges``."""
    if edges is not None:
        cuts = [F.lit(e) for e in edges]
    else:
        found = (approx_edges if approximate else quantile_edges)(df, "sales", QUARTILES)
        cuts = [found[i] for i in range(3)]
    return df.withColumn("sales_tier", tier_of(F.col("sales"), cuts))


def engineer_features(df: DataFrame, edges: list[float] | None = None) -> DataFrame:
    """Every feature whose inputs are present with a usable type."""
    if _is_temporal(df, "order_date"):
        df = df.withColumns({name: fn(F.col("order_date")) for name, fn in CALENDAR.items()})
        if _is_temporal(df, "ship_date"):
            df = shipping_days(df)
    if "sales" in df.columns:
        df = sales_tier(df, edges)
    return df
