"""Aggregates behind the dashboard: KPIs, trends, distributions, correlation, outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleswright.functions.dates import weekday_rank
from saleswright.functions.missing import column
from saleswright.functions.numeric import (
    exact_mean,
    exact_sum,
    known_count,
    nan_to_null,
    percent_of,
    sum_of_parts,
    sum_parts,
)
from saleswright.functions.quantiles import COUNT, box_summary, exact_quantiles, quantile_edges, value_table
from saleswright.operators.filters import numeric_columns, project_existing

# Bins of the full and of the trimmed histogram, where the latter is
# cut, how far a whisker reaches, and how many outliers are shown.
FULL_BINS = 80
TRIMMED_BINS = 60
TRIM_QUANTILE = 0.95
WHISKER_REACH = 1.5
TOP_OUTLIERS = 10
OUTLIER_COLUMNS = ("order_id", "customer_name", "product_name", "category", "sales")
TOP_SUBCATEGORIES = 10

def _revenue() -> Column:
    return exact_sum("sales").alias("revenue")


def kpi_summary(df: DataFrame) -> DataFrame:
    """Revenue, orders, mean order, distinct customers and products.

    The facts are summed up per customer and product in one pass; how many there are of each is counted over those
    sums, where the first of each customer and of each product stands for it.
    """
    keys = ("customer_id", "product_name")
    parts = sum_parts("sales", "_l")
    cells = df.groupBy(*keys).agg(
        F.count("*").alias("_rows"), F.expr(known_count("sales")).alias("_known"), *[F.expr(x).alias(c) for c, x in parts.items()]
    )
    for key, other in zip(keys, keys[::-1], strict=True):
        first = F.row_number().over(Window.partitionBy(key).orderBy(other)) == 1
        cells = cells.withColumn(f"_first_{key}", first & F.col(key).isNotNull())
    total = F.expr(f"CASE WHEN sum(_known) > 0 THEN {sum_of_parts([f'sum({c})' for c in parts])} END")
    return cells.agg(
        total.alias("revenue"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("orders"),
        F.try_divide(total, F.sum("_known")).alias("avg_order"),
        *[F.count_if(f"_first_{key}").alias(name) for key, name in zip(keys, ("customers", "products"), strict=True)],
    )


def monthly_period_trend(df: DataFrame) -> DataFrame:
    """Revenue and orders per month, with a sortable ``YYYY-MM`` period."""
    period = F.concat(F.col("year").cast("string"), F.lit("-"), F.lpad(F.col("month").cast("string"), 2, "0"))
    monthly = df.groupBy(F.col("order_year").alias("year"), F.col("order_month").alias("month")).agg(
        _revenue(), F.expr(known_count("sales")).alias("orders")
    )
    return monthly.withColumn("period", period).orderBy("period")


def category_revenue(df: DataFrame) -> DataFrame:
    """Revenue per category, smallest first."""
    return df.groupBy("category").agg(_revenue()).orderBy("revenue", "category")


def region_revenue_share(df: DataFrame) -> DataFrame:
    """Revenue per region and its percentage of the whole, largest first.

    The total is a window over one row per region.
    """
    regions = df.groupBy("region").agg(_revenue())
    whole = F.sum("revenue").over(Window.partitionBy())
    return regions.withColumn("share_pct", percent_of(F.col("revenue"), whole)).orderBy(
        F.desc("revenue"), "region"
    )


def top_subcategories(df: DataFrame, k: int = TOP_SUBCATEGORIES) -> DataFrame:
    """The ``k`` sub-categories with most revenue, whatever their category."""
    return df.groupBy("sub_category").agg(_revenue()).orderBy(F.desc("revenue"), "sub_category").limit(k)


def segment_revenue(df: DataFrame) -> DataFrame:
    """Revenue, orders and mean order per segment."""
    return df.groupBy("segment").agg(
        _revenue(), F.expr(known_count("sales")).alias("orders"), exact_mean("sales").alias("avg_order")
    )


def ship_mode_revenue(df: DataFrame) -> DataFrame:
    """Revenue and mean shipping days per ship mode, largest first."""
    return (
        df.groupBy("ship_mode")
        .agg(_revenue(), F.avg("shipping_days").alias("avg_days"))
        .orderBy(F.desc("revenue"), "ship_mode")
    )


def box_stats(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Five numbers, whisker ends and outlier count, overall or per group."""
    return box_summary(value_table(df, value, by), value, by, WHISKER_REACH, COUNT)


def group_distribution(df: DataFrame, value: str = "sales", by: str = "category") -> DataFrame:
    """How ``value`` is distributed in each group: its box plus mean and share of outliers."""
    values = value_table(df, value, [by])
    means = values.groupBy(by).agg(exact_mean(f"`{value}`", COUNT).alias("mean")).withColumnRenamed(by, "_g")
    boxes = box_summary(values, value, [by], WHISKER_REACH, COUNT)
    joined = boxes.join(means, boxes[by].eqNullSafe(means["_g"])).drop("_g")
    pct = percent_of(F.col("outlier_count").cast("double"), F.col("count").cast("double"))
    return joined.withColumn("outlier_pct", pct)


def histogram(df: DataFrame, value: str = "sales", bins: int = FULL_BINS) -> DataFrame:
    """Counts in ``bins`` bins of equal width, empty ones included.

    The largest value belongs to the last bin. The bounds come from one scalar
    subquery. When all values are equal they are all in the first bin.
    """
    x = F.col(value).cast("double")
    known = df.where(x.isNotNull() & ~F.isnan(x))
    ends = known.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    width = (ends["hi"] - ends["lo"]) / F.lit(float(bins))
    place = F.when(width > 0, F.least(F.floor((x - ends["lo"]) / width), F.lit(bins - 1))).otherwise(0)
    filled = known.groupBy((place + 1).cast("int").alias("_bin")).agg(F.count("*").alias("_n"))
    frame = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    joined = frame.join(filled, F.col("bin") == F.col("_bin"), "left")
    return joined.select(
        "bin",
        (ends["lo"] + (F.col("bin") - 1) * width).alias("bin_low"),
        (ends["lo"] + F.col("bin") * width).alias("bin_high"),
        F.coalesce("_n", F.lit(0)).alias("count"),
    ).orderBy("bin")


def trimmed_histogram(
    df: DataFrame, value: str = "sales", bins: int = TRIMMED_BINS, p: float = TRIM_QUANTILE
) -> DataFrame:
    """The histogram of the values strictly below their ``p`` quantile."""
    return histogram(df.where(F.col(value) < quantile_edges(df, value, (p,))[0]), value, bins)


def value_counts(df: DataFrame, column: str = "sales_tier") -> DataFrame:
    """Rows per value, most frequent first; NULL is left out."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), column)
    )


def _moments_by_gaps(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(i, j, n, mean_i, mean_j, var_i, var_j, cov)`` per pair of columns and set of known columns.

    Rows that know the same columns are one group, so no aggregate has to mask a row for one of its
    pairs, and a column has one mean and one variance per group instead of one per pair.
    """
    every = range(len(names))
    values = df.select(*[nan_to_null(column(c).cast("double")).alias(f"v{i}") for i, c in enumerate(names)])
    known = [F.col(f"v{i}").isNotNull().alias(f"k{i}") for i in every]
    # The mean of equal values is that value, to the last digit.
    means = [F.when(F.var_pop(f"v{i}") == 0, F.min(f"v{i}")).otherwise(F.avg(f"v{i}")).alias(f"m{i}") for i in every]
    single = means + [F.var_pop(f"v{i}").alias(f"s{i}") for i in every]
    double = [F.covar_pop(f"v{i}", f"v{j}").alias(f"c{i}_{j}") for i in every for j in every if i < j]
    groups = values.groupBy(*known).agg(F.count("*").alias("n"), *single, *double)
    pairs = [
        F.struct(
            F.lit(i).alias("i"), F.lit(j).alias("j"), "n",
            F.col(f"m{i}").alias("mean_i"), F.col(f"m{j}").alias("mean_j"),
            F.col(f"s{i}").alias("var_i"), F.col(f"s{j}").alias("var_j"),
            F.col(f"c{i}_{j}" if i < j else f"s{i}").alias("cov"),
        )
        for i in every for j in every if i <= j
    ]
    return groups.select(F.inline(F.array(*pairs))).where("cov IS NOT NULL")


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of numeric columns: ``(x, y, r)``.

    A pair uses the rows where both are known. One scan gives the moments of each set of known
    columns, of which there are as many as ways in which rows have gaps; a pair adds up the sets
    that know both. A constant column has no correlation (NULL), nor has a pair that no row knows.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    if len(names) < 2:
        raise ValueError("a correlation needs at least two numeric columns")
    pair = Window.partitionBy("i", "j")
    moments = _moments_by_gaps(df, names)
    # Means are taken from the least one, so that equal means leave exactly nothing.
    for m in ("mean_i", "mean_j"):
        moments = moments.withColumn(m, F.col(m) - F.min(m).over(pair))
    for m in ("mean_i", "mean_j"):
        moments = moments.withColumn(m, F.col(m) - F.sum(F.col("n") * F.col(m)).over(pair) / F.sum("n").over(pair))

    def merged(within: str, a: str, b: str) -> Column:
        return F.sum(F.col("n") * (F.col(within) + F.col(a) * F.col(b)))

    spread = F.sqrt(merged("var_i", "mean_i", "mean_i")) * F.sqrt(merged("var_j", "mean_j", "mean_j"))
    r = F.try_divide(merged("cov", "mean_i", "mean_j"), F.nullif(spread, F.lit(0.0)))
    found = moments.groupBy("i", "j").agg(F.when(F.col("i") != F.col("j"), r).when(spread != 0, F.lit(1.0)).alias("r"))
    cells = [
        F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(min(i, j)).alias("i"), F.lit(max(i, j)).alias("j"))
        for i, x in enumerate(names) for j, y in enumerate(names)
    ]
    frame = df.sparkSession.range(1).select(F.inline(F.array(*cells)))
    return frame.join(found, ["i", "j"], "left").select("x", "y", "r")


def _iqr_bounds(values: DataFrame, value: str) -> DataFrame:
    q = exact_quantiles(values, value, (0.25, 0.75), count=COUNT).select(
        F.col("quantiles")[0].alias("q1"), F.col("quantiles")[1].alias("q3")
    )
    spread = F.col("q3") - F.col("q1")
    return q.select(
        F.struct(
            "q1",
            "q3",
            spread.alias("iqr"),
            (F.col("q1") - F.lit(WHISKER_REACH) * spread).alias("lower"),
            (F.col("q3") + F.lit(WHISKER_REACH) * spread).alias("upper"),
        )
    )


def outlier_rows(df: DataFrame, value: str = "sales") -> DataFrame:
    """Rows strictly outside 1.5 interquartile ranges of the middle half; NaN is missing, not large."""
    b = _iqr_bounds(value_table(df, value), value).scalar()
    x = nan_to_null(F.col(value).cast("double"))
    return df.where((x < b["lower"]) | (x > b["upper"]))


def iqr_outliers(df: DataFrame, value: str = "sales") -> DataFrame:
    """Bounds, number, percentage and maximum of the outliers, as one row.

    ``total_count`` counts all rows, known or not; NaN is a missing value.
    """
    values = value_table(df, value)
    b = _iqr_bounds(values, value).scalar()
    x, n = F.col(value), F.col(COUNT)
    outside = (x < b["lower"]) | (x > b["upper"])
    counts = values.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total_count"),
        F.coalesce(F.sum(F.when(outside, n)), F.lit(0)).alias("outlier_count"),
        F.max(F.when(outside, x)).alias("max_outlier"),
    )
    pct = percent_of(F.col("outlier_count").cast("double"), F.col("total_count").cast("double"))
    return counts.select(
        *[b[n].alias(n) for n in ("q1", "q3", "iqr", "lower", "upper")],
        "total_count",
        "outlier_count",
        pct.alias("outlier_pct"),
        "max_outlier",
    )


def top_outliers(df: DataFrame, value: str = "sales", k: int = TOP_OUTLIERS) -> DataFrame:
    """The ``k`` largest outliers with the columns that describe them."""
    shown = project_existing(outlier_rows(df, value), OUTLIER_COLUMNS)
    ties = [c for c in shown.columns if c != value]
    return shown.orderBy(F.desc(value), *ties).limit(k)


def yoy_growth(df: DataFrame) -> DataFrame:
    """Revenue per year and its change on the year before, in percent.

    The window runs over one row per year. The first year has no growth, nor has a
    year after one without revenue.
    """
    yearly = df.groupBy(F.col("order_year").alias("year")).agg(_revenue())
    previous = F.lag("revenue").over(Window.orderBy("year"))
    growth = F.try_divide(F.col("revenue"), previous) - F.lit(1.0)
    return yearly.withColumn("growth_pct", growth * F.lit(100.0)).orderBy("year")


def category_year_trend(df: DataFrame) -> DataFrame:
    """Revenue per year and category."""
    return (
        df.groupBy(F.col("order_year").alias("year"), "category").agg(_revenue()).orderBy("year", "category")
    )


def weekday_month_heatmap(df: DataFrame) -> DataFrame:
    """Revenue per weekday (Monday first) and month; 0 where there is none.

    The months are given, so the pivot needs no extra job to find them.
    """
    months = list(range(1, 13))
    cells = df.groupBy(F.col("order_day_of_week").alias("day_of_week"), "order_month").agg(_revenue())
    wide = cells.groupBy("day_of_week").pivot("order_month", months).agg(F.sum("revenue"))
    named = wide.select("day_of_week", *[F.coalesce(F.col(str(m)), F.lit(0.0)).alias(f"month_{m:02d}") for m in months])
    known = named.where(weekday_rank(F.col("day_of_week")) > 0)
    return known.orderBy(weekday_rank(F.col("day_of_week")))
