"""Registered queries: filters, exploration, profiling, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleswright.functions.numeric import round_half_up
from saleswright.operators import exploration as ex
from saleswright.operators import filters as fl
from saleswright.operators import profiling as pr
from saleswright.operators import sampling as sm
from saleswright.plans.sales_table import RAW_NAMES, raw_orders, sales_data
from saleswright.workload.sql import RAW_COLUMNS, half_up, mean, over_flat, over_raw, over_sales, total

QUERIES, SQL = {}, {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


_REV = f"{total('sales')} AS revenue"
CHOICE = fl.SalesFilter(category="ECONOMY", region="ASIA", segment="BUILDING", year=1998)


# --- filters and projections -----------------------------------------------------


@register(
    "filter_options",
    over_sales(
        "\nUNION ALL\n".join(
            f"SELECT '{f}' AS filter, 'All' AS value UNION ALL "
            f"SELECT '{f}', CAST({c} AS VARCHAR) FROM sales_data WHERE {c} IS NOT NULL GROUP BY {c}"
            for f, c in (("category", "category"), ("region", "region"), ("segment", "segment"), ("year", "order_year"))
        )
    ),
)
def filter_options(spark, folder):
    return fl.filter_options(sales_data(spark, folder, ["category", "region", "segment", "order_year"]))


@register(
    "apply_filters",
    over_sales(
        "SELECT order_id, customer_id, category, region, segment, order_year, sales FROM sales_data "
        "WHERE category = 'ECONOMY' AND region = 'ASIA' AND segment = 'BUILDING' AND order_year = 1998"
    ),
)
def apply_filters(spark, folder):
    shown = ["order_id", "customer_id", "category", "region", "segment", "order_year", "sales"]
    return fl.apply_filters(sales_data(spark, folder, [*shown, "order_date"]), CHOICE).select(shown)


@register(
    "range_filter_quantile",
    over_flat("SELECT order_id, sales FROM flat WHERE sales < (SELECT quantile_cont(sales, 0.95) FROM flat)"),
)
def range_filter_quantile(spark, folder):
    return fl.range_filter_quantile(sales_data(spark, folder, ["order_id", "sales"]))


@register("project_existing", over_flat("SELECT order_id, product_name, sales FROM flat"))
def project_existing(spark, folder):
    df = sales_data(spark, folder, ["order_id", "product_name", "category", "sales"])
    return fl.project_existing(df, ["order_id", "no_such_column", "product_name", "sales"])


@register("select_numeric", over_flat("SELECT row_id, postal_code, sales FROM flat"))
def select_numeric(spark, folder):
    return fl.select_numeric(sales_data(spark, folder, ["row_id", "order_id", "segment", "postal_code", "sales"]))


@register("drop_null_rows", over_raw("SELECT row_id, segment FROM raw WHERE segment IS NOT NULL"))
def drop_null_rows(spark, folder):
    df = raw_orders(spark, folder, ["Row ID", "Segment"]).toDF("row_id", "segment")
    return fl.drop_null_rows(df, ["segment"])


# --- aggregates ------------------------------------------------------------------


@register(
    "kpi_summary",
    over_sales(
        f"SELECT {_REV}, count(*) AS orders, {mean('sales')} AS avg_order, "
        "count(DISTINCT customer_id) AS customers, count(DISTINCT product_name) AS products FROM sales_data"
    ),
)
def kpi_summary(spark, folder):
    return ex.kpi_summary(sales_data(spark, folder, ["sales", "customer_id", "product_name"]))


@register(
    "kpi_summary_filtered",
    over_sales(
        f"SELECT {_REV}, count(*) AS orders, {mean('sales')} AS avg_order, "
        "count(DISTINCT customer_id) AS customers, count(DISTINCT product_name) AS products FROM sales_data "
        "WHERE category = 'ECONOMY' AND region = 'ASIA' AND segment = 'BUILDING' AND order_year = 1998"
    ),
)
def kpi_summary_filtered(spark, folder):
    columns = ["sales", "customer_id", "product_name", "category", "region", "segment", "order_year", "order_date"]
    return ex.kpi_summary(fl.apply_filters(sales_data(spark, folder, columns), CHOICE))


@register(
    "monthly_period_trend",
    over_sales(
        "SELECT order_year AS year, order_month AS month, "
        f"order_year || '-' || lpad(CAST(order_month AS VARCHAR), 2, '0') AS period, {_REV}, "
        "count(sales) AS orders FROM sales_data GROUP BY order_year, order_month"
    ),
)
def monthly_period_trend(spark, folder):
    return ex.monthly_period_trend(sales_data(spark, folder, ["order_year", "order_month", "sales"]))


@register("category_revenue", over_sales(f"SELECT category, {_REV} FROM sales_data GROUP BY category"))
def category_revenue(spark, folder):
    return ex.category_revenue(sales_data(spark, folder, ["category", "sales"]))


@register(
    "region_revenue_share",
    over_sales(
        f"SELECT region, {_REV}, {half_up(total('sales') + f' * 100.0 / (SELECT {total("sales")} FROM sales_data)', 6)} "
        "AS share_pct FROM sales_data GROUP BY region"
    ),
)
def region_revenue_share(spark, folder):
    shares = ex.region_revenue_share(sales_data(spark, folder, ["region", "sales"]))
    return shares.withColumn("share_pct", round_half_up("share_pct", 6))


@register(
    "top_subcategories",
    over_sales(f"SELECT sub_category, {_REV} FROM sales_data GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
)
def top_subcategories(spark, folder):
    return ex.top_subcategories(sales_data(spark, folder, ["sub_category", "sales"]))


@register(
    "segment_revenue",
    over_sales(
        f"SELECT segment, {_REV}, count(sales) AS orders, {mean('sales')} AS avg_order FROM sales_data GROUP BY segment"
    ),
)
def segment_revenue(spark, folder):
    return ex.segment_revenue(sales_data(spark, folder, ["segment", "sales"]))


@register(
    "ship_mode_revenue",
    over_sales(
        f"SELECT ship_mode, {_REV}, CAST(sum(shipping_days) AS DOUBLE) / count(shipping_days) AS avg_days "
        "FROM sales_data GROUP BY ship_mode"
    ),
)
def ship_mode_revenue(spark, folder):
    return ex.ship_mode_revenue(sales_data(spark, folder, ["ship_mode", "sales", "shipping_days"]))


def _rounded(df, *names):
    """To six decimals: engines interpolate a quantile with a different last bit."""
    return df.select(*[round_half_up(c, 6).alias(c) if c in names else F.col(c) for c in df.columns])


_BOX = ("q1", "median", "q3")
_EDGES = ("q1", "q3", "iqr", "lower", "upper")


def _box_sql(value: str, by: str | None) -> tuple[str, str]:
    key, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    join = f"JOIN five USING ({by})" if by else "CROSS JOIN five"
    five = (
        f"five AS (SELECT {key}count({value}) AS count, CAST(min({value}) AS DOUBLE) AS min, "
        f"quantile_cont(CAST({value} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({value} AS DOUBLE), 0.5) AS median, "
        f"quantile_cont(CAST({value} AS DOUBLE), 0.75) AS q3, CAST(max({value}) AS DOUBLE) AS max "
        f"FROM sales_data {group})"
    )
    inside = f"{value} >= q1 - 1.5 * (q3 - q1) AND {value} <= q3 + 1.5 * (q3 - q1)"
    return (
        f"SELECT {key}max(five.count) AS count, max(five.min) AS min, "
        + "".join(f"{half_up(f'max({q})', 6)} AS {q}, " for q in _BOX)
        + "max(five.max) AS max, "
        f"CAST(min({value}) FILTER (WHERE {inside}) AS DOUBLE) AS whisker_low, "
        f"CAST(max({value}) FILTER (WHERE {inside}) AS DOUBLE) AS whisker_high, "
        f"count(*) FILTER (WHERE NOT ({inside})) AS outlier_count FROM sales_data {join} {group}",
        five,
    )


def _over_box(value: str, by: str | None) -> str:
    body, five = _box_sql(value, by)
    return over_sales(body, five)


@register("box_stats", _over_box("shipping_days", "ship_mode"))
def box_stats(spark, folder):
    df = sales_data(spark, folder, ["ship_mode", "shipping_days"])
    return _rounded(ex.box_stats(df, "shipping_days", ["ship_mode"]), *_BOX)


@register("box_stats_overall", _over_box("sales", None))
def box_stats_overall(spark, folder):
    return _rounded(ex.box_stats(sales_data(spark, folder, ["sales"]), "sales"), *_BOX)


def _distribution_sql() -> str:
    body, five = _box_sql("sales", "category")
    extra = (
        f"SELECT b.*, m.mean, b.outlier_count * 100.0::DOUBLE / b.count AS outlier_pct FROM ({body}) b "
        f"JOIN (SELECT category, {mean('sales')} AS mean FROM sales_data GROUP BY category) m USING (category)"
    )
    return over_sales(extra, five)


@register("group_distribution", _distribution_sql())
def group_distribution(spark, folder):
    return _rounded(ex.group_distribution(sales_data(spark, folder, ["category", "sales"])), *_BOX)


def _histogram_sql(source: str, bins: int) -> str:
    return (
        f"SELECT CAST(i AS BIGINT) AS bin, lo + (i - 1) * ((hi - lo) / {bins}) AS bin_low, "
        f"lo + i * ((hi - lo) / {bins}) AS bin_high, CAST(coalesce(n, 0) AS BIGINT) AS count "
        f"FROM range(1, {bins} + 1) t(i) CROSS JOIN (SELECT min(sales) AS lo, max(sales) AS hi FROM {source}) e "
        "LEFT JOIN (SELECT 1 + CAST(least(floor((sales - lo) / "
        f"((hi - lo) / {bins}::DOUBLE)), {bins} - 1) AS BIGINT) AS b, count(*) AS n "
        f"FROM {source} CROSS JOIN (SELECT min(sales) AS lo, max(sales) AS hi FROM {source}) GROUP BY 1) c ON b = i"
    )


@register("histogram", over_flat(_histogram_sql("flat", 80)))
def histogram(spark, folder):
    return ex.histogram(sales_data(spark, folder, ["sales"]))


@register(
    "trimmed_histogram",
    over_flat(
        _histogram_sql("trimmed", 60),
        "trimmed AS (SELECT sales FROM flat WHERE sales < (SELECT quantile_cont(sales, 0.95) FROM flat))",
    ),
)
def trimmed_histogram(spark, folder):
    return ex.trimmed_histogram(sales_data(spark, folder, ["sales"]))


@register(
    "value_counts",
    over_sales("SELECT sales_tier, count(*) AS count FROM sales_data GROUP BY sales_tier"),
)
def value_counts(spark, folder):
    return ex.value_counts(sales_data(spark, folder, ["sales_tier"]))


_NUMERIC = ("sales", "quantity", "postal_code", "order_year", "order_month", "shipping_days")


def _correlation_sql() -> str:
    pairs = "\nUNION ALL\n".join(
        f"SELECT '{x}' AS x, '{y}' AS y, {half_up(f'corr({x}, {y})', 6)} AS r FROM s" for x in _NUMERIC for y in _NUMERIC
    )
    source = (
        "s AS MATERIALIZED (SELECT sales, CASE WHEN row_id % 10 <> 7 THEN quantity END AS quantity, "
        "CASE WHEN CAST(order_id AS BIGINT) % 100 <> 0 THEN postal_code END AS postal_code, "
        "order_year, order_month, shipping_days FROM sales_data)"
    )
    return over_sales(pairs, source)


@register("correlation_matrix", _correlation_sql())
def correlation_matrix(spark, folder):
    """Six numeric columns, two of them with gaps."""
    df = sales_data(spark, folder, ["row_id", "order_id", *_NUMERIC])
    df = df.withColumn("quantity", F.when(F.col("row_id") % 10 != 7, F.col("quantity")))
    gaps = F.when(F.col("order_id").cast("bigint") % 100 != 0, F.col("postal_code"))
    matrix = ex.correlation_matrix(df.withColumn("postal_code", gaps), _NUMERIC)
    return matrix.withColumn("r", round_half_up("r", 6))


_BOUNDS = (
    "b AS (SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM "
    "(SELECT quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.75) AS q3 FROM {s}))"
)
# The prices themselves have no outliers, so both outlier queries look at price per unit.
_UNIT = "u AS (SELECT order_id, customer_name, product_name, category, sales / quantity AS sales FROM flat)"


def _unit_prices(spark, folder):
    df = sales_data(spark, folder, ["order_id", "customer_name", "product_name", "category", "sales", "quantity"])
    return df.withColumn("sales", F.col("sales") / F.col("quantity")).drop("quantity")


@register(
    "iqr_outliers",
    over_flat(
        "SELECT "
        + "".join(f"{half_up(f'max({e})', 6)} AS {e}, " for e in _EDGES)
        + "count(*) AS total_count, count(*) FILTER (WHERE sales < lower OR sales > upper) AS outlier_count, "
        "count(*) FILTER (WHERE sales < lower OR sales > upper) * 100.0::DOUBLE / count(*) AS outlier_pct, "
        "max(sales) FILTER (WHERE sales < lower OR sales > upper) AS max_outlier FROM u CROSS JOIN b",
        _UNIT,
        _BOUNDS.format(v="sales", s="u"),
    ),
)
def iqr_outliers(spark, folder):
    df = sales_data(spark, folder, ["sales", "quantity"])
    prices = df.select((F.col("sales") / F.col("quantity")).alias("sales"))
    return _rounded(ex.iqr_outliers(prices), *_EDGES)


@register(
    "outlier_rows",
    over_flat(
        "SELECT u.* FROM u CROSS JOIN b WHERE sales < lower OR sales > upper",
        _UNIT,
        _BOUNDS.format(v="sales", s="u"),
    ),
)
def outlier_rows(spark, folder):
    return ex.outlier_rows(_unit_prices(spark, folder))


@register(
    "top_outliers",
    over_flat(
        "SELECT u.* FROM u CROSS JOIN b WHERE sales < lower OR sales > upper "
        "ORDER BY sales DESC, order_id, customer_name, product_name, category LIMIT 10",
        _UNIT,
        _BOUNDS.format(v="sales", s="u"),
    ),
)
def top_outliers(spark, folder):
    return ex.top_outliers(_unit_prices(spark, folder))


@register(
    "yoy_growth",
    over_sales(
        "SELECT year, revenue, (revenue / lag(revenue) OVER (ORDER BY year) - 1.0) * 100.0 AS growth_pct FROM "
        f"(SELECT order_year AS year, {_REV} FROM sales_data GROUP BY order_year)"
    ),
)
def yoy_growth(spark, folder):
    return ex.yoy_growth(sales_data(spark, folder, ["order_year", "sales"]))


@register(
    "category_year_trend",
    over_sales(f"SELECT order_year AS year, category, {_REV} FROM sales_data GROUP BY order_year, category"),
)
def category_year_trend(spark, folder):
    return ex.category_year_trend(sales_data(spark, folder, ["order_year", "category", "sales"]))


@register(
    "weekday_month_heatmap",
    over_sales(
        "SELECT order_day_of_week AS day_of_week, "
        + ", ".join(
            f"coalesce(CAST(sum(CAST(sales AS DECIMAL(18,4))) FILTER (WHERE order_month = {m}) AS DOUBLE), 0) "
            f"AS month_{m:02d}"
            for m in range(1, 13)
        )
        + " FROM sales_data GROUP BY order_day_of_week"
    ),
)
def weekday_month_heatmap(spark, folder):
    return ex.weekday_month_heatmap(sales_data(spark, folder, ["order_day_of_week", "order_month", "sales"]))


# --- profiling -------------------------------------------------------------------


def _raw_snake(spark, folder):
    df = raw_orders(spark, folder)
    return df.toDF(*RAW_COLUMNS)


_DTYPES = {c: "string" for c in RAW_COLUMNS} | {
    "row_id": "bigint",
    "postal_code": "bigint",
    "sales": "double",
    "quantity": "double",
}


@register(
    "dataset_overview",
    over_raw(
        "SELECT max(n) AS rows, count(*) AS columns, CAST(sum(n - k) AS BIGINT) AS null_cells, "
        "CAST(sum(n - k) AS DOUBLE) * 100.0 / CAST(max(n) * count(*) AS DOUBLE) AS null_pct FROM ("
        + " UNION ALL ".join(f"SELECT count(*) AS n, count({c}) AS k FROM raw" for c in RAW_COLUMNS)
        + ")"
    ),
)
def dataset_overview(spark, folder):
    return pr.dataset_overview(_raw_snake(spark, folder))


@register(
    "data_quality_profile",
    over_raw(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column, '{_DTYPES[c]}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS null_count, "
            f"(count(*) - count({c})) * 100.0::DOUBLE / count(*) AS null_pct, count(DISTINCT {c}) AS distinct_count, "
            f"count(DISTINCT {c}) * 100.0::DOUBLE / count(*) AS distinct_pct FROM raw"
            for c in RAW_COLUMNS
        )
    ),
)
def data_quality_profile(spark, folder):
    return pr.data_quality_profile(_raw_snake(spark, folder))


@register(
    "missing_by_column",
    over_raw(
        "SELECT * FROM ("
        + "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column, count(*) - count({c}) AS null_count FROM raw" for c in RAW_COLUMNS
        )
        + ") WHERE null_count > 0"
    ),
)
def missing_by_column(spark, folder):
    return pr.missing_columns(_raw_snake(spark, folder))


def _describe_sql() -> str:
    columns = ("row_id", "postal_code", "sales", "quantity")
    return over_raw(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column, count({c}) AS count, {half_up(f'avg({c})')} AS mean, "
            f"{half_up(f'stddev_samp({c})')} AS std, {half_up(f'min({c})')} AS min, "
            + ", ".join(
                f"{half_up(f'quantile_cont(CAST({c} AS DOUBLE), {p})')} AS {n}"
                for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
            )
            + f", {half_up(f'max({c})')} AS max FROM raw"
            for c in columns
        )
    )


@register("describe_numeric", _describe_sql())
def describe_numeric(spark, folder):
    stats = pr.describe_numeric(_raw_snake(spark, folder))
    return stats.select("column", "count", *[round_half_up(c).alias(c) for c in stats.columns[2:]])


_PREVIEW = ["row_id", "order_id", "ship_mode", "customer_id", "product_id", "sales"]


@register("preview", over_flat(f"SELECT {', '.join(_PREVIEW)} FROM flat ORDER BY {', '.join(_PREVIEW)} LIMIT 20"))
def preview(spark, folder):
    return pr.preview(sales_data(spark, folder, _PREVIEW))


# --- samples ---------------------------------------------------------------------

_SCATTER = ["row_id", "category", "sales", "shipping_days"]


@register(
    "bounded_sample",
    over_sales(
        f"SELECT {', '.join(_SCATTER)} FROM sales_data ORDER BY md5(CAST(row_id AS VARCHAR) || ':' || "
        f"CAST(sales AS VARCHAR) || ':42'), {', '.join(_SCATTER)} LIMIT 2000"
    ),
)
def bounded_sample(spark, folder):
    return sm.bounded_sample(sales_data(spark, folder, _SCATTER), ["row_id", "sales"])


def _draw_sql(salt: str, digits: int) -> str:
    return f"CAST('0x' || substr(md5('{salt}:42:' || CAST(id AS VARCHAR)), 1, {digits}) AS BIGINT)"


def _moved_sql(column: str, name: str) -> str:
    days = f"CAST(floor({_draw_sql(name, 13)} / 4503599627370496::DOUBLE * 364) AS INT) + 1"
    return f"strftime(CAST(strptime({column}, '%d/%m/%Y') AS DATE) + ({days}), '%d/%m/%Y') AS \"{name}\""


_DRAWN = {"row_id": "id", "order_id": None, "order_date": None, "ship_date": None, "sales": None}
_RAW_TITLES = {clean: raw for raw, clean in RAW_NAMES.items() if clean != "quantity"}
_NOISE = f"(0.85::DOUBLE + {_draw_sql('sales', 13)} / 4503599627370496::DOUBLE * 0.3::DOUBLE)"


@register(
    "bootstrap_resample",
    over_raw(
        f"SELECT id AS \"{_RAW_TITLES['row_id']}\", substr(order_id, 1, greatest(length(order_id) - 4, 0)) || "
        f"CAST(CAST(floor({_draw_sql('order', 13)} / 4503599627370496::DOUBLE * 8999) AS BIGINT) + 1000 AS VARCHAR) AS \"{_RAW_TITLES['order_id']}\", "
        f"{_moved_sql('order_date', 'Order Date')}, {_moved_sql('ship_date', 'Ship Date')}, "
        f"{half_up(f'sales * {_NOISE}')} AS \"{_RAW_TITLES['sales']}\", "
        + ", ".join(f'{c} AS "{t}"' for c, t in _RAW_TITLES.items() if c not in _DRAWN)
        + f" FROM (SELECT id, {_draw_sql('row', 15)} % (SELECT count(*) FROM raw) AS place "
        f"FROM (SELECT CAST(range + 1 AS BIGINT) AS id FROM range({sm.BOOTSTRAP_ROWS}))) draws JOIN ("
        "SELECT *, row_number() OVER (ORDER BY md5(CAST(row_id AS VARCHAR) || ':42'), "
        + ", ".join(f"{c} NULLS FIRST" for c in _RAW_TITLES)
        + ") - 1 AS place FROM raw) placed USING (place)"
    ),
)
def bootstrap_resample(spark, folder):
    """100,000 raw rows drawn from the whole table."""
    return sm.bootstrap_resample(raw_orders(spark, folder).drop("Quantity"), keys=["Row ID"])
