"""Registered queries: features and reports."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from saleswright.functions.numeric import round_half_up
from saleswright.operators import features as fe
from saleswright.plans.reports import (
    REPORTS,
    headline_metrics,
    plan_reports,
    plan_together,
    run_all_reports,
)
from saleswright.plans.sales_table import REFERENCES, reference_check, sales_data
from saleswright.sinks import exports
from saleswright.workload.sql import AOV, FLAT, REV, features, half_up, over_flat, over_sales, total
from saleswright.workspace import stage

QUERIES, SQL = {}, {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


# --- features --------------------------------------------------------------------

_CALENDAR_SQL = {
    "order_year": "CAST(year(order_date) AS BIGINT)",
    "order_month": "CAST(month(order_date) AS BIGINT)",
    "order_month_name": "strftime(order_date, '%B')",
    "order_quarter": "CAST(quarter(order_date) AS BIGINT)",
    "order_day_of_week": "strftime(order_date, '%A')",
}


def _calendar(spark, folder, name):
    return getattr(fe, name)(sales_data(spark, folder, ["order_id", "order_date"]))


for _name, _sql in _CALENDAR_SQL.items():
    register(_name, over_flat(f"SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, {_sql} AS {_name} FROM flat"))(
        partial(_calendar, name=_name)
    )


@register(
    "shipping_days",
    over_flat(
        "SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, CAST(ship_date AS VARCHAR) AS ship_date, "
        "CAST(floor((epoch(ship_date) - epoch(order_date)) / 86400) AS BIGINT) AS shipping_days FROM flat"
    ),
)
def shipping_days(spark, folder):
    return fe.shipping_days(sales_data(spark, folder, ["order_id", "order_date", "ship_date"]))


@register(
    "sales_quartiles",
    over_flat(
        "SELECT "
        + ", ".join(f"{half_up(f'quantile_cont(sales, {p})', 6)} AS q{i}" for i, p in ((1, 0.25), (2, 0.5), (3, 0.75)))
        + " FROM flat"
    ),
)
def sales_quartiles(spark, folder):
    # To six decimals: engines interpolate a quantile with a different last bit.
    q = fe.sales_quartiles(sales_data(spark, folder, ["sales"]))
    return q.select(*[round_half_up(c, 6).alias(c) for c in q.columns])


@register("sales_tier", over_sales("SELECT order_id, sales, sales_tier FROM sales_data"))
def sales_tier(spark, folder):
    return fe.sales_tier(sales_data(spark, folder, ["order_id", "sales"]))


@register(
    "engineer_features",
    over_sales(
        "SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, CAST(ship_date AS VARCHAR) AS ship_date, sales, "
        "order_year, order_month, order_month_name, order_quarter, order_day_of_week, shipping_days, sales_tier "
        "FROM sales_data"
    ),
)
def engineer_features(spark, folder):
    return fe.engineer_features(sales_data(spark, folder, ["order_id", "order_date", "ship_date", "sales"]))


# --- reports ---------------------------------------------------------------------


def cells_sql(parts: dict[str, str]) -> str:
    """All cells of ordered results: a number where the text is one, else the text."""
    return "\nUNION ALL\n".join(
        f"SELECT '{k}' AS report, row, \"column\", try_cast(value AS DOUBLE) AS number, "
        "CASE WHEN try_cast(value AS DOUBLE) IS NULL THEN value END AS text FROM "
        f"(SELECT row, COLUMNS(* EXCLUDE (row))::VARCHAR FROM (SELECT row_number() OVER () AS row, * FROM ({s}))) "
        'UNPIVOT INCLUDE NULLS (value FOR "column" IN (COLUMNS(* EXCLUDE (row))))'
        for k, s in parts.items()
    )


def report_cells(results):
    number = F.col("value").try_cast("double")
    return exports.report_book(results).select(
        "report", "row", "column", number.alias("number"), F.when(number.isNull(), F.col("value")).alias("text")
    )


def _group(keys: str, measures: str, order: str, limit: int | None = None) -> str:
    names = ", ".join(k.split(" AS ")[0] for k in keys.split(", "))
    tail = f" LIMIT {limit}" if limit else ""
    return f"SELECT {keys}, {measures} FROM sales_data GROUP BY {names} ORDER BY {order}{tail}"


_CNT, _ORD = "count(*) AS order_count", "count(*) AS total_orders"
_YEAR = "order_year AS year"
_SHARE = half_up(f"{total('sales')} * 100.0 / (SELECT {total('sales')} FROM sales_data)")

REPORT_SQL = {
    "total_revenue_summary": (
        f"SELECT {_ORD}, {REV}, {AOV}, {half_up('min(sales)')} AS min_sale, {half_up('max(sales)')} AS max_sale, "
        f"{half_up('stddev_pop(sales)')} AS std_dev_sales FROM sales_data"
    ),
    "monthly_revenue_trend": _group(
        f"{_YEAR}, order_month AS month, order_month_name AS month_name", f"{_CNT}, {REV}, {AOV}", "1, 2"
    ),
    "quarterly_revenue": _group(f"{_YEAR}, order_quarter AS quarter", f"{_CNT}, {REV}, {AOV}", "1, 2"),
    "yearly_revenue": _group(_YEAR, f"{_ORD}, {REV}, {AOV}", "1"),
    "category_performance": _group(
        "category", f"{_CNT}, {REV}, {AOV}, {_SHARE} AS revenue_share_pct", "total_revenue DESC, category"
    ),
    "subcategory_performance": _group(
        "category, sub_category", f"{_CNT}, {REV}, {AOV}", "total_revenue DESC, category, sub_category", 15
    ),
    "top_10_products": _group(
        "product_name, category, sub_category",
        f"count(*) AS times_ordered, {REV}",
        "total_revenue DESC, product_name, category, sub_category",
        10,
    ),
    "segment_analysis": _group(
        "segment",
        f"count(DISTINCT customer_id) AS unique_customers, {_ORD}, {REV}, {AOV}, "
        f"{half_up(total('sales') + ' / count(DISTINCT customer_id)')} AS revenue_per_customer",
        "total_revenue DESC, segment",
    ),
    "top_10_customers": _group(
        "customer_id, customer_name, segment",
        f"{_ORD}, {REV}, {AOV}",
        "total_revenue DESC, customer_id, customer_name, segment",
        10,
    ),
    "region_performance": _group(
        "region",
        f"count(DISTINCT state) AS states_covered, count(DISTINCT city) AS cities_covered, {_ORD}, {REV}, {AOV}",
        "total_revenue DESC, region",
    ),
    "top_10_states": _group("state, region", f"{_ORD}, {REV}, {AOV}", "total_revenue DESC, state, region", 10),
    "top_10_cities": _group(
        "city, state, region", f"{_ORD}, {REV}, {AOV}", "total_revenue DESC, city, state, region", 10
    ),
    "shipping_mode_analysis": _group(
        "ship_mode",
        f"{_ORD}, {REV}, {AOV}, "
        f"{half_up('CAST(sum(shipping_days) AS DOUBLE) / count(shipping_days)', 1)} AS avg_shipping_days",
        "total_revenue DESC, ship_mode",
    ),
    "day_of_week_analysis": _group(
        "order_day_of_week AS day_of_week", f"{_ORD}, {REV}, {AOV}", "total_revenue DESC, day_of_week"
    ),
    "sales_tier_distribution": _group(
        "sales_tier",
        f"{_CNT}, {REV}, {AOV}, {half_up('min(sales)')} AS min_sale, {half_up('max(sales)')} AS max_sale",
        "avg_order_value, sales_tier",
    ),
}


def _report(spark, folder, key):
    report = REPORTS[key]
    return report.run(sales_data(spark, folder, report.inputs))


for _key, _sql in REPORT_SQL.items():
    register(_key, over_sales(_sql))(partial(_report, key=_key))


def planned(spark, folder):
    return plan_reports(partial(sales_data, spark, folder))


def planned_together(spark, folder):
    """All reports over shared cells."""
    return plan_together(partial(sales_data, spark, folder))


@register(
    "run_all_reports",
    over_sales(
        "\nUNION ALL\n".join(
            f"SELECT '{k}' AS report, count(*) AS rows, CAST(NULL AS VARCHAR) AS error FROM ({s})"
            for k, s in REPORT_SQL.items()
        )
    ),
)
def all_reports(spark, folder):
    return run_all_reports(spark, planned_together(spark, folder))


def _headline_sql() -> str:
    def first(key: str, metric: str, column: str, text: bool) -> str:
        t, n = (column, "NULL") if text else ("NULL", column)
        return (
            f"SELECT '{metric}' AS metric, CAST({t} AS VARCHAR) AS text, CAST({n} AS DOUBLE) AS number "
            f"FROM (SELECT * FROM ({REPORT_SQL[key]}) LIMIT 1)"
        )

    parts = [
        first("total_revenue_summary", m, m, False)
        for m in ("total_orders", "total_revenue", "avg_order_value", "max_sale")
    ]
    for name, key, label, figures in (
        ("category", "category_performance", "category", {"revenue": "total_revenue", "share_pct": "revenue_share_pct"}),
        ("region", "region_performance", "region", {"revenue": "total_revenue", "cities": "cities_covered"}),
        ("customer", "top_10_customers", "customer_name", {"revenue": "total_revenue", "orders": "total_orders"}),
    ):
        parts.append(first(key, f"top_{name}", label, True))
        parts += [first(key, f"top_{name}_{m}", c, False) for m, c in figures.items()]
    return over_sales("\nUNION ALL\n".join(parts))


@register("headline_metrics", _headline_sql())
def headlines(spark, folder):
    return headline_metrics(planned(spark, folder))


@register(
    "reference_check",
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS reference, count(*) AS rows, count(*) FILTER (NOT EXISTS (SELECT 1 FROM {other} WHERE {other_key} = {key})) AS orphans, "
        f"(SELECT count(*) FROM (SELECT {other_key} FROM {other} WHERE {other_key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS repeated FROM {table}"
        for name, (table, key, other, other_key) in REFERENCES.items()
    ),
)
def references(spark, folder):
    """How many lines, orders and places refer to nothing, or to something ambiguous."""
    return reference_check(spark, folder)


# --- missing sales -----------------------------------------------------------------

_GAPS = "gaps AS (SELECT * REPLACE (CASE WHEN row_id % 13 <> 0 THEN sales END AS sales) FROM flat)"


def over_gaps(body: str) -> str:
    return f"WITH {FLAT}, {_GAPS}, sales_data AS ({features('gaps')})\n{body}"


@register("reports_with_gaps", over_gaps(cells_sql(REPORT_SQL)))
def reports_with_gaps(spark, folder):
    """Every cell of all reports where every 13th line's price is not a number."""
    columns = dict.fromkeys(c for r in REPORTS.values() for c in r.inputs if c != "sales_tier")
    sales = sales_data(spark, folder, [*columns, "row_id"])
    price = F.when(F.col("row_id") % 13 == 0, F.lit(float("nan"))).otherwise(F.col("sales"))
    # written once: the tiers and each family of reports scan their columns of it, instead of joining all tables again
    gaps = stage(sales.withColumn("sales", price).drop("row_id"), "with_gaps")
    return report_cells(plan_together(fe.sales_tier(gaps)))
