"""The fifteen sales reports as declarations, and what is built on them.

A report states its keys, measures, order and limit; one builder turns that into a
DataFrame plan. So every report shares the same rules: rows are counted with
``count(*)``, NULL keys are a group, money is summed exactly and rounded half up,
shares and ratios use unrounded sums, and ties in a ranking are broken by the keys.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saleswright.functions.jobs import side_by_side
from saleswright.functions.numeric import known_count, known_value, round_half_up, sum_of_parts, sum_parts
from saleswright.functions.quantiles import COUNT, quantile_edges, value_table
from saleswright.functions.rows import literal_rows
from saleswright.operators.features import QUARTILES, tier_of
from saleswright.operators.filters import project_existing
from saleswright.workspace import stage

log = logging.getLogger(__name__)


_SALE = known_value("sales")


@dataclass(frozen=True)
class Aggregate:
    """An aggregate over order lines, and the same over cells: sums that groups of lines were reduced to.

    ``parts`` are the columns of a cell that it needs, as SQL over lines; ``merged`` is SQL over cells.
    """

    direct: str
    parts: dict[str, str]
    merged: str

    def __call__(self) -> Column:
        return F.expr(self.direct)


@dataclass(frozen=True)
class Measure:
    """Aggregates to compute per group, and the reported value made from them."""

    name: str
    inputs: tuple[str, ...]
    aggregates: dict[str, Aggregate]
    value: Callable[[], Column]
    counted: str | None = None  # the column whose distinct values are counted


def _added(direct: str, part: str, merge: str = "sum") -> Aggregate:
    return Aggregate(direct, {part: direct}, f"{merge}({part})")


def rows(name: str) -> Measure:
    return Measure(name, (), {"_rows": _added("count(*)", "_rows")}, lambda: F.col("_rows"))


def distinct(name: str, column: str) -> Measure:
    key = f"_distinct_{column}"
    counted = Aggregate(f"count(DISTINCT `{column}`)", {}, f"count_if(_first_{column})")
    return Measure(name, (column,), {key: counted}, lambda: F.col(key), column)


_KNOWN = {"_known": _added(known_count("sales"), "_known")}
_PARTS = sum_parts("sales", "_l")


def _total(known: str, parts: list[str]) -> str:
    return f"CASE WHEN {known} > 0 THEN {sum_of_parts(parts)} END"


_SUM = {
    "_sum": Aggregate(
        _total(known_count("sales"), list(_PARTS.values())),
        {"_known": known_count("sales"), **_PARTS},
        _total("sum(_known)", [f"sum({c})" for c in _PARTS]),
    )
}

REVENUE = Measure("total_revenue", ("sales",), _SUM, lambda: round_half_up("_sum"))
MEAN_ORDER = Measure(
    "avg_order_value",
    ("sales",),
    {**_SUM, **_KNOWN},
    lambda: round_half_up("try_divide(_sum, _known)"),
)
SMALLEST = Measure("min_sale", ("sales",), {"_min": _added(f"min({_SALE})", "_min", "min")}, lambda: round_half_up("_min"))
LARGEST = Measure("max_sale", ("sales",), {"_max": _added(f"max({_SALE})", "_max", "max")}, lambda: round_half_up("_max"))
# The share is a window over one row per group.
SHARE = Measure(
    "revenue_share_pct",
    ("sales",),
    _SUM,
    lambda: round_half_up("try_divide(_sum * 100D, sum(_sum) OVER ())"),
)
PER_CUSTOMER = Measure(
    "revenue_per_customer",
    ("sales", "customer_id"),
    {**_SUM, **distinct("", "customer_id").aggregates},
    lambda: round_half_up("try_divide(_sum, _distinct_customer_id)"),
    "customer_id",
)
SHIPPING = Measure(
    "avg_shipping_days",
    ("shipping_days",),
    {"_days": _added("sum(shipping_days)", "_days"), "_shipped": _added("count(shipping_days)", "_shipped")},
    lambda: round_half_up("try_divide(CAST(_days AS DOUBLE), _shipped)", 1),
)
#: How parts add up that are no sums. A mean and a variance don't, so a deviation is no measure of a report with distinct counts.
_MERGES = {"_min": "min", "_max": "max"}
#: The mean of all cells, near which deviations of cells from each other are taken.
_CENTRE = "sum(_known * _mean) / sum(_known)"


def deviation(ddof: int = 0) -> Measure:
    within, between = "sum(_known * _var) + sum(_known * power(_mean - _centre, 2))", "power(sum(_known * (_mean - _centre)), 2) / sum(_known)"
    merged = f"CASE WHEN sum(_known) > {ddof} THEN sqrt(greatest(0D, {within} - {between}) / (sum(_known) - {ddof})) END"
    parts = {"_known": known_count("sales"), "_mean": f"avg({_SALE})", "_var": f"var_pop({_SALE})"}
    std = Aggregate(f"{'stddev_samp' if ddof else 'stddev_pop'}({_SALE})", parts, merged)
    return Measure("std_dev_sales", ("sales",), {"_std": std}, lambda: round_half_up("_std"))


@dataclass(frozen=True)
class Report:
    """One report: ``keys`` maps output names to sales-table columns."""

    key: str
    title: str
    keys: dict[str, str]
    measures: tuple[Measure, ...]
    order: tuple[tuple[str, bool], ...] = ()  # (output column, descending)
    limit: int | None = None

    @property
    def inputs(self) -> list[str]:
        """The sales-table columns the report reads."""
        read = [*self.keys.values(), *[c for m in self.measures for c in m.inputs]]
        return list(dict.fromkeys(read))

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *[m.name for m in self.measures]]

    @property
    def aggregates(self) -> dict[str, Aggregate]:
        return {alias: made for m in self.measures for alias, made in m.aggregates.items()}

    @property
    def counted(self) -> list[str]:
        """The columns whose distinct values a measure counts."""
        return list(dict.fromkeys(m.counted for m in self.measures if m.counted))

    def run(self, sales: DataFrame, collation: str | None = None) -> DataFrame:
        """The report over a sales table.

        With a ``collation`` (e.g. ``UNICODE_CI_AI``) text keys that it considers
        equal are one group, shown by their smallest spelling. Several distinct counts go
        through cells of one pass instead of copies of every line.
        """
        if len(self.counted) > 1 and not collation:
            return self.from_cells(cells_of(sales, [self]))
        keys = {name: F.col(source) for name, source in self.keys.items()}
        shown: dict[str, Column] = {}
        if collation:
            for name, source in self.keys.items():
                if sales.schema[source].dataType.typeName() == "string":
                    keys[name] = F.collate(F.col(source), collation)
                    shown[f"_shown_{name}"] = F.min(F.col(source))
        grouped = sales.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(
            *[make().alias(alias) for alias, make in self.aggregates.items()],
            *[c.alias(n) for n, c in shown.items()],
        )
        return self._finished(grouped, [F.col(f"_shown_{n}" if f"_shown_{n}" in shown else n).alias(n) for n in self.keys])

    def from_cells(self, cells: DataFrame) -> DataFrame:
        """The report over cells (``cells_of``) whose keys include its own. The lines aren't read."""
        sources = list(self.keys.values())
        if any("_centre" in x.merged for x in self.aggregates.values()):
            cells = cells.withColumn("_centre", cells.agg(F.expr(_CENTRE)).scalar())
        kept = list(dict.fromkeys((*sources, *self.counted)))
        if self.counted and set(cells_keys(cells)) - set(kept):
            # first as few cells as the distinct counts need
            parts = dict.fromkeys(c for x in self.aggregates.values() for c in x.parts)
            cells = cells.groupBy(*kept).agg(*[F.expr(f"{_MERGES.get(c, 'sum')}({c})").alias(c) for c in parts])
        for c in self.counted:  # one cell of each distinct value stands for it
            others = [x for x in kept if x not in (*sources, c)]
            place = Window.partitionBy(*[F.col(f"`{x}`") for x in (*sources, c)]).orderBy(*others or [F.lit(0)])
            cells = cells.withColumn(f"_first_{c}", (F.row_number().over(place) == 1) & F.col(f"`{c}`").isNotNull())
        grouped = cells.groupBy(*[F.col(source).alias(n) for n, source in self.keys.items()]).agg(
            *[F.expr(made.merged).alias(alias) for alias, made in self.aggregates.items()]
        )
        if not self.keys and "_rows" in grouped.columns:  # no cells, no lines
            grouped = grouped.withColumn("_rows", F.coalesce("_rows", F.lit(0)))
        return self._finished(grouped, [F.col(n) for n in self.keys])

    def _finished(self, grouped: DataFrame, labels: list[Column]) -> DataFrame:
        """The reported values of the groups, in the report's order."""
        df = grouped.select(*labels, *[m.value().alias(m.name) for m in self.measures])
        if self.keys:
            # a figure that is missing comes last either way
            rising = {c: F.asc(c) if c in self.keys else F.asc_nulls_last(c) for c, _ in self.order}
            ranked = [F.desc(c) if down else rising[c] for c, down in self.order]
            ties = [F.asc(k) for k in self.keys if k not in {c for c, _ in self.order}]
            df = df.orderBy(*ranked, *ties)
        return df.limit(self.limit) if self.limit else df


def cells_keys(cells: DataFrame) -> list[str]:
    """The key columns of cells: what does not begin with an underscore."""
    return [c for c in cells.columns if not c.startswith("_")]


def cells_of(sales: DataFrame, reports: Iterable[Report]) -> DataFrame:
    """The lines reduced to one row per combination of all keys and counted columns of ``reports``, in one pass.

    A row holds what every aggregate needs, as parts that add up: counts, whole units of exact
    sums, least and largest, mean and variance, shipping days. So reports over cells are equal to reports over lines to the last digit
    (the deviation to rounding).
    """
    reports = list(reports)
    keys = dict.fromkeys(c for r in reports for c in (*r.keys.values(), *r.counted))
    parts = {c: x for r in reports for made in r.aggregates.values() for c, x in made.parts.items()}
    return sales.groupBy(*keys).agg(*[F.expr(x).alias(c) for c, x in parts.items()])


_BY_REVENUE = (("total_revenue", True),)
_ORDERS = rows("total_orders")
_COUNT = rows("order_count")


def _ranked(key: str, title: str, keys: Iterable[str], *measures: Measure, limit: int | None = None) -> Report:
    return Report(key, title, {k: k for k in keys}, measures, _BY_REVENUE, limit)


def _periodic(key: str, title: str, keys: dict[str, str], count: Measure) -> Report:
    parts = tuple((k, False) for k in keys if k != "month_name")
    return Report(key, title, keys, (count, REVENUE, MEAN_ORDER), parts)


_YEAR = {"year": "order_year"}
_MONTH = {"month": "order_month", "month_name": "order_month_name"}

_ALL = (
    Report(
        "total_revenue_summary",
        "Totals over all orders",
        {},
        (_ORDERS, REVENUE, MEAN_ORDER, SMALLEST, LARGEST, deviation()),
    ),
    _periodic("monthly_revenue_trend", "Revenue by month", {**_YEAR, **_MONTH}, _COUNT),
    _periodic("quarterly_revenue", "Revenue by quarter", {**_YEAR, "quarter": "order_quarter"}, _COUNT),
    _periodic("yearly_revenue", "Revenue by year", _YEAR, _ORDERS),
    _ranked("category_performance", "Categories", ["category"], _COUNT, REVENUE, MEAN_ORDER, SHARE),
    _ranked(
        "subcategory_performance",
        "Leading sub-categories",
        ["category", "sub_category"],
        _COUNT,
        REVENUE,
        MEAN_ORDER,
        limit=15,
    ),
    _ranked(
        "top_10_products",
        "Leading products",
        ["product_name", "category", "sub_category"],
        rows("times_ordered"),
        REVENUE,
        limit=10,
    ),
    _ranked(
        "segment_analysis",
        "Customer segments",
        ["segment"],
        distinct("unique_customers", "customer_id"),
        _ORDERS,
        REVENUE,
        MEAN_ORDER,
        PER_CUSTOMER,
    ),
    _ranked(
        "top_10_customers",
        "Leading customers",
        ["customer_id", "customer_name", "segment"],
        _ORDERS,
        REVENUE,
        MEAN_ORDER,
        limit=10,
    ),
    _ranked(
        "region_performance",
        "Regions",
        ["region"],
        distinct("states_covered", "state"),
        distinct("cities_covered", "city"),
        _ORDERS,
        REVENUE,
        MEAN_ORDER,
    ),
    _ranked("top_10_states", "Leading states", ["state", "region"], _ORDERS, REVENUE, MEAN_ORDER, limit=10),
    _ranked(
        "top_10_cities", "Leading cities", ["city", "state", "region"], _ORDERS, REVENUE, MEAN_ORDER, limit=10
    ),
    _ranked("shipping_mode_analysis", "Shipping modes", ["ship_mode"], _ORDERS, REVENUE, MEAN_ORDER, SHIPPING),
    Report(
        "day_of_week_analysis",
        "Weekdays",
        {"day_of_week": "order_day_of_week"},
        (_ORDERS, REVENUE, MEAN_ORDER),
        _BY_REVENUE,
    ),
    Report(
        "sales_tier_distribution",
        "Price tiers",
        {"sales_tier": "sales_tier"},
        (_COUNT, REVENUE, MEAN_ORDER, SMALLEST, LARGEST),
        (("avg_order_value", False),),
    ),
)

REPORTS: dict[str, Report] = {r.key: r for r in _ALL}


def run_report(key: str, sales: DataFrame, **options) -> DataFrame:
    return REPORTS[key].run(sales, **options)


@dataclass(frozen=True)
class Failure:
    """A report that could not be planned, and why."""

    error: str


def plan_reports(
    sales: DataFrame | Callable[[list[str]], DataFrame], registry: dict[str, Report] | None = None
) -> dict[str, DataFrame | Failure]:
    """Every report as a lazy DataFrame; one that fails does not stop the others.

    ``sales`` is a table, or a function that provides the columns a report reads.
    Each report scans only those columns, which is less to read than one cached
    copy of the whole table would be to write.
    """
    planned: dict[str, DataFrame | Failure] = {}
    for key, report in (REPORTS if registry is None else registry).items():
        try:
            planned[key] = report.run(sales(report.inputs) if callable(sales) else sales)
        except Exception as error:  # reported per report, see run_all_reports
            log.error("report %s failed: %s", key, error)
            planned[key] = Failure(str(error).splitlines()[0])
    return planned


#: Reports that share cells: their keys come from the same dimension, so there are no more cells than days, customers or products.
FAMILIES = (
    (
        "total_revenue_summary", "monthly_revenue_trend", "quarterly_revenue", "yearly_revenue", "shipping_mode_analysis",
        "day_of_week_analysis",
    ),
    ("category_performance", "subcategory_performance", "top_10_products"),
    ("segment_analysis", "top_10_customers", "region_performance", "top_10_states", "top_10_cities"),
)


def _tier_report(report: Report, sales: DataFrame) -> DataFrame:
    """A report by price tier from a value table: edges, tiers and sums come from one pass over the prices."""
    values = value_table(sales, "sales")
    edges = quantile_edges(values, "sales", QUARTILES, COUNT)
    parts = {"_rows": f"sum({COUNT})", "_known": known_count("sales", COUNT), **sum_parts("sales", "_l", COUNT)}
    tiered = values.withColumn("sales_tier", tier_of(F.col("sales"), [edges[i] for i in range(3)]))
    cells = tiered.groupBy("sales_tier").agg(
        *[F.expr(x).alias(c) for c, x in parts.items()], F.min("sales").alias("_min"), F.max("sales").alias("_max")
    )
    return report.from_cells(cells)


def plan_together(
    sales: DataFrame | Callable[[list[str]], DataFrame], registry: dict[str, Report] | None = None
) -> dict[str, DataFrame | Failure]:
    """All reports over shared cells: one pass over the lines per family, whose cells are kept, and one over the prices.

    The tiers are those of the prices at hand if ``sales`` is a function; a table brings its own. Reports of no family, and
    those of a family that fails as a whole, are planned one by one as by ``plan_reports``.
    """
    reports = REPORTS if registry is None else registry
    planned: dict[str, DataFrame | Failure] = {}
    for family in FAMILIES:
        members = [reports[k] for k in family if k in reports and reports[k] is REPORTS[k]]
        inputs = list(dict.fromkeys(c for r in members for c in r.inputs))
        try:
            cells = stage(cells_of(sales(inputs) if callable(sales) else sales, members), "cells") if members else None
        except Exception as error:  # each report then tells by itself
            log.warning("no shared cells for %s: %s", ", ".join(r.key for r in members), str(error).splitlines()[0])
            continue
        planned |= {r.key: r.from_cells(cells) for r in members}
    tiers = reports.get("sales_tier_distribution")
    if callable(sales) and tiers is not None and tiers is REPORTS[tiers.key]:
        planned[tiers.key] = _tier_report(tiers, sales(["sales"]))
    rest = plan_reports(sales, {k: r for k, r in reports.items() if k not in planned})
    return {k: planned.get(k, rest.get(k)) for k in reports}


def compute_reports(spark: SparkSession, planned: dict[str, DataFrame | Failure]) -> dict[str, DataFrame | Failure]:
    """Every report computed once, in full, and kept on shared storage in its order.

    Counts, exports, headlines and views read the kept rows. A report that fails while
    running, in any of its measures, is a ``Failure`` like one that could not be planned.
    """

    def finish(entry: tuple[str, DataFrame | Failure]) -> tuple[str, DataFrame | Failure]:
        key, result = entry
        if isinstance(result, Failure):
            return key, result
        try:
            return key, stage(result.coalesce(1), key)
        except Exception as error:
            log.error("report %s failed: %s", key, error)
            return key, Failure(str(error).splitlines()[0])

    return dict(side_by_side(spark, finish, planned.items()))


def report_outcomes(spark: SparkSession, computed: dict[str, DataFrame | Failure]) -> DataFrame:
    """``(report, rows, error)``: how each computed report turned out."""
    outcome = [
        (key, None, result.error) if isinstance(result, Failure) else (key, result.count(), None)
        for key, result in computed.items()
    ]
    return literal_rows(spark, {"report": "string", "rows": "bigint", "error": "string"}, outcome)


def run_all_reports(spark: SparkSession, planned: dict[str, DataFrame | Failure]) -> DataFrame:
    """``(report, rows, error)`` after computing every planned report in full."""
    return report_outcomes(spark, compute_reports(spark, planned))


# The headline figures, as (metric, report, column) of a report's first row.
HEADLINES = (
    ("total_orders", "total_revenue_summary", "total_orders"),
    ("total_revenue", "total_revenue_summary", "total_revenue"),
    ("avg_order_value", "total_revenue_summary", "avg_order_value"),
    ("max_sale", "total_revenue_summary", "max_sale"),
    ("top_category", "category_performance", "category"),
    ("top_category_revenue", "category_performance", "total_revenue"),
    ("top_category_share_pct", "category_performance", "revenue_share_pct"),
    ("top_region", "region_performance", "region"),
    ("top_region_revenue", "region_performance", "total_revenue"),
    ("top_region_cities", "region_performance", "cities_covered"),
    ("top_customer", "top_10_customers", "customer_name"),
    ("top_customer_revenue", "top_10_customers", "total_revenue"),
    ("top_customer_orders", "top_10_customers", "total_orders"),
)


def headline_metrics(planned: dict[str, DataFrame | Failure]) -> DataFrame:
    """``(metric, text, number)`` from the first rows of four reports."""
    parts = []
    for key in dict.fromkeys(report for _, report, _ in HEADLINES):
        result = planned.get(key)
        if result is None or isinstance(result, Failure):
            continue
        kinds = dict(result.dtypes)
        entries = [
            F.struct(
                F.lit(metric).alias("metric"),
                (F.col(c) if kinds[c] == "string" else F.lit(None)).cast("string").alias("text"),
                (F.lit(None) if kinds[c] == "string" else F.col(c)).cast("double").alias("number"),
            )
            for metric, report, c in HEADLINES
            if report == key
        ]
        parts.append(result.limit(1).select(F.inline(F.array(*entries))))
    if not parts:
        raise ValueError("none of the headline reports is there")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


# Columns and row caps of the printed summary, per report.
VIEWS = {
    "total_revenue_summary": (
        ("total_orders", "total_revenue", "avg_order_value", "min_sale", "max_sale", "std_dev_sales"),
        1,
    ),
    "category_performance": (("category", "order_count", "total_revenue", "revenue_share_pct"), 5),
    "region_performance": (
        ("region", "states_covered", "cities_covered", "total_orders", "total_revenue"),
        5,
    ),
    "segment_analysis": (
        ("segment", "unique_customers", "total_orders", "total_revenue", "avg_order_value", "revenue_per_customer"),
        5,
    ),
    "top_10_customers": (
        ("customer_name", "segment", "total_orders", "total_revenue", "avg_order_value"),
        10,
    ),
    "shipping_mode_analysis": (
        ("ship_mode", "total_orders", "total_revenue", "avg_order_value", "avg_shipping_days"),
        None,
    ),
    "top_10_products": (("product_name", "category", "times_ordered", "total_revenue"), 10),
}


def display_name(column: str) -> str:
    """A column heading: words with capitals."""
    return column.replace("_", " ").title()


def report_views(planned: dict[str, DataFrame | Failure]) -> dict[str, DataFrame]:
    """The column and row subsets that the printed summary shows."""
    views = {}
    for key, (columns, cap) in VIEWS.items():
        result = planned.get(key)
        if result is None or isinstance(result, Failure):
            continue
        shown = project_existing(result, columns)
        views[key] = shown.limit(cap) if cap else shown
    return views
