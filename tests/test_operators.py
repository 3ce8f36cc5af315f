"""Edge cases of reports, exploration, profiling and samples; plan shapes."""

from __future__ import annotations

import datetime as dt
import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from saleswright.operators import exploration as ex
from saleswright.operators import filters as fl
from saleswright.operators import profiling as pr
from saleswright.operators import sampling as sm
from saleswright.workspace import stage
from saleswright.plans import reports as rp
from saleswright.plans.sales_table import raw_orders, sales_data

# Columns of each report.
REPORT_COLUMNS = {
    "total_revenue_summary": "total_orders, total_revenue, avg_order_value, min_sale, max_sale, std_dev_sales",
    "monthly_revenue_trend": "year, month, month_name, order_count, total_revenue, avg_order_value",
    "quarterly_revenue": "year, quarter, order_count, total_revenue, avg_order_value",
    "yearly_revenue": "year, total_orders, total_revenue, avg_order_value",
    "category_performance": "category, order_count, total_revenue, avg_order_value, revenue_share_pct",
    "subcategory_performance": "category, sub_category, order_count, total_revenue, avg_order_value",
    "top_10_products": "product_name, category, sub_category, times_ordered, total_revenue",
    "segment_analysis": "segment, unique_customers, total_orders, total_revenue, avg_order_value, revenue_per_customer",
    "top_10_customers": "customer_id, customer_name, segment, total_orders, total_revenue, avg_order_value",
    "region_performance": "region, states_covered, cities_covered, total_orders, total_revenue, avg_order_value",
    "top_10_states": "state, region, total_orders, total_revenue, avg_order_value",
    "top_10_cities": "city, state, region, total_orders, total_revenue, avg_order_value",
    "shipping_mode_analysis": "ship_mode, total_orders, total_revenue, avg_order_value, avg_shipping_days",
    "day_of_week_analysis": "day_of_week, total_orders, total_revenue, avg_order_value",
    "sales_tier_distribution": "sales_tier, order_count, total_revenue, avg_order_value, min_sale, max_sale",
}


@pytest.fixture(scope="module")
def planned(spark, folder):
    return rp.plan_reports(partial(sales_data, spark, folder))


def test_report_columns(planned):
    assert {k: ", ".join(df.columns) for k, df in planned.items()} == REPORT_COLUMNS


@pytest.mark.parametrize(
    "key",
    ["category_performance", "region_performance", "segment_analysis", "shipping_mode_analysis", "day_of_week_analysis",
     "sales_tier_distribution", "monthly_revenue_trend", "quarterly_revenue", "yearly_revenue"],
)
def test_parts_add_up(planned, key):
    whole = planned["total_revenue_summary"].first()
    rows = planned[key].collect()
    count = "order_count" if "order_count" in planned[key].columns else "total_orders"
    assert sum(r[count] for r in rows) == whole.total_orders
    assert sum(r.total_revenue for r in rows) == pytest.approx(whole.total_revenue, abs=0.05)


def test_report_order(planned):
    for key, report in rp.REPORTS.items():
        rows = planned[key].collect()
        if report.order and report.order[0][1]:
            values = [r[report.order[0][0]] for r in rows]
            assert values == sorted(values, reverse=True)
    tiers = [r.sales_tier for r in planned["sales_tier_distribution"].collect()]
    assert tiers == ["Low", "Medium", "High", "Premium"]


def test_tiers_do_not_overlap(planned):
    rows = planned["sales_tier_distribution"].collect()
    assert all(a.max_sale < b.min_sale for a, b in zip(rows, rows[1:]))


def _sales(spark, rows):
    return spark.createDataFrame(rows, "category string, sales double")


def test_null_keys_missing_sales_and_ties(spark):
    df = _sales(spark, [("b", 1.0), ("a", 1.0), (None, 2.5), ("a", None)])
    report = rp.Report("r", "r", {"category": "category"}, (rp.rows("n"), rp.REVENUE, rp.MEAN_ORDER), (("total_revenue", True),))
    assert [tuple(r) for r in report.run(df).collect()] == [
        (None, 1, 2.5, 2.5),
        ("a", 2, 1.0, 1.0),
        ("b", 1, 1.0, 1.0),
    ]


def test_empty_input(spark):
    df = _sales(spark, [])
    row = rp.REPORTS["total_revenue_summary"].run(df).first()
    assert (row.total_orders, row.total_revenue, row.avg_order_value) == (0, None, None)
    assert rp.REPORTS["category_performance"].run(df).count() == 0
    out = ex.iqr_outliers(df).first()
    assert (out.outlier_count, out.outlier_pct) == (0, None)
    assert pr.dataset_overview(df).first().null_pct is None
    assert sm.bounded_sample(df, ["category"]).count() == 0


def test_deviation_of_population_or_sample(spark):
    df = _sales(spark, [("a", 1.0), ("a", 3.0)])
    pop, samp = (df.agg(*[m().alias("_std") for m in rp.deviation(d).aggregates.values()]).first()[0] for d in (0, 1))
    assert (pop, samp) == (1.0, pytest.approx(2**0.5))


def test_collation_merges_spellings(spark):
    df = _sales(spark, [("Été", 1.0), ("ete", 2.0), ("zoo", 4.0)])
    report = rp.REPORTS["category_performance"]
    assert len(report.run(df).collect()) == 3
    merged = report.run(df, collation="UNICODE_CI_AI").collect()
    assert [(r.category, r.order_count, r.total_revenue) for r in merged] == [("zoo", 1, 4.0), ("ete", 2, 3.0)]


def test_money_is_exact_and_rounded_half_up(spark):
    from saleswright.functions.numeric import exact_sum, round_half_up

    df = spark.range(100000).select(F.lit(0.1).alias("x"))
    assert df.agg(exact_sum("x")).first()[0] == 10000.0
    big = spark.range(4000).select(F.lit(9.0e11).alias("x"))
    assert big.agg(exact_sum("x")).first()[0] == 3.6e15
    cases = spark.createDataFrame([(0.125,), (-0.125,), (2.0,), (-0.001,)], "x double")
    assert [r[0] for r in cases.select(round_half_up("x")).collect()] == [0.13, -0.13, 2.0, 0.0]


def test_failed_report_does_not_stop_others(spark):
    df = _sales(spark, [("a", 1.0)])
    done = rp.run_all_reports(spark, rp.plan_reports(df)).collect()
    by_key = {r.report: r for r in done}
    assert len(done) == 15 and by_key["category_performance"].rows == 1
    assert by_key["top_10_cities"].error and by_key["top_10_cities"].rows is None


def test_views_and_headings(planned):
    views = rp.report_views(planned)
    assert views["top_10_customers"].columns[0] == "customer_name"
    assert views["category_performance"].count() <= 5
    assert rp.display_name("avg_order_value") == "Avg Order Value"


def test_filters(spark):
    df = spark.createDataFrame([("A", 2018), ("B", 2018), ("A", 2017)], "category string, order_year int")
    assert fl.apply_filters(df, fl.SalesFilter()).count() == 3
    assert fl.apply_filters(df, fl.SalesFilter(category="A", year="2018", region="no such column")).count() == 1
    options = [tuple(r) for r in fl.filter_options(df).collect()]
    assert options == [("category", "All"), ("category", "A"), ("category", "B"), ("year", "All"), ("year", "2017"), ("year", "2018")]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.0,), (5.0,), (None,)], "sales double")
    counts = {r.bin: r["count"] for r in ex.histogram(df, bins=10).collect()}
    assert (counts[1], counts[6], counts[10], sum(counts.values())) == (1, 1, 2, 4)
    same = spark.createDataFrame([(3.0,)] * 4, "sales double")
    assert [r["count"] for r in ex.histogram(same, bins=3).collect()] == [4, 0, 0]


def test_correlation(spark):
    rows = [(1, 2, 5.0), (2, 4, 5.0), (3, 7, 5.0), (None, 9, 5.0), (5, None, 5.0)]
    df = spark.createDataFrame(rows, "a int, b int, c double")
    r = {(x.x, x.y): x.r for x in ex.correlation_matrix(df).collect()}
    assert r["a", "b"] == r["b", "a"] == pytest.approx(0.9933992677987827)
    assert r["a", "a"] == 1.0 and r["a", "c"] is None and r["c", "c"] is None
    assert len(r) == 9


def test_correlation_merges_sets_of_known_columns(spark):
    draw = random.Random(4)
    rows = []
    for k in range(400):
        a = 1e6 + draw.random()
        row = [a, 3 * a + draw.random(), draw.gauss(0, 1), 0.1, float(k)]
        rows.append([None if draw.random() < 0.3 else float("nan") if draw.random() < 0.1 else x for x in row[:4]] + [row[4] if row[2] < 0 else None])
    df = spark.createDataFrame(rows, "a double, b double, `c.d` double, e double, f double").repartition(5)
    got = {(x.x, x.y): x.r for x in ex.correlation_matrix(df).collect()}
    frame = df.toPandas()
    want = frame.corr(min_periods=1)
    for x in frame.columns:
        for y in frame.columns:
            if "e" in (x, y):
                assert got[x, y] is None
            else:
                assert got[x, y] == pytest.approx(want.loc[x, y], abs=1e-8) and got[x, y] == got[y, x]
    never = spark.createDataFrame([(1.0, None), (None, 2.0), (3.0, None)], "a double, b double")
    assert {(x.x, x.y): x.r for x in ex.correlation_matrix(never).collect()} == {("a", "a"): 1.0, ("a", "b"): None, ("b", "a"): None, ("b", "b"): None}
    assert [x.r for x in ex.correlation_matrix(never.limit(0)).collect()] == [None] * 4


def test_yoy_growth(spark):
    # Revenue of four years and its growth to two decimals.
    revenue = {2015: 479856.21, 2016: 459436.01, 2017: 600192.55, 2018: 722052.02}
    df = spark.createDataFrame(list(revenue.items()), "order_year int, sales double")
    growth = [r.growth_pct for r in ex.yoy_growth(df).collect()]
    assert growth[0] is None and [round(g, 2) for g in growth[1:]] == [-4.26, 30.64, 20.30]
    assert fl.drop_null_rows(ex.yoy_growth(df), ["growth_pct"]).count() == 3
    zero = spark.createDataFrame([(1, 0.0), (2, 5.0)], "order_year int, sales double")
    assert [r.growth_pct for r in ex.yoy_growth(zero).collect()] == [None, None]


def test_heatmap_order(spark, folder):
    df = sales_data(spark, folder, ["order_day_of_week", "order_month", "sales"])
    days = [r.day_of_week for r in ex.weekday_month_heatmap(df).collect()]
    assert days == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def test_quality_profile(spark):
    df = spark.createDataFrame(
        [(0.0, "a", None), (-0.0, "a", None), (float("nan"), None, None)], "x double, s string, `odd name.` string"
    )
    rows = {r.column: r for r in pr.data_quality_profile(df).collect()}
    assert (rows["x"].distinct_count, rows["x"].null_count, rows["s"].non_null) == (1, 1, 2)
    assert (rows["odd name."].distinct_count, rows["odd name."].null_pct) == (0, 100.0)
    near = {r.column: r.distinct_count for r in pr.data_quality_profile(df.select("s"), exact=False).collect()}
    assert near == {"s": 1}


def test_bounded_sample(spark):
    df = spark.range(20000).withColumn("v", F.col("id") % 7).repartition(6)
    a = sm.bounded_sample(df, ["id"], 500).collect()
    b = sm.bounded_sample(df.repartition(3), ["id"], 500).collect()
    assert a == b and len({r.id for r in a}) == 500
    assert sm.bounded_sample(df, ["id"], 500, seed=1).collect() != a
    assert sm.bounded_sample(df.limit(10), ["id"], 500).count() == 10
    # One key on a third of all rows.
    hot = df.withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    want = hot.orderBy(F.md5(F.concat_ws(":", "k", F.lit("42")).cast("binary")), "id", "v", "k").limit(8000)
    assert sm.bounded_sample(hot, ["k"], 8000).collect() == want.collect()


def test_bootstrap(spark, folder):
    raw = raw_orders(spark, folder)
    n = 3000
    out = sm.bootstrap_resample(raw, n).cache()
    assert out.columns == raw.columns
    ids = [r[0] for r in out.select("Row ID").collect()]
    assert sorted(ids) == list(range(1, n + 1))
    low, high = raw.agg(F.min("Sales"), F.max("Sales")).first()
    assert out.where((F.col("Sales") < low * 0.85 - 0.01) | (F.col("Sales") > high * 1.15 + 0.01)).count() == 0
    assert out.where(~F.col("Order Date").rlike(r"^\d{2}/\d{2}/\d{4}$")).count() == 0
    assert out.where(F.col("Order Date").isNull()).count() == 0
    assert out.where(~F.expr("right(`Order ID`, 4)").cast("int").between(1000, 9998)).count() == 0
    assert out.select("Customer ID").distinct().count() > 20
    again = sm.bootstrap_resample(raw, n)
    assert out.exceptAll(again).count() == 0
    joined = sm.bootstrap_resample(raw.limit(7), 50)
    assert joined.count() == 50


def test_bootstrap_draws_do_not_depend_on_partitions(spark, folder):
    """The same rows in another order and partitioning, and joined the other way, give the same draws."""
    raw = stage(raw_orders(spark, folder), "raw")
    few, before = sorted(map(str, sm.bootstrap_resample(raw, 500).collect())), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert few == sorted(map(str, sm.bootstrap_resample(raw.repartition(5, "Customer ID").orderBy(F.desc("Sales")), 500).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_drawn_rows_are_those_at_their_places(spark):
    """Against plain ranks: copies, NULLs, a key that a third of the rows share, one row, no rows."""
    import hashlib

    rows = [(i % 7 if i % 3 else 0, None if i % 5 == 0 else f"t{i % 11}") for i in range(200)] + [(None, None)] * 3
    for data, keys in ((rows, None), (rows, ["k"]), (rows[:1], None)):
        df = spark.createDataFrame(data, "k bigint, t string").repartition(3)
        used = [0, 1] if keys is None else [0]

        def place(row):
            text = ":".join(["" if row[i] is None else str(row[i]) for i in used] + ["42"])
            return hashlib.md5(text.encode()).hexdigest(), *[(v is not None, v) for v in row]

        def number(i):
            return int(hashlib.md5(f"row:42:{i}".encode()).hexdigest()[:15], 16)

        ordered = sorted(data, key=lambda r: tuple(e if isinstance(e, str) else (e[0], e[1] if e[0] else 0) for e in place(r)))
        want = {i: ordered[number(i) % len(data)] for i in range(1, 301)}
        assert {r["_id"]: (r.k, r.t) for r in sm.drawn_rows(df, 300, keys=keys).collect()} == want
    assert sm.drawn_rows(spark.createDataFrame([], "k bigint, t string"), 10).count() == 0


# --- plan shapes -----------------------------------------------------------------


def _plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_no_query_leaves_the_jvm_or_builds_a_product(spark, folder):
    from saleswright.workload import cleaning_queries, exploration_queries, report_queries

    eager = ("bootstrap_resample", "clean_digest", "run_all_reports")
    areas = (report_queries, exploration_queries, cleaning_queries)
    QUERIES = {n: q for area in areas for n, q in area.QUERIES.items() if n not in eager}
    for name in QUERIES:
        plan = _plan(QUERIES[name](spark, folder))
        for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
            assert node not in plan, (name, node)


@pytest.mark.parametrize("key", ["top_10_products", "top_10_customers", "top_10_states", "top_10_cities", "subcategory_performance"])
def test_rankings_use_top_k(planned, key):
    assert "TakeOrderedAndProject" in _plan(planned[key])


def test_scans_are_pruned(planned):
    plan = _plan(planned["total_revenue_summary"])
    assert "orders.parquet" not in plan and "ReadSchema: struct<l_extendedprice:double>" in plan
    assert "part.parquet" not in _plan(planned["region_performance"])
    assert "customer.parquet" not in _plan(planned["yearly_revenue"])


def test_filters_reach_the_scan(spark, folder):
    df = sales_data(spark, folder, ["sales", "region", "order_year", "order_date"])
    plan = _plan(fl.apply_filters(df, fl.SalesFilter(region="ASIA", year=1998)))
    assert "EqualTo(r_name,ASIA)" in plan
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)" in plan


def test_aggregates_combine_before_the_shuffle(planned):
    plan = _plan(planned["category_performance"])
    assert "partial_sum" in plan


def test_date_filter_keeps_edges(spark):
    rows = [(dt.datetime(2018, 1, 1), 2018), (dt.datetime(2018, 12, 31, 23, 59), 2018), (dt.datetime(2019, 1, 1), 2019)]
    df = spark.createDataFrame(rows, "order_date timestamp_ntz, order_year int")
    assert fl.apply_filters(df, fl.SalesFilter(year=2018)).count() == 2
