"""Reports over shared cells, references, date look-ups: against the plain way."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from saleswright.operators import cleaning as cl
from saleswright.operators import exploration as ex
from saleswright.operators import features as fe
from saleswright.plans import reports as rp
from saleswright.plans import sales_table as st

NAN = float("nan")
SALE = "category string, sub_category string, product_name string, segment string, customer_id string, customer_name string, region string, state string, city string, ship_mode string, order_date timestamp_ntz, ship_date timestamp_ntz, sales double"


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def odd_sales(spark):
    day = dt.datetime(2018, 3, 5)
    rows = [
        (None if k % 7 == 0 else f"c{k % 3}", f"s{k % 4}", f"p{k % 5}", f"g{k % 2}", None if k % 11 == 0 else f"u{k % 9}", f"n{k % 9}", f"r{k % 2}",
         None if k % 13 == 0 else f"t{k % 4}", f"y{k % 6}", f"m{k % 3}", day + dt.timedelta(days=k * 9), day + dt.timedelta(days=k * 9 + k % 5),
         NAN if k % 10 == 0 else None if k % 10 == 1 else 10.25 * (k % 17) - 20)
        for k in range(240)
    ]
    return fe.engineer_features(spark.createDataFrame(rows, SALE))


@pytest.mark.parametrize("key", list(rp.REPORTS))
def test_cells_give_the_report(odd_sales, key):
    report = rp.REPORTS[key]
    direct = odd_sales.groupBy(*[F.col(s).alias(n) for n, s in report.keys.items()]).agg(*[m().alias(a) for a, m in report.aggregates.items()])
    want = rows_of(report._finished(direct, [F.col(n) for n in report.keys]))
    family = next((f for f in rp.FAMILIES if key in f), (key,))
    assert rows_of(report.from_cells(rp.cells_of(odd_sales, [rp.REPORTS[k] for k in family]))) == want == rows_of(report.run(odd_sales))


def test_together_as_one_by_one(spark, folder, odd_sales):
    given = lambda columns: st.sales_data(spark, folder, columns)
    for sales in (given, odd_sales, odd_sales.limit(0)):
        together, alone = rp.plan_together(sales), rp.plan_reports(sales)
        assert list(together) == list(alone)
        assert all(rows_of(together[k]) == rows_of(alone[k]) for k in alone)


def test_a_missing_column_fails_only_its_reports(odd_sales):
    planned = rp.plan_together(odd_sales.drop("ship_mode", "city"))
    failed = {k for k, v in planned.items() if isinstance(v, rp.Failure)}
    assert failed == {"shipping_mode_analysis", "region_performance", "top_10_cities"}


def test_four_passes_over_the_lines(spark, folder):
    scans = []

    def sales(columns):
        scans.append(columns)
        return st.sales_data(spark, folder, columns)

    planned = rp.plan_together(sales)
    assert len(scans) == 4 and len(planned) == 15
    for df in planned.values():
        assert not any("lineitem" in f for f in df.inputFiles())


def test_distinct_counts_copy_no_lines(odd_sales):
    mode = odd_sales.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    for df in (rp.REPORTS["region_performance"].run(odd_sales), ex.kpi_summary(odd_sales)):
        assert "Expand" not in df._jdf.queryExecution().explainString(mode)


def test_nan_is_missing(spark):
    df = spark.createDataFrame([("a", 10.0), ("a", 20.0), ("a", NAN), ("b", NAN)], "category string, sales double")
    got = {r["category"]: (r["order_count"], r["total_revenue"], r["avg_order_value"]) for r in rp.REPORTS["category_performance"].run(df).collect()}
    assert got == {"a": (3, 30.0, 15.0), "b": (1, None, None)}
    total = rp.REPORTS["total_revenue_summary"].run(df).first()
    assert (total.min_sale, total.max_sale, total.std_dev_sales) == (10.0, 20.0, 5.0)
    assert [r.sales_tier for r in fe.sales_tier(df).where("isnan(sales)").collect()] == ["Unknown"] * 2


def test_an_orphan_line_is_in_no_report(spark, folder, tmp_path):
    for name in ("orders", "customer", "nation", "region", "part", "lineitem"):
        df = spark.read.parquet(f"{folder}/{name}.parquet")
        if name == "lineitem":
            df = df.union(df.limit(1).withColumn("l_partkey", F.lit(-5).cast(df.schema["l_partkey"].dataType)))
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    found = {r.reference: (r.orphans, r.repeated) for r in st.reference_check(spark, str(tmp_path)).collect()}
    assert found == {"order": (0, 0), "part": (1, 0), "customer": (0, 0), "nation": (0, 0), "region": (0, 0)}
    assert st.references_hold(spark, folder) and not st.references_hold(spark, str(tmp_path))
    for columns in (["sales"], ["sales_tier", "sales"], ["order_year"]):
        assert st.sales_data(spark, str(tmp_path), columns).count() == st.sales_data(spark, folder, columns).count()


@pytest.mark.parametrize("texts", [200_000, 0])
def test_dates_by_look_up_and_by_parsing(spark, monkeypatch, texts):
    monkeypatch.setattr(cl, "DICTIONARY_TEXTS", texts)
    rows = [("15/04/2018", "04/15/2018", "x"), ("01/02/2018", None, "y"), (None, "2018-04-03 10:00:00", None), ("15/04/2018", "04/15/2018", "x")]
    out = cl.convert_dates(spark.createDataFrame(rows, "`order date` string, ship_date string, width_dt string"))
    assert dict(out.dtypes) == {"order date": "timestamp_ntz", "ship_date": "timestamp_ntz", "width_dt": "string"}
    day = dt.datetime
    assert sorted(rows_of(out), key=str) == sorted([
        (day(2018, 4, 15), day(2018, 4, 15), "x"), (day(2018, 2, 1), None, "y"), (None, day(2018, 4, 3, 10), None), (day(2018, 4, 15), day(2018, 4, 15), "x"),
    ], key=str)


def test_open_orders_are_counted_and_may_stop_the_run(spark):
    df = spark.createDataFrame([("13/01/2018", 1.0), ("01/13/2018", 2.0), ("01/13/2018", 3.0)], "order_date string, sales double")
    (reading,) = cl.date_readings(df)
    assert (reading.day_first, reading.month_first, reading.unread, reading.dayfirst) == (1, 2, 0, None)
    with pytest.raises(ValueError, match="1 values are day first, 2 month first"):
        cl.clean_and_transform(df, on_ambiguous="error")
