"""Hand-made edge cases of cleaning and features."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saleswright.functions.dates import parse_timestamp
from saleswright.operators import cleaning as cl
from saleswright.operators import features as fe
from saleswright.workspace import stage


@pytest.mark.parametrize(
    ("raw", "clean"),
    [(" Sub-Category ", "sub_category"), ("Price ($)/Unit", "price_unit"), ("A--B", "a_b"), ("Größe", "größe")],
)
def test_names(raw, clean):
    assert cl.standardized_name(raw) == clean


@given(st.text(max_size=30))
def test_names_are_stable(name):
    once = cl.standardized_name(name)
    assert "__" not in once and once.strip("_") == once
    assert all(c == "_" or c.isalnum() or not c.isascii() for c in once)


def test_name_collision_names_both(spark):
    with pytest.raises(ValueError, match=r"'A B', 'A-B'"):
        cl.standardize_columns(spark.createDataFrame([(1, 2)], "`A B` int, `A-B` int"))


def test_duplicates_treat_null_and_nan_as_equal(spark):
    df = spark.createDataFrame([(None, float("nan"))] * 2, "a string, b double")
    assert cl.remove_duplicates(df).count() == 1
    assert cl.duplicate_report(df).first().asDict() == {"rows_before": 2, "rows_after": 1, "rows_removed": 1}


def _numbers(spark, n, nulls):
    return spark.createDataFrame([(None if i < nulls else i,) for i in range(n)], "x int")


def test_five_percent_is_flagged(spark):
    df = cl.impute_missing(_numbers(spark, 20, 1))
    assert df.columns == ["x", "x_was_missing"]
    rows = df.orderBy(F.desc("x_was_missing")).collect()
    assert (rows[0].x, rows[0].x_was_missing, sum(r.x_was_missing for r in rows)) == (10.0, 1, 1)


def test_below_five_percent_is_not(spark):
    df = cl.impute_missing(_numbers(spark, 100, 4))
    assert df.columns == ["x"] and df.where("x IS NULL").count() == 0


def test_all_null_number_stays_null_but_flagged(spark):
    df = cl.impute_missing(spark.createDataFrame([(None,)] * 3, "x double"))
    assert [tuple(r) for r in df.collect()] == [(None, 1)] * 3


def test_nan_counts_as_missing(spark):
    df = cl.impute_missing(spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double"))
    assert sorted(tuple(r) for r in df.collect()) == [(1.0, 0), (2.0, 1), (3.0, 0)]


def test_mode_tie_takes_smallest(spark):
    df = cl.impute_missing(spark.createDataFrame([("b",), ("a",), (None,)], "x string"))
    assert sorted(r.x for r in df.collect()) == ["a", "a", "b"]


def test_all_null_text_is_unknown(spark):
    df = cl.impute_missing(spark.createDataFrame([(None, True), (None, None)], "x string, y boolean"))
    assert [tuple(r) for r in df.collect()] == [("Unknown", True)] * 2


def test_typed_dates_keep_nulls(spark):
    df = cl.impute_missing(spark.sql("SELECT CAST(NULL AS DATE) d UNION ALL SELECT DATE'2020-01-01'"))
    assert df.where("d IS NULL").count() == 1


def test_null_report(spark):
    df = spark.createDataFrame([(None, None, "a", None)] + [(1, "x", "a", None)] * 9, "n int, t string, full string, none string")
    got = {r.column: (r.null_count, r.null_pct, r.strategy) for r in cl.null_report(df).collect()}
    assert got == {"n": (1, 10.0, "median + flag"), "t": (1, 10.0, "mode"), "none": (10, 100.0, "unknown")}


@pytest.mark.parametrize(
    ("values", "expected"),
    [
        (["15/04/2018"], True),
        (["04/15/2018"], False),
        (["15/04/2018", "04/15/2018"], None),
        (["2017-11-08"], None),
        (["08/11/2017"], None),
        (["08/11/2017", None, "13.01.2018"], True),
        ([], None),
    ],
)
def test_infer_dayfirst(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "d string")
    assert cl.infer_dayfirst(df, "d") is expected
    assert cl.dayfirst_report(df, ["d"]).first().dayfirst is expected


def test_evidence_agrees_with_the_numbers(spark):
    """The patterns mean: first number above 12, else second number above 12."""
    pairs = [(a, b) for a in [*range(0, 35), 99] for b in [*range(0, 35), 99]]
    texts = [(a, b, s) for a, b in pairs for s in (f"{a}/{b}/2018", f"{a:02d}-{b:02d}-2018")]
    df = spark.createDataFrame(texts, "a int, b int, t string")
    from saleswright.functions.dates import DAY_THEN_NUMBER, MONTH_THEN_DAY

    t = F.col("t")
    wrong = df.where(
        (t.rlike(DAY_THEN_NUMBER) != (F.col("a") > 12))
        | (t.rlike(MONTH_THEN_DAY) != ((F.col("a") <= 12) & (F.col("b") > 12)))
    )
    assert wrong.collect() == []


def test_convert_dates(spark, monkeypatch):
    df = spark.createDataFrame([("08/11/2017",), ("15/04/2018",), (None,)], "order_date string")
    out = cl.convert_dates(df)
    assert dict(out.dtypes)["order_date"] == "timestamp_ntz"
    assert {r.order_date for r in out.collect()} == {dt.datetime(2017, 11, 8), dt.datetime(2018, 4, 15), None}
    open_order = df.limit(1)
    assert cl.convert_dates(open_order).first().order_date == dt.datetime(2017, 8, 11)
    monkeypatch.setenv("SALES_DAYFIRST", "true")
    assert cl.convert_dates(open_order).first().order_date == dt.datetime(2017, 11, 8)


def test_junk_keeps_text_or_becomes_null(spark):
    df = spark.createDataFrame([("08/11/2017",), ("junk",)], "order_date string")
    assert dict(cl.convert_dates(df).dtypes)["order_date"] == "string"
    kept = cl.convert_dates(df, on_error="null").where("order_date IS NOT NULL")
    assert kept.count() == 1


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_mixed_formats(spark, zone):
    cases = {
        "15/04/2018": dt.datetime(2018, 4, 15),
        "04/15/2018": dt.datetime(2018, 4, 15),
        "8.11.2017 14:05": dt.datetime(2017, 11, 8, 14, 5),
        "11-03-2018 02:30:00": dt.datetime(2018, 3, 11, 2, 30),
        "2017-11-08T01:02:03": dt.datetime(2017, 11, 8, 1, 2, 3),
        "2017/11/08": dt.datetime(2017, 11, 8),
        "15/04/18": dt.datetime(2018, 4, 15),
        "2017.11.08": dt.datetime(2017, 11, 8),
        "1a/02/2018": None,
        "ab-cd-efgh": None,
        " 1/02/2018": dt.datetime(2018, 2, 1),
        "15-04-99": dt.datetime(1999, 4, 15),
        "8 November 2017": dt.datetime(2017, 11, 8),
        "Nov 8, 2017": dt.datetime(2017, 11, 8),
        "31/31/2018": None,
        "BUILDING": None,
        "12345": None,
        "": None,
    }
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = df.select("t", parse_timestamp(F.col("t"), dayfirst=True).alias("p")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert {r.t: r.p for r in rows} == cases


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_shipping_days_round_down(spark, zone):
    df = spark.sql(
        "SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2017-11-08 01:00', TIMESTAMP_NTZ'2017-11-07 23:00'), "
        "(2, TIMESTAMP_NTZ'2018-03-10 12:00', TIMESTAMP_NTZ'2018-03-11 12:00'), "
        "(3, TIMESTAMP_NTZ'2018-03-10 12:00', TIMESTAMP_NTZ'2018-03-13 11:59:59'), "
        "(4, NULL, TIMESTAMP_NTZ'2018-03-13') t(id, order_date, ship_date)"
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = {r.id: r.shipping_days for r in fe.shipping_days(df).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == {1: -1, 2: 1, 3: 2, 4: None}


def test_quartiles_and_tiers(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "sales double")
    assert tuple(fe.sales_quartiles(df).first()) == (1.75, 2.5, 3.25)
    edges = spark.createDataFrame([(10.0,), (20.0,), (30.0,), (30.5,), (None,)], "sales double")
    got = [r.sales_tier for r in fe.sales_tier(edges, [10.0, 20.0, 30.0]).orderBy(F.asc_nulls_last("sales")).collect()]
    assert got == ["Low", "Medium", "High", "Premium", "Unknown"]
    lazily = {r.sales: r.sales_tier for r in fe.sales_tier(df).collect()}
    assert lazily == {1.0: "Low", 2.0: "Medium", 3.0: "High", 4.0: "Premium"}


def _raw(spark, extra=0):
    rows = [(i, f"{i % 28 + 1:02d}/0{i % 9 + 1}/2018", float(i), "A" if i % 3 else None) for i in range(1, 60)]
    df = spark.createDataFrame(rows + rows[:5], "`Row ID` int, `Order Date` string, `Sales` double, `Seg ment` string")
    return df.withColumns({f"Extra {i}": F.when(F.col("Row ID") > 3, F.col("Row ID")) for i in range(extra)})


def test_clean_is_idempotent_on_clean_data(spark):
    once = cl.clean_and_transform(_raw(spark))
    again = cl.clean_and_transform(once)
    assert again.columns == once.columns
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))
    assert once.count() == 59 and once.where("seg_ment IS NULL").count() == 0


def test_dates_first_leaves_missing_dates_null(spark):
    df = spark.createDataFrame([("15/04/2018",), ("16/04/2018",), ("16/04/2018",), (None,)], "`Order Date` string").withColumn(
        "id", F.monotonically_increasing_id()
    )
    assert cl.clean_and_transform(df).where("order_date IS NULL").count() == 0
    assert cl.clean_and_transform(df, dates_first=True).where("order_date IS NULL").count() == 1


def _jobs(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_jobs_do_not_grow_with_columns(spark):
    few, many = _raw(spark, 1), _raw(spark, 12)
    a = _jobs(spark, "few", lambda: cl.clean_and_transform(few))
    b = _jobs(spark, "many", lambda: cl.clean_and_transform(many))
    assert 0 < b <= a + 1


def test_empty_table(spark):
    out = cl.clean_and_transform(_raw(spark).where("false"))
    assert out.count() == 0 and "sales_tier" in out.columns


# --- duplicates by row key ---------------------------------------------------------


def _shuffled(spark, df):
    """Bytes that running ``df`` writes for shuffles."""
    store, gateway = spark._jsc.sc().statusStore(), spark.sparkContext._gateway

    def total():
        stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = total()
    df().write.format("noop").mode("overwrite").save()
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    return total() - before


def test_few_duplicates(spark, monkeypatch):
    """NULL, NaN, -0.0 and values in other columns; keys that collide; more repeated keys than may be sent."""
    nan = float("nan")
    rows = [("a", None, 1.0), (None, "a", 1.0), ("a", None, 1.0), ("a", "a", nan), ("a", "a", nan), ("", None, 0.0), ("", None, -0.0), (None, None, None)]
    df = spark.createDataFrame(rows * 2 + [("x", "y", float(i)) for i in range(50)], "a string, b string, `c.d` double").repartition(4)
    want = sorted(map(repr, cl.remove_duplicates(df).collect()))
    assert len(want) == 55

    def got():
        out = cl.remove_few_duplicates(df)
        assert out.columns == df.columns
        return sorted(repr(r).replace("-0.0", "0.0") for r in out.collect())

    want = [w.replace("-0.0", "0.0") for w in want]
    assert got() == sorted(want)
    with monkeypatch.context() as patch:
        patch.setattr(cl, "_row_keys", lambda df: [F.length(F.coalesce("a", F.lit(""))) % 2, F.lit(7)])
        assert got() == sorted(want)
    monkeypatch.setattr(cl, "FEW_KEYS", 2)
    assert got() == sorted(want)
    assert cl.remove_few_duplicates(df.limit(0)).count() == 0


def test_few_duplicates_move_few_bytes(spark):
    wide = stage(
        spark.range(20_000).select(*[F.md5(F.concat_ws(":", F.col("id") % 19_900, F.lit(i))).alias(f"c{i}") for i in range(8)]), "wide"
    )
    whole = _shuffled(spark, lambda: cl.remove_duplicates(wide))
    few = _shuffled(spark, lambda: cl.remove_few_duplicates(wide))
    assert 0 < few < whole / 3
