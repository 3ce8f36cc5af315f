"""Steps whose shuffles and passes must not grow faster than the input: what their plans carry, and what they return."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleswright.operators import cleaning as cl
from saleswright.plans import sales_table
from saleswright.sources import files
from saleswright.workload.cleaning_queries import summary
from saleswright.workload.sql import DIGEST_COLUMNS, DIGEST_TEXTS
from saleswright.workspace import stage


def _sales(spark):
    """Lines with repeated rows and gaps in group keys, orders and texts."""
    line, rows = F.col("id"), spark.range(60)
    texts = {c: F.when(line % 11 != 3, F.concat(F.lit(c[:3]), (line % 7).cast("string"))) for c in DIGEST_TEXTS}
    day = F.to_timestamp_ntz(F.lit("2001-05-06"), F.lit("yyyy-MM-dd"))
    return rows.select(
        F.when(line % 13 != 0, (line % 9).cast("string")).alias("order_id"), day.alias("order_date"), day.alias("ship_date"),
        F.when(line % 6 != 1, F.concat(F.lit("c"), (line % 2).cast("string"))).alias("category"),
        F.when(line % 5 != 2, (2000 + line % 3).cast("int")).alias("order_year"), (line * 1.5).alias("sales"),
        (line % 4).alias("postal_code"), (line % 5).cast("int").alias("shipping_days"), *[v.alias(c) for c, v in texts.items()],
    ).select(*DIGEST_COLUMNS)


def test_summary_shuffles_no_buffers_with_orders(spark):
    df = _sales(spark)
    found = summary(df)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "partial_count(distinct" not in plan and "count(distinct" not in plan.lower()
    want = df.groupBy("order_year", "category").agg(
        F.count("*").alias("row_count"), F.count_distinct("order_id").alias("orders"),
        F.min("city").alias("city_min"), F.max("city").alias("city_max"), F.sum(F.length("city")).alias("city_length"),
    )
    columns = want.columns
    assert sorted(map(str, found.select(*columns).collect())) == sorted(map(str, want.collect()))


def test_more_repeated_keys_than_are_sent_move_few_rows(spark, monkeypatch):
    monkeypatch.setattr(cl, "FEW_KEYS", 50)
    line = F.col("id") % 4_900
    value = F.when(line % 7 == 0, F.lit(float("nan"))).otherwise(line.cast("double"))
    df = stage(spark.range(5_000).select(line.alias("a"), F.when(line % 5 != 0, line.cast("string")).alias("c.d"), value.alias("e")), "twice")
    first, second = cl._row_keys(df)
    keyed = df.withColumns({"_key1": first, "_key2": second})
    repeated = keyed.groupBy("_key1", "_key2").count().where("count > 1").select("_key1", "_key2")
    flagged = cl._with_shared_bit(keyed, repeated, repeated.count())
    assert flagged.count() == 5_000 and 200 <= flagged.where("_key_shared").count() < 400
    assert flagged.where("_key_shared").join(repeated, ["_key1", "_key2"]).count() == 200
    out = cl.remove_few_duplicates(df)
    assert sorted(map(str, out.collect())) == sorted(map(str, cl.remove_duplicates(df).collect()))
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_one_number_tells_the_patterns_that_a_value_fits(spark):
    values = [
        "1", " 12 ", "+7", "-0", "\t3\n", "\x0b4\f", "123456789012345678", "1234567890123456789", "9" * 38, "9" * 39, "1.5", "1.", ".5", "-.5e3",
        "1e5", "inf", " -Infinity", "Inf", "true", "True", "TRUE", "tRUE", " true", "true\n", "false", "f", "", " ", "+", ".", "e5", "06/02/1998",
        "5-LOW", "iPad", "Ireland", "total", "\u00a01", "\u0661", "1\u2028", "\x1c1", "1 2", "--1", "0x1", "1d", None,
    ]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    kinds = list(files._TYPE_PATTERNS)
    rows = df.select("v", files._fit(F.col("v")).alias("fit"), *[F.col("v").rlike(p).alias(k) for k, p in files._TYPE_PATTERNS.items()]).collect()
    fits = {0: {0, 1, 2}, 1: {1, 2}, 2: {2}, 3: {3}, 4: set(), None: set()}
    assert len({r["fit"] for r in rows}) == 6
    for r in rows:
        assert {i for i, k in enumerate(kinds) if r[k]} == fits[r["fit"]], r
    for least, most in ((a, b) for a in range(5) for b in range(a, 5)):
        common = fits[least] & fits[most]
        assert files._kind(least, most) == (kinds[min(common)] if common else "string")
    assert files._kind(None, None) == "string"


def test_references_are_not_checked_where_every_table_is_joined(spark, folder, monkeypatch):
    def asked(*_):
        raise AssertionError("the whole table is joined anyway")

    want = sales_table.sales_data(spark, folder, list(sales_table.BASE), skip=False)
    monkeypatch.setattr(sales_table, "references_hold", asked)
    got = sales_table.sales_data(spark, folder, list(sales_table.BASE))
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
    assert sales_table.raw_orders(spark, folder).count() > got.count() > 0
