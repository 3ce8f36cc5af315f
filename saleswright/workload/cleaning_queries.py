"""Registered queries: cleaning, on raw rows with gaps, copies and text dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleswright.functions.numeric import exact_sum
from saleswright.operators import cleaning as cl
from saleswright.plans.sales_table import RAW_NAMES, raw_orders, sales_data
from saleswright.workload.sql import (
    DIGEST_COLUMNS,
    DIGEST_TEXTS,
    RAW_COLUMNS,
    digest,
    mode_of,
    over_clean,
    over_flat,
    over_raw,
)
from saleswright.workspace import stage

QUERIES, SQL = {}, {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


def _raw(spark, folder, *columns):
    raw_names = [raw for raw, clean in RAW_NAMES.items() if clean in columns or not columns]
    df = cl.standardize_columns(raw_orders(spark, folder, raw_names))
    return df.select(*columns) if columns else df


@register("standardize_columns", over_raw(f"SELECT {', '.join(RAW_COLUMNS)} FROM raw"))
def standardize_columns(spark, folder):
    return cl.standardize_columns(raw_orders(spark, folder))


@register("remove_duplicates", over_raw(f"SELECT DISTINCT {', '.join(RAW_COLUMNS)} FROM raw"))
def remove_duplicates(spark, folder):
    return cl.remove_duplicates(_raw(spark, folder))


@register("remove_few_duplicates", over_raw(f"SELECT DISTINCT {', '.join(RAW_COLUMNS)} FROM raw"))
def remove_few_duplicates(spark, folder):
    """By row keys, over the raw table as it lies in files."""
    return cl.remove_few_duplicates(stage(_raw(spark, folder), "raw"))


@register(
    "duplicate_report",
    over_raw(
        "SELECT n AS rows_before, d AS rows_after, n - d AS rows_removed FROM "
        "(SELECT (SELECT count(*) FROM raw) AS n, (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS d)"
    ),
)
def duplicate_report(spark, folder):
    return cl.duplicate_report(_raw(spark, folder))


@register(
    "impute_median",
    over_raw(
        "SELECT row_id, coalesce(CAST(postal_code AS DOUBLE), (SELECT median(postal_code) FROM raw)) AS postal_code, "
        "coalesce(quantity, (SELECT median(quantity) FROM raw)) AS quantity FROM raw"
    ),
)
def impute_median(spark, folder):
    return cl.impute_median(_raw(spark, folder, "row_id", "postal_code", "quantity"))


@register(
    "missing_indicator",
    over_raw(
        "SELECT row_id, postal_code, quantity, CAST(quantity IS NULL AS BIGINT) AS quantity_was_missing FROM raw"
    ),
)
def missing_indicator(spark, folder):
    return cl.missing_indicator(_raw(spark, folder, "row_id", "postal_code", "quantity"))


@register(
    "impute_mode",
    over_raw(f"SELECT row_id, coalesce(segment, {mode_of('segment', 'raw')}) AS segment, ship_mode FROM raw"),
)
def impute_mode(spark, folder):
    return cl.impute_mode(_raw(spark, folder, "row_id", "segment", "ship_mode"))


@register("impute_unknown", over_raw("SELECT row_id, 'Unknown' AS note, segment FROM raw"))
def impute_unknown(spark, folder):
    """A text column without any value becomes ``Unknown``; one with some is left alone."""
    df = _raw(spark, folder, "row_id", "segment").withColumn("note", F.lit(None).cast("string"))
    return cl.impute_unknown(df)


@register(
    "keep_null_dates",
    over_flat(
        "SELECT row_id, CAST(CASE WHEN row_id % 10 <> 3 THEN ship_date END AS VARCHAR) AS ship_date, "
        "coalesce(q, (SELECT median(q) FROM (SELECT CASE WHEN row_id % 10 <> 7 THEN quantity END AS q FROM flat))) "
        "AS quantity, CAST(q IS NULL AS BIGINT) AS quantity_was_missing "
        "FROM (SELECT *, CASE WHEN row_id % 10 <> 7 THEN quantity END AS q FROM flat)"
    ),
)
def keep_null_dates(spark, folder):
    """Gaps in a typed date column stay, while a number column next to it is filled."""
    df = sales_data(spark, folder, ["row_id", "ship_date", "quantity"])
    line = F.col("row_id") % 10
    df = df.withColumns(
        {"ship_date": F.when(line != 3, F.col("ship_date")), "quantity": F.when(line != 7, F.col("quantity"))}
    )
    return cl.impute_missing(df)


@register(
    "impute_missing",
    over_raw(
        "SELECT row_id, order_date, "
        f"coalesce(segment, {mode_of('segment', 'raw')}) AS segment, "
        "coalesce(CAST(postal_code AS DOUBLE), (SELECT median(postal_code) FROM raw)) AS postal_code, sales, "
        "coalesce(quantity, (SELECT median(quantity) FROM raw)) AS quantity, "
        "CAST(quantity IS NULL AS BIGINT) AS quantity_was_missing FROM raw"
    ),
)
def impute_missing(spark, folder):
    columns = ("row_id", "order_date", "segment", "postal_code", "sales", "quantity")
    return cl.impute_missing(_raw(spark, folder, *columns))


@register(
    "null_report",
    over_raw(
        "SELECT c AS column, n - k AS null_count, (n - k) * 100.0::DOUBLE / n AS null_pct, s AS strategy FROM ("
        "SELECT 'segment' AS c, count(*) AS n, count(segment) AS k, 'mode' AS s FROM raw UNION ALL "
        "SELECT 'postal_code', count(*), count(postal_code), 'median' FROM raw UNION ALL "
        "SELECT 'quantity', count(*), count(quantity), 'median + flag' FROM raw)"
    ),
)
def null_report(spark, folder):
    return cl.null_report(_raw(spark, folder))


_GAPS = {"segment": "text", "postal_code": "number", "quantity": "number", "ship_date": "date"}


@register(
    "imputation_report",
    over_raw(
        "SELECT c AS column, CAST(b AS BIGINT) AS missing_before, CAST(a AS BIGINT) AS missing_after, CAST(b - a AS BIGINT) AS filled FROM ("
        "SELECT * FROM gaps WHERE b > 0 UNION ALL SELECT '(all columns)', sum(b), sum(a) FROM gaps)",
        "typed AS (SELECT segment, postal_code, quantity, "
        "CASE WHEN row_id % 10 <> 3 THEN strptime(ship_date, '%d/%m/%Y') END AS ship_date FROM raw)",
        "gaps AS ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS c, count(*) - count({c}) AS b, {f'count(*) - count({c})' if kind == 'date' else '0'} AS a FROM typed"
            for c, kind in _GAPS.items()
        )
        + ")",
    ),
)
def imputation_report(spark, folder):
    """Texts and numbers are filled, a typed date column keeps its gaps."""
    df = _raw(spark, folder, "row_id", "order_date", "segment", "postal_code", "sales", "quantity", "ship_date")
    df = df.withColumn("ship_date", F.when(F.col("row_id") % 10 != 3, F.to_timestamp_ntz("ship_date", F.lit("dd/MM/yyyy"))))
    return cl.imputation_report(df, cl.impute_missing(df))


def _evidence_sql(column: str, text: str) -> str:
    first, second = (f"CAST(regexp_extract({text}, '^([0-9]{{1,2}})[-/.]([0-9]{{1,2}})', {g}) AS INT)" for g in (1, 2))
    day = f"count(*) FILTER ({first} > 12)"
    month = f"count(*) FILTER ({first} <= 12 AND {second} > 12)"
    return (
        f"SELECT '{column}' AS column, {day} AS day_first, {month} AS month_first, "
        f"CAST(CASE WHEN ({day} > 0) <> ({month} > 0) THEN {day} > 0 END AS VARCHAR) AS dayfirst FROM raw"
    )


@register(
    "infer_dayfirst",
    over_raw(
        "\nUNION ALL\n".join(
            (
                _evidence_sql("order_date", "order_date"),
                _evidence_sql("ship_date", "substr(ship_date, 4, 3) || substr(ship_date, 1, 3) || substr(ship_date, 7)"),
                _evidence_sql(
                    "mixed_date",
                    "CASE WHEN row_id % 2 = 0 THEN order_date ELSE "
                    "substr(order_date, 4, 3) || substr(order_date, 1, 3) || substr(order_date, 7) END",
                ),
            )
        )
    ),
)
def infer_dayfirst(spark, folder):
    """A day-first, a month-first and a contradictory column."""

    def swapped(name: str):
        text = F.col(name)
        return F.concat(F.substring(text, 4, 3), F.substring(text, 1, 3), F.substring(text, 7, 4))

    df = _raw(spark, folder, "row_id", "order_date", "ship_date")
    mixed = F.when(F.col("row_id") % 2 == 0, F.col("order_date")).otherwise(swapped("order_date"))
    return cl.dayfirst_report(df.select("order_date", swapped("ship_date").alias("ship_date"), mixed.alias("mixed_date")))


@register(
    "convert_dates",
    over_raw(
        "SELECT row_id, CAST(strptime(order_date, '%d/%m/%Y') AS VARCHAR) AS order_date, "
        "CAST(strptime(ship_date, '%d/%m/%Y') AS VARCHAR) AS ship_date, segment AS width FROM raw"
    ),
)
def convert_dates(spark, folder):
    """Two date columns; one whose name only looks like a date stays text."""
    df = _raw(spark, folder, "row_id", "order_date", "ship_date", "segment")
    return cl.convert_dates(df.withColumnRenamed("segment", "width"))


@register(
    "convert_dates_to_null",
    over_raw(
        "SELECT row_id, CAST(CASE WHEN row_id % 10 <> 5 THEN strptime(order_date, '%d/%m/%Y') END AS VARCHAR) "
        "AS order_date FROM raw"
    ),
)
def convert_dates_to_null(spark, folder):
    """Unreadable values become NULL instead of keeping the whole column as text."""
    df = _raw(spark, folder, "row_id", "order_date")
    junk = F.when(F.col("row_id") % 10 == 5, F.lit("unknown")).otherwise(F.col("order_date"))
    return cl.convert_dates(df.withColumn("order_date", junk), on_error="null")


_CLEAN_SHOWN = (
    *[c for c in RAW_COLUMNS if c not in ("order_date", "ship_date")],
    "order_year", "order_month", "order_month_name", "order_quarter", "order_day_of_week", "shipping_days",
    "sales_tier", "quantity_was_missing",
)


@register(
    "clean_and_transform",
    over_clean(
        f"SELECT {', '.join(_CLEAN_SHOWN)}, CAST(order_date AS VARCHAR) AS order_date, "
        "CAST(ship_date AS VARCHAR) AS ship_date FROM clean"
    ),
)
def clean_and_transform(spark, folder):
    return cl.clean_and_transform(raw_orders(spark, folder))


@register("clean_digest", over_clean(digest("clean")))
def clean_digest(spark, folder):
    """The cleaned table in summary, per year and category."""
    return summary(cl.clean_and_transform(raw_orders(spark, folder)))


def summary(df):
    """The Spark side of ``sql.digest``.

    Orders are counted in an aggregate of their own: beside the others, every order would carry all their buffers
    through the shuffle. Extremes of texts alone would have Spark sort all rows by group; a collected set, of one constant,
    lets it keep the few groups in a hash table.
    """
    shown, groups = df.select(*DIGEST_COLUMNS), ("order_year", "category")
    ordered = shown.where(F.col("order_id").isNotNull()).select(*groups, "order_id").distinct()
    counted = ordered.groupBy(*[F.col(g).alias(f"_{g}") for g in groups]).agg(F.count("*").alias("_orders"))
    texts = []
    for c in DIGEST_TEXTS:
        texts += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.sum(F.length(c)).alias(f"{c}_length")]
    figures = shown.groupBy(*groups).agg(
        F.count("*").alias("row_count"),
        exact_sum("sales").alias("revenue"),
        *texts,
        F.sum("postal_code").cast("double").alias("postal_sum"),
        F.sum("shipping_days").alias("days"),
        F.min("order_date").alias("first_order"),
        F.max("ship_date").alias("last_shipment"),
        F.collect_set(F.lit(1)).alias("_hashed"),
    )
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in groups]
    both = figures.where(F.size("_hashed") > 0).join(counted, same, "left")
    others = [c for c in figures.columns if c not in (*groups, "row_count", "revenue", "_hashed")]
    return both.select(*groups, "row_count", "revenue", F.coalesce("_orders", F.lit(0)).alias("orders"), *others)
