"""Registered queries: sources and sinks, on files Spark writes from the given tables.

Every query writes below the shared work folder, reads back and summarises what it
read, so that a value lost or changed on the way would show.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from saleswright.functions.numeric import exact_sum
from saleswright.operators.filters import SalesFilter, apply_filters
from saleswright.plans import reports
from saleswright.plans.batch import reports_from_processed, run_stages
from saleswright.plans.sales_table import FEATURE_INPUTS, raw_orders, sales_data
from saleswright.sinks import exports, tables
from saleswright.sources import files
from saleswright.workload.cleaning_queries import summary
from saleswright.workload.report_queries import REPORT_SQL, SQL as REPORT_FULL_SQL, cells_sql, planned, planned_together, report_cells
from saleswright.workload.sql import (
    DIGEST_COLUMNS,
    RAW_COLUMNS,
    digest,
    over_raw,
    over_sales,
    total,
)
from saleswright.workspace import work_dir

QUERIES, SQL = {}, {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


_TYPES = {
    "order_id": "string", "customer_id": "string", "product_id": "string", "order_year": "int",
    "order_date": "timestamp_ntz", "ship_date": "timestamp_ntz",
}


def _clean(spark, folder):
    return sales_data(spark, folder, DIGEST_COLUMNS)


@register("scan_csv", over_sales(digest("sales_data")))
def scan_csv(spark, folder):
    path = tables.save_processed(_clean(spark, folder), work_dir(spark))
    return summary(files.scan_csv(spark, path, _TYPES))


@register("scan_json", over_sales(digest("sales_data")))
def scan_json(spark, folder):
    df, path = _clean(spark, folder), f"{work_dir(spark)}/sales.json"
    tables.text_writer(df).json(path)
    return summary(files.scan_json(spark, path, df.schema))


@register("scan_parquet", over_sales(digest("sales_data")))
def scan_parquet(spark, folder):
    path = tables.save_processed(_clean(spark, folder), work_dir(spark), "sales.parquet")
    return summary(files.scan_parquet(spark, path))


@register(
    "reload_processed",
    over_sales(
        "SELECT CAST(year(order_date) AS BIGINT) AS year, count(*) AS rows, count(ship_date) AS known, "
        "CAST(max(ship_date) AS VARCHAR) AS last_shipment FROM (SELECT order_date, "
        "CASE WHEN CAST(order_id AS BIGINT) % 10 <> 0 THEN ship_date END AS ship_date FROM sales_data) GROUP BY 1"
    ),
)
def reload_processed(spark, folder):
    """Saved data whose ship dates are partly unreadable."""
    df = sales_data(spark, folder, ["order_id", "order_date", "ship_date"])
    junk = F.when(F.col("order_id").cast("bigint") % 10 == 0, F.lit("soon")).otherwise(F.col("ship_date").cast("string"))
    base = work_dir(spark)
    path = tables.save_processed(df.withColumn("ship_date", junk), base)
    again = files.reload_processed(spark, path, f"{base}/raw.csv")
    return again.groupBy(F.year("order_date").alias("year")).agg(
        F.count("*").alias("rows"), F.count("ship_date").alias("known"), F.max("ship_date").alias("last_shipment")
    )


@register(
    "validate_schema",
    over_raw(
        "\nUNION ALL\n".join(
            f"SELECT '{name}' AS column, '{"true" if name != "Region" else "false"}' AS present, "
            + (f"count({snake}) AS non_null FROM raw" if name != "Region" else "CAST(NULL AS BIGINT) AS non_null")
            for name, snake in zip(files.REQUIRED_COLUMNS, RAW_COLUMNS, strict=False)
        )
    ),
)
def validate_schema(spark, folder):
    """The contract against a raw table without ``Region``, with what each column holds."""
    df = raw_orders(spark, folder).drop("Region")
    profile = files.load_profile(df).select("column", "non_null")
    return files.validate_schema(df).join(profile, "column", "left")


@register(
    "load_profile",
    over_raw(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column, '{t}' AS dtype, count({c}) AS non_null, "
            f"(count(*) - count({c})) * 100.0::DOUBLE / count(*) AS null_pct FROM raw"
            for c, t in {
                **{c: "string" for c in RAW_COLUMNS},
                "row_id": "bigint", "postal_code": "bigint", "sales": "double", "quantity": "double",
            }.items()
        )
    ),
)
def load_profile(spark, folder):
    return files.load_profile(raw_orders(spark, folder).toDF(*RAW_COLUMNS))


@register(
    "load_summary",
    over_raw(
        "SELECT 'raw.csv' AS file, 'CSV' AS format, 'true' AS has_bytes, count(*) AS rows, "
        f"CAST({len(RAW_COLUMNS)} AS BIGINT) AS cols, CAST(" + " + ".join(f"(count(*) - count({c}))" for c in RAW_COLUMNS) + " AS BIGINT) AS missing FROM raw"
    ),
)
def load_summary(spark, folder):
    """What loading the raw table from CSV reports; the size in bytes is that of the writer's files, so SQL only knows it is there."""
    path = tables.save_processed(raw_orders(spark, folder), work_dir(spark), "raw.csv")
    return files.load_summary(spark, path).withColumn("has_bytes", F.col("bytes") > F.col("rows")).drop("bytes")


@register("save_processed", over_sales(digest("sales_data")))
def save_processed(spark, folder):
    path = tables.save_processed(_clean(spark, folder), work_dir(spark))
    return summary(files.scan_csv(spark, path, _TYPES, multi_line=False))


_TABLE = "saleswright_sales_data"


def _load(spark, folder, columns):
    """The sales table in the session's catalog, as files in the work folder."""
    df = sales_data(spark, folder, columns)
    if not tables.load_table(df, _TABLE, path=f"{work_dir(spark)}/{_TABLE}"):
        raise RuntimeError("the table was not loaded")
    return spark.table(_TABLE)


@register("load_table", over_sales(digest("sales_data")))
def load_table(spark, folder):
    return summary(_load(spark, folder, DIGEST_COLUMNS))


_INFO = {"order_id": "string", "order_date": "timestamp_ntz", "sales": "double", "order_year": "int"}


@register(
    "table_info",
    over_sales(
        f"SELECT '{_TABLE}' AS table_name, 'default' AS database, (SELECT count(*) FROM sales_data) AS row_count, "
        f"CAST({len(_INFO)} AS BIGINT) AS column_count, CAST(p AS BIGINT) AS position, n AS column_name, t AS column_type "
        "FROM (VALUES " + ", ".join(f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(_INFO.items(), 1)) + ") v(p, n, t)"
    ),
)
def table_info(spark, folder):
    _load(spark, folder, list(_INFO))
    return tables.table_info(spark, _TABLE)


@register(
    "table_layout",
    over_sales(
        "SELECT order_year, region, category, count(*) AS rows, "
        f"{total('sales')} AS revenue FROM sales_data WHERE order_year = 1998 AND region = 'ASIA' GROUP BY 1, 2, 3"
    ),
)
def table_layout(spark, folder):
    """Stored by year and along the curve, then read with a filter on both."""
    df = sales_data(spark, folder, ["order_year", "region", "category", "customer_id", "sales"])
    path = tables.write_layout(df, f"{work_dir(spark)}/by_year")
    chosen = apply_filters(spark.read.parquet(path), SalesFilter(region="ASIA", year=1998))
    return chosen.groupBy("order_year", "region", "category").agg(
        F.count("*").alias("rows"), exact_sum("sales").alias("revenue")
    )


# --- every cell of the reports, every column of the loaders -----------------------------


def _written_cells(spark, base, keys, plan):
    """What the exports wrote, read as text."""
    return {
        k: files.scan_csv(spark, f"{base}/{k}", {c: "string" for c in plan[k].columns}, multi_line=False) for k in keys
    }


_SHOWN = {
    "total_revenue_summary": ("total_orders, total_revenue, avg_order_value, min_sale, max_sale, std_dev_sales", 1),
    "category_performance": ("category, order_count, total_revenue, revenue_share_pct", 5),
    "region_performance": ("region, states_covered, cities_covered, total_orders, total_revenue", 5),
    "segment_analysis": ("segment, unique_customers, total_orders, total_revenue, avg_order_value, revenue_per_customer", 5),
    "top_10_customers": ("customer_name, segment, total_orders, total_revenue, avg_order_value", 10),
    "shipping_mode_analysis": ("ship_mode, total_orders, total_revenue, avg_order_value, avg_shipping_days", 1000),
    "top_10_products": ("product_name, category, times_ordered, total_revenue", 10),
}


@register("report_book", over_sales(cells_sql(REPORT_SQL)))
def report_book(spark, folder):
    """The whole book: every cell of all planned reports."""
    return report_cells(planned_together(spark, folder))


@register(
    "report_views",
    over_sales(cells_sql({k: f"SELECT {c} FROM ({REPORT_SQL[k]}) LIMIT {n}" for k, (c, n) in _SHOWN.items()})),
)
def report_views(spark, folder):
    """Every cell of the printed views."""
    return report_cells(reports.report_views(planned(spark, folder)))


@register("export_reports_csv", over_sales(cells_sql(REPORT_SQL)))
def export_reports_csv(spark, folder):
    """Every cell of the written reports, read back."""
    base, plan = work_dir(spark), planned_together(spark, folder)
    return report_cells(_written_cells(spark, base, exports.export_reports_csv(plan, base), plan))


@register(
    "export_report_bundle",
    over_sales(cells_sql(REPORT_SQL | {"cleaned_data": f"SELECT * FROM ({digest('sales_data')}) ORDER BY order_year, category"})),
)
def export_report_bundle(spark, folder):
    """Every cell of the bundle's reports, and a digest of all columns of its data."""
    base, plan = work_dir(spark), planned_together(spark, folder)
    keys = exports.export_report_bundle(_clean(spark, folder), plan, base)
    data = files.scan_csv(spark, f"{base}/cleaned_data.csv", _TYPES, multi_line=False)
    ordered = summary(data).orderBy("order_year", "category")
    return report_cells(_written_cells(spark, f"{base}/reports", keys, plan) | {"cleaned_data": ordered})


def _columns_sql(source: str, group: str, texts: list[str], numbers: list[str]) -> str:
    """One row per group and column that reads all values: of a text a sum of hashes, of a number its total."""
    parts = [
        f"SELECT {group} AS key, '{c}' AS column, count(*) AS rows, count({c}) AS known, min(CAST({c} AS VARCHAR)) AS least, "
        f"max(CAST({c} AS VARCHAR)) AS greatest, CAST(sum(CAST('0x' || substr(md5(CAST({c} AS VARCHAR)), 1, 8) AS BIGINT)) AS BIGINT) "
        f"AS hashes, NULL::DOUBLE AS low, NULL::DOUBLE AS high, NULL::DOUBLE AS total FROM {source} GROUP BY 1"
        for c in texts
    ] + [
        f"SELECT {group}, '{c}', count(*), count({c}), NULL, NULL, NULL, CAST(min({c}) AS DOUBLE), "
        f"CAST(max({c}) AS DOUBLE), {total(c)} FROM {source} GROUP BY 1"
        for c in numbers
    ]
    return "\nUNION ALL\n".join(parts)


def _columns(df, group: str, texts: list[str], numbers: list[str]):
    """The Spark side of ``_columns_sql``. As in ``summary``, a collected set spares sorting all rows by group."""

    def row(c):
        value, number = F.col(c).cast("string"), c in numbers
        hashed = F.conv(F.substring(F.md5(value), 1, 8), 16, 10).cast("bigint")
        fields = {
            "rows": F.count("*"),
            "known": F.count(c),
            "least": F.lit(None).cast("string") if number else F.min(value),
            "greatest": F.lit(None).cast("string") if number else F.max(value),
            "hashes": F.lit(None).cast("bigint") if number else F.sum(hashed),
            "low": F.min(F.col(c).cast("double")) if number else F.lit(None).cast("double"),
            "high": F.max(F.col(c).cast("double")) if number else F.lit(None).cast("double"),
            "total": exact_sum(c) if number else F.lit(None).cast("double"),
        }
        return F.struct(F.lit(c).alias("column"), *[v.alias(k) for k, v in fields.items()])

    found = [F.array(*map(row, texts + numbers)).alias("columns"), F.collect_set(F.lit(1)).alias("_hashed")]
    grouped = df.groupBy(F.col(group).alias("key")).agg(*found).where(F.size("_hashed") > 0)
    return grouped.select("key", F.inline("columns"))


_LINE_TEXTS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"]
_LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("load_dataset", _columns_sql("lineitem", "l_linenumber", _LINE_TEXTS, _LINE_NUMBERS))
def load_dataset(spark, folder):
    """A digest of all columns of the loaded table."""
    return _columns(files.load_dataset(spark, f"{folder}/lineitem.parquet"), "l_linenumber", _LINE_TEXTS, _LINE_NUMBERS)


_RAW_NUMBERS = ["sales", "quantity"]
_RAW_TEXTS = [c for c in RAW_COLUMNS if c not in _RAW_NUMBERS]


@register("discover_and_load", over_raw(_columns_sql("raw", "ship_mode", _RAW_TEXTS, _RAW_NUMBERS)))
def discover_and_load(spark, folder):
    """A folder with an unreadable file first and then two data sets, types inferred: a digest of all columns."""
    base = work_dir(spark)
    raw = raw_orders(spark, folder)
    later = raw.select("Row ID", "Ship Mode")
    tables.text_writer(later).json(f"{base}/b_later.json")
    tables.save_processed(raw, base, "a_orders.csv")
    spark.read.schema(later.schema).json(f"{base}/b_later.json").select("Row ID").limit(1).write.json(f"{base}/_ignored.txt")
    df = files.discover_and_load(spark, base)
    return _columns(df.toDF(*RAW_COLUMNS), "ship_mode", _RAW_TEXTS, _RAW_NUMBERS)


@register(
    "staged_run",
    over_raw(
        f"SELECT * FROM (SELECT 'ingestion' AS stage, 'success' AS status, (SELECT count(*) FROM raw) AS rows, CAST({len(RAW_COLUMNS)} AS BIGINT) AS cols "
        "UNION ALL SELECT stage, 'success', (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)), "
        # the columns of the raw table, a flag for each numeric column with one gap in twenty values or more, and the features
        f"{len(RAW_COLUMNS)} + (SELECT " + " + ".join(f"CAST(20 * (count(*) - count({c})) >= count(*) AS BIGINT)" for c in ("quantity", "postal_code"))
        + f" FROM (SELECT DISTINCT * FROM raw)) + {len(FEATURE_INPUTS)} "
        "FROM (VALUES ('cleaning'), ('save'), ('database')) v(stage) UNION ALL "
        f"SELECT stage, 'success', {len(reports.REPORTS)}, NULL FROM (VALUES ('analytics'), ('export')) v(stage))"
    ),
)
def staged_run(spark, folder):
    """All six stages over the raw table, as it would arrive in CSV files."""
    base = work_dir(spark)
    tables.save_processed(raw_orders(spark, folder), f"{base}/in", "orders.csv")
    metrics = run_stages(spark, f"{base}/in", f"{base}/out", _TABLE, table_path=f"{base}/{_TABLE}")
    return metrics.select("stage", "status", "rows", "cols")


@register("reports_from_processed", REPORT_FULL_SQL["headline_metrics"])
def from_processed(spark, folder):
    """Headline figures from saved data alone."""
    base = work_dir(spark)
    columns = [*DIGEST_COLUMNS, *[c for c in FEATURE_INPUTS if c not in DIGEST_COLUMNS]]
    path = tables.save_processed(sales_data(spark, folder, columns), base, "processed_data.parquet")
    return reports_from_processed(spark, path, base)
