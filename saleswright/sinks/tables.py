"""Cleaned data as files, as a catalog table, or behind JDBC."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswright.functions.missing import column
from saleswright.functions.rows import literal_rows
from saleswright.sources import storage
from saleswright.sources.database import BATCH_ROWS, jdbc_options, mask_password
from saleswright.sources.files import size_label
from saleswright.workspace import freeing

log = logging.getLogger(__name__)

SALES_TABLE = "sales_data"

# Columns that reports group and filter by most.
HOT_COLUMNS = (
    "order_date", "category", "sub_category", "segment", "region", "state", "city",
    "ship_mode", "customer_id",
)

#: Columns that the curve winds through, bits of each, rows that its parts are judged by, and rows per file.
CURVE_COLUMNS, CURVE_BITS, SPLIT_ROWS = 4, 6, 20_000
ROWS_PER_FILE = 2_000_000
#: Rows per file of compressed text, since one task reads such a file.
ROWS_PER_TEXT = 500_000


def text_writer(df: DataFrame, compression: str = "gzip") -> DataFrameWriter:
    """A writer of CSV or JSON in part files of ``ROWS_PER_TEXT`` rows at most.

    Such text takes several times the room of the same rows in Parquet, so it is compressed (``compression="none"`` leaves it
    plain). A compressed file can't be split between tasks; the bound on its rows keeps it small instead.
    """
    return freeing(df).write.option("compression", compression).option("maxRecordsPerFile", ROWS_PER_TEXT)


def save_processed(df: DataFrame, folder: str, name: str = "processed_data.csv", compression: str = "gzip") -> str:
    """Write cleaned data under ``folder/name``; the extension picks CSV or Parquet. ``compression`` is that of CSV.

    Every task writes its own part files below that path.
    """
    path = f"{folder.rstrip('/')}/{name}"
    if name.lower().endswith(".parquet"):
        freeing(df).write.mode("overwrite").parquet(path)
    else:
        text_writer(df, compression).mode("overwrite").option("header", True).option("escape", '"').csv(path)
    log.info("saved %s: %s", path, size_label(storage.total_bytes(df.sparkSession, path)))
    return path


def _edges(df: DataFrame, columns: Sequence[str], rows: int) -> dict[str, list]:
    """Values that cut each column into up to ``2 ** CURVE_BITS`` parts of about the same number of rows.

    They only decide where a row is stored, never a result, so they come from some ``SPLIT_ROWS`` rows, one array per column.
    """
    sample = df.select(*[column(c) for c in columns]).sample(min(1.0, SPLIT_ROWS / max(rows, 1)), seed=42)
    parts = 1 << CURVE_BITS
    sorted_ = sample.agg(*[F.array_sort(F.collect_list(column(c))).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    edges = {}
    for i, c in enumerate(columns):
        values = sorted_[i]
        edges[c] = sorted({values[len(values) * k // parts] for k in range(1, parts)}) if values else []
    return edges


def curve_place(df: DataFrame, edges: dict[str, list]) -> Column:
    """A row's place on the Morton curve: the bits of its columns' parts in turn, those of the first column leading.

    NULL is in the first part. With ``e`` edges (at least one) a part costs ``e`` comparisons, at most ``2 ** CURVE_BITS``.
    """
    parts = []
    for name, cuts in edges.items():
        known = F.array(*[F.lit(v).cast(df.schema[name].dataType) for v in cuts])
        value = column(name)
        below = F.when(value.isNotNull(), F.size(F.filter(known, lambda edge: edge <= value))).otherwise(0)  # noqa: B023
        # Columns of few values use the high bits, too, so that none leads the curve by its number of values alone.
        parts.append((below * F.lit(1 << CURVE_BITS) / F.lit(len(cuts) + 1)).cast("int"))
    place = F.lit(0).cast("bigint")
    for bit in range(CURVE_BITS - 1, -1, -1):
        for part in parts:
            place = F.shiftleft(place, 1).bitwiseOR(F.shiftright(part, bit).bitwiseAND(F.lit(1)).cast("bigint"))
    return place


def write_layout(
    df: DataFrame,
    path: str,
    partition_by: str = "order_year",
    cluster_by: Sequence[str] = HOT_COLUMNS,
    rows_per_file: int = ROWS_PER_FILE,
) -> str:
    """Parquet by year; inside a year, rows that are alike in the columns of ``cluster_by`` are stored together.

    The order is the Morton curve over the first ``CURVE_COLUMNS`` of ``cluster_by`` that the frame has and that hold more than
    one value, so a filter on any of them, not only the first, skips most files and row groups by their
    statistics. One range shuffle brings the rows of a year and a stretch of the curve to one task: as many tasks as files of
    ``rows_per_file`` rows are needed, so the number of files doesn't grow with the number of input tasks. A year that holds a
    third of all rows is cut along the curve. Rows that are alike in every column of the curve are spread by a hash of the
    row. The input is read three times: for its size, the parts of the columns, and the write.
    """
    rows = df.count()
    wanted = [c for c in cluster_by if c in df.columns and c != partition_by]
    edges = {c: e for c, e in _edges(df, wanted, rows).items() if len(e) > 1} if wanted else {}
    edges = dict(list(edges.items())[:CURVE_COLUMNS])
    spread = F.xxhash64(*[column(c) for c in df.columns])
    keys = [column(partition_by), F.col("_place"), F.col("_spread")]
    placed = df.withColumns({"_place": curve_place(df, edges), "_spread": spread})
    ranged = placed.repartitionByRange(max(1, -(-rows // rows_per_file)), *keys)
    stored = ranged.sortWithinPartitions(*keys).drop("_place", "_spread")
    stored.write.mode("overwrite").partitionBy(partition_by).parquet(path)
    return path


def dates_as_text(df: DataFrame) -> DataFrame:
    """Timestamps as ``yyyy-MM-dd HH:mm:ss``, for targets that take text."""
    stamps = [f.name for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in stamps}) if stamps else df


def load_table(
    df: DataFrame,
    table: str = SALES_TABLE,
    jdbc: dict | None = None,
    path: str | None = None,
) -> bool:
    """Replace ``table`` with ``df`` and check its row count; False on failure.

    The default target is the session's catalog (``path`` makes it an external
    table); ``jdbc`` holds ``url`` and driver options for a database. The number of
    rows written is observed during the write, so the data is computed once.
    """
    spark = df.sparkSession
    written = Observation(f"{table}_rows")
    observed = df.observe(written, F.count(F.lit(1)).alias("n"))
    try:
        if jdbc:
            options = jdbc_options(table=table, **jdbc)
            text = dates_as_text(observed)
            text.write.format("jdbc").options(**options).option("batchsize", BATCH_ROWS).mode("overwrite").save()
            stored = spark.read.format("jdbc").options(**options).load()
        else:
            writer = observed.write.mode("overwrite").format("parquet")
            (writer.option("path", path) if path else writer).saveAsTable(table)
            stored = spark.table(table)
        return stored.count() == written.get["n"]
    except Exception as error:  # the caller goes on without the table
        log.error("loading %s failed: %s", table, mask_password(error))
        return False


def table_info(spark: SparkSession, table: str = SALES_TABLE) -> DataFrame:
    """Name, database, row and column count of a table, with one row per column.

    An unknown table gives no rows.
    """
    columns = {
        "table_name": "string",
        "database": "string",
        "column_count": "bigint",
        "position": "bigint",
        "column_name": "string",
        "column_type": "string",
    }
    if not spark.catalog.tableExists(table):
        return literal_rows(spark, {**columns, "row_count": "bigint"}, [])
    df = spark.table(table)
    database = table.split(".")[-2] if "." in table else spark.catalog.currentDatabase()
    name = table.split(".")[-1]
    rows = [
        (name, database, len(df.columns), i, f.name, f.dataType.simpleString())
        for i, f in enumerate(df.schema, 1)
    ]
    size = df.agg(F.count("*")).scalar()
    return literal_rows(spark, columns, rows).withColumn("row_count", size)
