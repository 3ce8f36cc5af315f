"""Tables behind JDBC. Connection options come from the caller."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Rows per insert statement.
BATCH_ROWS = 1000


def mask_password(text: object) -> str:
    """A connection URL or an error message without the password in it."""
    masked = re.sub(r"(://[^:@/\s]*):[^@\s]*@", r"\1:***@", str(text))
    return re.sub(r"(?i)(password=)[^;&\s]*", r"\1***", masked)


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    partition: tuple[str, int | str, int | str, int] | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options of a JDBC read or write.

    ``partition`` is ``(column, lower, upper, tasks)``; without it one task reads
    everything. Spark cannot combine it with ``query``, so a query then becomes a
    derived table.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {"url": url, **extra}
    if query is not None and partition is None:
        options["query"] = query
    else:
        options["dbtable"] = table if table is not None else f"({query}) q"
    if partition:
        column, lower, upper, tasks = partition
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(tasks),
        }
    return options


def scan_jdbc(spark: SparkSession, url: str, **options) -> DataFrame:
    """The result of a table or query as a DataFrame."""
    return spark.read.format("jdbc").options(**jdbc_options(url, **options)).load()
