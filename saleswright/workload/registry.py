"""All registered queries, with result types that compare across engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswright.workload import cleaning_queries, exploration_queries, report_queries, storage_queries

_AREAS = (report_queries, exploration_queries, cleaning_queries, storage_queries)
QUERIES = {name: fn for area in _AREAS for name, fn in area.QUERIES.items()}
SQL = {name: sql for area in _AREAS for name, sql in area.SQL.items()}


def comparable(df: DataFrame) -> DataFrame:
    """Integers as bigint, decimals and floats as double, timestamps and booleans as text."""

    def cast(field: T.StructField):
        kind = field.dataType
        if isinstance(kind, T.IntegralType):
            return F.col(field.name).cast("bigint").alias(field.name)
        if isinstance(kind, T.NumericType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType, T.BooleanType)):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select(*[cast(f) for f in df.schema])


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return comparable(QUERIES[name](spark, folder))
