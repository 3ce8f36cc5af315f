"""Small literal tables (names of columns, reports, stages), planned in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_rows(spark: SparkSession, columns: dict[str, str], rows: Sequence[tuple]) -> DataFrame:
    """A DataFrame of literals; ``columns`` maps names to types."""
    structs = [
        F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, columns.items(), strict=True)])
        for row in rows
    ]
    if not structs:
        return spark.createDataFrame([], ", ".join(f"`{n}` {t}" for n, t in columns.items()))
    return spark.range(1).select(F.inline(F.array(*structs)))
