"""Finished reports as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleswright.functions.jobs import side_by_side
from saleswright.plans.reports import Failure
from saleswright.sinks.tables import save_processed


def export_reports_csv(planned: dict[str, DataFrame | Failure], folder: str) -> list[str]:
    """One CSV per report that has rows, as ``folder/<key>``; returns the keys.

    A report is a few dozen aggregated rows: it is computed once, kept while it is
    written, and goes into one part file.
    """
    base = folder.rstrip("/")
    reports = {k: r for k, r in planned.items() if not isinstance(r, Failure)}
    if not reports:
        return []

    def write(entry: tuple[str, DataFrame]) -> bool:
        key, report = entry
        kept = report.coalesce(1).persist()
        try:
            if kept.count() == 0:
                return False
            kept.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{base}/{key}")
            return True
        finally:
            kept.unpersist()

    spark = next(iter(reports.values())).sparkSession
    written = side_by_side(spark, write, reports.items())
    return [key for key, done in zip(reports, written, strict=True) if done]


def export_report_bundle(df: DataFrame, planned: dict[str, DataFrame | Failure], folder: str) -> list[str]:
    """Cleaned data and all reports below one folder."""
    save_processed(df, folder, "cleaned_data.csv")
    return export_reports_csv(planned, f"{folder.rstrip('/')}/reports")


def report_book(planned: dict[str, DataFrame | Failure]) -> DataFrame:
    """All reports in one long table: ``(report, row, column, value)``, values as text.

    Rows are numbered in report order; that window runs over finished reports only.
    """
    book = None
    for key, report in planned.items():
        if isinstance(report, Failure):
            continue
        numbered = report.withColumn("_m", F.monotonically_increasing_id())
        row = F.row_number().over(Window.orderBy("_m"))
        cells = [
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in report.columns
        ]
        page = numbered.withColumn("row", row).select(
            F.lit(key).alias("report"), "row", F.inline(F.array(*cells))
        )
        book = page if book is None else book.unionByName(page)
    if book is None:
        raise ValueError("there is no report to put into the book")
    return book
