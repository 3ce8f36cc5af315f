"""A complete run: read, clean, save, load, report, export."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from saleswright.functions.rows import literal_rows
from saleswright.operators.cleaning import clean_and_transform
from saleswright.plans.reports import Failure, compute_reports, headline_metrics, plan_together
from saleswright.sinks.exports import export_reports_csv
from saleswright.sinks.tables import SALES_TABLE, load_table, save_processed
from saleswright.sources.files import discover_and_load, load_dataset, scan_parquet

log = logging.getLogger(__name__)

STAGE_COLUMNS = {
    "stage": "string",
    "status": "string",
    "rows": "bigint",
    "cols": "bigint",
    "seconds": "double",
}


class StageFailed(RuntimeError):
    """A stage that later ones depend on did not succeed."""


class _Log:
    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def set_rows(self, name: str, rows: int) -> None:
        self.rows = [(n, s, rows if n == name else r, c, t) for n, s, r, c, t in self.rows]

    def stage(self, name: str, fatal: bool, work: Callable[[], tuple]):
        """Run one stage; ``work`` returns (result, ok, rows, cols)."""
        start = time.monotonic()
        try:
            result, ok, rows, cols = work()
            status = "success" if ok else "skipped"
        except Exception as error:
            if fatal:
                raise StageFailed(f"{name}: {error}") from error
            log.warning("%s did not succeed: %s", name, error)
            result, status, rows, cols = None, "skipped", None, None
        self.rows.append((name, status, rows, cols, round(time.monotonic() - start, 2)))
        return result


def run_stages(
    spark: SparkSession,
    source: str | DataFrame,
    out: str,
    table: str = SALES_TABLE,
    jdbc: dict | None = None,
    table_path: str | None = None,
) -> DataFrame:
    """Run all six stages and return ``(stage, status, rows, cols, seconds)``.

    Reading, cleaning and saving must succeed; loading the table, analysing and
    exporting may fail without stopping the run. Rows read are counted while
    duplicates are removed, and rows cleaned while they are saved, so nothing is
    scanned for a count; everything after that scans the saved Parquet.
    """
    done = _Log()

    read, written = Observation("read"), Observation("cleaned")

    def ingest():
        df = source if isinstance(source, DataFrame) else discover_and_load(spark, source)
        return df.observe(read, F.count(F.lit(1)).alias("n")), True, None, len(df.columns)

    raw = done.stage("ingestion", True, ingest)

    def clean():
        df = clean_and_transform(raw).observe(written, F.count(F.lit(1)).alias("n"))
        path = save_processed(df, out, "processed_data.parquet")
        return scan_parquet(spark, path, df.schema), True, written.get["n"], len(df.columns)

    cleaned = done.stage("cleaning", True, clean)
    done.set_rows("ingestion", read.get["n"])
    done.stage("save", True, lambda: (save_processed(cleaned, out), True, written.get["n"], len(cleaned.columns)))

    def load():
        ok = load_table(cleaned, table, jdbc, table_path)
        return ok, ok, written.get["n"] if ok else None, len(cleaned.columns)

    done.stage("database", False, load)

    def analyse():
        computed = compute_reports(spark, plan_together(cleaned))
        fine = sum(not isinstance(x, Failure) for x in computed.values())
        return computed, fine == len(computed), fine, None

    planned = done.stage("analytics", False, analyse) or {}

    def export():
        written_keys = export_reports_csv(planned, f"{out.rstrip('/')}/csv_reports")
        return written_keys, bool(written_keys), len(written_keys), None

    done.stage("export", False, export)
    return literal_rows(spark, STAGE_COLUMNS, done.rows)


def reports_from_processed(spark: SparkSession, processed: str, out: str) -> DataFrame:
    """Reports from saved data alone: export them and return the headline figures."""
    planned = compute_reports(spark, plan_together(load_dataset(spark, processed)))
    export_reports_csv(planned, f"{out.rstrip('/')}/csv_reports")
    return headline_metrics(planned)
