"""The whole-result queries cover every report, cell and column."""

from __future__ import annotations

import pytest

from saleswright.plans.reports import REPORTS
from saleswright.workload import registry
from saleswright.workload.report_queries import planned
from saleswright.workload.sql import RAW_COLUMNS


@pytest.mark.parametrize("name", ["report_book", "export_reports_csv"])
def test_every_cell_of_every_report(spark, folder, name):
    got = {}
    for r in registry.run(name, spark, folder).collect():
        got.setdefault(r["report"], []).append(r["column"])
    plan = planned(spark, folder)
    assert set(got) == set(REPORTS) and len(got) == 15
    for key, report in plan.items():
        assert sorted(got[key]) == sorted(report.columns * report.count())


def test_every_column_of_the_loaders(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").columns
    for name, columns in (("load_dataset", lines), ("discover_and_load", RAW_COLUMNS)):
        assert {r["column"] for r in registry.run(name, spark, folder).collect()} == set(columns)
