"""What passes leave on the disks: shuffle files, uncompressed text, frames that nothing reads any more."""

from __future__ import annotations

import glob
import gzip
import os
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from saleswright import workspace
from saleswright.operators import cleaning as cl
from saleswright.plans import sales_table
from saleswright.sinks import tables
from saleswright.sources import files


@contextmanager
def _conf(spark, **settings):
    old = {k.replace("__", "."): spark.conf.get(k.replace("__", "."), None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k.replace("__", "."), v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _shuffle_files(spark) -> set[str]:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    dirs = [d.getPath() for d in blocks.localDirs()]
    return {f for d in dirs for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}


def _shuffled(spark):
    return spark.range(5000).groupBy((F.col("id") % 700).alias("k")).agg(F.count("*").alias("n"))


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    held = _shuffled(spark)  # whoever holds the frame keeps Spark's cleaner from its files
    before = _shuffle_files(spark)
    staged = workspace.stage(held)
    path = tables.save_processed(held, str(tmp_path))
    parquet = tables.save_processed(held, str(tmp_path), "x.parquet")
    assert _shuffle_files(spark) <= before
    assert staged.count() == spark.read.parquet(parquet).count() == files.scan_csv(spark, path).count() == 700
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_settings_hold_for_one_write(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())})

    rows = spark.range(0, 100, 1, 1).mapInArrow(sizes, "n bigint")
    assert {r.n for r in workspace.stage(rows, "sizes", {key: "20"}).collect()} == {20}
    assert spark.conf.get(key) == before and [r.n for r in rows.collect()] == [100]


def test_csv_is_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_TEXT", 300)
    df = spark.range(0, 1000, 1, 1).select("id", F.lit('a "word", and\tmore').alias("text"), F.lit(None).cast("string").alias("gap"))
    path = tables.save_processed(df, str(tmp_path))
    parts = sorted(glob.glob(f"{path}/part-*.csv.gz"))
    lines = [len(gzip.open(p, "rt").readlines()) - 1 for p in parts]
    assert sum(lines) == 1000 and max(lines) <= 300
    again = files.scan_csv(spark, path)
    assert sorted(again.collect()) == sorted(df.collect())
    plain = tables.save_processed(df, str(tmp_path), "plain.csv", compression="none")
    assert glob.glob(f"{plain}/part-*.csv") and files.scan_csv(spark, plain).count() == 1000


def test_compressed_json_is_read_whole(spark, tmp_path):
    df = spark.range(500).select(F.col("id").cast("string").alias("name"), (F.col("id") / 4).alias("x"))
    tables.text_writer(df).json(str(tmp_path / "j.json"))
    assert glob.glob(f"{tmp_path}/j.json/*.json.gz")
    assert sorted(files.scan_json(spark, str(tmp_path / "j.json"), df.schema).collect()) == sorted(df.collect())


_ROWS = [
    (1, "a", 0.0, None), (1, "a", -0.0, None), (1, None, float("nan"), "x"), (1, None, float("nan"), "x"), (2, None, None, "x"),
    (2, "x", None, None), (None, "a", 1.0, "b"), (None, "a", 1.0, "b"), (None, "a", 1.0, "c"),
]


@pytest.mark.parametrize("few", [0, cl.FEW_KEYS])
def test_staged_rows_without_duplicates(spark, few, monkeypatch):
    monkeypatch.setattr(cl, "FEW_KEYS", few)
    df = spark.createDataFrame(_ROWS, "n int, s string, x double, t string")
    kept = lambda d: sorted(map(repr, d.select("n", "s", F.abs("x").alias("x"), "t").collect()))
    assert kept(cl.staged_without_duplicates(df)) == kept(df.dropDuplicates())
    assert cl.staged_without_duplicates(df.where("false")).count() == 0


def test_rows_whose_hashes_do_not_tell_are_compared_in_full(spark):
    df = spark.createDataFrame([("A",), ("a",), ("b",)], "s string").select(F.collate("s", "UTF8_LCASE").alias("s"))
    assert cl.staged_without_duplicates(df).count() == df.dropDuplicates().count() == 2
    nested = spark.createDataFrame([([1, 2], 1), ([1, 2], 1), ([2], 1)], "v array<int>, n int")
    assert cl.staged_without_duplicates(nested).count() == 2


def test_rows_with_duplicates_go_once_they_are_read(spark, monkeypatch):
    gone = []
    monkeypatch.setattr(cl, "discard", lambda d: (gone.extend(d.inputFiles()), workspace.discard(d)))
    df = spark.range(100).select((F.col("id") % 60).alias("n"), F.lit("x").alias("s"))
    assert cl.staged_without_duplicates(df).count() == 60
    assert gone and not any(os.path.exists(f.removeprefix("file:").replace("//", "/", 1)) for f in gone)


def test_wide_rows_are_shuffled_once(spark, folder):
    """The columns of customers don't go through the shuffle by part, where both tables are shuffled."""
    columns = list(sales_table.BASE)
    want = sales_table.sales_data(spark, folder, columns, skip=False)
    assert sales_table._sent_to_all(sales_table._read(spark, folder, "part"))
    with _conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        got = sales_table.sales_data(spark, folder, columns, skip=False)
        plan = got._jdf.queryExecution().executedPlan().toString().splitlines()
        by_part = [line for line in plan if "hashpartitioning(l_partkey" in line]
        rows = sorted(got.collect())
    assert rows == sorted(want.collect()) and len(by_part) == 1
    below = plan[plan.index(by_part[0]) :]
    assert "Scan parquet" in next(line for line in below if "Scan" in line or "Join" in line)
