"""Sources, sinks and the staged run on small files."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from saleswright import workspace
from saleswright.plans import batch
from saleswright.plans.sales_table import raw_orders
from saleswright.sinks import exports, tables
from saleswright.sources import database, files


def _write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_quotes_newlines_and_missing(spark, tmp_path):
    text = 'id,name,n,x,flag,code\n1,"HP T520 - 24"" Color",5,NA,true,01a\n2,"two\nlines",,1.5,false,N/A\n3,null,7,2,true,x\n'
    df = files.scan_csv(spark, _write(tmp_path / "a.csv", text))
    assert dict(df.dtypes) == {"id": "bigint", "name": "string", "n": "bigint", "x": "double", "flag": "boolean", "code": "string"}
    assert [tuple(r) for r in df.orderBy("id").collect()] == [
        (1, 'HP T520 - 24" Color', 5, None, True, "01a"),
        (2, "two\nlines", None, 1.5, False, None),
        (3, None, 7, 2.0, True, "x"),
    ]


def test_csv_without_line_breaks_can_be_split(spark, tmp_path):
    path = _write(tmp_path / "a.csv", 'a,b\n1,"x ""y"""\n2,z\n')
    assert not files._spans_lines(spark, path)
    assert {r.b for r in files.scan_csv(spark, path).collect()} == {'x "y"', "z"}
    declared = files.scan_csv(spark, path, {"a": "string", "b": "string"})
    assert dict(declared.dtypes)["a"] == "string"


def test_csv_round_trip_keeps_awkward_text(spark, tmp_path):
    rows = [(1, 'a "quoted" word'), (2, "back\\slash"), (3, "comma, and\nbreak"), (4, "é")]
    df = spark.createDataFrame(rows, "id bigint, t string")
    path = tables.save_processed(df, str(tmp_path / "out"))
    assert sorted(tuple(r) for r in files.scan_csv(spark, path).collect()) == rows


def test_json_forms(spark, tmp_path):
    array = files.scan_json(spark, _write(tmp_path / "a.json", '[{"a": 1, "b": "x"},\n {"a": 2, "b": null}]'))
    lines = files.scan_json(spark, _write(tmp_path / "l.json", '{"a": 1, "b": "x"}\n{"a": 2}\n'))
    assert sorted(map(tuple, array.collect())) == sorted(map(tuple, lines.collect())) == [(1, "x"), (2, None)]
    with pytest.raises(ValueError, match="flat records"):
        files.scan_json(spark, _write(tmp_path / "c.json", '{"a": {"0": 1, "1": 2}}'))


AWKWARD = ["}", "}, {", '"', "\\", '\\"}', "a\nb", "", None, '{"a": 1}', "], [", "é}", '}, {", ":": "}']


def test_json_arrays_are_cut_side_by_side(spark, tmp_path):
    """Braces, quotes and escapes in strings, blocks that end anywhere, one line and many, against the plain reader."""
    rows = [{"id": i, "t": AWKWARD[i % len(AWKWARD)], "n": None if i % 7 == 0 else i / 4} for i in range(3000)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k, v in zip(before, ("4099", "0"), strict=True):
            spark.conf.set(k, v)
        for indent in (None, 1):
            path = _write(tmp_path / f"a{indent}.json", json.dumps(rows, indent=indent, ensure_ascii=False))
            assert files._pieces(spark, path).select("block").distinct().count() > 10
            assert files.array_records(spark, path).count() == len(rows)
            got = files.scan_json(spark, path)
            assert sorted((r.id, r.t, r.n) for r in got.collect()) == [(r["id"], r["t"], r["n"]) for r in rows]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_json_folder_of_both_forms(spark, tmp_path):
    folder = tmp_path / "both forms.json"
    folder.mkdir()
    _write(folder / "a.json", '\n {"a": 1, "b": "["}\n{"a": 2}\n')
    _write(folder / "b c.json", ' \n[{"a": 3, "b": "}"}, {"a": 4,\n "b": null}]\n')
    _write(folder / "c.json", "[]")
    _write(folder / "d.json", "")
    want = [(1, "["), (2, None), (3, "}"), (4, None)]
    assert sorted(map(tuple, files.scan_json(spark, str(folder)).collect())) == want
    assert sorted(map(tuple, files.scan_json(spark, str(folder), "a bigint, b string").collect())) == want
    assert files.scan_json(spark, _write(tmp_path / "e.json", "[]"), "a bigint").count() == 0
    for nested in ('[{"a": {"b": 1}}, {"a": {"b": 2}}]', '[{"a": [1, 2]}]'):
        with pytest.raises(ValueError, match="flat records"):
            files.scan_json(spark, _write(tmp_path / "n.json", nested)).count()


def test_nan_becomes_null_at_the_boundary(spark, tmp_path):
    spark.createDataFrame([(float("nan"),), (1.0,)], "x double").write.parquet(str(tmp_path / "p.parquet"))
    assert files.load_dataset(spark, str(tmp_path / "p.parquet")).where("x IS NULL").count() == 1


def test_dispatch_and_discovery_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.load_dataset(spark, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError, match="unsupported"):
        files.load_dataset(spark, _write(tmp_path / "a.xlsx", "x"))
    with pytest.raises(FileNotFoundError):
        files.discover_and_load(spark, str(tmp_path))
    with pytest.raises(NotADirectoryError):
        files.discover_and_load(spark, str(tmp_path / "none"))
    _write(tmp_path / "b.csv", "a\n1\n")
    _write(tmp_path / "c.JSON", '[{"a": 2}]')
    assert files.discover(spark, str(tmp_path)).endswith("/b.csv")
    assert files.discover_and_load(spark, str(tmp_path)).first().a == 1
    assert files.detect_file_format("x/Y.PARQUET") == ".parquet"


def test_reload_processed(spark, tmp_path):
    raw = _write(tmp_path / "raw.csv", "order_date,ship_date\n2018-04-15,junk\n")
    assert files.reload_processed(spark, str(tmp_path / "none.csv")) is None
    row = files.reload_processed(spark, str(tmp_path / "none.csv"), raw).first()
    assert str(row.order_date) == "2018-04-15 00:00:00" and row.ship_date is None


def test_schema_contract(spark, folder):
    raw = raw_orders(spark, folder)
    assert files.validate_schema(raw).where("NOT present").count() == 0
    with pytest.raises(ValueError, match="Region"):
        files.require_schema(raw.drop("Region"))


def test_inventory(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    _write(tmp_path / "a.txt", "x" * 1536)
    _write(tmp_path / "sub" / "b.bin", "y" * (2 << 20))
    rows = {r.file: r.size for r in files.file_inventory(spark, str(tmp_path)).collect()}
    assert rows == {f"{tmp_path.name}/a.txt": "1.5 KB", f"{tmp_path.name}/sub/b.bin": "2.00 MB"}


def test_jdbc_options_and_masking():
    """Options only: reading and writing would need a database."""
    plain = database.jdbc_options("jdbc:mysql://h/db", table="sales_data", user="u")
    assert plain == {"url": "jdbc:mysql://h/db", "dbtable": "sales_data", "user": "u"}
    query = database.jdbc_options("u", query="SELECT 1", partition=("id", 1, 9, 4))
    assert query["dbtable"] == "(SELECT 1) q" and query["numPartitions"] == "4"
    assert "query" in database.jdbc_options("u", query="SELECT 1")
    with pytest.raises(ValueError):
        database.jdbc_options("u")
    assert database.mask_password("mysql://root:s3cr3t@host/db") == "mysql://root:***@host/db"
    assert "s3cr3t" not in database.mask_password("jdbc:mysql://h/db?user=a&password=s3cr3t&x=1")


def test_table_is_replaced_verified_and_described(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    assert tables.load_table(df, "small_table", path=str(tmp_path / "t1"))
    assert tables.load_table(df.limit(1), "small_table", path=str(tmp_path / "t2"))
    info = tables.table_info(spark, "small_table").orderBy("position").collect()
    assert [(r.column_name, r.column_type, r.row_count, r.column_count) for r in info] == [("id", "int", 1, 2), ("t", "string", 1, 2)]
    assert tables.table_info(spark, "no_such_table").count() == 0
    failing = df.withColumn("x", F.raise_error(F.lit("broken")).cast("string"))
    assert not tables.load_table(failing, "other_table", path=str(tmp_path / "t3"))


def test_dates_as_text(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2018-04-15 01:02:03' d, 1 n")
    assert tuple(tables.dates_as_text(df).first()) == ("2018-04-15 01:02:03", 1)


def test_layout_prunes(spark, tmp_path):
    df = spark.range(100).select((2015 + F.col("id") % 4).alias("order_year"), F.lit("r").alias("region"), "id")
    path = tables.write_layout(df, str(tmp_path / "t"))
    one = spark.read.parquet(path).where("order_year = 2016")
    assert one.count() == 25 and len(one.inputFiles()) >= 1
    assert "PartitionFilters: [isnotnull(order_year" in one._jdf.queryExecution().toString()


def test_layout_keeps_like_rows_together(spark, tmp_path):
    """Few files however many tasks wrote; a filter on any column of the curve finds its rows in few of them; no row is lost."""
    year = F.when(F.col("id") % 3 == 0, 2015).otherwise(2016 + F.col("id") % 4)
    df = spark.range(0, 40_000, numPartitions=64).select(
        year.alias("order_year"),
        F.when(F.col("id") % 50 != 0, F.concat(F.lit("r"), F.xxhash64("id", F.lit(1)) % 8)).alias("region"),
        F.concat(F.lit("c"), F.xxhash64("id", F.lit(2)) % 8).alias("category"),
        F.lit("one").alias("segment"),
        (F.xxhash64("id", F.lit(3)) % 1000).alias("customer_id"),
        "id",
    )
    path = tables.write_layout(df, str(tmp_path / "t"), cluster_by=("segment", "region", "category"), rows_per_file=625)
    back = spark.read.parquet(path)
    assert back.select(df.columns).exceptAll(df).count() == 0 and back.count() == 40_000
    files_ = back.groupBy(F.input_file_name().alias("file")).agg(
        F.min("region").alias("r0"), F.max("region").alias("r1"), F.min("category").alias("c0"), F.max("category").alias("c1")
    )
    stored = files_.collect()
    assert 40 <= len(stored) <= 64 + 5

    def touched(**values):
        return sum(all(f[k + "0"] is not None and f[k + "0"] <= v <= f[k + "1"] for k, v in values.items()) for f in stored)

    assert touched(r="r3", c="c2") < len(stored) / 4
    assert touched(r="r3") < len(stored) / 2 and touched(c="c2") < len(stored) * 0.7


def test_layout_of_odd_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "order_year int, region string")
    assert spark.read.schema(empty.schema).parquet(tables.write_layout(empty, str(tmp_path / "e"))).count() == 0
    alike = spark.range(3000).select(F.lit(2015).alias("order_year"), F.lit(None).cast("string").alias("region"), "id")
    path = tables.write_layout(alike, str(tmp_path / "a"), rows_per_file=500)
    assert spark.read.parquet(path).count() == 3000 and len(spark.read.parquet(path).inputFiles()) == 6


def test_staged_run_and_its_failures(spark, folder, tmp_path):
    source = tmp_path / "in"
    raw_orders(spark, folder).write.option("header", True).csv(str(source / "orders.csv"))
    out = str(tmp_path / "out")
    metrics = batch.run_stages(spark, str(source), out, "run_table", table_path=str(tmp_path / "table"))
    rows = {r.stage: r for r in metrics.collect()}
    assert list(rows) == ["ingestion", "cleaning", "save", "database", "analytics", "export"]
    assert {r.status for r in rows.values()} == {"success"}
    assert rows["ingestion"].rows > rows["cleaning"].rows
    assert files.scan_csv(spark, f"{out}/processed_data.csv").count() == rows["cleaning"].rows
    headline = batch.reports_from_processed(spark, f"{out}/processed_data.parquet", out)
    assert headline.count() == 13
    with pytest.raises(batch.StageFailed, match="ingestion"):
        batch.run_stages(spark, str(tmp_path / "none"), out)


def test_bundle_skips_empty_reports(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0)], "category string, sales double")
    planned = {"full": df, "empty": df.where("false")}
    assert exports.export_report_bundle(df, planned, str(tmp_path)) == ["full"]
    book = exports.report_book(planned).collect()
    assert [tuple(r) for r in book] == [("full", 1, "category", "a"), ("full", 1, "sales", "1.0")]


def test_work_dir_needs_shared_storage_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master, applicationId = "spark://cluster", "app"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.work_dir(Session())
    assert "saleswright" in workspace.work_dir(spark)


def test_declared_types_never_lose_values_silently(spark, tmp_path, caplog):
    (tmp_path / "x.csv").write_text('Id,Sales\n12345678901234567890,7\n12345678901234567891,"1,234.50"\n')
    with pytest.raises(ValueError, match="Sales.*1"):
        files.scan_csv(spark, str(tmp_path / "x.csv"), types={"Sales": "double"})
    with caplog.at_level("WARNING"):
        df = files.scan_csv(spark, str(tmp_path / "x.csv"), types={"Sales": "double"}, on_error="null")
    assert "Sales" in caplog.text and sorted(r.Sales or 0 for r in df.collect()) == [0, 7.0]
    assert df.select("Id").distinct().count() == 2 and dict(df.dtypes)["Id"] == "decimal(38,0)"
