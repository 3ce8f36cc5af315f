"""CSV, JSON and Parquet scans, and the choice between them."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswright.functions.dates import parse_timestamp
from saleswright.functions.missing import column, missing_by_column
from saleswright.functions.numeric import nan_to_null, percent_of
from saleswright.functions.rows import literal_rows
from saleswright.sources import storage
from saleswright.workspace import stage, work_dir

log = logging.getLogger(__name__)

# File extensions that can be read.
FORMATS = {".csv": "CSV", ".json": "JSON", ".parquet": "Parquet"}

# Texts that stand for a missing value in a CSV file.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The columns an order table must have.
REQUIRED_COLUMNS = (
    "Row ID", "Order ID", "Order Date", "Ship Date", "Ship Mode", "Customer ID",
    "Customer Name", "Segment", "Country", "City", "State", "Postal Code", "Region",
    "Product ID", "Category", "Sub-Category", "Product Name", "Sales",
)

PROCESSED_DATES = ("order_date", "ship_date")


def detect_file_format(path: str) -> str:
    """The lower-cased extension of a readable path."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    ext = ("." + name.rsplit(".", 1)[1].lower()) if "." in name.lstrip(".") else ""
    if ext not in FORMATS:
        raise ValueError(f"unsupported file format '{ext}'; supported: {sorted(FORMATS)}")
    return ext


def nan_as_null(df: DataFrame) -> DataFrame:
    """NaN in floating-point columns becomes NULL, once, at the boundary."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(column(c)) for c in floats}) if floats else df


def _spans_lines(spark: SparkSession, path: str) -> bool:
    """Does a quoted CSV value run over a line end? Its first line has an odd quote count."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return spark.read.text(path).where(quotes % 2 == 1).limit(1).count() > 0


def scan_csv(
    spark: SparkSession,
    path: str,
    types: dict[str, str] | None = None,
    multi_line: bool | None = None,
    on_error: str = "raise",
) -> DataFrame:
    """A UTF-8 CSV file, or a folder of them, with a header.

    The usual missing-value texts become NULL before any typing, so one ``NA`` does
    not turn a number column into text. The types of columns that are not in ``types``
    come from one aggregate, which also counts the values that a declared type cannot
    hold: ``on_error="raise"`` names them, ``"null"`` logs their number and makes them NULL.

    A file with line breaks inside quotes cannot be split between tasks, so by
    default one cheap scan finds out whether there are any; pass ``multi_line`` to
    skip it.
    """
    if multi_line is None:
        multi_line = _spans_lines(spark, path)
    raw = spark.read.csv(path, header=True, inferSchema=False, escape='"', multiLine=multi_line, encoding="UTF-8")
    texts = raw.select(*[F.when(~column(c).isin(*NA_TOKENS), column(c)).alias(c) for c in raw.columns])
    declared = types or {}
    inferred = _infer_types(texts, [c for c in texts.columns if c not in declared], declared, on_error)
    kinds = {**inferred, **declared}
    return nan_as_null(texts.select(*[column(c).try_cast(kinds[c]).alias(c) for c in texts.columns]))


_TYPE_PATTERNS = {
    "bigint": r"^\s*[+-]?[0-9]{1,18}\s*$",
    "decimal(38,0)": r"^\s*[+-]?[0-9]{1,38}\s*$",
    "double": r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+|inf|Infinity)([eE][+-]?[0-9]+)?\s*$",
    "boolean": r"^(true|True|TRUE|false|False|FALSE)$",
}


#: What a value that fits one of the patterns begins with, after blanks as ``\\s`` knows them.
_BLANKS, _NUMBER_STARTS, _BOOLEAN_STARTS = " \t\n\x0b\f\r", tuple("0123456789+-.iI"), tuple("tTfF")


def _fit(text: Column) -> Column:
    """Place in ``_TYPE_PATTERNS`` of the first pattern that a value fits, 4 if it fits none, NULL for NULL.

    A whole number fits ``decimal`` and ``double``, too, and a decimal fits ``double``; ``boolean`` excludes the others. So a
    value's first character and at most three patterns decide, and most texts need none.
    """
    bigint, decimal, double, boolean = (text.rlike(p) for p in _TYPE_PATTERNS.values())
    start = F.substring(F.ltrim(text, F.lit(_BLANKS)), 1, 1)
    number = F.when(bigint, 0).when(double, F.when(decimal, 1).otherwise(2)).otherwise(4)
    fit = F.when(start.isin(*_NUMBER_STARTS), number).when(start.isin(*_BOOLEAN_STARTS), F.when(boolean, 3).otherwise(4))
    return F.when(text.isNotNull(), fit.otherwise(4))


def _kind(least: int | None, most: int | None) -> str:
    """The type of a column by the least and greatest ``_fit`` of its values."""
    kinds = tuple(_TYPE_PATTERNS)
    if least is None or most > 3 or (most == 3 and least < 3):
        return "string"
    return kinds[most]


def _infer_types(
    texts: DataFrame, columns: Sequence[str], declared: dict[str, str], on_error: str
) -> dict[str, str]:
    """The narrowest of bigint, decimal, double, boolean and string that holds every value.

    Values are matched, not cast: a failing cast costs an exception per value. Each is given one small number, whose
    extremes per column tell the type. Declared columns are cast, and those with values that fail are told.
    """
    told = {c: kind for c, kind in declared.items() if c in texts.columns and kind != "string"}
    if not columns and not told:
        return {}
    # one short row per value, so that one expression, not one per column, is compiled
    entries = [F.struct(F.lit(i).alias("place"), column(name).alias("text"), F.lit(False).alias("bad")) for i, name in enumerate(columns)]
    for i, (c, kind) in enumerate(told.items(), len(columns)):
        fails = column(c).isNotNull() & column(c).try_cast(kind).isNull()
        entries.append(F.struct(F.lit(i).alias("place"), F.lit(None).cast("string").alias("text"), fails.alias("bad")))
    values = texts.select(F.inline(F.array(*entries))).select("place", "bad", _fit(F.col("text")).alias("fit"))
    extremes = values.groupBy("place").agg(F.min("fit").alias("least"), F.max("fit").alias("most"), F.count_if("bad").alias("bad"))
    found = {r["place"]: r for r in extremes.collect()}  # no rows, no entries
    bad = {c: found[i]["bad"] for i, c in enumerate(told, len(columns)) if i in found and found[i]["bad"]}
    if bad and on_error == "raise":
        raise ValueError(f"values that their declared types cannot hold, by column: {bad}")
    if bad:
        log.warning("values that their declared types cannot hold become NULL, by column: %s", bad)
    return {name: _kind(found[i]["least"], found[i]["most"]) if i in found else "string" for i, name in enumerate(columns)}


# --- JSON ------------------------------------------------------------------------

_END = "}"


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text cut after every closing brace: ``(file, block, place, value)``.

    A separator of its own lets Spark split a file anywhere, also one without line ends; a piece belongs to the block that it starts in.
    """
    raw = spark.read.option("lineSep", _END).text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )


def json_forms(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """``(file, is an array)`` for each file that isn't blank, by the file's own first character: one row per file."""
    said = _pieces(spark, path).where(F.trim(F.regexp_replace("value", r"[\s\uFEFF]+", "")) != "")
    first = F.min_by(F.regexp_extract("value", r"^[\s\uFEFF]*(.)", 1), F.struct("block", "place"))
    return [(unquote(r["file"]), r["first"] == "[") for r in said.groupBy("file").agg(first.alias("first")).orderBy("file").collect()]


def array_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The records of files that hold one array of flat records each, as lines of JSON in a column ``value``.

    A closing brace ends a record unless it stands inside a string, that is after an odd number of quotes since the start of the
    file, escaped ones not counted. The quotes of each block are added up first, one row per block; then every block
    counts on from what came before it, so blocks are cut into records side by side. Only records whose strings hold braces
    are put together from several pieces. Line ends between values become blanks, since inside strings they are escaped.
    """
    bare = F.regexp_replace("value", r"\\.", "")
    pieces = _pieces(spark, path).withColumn("quotes", F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit(""))))
    blocks = pieces.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    started = blocks.select("file", "block", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("start"))
    upto = Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = pieces.withColumn("upto", F.sum("quotes").over(upto)).join(started, ["file", "block"])
    after = F.col("start") + F.col("upto")
    inside = counted.select(
        "file", "block", "place", "value", ((after - F.col("quotes")) % 2 == 1).alias("begun"), (after % 2 == 1).alias("open")
    )
    inside = stage(inside, "json_pieces")
    whole = inside.where("NOT begun AND NOT open").select("value")
    parts = inside.where("begun OR open")
    in_file = Window.partitionBy("file").orderBy("block", "place")
    parts = parts.withColumn("record", F.count_if(~F.col("begun")).over(in_file))
    joined = parts.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "place", "value"))).alias("parts"))
    records = whole.unionByName(joined.select(F.array_join("parts.value", _END).alias("value")))
    # What is left of the array itself: the bracket and the commas before a record, and the bracket at the end.
    body = F.regexp_replace(F.regexp_replace("value", r"^[\s\uFEFF]*[\[,]?\s*", ""), r"[\r\n]+", " ")
    return records.select(body.alias("value")).where(~F.col("value").rlike(r"^\s*\]?\s*$")).select(F.concat("value", F.lit(_END)).alias("value"))


def scan_json(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, lines: bool | None = None
) -> DataFrame:
    """Arrays of flat records, or JSON Lines, or a folder that mixes such files; column-oriented documents are refused.

    Each file is judged by its own first character, in one scan that ``lines=True`` spares. Arrays are written once as JSON
    Lines to the shared work folder, by tasks that each take a part of a file, and read from there. A folder whose files
    are all blank has no columns unless a schema is given. Partition columns in folder names are kept for JSON Lines only.
    """
    forms = [] if lines else json_forms(spark, path)
    arrays = [file for file, array in forms if array]
    paths: str | list[str] = path
    if arrays:
        records = f"{work_dir(spark)}/records"
        array_records(spark, arrays).write.text(records)
        paths = [records, *[file for file, array in forms if not array]]
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.json(paths)
    nested = [f.name for f in df.schema if isinstance(f.dataType, (T.StructType, T.MapType, T.ArrayType))]
    if nested or df.columns == ["_corrupt_record"] or (arrays and not schema and "_corrupt_record" in df.columns):
        raise ValueError(f"not an array of flat records or JSON Lines: {path} (nested columns {nested})")
    return nan_as_null(df)


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A Parquet file or folder; filters and column choices reach the files."""
    reader = spark.read.schema(schema) if schema else spark.read
    return nan_as_null(reader.parquet(path))


def load_dataset(spark: SparkSession, path: str, types: dict[str, str] | None = None) -> DataFrame:
    """Read a path by its extension."""
    if not storage.exists(spark, path):
        raise FileNotFoundError(f"no such dataset: {path}")
    ext = detect_file_format(path)
    log.info("reading %s: %s, %s", path, FORMATS[ext], size_label(storage.total_bytes(spark, path)))
    if ext == ".csv":
        return scan_csv(spark, path, types)
    return scan_json(spark, path) if ext == ".json" else scan_parquet(spark, path)


def discover(spark: SparkSession, folder: str) -> str:
    """The first readable entry of a folder in name order."""
    if not storage.is_directory(spark, folder):
        raise NotADirectoryError(f"no such folder: {folder}")
    for name in storage.list_names(spark, folder):
        try:
            detect_file_format(name)
        except ValueError:
            continue
        return f"{folder.rstrip('/')}/{name}"
    raise FileNotFoundError(f"no readable dataset in {folder}; supported: {sorted(FORMATS)}")


def discover_and_load(spark: SparkSession, folder: str, types: dict[str, str] | None = None) -> DataFrame:
    """Read the first readable entry of a folder."""
    return load_dataset(spark, discover(spark, folder), types)


def reload_processed(spark: SparkSession, processed: str, raw: str | None = None) -> DataFrame | None:
    """The cleaned table if it is there, else the raw one, else None.

    Dates come back as timestamps; an unreadable one becomes NULL.
    """
    for path in (processed, raw):
        if path and storage.exists(spark, path):
            df = load_dataset(spark, path)
            dates = [
                f.name
                for f in df.schema
                if f.name in PROCESSED_DATES and isinstance(f.dataType, T.StringType)
            ]
            return df.withColumns({c: parse_timestamp(F.col(c), dayfirst=False) for c in dates}) if dates else df
    return None


def validate_schema(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """``(column, present)`` for each required column; no job."""
    present = set(df.columns)
    rows = [(c, c in present) for c in required]
    return literal_rows(df.sparkSession, {"column": "string", "present": "boolean"}, rows)


def require_schema(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """The frame itself, or an error that names the missing columns."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    return df


def size_label(size: int) -> str:
    """Bytes in megabytes of 2**20, as loading and saving report them."""
    return f"{size / 2**20:.2f} MB"


def load_summary(spark: SparkSession, path: str, df: DataFrame | None = None) -> DataFrame:
    """One row on a data set: ``(file, format, bytes, rows, cols, missing)``, its size on storage and what a scan finds.

    ``df`` is the frame as it was read from ``path``, by default ``load_dataset``. Rows and missing values come from one aggregate.
    """
    df = load_dataset(spark, path) if df is None else df
    name, kind = path.rstrip("/").rsplit("/", 1)[-1], FORMATS[detect_file_format(path)]
    totals = missing_by_column(df).agg(F.coalesce(F.max("row_count"), F.lit(0)).alias("rows"), F.coalesce(F.sum("null_count"), F.lit(0)).alias("missing"))
    size = F.lit(storage.total_bytes(spark, path)).cast("bigint")
    return totals.select(
        F.lit(name).alias("file"), F.lit(kind).alias("format"), size.alias("bytes"), "rows", F.lit(len(df.columns)).cast("bigint").alias("cols"), "missing"
    )


def load_profile(df: DataFrame) -> DataFrame:
    """Type, non-null count and null percentage per column, from one aggregate."""
    missing = missing_by_column(df)
    pct = percent_of(F.col("null_count").cast("double"), F.col("row_count").cast("double"))
    return missing.select(
        "column", "dtype", (F.col("row_count") - F.col("null_count")).alias("non_null"), pct.alias("null_pct")
    )


def file_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Every file below a folder: relative path, size label, time of change.

    Only the listing is read: the content column is pruned from the scan.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    kb = F.col("length") / F.lit(1024.0)
    size = F.when(kb < 1024, F.format_string("%.1f KB", kb)).otherwise(
        F.format_string("%.2f MB", kb / 1024)
    )
    root = folder.rstrip("/").rsplit("/", 1)[-1]
    relative = F.concat(F.lit(root + "/"), F.substring_index("path", f"/{root}/", -1))
    return files.select(
        relative.alias("file"),
        size.alias("size"),
        F.date_format("modificationTime", "yyyy-MM-dd HH:mm").alias("modified"),
        F.col("length").alias("bytes"),
    ).orderBy("file")
