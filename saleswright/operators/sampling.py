"""Repeatable samples: exact-size without, and fixed-size with replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleswright.functions.dates import parse_timestamp
from saleswright.functions.missing import column
from saleswright.functions.numeric import round_half_up
from saleswright.workspace import stage

# Size of the scatter sample and of the enlarged table.
SCATTER_ROWS = 2_000
BOOTSTRAP_ROWS = 100_000


def bounded_sample(
    df: DataFrame, keys: Sequence[str], size: int = SCATTER_ROWS, seed: int = 42
) -> DataFrame:
    """``min(size, n)`` rows without replacement, the same ones on every run.

    A row's place is the MD5 of its keys and the seed; the first ``size`` rows are
    the sample. So that the tasks do not each send ``size`` rows to the last one,
    a first pass counts rows by the number of leading zeros of the hash, and only
    rows with enough zeros to still hold the whole sample are sorted.
    """
    text = F.concat_ws(":", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    placed = df.withColumn("_h", F.md5(text.cast("binary")))
    placed = placed.withColumn("_z", F.length("_h") - F.length(F.ltrim("_h", F.lit("0"))))
    per_zeros = placed.groupBy("_z").agg(F.count("*").alias("_n"))
    # At most 33 rows: an unpartitioned window is fine.
    at_least = Window.orderBy(F.col("_z").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    enough = per_zeros.withColumn("_c", F.sum("_n").over(at_least)).where(F.col("_c") >= size)
    cut = enough.agg(F.coalesce(F.max("_z"), F.lit(0))).scalar()
    candidates = placed.where(F.col("_z") >= cut)
    return candidates.orderBy("_h", *df.columns).limit(size).drop("_h", "_z")


# --- draws with replacement --------------------------------------------------------

#: Hexadecimal digits of a row's place that pick its bucket, and its cell. A bucket's cells are sorted in one task.
BUCKET_DIGITS, CELL_DIGITS = 4, 8
#: Blocks of places in which draws look for their bucket side by side.
BLOCKS = 1024


def _draw(salt: str, seed: int, digits: int) -> Column:
    """A repeatable whole number below ``16 ** digits`` per draw, from an MD5 that other engines compute alike."""
    text = F.concat(F.lit(f"{salt}:{seed}:"), F.col("_id").cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("bigint")


def _uniform(salt: str, seed: int) -> Column:
    """A repeatable number in [0, 1) per draw."""
    return _draw(salt, seed, 13) / F.lit(float(1 << 52))


def _placed(df: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    """Rows with their place ``_h``, an MD5 of the keys, and the bucket and cell that its first digits name."""
    text = F.concat_ws(":", *[F.coalesce(column(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    placed = df.withColumn("_h", F.md5(text.cast("binary")))
    bucket = F.conv(F.substring("_h", 1, BUCKET_DIGITS), 16, 10).cast("int")
    return placed.withColumn("_b", bucket).withColumn("_c", F.substring("_h", 1, CELL_DIGITS))


def _assign(ranges: DataFrame, draws: DataFrame, by: str, value: str) -> DataFrame:
    """Each draw with the ``value`` of the range that its ``_k`` falls into, per ``by``.

    ``ranges`` start at ``_s`` and cover a group without gaps. Both are merged in order: a draw takes the last range
    that started, so no range is compared with a draw that isn't in it.
    """
    marks = ranges.select(by, F.col("_s").alias("_k"), F.lit(None).cast("bigint").alias("_id"), value, "_s")
    asked = draws.select(by, "_k", "_id", F.lit(None).cast(ranges.schema[value].dataType).alias(value), F.lit(None).cast("bigint").alias("_s"))
    order = Window.partitionBy(by).orderBy("_k", F.col("_id").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last(F.when(F.col("_id").isNull(), F.struct(value, "_s")), ignorenulls=True).over(order)
    found = marks.unionByName(asked).withColumn("_r", last).where(F.col("_id").isNotNull())
    return found.select("_id", F.col(f"_r.{value}").alias(value), (F.col("_k") - F.col("_r._s")).alias("_k"))


def _before(by: str, *order) -> Column:
    """Rows of the group before this range."""
    return F.coalesce(F.sum("_n").over(Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def drawn_rows(df: DataFrame, size: int, seed: int = 42, keys: Sequence[str] | None = None) -> DataFrame:
    """``size`` rows drawn with replacement, with the draw's number ``_id`` from 1.

    All rows are thought of in the order of an MD5 of their ``keys`` (all columns by default), equal ones by their
    columns; a draw takes the row at an MD5 of its number modulo the row count. So the draws depend on the rows alone,
    not on files, partitions or their order. No row is moved for its number: rows are counted by cell, the first
    digits of the MD5, the counts of the cells become ranges, and only rows of cells that hold a draw are put in order,
    copies counted and not repeated. Cells shuffle at most 2^32 narrow rows. ``keys`` should tell
    rows apart, because unequal rows with equal keys meet in one cell. Columns must be sortable (no maps). An empty
    table gives no rows.
    """
    keys = df.columns if keys is None else list(keys)
    placed = _placed(df, keys, seed)
    cells = stage(placed.groupBy("_b", "_c").agg(F.count("*").alias("_n")), "cells")
    total = cells.agg(F.sum("_n")).first()[0]
    if not total:
        return df.limit(0).withColumn("_id", F.lit(0).cast("bigint"))
    # One row per bucket, at most 65,536: an unpartitioned window is fine. A range is listed in each block of places it reaches into.
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = cells.groupBy("_b").agg(F.sum("_n").alias("_n")).withColumn("_s", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    width = -(-total // BLOCKS)
    first, last = (F.expr(f"({place}) div {width}") for place in ("_s", "_s + _n - 1"))
    buckets = counts.withColumn("_block", F.explode(F.sequence(first, last)))
    draws = df.sparkSession.range(1, size + 1).withColumnRenamed("id", "_id")
    draws = draws.withColumn("_k", F.pmod(_draw("row", seed, 15), F.lit(total))).withColumn("_block", F.expr(f"_k div {width}"))
    draws = _assign(buckets, draws, "_block", "_b")
    in_cells = stage(_assign(cells.withColumn("_s", _before("_b", "_c")), draws, "_b", "_c"), "draws")
    wanted = placed.join(in_cells.select("_c").distinct(), "_c", "left_semi")
    rows = wanted.groupBy("_c", "_h", *[column(c) for c in df.columns]).agg(F.count("*").alias("_n"))
    ranges = rows.select(
        "_c", _before("_c", "_h", *[column(c) for c in df.columns]).alias("_s"), F.struct(*[column(c) for c in df.columns]).alias("_row")
    )
    return _assign(ranges, in_cells, "_c", "_row").select("_row.*", "_id")


def bootstrap_resample(
    df: DataFrame, size: int = BOOTSTRAP_ROWS, seed: int = 42, keys: Sequence[str] | None = None
) -> DataFrame:
    """``size`` raw rows drawn with replacement, with varied sales, dates and ids.

    ``Row ID`` runs from 1, ``Sales`` is scaled by 0.85 to 1.15, both dates move on
    by 1 to 364 days (as dd/MM/yyyy text), and the last four characters of
    ``Order ID`` become a number from 1000 to 9998. All draws are hashes of the row
    id, and ``drawn_rows`` says which rows they take, so another order or partitioning of the input
    gives the same result. Dates are read in either order, so none is lost on the way.
    """
    columns = df.columns
    out = drawn_rows(df, size, seed, keys)
    if "Row ID" in columns:
        out = out.withColumn("Row ID", F.col("_id"))
    if "Sales" in columns:
        noise = F.lit(0.85) + _uniform("sales", seed) * F.lit(0.3)
        out = out.withColumn("Sales", F.col("Sales") * noise).withColumn("Sales", round_half_up("Sales"))
    for name in ("Order Date", "Ship Date"):
        if name in columns:
            stamp = F.col(name)
            if dict(df.dtypes)[name] == "string":
                stamp = parse_timestamp(stamp, dayfirst=True)
            days = (F.floor(_uniform(name, seed) * 364) + 1).cast("int")
            moved = F.date_add(stamp.cast("date"), days)
            out = out.withColumn(name, F.date_format(moved, "dd/MM/yyyy"))
    if "Order ID" in columns:
        number = (F.floor(_uniform("order", seed) * 8999) + 1000).cast("string")
        text = F.col("Order ID").cast("string")
        kept = F.substring(text, F.lit(1), F.greatest(F.length(text) - 4, F.lit(0)))
        out = out.withColumn("Order ID", F.concat(kept, number))
    return out.select(*columns)
