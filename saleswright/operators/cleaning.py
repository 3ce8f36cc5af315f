"""Cleaning: names, duplicates, missing values, text dates.

Decisions that depend on the data (which columns have gaps, what to fill in, how to
read dates) take a fixed number of aggregate jobs whatever the number of columns,
and bring one row per column to the driver. The cleaned frame itself is then a
projection with a look-up of the distinct date texts: no shuffle besides the one that removes duplicates.
"""

from __future__ import annotations

import logging
import os
import re
from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswright.functions.dates import dayfirst_evidence, decide_dayfirst, parse_timestamp
from saleswright.functions.missing import column, is_missing, missing_by_column
from saleswright.functions.numeric import percent_of
from saleswright.functions.quantiles import exact_quantiles
from saleswright.functions.rows import literal_rows
from saleswright.operators.features import QUARTILES, engineer_features
from saleswright.workspace import discard, stage

log = logging.getLogger(__name__)

# Fixed values.
FLAG_THRESHOLD_PCT = 5.0
FLAG_SUFFIX = "_was_missing"
UNKNOWN = "Unknown"
ALL_COLUMNS = "(all columns)"
DATE_NAME_PARTS = ("date", "time", "timestamp", "created", "updated", "dt")
DAYFIRST_VARIABLE = "SALES_DAYFIRST"
#: Distinct texts up to which dates are looked up; beyond, parsing in place is cheaper than shuffling the rows.
DICTIONARY_TEXTS = 200_000
#: Keys of repeated rows up to which they are sent to all tasks: 8 MB.
FEW_KEYS = 500_000
#: Bits of the table that stands for more of them: about ``KEY_BITS`` a key, from 2**16 to 2**28 (32 MB), in rows of ``WORDS`` words.
KEY_BITS, LEAST_BITS, MOST_BITS, WORDS = 32, 16, 28, 64


# --- names -----------------------------------------------------------------------


def standardized_name(name: str) -> str:
    """snake_case: separators become single underscores, other symbols disappear."""
    words = re.sub(r"[ \-/]", "_", name.strip())
    return re.sub(r"_+", "_", re.sub(r"\W", "", words).lower()).strip("_")


def standardize_columns(df: DataFrame) -> DataFrame:
    """All columns in snake_case; two that would get the same name are an error."""
    names = {c: standardized_name(c) for c in df.columns}
    clash = {n for n, times in Counter(names.values()).items() if times > 1}
    if clash:
        sources = [c for c in df.columns if names[c] in clash]
        raise ValueError(f"columns get the same name {sorted(clash)}: {sources}")
    return df.toDF(*[names[c] for c in df.columns])


# --- duplicates ------------------------------------------------------------------


def remove_duplicates(df: DataFrame) -> DataFrame:
    """One of each set of equal rows; NULL equals NULL and NaN equals NaN.

    Copies collapse before the shuffle, whose key is the whole row.
    """
    return df.dropDuplicates()


def _row_keys(df: DataFrame) -> list[Column]:
    """A 128-bit key of a row: equal rows have equal keys; NaN equals NaN, and NULL is told from other values by its place."""
    values = [column(c) for c in df.columns]
    gaps = [column(f.name).isNull() for f in df.schema if f.nullable]
    return [F.xxhash64(F.lit(1), *values, *gaps), F.xxhash64(F.lit(2), *reversed(gaps), *reversed(values))]


def _with_shared_bit(keyed: DataFrame, repeated: DataFrame, known: int) -> DataFrame:
    """``keyed`` with ``_key_shared``: whether a row's key has a bit that one of the ``known`` keys in ``repeated`` has set.

    Bits lie 64 to a word and ``WORDS`` words to a row, so that the table is small enough to be sent to all tasks.
    """
    bits = min(max((KEY_BITS * known).bit_length(), LEAST_BITS), MOST_BITS)
    place = F.shiftrightunsigned(F.col("_key1").cast("bigint"), 64 - bits)
    row, word = F.shiftright(place, 12), F.shiftright(place, 6).bitwiseAND(F.lit(WORDS - 1)).cast("int")
    bit = place.bitwiseAND(F.lit(63)).cast("int")
    placed = repeated.select(row.alias("_key_row"), word.alias("_word"), bit.alias("_bit"))
    words = placed.groupBy("_key_row", "_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_set"))
    rows = words.groupBy("_key_row").agg(F.map_from_entries(F.collect_list(F.struct("_word", "_set"))).alias("_sets"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda i: F.coalesce(F.try_element_at("_sets", i), F.lit(0).cast("bigint")))
    table = rows.select("_key_row", dense.alias("_key_words"))
    found = keyed.withColumn("_key_row", row).join(F.broadcast(table), "_key_row", "left")
    shared = F.call_function("shiftright", F.get("_key_words", word), bit).bitwiseAND(F.lit(1)) == 1
    return found.withColumn("_key_shared", F.coalesce(shared, F.lit(False)))


def remove_few_duplicates(df: DataFrame) -> DataFrame:
    """``remove_duplicates`` for a table that is cheap to read and holds few copies: few rows are shuffled.

    A first pass shuffles 16 bytes per row, the row's key, and keeps the keys that occur more than once. Rows with a key of
    their own stay where they are; only the others are shuffled and compared in full, so unequal rows that
    happen to share a key are both kept. Up to ``FEW_KEYS`` repeated keys (16 bytes each) are sent to all tasks; of
    more, a table of at most 2**``MOST_BITS`` bits. Rows that share a bit with a repeated key are shuffled and compared, too, so
    the result doesn't depend on its size. The frame is read twice.
    """
    first, second = _row_keys(df)
    keyed = df.withColumns({"_key1": first, "_key2": second})
    counts = keyed.select("_key1", "_key2").groupBy("_key1", "_key2").agg(F.count("*").alias("_n"))
    repeated = stage(counts.where("_n > 1").select("_key1", "_key2"), "repeated_keys")
    known = repeated.count()
    if known > FEW_KEYS:
        flagged = _with_shared_bit(keyed, repeated, known)
        copies = flagged.where("_key_shared").select(*[column(c) for c in df.columns]).dropDuplicates()
        return flagged.where("NOT _key_shared").select(*[column(c) for c in df.columns]).unionByName(copies)
    few, on = F.broadcast(repeated), ["_key1", "_key2"]
    copies = keyed.join(few, on, "left_semi").select(*[column(c) for c in df.columns]).dropDuplicates()
    return keyed.join(few, on, "left_anti").select(*[column(c) for c in df.columns]).unionByName(copies)


def _hash_tells_equal(kind: T.DataType) -> bool:
    """Do equal values of a type have equal hashes? Not with a collation; nested types are left out, maps have none."""
    if isinstance(kind, T.StringType):
        return getattr(kind, "collation", "UTF8_BINARY") == "UTF8_BINARY"
    return isinstance(kind, (T.NumericType, T.BooleanType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType))


def staged_without_duplicates(df: DataFrame) -> DataFrame:
    """``remove_duplicates``, written once to shared storage.

    The frame itself is written first, so that what it shuffles can go before anything else is shuffled. Then rows are told
    apart by their keys, and whole rows are shuffled only where a key occurs twice; the first copy goes at the end.
    """
    if not all(_hash_tells_equal(f.dataType) for f in df.schema):
        return stage(remove_duplicates(df), "deduplicated")
    rows = stage(df, "with_duplicates")
    once = stage(remove_few_duplicates(rows), "deduplicated")
    discard(rows)
    return once


def duplicate_report(df: DataFrame) -> DataFrame:
    """Rows before, rows after and rows removed, in one pass."""
    sizes = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return sizes.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_before"),
        F.count("*").alias("rows_after"),
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


# --- missing values --------------------------------------------------------------


def null_report(df: DataFrame) -> DataFrame:
    """Columns with missing values and what imputation does about them."""
    found = missing_by_column(df).where(F.col("null_count") > 0)
    pct = percent_of(F.col("null_count").cast("double"), F.col("row_count").cast("double"))
    strategy = (
        F.when((F.col("kind") == "numeric") & (F.col("null_pct") >= FLAG_THRESHOLD_PCT), "median + flag")
        .when(F.col("kind") == "numeric", "median")
        .when(F.col("kind") == "temporal", "left null")
        .when(F.col("null_count") == F.col("row_count"), "unknown")
        .otherwise("mode")
    )
    found = found.withColumn("null_pct", pct).withColumn("strategy", strategy)
    return found.select("column", "null_count", "null_pct", "strategy")


def imputation_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(column, missing_before, missing_after, filled)`` for each column that had gaps, and a row ``(all columns)`` with the totals.

    Two aggregates, one per frame; columns that imputation adds count as having had none. The totals are there
    when nothing is missing, too.
    """
    old = missing_by_column(before).select("column", F.col("null_count").alias("missing_before"))
    new = missing_by_column(after).select("column", F.col("null_count").alias("missing_after"))
    both = old.join(new, "column", "full").na.fill(0, ["missing_before", "missing_after"])
    each = both.where("missing_before > 0 OR missing_after > 0")
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("missing_before", "missing_after")]
    found = each.unionByName(both.agg(F.lit(ALL_COLUMNS).alias("column"), *sums))
    return found.withColumn("filled", F.col("missing_before") - F.col("missing_after"))


@dataclass(frozen=True)
class Fill:
    """What to do about one column's gaps. ``value`` is None when nothing is known."""

    column: str
    strategy: str  # median | mode | unknown
    value: float | str | None
    flag: bool = False


def column_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact medians of several columns in one pass: ``(column, median)``."""
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    long = values.unpivot([], list(columns), "column", "value")
    return exact_quantiles(long, "value", (0.5,), ["column"]).select(
        "column", F.col("quantiles")[0].alias("median")
    )


def column_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent text of several columns in one pass, ties to the smallest.

    The shuffle carries one row per distinct (column, value), so a value that fills
    a third of the table is counted where it lies.
    """
    values = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = values.unpivot([], list(columns), "column", "value").where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count("*").alias("_n"))
    return counts.groupBy("column").agg(
        F.min_by("value", F.struct((-F.col("_n")).alias("a"), F.col("value").alias("b"))).alias("mode")
    )


def column_fills(df: DataFrame) -> list[Fill]:
    """Decide all fills: one job for the gaps, one each for medians and modes."""
    gaps = [r for r in missing_by_column(df).collect() if r.null_count > 0]
    numeric = [r.column for r in gaps if r.kind == "numeric"]
    text = [r.column for r in gaps if r.kind == "text"]
    medians = {r.column: r.median for r in column_medians(df, numeric).collect()} if numeric else {}
    modes = {r.column: r.mode for r in column_modes(df, text).collect()} if text else {}
    fills = []
    for r in gaps:
        if r.kind == "numeric":
            flag = 100.0 * r.null_count / r.row_count >= FLAG_THRESHOLD_PCT
            fills.append(Fill(r.column, "median", medians.get(r.column), flag))
        elif r.kind == "text":
            known = r.column in modes
            fills.append(Fill(r.column, "mode" if known else "unknown", modes.get(r.column, UNKNOWN)))
    return fills


def apply_fills(df: DataFrame, fills: Iterable[Fill], flags: bool = True, values: bool = True) -> DataFrame:
    """A projection that fills gaps and appends ``<column>_was_missing`` flags.

    A filled number is a double, since a median may lie between two integers.
    """
    by_name = {f.column: f for f in fills}
    out = []
    for field in df.schema:
        fill = by_name.get(field.name)
        if not values or fill is None or fill.value is None:
            out.append(F.col(field.name))
        elif fill.strategy == "median":
            known = F.when(~is_missing(df, field.name), F.col(field.name).cast("double"))
            out.append(F.coalesce(known, F.lit(fill.value)).alias(field.name))
        elif fill.strategy == "unknown" and not isinstance(field.dataType, T.StringType):
            out.append(F.coalesce(F.col(field.name).cast("string"), F.lit(fill.value)).alias(field.name))
        else:
            filler = F.lit(fill.value).cast(field.dataType)
            out.append(F.coalesce(F.col(field.name), filler).alias(field.name))
    for fill in by_name.values():
        if flags and fill.flag:
            out.append(is_missing(df, fill.column).cast("int").alias(fill.column + FLAG_SUFFIX))
    return df.select(*out)


def _fills(df: DataFrame, strategy: str) -> list[Fill]:
    return [f for f in column_fills(df) if f.strategy == strategy]


def impute_median(df: DataFrame) -> DataFrame:
    """Fill numeric gaps with the exact median; no flags."""
    return apply_fills(df, _fills(df, "median"), flags=False)


def missing_indicator(df: DataFrame) -> DataFrame:
    """Add a flag per numeric column with 5 % or more missing; fill nothing."""
    return apply_fills(df, _fills(df, "median"), values=False)


def impute_mode(df: DataFrame) -> DataFrame:
    """Fill text gaps with the most frequent value."""
    return apply_fills(df, _fills(df, "mode"))


def impute_unknown(df: DataFrame) -> DataFrame:
    """Fill text columns that have no value at all with ``"Unknown"``."""
    return apply_fills(df, _fills(df, "unknown"))


def impute_missing(df: DataFrame) -> DataFrame:
    """All of the above; typed date columns keep their nulls."""
    return apply_fills(df, column_fills(df))


# --- dates -----------------------------------------------------------------------


def date_candidates(df: DataFrame) -> list[str]:
    """Text columns whose name hints at a date."""
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.StringType) and any(p in f.name.lower() for p in DATE_NAME_PARTS)
    ]


@dataclass(frozen=True)
class DateReading:
    """How to read one text column: order of the parts, and can every value be read; with the values that prove it."""

    column: str
    dayfirst: bool | None
    readable: bool
    day_first: int = 0
    month_first: int = 0
    unread: int = 0


def date_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, text, n, day_first, month_first)``: every distinct text with its number of rows and both readings, written once.

    One pass over the rows brings all columns along; copies of a text collapse before the shuffle, so a text is parsed
    once, however often it occurs.
    """
    texts = F.array(*[F.struct(F.lit(i).alias("column"), column(c).alias("text")) for i, c in enumerate(columns)])
    each = df.select(F.inline(texts)).where("text IS NOT NULL").groupBy("column", "text").agg(F.count("*").alias("n"))
    both = {name: parse_timestamp(F.col("text"), first) for name, first in (("day_first", True), ("month_first", False))}
    return stage(each.withColumns(both), "date_texts")


def date_readings(df: DataFrame, columns: Sequence[str] | None = None, dictionary: DataFrame | None = None) -> list[DateReading]:
    """Evidence and readability of all candidate columns, one row each, from their distinct texts.

    Every row counts, not a sample: without a row order a sample would not be
    repeatable. Readability does not depend on the order that is chosen, because
    each value is tried in both.
    """
    columns = date_candidates(df) if columns is None else list(columns)
    if not columns:
        return []
    texts = date_dictionary(df, columns) if dictionary is None else dictionary
    day, month = dayfirst_evidence(F.col("text"), F.col("n"))
    unread = F.coalesce(F.sum(F.when(F.col("day_first").isNull(), F.col("n"))), F.lit(0))
    found = {r["column"]: r for r in texts.groupBy("column").agg(day.alias("day"), month.alias("month"), unread.alias("unread")).collect()}
    readings = []
    for i, name in enumerate(columns):
        row = found.get(i)  # a column without texts proves nothing and is readable
        day_first, month_first, unread_ = (row["day"], row["month"], row["unread"]) if row else (0, 0, 0)
        readings.append(DateReading(name, decide_dayfirst(day_first, month_first), unread_ == 0, day_first, month_first, unread_))
    return readings


def infer_dayfirst(df: DataFrame, column: str) -> bool | None:
    """True for day-first, False for month-first, None when the data leave it open."""
    row = df.agg(*dayfirst_evidence(F.col(column))).first()
    return decide_dayfirst(row[0], row[1])


def dayfirst_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Evidence per date column, lazily: ``(column, day_first, month_first, dayfirst)``; the middle two count values."""
    columns = date_candidates(df) if columns is None else list(columns)
    schema = {"column": "string", "day_first": "bigint", "month_first": "bigint"}
    if not columns:
        return literal_rows(df.sparkSession, {**schema, "dayfirst": "boolean"}, [])
    row = df.agg(
        *[F.struct(*dayfirst_evidence(F.col(c))).alias(f"e{i}") for i, c in enumerate(columns)]
    )
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"e{i}.col1").alias("day_first"),
            F.col(f"e{i}.col2").alias("month_first"),
        )
        for i, c in enumerate(columns)
    ]
    day, month = F.col("day_first") > 0, F.col("month_first") > 0
    decided = F.when(day != month, day)
    return row.select(F.inline(F.array(*entries))).withColumn("dayfirst", decided)


def default_dayfirst() -> bool:
    """The order to assume where the data leave it open."""
    return os.environ.get(DAYFIRST_VARIABLE, "false").strip().lower() == "true"


def _ambiguous(reading: DateReading, on_ambiguous: str) -> None:
    order = "day first" if default_dayfirst() else "month first"
    said = (
        f"the dates in {reading.column} prove no single order ({reading.day_first} values are day first, {reading.month_first} month first); "
        f"{order} is assumed (set {DAYFIRST_VARIABLE} to change that)"
    )
    if on_ambiguous == "error":
        raise ValueError(said)
    log.warning(said)


def apply_readings(
    df: DataFrame, readings: Iterable[DateReading], on_error: str = "keep", on_ambiguous: str = "default", dictionary: DataFrame | None = None
) -> DataFrame:
    """Turn readable text columns into ``timestamp_ntz``.

    ``on_error="keep"`` leaves a column with any unreadable value as text;
    ``"null"`` converts it and nulls those values. Where the values prove no order, or
    both, ``on_ambiguous="default"`` takes the default order and says so in the log;
    ``"error"`` raises. With the ``dictionary`` of these ``readings`` a text is looked up by
    equality instead of being parsed in every row, as long as it has no more than ``DICTIONARY_TEXTS`` texts.
    """
    readings, parsed = list(readings), {}
    look_up = dictionary is not None and dictionary.count() <= DICTIONARY_TEXTS
    for i, r in enumerate(readings):
        if r.readable or on_error == "null":
            if r.dayfirst is None:
                _ambiguous(r, on_ambiguous)
            order = default_dayfirst() if r.dayfirst is None else r.dayfirst
            if look_up:
                key, value = f"_text_{i}", f"_read_{i}"
                texts = dictionary.where(F.col("column") == i).select(F.col("text").alias(key), F.col("day_first" if order else "month_first").alias(value))
                df = df.join(texts, column(r.column) == F.col(key), "left").drop(key)
                parsed[r.column] = F.col(value)
            else:
                parsed[r.column] = parse_timestamp(column(r.column), order)
    if not parsed:
        return df
    return df.withColumns(parsed).drop(*[f"_read_{i}" for i in range(len(readings))])


def convert_dates(
    df: DataFrame, columns: Sequence[str] | None = None, on_error: str = "keep", on_ambiguous: str = "default"
) -> DataFrame:
    """Parse the text date columns, each in the order its own values prove."""
    columns = date_candidates(df) if columns is None else list(columns)
    if not columns:
        return df
    texts = date_dictionary(df, columns)
    return apply_readings(df, date_readings(df, columns, texts), on_error, on_ambiguous, texts)


# --- all together ----------------------------------------------------------------


def clean_and_transform(df: DataFrame, dates_first: bool = False, staged: bool = True, on_ambiguous: str = "default") -> DataFrame:
    """Names, duplicates, gaps, dates, features, in that order. ``on_ambiguous`` is that of ``apply_readings``.

    The frame without duplicates is written once to shared storage, because several
    passes follow; each of them reads only its own columns. ``dates_first`` parses
    dates before imputation, so that a missing text date stays null instead of
    taking the most frequent one. ``staged=False`` skips the write, for inputs that
    are cheap to recompute.
    """
    df = standardize_columns(df)
    df = staged_without_duplicates(df) if staged else remove_duplicates(df)
    # Filling with a value that already occurs changes neither the evidence for a
    # date order nor readability, so both are decided on the same frame.
    if dates_first:
        df = convert_dates(df, on_ambiguous=on_ambiguous)
        df = apply_fills(df, column_fills(df))
    else:
        fills = column_fills(df)
        emptied = {f.column for f in fills if f.strategy == "unknown"}
        dated = [c for c in date_candidates(df) if c not in emptied]
        texts = date_dictionary(df, dated) if dated else None
        df = apply_readings(apply_fills(df, fills), date_readings(df, dated, texts), on_ambiguous=on_ambiguous, dictionary=texts)
    edges = None
    if "sales" in df.columns:
        found = exact_quantiles(df, "sales", QUARTILES).first().quantiles
        edges = found if all(e is not None for e in found) else [None] * len(QUARTILES)
    return engineer_features(df, edges)
