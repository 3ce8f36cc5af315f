"""Calendar names, elapsed days and tolerant date parsing, all as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The labels a report shows.
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# A leading number that can only be a day, and a possible month that is
# followed by one. Matching is far cheaper than extracting and casting each number.
DAY_THEN_NUMBER = r"^(1[3-9]|[2-9][0-9])[-/.][0-9]"
MONTH_THEN_DAY = r"^(0?[0-9]|1[0-2])[-/.](1[3-9]|[2-9][0-9])"

_NUMERIC_DATE = r"^\s*(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})(?!\d)(.*)$"
_SHORT_YEAR = r"^\s*(\d{1,2})[-/.](\d{1,2})[-/.](\d{2})(?!\d)(.*)$"
_YEAR_FIRST = r"^\s*(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?!\d)(.*)$"
_HAS_MONTH_NAME = r"(?i)\d\D*(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)|(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)\D*\d"
_NAMED_MONTH = ("d MMMM yyyy", "d MMM yyyy", "MMMM d, yyyy", "MMM d, yyyy", "d-MMM-yyyy")

TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def is_temporal(dtype: T.DataType) -> bool:
    return isinstance(dtype, TEMPORAL)


def month_name(ts: Column) -> Column:
    """Full English month name; independent of locale and time zone."""
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month(ts))


def weekday_name(ts: Column) -> Column:
    """Full English weekday name."""
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAY_NAMES]), F.weekday(ts) + 1)


def weekday_rank(name: Column) -> Column:
    """Position of a weekday name in Monday..Sunday order."""
    return F.array_position(F.array(*[F.lit(d) for d in WEEKDAY_NAMES]), name)


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end``, rounded down (also below zero).

    The interval between two wall-clock times does not depend on the session time
    zone, and its parts are plain integers. Extracting days cuts towards zero.
    """
    elapsed = end - start
    days = F.extract(F.lit("DAY"), elapsed).cast("int")
    return F.when(elapsed < days * F.expr("INTERVAL '1' DAY"), days - 1).otherwise(days)


def parse_timestamp(text: Column, dayfirst: bool) -> Column:
    """A ``timestamp_ntz`` from text in mixed formats; NULL where nothing fits.

    Numeric dates are rewritten to ISO order and cast, so a time part is accepted
    after any of them. The usual ten-character forms are cut by position, which
    costs a fraction of a pattern match; the patterns are for all others. ``dayfirst`` only decides between readings that are both
    possible: under either setting 15/04/2018 and 04/15/2018 are the 15th of April.
    """

    def iso(pattern: str, order: str) -> Column:
        matched = F.when(text.rlike(pattern), F.regexp_replace(text, pattern, order))
        return F.rtrim(matched).try_cast("timestamp_ntz")

    def short(order: str) -> Column:
        year = F.regexp_extract(text, _SHORT_YEAR, 3).try_cast("int")
        century = F.when(year < 69, F.lit("20")).otherwise(F.lit("19"))
        matched = F.when(
            text.rlike(_SHORT_YEAR), F.concat(century, F.regexp_replace(text, _SHORT_YEAR, order))
        )
        return F.rtrim(matched).try_cast("timestamp_ntz")

    def cut(separators: tuple[int, int], parts: tuple[tuple[int, int], ...]) -> Column:
        shaped = F.length(text) == 10
        for at in separators:
            shaped = shaped & F.substring(text, at, 1).isin("/", "-", ".")
        ordered = F.concat_ws("-", *[F.substring(text, at, n) for at, n in parts])
        return F.when(shaped, ordered).try_cast("timestamp_ntz")

    year, leading, middle = (7, 4), (1, 2), (4, 2)
    day_cut, month_cut = cut((3, 6), (year, middle, leading)), cut((3, 6), (year, leading, middle))
    day_month, month_day = "$3-$2-$1$4", "$3-$1-$2$4"
    first, second = (day_month, month_day) if dayfirst else (month_day, day_month)
    # A pattern that does not fit costs an exception per value, hence the cheap test first.
    spelled = [F.try_to_date(F.trim(text), f).cast("timestamp_ntz") for f in _NAMED_MONTH]
    others = F.coalesce(
        iso(_NUMERIC_DATE, first),
        iso(_NUMERIC_DATE, second),
        iso(_YEAR_FIRST, "$1-$2-$3$4"),
        short(first),
        short(second),
        F.when(text.rlike(_HAS_MONTH_NAME), F.coalesce(*spelled)),
    )
    return F.coalesce(
        *((day_cut, month_cut) if dayfirst else (month_cut, day_cut)),
        cut((5, 8), ((1, 4), (6, 2), (9, 2))),
        F.when(text.rlike("[0-9]"), others),
    )


def dayfirst_evidence(text: Column, count: Column | None = None) -> tuple[Column, Column]:
    """Aggregates: how many values prove day-first order, and how many month-first. A row stands for ``count`` values."""

    def values(pattern: str) -> Column:
        proves = text.rlike(pattern)
        found = F.count_if(proves) if count is None else F.sum(F.when(proves, count))
        return F.coalesce(found, F.lit(0).cast("bigint"))

    return values(DAY_THEN_NUMBER), values(MONTH_THEN_DAY)


def decide_dayfirst(day: int, month: int) -> bool | None:
    """One kind of evidence decides; none or both leave it open."""
    if bool(day) == bool(month):
        return None
    return bool(day)
