"""Order-independent money arithmetic.

A sum of doubles depends on the order in which partitions are merged, so the same
report could differ by a cent between two runs. A value is therefore split into whole
numbers of fixed units, which are summed exactly in decimal space; only the totals
become doubles again and are added in a fixed order, the largest units first.

Up to ``_PLAIN`` the first unit is a ten-thousandth, so that money with up to four
decimals is summed as what it says; what a value has beyond that is summed in units of
2**-66 and 2**-118. Larger values are summed in units of 2**50 and 2**-13, exact up to
2**113; beyond that (10**34) doubles are added as they are, to the last digit or so.
NaN is a missing value, infinity makes the sum infinite.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimal places of the first unit, and the values below which it is used.
MONEY_SCALE = 4
_PLAIN, _LARGEST = 2.0**39, 2.0**113


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def known_value(value: str) -> str:
    """SQL of a value as a double, NaN as NULL."""
    return f"nullif(CAST({value} AS DOUBLE), CAST('NaN' AS DOUBLE))"


def _limbs(value: str, weight: str | None = None) -> list[tuple[str, str]]:
    """``(SQL of a row's units, SQL from their total to its share of the sum)``, the smallest values' units first.

    Units that a value has none of are NULL, so ordinary money is one addition a row. A row may stand for
    ``weight`` equal ones.
    """
    x, unit = known_value(value), f"{10**MONEY_SCALE}D"

    def units(whole: str, where: str) -> str:
        one = f"CAST(CAST(CASE WHEN {where} THEN {whole} END AS BIGINT) AS DECIMAL(20,0))"
        return f"{one} * CAST({weight} AS DECIMAL(17,0))" if weight else one

    plain, large = f"abs({x}) < {_PLAIN!r}D", f"abs({x}) >= {_PLAIN!r}D AND abs({x}) < {_LARGEST!r}D"
    rest = f"({x} - rint({x} * {unit}) / {unit}) * {2.0**66!r}D"
    high = f"floor({x} * {2.0**-50!r}D)"
    largest = f"CASE WHEN abs({x}) >= {_LARGEST!r}D THEN {x} END"
    return [
        (units(f"rint({x} * {unit})", plain), f"/ {unit}"),
        (units(f"floor({rest})", f"{plain} AND {rest} <> 0"), f"* {2.0**-66!r}D"),
        (units(f"({rest} - floor({rest})) * {2.0**52!r}D", f"{plain} AND {rest} <> 0"), f"* {2.0**-118!r}D"),
        (units(high, large), f"* {2.0**50!r}D"),
        (units(f"({x} - {high} * {2.0**50!r}D) * {2.0**13!r}D", large), f"* {2.0**-13!r}D"),
        (f"{largest} * {weight}" if weight else largest, ""),
    ]


def known_count(value: str, weight: str | None = None) -> str:
    """SQL of the number of known values."""
    return f"sum(CASE WHEN {known_value(value)} IS NOT NULL THEN {weight} ELSE 0 END)" if weight else f"count({known_value(value)})"


def sum_parts(value: str, prefix: str, weight: str | None = None) -> dict[str, str]:
    """Column -> SQL aggregate: what an exact sum is made of. The parts of several groups add up to those of their union."""
    return {f"{prefix}{k}": f"sum({row})" for k, (row, _) in enumerate(_limbs(value, weight))}


def sum_of_parts(parts: list[str]) -> str:
    """SQL of the exact sum as a double from SQL of the totals of ``sum_parts``."""
    sizes = [size for _, size in _limbs("0D")]
    return " + ".join(reversed([f"coalesce(CAST({part} AS DOUBLE), 0D) {size}" for part, size in zip(parts, sizes, strict=True)]))


def exact_sum(value: str, weight: str | None = None) -> Column:
    """Sum of a money column (SQL text) as a double, the same in any order; NULL when there is no value.

    Each decimal(20,0) unit gives a decimal(30,0) buffer, so 10**10 rows of the largest
    units, and more of ordinary ones, can't overflow. With a ``weight`` (SQL text of a whole number) a row counts that often.
    """
    parts = list(sum_parts(value, "", weight).values())
    return F.expr(f"CASE WHEN {known_count(value, weight)} > 0 THEN {sum_of_parts(parts)} END")


def exact_mean(value: str, weight: str | None = None) -> Column:
    """Exact sum over the number of known values."""
    return F.try_divide(exact_sum(value, weight), F.expr(known_count(value, weight)))


def round_half_up(value: str, digits: int = 2) -> Column:
    """Round a double (SQL text) half away from zero, in binary arithmetic.

    Spark's own ``round`` goes through the decimal text of a double; scaling and
    flooring gives the same result in every engine. ``floor`` gives a bigint, so
    there is no ``-0.0``. From 2**53 units on a double has no digits left to round.
    """
    unit = f"{10**digits}D"
    down, up = f"-floor(-({value}) * {unit} + 0.5D)", f"floor(({value}) * {unit} + 0.5D)"
    return F.expr(
        f"CASE WHEN abs({value}) * {unit} < {2.0**53!r}D "
        f"THEN (CASE WHEN ({value}) < 0 THEN {down} ELSE {up} END) / {unit} ELSE CAST({value} AS DOUBLE) END"
    )


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; NULL for an empty or zero whole."""
    return F.try_divide(part * F.lit(100.0), whole)


def nan_to_null(col: Column | str) -> Column:
    """NaN sorts above every number in Spark, so it must not survive the sources."""
    c = as_column(col)
    return F.when(~F.isnan(c), c)
