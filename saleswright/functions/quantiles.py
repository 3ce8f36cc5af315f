"""Exact quantiles that never hold a group's values in one task.

The built-in exact ``percentile`` keeps a value -> count map per group in a single
buffer, which grows with the data. Here a quantile takes three narrow scans instead:

1. Every value falls into a narrow, logarithmic bucket. The bucket totals per group
   are combined on the map side and form a small table; its running sum tells in
   which bucket a wanted rank lies.
2. Each bucket that holds a wanted rank is cut into ``CELLS`` cells of equal width
   between its own least and largest value, whose totals tell the cell in the same way.
   So values far from zero, or close to it, are told apart as well.
3. The last scan keeps only the values of the wanted cells, counts them and orders
   them, one window partition per cell.

Which rows a scan keeps is a join with the wanted buckets or cells, or without groups,
where they are at most two per quantile, a scalar subquery.

Nothing is sampled or approximated, copies of a value collapse in the map-side
combine, and a dominant group is spread over its buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswright.functions.numeric import nan_to_null
from saleswright.workspace import stage

#: The column of a value table that says how many rows have the value.
COUNT = "value_count"

#: Buckets per e-fold of magnitude: a bucket spans 1/4096 of the value it holds,
#: i.e. some 2,400 different cents around 100,000.
BUCKETS_PER_EFOLD = 4096

#: Cells into which a wanted bucket is cut.
CELLS = 65_536


def _bucket(x: Column) -> Column:
    return F.floor(F.signum(x) * F.log1p(F.abs(x)) * F.lit(float(BUCKETS_PER_EFOLD)))


def _known(df: DataFrame, value: str) -> Column:
    x = F.col(value).cast("double")
    return nan_to_null(x) if isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType)) else x


def value_table(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., value, COUNT)``: every distinct value once with its number of rows, written once.

    It takes one pass over the input; ranks, boxes, means and tails are read from it with ``count=COUNT``. Copies
    collapse before the shuffle. The row with a NULL value counts what is missing, NaN included.
    """
    rows = df.select(*by, _known(df, value).alias(value)).groupBy(*by, value).agg(F.count("*").alias(COUNT))
    return stage(rows, "values")


def _bucketed(df: DataFrame, value: str, by: Sequence[str], count: str | None = None) -> DataFrame:
    """``(by..., _x, _n, _b)``: known values, how many rows each stands for, and their buckets."""
    n = F.col(count) if count else F.lit(1).cast("bigint")
    rows = df.select(*by, _known(df, value).alias("_x"), n.alias("_n"))
    return rows.where(F.col("_x").isNotNull()).withColumn("_b", _bucket(F.col("_x")))


def _histogram(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bucket totals; size is bounded by groups times buckets, not by rows."""
    return rows.groupBy(*by, "_b").agg(
        F.sum("_n").alias("_n"), F.min("_x").alias("_min"), F.max("_x").alias("_max")
    )


def _rows_in(rows: DataFrame, wanted: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """The ``rows`` of the ``wanted`` (group, ``key``) cells, with their struct column ``_w``."""
    if not by:
        # At most two buckets or cells per quantile or bound: one subquery both filters and attaches.
        cells = wanted.agg(F.map_from_entries(F.collect_list(F.struct(key, "_w")))).scalar()
        hit = rows.where(F.array_contains(F.map_keys(cells), F.col(key)))
        return hit.withColumn("_w", F.try_element_at(cells, F.col(key)))
    cells = wanted.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(by)], F.col(key).alias("_kb"), "_w")
    cond = rows[key] == cells["_kb"]
    for i, k in enumerate(by):
        cond = cond & rows[k].eqNullSafe(cells[f"_k{i}"])
    return rows.join(cells, cond).select(*rows.columns, "_w")


def _cell(x: Column, box: Column) -> Column:
    """The cell of a value, counted through all buckets; it never falls as the value grows."""
    width = box["_max"] - box["_min"]
    inside = F.floor((x - box["_min"]) / F.nullif(width, F.lit(0.0)) * F.lit(float(CELLS)))
    return F.col("_b") * CELLS + F.coalesce(F.least(inside, F.lit(CELLS - 1)), F.lit(0)).cast("bigint")


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), count: str | None = None
) -> DataFrame:
    """Linear-interpolated quantiles of ``value``, overall or per group of ``by``.

    Returns ``by..., count bigint, quantiles array<double>``. Nulls and NaN are
    ignored. Without ``by`` there is one row even for an empty input. ``count`` names a column
    that says how many rows each one stands for (see ``value_table``).
    """
    by = list(by)
    rows = _bucketed(df, value, by, count)
    return _quantiles(rows, _histogram(rows, by), probs, by)


def _quantiles(
    rows: DataFrame, hist: DataFrame, probs: Sequence[float], by: list[str]
) -> DataFrame:
    group = Window.partitionBy(*by)
    upto = (Window.unboundedPreceding, Window.currentRow)
    cumulated = hist.select(
        *by,
        "_b",
        "_n",
        "_min",
        "_max",
        (F.sum("_n").over(group.orderBy("_b").rowsBetween(*upto)) - F.col("_n")).alias("_before"),
        F.sum("_n").over(group).alias("_total"),
    )

    def ranks(p: float, total: Column) -> tuple[Column, Column, Column]:
        position = F.lit(float(p)) * (total - 1)
        return position, F.floor(position), F.ceil(position)

    def holds(rank: Column, start: Column, size: Column) -> Column:
        return (rank >= start) & (rank < start + size)

    def needed(start: Column) -> Column:
        found = F.lit(False)
        for p in probs:
            for rank in ranks(p, F.col("_total"))[1:]:
                found = found | holds(rank, start, F.col("_n"))
        return found

    wanted = cumulated.where(needed(F.col("_before"))).select(
        *by, "_b", F.struct("_before", "_total", "_min", "_max").alias("_w")
    )
    celled = _rows_in(rows, wanted, by, "_b").withColumn("_c", _cell(F.col("_x"), F.col("_w")))
    cells = celled.groupBy(*by, "_b", "_c").agg(F.sum("_n").alias("_n"), F.first("_w").alias("_w"))
    inside = Window.partitionBy(*by, "_b").orderBy("_c").rowsBetween(*upto)
    wanted_cells = (
        cells.select(
            *by, "_c", "_n", F.col("_w._total").alias("_total"),
            (F.col("_w._before") + F.sum("_n").over(inside) - F.col("_n")).alias("_before"),
        )
        .where(needed(F.col("_before")))
        .select(*by, "_c", F.struct("_before", "_total").alias("_w"))
    )
    values = _rows_in(celled.drop("_w"), wanted_cells, by, "_c")
    counted = values.groupBy(*by, "_c", "_x").agg(F.sum("_n").alias("_n"), F.first("_w").alias("_w"))
    ordered = Window.partitionBy(*by, "_c").orderBy("_x").rowsBetween(*upto)
    ranked = counted.select(
        *by,
        "_x",
        "_n",
        F.col("_w._total").alias("_total"),
        (F.col("_w._before") + F.sum("_n").over(ordered) - F.col("_n")).alias("_start"),
    )
    picks = []
    for i, p in enumerate(probs):
        _, low, high = ranks(p, F.col("_total"))
        for side, rank in (("low", low), ("high", high)):
            at_rank = F.when(holds(rank, F.col("_start"), F.col("_n")), F.col("_x"))
            picks.append(F.max(at_rank).alias(f"_{side}{i}"))
    picked = ranked.groupBy(*by).agg(F.max("_total").alias("_total"), *picks)

    def interpolated(i: int, p: float) -> Column:
        # From the nearer neighbour, as NumPy and pandas do it: equal to the last bit.
        position, low, _ = ranks(p, F.col("_total"))
        share, a, b = position - low, F.col(f"_low{i}"), F.col(f"_high{i}")
        return F.when(share < 0.5, a + (b - a) * share).otherwise(b - (b - a) * (F.lit(1.0) - share))

    return picked.select(
        *by,
        F.coalesce("_total", F.lit(0)).cast("bigint").alias("count"),
        F.array(*[interpolated(i, p) for i, p in enumerate(probs)]).alias("quantiles"),
    )


def quantile_edges(df: DataFrame, value: str, probs: Sequence[float], count: str | None = None) -> Column:
    """The overall quantiles as one array-valued scalar subquery.

    Spark runs it once, before the stage that uses it, and inlines the result: no
    join, no broadcast, no driver round trip.
    """
    return exact_quantiles(df, value, probs, count=count).select("quantiles").scalar()


def approx_edges(df: DataFrame, value: str, probs: Sequence[float], accuracy: int = 10_000) -> Column:
    """Opt-in single-scan sketch of :func:`quantile_edges`; edges may move slightly."""
    return df.agg(
        F.percentile_approx(F.col(value).cast("double"), [float(p) for p in probs], accuracy)
    ).scalar()


def box_summary(df: DataFrame, value: str, by: Sequence[str] = (), reach: float = 1.5, count: str | None = None) -> DataFrame:
    """Five numbers, whisker ends inside ``reach`` IQRs and the count beyond them.

    Buckets wholly inside or outside the bounds contribute their totals; only the
    two buckets that a bound cuts through are looked into, by value.
    """
    by = list(by)
    rows = _bucketed(df, value, by, count)
    hist = _histogram(rows, by)
    names = ("min", "q1", "median", "q3", "max")
    five = _quantiles(rows, hist, (0.0, 0.25, 0.5, 0.75, 1.0), by).select(
        *by, "count", *[F.col("quantiles")[i].alias(n) for i, n in enumerate(names)]
    )
    spread = F.lit(float(reach)) * (F.col("q3") - F.col("q1"))
    five = five.withColumn("_low", F.col("q1") - spread).withColumn("_high", F.col("q3") + spread)
    five = five.select(*by, F.struct("count", *names, "_low", "_high").alias("_box"))

    # The totals with their group's box: a small table joined with a smaller one.
    if by:
        keyed = five.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(by)], "_box")
        cond = F.lit(True)
        for i, k in enumerate(by):
            cond = cond & hist[k].eqNullSafe(keyed[f"_g{i}"])
        boxed = hist.join(keyed, cond).drop(*[f"_g{i}" for i in range(len(by))])
    else:
        boxed = hist.withColumn("_box", five.select("_box").scalar())
    low_b, high_b = _bucket(F.col("_box._low")), _bucket(F.col("_box._high"))
    cut = (F.col("_b") == low_b) | (F.col("_b") == high_b)

    whole = boxed.where(~cut).select(
        *by, "_box", "_min", "_max", "_n", ((F.col("_b") > low_b) & (F.col("_b") < high_b)).alias("_in")
    )
    edges = boxed.where(cut).select(*by, "_b", F.col("_box").alias("_w"))
    x = F.col("_x")
    cut_values = _rows_in(rows, edges, by, "_b").groupBy(*by, "_b", "_x").agg(F.sum("_n").alias("_n"), F.first("_w").alias("_w"))
    split = cut_values.select(
        *by,
        F.col("_w").alias("_box"),
        x.alias("_min"),
        x.alias("_max"),
        "_n",
        ((x >= F.col("_w._low")) & (x <= F.col("_w._high"))).alias("_in"),
    )
    parts = whole.unionByName(split)
    return parts.groupBy(*by).agg(
        *[F.max(f"_box.{m}").alias(m) for m in ("count", *names)],
        F.min(F.when(F.col("_in"), F.col("_min"))).alias("whisker_low"),
        F.max(F.when(F.col("_in"), F.col("_max"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~F.col("_in"), F.col("_n"))), F.lit(0)).cast("bigint").alias("outlier_count"),
    )
