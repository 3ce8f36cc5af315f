"""The flat sales table over a star schema, joined only as far as it is used.

The table is the inner join of order lines with their order, customer, nation, region
and part. A dimension that no requested column comes from is left out only where it
cannot change the rows: where ``reference_check`` found that every line has exactly one
row in each. The check runs once per application and folder and its result is kept. The
dimensions are joined with each other first: the fact table is shuffled at most once per
key (order, part), never by customer.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswright.functions.quantiles import quantile_edges
from saleswright.operators.features import CALENDAR, QUARTILES, shipping_days, tier_of

#: Column -> (last table on the way that it needs, expression).
BASE = {
    "row_id": ("lineitem", "l_orderkey * 10 + l_linenumber"),
    "order_id": ("lineitem", "CAST(l_orderkey AS STRING)"),
    "order_date": ("orders", "o_orderdate"),
    "ship_date": ("lineitem", "l_shipdate"),
    "ship_mode": ("orders", "o_orderpriority"),
    "customer_id": ("orders", "CAST(o_custkey AS STRING)"),
    "customer_name": ("customer", "c_name"),
    "segment": ("customer", "c_mktsegment"),
    "country": ("region", "r_name"),
    "city": ("nation", "n_name || '-' || CAST(c_custkey % 10 AS STRING)"),
    "state": ("nation", "n_name"),
    "postal_code": ("customer", "c_nationkey * 100 + c_custkey % 100"),
    "region": ("region", "r_name"),
    "product_id": ("lineitem", "CAST(l_partkey AS STRING)"),
    "category": ("part", "p_type"),
    "sub_category": ("part", "p_brand"),
    "product_name": ("part", "p_name"),
    "sales": ("lineitem", "l_extendedprice"),
    "quantity": ("lineitem", "l_quantity"),
}

FEATURE_INPUTS = {name: ("order_date",) for name in CALENDAR} | {
    "shipping_days": ("order_date", "ship_date"),
    "sales_tier": ("sales",),
}

#: The order table as it looks after cleaning.
CLEAN_COLUMNS = [c for c in BASE if c != "quantity"]

_CHAIN = ("orders", "customer", "nation", "region")


_schemas: dict[tuple[str, str], T.StructType] = {}


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One table; its schema is looked up once per application, not once per query."""
    path = f"{folder.rstrip('/')}/{table}.parquet"
    known = (spark.sparkContext.applicationId, path)
    if known not in _schemas:
        _schemas[known] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[known]).parquet(path)


#: Reference -> (table and key that refer, table and key referred to).
REFERENCES = {
    "order": ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    "part": ("lineitem", "l_partkey", "part", "p_partkey"),
    "customer": ("orders", "o_custkey", "customer", "c_custkey"),
    "nation": ("customer", "c_nationkey", "nation", "n_nationkey"),
    "region": ("nation", "n_regionkey", "region", "r_regionkey"),
}

_evidence: dict[tuple[str, str], bool] = {}


def reference_check(spark: SparkSession, folder: str) -> DataFrame:
    """``(reference, rows, orphans, repeated)``: rows that refer, those of them whose key is missing there, and keys that occur twice there.

    Both keys are counted before they meet, so a key that a third of all rows have is one row of the join.
    """
    parts = []
    for name, (table, key, other, other_key) in REFERENCES.items():
        used = _read(spark, folder, table).groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"))
        there = _read(spark, folder, other).groupBy(F.col(other_key).alias("k")).agg(F.count("*").alias("m"))
        found = used.join(there, "k", "full")
        zero = F.lit(0).cast("bigint")
        parts.append(
            found.agg(
                F.coalesce(F.sum("n"), zero).alias("rows"),
                F.coalesce(F.sum(F.when(F.col("m").isNull(), F.col("n"))), zero).alias("orphans"),
                F.count_if(F.col("k").isNotNull() & (F.col("m") > 1)).alias("repeated"),
            ).select(F.lit(name).alias("reference"), "rows", "orphans", "repeated")
        )
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def references_hold(spark: SparkSession, folder: str) -> bool:
    """If ``reference_check`` found nothing; asked once per application and folder."""
    known = (spark.sparkContext.applicationId, folder.rstrip("/"))
    if known not in _evidence:
        _evidence[known] = not reference_check(spark, folder).where("orphans > 0 OR repeated > 0").take(1)
    return _evidence[known]


def _sent_to_all(df: DataFrame) -> bool:
    """Would Spark broadcast this table? Then its join shuffles nothing, and comes best after the one that does."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def _facts(spark: SparkSession, folder: str, tables: set[str]) -> DataFrame:
    """Order lines with the dimensions in ``tables`` (and those on the way there)."""
    facts = _read(spark, folder, "lineitem")
    parts = _read(spark, folder, "part") if "part" in tables else None
    # Of two shuffles the second carries what the first join brought: a part's columns are fewer than an order's.
    early = parts is not None and not _sent_to_all(parts)
    if early:
        facts = facts.join(parts, facts.l_partkey == parts.p_partkey)
    depth = max((_CHAIN.index(t) + 1 for t in tables if t in _CHAIN), default=0)
    if depth:
        side = _read(spark, folder, "orders")
        if depth > 1:
            people = _read(spark, folder, "customer")
            if depth > 2:
                places = _read(spark, folder, "nation")
                if depth > 3:
                    regions = _read(spark, folder, "region")
                    places = places.join(regions, places.n_regionkey == regions.r_regionkey)
                people = people.join(places, people.c_nationkey == places.n_nationkey)
            side = side.join(people, side.o_custkey == people.c_custkey)
        facts = facts.join(side, facts.l_orderkey == side.o_orderkey)
    if parts is not None and not early:
        facts = facts.join(parts, facts.l_partkey == parts.p_partkey)
    return facts


def sales_data(spark: SparkSession, folder: str, columns: Iterable[str] | None = None, skip: bool | None = None) -> DataFrame:
    """The cleaned order table, or the requested base and feature columns of it.

    ``skip`` says whether unused dimensions may be left out; without it ``references_hold`` is asked, unless every
    dimension is used anyway.
    """
    wanted = list(columns) if columns is not None else [*CLEAN_COLUMNS, *FEATURE_INPUTS]
    inputs = [i for c in wanted for i in FEATURE_INPUTS.get(c, (c,))]
    needed = list(dict.fromkeys(inputs)) or ["row_id"]
    every, used = {table for table, _ in BASE.values()}, {BASE[c][0] for c in needed}
    whole = {_CHAIN[-1], "part"} <= used
    if skip is None and ("sales_tier" in wanted or not whole):
        skip = references_hold(spark, folder)
    facts = _facts(spark, folder, used if skip or whole else every)
    df = facts.selectExpr(*[f"{BASE[c][1]} AS {c}" for c in needed])
    for name in wanted:
        if name in CALENDAR:
            df = df.withColumn(name, CALENDAR[name](F.col("order_date")))
        elif name == "shipping_days":
            df = shipping_days(df)
        elif name == "sales_tier":
            # the quartiles need the price only
            edges = quantile_edges(sales_data(spark, folder, ["sales"], skip), "sales", QUARTILES)
            df = df.withColumn("sales_tier", tier_of(F.col("sales"), [edges[i] for i in range(3)]))
    return df.select(*wanted)


#: Raw column name -> cleaned name.
RAW_NAMES = {
    "Row ID": "row_id",
    "Order ID": "order_id",
    "Order Date": "order_date",
    "Ship Date": "ship_date",
    "Ship Mode": "ship_mode",
    "Customer ID": "customer_id",
    "Customer Name": "customer_name",
    "Segment": "segment",
    "Country": "country",
    "City": "city",
    "State": "state",
    "Postal Code": "postal_code",
    "Region": "region",
    "Product ID": "product_id",
    "Category": "category",
    "Sub-Category": "sub_category",
    "Product Name": "product_name",
    "Sales": "sales",
    "Quantity": "quantity",
}


def raw_orders(spark: SparkSession, folder: str, columns: Iterable[str] | None = None) -> DataFrame:
    """The table as it might arrive: raw names, text dates, gaps and copies.

    The given tables are clean, so gaps are cut by rule: every 50th order has no
    segment, every 100th no postal code, every 7th line no quantity. The lines of
    every 10th order occur twice. ``columns`` are raw names.
    """
    wanted = list(columns) if columns is not None else list(RAW_NAMES)
    needed = [RAW_NAMES[c] for c in wanted]
    df = sales_data(spark, folder, dict.fromkeys([*needed, "order_id", "row_id"]))
    order = F.col("order_id").cast("bigint")
    changes = {
        "order_date": F.date_format("order_date", "dd/MM/yyyy"),
        "ship_date": F.date_format("ship_date", "dd/MM/yyyy"),
        "segment": F.when(order % 50 != 0, F.col("segment")),
        "postal_code": F.when(order % 100 != 0, F.col("postal_code")),
        "quantity": F.when(F.col("row_id") % 10 != 7, F.col("quantity")),
    }
    copies = F.when(order % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    kept = {c: change for c, change in changes.items() if c in needed}
    df = df.withColumns({**kept, "_copy": F.explode(copies)})
    return df.select(*[F.col(RAW_NAMES[c]).alias(c) for c in wanted])
