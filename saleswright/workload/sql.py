"""SQL building blocks of the cross-check: the flat table and exact arithmetic."""

from __future__ import annotations


def total(x: str) -> str:
    """Exact sum of a money column."""
    return f"CAST(sum(CAST({x} AS DECIMAL(18,4))) AS DOUBLE)"


def mean(x: str) -> str:
    return f"({total(x)} / nullif(count({x}), 0))"


def half_up(x: str, digits: int = 2) -> str:
    unit = f"{10**digits}::DOUBLE"
    return (
        f"((CASE WHEN ({x}) < 0 THEN -CAST(floor(-({x}) * {unit} + 0.5) AS BIGINT) "
        f"ELSE CAST(floor(({x}) * {unit} + 0.5) AS BIGINT) END) / {unit})"
    )


REV = f"{half_up(total('sales'))} AS total_revenue"
AOV = f"{half_up(mean('sales'))} AS avg_order_value"

# Every join is made here, whatever columns a query reads.
FLAT = """
flat AS (
  SELECT l_orderkey * 10 + l_linenumber AS row_id,
         CAST(l_orderkey AS VARCHAR) AS order_id,
         o_orderdate AS order_date, l_shipdate AS ship_date, o_orderpriority AS ship_mode,
         CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
         r_name AS country, n_name || '-' || CAST(c_custkey % 10 AS VARCHAR) AS city, n_name AS state,
         CAST(c_nationkey * 100 + c_custkey % 100 AS BIGINT) AS postal_code, r_name AS region,
         CAST(p_partkey AS VARCHAR) AS product_id, p_type AS category, p_brand AS sub_category,
         p_name AS product_name, l_extendedprice AS sales, l_quantity AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
)"""


def features(source: str) -> str:
    """Calendar, shipping and tier columns over ``source``."""
    return f"""
    SELECT s.*,
         CAST(year(order_date) AS BIGINT) AS order_year, CAST(month(order_date) AS BIGINT) AS order_month,
         strftime(order_date, '%B') AS order_month_name, CAST(quarter(order_date) AS BIGINT) AS order_quarter,
         strftime(order_date, '%A') AS order_day_of_week,
         CAST(floor((epoch(ship_date) - epoch(order_date)) / 86400) AS BIGINT) AS shipping_days,
         CASE WHEN sales <= (SELECT quantile_cont(sales, 0.25) FROM {source}) THEN 'Low'
              WHEN sales <= (SELECT quantile_cont(sales, 0.5) FROM {source}) THEN 'Medium'
              WHEN sales <= (SELECT quantile_cont(sales, 0.75) FROM {source}) THEN 'High'
              WHEN sales > (SELECT quantile_cont(sales, 0.75) FROM {source}) THEN 'Premium'
              ELSE 'Unknown' END AS sales_tier
    FROM {source} s"""


SALES = f"{FLAT}, sales_data AS ({features('flat')})"

RAW = f"""{FLAT}, copies AS (
  SELECT * FROM flat UNION ALL SELECT * FROM flat WHERE CAST(order_id AS BIGINT) % 10 = 0
), raw AS (
  SELECT row_id, order_id, strftime(order_date, '%d/%m/%Y') AS order_date,
         strftime(ship_date, '%d/%m/%Y') AS ship_date, ship_mode, customer_id, customer_name,
         CASE WHEN CAST(order_id AS BIGINT) % 50 <> 0 THEN segment END AS segment, country, city, state,
         CASE WHEN CAST(order_id AS BIGINT) % 100 <> 0 THEN postal_code END AS postal_code, region,
         product_id, category, sub_category, product_name, sales,
         CASE WHEN row_id % 10 <> 7 THEN quantity END AS quantity
  FROM copies
)"""

RAW_COLUMNS = (
    "row_id", "order_id", "order_date", "ship_date", "ship_mode", "customer_id", "customer_name",
    "segment", "country", "city", "state", "postal_code", "region", "product_id", "category",
    "sub_category", "product_name", "sales", "quantity",
)


def over_sales(body: str, *ctes: str) -> str:
    return f"WITH {', '.join((SALES, *ctes))}\n{body}"


def over_flat(body: str, *ctes: str) -> str:
    return f"WITH {', '.join((FLAT, *ctes))}\n{body}"


def over_raw(body: str, *ctes: str) -> str:
    return f"WITH {', '.join((RAW, *ctes))}\n{body}"


def mode_of(column: str, source: str) -> str:
    """Most frequent value, ties to the smallest."""
    return (
        f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} "
        f"ORDER BY count(*) DESC, {column} LIMIT 1)"
    )


# The raw rows after cleaning: distinct rows, gaps filled, dates parsed, features added.
CLEAN = f"""{RAW}, rows_once AS (SELECT DISTINCT * FROM raw),
filled AS (
  SELECT row_id, order_id, strptime(order_date, '%d/%m/%Y') AS order_date,
         strptime(ship_date, '%d/%m/%Y') AS ship_date, ship_mode, customer_id, customer_name,
         coalesce(segment, {mode_of('segment', 'rows_once')}) AS segment, country, city, state,
         coalesce(CAST(postal_code AS DOUBLE), (SELECT median(postal_code) FROM rows_once)) AS postal_code,
         region, product_id, category, sub_category, product_name, sales,
         coalesce(quantity, (SELECT median(quantity) FROM rows_once)) AS quantity,
         CAST(quantity IS NULL AS BIGINT) AS quantity_was_missing
  FROM rows_once
), clean AS ({features('filled')})"""


def over_clean(body: str, *ctes: str) -> str:
    return f"WITH {', '.join((CLEAN, *ctes))}\n{body}"


DIGEST_TEXTS = (
    "ship_mode", "customer_id", "customer_name", "segment", "city", "state", "region", "product_id",
    "sub_category", "product_name", "sales_tier",
)


def digest(source: str) -> str:
    """A summary per year and category that reads every column of the flat table."""
    texts = ", ".join(
        f"min({c}) AS {c}_min, max({c}) AS {c}_max, CAST(sum(length({c})) AS BIGINT) AS {c}_length"
        for c in DIGEST_TEXTS
    )
    return f"""SELECT CAST(order_year AS BIGINT) AS order_year, category, count(*) AS row_count,
    {total('sales')} AS revenue, count(DISTINCT order_id) AS orders, {texts},
    CAST(sum(postal_code) AS DOUBLE) AS postal_sum, CAST(sum(shipping_days) AS BIGINT) AS days,
    CAST(min(order_date) AS VARCHAR) AS first_order, CAST(max(ship_date) AS VARCHAR) AS last_shipment
    FROM {source} GROUP BY order_year, category"""


DIGEST_COLUMNS = [
    "order_id", "order_date", "ship_date", "ship_mode", "customer_id", "customer_name", "segment",
    "city", "state", "postal_code", "region", "product_id", "category", "sub_category",
    "product_name", "sales", "order_year", "shipping_days", "sales_tier",
]
