"""URL filters (2): host and path rules first, then a list of canonical URLs behind a Bloom filter.

The list is held twice: as a blocked Bloom filter, one row of eight 64-bit words per block,
and as the exact set. A URL's key selects one block and one bit in each of its words; only
URLs whose eight bits are all set go on to the exact join, which removes the false hits. The
filter is a table of its own: Spark broadcasts it if it is small by its measured size and
otherwise shuffles by block, so no list is too long for it.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no rule
and is allowed; repeated URLs and rows are judged alike; an empty table or list gives an empty
result or only allowed pages; of rules that fit, the longest (host and path together) wins,
then the longer host, then block; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (host, path, verdict)
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
WORDS = 8
#: Bits per listed URL: about one false hit in 100 with one bit in each of eight words.
BITS_PER_URL = 12


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.`` and path without a closing slash; scheme, query and fragment don't count."""
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, r"/+$", ""))


def _bits(key: Column) -> list[Column]:
    """One bit in each of the eight words, from 48 bits of a hash of its own."""
    h = F.xxhash64(F.lit("bits"), key)
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 6 * w).bitwiseAND(F.lit(63)).cast("int")) for w in range(WORDS)]


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), blocks)


def bloom_filter(listed: DataFrame) -> DataFrame:
    """``(block, blocks, w0..w7)`` over a column ``key``, merged by bitwise or."""
    total = listed.agg(F.greatest(F.lit(1), F.ceil(F.count("*") * BITS_PER_URL / (64 * WORDS))).alias("blocks"))
    sized = listed.withColumn("blocks", F.lit(total.first()["blocks"]))
    bits = [b.alias(f"b{w}") for w, b in enumerate(_bits(F.col("key")))]
    return (
        sized.select(_block(F.col("key"), F.col("blocks")).alias("block"), "blocks", *bits)
        .groupBy("block", "blocks")
        .agg(*[F.bit_or(f"b{w}").alias(f"w{w}") for w in range(WORDS)])
    )


def possible(keys: DataFrame, bloom: DataFrame) -> DataFrame:
    """Rows of ``keys`` whose eight bits are all set in their block; never loses a listed key."""
    size = bloom.agg(F.max("blocks")).first()[0]
    if size is None:
        return keys.limit(0)
    bits = _bits(F.col("key"))
    hit = F.lit(True)
    for w, b in enumerate(bits):
        hit = hit & (F.col(f"w{w}").bitwiseAND(b) == b)
    probed = keys.withColumn("block", _block(F.col("key"), F.lit(size)))
    return probed.join(bloom.drop("blocks"), "block").where(hit).select(*keys.columns)


def fitting_rule(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, path, rule, rule_verdict)``: the winning rule of each distinct host and path.

    Each host is joined by equality on its own suffixes; only the rules of such a suffix
    are compared with the path.
    """
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")
    )
    given = rules.select(
        F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict")
    )
    rank = F.struct(
        F.length(F.concat("rule_host", "rule_path")).alias("length"),
        F.length("rule_host").alias("host_length"),
        F.col("rule_verdict").alias("verdict"),
        F.concat("rule_host", "rule_path").alias("rule"),
    )
    return (
        urls.select("host", "path", F.explode(suffixes).alias("rule_host"))
        .join(given, "rule_host")
        .where(F.col("path").startswith(F.col("rule_path")))
        .groupBy("host", "path")
        .agg(F.max(rank).alias("best"))
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("rule_verdict"))
    )


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def url_filter(pages: DataFrame, rules: DataFrame, listed: DataFrame, url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """``(page_id, host, path, rule, verdict, listed)`` for every page.

    ``listed`` has a column ``key`` of canonical URLs to block. Distinct hosts and paths are
    judged once, so a URL that fills a third of the pages is one row in every join but the
    last, where both sides are dealt by it and Spark splits it.
    """
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    urls = rows.select("host", "path").distinct()
    ruled = fitting_rule(urls, rules)
    exact = listed.select("key").where(F.col("key").isNotNull()).distinct()
    keyed = urls.select("host", "path", canonical(F.col("host"), F.col("path")).alias("key")).where("key <> ''")
    hits = possible(keyed, bloom_filter(exact)).join(exact, "key", "left_semi")
    judged = (
        ruled.join(hits.select("host", "path", F.lit(True).alias("listed")), ["host", "path"], "full")
        .withColumn("listed", F.coalesce("listed", F.lit(False)))
    )
    return rows.join(judged, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
        F.coalesce("listed", F.lit(False)).alias("listed"),
    )
