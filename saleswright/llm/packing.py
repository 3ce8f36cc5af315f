"""Packing (3): deficit round-robin over one queue per source, in closed form.

Each round a source is granted its share of a window (``quantum``); it serves pieces as long
as its credit lasts and carries what is left into the next round. A piece that ends at token
``C`` of its queue is therefore served in round ``ceil(C / quantum)``, whatever the other
queues do. So the whole schedule is an order by (round, source, place in the queue), and the
deficits are carried across windows and partitions without any task seeing more than its own
rows. Served tokens fill windows of ``WINDOW`` without gaps; only the last one is padded.

Long documents enter their queue in pieces of at most ``PIECE`` tokens, so that no source
fills a window alone. Queues run in the order of a hash of the document. Running totals are
taken in two steps: inside a bucket, and over the totals of a fixed number of buckets.

Weights are target shares of a window. If they add up to more than one, they are scaled down to
one. Sources without a weight split what is left of a window by their size. A source whose share
is zero, given or left, is served after all others; such sources split a window by their size.
Without weights, all sources do. A negative or infinite weight is an error.

Defined cases: a null or empty text is the end id alone; a null source is a queue of its own,
without a weight; repeated rows are packed each; a very long text is many pieces; an empty table
gives no pieces; the share of a source that doesn't occur goes to the others in their proportions;
further columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleswright import workspace
from saleswright.llm import text as T
from saleswright.llm import tokens

WINDOW, PIECE = 4096, 256
#: Buckets of the two-step running totals: per queue, and over all rounds.
QUEUE_BUCKETS, ROUND_BUCKETS = 4096, 8192
_BEFORE = (Window.unboundedPreceding, -1)


def token_table(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(row, doc_id, source, tie, n_tokens, ids)``, written once; ``row`` is unique."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"), tokens.text_bytes(text_col),
    ).select("row", "doc_id", "source", F.crc32("text").alias("tie"), "text")
    return workspace.stage(tokens.encoded(rows, path, "row bigint, doc_id bigint, source string, tie bigint"), "tokens")


def _before(value: str, *order: str, by: tuple[str, ...] = ()) -> Column:
    return F.coalesce(F.sum(value).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(*_BEFORE)), F.lit(0))


def _shares(weights: Mapping[str, float] | None) -> dict[str, float]:
    """Queue -> target share of a window; together at most one."""
    given = {f"={k}": float(v) for k, v in (weights or {}).items()}
    if not all(0 <= v < math.inf for v in given.values()):
        raise ValueError(f"weights must be finite and not negative: {weights}")
    return {k: v / max(1.0, sum(given.values())) for k, v in given.items()}


def schedule(docs: DataFrame, weights: Mapping[str, float] | None = None, window: int = WINDOW, piece: int = PIECE) -> DataFrame:
    """``(row, start, length, sequence_id, offset)`` for a table of ``row, doc_id, source, tie, n_tokens``."""
    queue = docs.select(
        "row", "doc_id", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("queue"), "n_tokens",
        F.xxhash64("doc_id", "tie").alias("h"),
    ).withColumn("bucket", F.shiftrightunsigned("h", 52))
    sums = queue.groupBy("queue", "bucket").agg(F.sum("n_tokens").alias("tokens"))
    totals = sums.groupBy("queue").agg(F.sum("tokens").alias("queue_tokens"))
    given = _shares(weights)
    is_given = F.col("queue").isin(list(given))
    total, others = totals.agg(F.sum("queue_tokens"), F.sum(F.when(~is_given, F.col("queue_tokens")))).first()
    total, others, left = total or 1, others or 0, max(0.0, 1 - sum(given.values()))
    natural = F.col("queue_tokens") / F.lit(float(total))
    share = natural * F.lit(left * total / others) if others else F.lit(0.0)
    for name, weight in given.items():
        share = F.when(F.col("queue") == name, F.lit(weight)).otherwise(share)
    rates = totals.withColumn("share", share).withColumn("last", F.col("share") <= 0)
    end_round = F.ceil(F.col("queue_tokens") / (F.col("share") * window))
    first_end = rates.where(~F.col("last")).agg(F.max(end_round)).first()[0] or 0
    quantum = F.when(F.col("last"), natural).otherwise(F.col("share")) * window
    quanta = rates.select("queue", "queue_tokens", quantum.alias("quantum"), F.when(F.col("last"), F.lit(first_end)).otherwise(0).alias("after"))
    bases = sums.select("queue", "bucket", _before("tokens", "bucket", by=("queue",)).alias("base")).join(quanta, "queue")
    begin = F.col("base") + _before("n_tokens", "h", "doc_id", "row", by=("queue", "bucket"))
    pieces = (
        queue.join(bases, ["queue", "bucket"])
        .withColumn("begin", begin)
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.expr(f"CAST((n_tokens - 1) DIV {piece} AS INT)"))))
        .withColumn("piece_start", F.col("k") * F.lit(piece).cast("bigint"))
        .withColumn("size", F.least(F.lit(piece), F.col("n_tokens") - F.col("piece_start")))
        .withColumn("ends", F.col("begin") + F.col("piece_start") + F.col("size"))
        .withColumn("round", F.col("after") + F.ceil(F.col("ends") / F.col("quantum")))
        .select("row", "queue", "piece_start", "size", "ends", "round")
    )
    # tokens that all queues together have served by a round: where in the order its pieces lie
    round_, late = F.col("round"), F.greatest(F.col("round") - F.lit(first_end), F.lit(0))

    def by_round(rounds: Column, tokens: float, rate: float) -> Column:
        return F.least(F.lit(float(tokens)), rounds * F.lit(float(rate)))

    served = by_round(round_, others, left * window) if left > 0 else by_round(late, others, others / total * window)
    for r in quanta.where(is_given).collect() if given else []:
        served += by_round(late if r["after"] else round_, r["queue_tokens"], r["quantum"])
    span = F.least(F.lit(ROUND_BUCKETS - 1), F.floor(served * F.lit(ROUND_BUCKETS / (total + window)))).alias("span")
    placed = pieces.select("*", span)
    span_sums = placed.groupBy("span").agg(F.sum("size").alias("tokens"))
    span_bases = span_sums.select("span", _before("tokens", "span").alias("span_base"))
    at = F.col("span_base") + _before("size", "round", "queue", "ends", "row", by=("span",))
    cut_from = F.greatest(F.col("at"), F.col("sequence_id") * window)
    cut_to = F.least(F.col("at") + F.col("size"), (F.col("sequence_id") + 1) * window)
    return (
        placed.join(span_bases, "span")
        .select("row", "piece_start", "size", at.alias("at"))
        .withColumn("sequence_id", F.explode(F.expr(f"sequence(at DIV {window}, (at + size - 1) DIV {window})")))
        .select(
            "row", (F.col("piece_start") + cut_from - F.col("at")).alias("start"), (cut_to - cut_from).alias("length"),
            "sequence_id", (cut_from - F.col("sequence_id") * window).alias("offset"),
        )
    )


_OUT = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, source string"
)


def _checked(batch: pa.RecordBatch) -> list:
    out: list[list] = [[] for _ in range(8)]
    for doc, source, n, stored, pieces in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        ids = memoryview(tokens.widen(stored))
        for p in pieces:
            start, length = p["start"], p["length"]
            values = doc, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n, p["sequence_id"], p["offset"], source
            for column, value in zip(out, values, strict=True):
                column.append(value)
    return out


def pack(docs: DataFrame, path: str, weights: Mapping[str, float] | None = None, window: int = WINDOW, piece: int = PIECE) -> DataFrame:
    """All documents in windows: one row per piece, with a checksum of its ids."""
    held = token_table(docs, path)
    pieces = schedule(held.drop("ids"), weights, window, piece)
    of_row = pieces.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("pieces"))
    rows = held.join(of_row, "row").select("doc_id", "source", "n_tokens", "ids", "pieces")
    return T.map_rows(rows, _OUT, _checked, rows=64)
