"""N-gram Jaccard join (11): universe partition and pigeonhole.

A document's set is its distinct five-word shingles (``text.shingle_set``), and two documents
link when ``100 * intersection >= PERCENT * union``. Then their sets differ by at most
``H = (|r| + |s|) / 9`` shingles. Sizes are cut into bands so that partners lie in the same or
in neighbouring bands, and each band cuts the universe of shingles into more than ``H`` segments: of
those that a set spends its budget on, at least one must agree with its partner.

* A segment with threshold 0 (one unit of budget) agrees when both subsets are equal; one with
  threshold 1 (two units) when they differ by at most one shingle: subsets and their one-deletion
  neighbourhoods meet. Threshold -1 leaves a segment out. The smaller set of a pair allocates
  ``|s| // 4 + 1`` units; the larger one is in the index of its own band and of the band below with all
  its subsets. Neighbourhoods are made in the bands of short texts (``WIDE``), where three
  shingles say little and few rows come of them.
* The allocation goes by cost. The index is counted first, so a unit costs the true number of
  sets that it would be compared with; units that nobody else has are free and
  cover most budgets. Each set takes its cheapest units.
* The empty subset is no key. A set whose segments are so empty that its budget may not
  be covered without it is ``sparse`` and has the empty subsets as keys too: by counting, whatever a
  sparse set would miss without them is sparse itself.

So every link is in at least one bucket that is compared, and no bands or samples decide. In a
bucket, first the most connected member is compared with all others; what stays in different components is
compared inside tasks, chunk by chunk, where a chunk is bounded by its shingles. Every link is
confirmed on the full sets, only links become rows, and equal sets are one class.

Defined cases: a null or empty text, or one without words, has an empty set and no link; a row
with a null id is linked with nothing and has no component; rows that repeat an id are one
vertex; very long texts are sets like others; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleswright import workspace
from saleswright.llm import bits, graph, neardup
from saleswright.llm import text as T

PERCENT = 80
#: Largest set size of a band whose segments have one-deletion neighbourhoods.
WIDE = 24
#: Bits of the filter of repeated keys; 4 MB.
BITS = 1 << 25
#: Copies, 24 bytes each, up to which they are sent to the sets; beyond, both are shuffled.
BROADCAST = 1 << 20
#: Shingles in a chunk that is compared with another inside a task.
CHUNK = 1 << 18
_MIX, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: ``own`` keys of the set's own band come first; ``units`` tells those of wide and of sparse sets, otherwise each is a unit of its own.
DESCRIBED = "doc_id bigint, n_shingles bigint, set_id binary, keys array<bigint>, units array<int>, own int, proper int, need int"


@cache
def band_of(size: int) -> tuple[int, int]:
    """``(lowest, highest)`` set size of the band that ``size`` lies in; the next band begins at 5/4 of the lowest."""
    low = 1
    while (after := max(-(-5 * low // 4), low + 1)) <= size:
        low = after
    return low, after - 1


def plan(high: int) -> tuple[int, bool]:
    """Segments of the band that ends at ``high``, and if they have neighbourhoods.

    Each covers one unit, or two; a few more than the ``high // 4 + 1`` units that are needed give a choice.
    """
    wide = high <= WIDE
    units = high // 4 + 1 + max(1, high // 32)
    return (-(-units // 2), True) if wide else (units, False)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX2
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _cuts(high: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the segments of the band that ends at ``high`` begin, but the first, and a seed for each."""
    m, _ = plan(high)
    return np.array([(k << 64) // m for k in range(1, m)], np.uint64), _scramble(np.arange(m, dtype=np.uint64) + np.uint64(high << 32))


def segment_keys(shingles: np.ndarray, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """``(keys, units, empty, proper)`` of a sorted set in the band that ends at ``high``.

    A segment is a range of hashes. Unit ``4 * segment`` is its subset, ``+ 1`` the same if deletions from it are keys too, ``+ 2`` those
    deletions. ``empty`` marks keys of empty subsets, which sparse sets alone have; ``proper`` counts the other units.
    """
    cuts, seeds = _cuts(high)
    _, wide = plan(high)
    ends = np.append(np.searchsorted(shingles, cuts), len(shingles))
    sizes = np.diff(ends, prepend=0)
    mixed = _scramble(shingles)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    sums = total[ends] - total[ends - sizes]
    proper = int(np.minimum(sizes, 2 if wide else 1).sum())
    sparse = proper <= high // 4
    held = np.flatnonzero((sizes > 0) | sparse)
    values, units, empty = [(sums * _MIX + seeds)[held]], [4 * held + (wide & (sizes[held] > 1))], [sizes[held] == 0]
    if wide:
        of = np.repeat(np.arange(len(sizes)), sizes)
        some = (sizes[of] > 1) | sparse
        values.append(((sums[of] - mixed) * _MIX + seeds[of])[some])
        units.append(4 * of[some] + 2)
        empty.append(sizes[of[some]] == 1)
    return _scramble(np.concatenate(values)).view(np.int64), np.concatenate(units).astype(np.int32), np.concatenate(empty), proper


def _described(batch: pa.RecordBatch) -> list:
    """Each set with its keys, in its own band and in the band below. Units of -1 are for others to find: nothing is spent on them."""
    out: list[list] = [[] for _ in range(7)]
    for text in batch.column(1).to_pylist():
        found = T.shingle_set(text)
        n, keys, units, own, proper, need = len(found), np.zeros(0, np.int64), np.zeros(0, np.int32), 0, 0, 0
        if n:
            low, high = band_of(n)
            keys, units, empty, proper = segment_keys(found, high)
            own, need = len(keys), n // 4 + 1
            if proper < need:  # all there is
                need = own + proper
            elif empty.any():
                units = np.where(empty, np.int32(-1), units)
            elif high > WIDE:
                units = units[:0]
            if 100 * (low - 1) >= PERCENT * n:
                below, *_ = segment_keys(found, low - 1)
                keys = np.concatenate([keys, below])
        for column, value in zip(out, (n, neardup.set_id(found) if n else None, keys, units, own, proper, need), strict=True):
            column.append(value)
    return [batch.column(0), *out]


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its set's size, identity and keys, written once."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), T.whole_text(text_col))
    return workspace.stage(T.map_rows(rows, DESCRIBED, _described), "sets")


def one_each(described: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row of ``described`` per distinct set, and ``(u, v)``: the least id of a set with the others."""
    named = described.where("doc_id IS NOT NULL AND set_id IS NOT NULL")
    same = named.groupBy("set_id").agg(F.min("doc_id").alias("u"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    copies = workspace.stage(named.select("doc_id", "set_id").join(same, "set_id").where("doc_id <> u").distinct(), "copies")
    gone = copies.select("doc_id", "set_id")
    # the sets themselves need not move for a few copies
    gone = F.broadcast(gone) if copies.count() <= BROADCAST else gone
    return named.join(gone, ["doc_id", "set_id"], "left_anti"), copies.select("u", F.col("doc_id").alias("v"))


def _units(own: int, told: np.ndarray, size: int) -> np.ndarray:
    """The unit of each of ``size`` keys; -1 for those of the band below."""
    out = np.full(size, -1, np.int32)
    out[:own] = told if len(told) else 4 * np.arange(own)
    return out


def _listed(table: bits.Bitmap):
    """The keys of a set that the bitmap lets through, a row each."""

    def work(batch: pa.RecordBatch) -> list:
        held = [batch.column(k) for k in range(3)]
        keys, told = batch.column(3), batch.column(4)
        own, proper, need = (batch.column(k).to_numpy() for k in (5, 6, 7))
        sizes = np.diff(keys.offsets.to_numpy())
        which, every = np.repeat(np.arange(batch.num_rows), sizes), keys.flatten().to_numpy()
        units = [_units(own[k], told[k].values.to_numpy(), sizes[k]) for k in range(batch.num_rows)]
        hit = table.has(every)
        at = which[hit]
        unit = np.concatenate([np.zeros(0, np.int32), *units])[hit]
        return [*[c.take(pa.array(at)) for c in held], every[hit], unit, proper[at], need[at]]

    return work


def crowded(classes: DataFrame, n_bits: int = BITS) -> DataFrame:
    """``(doc_id, set_id, n, key, chosen, score)``: the keys that several sets have, ``chosen`` where its set spends a unit on it.

    ``score`` is the number of such keys of the set. Written once.
    """
    every = classes.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("many")).where("many > 1")
    repeated = workspace.stage(every, "repeated")
    table = bits.bitmap(repeated, "key", n_bits)
    rows = classes.select("doc_id", "set_id", "n_shingles", "keys", "units", "own", "proper", "need").where("size(keys) > 0")
    schema = "doc_id bigint, set_id binary, n bigint, key bigint, unit int, proper int, need int"
    # one shuffle by set serves all windows
    crowd = T.map_rows(rows, schema, _listed(table), rows=64).join(repeated, "key").repartition("doc_id", "set_id")
    own = Window.partitionBy("doc_id", "set_id")
    unit, segment = (Window.partitionBy("doc_id", "set_id", x) for x in ("unit", F.expr("unit DIV 4")))
    subset, deletion = F.expr("unit >= 0 AND unit % 4 < 2"), F.expr("unit >= 0 AND unit % 4 = 2")
    # deletions cost the buckets of the whole neighbourhood, and no less than the subset, without which they are no use;
    # where nobody has the deletions, they come with the subset for nothing
    priced = crowd.withColumn("cost", F.sum("many").over(unit)).withColumns({
        "cost": F.when(deletion, F.greatest("cost", F.max(F.when(subset, F.col("cost"))).over(segment))).otherwise(F.col("cost")),
        "worth": F.when(F.expr("unit >= 0 AND unit % 4 = 1") & ~F.max(deletion).over(segment), 2).otherwise(1),
        "score": F.count("*").over(own),
        "nth": F.row_number().over(unit.orderBy("key")),
    })
    counted = F.when((F.col("unit") >= 0) & (F.col("nth") == 1), F.col("worth")).otherwise(0)
    free = F.col("proper") - F.sum(counted).over(own)
    before = F.sum(counted).over(own.orderBy(F.expr("unit < 0"), "cost", "unit")) - F.col("worth")
    chosen = (F.col("unit") >= 0) & (before < F.col("need") - free)
    return workspace.stage(priced.select("doc_id", "set_id", "n", "key", chosen.alias("chosen"), "score"), "crowd")


def _confirmed(batch: pa.RecordBatch) -> list:
    a_ids, b_ids, a_sets, b_sets = (c.to_pylist() for c in batch.columns)
    out: list[list] = [[], []]
    for a, b, x, y in zip(a_ids, b_ids, a_sets, b_sets, strict=True):
        p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        if alike(len(p), len(q), len(np.intersect1d(p, q, assume_unique=True))):
            out[0].append(a)
            out[1].append(b)
    return out


def alike(n, m, shared):
    """If sets of ``n`` and ``m`` shingles with ``shared`` common ones link; also for arrays."""
    return 100 * shared >= PERCENT * (n + m - shared)


def links(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(u, v)``: confirmed links that connect all classes which any chain of links connects."""
    crowd = crowded(classes)
    pivot = F.max(F.struct("score", (-F.col("doc_id")).alias("least"), "doc_id", "set_id", "n")).alias("p")
    buckets = crowd.groupBy("key").agg(pivot, F.max("chosen").alias("asked"), F.count("*").alias("many")).where("asked AND many > 1")
    placed = workspace.stage(crowd.drop("score").join(buckets.drop("asked", "many"), "key"), "placed")
    vertex = lambda x, doc, set_: [F.col(doc).alias(f"{x}_id"), F.col(set_).alias(f"{x}_set")]
    fits = f"100 * least(n, p.n) >= {PERCENT} * greatest(n, p.n)"
    first = workspace.stage(
        placed.where("set_id <> p.set_id").where(fits).select(*vertex("a", "p.doc_id", "p.set_id"), *vertex("b", "doc_id", "set_id")).distinct(),
        "pairs",
    )
    sets = neardup.full_sets(docs, placed.select("doc_id", "set_id").distinct(), id_col, text_col)
    a, b = (sets.select(*vertex(x, "doc_id", "set_id"), F.col("shingles").alias(f"{x}_shingles")) for x in "ab")
    both = first.join(a, ["a_id", "a_set"]).join(b, ["b_id", "b_set"])
    found = workspace.stage(T.map_rows(both.select("a_id", "b_id", "a_shingles", "b_shingles"), "u bigint, v bigint", _confirmed), "links")
    joined = graph.components(found)
    now = placed.drop("p").join(joined.withColumnRenamed("v", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    apart = now.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    open_ = workspace.stage(now.join(apart, "key"), "open")
    return found.union(workspace.stage(compared(open_, sets), "links"))


def compared(open_: DataFrame, sets: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``(u, v)``: confirmed links between members of a bucket in different components.

    Buckets that share members form a cluster. Its sets are dealt into chunks of about ``chunk`` shingles, and a task compares two
    chunks; a set that is larger is a chunk of its own.
    """
    least = open_.groupBy("key").agg(F.min("doc_id").alias("u"))
    edges = open_.join(least, "key").where("doc_id <> u").select("u", F.col("doc_id").alias("v"))
    cluster = graph.components(edges).select(F.col("v").alias("doc_id"), F.col("component").alias("cluster"))
    members = open_.groupBy("doc_id", "set_id").agg(
        F.first("n").alias("n"), F.first("component").alias("component"), F.collect_set("key").alias("buckets")
    ).join(cluster, "doc_id", "left").withColumn("cluster", F.coalesce("cluster", "doc_id"))
    sizes = members.groupBy("cluster").agg(F.ceil(F.sum("n") / chunk).cast("int").alias("chunks"))
    dealt = (
        members.join(sizes, "cluster").join(sets, ["doc_id", "set_id"])
        .withColumn("chunk", F.pmod(F.xxhash64("doc_id", "set_id"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .groupBy("cluster", F.least("chunk", "other").alias("x"), F.greatest("chunk", "other").alias("y"))
        .agg(F.collect_list(F.struct("chunk", "doc_id", "n", "component", "buckets", "shingles")).alias("members"))
        .select("x", "y", "members")
    )

    def judge(batch: pa.RecordBatch) -> list:
        out: list[list] = [[], []]
        for x, y, members in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            left = [m for m in members if m["chunk"] == x]
            for u, v in _linked(left, left if x == y else [m for m in members if m["chunk"] == y], x == y):
                out[0].append(u)
                out[1].append(v)
        return out

    return T.map_rows(dealt, "u bigint, v bigint", judge, rows=1)


def _linked(left: list[dict], right: list[dict], same: bool) -> list[tuple[int, int]]:
    """Links between two chunks: those that share a bucket and fit by size, counted over the sorted shingles of one."""
    if not left or not right:
        return []
    arrays = [np.frombuffer(m["shingles"], np.uint64) for m in right]
    owners = np.repeat(np.arange(len(right)), [len(x) for x in arrays])
    shingles = np.concatenate(arrays)
    order = np.argsort(shingles, kind="stable")
    shingles, owners = shingles[order], owners[order]
    n, component = (np.array([m[k] for m in right], np.int64) for k in ("n", "component"))
    in_bucket: dict[int, list[int]] = {}
    for k, m in enumerate(right):
        for key in m["buckets"]:
            in_bucket.setdefault(key, []).append(k)
    out = []
    for i, m in enumerate(left):
        allowed = np.zeros(len(right), bool)
        for key in m["buckets"]:
            allowed[in_bucket.get(key, [])] = True
        if same:
            allowed[: i + 1] = False
        allowed &= (component != m["component"]) & (100 * np.minimum(n, m["n"]) >= PERCENT * np.maximum(n, m["n"]))
        if not allowed.any():
            continue
        mine = np.frombuffer(m["shingles"], np.uint64)
        start, stop = np.searchsorted(shingles, mine, "left"), np.searchsorted(shingles, mine, "right")
        sizes = stop - start
        place = np.repeat(start - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        shared = np.bincount(owners[place], minlength=len(right))
        out += [(m["doc_id"], right[k]["doc_id"]) for k in np.flatnonzero(allowed & alike(n, m["n"], shared))]
    return out


def joined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per document."""
    described = describe(docs, id_col, text_col)
    classes, copies = one_each(described)
    found = graph.components(links(docs, classes, id_col, text_col).union(copies))
    return described.select("doc_id", "n_shingles").join(found.withColumnRenamed("v", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
