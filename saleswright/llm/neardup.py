"""MinHash near-dedup (8) with circulant permutations.

A document's set is its distinct five-word shingles (``text.shingle_set``). A first
permutation, a hash, places each shingle on a circle of ``CIRCLE`` places; a second one is a
table of ranks on that circle. Coordinate ``k`` of the signature is the least rank after the
table is shifted by ``k`` places, so all coordinates of a shingle lie side by side in memory
and a signature is one ``min`` over rows. ``BANDS`` bands of ``ROWS`` coordinates make pairs
candidates: at a similarity of 0.75, a pair is missed by all bands with probability 5e-6.

Equal sets are one class, with its least doc_id as representative. In a bucket, first the
most central member is compared with all others. What this leaves apart is compared in chunks:
members of a bucket that lie in different components, unless a bound excludes a link:
by their sizes, or by their own shingles, which are in no other open set and so can't be in
an intersection. So copies cost one comparison each, no link between components that share a
bucket goes untested, and only links become rows. Every
link is confirmed on the full sets.

Defined cases: a null or empty text, or one without words, has an empty set and is linked
with nothing; a row with a null id is linked with nothing, has no component and is kept; rows
that repeat an id are one vertex; an empty table gives an empty result; further columns are
ignored (``near_duplicates``) or pass through (``deduplicated``).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright import workspace
from saleswright.llm import graph
from saleswright.llm import text as T

#: A pair is linked with ``100 * intersection >= PERCENT * union``.
PERCENT = 75
BANDS, ROWS, CIRCLE = 32, 4, 1 << 20
#: Bits of the filter that spares texts from being read again; 16 MB once unpacked.
FILTER_BITS = 1 << 24
#: Sets in a chunk of a cluster.
CHUNK = 256
#: Shingles in a chunk of a cluster: 8 MB, so that long texts make smaller chunks.
CHUNK_SHINGLES = 1 << 20
_K = BANDS * ROWS
_tables: list[np.ndarray] = []


def _table() -> np.ndarray:
    """Row ``p``: the ranks at the ``_K`` places from ``p`` on, round the circle."""
    if not _tables:
        ranks = np.random.default_rng(20_240_607).permutation(CIRCLE).astype(np.uint32)
        _tables.append(np.lib.stride_tricks.sliding_window_view(np.concatenate([ranks, ranks[:_K]]), _K))
    return _tables[0]


def signature(shingles: np.ndarray) -> np.ndarray:
    """``_K`` coordinates of a non-empty set."""
    places = ((shingles ^ (shingles >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(44)
    table, out = _table(), np.full(_K, CIRCLE, np.uint32)
    for start in range(0, len(places), 4096):
        np.minimum(out, table[places[start : start + 4096].astype(np.int64)].min(axis=0), out=out)
    return out


def band_keys(coordinates: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A 64-bit key for each band."""
    rows = coordinates.reshape(bands, -1).astype(np.uint64)
    out = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows.shape[1]):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + rows[:, k]
    return (out * np.uint64(0x94D049BB133111EB)).view(np.int64)


def set_id(shingles: np.ndarray) -> bytes:
    """128 bits that stand for the whole set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _described(batch: pa.RecordBatch) -> list:
    sizes, ids, bands = [], [], []
    for text in batch.column(1).to_pylist():
        shingles = T.shingle_set(text)
        sizes.append(len(shingles))
        ids.append(set_id(shingles) if len(shingles) else None)
        bands.append(band_keys(signature(shingles)).tolist() if len(shingles) else [])
    return [batch.column(0), sizes, ids, bands]


DESCRIBED = "doc_id bigint, n_shingles bigint, set_id binary, bands array<bigint>"


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, set_id, bands)`` of every row, written once."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), T.whole_text(text_col))
    return workspace.stage(T.map_rows(rows, DESCRIBED, _described), "sets")


def _vertex(prefix: str) -> list:
    return [F.col("doc_id").alias(f"{prefix}_id"), F.col("set_id").alias(f"{prefix}_set")]


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (``a_id, a_set, b_id, b_set``) whose full sets are similar enough."""

    def judge(batch: pa.RecordBatch) -> list:
        a_ids, b_ids, a_sets, b_sets = (c.to_pylist() for c in batch.columns)
        out: list[list] = [[], []]
        for a, b, x, y in zip(a_ids, b_ids, a_sets, b_sets, strict=True):
            p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            shared = len(np.intersect1d(p, q, assume_unique=True))
            if 100 * shared >= PERCENT * (len(p) + len(q) - shared):
                out[0].append(a)
                out[1].append(b)
        return out

    a, b = (sets.select(*_vertex(x), F.col("shingles").alias(f"{x}_shingles")) for x in "ab")
    both = pairs.join(a, ["a_id", "a_set"]).join(b, ["b_id", "b_set"])
    return T.map_rows(both.select("a_id", "b_id", "a_shingles", "b_shingles"), "u bigint, v bigint", judge)


def _place(doc_id: str) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(FILTER_BITS))


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, set_id, shingles)`` of the ``wanted`` (``doc_id, set_id``), written once.

    A bitmap of fixed size, ``FILTER_BITS``, spares most texts that aren't wanted: it is
    sent to all tasks, so texts needn't be shuffled. What it lets through is joined exactly.
    """
    place = _place("doc_id")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))
    words = wanted.select(F.shiftright(place, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    table = np.zeros(FILTER_BITS // 64, np.int64)
    for row in words.toLocalIterator():
        table[row["word"]] = row["bits"]
    there = np.unpackbits(table.view(np.uint8), bitorder="little").tobytes()
    shared = docs.sparkSession.sparkContext.broadcast(there)

    def work(batch: pa.RecordBatch) -> list:
        bits = np.frombuffer(shared.value, bool)
        batch = batch.filter(pa.array(bits[batch.column(2).to_numpy(zero_copy_only=False)]))
        found = [T.shingle_set(x) for x in batch.column(1).to_pylist()]
        return [batch.column(0), [set_id(x) for x in found], [x.tobytes() for x in found]]

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where("doc_id IS NOT NULL AND text IS NOT NULL").withColumn("place", _place("doc_id"))
    made = T.map_rows(rows, "doc_id bigint, set_id binary, shingles binary", work)
    return workspace.stage(made.join(wanted, ["doc_id", "set_id"], "left_semi").dropDuplicates(["doc_id", "set_id"]), "full_sets")


def own_shingles(sets: DataFrame) -> DataFrame:
    """``(doc_id, set_id, own)``: how many shingles of a set are in no other of ``sets``."""

    def work(batch: pa.RecordBatch) -> list:
        found = [np.frombuffer(x, np.int64) for x in batch.column(2).to_pylist()]
        which = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
        return [batch.column(0).take(which), batch.column(1).take(which), pa.array(np.concatenate([np.zeros(0, np.int64), *found]))]

    each = T.map_rows(sets.select("doc_id", "set_id", "shingles"), "doc_id bigint, set_id binary, shingle bigint", work, rows=64)
    alone = each.groupBy("shingle").agg(F.count("*").alias("m"), F.min("doc_id").alias("doc_id"), F.min("set_id").alias("set_id")).where("m = 1")
    return alone.groupBy("doc_id", "set_id").agg(F.count("*").alias("own"))


def links(docs: DataFrame, described: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(u, v)``: confirmed links that connect all classes which any chain of links connects."""
    classes = workspace.stage(
        described.where("doc_id IS NOT NULL AND set_id IS NOT NULL").groupBy("set_id")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")),
        "classes",
    )
    members = classes.select("doc_id", "set_id", "n", F.posexplode("bands").alias("band", "key"))
    # the member that shares most buckets with most others, as a rule the text the others were made from, stands for a bucket
    crowded = members.groupBy("band", "key").agg(F.count("*").alias("many")).where("many > 1")
    crowd = workspace.stage(members.join(crowded, ["band", "key"]), "crowd")
    scores = crowd.groupBy("doc_id", "set_id", "n").agg(F.sum("many").alias("score"))
    scored = crowd.drop("n").join(scores, ["doc_id", "set_id"])
    best = scored.groupBy("band", "key").agg(F.max(F.struct("score", (-F.col("doc_id")).alias("least"), "doc_id", "set_id", "n")).alias("pivot"))
    crowd = workspace.stage(crowd.join(best, ["band", "key"]).drop("many"), "crowd")
    fits = f"100 * least(a_n, b_n) >= {PERCENT} * greatest(a_n, b_n)"
    pivots = crowd.select(
        F.col("pivot.doc_id").alias("a_id"), F.col("pivot.set_id").alias("a_set"), F.col("pivot.n").alias("a_n"),
        *_vertex("b"), F.col("n").alias("b_n"),
    )
    first = workspace.stage(
        pivots.where("a_set <> b_set").where(fits)
        .select(*[F.when(F.col("a_set") < F.col("b_set"), F.col(x)).otherwise(F.col(y)).alias(x) for x, y in
                  (("a_id", "b_id"), ("a_set", "b_set"), ("b_id", "a_id"), ("b_set", "a_set"))])
        .distinct(),
        "pairs",
    )
    wanted = crowd.select("doc_id", "set_id").distinct()
    sets = full_sets(docs, wanted, id_col, text_col)
    found = workspace.stage(confirmed(first, sets), "links")
    joined = graph.components(found)
    # buckets whose members are still apart
    placed = crowd.drop("pivot").join(joined.withColumnRenamed("v", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id")
    )
    apart = placed.groupBy("band", "key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    open_ = workspace.stage(placed.join(apart.select("band", "key"), ["band", "key"], "left_semi"), "open")
    own = own_shingles(sets.join(open_.select("doc_id", "set_id").distinct(), ["doc_id", "set_id"], "left_semi"))
    hopeful = workspace.stage(
        open_.join(own, ["doc_id", "set_id"], "left").withColumn("own", F.coalesce("own", F.lit(0)))
        .where(f"100 * own <= {100 - PERCENT} * n"),
        "hopeful",
    )
    return found.union(workspace.stage(compared(hopeful, sets), "links"))


def compared(open_: DataFrame, sets: DataFrame) -> DataFrame:
    """``(u, v)``: confirmed links between members of a bucket in different components.

    ``open_`` has a row for each member of an open bucket (``band, key, doc_id, set_id, n, own,
    component``). Buckets that share members form a cluster, which is dealt in chunks of about
    ``CHUNK`` sets or ``CHUNK_SHINGLES`` shingles, whichever is less; a task gets two chunks and compares them in
    numpy, so pairs without a link are never rows, however large a cluster is. What a task holds is bounded by
    two chunks, or by two sets where sets are larger.
    """
    least = open_.groupBy("band", "key").agg(F.min("doc_id").alias("u"))
    edges = open_.join(least, ["band", "key"]).where("doc_id <> u").select("u", F.col("doc_id").alias("v"))
    cluster = graph.components(edges).select(F.col("v").alias("doc_id"), F.col("component").alias("cluster"))
    members = open_.groupBy("doc_id", "set_id").agg(
        F.first("n").alias("n"), F.first("own").alias("own"), F.first("component").alias("component"),
        F.collect_set(F.xxhash64("band", "key")).alias("buckets"),
    ).join(cluster, "doc_id", "left").withColumn("cluster", F.coalesce("cluster", "doc_id"))
    chunks = F.greatest(F.ceil(F.count("*") / CHUNK), F.ceil(F.sum("n") / CHUNK_SHINGLES))
    sizes = members.groupBy("cluster").agg(F.least(F.count("*"), chunks).cast("int").alias("chunks"))
    dealt = (
        members.join(sizes, "cluster").join(sets, ["doc_id", "set_id"])
        .withColumn("chunk", F.pmod(F.xxhash64("doc_id", "set_id"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .groupBy("cluster", F.least("chunk", "other").alias("x"), F.greatest("chunk", "other").alias("y"))
        .agg(F.collect_list(F.struct("chunk", "doc_id", "n", "own", "component", "buckets", "shingles")).alias("members"))
        .select("x", "y", "members")
    )

    def judge(batch: pa.RecordBatch) -> list:
        out: list[list] = [[], []]
        for x, y, members in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            left = [m for m in members if m["chunk"] == x]
            right = left if x == y else [m for m in members if m["chunk"] == y]
            for u, v in _linked(left, right, x == y):
                out[0].append(u)
                out[1].append(v)
        return out

    return T.map_rows(dealt, "u bigint, v bigint", judge, rows=1)


def _linked(left: list[dict], right: list[dict], same: bool) -> list[tuple[int, int]]:
    """Links between two chunks that a bucket allows and the bounds don't exclude, counted over an inverted index of one."""
    if not left or not right:
        return []
    arrays = [np.frombuffer(m["shingles"], np.uint64) for m in right]
    owners = np.repeat(np.arange(len(right)), [len(x) for x in arrays])
    shingles = np.concatenate(arrays)
    order = np.argsort(shingles, kind="stable")
    shingles, owners = shingles[order], owners[order]
    n, own, component = (np.array([m[k] for m in right], np.int64) for k in ("n", "own", "component"))
    in_bucket: dict[int, list[int]] = {}
    for k, m in enumerate(right):
        for b in m["buckets"]:
            in_bucket.setdefault(b, []).append(k)
    out = []
    for i, m in enumerate(left):
        allowed = np.zeros(len(right), bool)
        for b in m["buckets"]:
            allowed[in_bucket.get(b, [])] = True
        if same:
            allowed[: i + 1] = False
        # by sizes; and an own shingle is in the union and not in the intersection
        allowed &= (component != m["component"]) & (100 * np.minimum(n, m["n"]) >= PERCENT * np.maximum(n, m["n"]))
        allowed &= (100 - PERCENT) * np.minimum(n - own, m["n"] - m["own"]) >= PERCENT * (own + m["own"])
        if not allowed.any():
            continue
        mine = np.frombuffer(m["shingles"], np.uint64)
        first, last = np.searchsorted(shingles, mine, "left"), np.searchsorted(shingles, mine, "right")
        sizes = last - first
        place = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        both = np.bincount(owners[place], minlength=len(right))
        for k in np.flatnonzero(allowed & (100 * both >= PERCENT * (n + m["n"] - both))):
            out.append((m["doc_id"], right[k]["doc_id"]))
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per document."""
    described = describe(docs, id_col, text_col)
    named = described.where("doc_id IS NOT NULL AND set_id IS NOT NULL")
    same = named.groupBy("set_id").agg(F.min("doc_id").alias("u"))
    copies = named.join(same, "set_id").where("doc_id <> u").select("u", F.col("doc_id").alias("v"))
    found = graph.components(links(docs, described, id_col, text_col).union(copies))
    return described.select("doc_id", "n_shingles").join(found.withColumnRenamed("v", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents of which one stays per group, with all their columns."""
    gone = near_duplicates(docs, id_col, text_col).where("NOT kept").select(F.col("doc_id").alias(T.free_name(docs, "gone_id"))).distinct()
    return docs.join(gone, F.col(id_col).cast("bigint") == gone[0], "left_anti")
