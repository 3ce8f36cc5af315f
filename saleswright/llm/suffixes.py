"""Suffix-array dedup (5): a logarithmic family of sparse suffix arrays.

Every string of ``LENGTH`` bytes has an anchor of its own: of the places where ``GRAM`` bytes
begin inside it, the one whose bytes have the least hash. Equal strings have equal anchors,
so it is enough to index the suffixes that begin at anchors, one in about 76. A suffix is
ordered by the fingerprint of its first ``GRAM`` bytes, then by that of its context: all bytes
of the strings that it anchors, and where it lies among them. (Order beyond equality is of no
use here, so suffixes are ordered by fingerprints and not letter by letter.)

Documents come in batches. A batch gets its array, which is merge-scanned against each level
of the family for grams that both have; levels of equal size are then merged, so each suffix
is rewritten a logarithmic number of times. Matches go down in three steps, each of which
only sees what the last one left open: contexts that occur twice are repeated whole; of the
rest, blocks of ``BLOCK`` strings at a time are compared by what they have in common and by
all they cover; what then is still open is compared string by string. A gram, a context or a
block that fills a third of the corpus is counted, never gathered.

All keys are pairs of 64-bit fingerprints. Texts are named by two 64-bit hashes, so copies of
a text share their anchors' results.

Defined cases: a null or empty text, or one shorter than ``LENGTH``, loses nothing; repeated
rows are copies of each other; null ids stay; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswright import workspace
from saleswright.llm import text as T

LENGTH, GRAM, BLOCK, BATCHES = 200, 50, 16, 4
_WINDOW = LENGTH - GRAM + 1
_PLACE = np.uint64((1 << 31) - 1)
_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(5_417).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}
LEVEL = "g bigint, c bigint, t1 bigint, t2 bigint, a int, lo int, hi int"


def _power(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2**64, remembered."""
    out = _powers.get(base)
    if out is None or len(out) < n:
        size = max(1 << 12, 1 << (n - 1).bit_length())
        out, made = np.ones(size, np.uint64), 1
        while made < size:
            step = min(made, size - made)
            out[made : made + step] = out[:step] * np.uint64(pow(base, made, 1 << 64))
            made += step
        _powers[base] = out
    return out[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Hashed:
    """Fingerprints of any stretch of a byte string, from prefix sums."""

    def __init__(self, data: bytes):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[np.frombuffer(data, np.uint8)] * _power(_BASE, n), out=self.sums[1:])
        self.inverse = _power(pow(_BASE, -1, 1 << 64), n + 1)

    def of(self, start: np.ndarray, end: np.ndarray, salt: np.ndarray | int = 0) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.inverse[start] ^ _mixed(np.atleast_1d(np.asarray(salt, np.uint64))))


def anchors(data: bytes) -> tuple[np.ndarray, ...]:
    """``(g, c, a, lo, hi)``: each anchor with its gram, its context, and the first and last start of its strings."""
    n = len(data)
    if n < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    hashed, starts = Hashed(data), np.arange(n - GRAM + 1)
    grams = hashed.of(starts, starts + GRAM)
    least, width = (grams & ~_PLACE) | starts.astype(np.uint64), 1
    while 2 * width <= _WINDOW:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    rest = _WINDOW - width
    least = np.minimum(least[: len(least) - rest], least[rest:])
    chosen = (least & _PLACE).astype(np.int64)
    lo = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    hi = np.append(lo[1:], len(chosen)) - 1
    a = chosen[lo]
    context = hashed.of(lo, hi + LENGTH, ((a - lo) << 32) + (hi - lo) + 1)
    return grams[a].view(np.int64), context.view(np.int64), a, lo, hi


def _anchored(batch: pa.RecordBatch) -> list:
    found = [anchors(x) for x in batch.column(2).to_pylist()]
    sizes = [len(x[0]) for x in found]
    names = [pa.array(np.repeat(c.to_numpy(zero_copy_only=False), sizes)) for c in batch.columns[:2]]
    g, c, a, lo, hi = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*found, strict=True)) if found else ([],) * 5
    places = [pa.array(np.asarray(x, np.int32), pa.int32()) for x in (a, lo, hi)]
    return [pa.array(np.asarray(g, np.int64)), pa.array(np.asarray(c, np.int64)), *names, *places]


def _release(*frames: DataFrame) -> None:
    """Lets Spark drop the shuffle files of what has been written meanwhile."""
    spark = frames[0].sparkSession
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _drop(*written: DataFrame) -> None:
    """Removes written steps that went into another one; nothing reads them any more."""
    context = written[0].sparkSession.sparkContext
    jvm, conf = context._jvm, context._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for frame in written for f in frame.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def _sorted_run(level: DataFrame) -> DataFrame:
    return workspace.stage(level.sortWithinPartitions("g", "c"), "level")


def family(texts: DataFrame, batches: int = BATCHES) -> tuple[list[DataFrame], DataFrame]:
    """``(levels, met)``: all anchors in their levels, and the grams that occur more than once."""
    levels: list[tuple[int, DataFrame]] = []
    met = None
    for k in range(batches):
        part = texts.where(F.pmod("t1", F.lit(batches)) == k)
        new = _sorted_run(T.map_rows(part, LEVEL, _anchored, rows=64))
        grams = new.groupBy("g").agg(F.count("*").alias("n"))
        found = grams.where("n > 1").select("g")
        for _, level in levels:
            found = found.union(grams.select("g").join(level.select("g").distinct(), "g"))
        found = workspace.stage(found.distinct(), "met")
        met = found if met is None else met.union(found)
        levels.append((1, new))
        while len(levels) > 1 and levels[-1][0] == levels[-2][0]:
            (size, x), (_, y) = levels.pop(), levels.pop()
            merged = x.union(y).repartitionByRange("g", "c", "t1")
            levels.append((2 * size, _sorted_run(merged)))
            _drop(x, y)
        _release(texts)
    all_met = workspace.stage(met.distinct(), "met")
    _drop(met)
    return [x for _, x in levels], all_met


_ENTRY = ["g", "c", "t1", "t2", "a", "lo", "hi"]


def _cut_contexts(batch: pa.RecordBatch) -> list:
    """The bytes around each open entry of a text: from its first string to the end of its last."""
    out: list[list] = [[] for _ in range(8)]
    for t1, t2, text, entries in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        for e in entries:
            values = e["g"], e["c"], t1, t2, e["a"], e["lo"], e["hi"], text[e["lo"] : e["hi"] + LENGTH]
            for column, value in zip(out, values, strict=True):
                column.append(value)
    return out


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, Hashed]:
    """``(at, a, last, Hashed)`` of all entries at once: where each one's bytes begin in the joined bytes, and places relative to that."""
    a, lo, hi = (batch.column(x).to_numpy().astype(np.int64) for x in ("a", "lo", "hi"))
    data = batch.column("bytes").to_pylist()
    ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)))
    return np.append(np.zeros(1, np.int64), ends)[:-1], a - lo, hi - lo, Hashed(b"".join(data))


def _counted(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(which, value)``: for each k the ``n[k]`` whole numbers from ``first[k]`` on."""
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + first[which]


def _blocks(batch: pa.RecordBatch) -> list:
    """For each block of strings of an entry: what all of them have in common, and all they cover if none is missing."""
    at, a, last, hashed = _entries(batch)
    least = (a - last) // BLOCK
    which, j = _counted(least, a // BLOCK - least + 1)
    at, a, last = at[which], a[which], last[which]
    first_x, last_x = np.maximum(j * BLOCK, a - last), np.minimum(j * BLOCK + BLOCK - 1, a)
    core = hashed.of(at + a - j * BLOCK, at + a - j * BLOCK - (BLOCK - 1) + LENGTH, 3).view(np.int64)
    whole = hashed.of(at + a - last_x, at + a - first_x + LENGTH, 5).view(np.int64)
    part = last_x - first_x != BLOCK - 1
    return [*batch.select(_ENTRY).take(pa.array(which)).columns, pa.array(j.astype(np.int32)), pa.array(core), pa.array(whole, mask=part)]


def _strings(batch: pa.RecordBatch) -> list:
    """Each string of the open blocks of an entry by itself."""
    at, a, last, hashed = _entries(batch)
    open_ = batch.column("blocks")
    entry = np.repeat(np.arange(len(a)), open_.value_lengths().to_numpy())
    j = open_.flatten().to_numpy().astype(np.int64)
    first = np.maximum(j * BLOCK, a[entry] - last[entry])
    which, x = _counted(first, np.minimum(j * BLOCK + BLOCK - 1, a[entry]) - first + 1)
    which = entry[which]
    start = at[which] + a[which] - x
    prints = hashed.of(start, start + LENGTH, 7).view(np.int64)
    return [*batch.select(["g", "t1", "t2", "a"]).take(pa.array(which)).columns, pa.array(x.astype(np.int32)), pa.array(prints)]


def named_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), T.whole_text(text_col))
    return rows.select("doc_id", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"), F.col("text").cast("binary").alias("text"))


FILTER_BITS = 1 << 24


def _taken(wanted: DataFrame):
    """Which rows of a batch ``(doc_id, t1, ...)`` a bitmap of fixed size takes for ``wanted`` texts.

    At most ``FILTER_BITS`` bits are sent to the tasks, so that most other texts needn't be shuffled.
    """
    words = (
        wanted.select(F.shiftright(F.pmod("t1", F.lit(FILTER_BITS)), 6).alias("word"), F.pmod("t1", F.lit(64)).cast("int").alias("bit"))
        .groupBy("word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))).alias("bits"))
    )
    table = np.zeros(FILTER_BITS // 64, np.int64)
    for row in words.toLocalIterator():
        table[row["word"]] = row["bits"]
    shared = wanted.sparkSession.sparkContext.broadcast(np.unpackbits(table.view(np.uint8), bitorder="little").tobytes())

    def hit(batch: pa.RecordBatch) -> np.ndarray:
        return np.frombuffer(shared.value, bool)[batch.column(1).to_numpy(zero_copy_only=False) & (FILTER_BITS - 1)]

    return hit


_NAMED = ["doc_id", "t1", "t2", "text"]


def maybe(texts: DataFrame, taken) -> DataFrame:
    """The texts that may be wanted, by ``taken`` (see ``_taken``)."""
    return T.map_rows(
        texts.select(*_NAMED), "doc_id bigint, t1 bigint, t2 bigint, text binary", lambda batch: batch.filter(pa.array(taken(batch))).columns
    )


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES) -> DataFrame:
    """``(t1, t2, spans)``: the stretches of each distinct text that repeated strings cover, perhaps overlapping."""
    texts = named_texts(docs, id_col, text_col)
    levels, met = family(texts.select("t1", "t2", "text"), batches)
    index = levels[0]
    for level in levels[1:]:
        index = index.union(level)
    held = workspace.stage(index.join(met, "g", "left_semi"), "candidates")
    _drop(met, *levels)
    contexts = held.groupBy("g", "c").agg(F.count("*").alias("n"), F.min(F.struct(*_ENTRY[2:])).alias("e"))
    contexts = workspace.stage(contexts.select("g", "c", "n", "e.*"), "contexts")
    several = contexts.groupBy("g").agg(F.count("*").alias("m")).where("m > 1").select("g")
    open_ = contexts.join(several, "g", "left_semi")
    by_text = open_.groupBy("t1", "t2").agg(F.collect_list(F.struct("g", "c", "a", "lo", "hi")).alias("entries"))
    by_text = workspace.stage(by_text, "open")
    wanted = maybe(texts, _taken(by_text)).join(by_text, ["t1", "t2"]).select("t1", "t2", "text", "entries")
    cut = T.map_rows(wanted, f"{LEVEL}, bytes binary", _cut_contexts, rows=64)
    cut = workspace.stage(cut.dropDuplicates(["g", "c"]), "entries")
    _drop(by_text)
    _release(docs)
    blocks = workspace.stage(T.map_rows(cut, f"{LEVEL}, block int, core bigint, whole bigint", _blocks), "blocks")
    shared = blocks.groupBy("g", "block", "core").agg(
        F.count("*").alias("m"), F.count("whole").alias("w"), F.min("whole").alias("x"), F.max("whole").alias("y")
    ).where("m > 1").select("g", "block", "core", F.expr("w = m AND x = y").alias("alike"))
    judged = blocks.join(shared, ["g", "block", "core"]).select("g", "c", "t1", "t2", "a", "block", "alike")
    judged = workspace.stage(judged, "judged")
    _drop(blocks)
    _release(docs)
    still = judged.where("NOT alike").groupBy("g", "c").agg(F.collect_list("block").alias("blocks"))
    single = T.map_rows(
        cut.join(still, ["g", "c"]).select(*_ENTRY, "bytes", "blocks"), "g bigint, t1 bigint, t2 bigint, a int, x int, print bigint", _strings
    )
    single = workspace.stage(single, "strings")
    _drop(cut)
    _release(docs)
    twice = single.groupBy("g", "x", "print").agg(F.count("*").alias("m")).where("m > 1").drop("m")
    spans = (
        held.join(contexts.where("n > 1").select("g", "c"), ["g", "c"], "left_semi")
        .select("t1", "t2", F.col("lo").alias("from"), (F.col("hi") + LENGTH).alias("to"))
        .union(judged.where("alike").select("t1", "t2", F.expr(f"a - block * {BLOCK} - {BLOCK - 1}"), F.expr(f"a - block * {BLOCK} + {LENGTH}")))
        .union(single.join(twice, ["g", "x", "print"], "left_semi").select("t1", "t2", F.expr("a - x"), F.expr(f"a - x + {LENGTH}")))
    )
    found = workspace.stage(spans.groupBy("t1", "t2").agg(F.collect_set(F.struct("from", "to")).alias("spans")), "spans")
    _drop(held, contexts, judged, single)
    _release(docs)
    return found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _removed(batch: pa.RecordBatch) -> list:
    done = []
    for data, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
        gone = merged([(x["from"], x["to"]) for x in spans or ()])
        kept, at = hashlib.sha256(), 0
        for start, end in [*gone, (len(data), len(data))]:
            kept.update(data[at:start])
            at = end
        done.append((len(data), sum(b - a for a, b in gone), len(gone), kept.hexdigest(), gone))
    columns = [list(c) for c in zip(*done, strict=True)] or [[] for _ in range(5)]
    columns[4] = [[{"from": a, "to": b} for a, b in x] for x in columns[4]]
    return [batch.column(0), *columns]


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans)``, one row per document."""
    found = repeated_spans(docs, id_col, text_col, batches)
    texts, taken = named_texts(docs, id_col, text_col), _taken(found)
    touched = maybe(texts, taken).join(found, ["t1", "t2"], "left").select("doc_id", "text", "spans")
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<from: int, to: int>>"

    def untouched(batch: pa.RecordBatch) -> list:
        rest = batch.filter(pa.array(~taken(batch)))
        return _removed(pa.RecordBatch.from_arrays([rest.column(0), rest.column(3), pa.nulls(rest.num_rows)], ["doc_id", "text", "spans"]))

    return T.map_rows(touched, schema, _removed).union(T.map_rows(texts.select(*_NAMED), schema, untouched))
