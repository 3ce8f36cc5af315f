"""Token-ID output (10): Re-Pair grammars per shard, in a file format of its own.

A shard is a run of whole documents in ascending order. Its frequent pairs of neighbouring
ids become nonterminals, round by round, until no pair is frequent; a pair never reaches
over a document's end. Stored are the rules, the length each nonterminal expands to, the
symbols that are left, and where each document begins among the symbols and among the ids,
so any document can be decoded without the rest.

One file row holds one shard: ``part`` and ``shard`` give its place, ``payload`` its bytes
(see ``pack``). The rows are written by Spark as Parquet, so a shard is as safe as any task.

Defined cases: a null or empty text is the end id alone; documents with null ids come first;
rows with equal ids keep the order of a hash of their texts; an empty table gives no files
and no rows; further columns are ignored. A text is never cut: a very long one makes its
shard larger than ``SHARD_IDS``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleswright import workspace
from saleswright.llm import text as T
from saleswright.llm import tokens

#: Ids after which a shard is closed.
SHARD_IDS = 1 << 20
#: A pair that occurs so often in its shard is frequent; a round takes all pairs that occur
#: at least a ``ROUND``-th as often as the most frequent one.
MIN_COUNT, ROUND = 24, 6
#: The first nonterminal: one beyond the vocabulary's ids.
FIRST_RULE = 49_408
_SLOTS = 1 << 18
FILE_SCHEMA = "part int, shard int, n_docs bigint, n_ids bigint, payload binary"


def _slot(keys: np.ndarray) -> np.ndarray:
    return (keys * np.uint32(2654435761)) >> np.uint32(14)


def _keys(symbols: np.ndarray) -> np.ndarray:
    return (symbols[:-1] << np.uint32(16)) | symbols[1:]


def build(ids: np.ndarray, ends: np.ndarray, first_rule: int = FIRST_RULE, min_count: int = MIN_COUNT):
    """``(symbols, rules, symbol_ends)`` of a shard; ``ends`` are the documents' ends among the ids."""
    symbols, rules = ids.astype(np.uint32), []
    last = np.zeros(len(ids), bool)
    last[ends - 1] = True
    while len(symbols) > 1:
        free = (1 << 16) - first_rule - len(rules)
        keys = _keys(symbols)
        inner = ~last[:-1]
        ordered = np.sort(keys[inner])
        if not len(ordered) or free <= 0:
            break
        heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        counts = np.diff(np.append(heads, len(ordered)))
        least = max(min_count, int(counts.max()) // ROUND)
        often = np.flatnonzero(counts >= least)
        often = often[np.argsort(-counts[often], kind="stable")][:free]
        if not len(often):
            break
        pairs = ordered[heads[often]]
        slots = _slot(pairs)
        _, kept = np.unique(slots, return_index=True)  # of two pairs in a slot, the rarer waits for a later round
        pairs = pairs[np.sort(kept)]
        slots = _slot(pairs)
        table = np.full(_SLOTS, -1, np.int64)
        table[slots] = np.arange(len(pairs))
        owner = table[_slot(keys)]
        hit = inner & (owner >= 0)
        at = np.flatnonzero(hit)
        at = at[pairs[owner[at]] == keys[at]]
        # of overlapping pairs, every second one from the left
        starts = np.concatenate([[True], np.diff(at) != 1]) if len(at) else np.zeros(0, bool)
        offset = np.arange(len(at)) - np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
        at = at[offset % 2 == 0]
        symbols[at] = (first_rule + len(rules) + owner[at]).astype(np.uint32)
        last[at] = last[at + 1]
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        symbols, last = symbols[stay], last[stay]
        rules.extend(pairs.tolist())
    packed = np.array(rules, np.uint32)
    return symbols, np.stack([packed >> np.uint32(16), packed & np.uint32(0xFFFF)], 1), np.flatnonzero(last) + 1


def expansions(rules: np.ndarray, first_rule: int = FIRST_RULE) -> tuple[np.ndarray, np.ndarray]:
    """``(lengths, pool)``: what each rule expands to, one after another."""
    known: list[np.ndarray] = []
    for pair in rules:
        known.append(np.concatenate([known[x - first_rule] if x >= first_rule else np.array([x], np.uint32) for x in pair]))
    lengths = np.array([len(x) for x in known], np.int64)
    return lengths, np.concatenate(known) if known else np.zeros(0, np.uint32)


def expand(symbols: np.ndarray, rules: np.ndarray, first_rule: int = FIRST_RULE) -> np.ndarray:
    """The ids of a run of symbols."""
    lengths, pool = expansions(rules, first_rule)
    pool = np.concatenate([np.arange(first_rule, dtype=np.uint32), pool])
    starts = np.concatenate([np.arange(first_rule), first_rule + np.cumsum(lengths) - lengths])
    sizes = np.concatenate([np.ones(first_rule, np.int64), lengths])[symbols]
    total = int(sizes.sum())
    place = np.repeat(starts[symbols] - (np.cumsum(sizes) - sizes), sizes)
    return pool[place + np.arange(total)]


def pack(doc_ids: list[int | None], encoded: list[bytes]) -> tuple[int, int, bytes]:
    """``(n_docs, n_ids, payload)``. The payload: eight 64-bit counts and flags, then the arrays they announce."""
    ids = np.frombuffer(b"".join(encoded), "<u4")
    ends = np.cumsum([len(x) // 4 for x in encoded])
    symbols, rules, symbol_ends = build(ids, ends)
    lengths, _ = expansions(rules)
    named = np.array([x is not None for x in doc_ids])
    head = np.array([len(doc_ids), len(ids), len(symbols), len(rules), FIRST_RULE, 0, 0, 0], "<i8")
    parts = [
        head, np.array([x or 0 for x in doc_ids], "<i8"), named.astype("u1"), ends.astype("<i8"),
        symbol_ends.astype("<i8"), rules.astype("<u2"), lengths.astype("<u4"), symbols.astype("<u2"),
    ]
    return len(doc_ids), len(ids), b"".join(x.tobytes() for x in parts)


class Shard:
    """A read payload; ``document(k)`` decodes one document alone, ``documents()`` all of them."""

    def __init__(self, payload: bytes):
        head = np.frombuffer(payload, "<i8", 8)
        n_docs, self.n_ids, n_symbols, n_rules, self.first_rule = map(int, head[:5])
        at = 64

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, count, at)
            at += out.nbytes
            return out

        ids, named = take("<i8", n_docs), take("u1", n_docs)
        self.doc_ids = [int(x) if y else None for x, y in zip(ids, named, strict=True)]
        self.ends, self.symbol_ends = take("<i8", n_docs), take("<i8", n_docs)
        self.rules = take("<u2", 2 * n_rules).reshape(-1, 2)
        self.lengths, self.symbols = take("<u4", n_rules), take("<u2", n_symbols)

    def document(self, k: int) -> np.ndarray:
        start = self.symbol_ends[k - 1] if k else 0
        return expand(self.symbols[start : self.symbol_ends[k]], self.rules, self.first_rule)

    def documents(self) -> list[np.ndarray]:
        return np.split(expand(self.symbols, self.rules, self.first_rule), self.ends[:-1])


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Encode, compress and write all documents in ascending order; returns the table of files.

    The one shuffle deals whole texts by ranges of ids; each task then streams through its
    range and holds one shard at a time.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, held, encoded, size = TaskContext.get().partitionId(), 0, [], [], 0

        def closed():
            n_docs, n_ids, payload = pack(held, encoded)
            columns = {"part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32())}
            return pa.RecordBatch.from_pydict(columns | {"n_docs": [n_docs], "n_ids": [n_ids], "payload": pa.array([payload], pa.binary())})

        for batch in T.slices(batches):
            for doc, ids in zip(batch.column(0).to_pylist(), tokens.encode_texts(batch.column(1).to_pylist(), path), strict=True):
                held.append(doc)
                encoded.append(ids)
                size += len(ids) // 4
                if size >= SHARD_IDS:
                    yield closed()
                    shard, held, encoded, size = shard + 1, [], [], 0
        if held:
            yield closed()

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), tokens.text_bytes(text_col))
    ties = rows.withColumn("tie", F.xxhash64("text"))
    dealt = ties.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    files = T.map_batches(dealt, FILE_SCHEMA, work)
    if folder is None:
        return workspace.stage(files, "shards")
    files.write.parquet(folder)
    return docs.sparkSession.read.schema(FILE_SCHEMA).parquet(folder)


def read_documents(files: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, decoded from the files."""
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    part_starts = parts.select(
        "part", F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("part_start")
    )
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        files.select("part", "shard", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("shard_start"))
        .join(part_starts, "part")
        .select("part", "shard", (F.col("part_start") + F.col("shard_start")).alias("first_id"))
    )

    def work(batch: pa.RecordBatch) -> list:
        out: list[list] = [[], [], [], []]
        for first, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            shard = Shard(payload)
            begins = first + np.concatenate([[0], shard.ends[:-1]])
            out[0] += shard.doc_ids
            out[1] += begins.tolist()
            for ids in shard.documents():
                out[2].append(len(ids))
                out[3].append(zlib.crc32(ids.astype("<u4").tobytes()))
        return out

    rows = files.join(starts, ["part", "shard"]).select("first_id", "payload")
    return T.map_rows(rows, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint", work, rows=4)
