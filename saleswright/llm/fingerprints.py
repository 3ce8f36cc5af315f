"""Document fingerprints (4): MinHash by many universal hash functions, in vectorised numpy.

Coordinate ``k`` of a signature is the least value of ``(a_k * x + b_k) mod 2^64``, upper 32
bits, over the shingles ``x`` of a text (five words, A-Z lower-cased; a shorter text is one
shingle). The fingerprint spells the low 16 bits of each coordinate in hex; the likeness of two
fingerprints is their share of equal coordinates, an estimate of the sets' Jaccard similarity.

``near_links`` joins bands of signatures in Spark and confirms each pair on its full sets.

``edited`` compares each text with its own edit and with the next document. The one shuffle
deals whole texts by ranges of ids; a task passes once through its sorted range and needs the
next text only. The edges of the ranges, two rows for each task, are matched afterwards.

Defined cases: a null or empty text has no shingles and its fingerprint spells the largest
values, so two empty texts are alike and an empty one is unlike all others; rows with null
ids come first, rows with equal ids are ordered by a hash of their texts; the last row's next
one is the first, which for a single row is itself; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleswright import workspace
from saleswright.llm import neardup
from saleswright.llm import text as T

PERMUTATIONS = 64
#: 16 bands of 4 coordinates: a pair at a similarity of 0.75 is missed with probability 0.2 %.
BANDS = 16
_RANDOM = np.random.default_rng(7_719_103)
_A = _RANDOM.integers(1, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 1 << 63, PERMUTATIONS, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """``PERMUTATIONS`` coordinates; the largest value for an empty set."""
    out = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint64)
    for start in range(0, len(shingles), 2048):
        values = shingles[None, start : start + 2048] * _A[:, None] + _B[:, None]
        np.minimum(out, values.min(axis=1) >> np.uint64(32), out=out)
    return out.astype(np.uint32)


def fingerprint(text: str) -> np.ndarray:
    """The low 16 bits of each coordinate. Repeated shingles don't change a minimum."""
    hashes = T.word_hashes(text.encode().lower())
    return signature(T.windows(hashes, T.WIDTH)).astype("<u2")


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    return float((x == y).mean())


def edited_text(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many, or all, of the next text."""
    m = len(text) // 4
    return text[: len(text) - m] + following[:m]


def _compared(text: str, print_: np.ndarray, following: str, next_print: np.ndarray) -> tuple:
    changed = edited_text(text, following)
    edited = fingerprint(changed) if changed != text else print_
    digest = hashlib.sha256(changed.encode()).hexdigest()
    return digest, edited.tobytes().hex(), likeness(print_, edited), likeness(print_, next_print)


_SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, part int, first boolean, last boolean, edge string"
)


def _pass(batches: Iterable[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    part, held = TaskContext.get().partitionId(), None

    def batch_of(rows: list) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    first = True
    for piece in T.slices(batches):
        rows = []
        for doc, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
            print_ = fingerprint(text)
            if held:
                before, own, mine = held
                sha, changed, near, following = _compared(own, mine, text, print_)
                rows.append((before, len(own), sha, mine.tobytes().hex(), changed, near, following, part, first, False, own if first else None))
                first = False
            held = doc, text, print_
        yield batch_of(rows)
    if held:
        doc, own, mine = held
        yield batch_of([(doc, len(own), None, mine.tobytes().hex(), None, None, None, part, first, True, own)])


def _edges(batch: pa.RecordBatch) -> list:
    done = []
    for text, print_, following, next_print in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
        prints = (np.frombuffer(bytes.fromhex(x), "<u2") for x in (print_, next_print))
        mine, other = prints
        done.append(_compared(text, mine, following, other))
    columns = [list(c) for c in zip(*done, strict=True)] or [[], [], [], []]
    return [batch.column(0), [len(x) for x in batch.column(2).to_pylist()], columns[0], batch.column(3), *columns[1:]]


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), T.whole_text(text_col)).withColumn("tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    passed = workspace.stage(T.map_batches(dealt, _SCHEMA, partial(_pass, schema=T.arrow_schema(_SCHEMA))), "fingerprints")
    keep = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    # one row per task from here on
    heads = passed.where("first").select("part", F.col("edge").alias("next_text"), F.col("fingerprint").alias("next_print"))
    follow = heads.select(
        F.col("part").alias("own_part"),
        F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.orderBy("part"))).alias("part"),
    )
    tails = (
        passed.where("last").select("doc_id", F.col("part").alias("own_part"), "edge", "fingerprint")
        .join(follow, "own_part").join(heads, "part")
        .select("doc_id", "own_part", "edge", "fingerprint", "next_text", "next_print")
    )
    kinds = dict(x.rsplit(" ", 1) for x in _SCHEMA.split(", "))
    closed = T.map_rows(tails, ", ".join(f"{c} {kinds[c]}" for c in keep), _edges)
    return passed.where("NOT last").select(keep).union(closed)


def _described(batch: pa.RecordBatch) -> list:
    sizes, ids, bands = [], [], []
    for text in batch.column(1).to_pylist():
        shingles = T.shingle_set(text)
        sizes.append(len(shingles))
        ids.append(neardup.set_id(shingles) if len(shingles) else None)
        bands.append(neardup.band_keys(signature(shingles), BANDS).tolist() if len(shingles) else [])
    return [batch.column(0), sizes, ids, bands]


def near_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(u, v)``: classes of equal sets whose bands meet, confirmed by the Jaccard similarity of their full sets.

    Members of a bucket are compared with one of them, and with each other where that leaves
    them in different components; ids stand for their class of equal sets.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), T.whole_text(text_col))
    described = workspace.stage(T.map_rows(rows, neardup.DESCRIBED, _described), "signatures")
    return neardup.links(docs, described, id_col, text_col)
