"""Byte-level BPE encoding and decoding (6) in overlapping chunks.

A text is cut into chunks of ``CHUNK`` code points, each read ``OVERLAP`` beyond its end. All
chunks are split into pre-tokens at once, each from its own start, which may lie inside a
pre-token. The pattern only looks ahead, so from a place where two chunks both have a
boundary, both split alike. Such a place is sought in the overlap of every chunk with the
next; there the earlier chunk hands over. A chunk that finds none, because one pre-token
fills the overlap, is split again together with its neighbours by one task, from where the
last chunk handed over. Then each chunk encodes its own pre-tokens, and the chunks' ids are
put together in order. Decoding concatenates the tokens' raw bytes, once the ids are whole, so
that only the ids travel.

A text of one chunk has nothing to stitch and is encoded where it is read. Splitting and
encoding are those of the named rank file and pattern, piece by piece, so the ids are those
of the whole text.

Defined cases: a null or empty text has no ids; repeated rows are encoded each (chunks carry
a key of their row); null ids stay; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleswright import workspace
from saleswright.llm import text as T

RANKS = "byte_bpe_50k.tiktoken"
#: Code points in a chunk, and beyond its end.
CHUNK, OVERLAP = 16_384, 1_024
#: Pre-tokens in one generation of a worker's memory.
REMEMBERED = 200_000
_OUT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class Codec:
    """One worker's rank table, pattern and memory of pre-tokens."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.known: dict[str, str] = {}
        self.old: dict[str, str] = {}

    def boundaries(self, text: str, start: int = 0) -> list[int]:
        """Where pre-tokens end, splitting from ``start`` on; what no pre-token covers counts as one."""
        return [m.end() for m in self.pattern.finditer(text, start)]

    def encode(self, pieces: list[str]) -> list[str]:
        """Each pre-token's ids in decimal, joined by a space."""
        if len(self.known) >= REMEMBERED:
            self.old, self.known = self.known, {}
        known, old, out = self.known, self.old, []
        for piece in pieces:
            ids = known.get(piece)
            if ids is None:
                ids = old.get(piece)
                if ids is None:
                    ids = " ".join(map(str, self.library._encode_single_piece(piece)))
                known[piece] = ids
            out.append(ids)
        return out

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, map(int, ids.split())))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def _digests(ids: str, decoded: bytes) -> tuple[int, str, str]:
    return ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()


def chunks(docs: DataFrame, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``(row, doc_id, part, at, text)`` for the texts of more than one chunk."""
    last = F.expr(f"CAST((n - 1) DIV {chunk} AS INT)")
    cut = docs.where(F.col("n") > chunk).select("row", "doc_id", "text", F.explode(F.sequence(F.lit(0), last)).alias("part"))
    at = F.col("part") * chunk
    return cut.select("row", "doc_id", "part", at.alias("at"), F.substring("text", at + 1, F.lit(chunk + overlap)).alias("text"))


def _seams(path: str, pattern: str, chunk: int, overlap: int):
    """Boundaries of each chunk in the overlap at its start and in that at its end, in the text's places."""

    def work(batch: pa.RecordBatch) -> list:
        own = codec(path, pattern)
        heads, tails = [], []
        for at, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            ends = own.boundaries(text)
            # a pre-token that touches a cut, or could look beyond it, is not certain
            sure = [at + x for x in ends if x < len(text) - 1] if len(text) == chunk + overlap else [at + x for x in ends]
            heads.append([x for x in sure if x <= at + overlap])
            tails.append([x for x in sure if x >= at + chunk])
        return [batch.column(0), batch.column(1), batch.column(2), heads, tails]

    return work


def _joined(path: str, pattern: str):
    """Encodes one run of text between two seams."""

    def work(batch: pa.RecordBatch) -> list:
        own = codec(path, pattern)
        ids = [" ".join(own.encode(own.pattern.findall(text))) for text in batch.column(2).to_pylist()]
        return [batch.column(0), batch.column(1), ids]

    return work


def encode_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``, one row per document."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("doc_id"), T.whole_text(text_col)
    ).withColumn("n", F.length("text"))

    def whole(batch: pa.RecordBatch) -> list:
        own = codec(path, pattern)
        done = []
        for text in batch.column(1).to_pylist():
            ids = " ".join(own.encode(own.pattern.findall(text)))
            done.append(_digests(ids, own.decode(ids)))
        return [batch.column(0), *(list(c) for c in zip(*done, strict=True))] if done else [batch.column(0), [], [], []]

    short = T.map_rows(rows.where(F.col("n") <= chunk).select("doc_id", "text"), _OUT, whole)
    cut = workspace.stage(chunks(rows, chunk, overlap), "chunks")
    seams = T.map_rows(
        cut.select("row", "part", "at", "text"), "row bigint, part int, at bigint, heads array<bigint>, tails array<bigint>",
        _seams(path, pattern, chunk, overlap), rows=32,
    )
    in_order = Window.partitionBy("row").orderBy("part")
    # the first common boundary; a chunk without one is joined to the run before it
    meet = F.array_min(F.array_intersect(F.lag("tails").over(in_order), "heads"))
    begins = (
        seams.select("row", "part", "at", F.when(F.col("part") == 0, F.lit(0).cast("bigint")).otherwise(meet).alias("begin"))
        .withColumn("run", F.count("begin").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    )
    runs = begins.groupBy("row", "run").agg(F.min("begin").alias("begin"), F.min("part").alias("first"), F.max("part").alias("last"))
    runs = runs.withColumn("end", F.lead("begin").over(Window.partitionBy("row").orderBy("run")))
    # dealt by text alone, so that the chunks move once
    run_of = begins.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("part", "run"))).alias("run_of"))
    texts = (
        cut.join(run_of, "row").select("row", F.col("run_of")[F.col("part")].alias("run"), "part", "at", "text")
        .groupBy("row", "run")
        .agg(F.sort_array(F.collect_list(F.struct("part", "text"))).alias("parts"), F.min("at").alias("at"))
    )
    # all but the last chunk of a run without their overlap
    n = F.size("parts")
    text = F.array_join(F.transform("parts", lambda x, k: F.when(k < n - 1, F.substring(x["text"], 1, chunk)).otherwise(x["text"])), "")
    from_, length = F.col("begin") - F.col("at") + 1, F.coalesce(F.col("end") - F.col("begin"), F.lit(1 << 30))
    pieces = texts.join(runs, ["row", "run"]).select(
        "row", F.col("run").cast("int"), F.substring(text, from_.cast("int"), length.cast("int")).alias("text")
    )
    encoded = T.map_rows(pieces, "row bigint, run int, ids string", _joined(path, pattern), rows=32)
    whole_ids = encoded.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("run", "ids"))).alias("runs"))
    ids = F.array_join(F.filter(F.col("runs.ids"), lambda x: x != ""), " ")
    in_full = whole_ids.join(cut.where("part = 0").select("row", "doc_id"), "row").select("doc_id", ids.alias("ids"))

    def digested(batch: pa.RecordBatch) -> list:
        own = codec(path, pattern)
        done = [_digests(x, own.decode(x)) for x in (v.as_py() for v in batch.column(1))]
        return [batch.column(0), *(list(c) for c in zip(*done, strict=True))] if done else [batch.column(0), [], [], []]

    return short.union(T.map_rows(in_full, _OUT, digested, rows=32))
