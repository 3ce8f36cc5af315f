"""Cross-tokenizer alignment (13): which tokens of two tokenizers cover the same bytes.

Both tokenizers spell a space and the text. A dictionary from byte end to index per token list,
intersected by their keys, gives the offsets where both end a token; the sorted common ends
slice both id lists into groups, and inside a group all token pairs whose byte ranges overlap
are links.

No token of either goes beyond the white space before a word, so a text is cut into units
(white space and the word behind it) that are aligned by themselves, and each worker remembers
the units it has seen. What the vocabulary says decides where that holds: a word is cut from the
mark behind it if no piece joins the two, and a text with white space that a piece may join to a
word is one unit. A test compares with whole texts.

Documents are dealt into shards of ``SHARD_BYTES`` of text, one row each, with every unit and
every linked id pair once. The pairs of all shards are added up over the cluster, and each
shard gets the totals of its own pairs back: a pair is one row per shard, however often it
occurs, and a shard's list is bounded by its text.

Defined cases: a null or empty text, or one whose joined token bytes differ from a space and the
text, has no tokens and no links: zeros and an empty digest; null ids and repeated rows stay,
each a row; a very long text is a shard of its own; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswright import workspace
from saleswright.llm import text as T
from saleswright.llm import tokens

A_VOCABULARY, B_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Text bytes and documents in a shard.
SHARD_BYTES, SHARD_DOCS = 1 << 20, 1 << 16
#: Units in one generation of a worker's memory. When it is full it becomes the old one, from which units that are asked for
#: again move on; two generations take some 160 MB. It is full, too, when its units have so many characters.
REMEMBERED, REMEMBERED_CHARS = 200_000, 4 << 20
#: Rows that go to a worker at a time, of texts and of shards: a batch is held whole on both sides.
_TEXTS, _SHARDS = ({"spark.sql.execution.arrow.maxRecordsPerBatch": str(n)} for n in (256, 4))
#: Units that are spelled at a time for the digest.
SPELLED = 1 << 14
_SPACE = "▁"
#: White space besides space and line end, or what some call so.
_OTHER = re.compile("[^\\S \\n]|[\\u180e\\u200b\\u2060\\ufeff]")
_UNIT = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_MARKED_LETTER = r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f](?=[.,;:!?])"
#: The same, cut between Latin letters and a mark as well.
_MARKED = re.compile(rf"[ \n]*(?:[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]*{_MARKED_LETTER}|[^ \n]+)|[ \n]+")
_SHARD = (
    "shard bigint, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
    "digests array<string>, doc_ends binary, doc_units binary, unit_ends binary, unit_pairs binary, a binary, b binary, n binary"
)
_OUT = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
)


def slices(a_ends: list[int], b_ends: list[int]) -> list[tuple[int, int, int, int]]:
    """``(i, i2, j, j2)``: the tokens ``i..i2`` of A and ``j..j2`` of B between two common ends."""
    a_at, b_at = ({end: k for k, end in enumerate(ends, 1)} for ends in (a_ends, b_ends))
    out, i, j = [], 0, 0
    for end in sorted(a_at.keys() & b_at.keys()):
        out.append((i, a_at[end], j, b_at[end]))
        i, j = a_at[end], b_at[end]
    return out


def links(a_ends: list[int], b_ends: list[int], part: tuple[int, int, int, int]) -> list[tuple[int, int]]:
    """Index pairs inside a group whose byte ranges overlap."""
    i, i2, j, j2 = part
    if i2 - i == 1 or j2 - j == 1:
        return [(x, y) for x in range(i, i2) for y in range(j, j2)]
    out = []
    while i < i2 and j < j2:
        out.append((i, j))
        if a_ends[i] < b_ends[j]:
            i += 1
        elif a_ends[i] > b_ends[j]:
            j += 1
        else:
            i, j = i + 1, j + 1
    return out


class Aligner:
    """One worker's two tokenizers and its memory of units: ``(n_a, n_b, n_groups, spelled, pairs)`` or None where bytes differ."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        letters = {c: b for b, c in tokens._byte_letters().items()}
        entries = sorted(self.a.get_vocab().items(), key=lambda x: x[1])
        self.a_bytes = [bytes(letters.get(c, ord(c) & 255) for c in entry) for entry, _ in entries]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(_SPACE, " ").encode() for k, p in enumerate(pieces)
        ]
        self.blank = pieces.index(_SPACE)
        # a piece may hold spaces at its start only, and no line end at all, for units to be cut there
        self.separable = not any(_SPACE in p.lstrip(_SPACE) or "\n" in p for p in pieces)
        mixed = any(re.search(_MARKED_LETTER, p) for p in pieces)
        self.unit = _UNIT if mixed else _MARKED
        self.known: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}
        self.chars = 0

    def units(self, text: str) -> list[str]:
        """A space and the text, cut where neither tokenizer joins anything."""
        text = " " + text
        if not self.separable or _OTHER.search(text):
            return [text]
        return self.unit.findall(text)

    def align(self, a: list[int], b: list[int], data: bytes) -> tuple | None:
        """The record of one unit with these ids; ``data`` is what both must spell."""
        a_raw, b_raw = [self.a_bytes[x] for x in a], [self.b_bytes[x] for x in b]
        if b"".join(a_raw) != data or b"".join(b_raw) != data:
            return None
        a_text, b_text = list(map(str, a)), list(map(str, b))
        if len(a) == 1 or len(b) == 1:
            spelled = f"{','.join(a_text)}|{','.join(b_text)}"
            return len(a), len(b), 1, spelled, array("Q", [x << 32 | y for x in a for y in b]).tobytes()
        a_ends, b_ends = list(accumulate(map(len, a_raw))), list(accumulate(map(len, b_raw)))
        parts, pairs = slices(a_ends, b_ends), []
        for part in parts:
            pairs += [a[x] << 32 | b[y] for x, y in links(a_ends, b_ends, part)]
        spelled = ";".join([f"{','.join(a_text[i:i2])}|{','.join(b_text[j:j2])}" for i, i2, j, j2 in parts])
        return len(a), len(b), len(parts), spelled, array("Q", pairs).tobytes()

    def b_ids(self, units: list[str]) -> list[list[int]]:
        """The library puts a space before each but an empty text. A unit without one follows a line end, and both tokens before it go."""
        found = self.b.encode([u[1:] if u[0] == " " else "\n" + u for u in units], num_threads=1)
        return [(ids or [self.blank]) if u[0] == " " else ids[2:] for u, ids in zip(units, found, strict=True)]

    def records(self, units: list[str]) -> list[tuple | None]:
        if len(self.known) >= REMEMBERED or self.chars >= REMEMBERED_CHARS:
            self.old, self.known, self.chars = self.known, {}, 0
        known, old, new = self.known, self.old, []
        for u in units:
            if u not in known:
                self.chars += len(u)
                if u in old:
                    known[u] = old[u]
                else:
                    new.append(u)
        for start in range(0, len(new), 4096):
            part = new[start : start + 4096]
            a = [x.ids for x in self.a.encode_batch(part, add_special_tokens=False)]
            for u, x, y in zip(part, a, self.b_ids(part), strict=True):
                known[u] = self.align(x, y, u.encode())
        return [known[u] for u in units]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


class _Numbered(dict):
    """Numbers keys in the order in which they come."""

    def __missing__(self, key):
        value = self[key] = len(self)
        return value


def _number(count: int) -> str:
    """The type of numbers below ``count``. Shards are stored and shuffled, mostly as numbers of units."""
    return "<u2" if count <= 1 << 16 else "<u4"


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the runs of ``values`` that end at ``ends``."""
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    return np.diff(total[np.concatenate([np.zeros(1, np.int64), ends])])


class _Shard:
    """Documents, each as numbers of units, and the distinct units."""

    def __init__(self):
        self.ids, self.docs, self.units, self.size = [], [], _Numbered(), 0

    def add(self, own: Aligner, doc_id: int | None, text: str | None) -> None:
        found = own.units(text) if text else []
        self.ids.append(doc_id)
        self.docs.append(np.fromiter(map(self.units.__getitem__, found), np.uint32, len(found)))
        self.size += len(text or "")

    def row(self, own: Aligner, number: int) -> list:
        """The shard as one row of ``_SHARD``."""
        records = own.records(list(self.units))
        bad = np.array([r is None for r in records], bool)
        records = [r or (0, 0, 0, "", b"") for r in records]
        docs = [d[:0] if bad[d].any() else d for d in self.docs]
        ends = np.cumsum([len(d) for d in docs], dtype=np.int64)
        held = np.concatenate([np.zeros(0, np.uint32), *docs])
        sizes = np.array([len(r[4]) // 8 for r in records], np.int64)
        figures = [_sums(np.array([r[k] for r in records], np.int64)[held], ends).tolist() for k in range(3)]
        pairs, place = np.unique(np.frombuffer(b"".join([r[4] for r in records]), np.uint64), return_inverse=True)
        often = np.repeat(np.bincount(held, minlength=len(records)), sizes)
        n = np.bincount(place, weights=often, minlength=len(pairs)).astype(np.int64)
        spelled, digests = [r[3] for r in records], []
        for d in docs:
            digest = hashlib.sha256()
            for start in range(0, len(d), SPELLED):
                digest.update((";" * (start > 0) + ";".join(map(spelled.__getitem__, d[start : start + SPELLED].tolist()))).encode())
            digests.append(digest.hexdigest() if len(d) else "")
        own_pairs, names = np.cumsum(sizes), held.astype(_number(len(records)))
        wide = (ends, names, own_pairs.astype(np.uint32), place.astype(_number(len(pairs))), (pairs >> np.uint64(32)).astype(np.int32), pairs.astype(np.int32), n)
        return [number, self.ids, *figures, _sums(sizes[held], ends).tolist(), digests, *[x.tobytes() for x in wide]]


def shards(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SHARD_BYTES) -> DataFrame:
    """All documents in shards (``_SHARD``), written once."""
    schema = T.arrow_schema(_SHARD)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number, shard = aligner(a_path, b_path), TaskContext.get().partitionId() << 32, _Shard()

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(shard.row(own, number), schema, strict=True)], schema=schema)

        for part in T.slices(batches, 64):
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                shard.add(own, doc_id, text.as_py())
                if shard.size >= size or len(shard.ids) >= SHARD_DOCS:
                    yield done()
                    number, shard = number + 1, _Shard()
        if shard.ids:
            yield done()

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return workspace.stage(T.map_batches(rows, _SHARD, run), "shards", _TEXTS)


def _pairs(batch: pa.RecordBatch) -> list:
    """One row per id pair of a shard, with its place ``k`` in the shard."""
    a, b, n = (np.concatenate([np.frombuffer(x, t) for x in c.to_pylist()]) for c, t in zip(batch.columns[1:], ("<i4", "<i4", "<i8"), strict=True))
    sizes = [len(x) // 4 for x in batch.column(1).to_pylist()]
    shard = np.repeat(batch.column(0).to_numpy(), sizes)
    return [shard, np.concatenate([np.arange(k, dtype=np.int32) for k in sizes]), a, b, n]


def pair_counts(dealt: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(shard, k, a, b, n)`` of every shard, and ``(a, b, total, best)``: all links of a pair, and if no other A id has more for its B id."""
    each = T.map_rows(dealt.select("shard", "a", "b", "n"), "shard bigint, k int, a int, b int, n bigint", _pairs, rows=1)
    totals = workspace.stage(each.groupBy("a", "b").agg(F.sum("n").alias("total")).where("total > 0"), "pairs")
    most = totals.groupBy("b").agg(F.max("total").alias("most"))
    return each, totals.join(most, "b").select("a", "b", "total", (F.col("total") == F.col("most")).alias("best"))


def _scored(batch: pa.RecordBatch) -> list:
    """The documents of a shard with the totals of its pairs."""
    row = {name: batch.column(k)[0] for k, name in enumerate(batch.schema.names)}
    unit_ends, count = np.frombuffer(row["unit_ends"].as_py(), "<u4"), len(row["n"].as_py()) // 8
    kinds = (("doc_ends", "<i8"), ("doc_units", _number(len(unit_ends))), ("unit_pairs", _number(count)))
    ends, held, place = (np.frombuffer(row[c].as_py(), t) for c, t in kinds)
    sums = []
    for field in ("best", "total"):
        value = np.zeros(count, np.int64)
        if row["totals"].is_valid:
            found = row["totals"].values
            value[found.field("k").to_numpy()] = found.field(field).cast(pa.int64()).to_numpy()
        sums.append(_sums(_sums(value[place], unit_ends)[held], ends))
    return [row[c].values for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")] + sums + [row["digests"].values]


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SHARD_BYTES) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, one row per document."""
    dealt = shards(docs, a_path, b_path, id_col, text_col, size)
    each, counts = pair_counts(dealt)
    back = each.join(counts, ["a", "b"]).groupBy("shard").agg(F.collect_list(F.struct("k", F.col("best").cast("int").alias("best"), "total")).alias("totals"))
    rows = dealt.drop("a", "b").join(back, "shard", "left")
    return workspace.stage(T.map_rows(rows, _OUT, _scored, rows=1), "aligned", _SHARDS)


def groups(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, groups)``: the groups themselves, each as the ids of A and of B; none where a text has no tokens."""

    def work(batch: pa.RecordBatch) -> list:
        own, out = aligner(a_path, b_path), []
        for text in batch.column(1).to_pylist():
            found = own.records(own.units(text)) if text else []
            spelled = [] if None in found else ";".join(r[3] for r in found).split(";") if found else []
            out.append([dict(zip("ab", ([int(x) for x in side.split(",")] for side in g.split("|")), strict=True)) for g in spelled])
        return [batch.column(0), out]

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return T.map_rows(rows, "doc_id bigint, groups array<struct<a: array<int>, b: array<int>>>", work)
