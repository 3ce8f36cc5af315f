"""Phrase collocation mining (12) by SON partitioning.

Documents become blocks of at most ``BLOCK_WORDS`` words of one language, as codes of a
dictionary of the block; blocks are dealt to ``SHARDS`` shards. In each shard all phrases are
mined that are frequent there: a phrase with ``MIN_COUNT`` occurrences in its language has, in at
least one shard, a share of them no smaller than the shard's share of the words, so that share
of ``MIN_COUNT`` is the local support. Mining goes by length: a phrase counts only where a bitmap
has both phrases one word shorter as frequent in the shard. A block emits such phrases as sorted
lists of hashes and counts, a list per range of hashes, and one shuffle brings the lists of a
shard, a language and a range together; the blocks themselves are never shuffled. The locally
frequent phrases of all shards are then counted over all blocks by their words, exactly, again
in lists: a row holds many phrases, so rows grow with blocks and bytes with the words.

In mining a phrase is a 48-bit hash: a collision adds up two counts and so only adds a candidate.
Bitmaps tell the blocks which phrases are frequent or candidates; their bits grow with the words
(``filter_bits``), or what they let through in error would grow with words times candidates. What
they do let through is counted as well, exactly, and falls by its count.

Phrases are scored by their weakest cut, and those that a longer phrase with as many
occurrences contains go.

Defined cases: a null or empty text has no words; a null language is ``und``; repeated rows and
null ids count as documents; a very long text is spread over several blocks, cut where
pieces end; an empty table gives an empty result; further columns
are ignored; ties in the ranking go by phrase, in the order of UTF-8 bytes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleswright import workspace
from saleswright.llm import bits
from saleswright.llm import text as T

#: Occurrences that make a phrase a candidate, most words in one, and phrases reported per language.
MIN_COUNT, LONGEST, REPORTED = 100, 5, 2000
SHARDS = 4
#: Words in a block, of one or of all languages that a task holds.
BLOCK_WORDS = 1 << 21
#: Bits of a filter of phrases, at least and at most (4 to 64 MB); between these, one for so many words.
BITS, MOST_BITS, WORDS_PER_BIT = 1 << 25, 1 << 29, 32
#: Bits of a phrase's hash, bytes of a block's count, and a shard's words per range of hashes.
HASH_BITS, COUNT_BYTES, RANGE_WORDS = 48, 4, 1 << 18
#: Phrases that a counting task holds, and a language's words per part of its phrases.
HELD, PART_WORDS = 1 << 17, 1 << 22
_MARKS = b".,;:!?\n\x0b\x0c\r"
_TO_BREAK = bytes.maketrans(_MARKS, b"." * len(_MARKS))
_BLOCK = "block bigint, shard int, lang string, n bigint, words binary, codes binary"
_LISTED = "part int, shard int, lang string, need bigint, hashes binary, counts binary"
_FOUND = "h bigint, upper bigint, shard int"
_COUNTED = "lang string, part int, phrases binary, counts binary"
_MIX, _MIX2, _UPPER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(19)


def pieces(text: str) -> list[bytes]:
    """The words of a text with A-Z lower-cased, ``b"."`` standing where a piece ends."""
    return text.encode().lower().translate(_TO_BREAK).replace(b".", b" . ").split()


class _Block(dict):
    """Words and their codes; code 0 ends a piece."""

    def __init__(self):
        super().__init__({b".": 0})
        self.codes, self.size = [np.zeros(1, np.uint32)], 0

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value

    def add(self, words: list[bytes]) -> None:
        self.codes += [np.fromiter(map(self.__getitem__, words), np.uint32, len(words)), np.zeros(1, np.uint32)]
        self.size += len(words)


def blocks(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = BLOCK_WORDS, shards: int = SHARDS) -> DataFrame:
    """All texts in blocks (``_BLOCK``), written once; ``n`` is the number of words."""
    schema = T.arrow_schema(_BLOCK)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        held: dict[str, _Block] = {}
        number = task << 32

        def done(lang: str) -> pa.RecordBatch:
            nonlocal number
            block = held.pop(lang)
            codes, number = np.concatenate(block.codes), number + 1
            row = [number, task % shards, lang, int((codes > 0).sum()), b"\n".join(list(block)[1:]), codes.tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

        for part in T.slices(batches, 64):
            for lang, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                words = pieces(text.as_py())
                # a long text is cut at the ends of pieces; only a piece that is itself too long goes into one block whole
                for some in _runs(words, size // 4):
                    held.setdefault(lang, _Block()).add(some)
                    if held[lang].size >= size:
                        yield done(lang)
                    while sum(b.size for b in held.values()) > size:
                        yield done(max(held, key=lambda x: held[x].size))
        for lang in list(held):
            yield done(lang)

    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), T.whole_text(text_col))
    return workspace.stage(T.map_batches(rows, _BLOCK, run), "blocks")


def _runs(words: list[bytes], size: int) -> Iterator[list[bytes]]:
    """The words in runs of about ``size`` that end where a piece ends."""
    start = 0
    while len(words) - start > size:
        try:
            end = words.index(b".", start + size) + 1
        except ValueError:
            break
        yield words[start:end]
        start = end
    yield words[start:]


class _Hashed:
    """A block's windows: ``hashes(k)`` and ``inside(k)``, which start inside one piece."""

    def __init__(self, lang: str, words: bytes, codes: bytes):
        seed = xxhash.xxh64_intdigest(lang)
        listed = words.split(b"\n") if words else []
        own = np.array([0, *[xxhash.xxh64_intdigest(w, seed) for w in listed]], np.uint64)
        self.words, self.codes = listed, np.frombuffer(codes, "<u4")
        self.single = own[self.codes]
        self.apart = np.concatenate([np.zeros(1, np.int32), np.cumsum(self.codes == 0, dtype=np.int32)])

    def starts(self, k: int) -> np.ndarray:
        """Where windows of ``k`` words start that hold no end of a piece."""
        n = max(len(self.codes) - k + 1, 0)
        return np.flatnonzero(self.apart[k : k + n] == self.apart[:n]).astype(np.int32)

    def hashes(self, k: int, at: np.ndarray) -> np.ndarray:
        out = self.single[at]
        out += np.uint64(k)
        for step in range(1, k):
            out ^= out >> np.uint64(31)
            out *= _MIX
            out += self.single[step:][at]
        out ^= out >> np.uint64(29)
        out *= _MIX2
        out ^= out >> np.uint64(32)
        out >>= np.uint64(64 - HASH_BITS)
        return out


def _packed(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of whole numbers, first bytes first, so that what they share lies together."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unpacked(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.reshape(-1).view("<u8")


def _emitted(k: int, shorter: bits.Bitmap | None):
    """Phrases of ``k`` words of a block that may be frequent in its shard, dealt by ranges of hashes: ``_LISTED``."""

    def work(batch: pa.RecordBatch) -> list:
        out: list[list] = [[], [], [], [], [], []]
        for shard, lang, need, ranges, words, codes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = _Hashed(lang, words, codes)
            at = own.starts(k)
            if shorter:
                before = own.starts(k - 1)
                at = _both(at, before[shorter.has(own.hashes(k - 1, before) ^ np.uint64(shard))], len(own.codes))
            found, n = np.unique(own.hashes(k, at), return_counts=True)
            cuts = np.searchsorted(found, np.array([(i << HASH_BITS) // ranges for i in range(ranges + 1)], np.uint64))
            for part, (start, end) in enumerate(pairwise(cuts.tolist())):
                if start < end:
                    row = part, shard, lang, need, _packed(found[start:end], HASH_BITS // 8), _packed(n[start:end], COUNT_BYTES)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
        return out

    return work


def _frequent(lists: pa.Table) -> pa.Table:
    """The phrases of a shard, a language and a range of hashes whose counts reach the need: ``(h, upper, shard)``."""
    hashes = np.concatenate([_unpacked(x, HASH_BITS // 8) for x in lists["hashes"].to_pylist()])
    counts = np.concatenate([_unpacked(x, COUNT_BYTES) for x in lists["counts"].to_pylist()])
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    found = hashes[first][np.add.reduceat(counts, first) >= np.uint64(lists["need"][0].as_py())]
    shard = np.full(len(found), lists["shard"][0].as_py(), np.int32)
    return pa.table({"h": found.view(np.int64), "upper": (found >> _UPPER).view(np.int64), "shard": shard})


def _both(at: np.ndarray, shorter: np.ndarray, size: int) -> np.ndarray:
    """Those of the starts ``at`` where both windows one word shorter are among the ``shorter`` ones."""
    there = np.zeros(size + 1, bool)
    there[shorter] = True
    return at[there[at] & there[at + 1]]


def filter_bits(words: int, least: int = BITS) -> int:
    """The bits of a filter for so many words: a power of two, as frequent phrases grow with the words."""
    return min(max(least, 1 << max(words // WORDS_PER_BIT, 1).bit_length()), max(least, MOST_BITS))


def mined(dealt: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, n_bits: int = BITS, range_words: int = RANGE_WORDS) -> list[DataFrame]:
    """Per length, ``_FOUND``: the hashes of the phrases that are frequent in their shard."""
    sizes = dealt.groupBy("shard", "lang").agg(F.sum("n").alias("local"))
    sizes = sizes.withColumn("all", F.sum("local").over(Window.partitionBy("lang")))
    # the least whole number not below the shard's share of the support
    need = F.ceil(F.lit(min_count).cast("decimal(20,0)") * F.col("local") / F.greatest("all", F.lit(1))).cast("bigint")
    ranges = F.expr(f"CAST(local DIV {range_words} + 1 AS INT)")
    held = dealt.join(workspace.stage(sizes.select("shard", "lang", need.alias("need"), ranges.alias("ranges")), "needs"), ["shard", "lang"])
    shorter, out = None, []
    for k in range(1, longest + 1):
        listed = T.map_rows(held.select("shard", "lang", "need", "ranges", "words", "codes"), _LISTED, _emitted(k, shorter), rows=1)
        found = workspace.stage(listed.groupBy("part", "shard", "lang").applyInArrow(_frequent, _FOUND), f"frequent{k}")
        out.append(found)
        if k < longest:
            # each shard has bits of its own: its number is mixed into the lowest bits of the hash
            shorter = bits.bitmap(found.select(F.col("h").bitwiseXOR(F.col("shard").cast("bigint")).alias("h")), "h", n_bits)
    return out


def _spelled(own: _Hashed, longest: int, low: bits.Bitmap, upper: bits.Bitmap) -> Iterator[tuple[list[bytes], list[int]]]:
    """Per length, a block's phrases that both bitmaps let through, by their words, and their counts.

    All parts of a frequent phrase are frequent, so a window is looked up only where both windows
    one word shorter came through.
    """
    spelled, at = [b"", *own.words], None
    for k in range(1, longest + 1):
        at = own.starts(k) if at is None else _both(own.starts(k), at, len(own.codes))
        hashes = own.hashes(k, at)
        hit = low.has(hashes) & upper.has(hashes >> _UPPER)
        at, hashes = at[hit], hashes[hit]
        # equal hashes first, then equal words: runs of equal windows
        order = np.argsort(hashes, kind="stable")
        by, hashes = at[order], hashes[order]
        new = np.ones(len(by), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        for step in range(k):
            new[1:] |= own.codes[by[1:] + step] != own.codes[by[:-1] + step]
        first = np.flatnonzero(new)
        counts = np.diff(np.append(first, len(by))).tolist()
        by = by[first]
        del hit, order, hashes, new, first
        columns = [own.codes[by + step].tolist() for step in range(k)]
        yield [b" ".join(map(spelled.__getitem__, row)) for row in zip(*columns, strict=True)], counts


def counted(dealt: DataFrame, parts: DataFrame, longest: int, low: bits.Bitmap, upper: bits.Bitmap, most: int = HELD) -> DataFrame:
    """``_COUNTED``: a task's counts of the candidates, a row per language and part of its phrases.

    ``parts`` has the number of parts of each ``lang``; a task holds ``most`` phrases and those of one block.
    """
    schema = T.arrow_schema(_COUNTED)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: defaultdict[tuple, defaultdict] = defaultdict(lambda: defaultdict(int))

        def done() -> Iterator[pa.RecordBatch]:
            for (lang, parts), own in held.items():
                dealt: list[list[bytes]] = [[] for _ in range(parts)]
                for phrase in own:
                    dealt[xxhash.xxh32_intdigest(phrase) * parts >> 32].append(phrase)
                for part, phrases in enumerate(map(sorted, dealt)):
                    if phrases:
                        n = np.fromiter(map(own.__getitem__, phrases), np.int64, len(phrases))
                        row = lang, part, b"\n".join(phrases), _packed(n, 8)
                        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)
            held.clear()

        for block in T.slices(batches, 1):
            lang, parts, words, codes = (c[0].as_py() for c in block.columns)
            own = held[lang, parts]
            for phrases, counts in _spelled(_Hashed(lang, words, codes), longest, low, upper):
                for phrase, n in zip(phrases, counts, strict=True):
                    own[phrase] += n
            if sum(map(len, held.values())) > most:
                yield from done()
        yield from done()

    return T.map_batches(dealt.join(parts, "lang").select("lang", "parts", "words", "codes"), _COUNTED, run)


def _exact(min_count: int):
    """The phrases of a language's part with ``min_count`` occurrences, counted by their words: ``(lang, size, phrase, a)``."""

    def work(lists: pa.Table) -> pa.Table:
        own: defaultdict[bytes, int] = defaultdict(int)
        for phrases, counts in zip(lists["phrases"], lists["counts"], strict=True):
            for phrase, n in zip(phrases.as_py().split(b"\n"), _unpacked(counts.as_py(), 8).tolist(), strict=True):
                own[phrase] += n
        found = {p: a for p, a in own.items() if a >= min_count}
        sizes = pa.array([p.count(b" ") + 1 for p in found], pa.int32())
        lang = pa.array([lists["lang"][0].as_py()] * len(found), pa.string())
        return pa.table({"lang": lang, "size": sizes, "phrase": pa.array(list(found), pa.binary()).cast(pa.string()), "a": pa.array(list(found.values()), pa.int64())})

    return work


def frequent_phrases(dealt: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, n_bits: int = BITS) -> DataFrame:
    """``(lang, size, phrase, a)``: all phrases of up to ``longest`` words with ``min_count`` occurrences, written once."""
    n_bits = filter_bits(dealt.agg(F.sum("n")).first()[0] or 0, n_bits)
    candidates = reduce(DataFrame.union, mined(dealt, min_count, longest, n_bits))
    low, upper = (bits.bitmap(candidates, column, n_bits) for column in ("h", "upper"))
    parts = workspace.stage(dealt.groupBy("lang").agg(F.expr(f"CAST(sum(n) DIV {PART_WORDS} + 1 AS INT)").alias("parts")), "parts")
    lists = counted(dealt, parts, longest, low, upper)
    return workspace.stage(lists.groupBy("lang", "part").applyInArrow(_exact(min_count), "lang string, size int, phrase string, a bigint"), "phrases")


def _part(start: int | Column, length: Column) -> Column:
    return F.array_join(F.slice("words", start, length), " ")


def scored(found: DataFrame, totals: DataFrame) -> DataFrame:
    """``(lang, phrase, a, l, r, n, score)`` of each phrase of two words and more that no longer one stands for.

    Products are whole decimals of 38 digits.
    """
    phrases = found.where("size > 1").join(totals, "lang").withColumn("words", F.split("phrase", " "))
    k = F.col("k")
    cuts = phrases.select("lang", "phrase", "a", "n", "size", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "n", "k", _part(1, k).alias("first"), _part(k + 1, F.col("size") - k).alias("rest")
    )
    left = found.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = found.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    whole = {c: f"CAST({c} AS DECIMAL(19,0))" for c in "anlr"}
    score = F.expr(f"CAST({whole['a']} * {whole['n']} AS DECIMAL(34,0)) * 1000BD DIV ({whole['l']} * {whole['r']})")
    best = (
        cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
        .groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    )
    # a phrase inside a longer one is inside one that is one word longer and occurs at least as often
    inner = F.explode(F.array(_part(1, F.col("size") - 1), _part(2, F.col("size") - 1)))
    inside = phrases.where("size > 2").select("lang", "a", inner.alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    return best.join(inside, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a").select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, reported: int = REPORTED, size: int = BLOCK_WORDS, shards: int = SHARDS) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``reported`` best phrases of each language."""
    dealt = blocks(docs, text_col, lang_col, size, shards)
    totals = workspace.stage(dealt.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    found = scored(frequent_phrases(dealt, min_count), totals)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= reported)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
