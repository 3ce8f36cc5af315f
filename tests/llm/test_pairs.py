"""The joins, collocations and alignments against plain versions."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from itertools import accumulate

import brute
import numpy as np
import pytest
import sentencepiece
from test_llm import ODD, by_id, given, none, odd  # noqa: F401
from tokenizers import Tokenizer

import __spark_entry__ as entry
from saleswright.llm import align, bits, collocations, jaccardjoin, neardup, tokens

A, B = map(tokens.vocabulary_path, (align.A_VOCABULARY, align.B_VOCABULARY))
EDGES = [
    "a  b", " lead", "tail  ", "\n\nfoo \n bar.\n\tx", "tab\there", "no\xa0break and\u3000wide", "x\u2581y", "\u2581", "don't 12345 'll",
    "<|endoftext|> </s> <s><unk>", "\x1c\x1f.\x1cx", "\r\nfoo();\r\nbar", "na\u00efve \U0001f600\U0001f468\u200d\U0001f469 caf\u00e9", "\u4e2d\u6587 \u0645\u0631",
    " ", "\n", "x", "\ufeffbom \u180ez \u200b", "..." * 60, "a" * 300, "a.b,c's; x\u00b2, 3. \u2460! e\u0301? it's,'re \u0130.", "{ }\r';\r", "e\u0301 \x00 nul",
]


def test_ngram_join(given, odd, none):  # noqa: F811
    docs, rows = given
    want = brute.components(rows, jaccardjoin.PERCENT)
    got = by_id(jaccardjoin.joined(docs))
    assert {d: (r["component_id"], r["n_shingles"]) for d, r in got.items()} == {d: (want[d], len(brute.shingles(t))) for d, t in rows}
    rows_ = jaccardjoin.joined(odd).collect()
    found = {r["doc_id"]: r for r in rows_}
    assert len(rows_) == len(ODD)
    assert [found[k]["component_id"] for k in (1, 2, 3, 4, 5, 6, 13)] == [1, 2, 3, 4, 1, 1, 13]
    assert found[None]["component_id"] is None and found[2]["n_shingles"] == 0
    assert jaccardjoin.joined(none).count() == 0


@pytest.mark.parametrize("length, edits, seed", [(10, 1, 1), (30, 2, 2), (130, 5, 3)])
def test_ngram_join_of_chains_and_crowds(spark, length, edits, seed):
    draw = random.Random(seed)
    rows = []
    for k in range(150):
        words = [f"w{(k % 3) * 1000 + i}" for i in range(draw.randint(length * 9 // 10, length))]
        for _ in range(draw.randint(0, edits)):
            words[draw.choice([draw.randrange(len(words)), -1, 0])] = f"x{draw.randint(0, 9)}"
        rows.append((k, " ".join(words)))
    got = by_id(jaccardjoin.joined(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    assert {d: r["component_id"] for d, r in got.items()} == brute.components(rows, jaccardjoin.PERCENT)


def allocated(keys, units, often, need, proper):
    """The keys a set spends its units on, chosen one by one by cost."""
    price = {u: sum(often[k] for k, x in zip(keys, units, strict=True) if x == u) for u in set(units) if u >= 0}
    for u in price:
        if u % 4 == 2:
            price[u] = max(price[u], price.get(u - 1, 0))
    best = sorted(price, key=lambda u: (price[u], u))[: max(need, 0)] if proper >= need else price
    return {k for k, u in zip(keys, units, strict=True) if u in best}


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 12, 20, 24, 25, 40, 90, 400])
def test_pigeonhole(size):
    """Any two sets at the least similarity share a key that the smaller one can afford, whatever the costs."""
    draw = np.random.default_rng(size)
    for _ in range(200):
        small = np.unique(draw.integers(0, 1 << 63, size, np.uint64) * np.uint64(2))
        n = len(small)
        # s loses x of its own and r has y more: 100 (n - x) >= 80 (n + y)
        x = int(draw.integers(0, n // 5 + 1))
        y = int(draw.integers(x, max(x, (100 * (n - x) - 80 * n) // 80) + 1))
        if 100 * (n - x) < 80 * (n + y):
            continue
        large = np.unique(np.concatenate([draw.permutation(small)[x:], draw.integers(0, 1 << 63, y, np.uint64) * np.uint64(2) + np.uint64(1)]))
        low, high = jaccardjoin.band_of(n)
        assert len(large) <= high or 100 * high >= 80 * len(large)
        keys, units, empty, proper = jaccardjoin.segment_keys(small, high)
        others = set(jaccardjoin.segment_keys(large, high)[0].tolist())
        mine, own = keys.tolist(), np.where(empty & (proper > n // 4), -1, units).tolist()
        cost = {k: int(draw.integers(1, 50)) for k in mine}
        assert others & allocated(mine, own, cost, n // 4 + 1, proper)


def brute_alignment(rows):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = {c: x for x, c in tokens._byte_letters().items()}
    docs, counts = [], Counter()
    for doc, text in rows:
        x, y = a.encode(" " + (text or ""), add_special_tokens=False), b.encode(text or "")
        raw_a = [bytes(letters.get(c, ord(c) & 255) for c in t) for t in x.tokens]
        raw_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in zip(y, map(b.id_to_piece, y), strict=True)]
        if not text or not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            docs.append((doc, [], [], [], ""))
            continue
        ea, eb = ([0, *accumulate(map(len, r))] for r in (raw_a, raw_b))
        common = sorted(set(ea) & set(eb))
        pairs = [(x.ids[i], y[j]) for i in range(len(raw_a)) for j in range(len(raw_b)) if max(ea[i], eb[j]) < min(ea[i + 1], eb[j + 1])]
        spelled = ";".join(
            ",".join(str(t) for t, e in zip(x.ids, ea[1:], strict=True) if p < e <= q) + "|" + ",".join(str(t) for t, e in zip(y, eb[1:], strict=True) if p < e <= q)
            for p, q in zip(common, common[1:], strict=False)
        )
        counts.update(pairs)
        docs.append((doc, x.ids, y, pairs, spelled))
    most: dict[int, int] = {}
    for (_, j), n in counts.items():
        most[j] = max(most.get(j, 0), n)
    for doc, x, y, pairs, spelled in docs:
        best = sum(counts[p] == most[p[1]] for p in pairs)
        digest = hashlib.sha256(spelled.encode()).hexdigest() if spelled else ""
        yield doc, len(x), len(y), spelled.count(";") + 1 if spelled else 0, len(pairs), best, sum(counts[p] for p in pairs), digest


@pytest.mark.parametrize("size", [align.SHARD_BYTES, 500])
def test_alignment(spark, given, odd, none, size):  # noqa: F811
    docs, rows = given
    short = [(d, t[:1500]) for d, t in rows[:60]]
    edges = [(k, t) for k, t in enumerate(EDGES)]
    key = lambda r: (r[0] is None, r)
    for table, texts in (
        (spark.createDataFrame(short, "doc_id long, text string").repartition(3), short),
        (odd.where("doc_id <> 12 OR doc_id IS NULL"), [(d, t) for d, t, _ in ODD if d != 12]),
        (spark.createDataFrame(edges, "doc_id long, text string").repartition(3), edges),
    ):
        got = [tuple(r) for r in align.aligned(table, A, B, size=size).collect()]
        assert sorted(got, key=key) == sorted(brute_alignment(texts), key=key)
    assert align.aligned(none, A, B).count() == 0


def test_alignment_remembers_so_many_characters(monkeypatch):
    """Units may be long: a text with a tab is one unit. Their number alone does not bound a worker's memory."""
    monkeypatch.setattr(align, "REMEMBERED_CHARS", 6000)
    own = align.Aligner(A, B)
    long = [" " + f"{k}\t" + "some words " * 200 for k in range(8)]
    for unit in long * 2:
        assert own.records([unit])[0] == own.records([unit])[0]
        assert sum(map(len, own.known)) <= align.REMEMBERED_CHARS + len(unit) and sum(map(len, own.old)) <= align.REMEMBERED_CHARS + len(unit)


def test_alignment_of_more_units_than_short_numbers(spark):
    """A shard may hold more than 65,536 units or pairs; its numbers are wider then."""
    words = [f"{k:x}q{k * 7919 % 65_521:x}" for k in range(70_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:9])), (3, "")]
    whole = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    wide = sorted(align.aligned(whole, A, B, size=1 << 30).collect())
    assert wide == sorted(align.aligned(whole, A, B, size=1).collect())
    assert wide[1].n_links > 9 and wide[0].count_sum > wide[1].count_sum


def test_alignment_of_a_very_long_text(spark):
    text = "Some words, repeated often. " * 40_000
    rows = [(1, text), (2, text[:28])]
    got = by_id(align.aligned(spark.createDataFrame(rows, "doc_id long, text string"), A, B))
    # six groups a sentence, and the space at the end
    assert [got[1][c] for c in ("n_groups", "n_links", "n_best")] == [240_001] * 3 and got[2]["n_links"] == 7


def test_alignment_groups(spark):
    found = by_id(align.groups(spark.createDataFrame([(1, "Hello there"), (2, None), (3, "x\u2581")], "doc_id long, text string"), A, B))
    spelled = ";".join(f"{','.join(map(str, g.a))}|{','.join(map(str, g.b))}" for g in found[1].groups)
    assert hashlib.sha256(spelled.encode()).hexdigest() == list(brute_alignment([(1, "Hello there")]))[0][-1]
    assert found[2].groups == [] == found[3].groups


def ranked(df) -> dict:
    out: dict[str, list] = {}
    for r in df.orderBy("lang", "rank").collect():
        out.setdefault(r["lang"], []).append((r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]))
        assert r["rank"] == len(out[r["lang"]])
    return out


@pytest.mark.parametrize("least, size, shards", [(4, collocations.BLOCK_WORDS, 4), (7, 300, 3), (2, 100, 1)])
def test_collocations(spark, given, none, least, size, shards):  # noqa: F811
    docs, _ = given
    rows = [(r.lang, r.text[:3000]) for r in docs.where("doc_id % 3 = 0").collect()]
    rows += [(None, "New York City, new york; NEW YORK!\x1c new york"), (None, None), ("und", "a a a a a a. a a"), ("xx", ""), ("xx", "\u0131\u00c9 .. ,")]
    df = spark.createDataFrame([(k, lang, text, 0, "p") for k, (lang, text) in enumerate(rows)], "doc_id int, lang string, text string, n int, phrase string")
    got = collocations.collocations(df.repartition(5), min_count=least, reported=1 << 30, size=size, shards=shards)
    assert ranked(got) == brute.collocations(rows, least)
    few = ranked(collocations.collocations(df, min_count=least, reported=5, size=size, shards=shards))
    assert few == {lang: found[:5] for lang, found in brute.collocations(rows, least).items()}
    assert collocations.collocations(none.selectExpr("*", "source AS lang")).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 9_000_000_000_000
    found = spark.createDataFrame([("en", 1, "x", big), ("en", 1, "y", big), ("en", 2, "x y", big - 1)], "lang string, size int, phrase string, a long")
    totals = spark.createDataFrame([("en", 90 * big)], "lang string, n long")
    assert collocations.scored(found, totals).first()["score"] == 1000 * (big - 1) * 90 * big // (big * big)


def test_bitmap(spark):
    keys = spark.range(2000).selectExpr("xxhash64(id) AS h")
    table = bits.bitmap(keys, "h", 1 << 12)
    there = np.array([r.h for r in keys.collect()], np.int64)
    assert table.has(there).all() and table.has(there.view(np.uint64)).all()
    assert not bits.bitmap(keys.limit(0), "h", 1 << 12).has(there).any()


def test_registered():
    assert {"op11_ngram_join", "op12_collocations", "op13_token_alignment"} <= entry.queries().keys()


@pytest.mark.parametrize("shingles", [1 << 20, 500, 1])
def test_chunks_by_shingles_lose_no_link(spark, monkeypatch, shingles):
    """Members of one bucket, long and short, against all pairs; however small the chunks are."""
    monkeypatch.setattr(neardup, "CHUNK_SHINGLES", shingles)
    draw = np.random.default_rng(7)
    sets = []
    for i in range(60):
        base = np.arange(1000) if i % 2 else np.arange(2000, 2040)
        sets.append(np.sort(np.concatenate([draw.permutation(base)[: len(base) * 17 // 20], 10_000 * (i + 1) + np.arange(len(base) // 20)])).astype(np.uint64))
    rows = [(0, 5, i, i * 10, len(x), 0, i) for i, x in enumerate(sets)]
    open_ = spark.createDataFrame(rows, "band int, key bigint, doc_id bigint, set_id bigint, n bigint, own bigint, component bigint")
    full = spark.createDataFrame([(i, i * 10, bytearray(x.tobytes())) for i, x in enumerate(sets)], "doc_id bigint, set_id bigint, shingles binary")
    want = set()
    for u in range(60):
        for v in range(u):
            both = len(np.intersect1d(sets[u], sets[v]))
            if 100 * both >= 75 * (len(sets[u]) + len(sets[v]) - both):
                want.add((v, u))
    found = [tuple(sorted(r)) for r in neardup.compared(open_, full).collect()]
    assert len(want) > 3 and len(found) == len(set(found)) and set(found) == want


def test_packed_lists():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 48, 500, np.uint64))
    assert (collocations._unpacked(collocations._packed(values, 6), 6) == values).all()
    assert not len(collocations._unpacked(collocations._packed(values[:0], 6), 6))


def test_filters_grow_with_the_words():
    assert collocations.filter_bits(0) == collocations.filter_bits(1 << 28) == collocations.BITS
    assert [collocations.filter_bits(1 << n) for n in (33, 60)] == [1 << 29, collocations.MOST_BITS]
    assert collocations.filter_bits(1 << 20, 1 << 12) == 1 << 16


@pytest.mark.parametrize("ranges, parts, held, n_bits", [(50, 40, 10, 1 << 25), (1 << 20, 1 << 22, 1 << 17, 1 << 6)])
def test_collocations_over_many_lists(spark, monkeypatch, ranges, parts, held, n_bits):
    """Many ranges, parts and flushes, or filters that let nearly all through, give the same phrases; rows are lists, no phrase each."""
    draw = random.Random(4)
    rows = [(draw.choice(["en", "de", None]), " ".join(f"{draw.choice('abcdefgh')}é{draw.choice('.   ')}" for _ in range(120))) for _ in range(40)]
    rows += [("en", "A b c d e f g"), ("xx", "once"), ("yy", None)]
    monkeypatch.setattr(collocations, "PART_WORDS", parts)
    dealt = collocations.blocks(spark.createDataFrame(rows, "lang string, text string").repartition(3), size=400)
    want = Counter()
    for lang, text in rows:
        for piece in (text or "").lower().split("."):
            words = piece.split()
            want.update((lang or "und", k, " ".join(words[i : i + k])) for k in range(1, 6) for i in range(len(words) - k + 1))
    lists = collocations.mined
    monkeypatch.setattr(collocations, "mined", lambda *a: lists(*a, range_words=ranges))
    monkeypatch.setattr(collocations, "filter_bits", lambda words, least: n_bits)
    counted, made = collocations.counted, []
    monkeypatch.setattr(collocations, "counted", lambda *a: made.append(counted(*a, most=held)) or made[0])
    got = {(r.lang, r["size"], r.phrase): r.a for r in collocations.frequent_phrases(dealt, 5).collect()}
    assert got == {key: a for key, a in want.items() if a >= 5} and len({k for _, k, _ in got}) > 2
    if held > 1000:  # all phrases of a task and a language are in one row
        assert made[0].count() <= dealt.count() < len(got)
