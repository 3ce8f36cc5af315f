"""Each operator against a plain version, on given documents and on odd ones."""

from __future__ import annotations

import hashlib
import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from saleswright.llm import bytebpe, fingerprints, lines, neardup, packing, quality, queries, repair, secrets, suffixes, tokens, urls

VOCABULARY = tokens.vocabulary_path(tokens.VOCABULARY)
PROSE = " ".join(f"word{k % 97} and{k % 31}" for k in range(400))
BLOCK = "\n".join(f"line number {k} of a shared block" for k in range(6))
ODD = [
    (1, PROSE, "a"),
    (2, None, "a"),
    (3, "", None),
    (4, " \n\t\n", "b"),
    (5, PROSE, "b"),
    (6, PROSE.replace("word5 ", "WORD5 ") + " tail", None),
    (7, f"Head.\n{BLOCK}\nTail.", "a"),
    (8, f"Other head.\n\n{BLOCK}", "a"),
    (9, "ab" * 500, "c"),
    (10, "é" * 130 + "x" + PROSE[:260], "c"),
    (11, 'password = "abcDEF123" token: short AKIA' + "A1" * 10 + " " + "0af" * 12, "c"),
    (12, "long " * 9_000 + "x" * 3_000, "c"),
    (None, "a row without an id " * 5, "a"),
    (13, "###|||***", "a"),
    (13, "###|||***", "a"),
]
#: More columns, with the names that operators use themselves.
CLASHING = "doc_id bigint, text string, source string, n_chars bigint, row string, removed int, kept string, kinds int, scan_id int, n_tokens int, spans int"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(d, t, s, len(t) if t is not None else None, "r", 0, "k", 0, 0, 0, 0) for d, t, s in ODD]
    return spark.createDataFrame(rows, CLASHING).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], CLASHING)


@pytest.fixture(scope="module")
def given(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").orderBy("doc_id").collect()]


def by_id(df) -> dict:
    return {r["doc_id"]: r for r in df.collect()}


def test_line_dedup(given, odd, none):
    docs, rows = given
    want = brute.without_line_runs(rows, lines.MIN_LINES, lines.MIN_WORDS)
    assert {d: r["text"] for d, r in by_id(lines.deduplicated(docs)).items()} == want
    got = lines.deduplicated(odd)
    assert got.columns == odd.columns and got.count() == len(ODD)
    found = by_id(got)
    assert found[2]["text"] is None and found[7]["text"] == ODD[6][1] and found[8]["text"] == "Other head.\n"
    assert found[8]["n_chars"] == len("Other head.\n")
    assert lines.deduplicated(none).count() == 0


def test_line_dedup_of_repeated_rows(spark):
    df = spark.createDataFrame([(1, BLOCK), (1, BLOCK), (None, BLOCK)], "doc_id long, text string")
    assert sorted(len(r["text"]) for r in lines.deduplicated(df).collect()) == [0, 0, len(BLOCK)]


def test_url_filter(spark):
    pages = [
        (1, "http://A.Net/x"), (2, "https://www.example.net/en/9?q=1"), (3, "ftp://sub.example.com/de/"), (4, "http://x.org/fr/a#b"),
        (5, None), (6, "no scheme"), (7, "http://listed.com/page/?a"), (8, "http://www.listed.com/page"), (9, "http://anet/x"),
        (9, "http://anet/x"), (10, "http://a.net"),
    ]
    df = spark.createDataFrame([(a, b, 0, "r") for a, b in pages], "page_id long, url string, host int, rule string")
    listed = spark.createDataFrame([("listed.com/page",), (None,), ("listed.com/page",)], "key string")
    got = [tuple(r)[:5] for r in urls.url_filter(df, urls.rule_table(spark), listed).orderBy("page_id").collect()]
    assert got == [
        (1, "a.net", "/x", "net/", "block"), (2, "www.example.net", "/en/9", "example.net/en/", "allow"),
        (3, "sub.example.com", "/de/", "example.com/de/", "block"), (4, "x.org", "/fr/a", "org/fr/", "allow"),
        (5, "", "", None, "allow"), (6, "", "", None, "allow"), (7, "listed.com", "/page/", None, "block"),
        (8, "www.listed.com", "/page", None, "block"), (9, "anet", "/x", None, "allow"), (9, "anet", "/x", None, "allow"),
        (10, "a.net", "", None, "allow"),
    ]
    assert urls.url_filter(df.limit(0), urls.rule_table(spark), listed).count() == 0
    assert urls.url_filter(df, urls.rule_table(spark), listed.limit(0)).where("listed").count() == 0


def test_bloom_filter_loses_nothing_and_passes_little(spark):
    keys = spark.range(20_000).selectExpr("concat('host', id, '.com/', id) AS key")
    bloom = urls.bloom_filter(keys.where("substring(key, -1) = '3'"))
    hits = {r.key for r in urls.possible(keys, bloom).collect()}
    there = {r.key for r in keys.where("substring(key, -1) = '3'").collect()}
    assert there <= hits and len(hits) < len(there) * 1.5


def ids_of(text):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, tokens.END], "<u4")


@pytest.mark.parametrize(
    "text",
    ["", "  a\t b", "<|endoftext|> x<|startoftext|>", "don't  won'T é é ÀΣ ΑΣ ς x\x1cy", "́ a 1234's", "Foo!! bar.. İx. ªº. ÿ! µ. \x85 z", PROSE],
)
def test_tokens_are_those_of_the_library(text):
    assert tokens.encode_texts([text.encode()], VOCABULARY)[0] == ids_of(text).tobytes()
    assert tokens.widen(tokens.narrow(ids_of(text).tobytes())) == ids_of(text).tobytes()
    assert tokens.widen(tokens.narrow(np.array([70_000], "<u4").tobytes())) == np.array([70_000], "<u4").tobytes()


def check_packed(pieces, texts):
    at, cover = 0, {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["sequence_id"] * packing.WINDOW + p["offset"] == at and p["length"] > 0
        at += p["length"]
        cover.setdefault(p["doc_id"], []).append(p)
    for doc, text in texts:
        ids, own = ids_of(text), sorted(cover[doc], key=lambda p: p["start"])
        copies = sum(p["length"] for p in own) // len(ids)
        assert copies * len(ids) == sum(p["length"] for p in own)
        for p in own:
            assert p["doc_tokens"] == len(ids) and p["ids_crc32"] == zlib.crc32(ids[p["start"] :][: p["length"]].tobytes())
        if copies == 1:
            assert all(p["start"] + p["length"] == q["start"] for p, q in zip(own, own[1:], strict=False)) and own[0]["start"] == 0


def test_packing(given, odd, none):
    docs, rows = given
    check_packed(packing.pack(docs, VOCABULARY).collect(), rows)
    check_packed(packing.pack(odd, VOCABULARY, {"a": 2.0, "c": 1.0}).collect(), [(d, t) for d, t, _ in ODD])
    assert packing.pack(none, VOCABULARY).count() == 0


def drawn_queues(spark, seed=3):
    draw = random.Random(seed)
    docs = [(k, k, draw.choice("aaabc"), k, draw.randint(1, 900)) for k in range(300)]
    return docs, spark.createDataFrame(docs, "row long, doc_id long, source string, tie long, n_tokens long")


@pytest.mark.parametrize(
    "weights, shares, last",
    [
        (None, None, ""),
        ({"a": 0.5, "b": 0.25, "c": 0.25}, {"a": 0.5, "b": 0.25, "c": 0.25}, ""),
        ({"a": 0.2}, {"a": 0.2, "b": 0.8, "c": 0.8}, ""),
        ({"a": 3, "b": 1}, {"a": 0.75, "b": 0.25}, "c"),
        ({"a": 0, "b": 0.5}, {"b": 0.5, "c": 0.5}, "a"),
        ({"a": 0, "b": 0, "c": 0}, {}, "abc"),
        ({"b": 0.5, "absent": 0.1}, {"b": 0.5, "a": 0.4, "c": 0.4}, ""),
    ],
)
def test_packing_serves_like_round_robin(spark, weights, shares, last):
    """``shares`` of sources without a weight are what they split by their size; the ``last`` are served after all others."""
    docs, df = drawn_queues(spark)
    got = sorted((p["sequence_id"], p["offset"], p["row"], p["start"], p["length"]) for p in packing.schedule(df, weights).collect())
    order = {r.row: r.h for r in df.selectExpr("row", "xxhash64(doc_id, tie) AS h").collect()}
    queues, total = {}, sum(d[4] for d in docs)
    for row, _, source, _, n in sorted(docs, key=lambda d: (order[d[0]] & (1 << 64) - 1)):
        queues.setdefault(source, []).extend((row, s, min(packing.PIECE, n - s)) for s in range(0, n, packing.PIECE))
    size = {s: sum(x[2] for x in q) / total for s, q in queues.items()}
    free = sum(size[s] for s in size if s not in (weights or {}))
    share = {s: shares[s] if s in (weights or {}) else shares[s] * size[s] / free for s in shares} if shares else size
    served = []
    for turn in (set(queues) - set(last), set(last)):
        rate, credit = {s: share[s] if s not in last else size[s] for s in turn}, dict.fromkeys(turn, 0.0)
        while any(queues[s] for s in turn):
            for s in sorted(turn):
                credit[s] += rate[s] * packing.WINDOW
                while queues[s] and queues[s][0][2] <= credit[s] + 1e-6:
                    served.append(queues[s].pop(0))
                    credit[s] -= served[-1][2]
    flat = [(row, s + k) for row, s, n in served for k in range(n)]
    assert [(row, s + k) for _, _, row, s, n in got for k in range(n)] == flat


def test_windows_hold_their_targets(spark):
    docs, df = drawn_queues(spark, 8)
    source, tokens_of = {d[0]: d[2] for d in docs}, dict.fromkeys("abc", 0)
    for d in docs:
        tokens_of[d[2]] += d[4]
    for weights in ({"a": 0.4, "b": 0.35, "c": 0.25}, {"a": 0.3}):
        free = sum(n for s, n in tokens_of.items() if s not in weights)
        target = {s: weights[s] if s in weights else (1 - sum(weights.values())) * tokens_of[s] / free for s in "abc"}
        full = int(min(tokens_of[s] / target[s] for s in "abc")) // packing.WINDOW
        held = [dict.fromkeys("abc", 0) for _ in range(full)]
        for p in packing.schedule(df, weights).where(f"sequence_id < {full}").collect():
            held[p["sequence_id"]][source[p["row"]]] += p["length"]
        assert full > 5 and all(abs(w[s] - target[s] * packing.WINDOW) <= 3 * packing.PIECE for w in held[:-1] for s in "abc")
        # deficits are carried: they don't add up over the windows
        assert all(abs(sum(w[s] for w in held) - full * target[s] * packing.WINDOW) <= 3 * packing.PIECE for s in "abc")


@pytest.mark.parametrize("weight", [-1.0, float("inf"), float("nan")])
def test_weights_that_are_no_shares(spark, weight):
    with pytest.raises(ValueError, match="weights"):
        packing.schedule(drawn_queues(spark)[1], {"a": weight})


def test_fingerprints(given, odd, none):
    docs, rows = given
    found = by_id(fingerprints.edited(docs.repartition(5)))
    errors = []
    for k, (doc, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)]
        m, r = len(text) // 4, found[doc]
        changed = text[: len(text) - m] + after[1][:m]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["fingerprint"] == fingerprints.fingerprint(text).tobytes().hex()
        a, b, c = map(brute.shingles, (text, changed, after[1]))
        errors += [r["near_edited"] - len(a & b) / len(a | b), r["near_next"] - len(a & c) / len(a | c)]
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 0.35
    same = [r["fingerprint"] for r in fingerprints.edited(odd).collect() if r["doc_id"] in (1, 5, 2, 3)]
    assert sorted(map(same.count, same)) == [2, 2, 2, 2]
    assert fingerprints.edited(odd).count() == len(ODD) and fingerprints.edited(none).count() == 0
    alone = fingerprints.edited(odd.where("doc_id = 1")).first()
    assert alone["near_next"] == 1.0


def test_fingerprint_links(given):
    docs, rows = given
    want = brute.components(rows)
    for r in fingerprints.near_links(docs).collect():
        assert want[r.u] == want[r.v]


def test_suffix_dedup(given, odd, none):
    for docs, rows in (given, (odd, [(d, t) for d, t, _ in ODD])):
        marks = dict(zip([d for d, _ in rows], brute.repeated_bytes([t for _, t in rows]), strict=True))
        got = by_id(suffixes.without_repeats(docs))
        for doc, text in rows:
            data, m, r = (text or "").encode(), marks[doc], got[doc]
            assert (r["n_bytes"], r["n_removed"]) == (len(data), sum(m)), doc
            assert r["n_spans"] == sum(x and not y for x, y in zip(m, [False, *m], strict=False))
            assert r["kept_sha256"] == hashlib.sha256(bytes(b for b, x in zip(data, m, strict=True) if not x)).hexdigest()
    assert suffixes.without_repeats(none).count() == 0


def test_suffix_dedup_at_the_edges_of_passages(spark):
    draw = random.Random(11)
    text = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    passages = [text(n) for n in (199, 200, 201, 250, 420)]
    rows = [(k, text(draw.randint(0, 90)) + passages[k % 5] + text(draw.randint(0, 90)) + passages[(k * 3) % 5]) for k in range(24)]
    rows += [(50, passages[4][3:330]), (51, passages[4][:260] + "#" + passages[4][200:])]
    got = by_id(suffixes.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), batches=3))
    for (doc, _), m in zip(rows, brute.repeated_bytes([t for _, t in rows]), strict=True):
        assert got[doc]["n_removed"] == sum(m), doc


@pytest.mark.parametrize("chunk, overlap", [(bytebpe.CHUNK, bytebpe.OVERLAP), (64, 24), (40, 40)])
def test_byte_bpe(given, odd, none, chunk, overlap):
    path = public_tokenizers.path(bytebpe.RANKS)
    import base64

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs, rows = given if chunk > 64 else (odd, [(d, t) for d, t, _ in ODD])
    got = by_id(bytebpe.encode_decode(docs, path, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap))
    for doc, text in rows:
        ids, r = library.encode_ordinary(text or ""), got[doc]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert bytebpe.encode_decode(none, path, public_tokenizers.PATTERN).count() == 0


def test_quality_rules(given, odd, none):
    docs, rows = given
    for table, texts in ((docs, rows), (odd, [(d, t) for d, t, _ in ODD])):
        got = by_id(quality.quality_table(table))
        for doc, text in texts:
            text, r = text or "", got[doc]
            words, parts = brute.WORD.findall(text), [x for x in text.split("\n") if brute.WORD.search(x)]
            base = len(words) < 10 or 100 * brute.repeated_words(text) > 20 * len(words)
            want = len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(parts) - len(set(parts)), brute.repeated_words(text), base
            assert want == tuple(r[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")), doc
            assert not (base and r["kept"])
    kept = quality.clean_lines(odd)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {1, 5, 6, 10}
    assert quality.clean_lines(none).count() == 0 == quality.quality_table(none).count()


@pytest.mark.parametrize(
    "line, fails",
    [
        ("A clean line of prose.", False), ("No mark at its end but long enough", False), ("Too short", True), ("Fine.", False), ("", False),
        ("Home | News | Sport | Contact", True), ("All rights reserved by the publisher.", True), ("BUY!! NOW!! CHEAP!! ONLY today.", True),
        ("word### other$$$ third***", True),
    ],
)
def test_line_rules(line, fails):
    assert quality.line_fails(line, False) is fails


def test_near_dedup(given, odd, none):
    docs, rows = given
    want = brute.components(rows)
    got = by_id(neardup.near_duplicates(docs))
    assert {d: (r["component_id"], r["n_shingles"], r["kept"]) for d, r in got.items()} == {
        d: (want[d], len(brute.shingles(t)), want[d] == d) for d, t in rows
    }
    found = by_id(neardup.near_duplicates(odd))
    assert [found[k]["component_id"] for k in (1, 2, 3, 4, 5, 6)] == [1, 2, 3, 4, 1, 1]
    assert found[None]["component_id"] is None and found[None]["kept"] and found[2]["n_shingles"] == 0
    stay = neardup.deduplicated(odd)
    assert stay.columns == odd.columns and stay.count() == len(ODD) - 3  # 5, 6, 8
    assert neardup.near_duplicates(none).count() == 0


def test_near_dedup_of_chains_and_crowds(spark):
    draw = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(90):
        words = list(base)
        for _ in range(draw.randint(0, 5)):
            words[draw.randrange(len(words))] = f"x{draw.randint(0, 40)}"
        rows.append((k, " ".join(words)))
    got = by_id(neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {d: r["component_id"] for d, r in got.items()} == brute.components(rows)


def test_secret_scan(given, odd, none):
    docs, rows = given
    for table, texts in ((docs, rows), (odd, [(d, t) for d, t, _ in ODD])):
        got = by_id(secrets.spans_table(table))
        for doc, text in texts:
            spans, r = brute.secrets(text), got[doc]
            spelled = ",".join(f"{secrets.BASE[k]}:{a}:{b}" for a, k, b in spans)
            assert tuple(r[f"n_{x}"] for x in secrets.BASE) == tuple(sum(s[1] == k for s in spans) for k in range(3))
            assert r["base_sha256"] == hashlib.sha256(spelled.encode()).hexdigest()
            assert set(spelled.split(",")) <= set(r["spans"].split(",")) or not spelled
    clean = secrets.redacted(odd)
    assert clean.columns == odd.columns and clean.count() == len(ODD)
    assert by_id(clean)[11]["text"].startswith("[SECRET]") and "0af0af" not in by_id(clean)[11]["text"]
    assert secrets.spans_table(none).count() == 0


@pytest.mark.parametrize("kind, pattern, least, group", secrets.RULES)
def test_trigram_queries_hold_for_matches(kind, pattern, least, group):
    samples = ["PassWord: hunter22", "api_key='abcdef'", "APIKEY=abcdef", "AKIA" + "B" * 16, "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a" * 36,
               "xoxb-1234567890ab", "eyJabcdefgh1.eyJabcdefgh2.abcdefgh3"]
    import re

    for text in filter(re.compile(pattern).search, samples):
        low = text.lower()
        assert all(any(all(t in low for t in s) for s in clause) for clause in secrets.QUERIES[kind])
    assert bool(secrets.QUERIES[kind]) == (kind != "hex")


def test_repair_output(given, odd, none):
    docs, rows = given
    texts = [(d, t) for d, t in sorted(((d, t) for d, t, _ in ODD), key=lambda x: (x[0] is not None, x[0] or 0))]
    for table, wanted in ((docs, rows), (odd, texts)):
        files = repair.write_shards(table, VOCABULARY)
        got, at = [tuple(r) for r in repair.read_documents(files).orderBy("start").collect()], 0
        for (doc, text), r in zip(wanted, got, strict=True):
            ids = ids_of(text)
            assert r == (doc, at, len(ids), zlib.crc32(ids.tobytes()))
            at += len(ids)
    shard = repair.Shard(files.orderBy("part", "shard").first()["payload"])
    whole = shard.documents()
    assert all((shard.document(k) == x).all() for k, x in enumerate(whole))
    assert repair.read_documents(repair.write_shards(none, VOCABULARY)).count() == 0


def test_repair_replaces_frequent_pairs():
    ids = np.array([1, 2, 3, 4] * 300 + [5, 5, 5, 5, 5] * 40 + [2], np.uint32)
    ends = np.array([700, 1200, len(ids)])
    symbols, rules, symbol_ends = repair.build(ids, ends)
    assert len(symbols) < len(ids) / 4 and len(rules) > 1 and len(symbol_ends) == 3
    assert (repair.expand(symbols, rules) == ids).all()
    assert (repair.expand(symbols[: symbol_ends[0]], rules) == ids[:700]).all()
    lengths, _ = repair.expansions(rules)
    assert lengths.min() >= 2


def test_queries_take_whole_tables(spark, folder):
    n = spark.read.parquet(f"{folder}/documents.parquet").count()
    for name in ("op7_quality_rules", "op9_secret_scan"):
        assert queries.QUERIES[name](spark, folder).count() == n
