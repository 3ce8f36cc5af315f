"""Line dedup by lines or words: a long run of one or two lines counts too."""

from __future__ import annotations

import time

import brute

from saleswright.llm import lines

LONG = " ".join(f"w{k}" for k in range(51))
HALF = [" ".join(f"{x}{k}" for k in range(26)) for x in "ab"]
FIFTY = " ".join(f"f{k}" for k in range(50))
DOCS = [
    (1, f"head one\n{LONG}\ntail one"),
    (2, f"head two\n{LONG}\ntail two"),
    (3, "\n".join(["x", *HALF, "y"])),
    (4, "\n".join(["u", *HALF, "v"])),
    (5, "\n".join(["p", HALF[0], "q", HALF[1]])),
    (6, f"{FIFTY}\nr"),
    (7, f"{FIFTY}\ns"),
    (8, LONG),
    (9, None),
]


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_long_short_runs_go(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    got = texts(lines.deduplicated(docs))
    assert got[2] == "head two\ntail two" and got[4] == "u\nv" and got[8] == ""
    assert got == brute.without_line_runs(DOCS, lines.MIN_LINES, lines.MIN_WORDS)
    assert texts(lines.deduplicated(docs, min_words=None)) == dict(DOCS)


def test_given_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").orderBy("doc_id").collect()]
    got = texts(lines.deduplicated(docs))
    assert got == brute.without_line_runs(rows, lines.MIN_LINES, lines.MIN_WORDS)
    assert got != texts(lines.deduplicated(docs, min_words=None))


def many_lines(spark, n):
    """Two documents of ``n`` lines, the second with every other block of ten out of the first, blank lines between."""
    first = [f"line {k} of many" for k in range(n)]
    second = [x if k // 10 % 2 else f"{x} more" for k, x in enumerate(first)]
    rows = [(1, "\n".join(first)), (2, "\n\n".join(second))]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_time_is_linear_in_lines(spark):
    def run(n):
        rows, docs = many_lines(spark, n)
        began = time.monotonic()
        got = lines.deduplicated(docs, report="report").collect()
        took = time.monotonic() - began
        assert {r.doc_id: r.text for r in got} == brute.without_line_runs(rows, lines.MIN_LINES, lines.MIN_WORDS)
        sizes = {r.doc_id: tuple(r.report) for r in got}
        assert sizes == {1: (n, 0, 0, 0), 2: (n, n // 2, n // 20, 10)}
        return took

    run(300)
    few, many = run(300), run(24_000)
    assert many < few + 15
