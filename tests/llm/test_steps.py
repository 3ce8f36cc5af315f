"""What the steps of the text operators move and leave behind."""

from __future__ import annotations

import random
import uuid

import numpy as np
import public_tokenizers
import pyarrow as pa

from saleswright import workspace
from saleswright.llm import bytebpe, suffixes


def test_only_ids_of_long_texts_travel(spark):
    docs = spark.createDataFrame([(1, "one two three " * 40), (2, "short")], "doc_id long, text string")
    found = bytebpe.encode_decode(docs, public_tokenizers.path(bytebpe.RANKS), public_tokenizers.PATTERN, chunk=64, overlap=24)
    assert found.count() == 2
    assert "raw#" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_written_steps_that_nothing_reads_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "work_dir", lambda _: f"{tmp_path}/{uuid.uuid4().hex}")
    draw = random.Random(3)
    text = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    passages = [text(420), text(230)]
    docs = spark.createDataFrame([(k, text(80) + passages[k % 2] + text(90)) for k in range(12)], "doc_id long, text string")
    assert all(r["n_removed"] >= 200 for r in suffixes.without_repeats(docs).collect())
    assert {p.name for p in tmp_path.glob("*/*")} == {"spans"}


def test_fingerprints_of_joined_entries_are_those_of_each():
    draw = np.random.default_rng(1)
    n = 40
    last = draw.integers(0, 60, n)
    a = last + draw.integers(0, 50, n)
    a[:5] = last[:5]
    lo = draw.integers(0, 1000, n)
    data = [draw.bytes(int(x) + suffixes.LENGTH) for x in last]
    a, hi = np.minimum(a, last + suffixes._WINDOW - 1), lo + last
    open_ = [list(range((x - y) // suffixes.BLOCK, x // suffixes.BLOCK + 1)) for x, y in zip(a.tolist(), last.tolist(), strict=True)]
    columns = {c: draw.integers(0, 1 << 60, n) for c in ("g", "c", "t1", "t2")} | {"a": a + lo, "lo": lo, "hi": hi, "bytes": data}
    whole = pa.RecordBatch.from_pydict(columns | {"blocks": open_})

    def rows(columns: list) -> list[tuple]:
        return list(zip(*(c.to_pylist() for c in columns), strict=True))

    for work in (suffixes._blocks, suffixes._strings):
        assert rows(work(whole)) == [r for k in range(n) for r in rows(work(whole.slice(k, 1)))]
    for row in rows(suffixes._strings(whole)):
        k = columns["g"].tolist().index(row[0])
        start = int(a[k] - row[4])
        one = suffixes.Hashed(data[k]).of(np.array([start]), np.array([start + suffixes.LENGTH]), 7).view(np.int64)
        assert row[5] == one[0]
    assert [len(c) for c in suffixes._blocks(whole.slice(0, 0))] == [0] * 10
