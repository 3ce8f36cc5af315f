"""The pipeline against plain versions of its stages."""

from __future__ import annotations

import brute
import numpy as np
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from saleswright.llm import lines, quality, secrets, tokens


def test_pipeline(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()]
    judged = [(d, quality.judge(t or "")) for d, t in rows]
    kept = [(d, j[9]) for d, j in judged if j[8]]
    shorter = brute.without_line_runs(kept, lines.MIN_LINES, lines.MIN_WORDS)
    groups = brute.components(list(shorter.items()))
    clean = {d: secrets.mask(t, secrets.find(t)) for d, t in shorter.items() if groups[d] == d}
    library = Tokenizer.from_file(tokens.vocabulary_path(tokens.VOCABULARY))
    want = {d: len(library.encode(t, add_special_tokens=False).ids) + 1 for d, t in clean.items()}

    pieces = corpus_pipeline.run(spark, folder).collect()
    assert {p["doc_id"]: p["doc_tokens"] for p in pieces} == want
    assert sum(p["length"] for p in pieces) == sum(want.values())
    ends = np.array(sorted((p["sequence_id"] * 4096 + p["offset"], p["length"]) for p in pieces))
    assert ends[0, 0] == 0 and (ends[:-1].sum(axis=1) == ends[1:, 0]).all()


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns


def test_registered():
    names = [f"op{n}_" for n in range(1, 11)]
    assert all(any(q.startswith(n) for q in entry.queries()) for n in names) and "pipeline" in entry.queries()
