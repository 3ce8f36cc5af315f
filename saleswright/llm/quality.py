"""Quality rules (7): lines first, then documents.

Every line is judged by itself: by its punctuation, as navigation, as boilerplate. Lines that
fail are taken out; a document that loses more than ``MAX_LOST`` of its word characters this
way, or fails the base rules, is rejected. All in one pass over whole texts, without a shuffle.

Defined cases: a null or empty text has no words and fails the base rules; a line without
words is neither judged nor lost; repeated rows are judged one by one; a null id stays null;
an empty table gives an empty result; further columns pass through (``clean_lines``) or are
ignored (``quality_table``), and names that clash are evaded with an underscore.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswright.llm import text as T

MIN_WORDS = 10
#: Percent of words in repeated five-word windows above which a text is rejected.
MAX_REPEATED = 20
#: Share of word characters that a document may lose with its failed lines.
MAX_LOST = 0.3
#: Share of a line's characters that may be symbols, and of its words that may shout.
MAX_SYMBOLS, MAX_SHOUTED = 0.1, 0.5
#: Separators from which a line counts as navigation, and the most words that lie between two on average.
MIN_SEPARATORS, ITEM_WORDS = 3, 4
#: A line of so few words needs a sign at its end, unless it is a document's first (a heading).
SHORT_LINE = 3

SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
_ENDS = tuple(".!?:;\"'”’»…。！？)]}")
_SEPARATOR = re.compile("[|»›·•]")
BOILERPLATE = (
    r"all rights reserved|terms of (use|service)|privacy policy|cookie policy|accept (all )?cookies|enable javascript"
    r"|javascript is (disabled|required)|subscribe to our newsletter|click here to|lorem ipsum|skip to (main )?content"
)
_BOILERPLATE = re.compile(BOILERPLATE, re.IGNORECASE)
_FIELDS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "n_failed_lines bigint, lost_chars bigint, base_failed boolean, kept boolean, clean_text string"
)


def line_fails(line: str, first: bool) -> bool:
    """The rules of one line: navigation, boilerplate, punctuation."""
    words = line.encode().split()
    if not words:
        return False
    separators = len(_SEPARATOR.findall(line)) + words.count(b"/") + words.count(b">")
    if separators >= MIN_SEPARATORS and len(words) <= (ITEM_WORDS + 1) * (separators + 1):
        return True
    if _BOILERPLATE.search(line):
        return True
    shouted = sum(w.endswith((b"!!", b"??", b"!!.", b"??.")) for w in words)
    if len(words) >= 2 and shouted > MAX_SHOUTED * len(words):
        return True
    if sum(map(line.count, SYMBOLS)) > MAX_SYMBOLS * len(line):
        return True
    return not first and len(words) <= SHORT_LINE and not line.rstrip(_SPACES).endswith(_ENDS)


def judge(text: str) -> tuple:
    """All fields of ``_FIELDS`` for one text."""
    data = text.encode()
    hashes = T.word_hashes(data)
    n, n_repeat = len(hashes), 0
    if n >= T.WIDTH:
        _, which, counts = np.unique(T.windows(hashes, T.WIDTH), return_inverse=True, return_counts=True)
        if len(counts) < len(which):
            edge = np.zeros(n + 1, np.int64)
            starts = np.flatnonzero(counts[which] > 1)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + T.WIDTH, -1)
            n_repeat = int((np.cumsum(edge) > 0).sum())
    word_chars = len(text) - sum(map(text.count, _SPACES))
    lines = text.split("\n")
    seen = Counter(x for x in lines if x.strip(_SPACES))
    kept, lost, failed, first = [], 0, 0, True
    for line in lines:
        if line_fails(line, first):
            failed += 1
            lost += len(line) - sum(map(line.count, _SPACES))
        else:
            kept.append(line)
        first = first and line not in seen
    base = n < MIN_WORDS or 100 * n_repeat > MAX_REPEATED * n
    stays = not base and lost <= MAX_LOST * word_chars
    duplicates = sum(seen.values()) - len(seen)
    symbols = sum(map(text.count, SYMBOLS))
    return n, word_chars, symbols, duplicates, n_repeat, failed, lost, base, stays, "\n".join(kept)


def _judged(batch: pa.RecordBatch) -> list:
    texts = batch.column(batch.num_columns - 1).to_pylist()
    rows = list(zip(*map(judge, texts), strict=True)) or [[] for _ in _FIELDS.split(", ")]
    return [*batch.columns[:-1], *map(list, rows)]


def quality_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and every figure, verdict and cleaned text, one row per document."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), T.whole_text(text_col))
    return T.map_rows(rows, f"doc_id bigint, {_FIELDS}", _judged)


def clean_lines(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The kept documents with all their columns; failed lines are out of the text.

    An ``n_chars`` column, if there is one, is set to the new length.
    """
    whole = T.free_name(docs, "whole_text")
    names = {f.split()[0]: T.free_name(docs, f.split()[0]) for f in _FIELDS.split(", ")}
    passed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    fields = ", ".join(f"{names[f.split()[0]]} {f.split()[1]}" for f in _FIELDS.split(", "))
    judged = T.map_rows(docs.withColumn(whole, T.whole_text(text_col)), f"{passed}, {fields}", _judged)
    clean = F.col(names["clean_text"])
    return judged.where(names["kept"]).select(
        *[
            clean.alias(c) if c == text_col
            else F.length(clean).cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
            else F.col(f"`{c}`")
            for c in docs.columns
        ]
    )
