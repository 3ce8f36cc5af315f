"""Secret scans (9): a trigram index decides which documents a rule has to be run on.

From each rule's regular expression the trigrams are derived that any match must contain, as
an AND of ORs of ANDs. The index holds, for each of these trigrams, the documents whose
lower-cased text has it. Intersecting the postings gives each rule's candidates, on which
alone the rule then runs; a rule without mandatory trigrams runs on every document.

Defined cases: a null or empty text has no secrets; documents with null ids are one entry of
the index and so are repeated ids: a candidate id brings all its rows, which are then
verified one by one; an empty table gives an empty result; other columns pass through
(``redacted``) or are ignored (``spans_table``). Spans of one kind never overlap; those of
different kinds may.
"""

from __future__ import annotations

import hashlib
import re
from functools import reduce
from re import _constants as C
from re import _parser as parser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright import workspace
from saleswright.llm import text as T

#: kind, pattern, least length of the match, group that needs ``least`` characters.
RULES = (
    ("assign", r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    ("access", r"AKIA[A-Z0-9]+", 20, 0),
    ("hex", r"[0-9a-f]{24,}", 24, 0),
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
)
BASE = ("assign", "access", "hex")
#: Most alternatives that are followed while deriving trigrams.
MOST = 64

Clause = list[frozenset]


def _trigrams(text: str) -> frozenset:
    return frozenset(text[k : k + 3] for k in range(len(text) - 2))


def _strings(items) -> set[str] | None:
    """All lower-cased strings that a parsed expression matches, if they are few; else None."""
    found = {""}
    for op, arg in items:
        if op is C.LITERAL:
            more = {chr(arg).lower()}
        elif op is C.IN and all(x[0] is C.LITERAL for x in arg):
            more = {chr(x[1]).lower() for x in arg}
        elif op is C.SUBPATTERN:
            more = _strings(arg[3])
        elif op is C.BRANCH:
            parts = [_strings(x) for x in arg[1]]
            more = None if None in parts else set().union(*parts)
        elif op is C.MAX_REPEAT and arg[1] == 1:
            inner = _strings(arg[2])
            more = inner if inner is None or arg[0] else inner | {""}
        else:
            more = None
        if more is None or len(found) * len(more) > MOST:
            return None
        found = {a + b for a in found for b in more}
    return found


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses that all hold in a text with a match; a clause holds if one of its trigram sets is there whole."""
    clauses, run = [], {""}

    def close() -> None:
        nonlocal run
        if all(len(x) >= 3 for x in run):
            clauses.append(sorted({_trigrams(x) for x in run}, key=sorted))
        run = {""}

    for item in parser.parse(pattern):
        more = _strings([item])
        if more is None:
            close()
        elif len(run) * len(more) > MOST:
            close()
            run = more
        else:
            run = {a + b for a in run for b in more}
    close()
    return clauses


QUERIES = {kind: trigram_query(pattern) for kind, pattern, _, _ in RULES}
#: Every trigram of a query has one bit.
BITS = {t: k for k, t in enumerate(sorted({t for q in QUERIES.values() for c in q for s in c for t in s}))}


def postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(trigram, doc_id)``, the index over all trigrams that any rule asks for, written once."""
    low = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.lower(F.col(text_col).cast("string")).alias("low"))
    there = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in BITS]))
    return workspace.stage(low.select(F.explode(there).alias("trigram"), "doc_id"), "postings")


def _holds(query: list[Clause], words: int) -> Column:
    def has(trigrams: frozenset) -> Column:
        masks = [sum(1 << (BITS[t] % 62) for t in trigrams if BITS[t] // 62 == w) for w in range(words)]
        return reduce(Column.__and__, [F.col(f"m{w}").bitwiseAND(F.lit(m)) == F.lit(m) for w, m in enumerate(masks) if m])

    return reduce(Column.__and__, [reduce(Column.__or__, map(has, clause)) for clause in query])


def candidates(index: DataFrame) -> DataFrame:
    """``(doc_id, kinds)``: the postings intersected as each rule's query asks."""
    words = len(BITS) // 62 + 1
    bit = F.create_map(*[F.lit(x) for t, k in BITS.items() for x in (t, k)])[F.col("trigram")]
    masks = [F.bit_or(F.when(bit >= 62 * w, F.when(bit < 62 * (w + 1), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit - 62 * w))).cast("bigint")).alias(f"m{w}") for w in range(words)]
    seen = index.groupBy("doc_id").agg(*masks).na.fill(0, [f"m{w}" for w in range(words)])
    kinds = F.array_compact(F.array(*[F.when(_holds(q, words), F.lit(kind)) for kind, q in QUERIES.items() if q]))
    return seen.select("doc_id", kinds.alias("kinds")).where(F.size("kinds") > 0)


_COMPILED = [(kind, re.compile(pattern), least, group) for kind, pattern, least, group in RULES]


def find(text: str, kinds: set[str] | None = None) -> list[tuple[int, int, int]]:
    """``(start, rule, end)`` in order, of the given kinds and those that have no trigrams."""
    spans = []
    for k, (kind, pattern, least, group) in enumerate(_COMPILED):
        if kinds is None or kind in kinds or not QUERIES[kind]:
            spans += [(m.start(), k, m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return sorted(spans)


def _spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{RULES[k][0]}:{start}:{end}" for start, k, end in spans)


def mask(text: str, spans: list[tuple[int, int, int]], by: str = "[SECRET]") -> str:
    """The text with every stretch of spans replaced."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], by]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _verified(batch: pa.RecordBatch) -> list:
    texts, kinds = (batch.column(batch.num_columns - k).to_pylist() for k in (2, 1))
    out: list[list] = [[], [], [], [], [], []]
    for text, wanted in zip(texts, kinds, strict=True):
        spans = find(text, set(wanted or ()))
        base = [x for x in spans if RULES[x[1]][0] in BASE]
        values = *(sum(RULES[x[1]][0] == kind for x in base) for kind in BASE), hashlib.sha256(_spelled(base).encode()).hexdigest(), _spelled(spans), mask(text, spans)
        for column, value in zip(out, values, strict=True):
            column.append(value)
    return [*batch.columns[:-2], *out]


_OUT = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, masked string"


def _scanned(docs: DataFrame, passed: list[Column], id_col: str, text_col: str) -> tuple[DataFrame, dict[str, str]]:
    found = candidates(postings(docs, id_col, text_col))
    out = docs.select(*passed)
    names = {n: T.free_name(out, n) for n in ("scan_id", "scan_text", "kinds", *(x.split()[0] for x in _OUT.split(", ")))}
    rows = docs.select(*passed, F.col(id_col).cast("bigint").alias(names["scan_id"]), T.whole_text(text_col).alias(names["scan_text"]))
    found = found.select(F.col("doc_id").alias("candidate_id"), F.col("kinds").alias(names["kinds"]))
    joined = rows.join(found, rows[names["scan_id"]].eqNullSafe(found["candidate_id"]), "left")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema]
    schema = ", ".join([*fields, *(f"{names[x.split()[0]]} {x.split()[1]}" for x in _OUT.split(", "))])
    return T.map_rows(joined.select(*out.columns, names["scan_text"], names["kinds"]), schema, _verified), names


def spans_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)``, one row per document."""
    found, _ = _scanned(docs, [F.col(id_col).cast("bigint").alias("doc_id")], id_col, text_col)
    return found.drop("masked")


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with all their columns and every secret masked; ``n_chars`` is set anew."""
    found, names = _scanned(docs, [F.col(f"`{c}`") for c in docs.columns], id_col, text_col)
    masked = F.col(names["masked"])
    return found.select(
        *[
            masked.alias(c) if c == text_col
            else F.length(masked).cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
            else F.col(f"`{c}`")
            for c in docs.columns
        ]
    )
