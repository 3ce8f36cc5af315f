"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def components(docs: list[tuple[int, str | None]], percent: int = 75) -> dict[int, int]:
    sets = {d: shingles(t) for d, t in docs}
    parent = {d: d for d in sets}

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y) and root(a) != root(b):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {d: root(d) for d in ids}


def without_line_runs(docs: list[tuple[int, str | None]], min_lines: int, min_words: int) -> dict[int, str | None]:
    seen, out = set(), {}
    for doc, text in docs:
        lines = (text or "").split("\n")
        worded = [k for k, x in enumerate(lines) if x.strip(" \t\r\x0b\x0c")]
        gone = set()
        for size in range(1, min_lines + 1):
            for p in range(len(worded) - size + 1):
                run = tuple(lines[k] for k in worded[p : p + size])
                if size == min_lines or sum(len(WORD.findall(x)) for x in run) > min_words:
                    if run in seen:
                        gone.update(worded[p : p + size])
                    seen.add(run)
        out[doc] = text if not gone else "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def repeated_bytes(texts: list[str | None], length: int = 200) -> list[list[bool]]:
    data = [(t or "").encode() for t in texts]
    counts = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        marks = [False] * len(b)
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                marks[i : i + length] = [True] * length
        out.append(marks)
    return out


def repeated_words(text: str) -> int:
    words = WORD.findall(text)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts, marks = Counter(runs), set()
    for i, run in enumerate(runs):
        if counts[run] > 1:
            marks.update(range(i, i + 5))
    return len(marks)


def secrets(text: str | None) -> list[tuple[int, int, int]]:
    text, found = text or "", []
    kinds = (
        (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
         r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        (r"AKIA[A-Z0-9]+", 0, 20),
        (r"[0-9a-f]+", 0, 24),
    )
    for kind, (pattern, group, least) in enumerate(kinds):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return sorted(found)


def collocations(docs: list[tuple[str | None, str | None]], least: int) -> dict[str, list[tuple]]:
    """Per language, ``(phrase, a, l, r, n, score)`` in order; ``docs`` are ``(lang, text)``."""
    counts: dict[str, Counter] = {}
    totals: Counter = Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = {}
    for lang, own in counts.items():
        found = {w: a for w, a in own.items() if len(w) > 1 and a >= least}
        rows = []
        for w, a in found.items():
            score, _, l, r = min((1000 * a * totals[lang] // (own[w[:k]] * own[w[k:]]), k, own[w[:k]], own[w[k:]]) for k in range(1, len(w)))
            inside = (b for x, b in found.items() if len(x) > len(w) and any(x[i : i + len(w)] == w for i in range(len(x))))
            if not any(100 * b >= 100 * a for b in inside):
                rows.append((" ".join(w), a, l, r, totals[lang], score))
        if rows:
            out[lang] = sorted(rows, key=lambda x: (-x[5], -x[1], x[0].encode()))
    return out
