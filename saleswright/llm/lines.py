"""Line dedup (1): a suffix array over line ids, by distributed prefix doubling.

Each document is a sequence of line ids; a suffix begins at each line. The first round ranks
single lines, each later one runs of up to twice as many: the rank of a run is that of its
pair of shorter ranks, all pairs being sorted over the cluster. Only suffixes whose prefix
occurs elsewhere go on to the next round, so unique lines, most of any corpus, leave after
the first. Suffixes of equal rank after ``MIN_LINES`` lines are the intervals of the suffix
array with a common prefix of at least that length: the repeated runs. A maximal repeated
run is the union of its overlapping stretches of that length, so the first copy of each
stretch (by doc_id, then place) stays and the lines of later ones go.

A run of fewer lines counts too when it has more than ``min_words`` words: the rounds before
the last find these runs anyway, and take the words of each along. ``min_words=None`` lets
lines alone decide.

DataFrame operations only. Ranks come from sorted distinct pairs, each with its count, so a
line that fills a third of the corpus is one row of every sort. A text is split and rebuilt
in time linear in its lines but for the sorting of their places.

Defined cases: lines without a word are no lines: they never take part and stay; a null text
has no lines and stays null; rows with null ids come first; repeated rows are later copies of
the first; an empty table gives an empty result; a very long text is one row, its lines are
rows of their own; all columns of the documents pass through, and added ones evade their names.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright import workspace
from saleswright.llm import text as T

#: Lines in the shortest run that counts as repeated.
MIN_LINES = 3
#: A shorter run counts as repeated when it has more words than this.
MIN_WORDS = 50
_BLANK = " \t\r\x0b\x0c"
_WORD = r"[^\x20\x09-\x0D]+"


def _worded(text: Column) -> Column:
    """The lines with a word, each with its place among all lines."""
    numbered = F.transform(F.split(text, "\n", -1), lambda x, k: F.struct(k.alias("at"), x.alias("line")))
    return F.filter(numbered, lambda x: F.btrim(x["line"], F.lit(_BLANK)) != "")


def suffixes(held: DataFrame, worded: bool = False) -> DataFrame:
    """``(row, doc_id, pos, h1, h2)``: one suffix per line of ``held`` (``row, doc_id, text``).

    If ``worded``, also ``words`` and ``last``: the words of the run so far and of its last line.
    """

    def one(x: Column) -> Column:
        fields = [F.xxhash64(x["line"]).alias("h1"), F.xxhash64(F.lit(1), x["line"]).alias("h2")]
        if worded:
            fields.append(F.regexp_count(x["line"], F.lit(_WORD)).cast("bigint").alias("words"))
        return F.struct(*fields)

    found = held.select("row", "doc_id", F.posexplode(F.transform(_worded(F.col("text")), one)).alias("pos", "h")).select("row", "doc_id", "pos", "h.*")
    return found.withColumn("last", F.col("words")) if worded else found


def _ranked(keyed: DataFrame, keys: list[str]) -> DataFrame:
    """Suffixes whose ``keys`` occur more than once, with an order-preserving ``rank`` of the keys and their ``first`` suffix."""
    place = F.struct("doc_id", "row", "pos")
    groups = keyed.groupBy(*keys).agg(F.count("*").alias("copies"), F.min(place).alias("first")).where("copies > 1")
    ranks = workspace.stage(groups.orderBy(*keys).withColumn("rank", F.monotonically_increasing_id()), "ranks")
    ranked = keyed.join(ranks.drop("copies"), keys)
    carried = [c for c in ("words", "last") if c in keyed.columns]
    return workspace.stage(ranked.select("row", "doc_id", "pos", "rank", "first", *carried), "suffixes")


def _rounds(held: DataFrame, min_lines: int, min_words: int | None) -> Iterator[tuple[int, DataFrame]]:
    """``(length, suffixes)`` of each round; with ``min_words`` no length up to ``min_lines`` is left out."""
    worded = min_words is not None
    now, length = _ranked(suffixes(held, worded), ["h1", "h2"]), 1
    yield length, now
    while length < min_lines:
        step = 1 if worded else min(length, min_lines - length)
        tail = [F.col("last").alias("last2")] if worded else []
        ahead = now.select("row", (F.col("pos") - step).alias("pos"), F.col("rank").alias("rank2"), *tail)
        totals = ["words"] if worded else []
        pairs = now.select("row", "doc_id", "pos", F.col("rank").alias("rank1"), *totals).join(ahead, ["row", "pos"])
        if worded:
            pairs = pairs.withColumn("words", F.col("words") + F.col("last2")).withColumnRenamed("last2", "last")
        now, length = _ranked(pairs, ["rank1", "rank2"]), length + step
        yield length, now


def repeated_runs(held: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """``(row, doc_id, pos, rank, first)``: suffixes whose first ``min_lines`` lines occur more than once.

    ``rank`` is the place of that prefix in the order of all repeated ones, ``first`` its first suffix.
    """
    *_, (_, runs) = _rounds(held, min_lines, None)
    return runs


def removed_lines(held: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = MIN_WORDS) -> DataFrame:
    """``(row, removed)``: the ordered places, among lines with words, that lie in a later copy of a run."""
    covered = None
    for length, runs in _rounds(held, min_lines, min_words):
        if length < min_lines:
            if min_words is None:
                continue
            runs = runs.where(F.col("words") > min_words)
        later = runs.where("NOT (row <=> first.row AND pos = first.pos)")
        places = later.select("row", F.explode(F.sequence("pos", F.col("pos") + length - 1)).alias("pos"))
        covered = places if covered is None else covered.unionByName(places)
    return covered.groupBy("row").agg(F.sort_array(F.collect_set("pos")).alias("removed"))


def _marks(size: Column, places: Column) -> Column:
    """``(at, hit)`` for each number below ``size``, in order: whether it is one of ``places``."""
    others = F.array_except(F.sequence(F.lit(0), size - 1), places)

    def marked(numbers: Column, hit: bool) -> Column:
        return F.transform(numbers, lambda x: F.struct(x.alias("at"), F.lit(hit).alias("hit")))

    return F.sort_array(F.concat(marked(places, True), marked(others, False)))


def _without(text: Column, removed: Column) -> Column:
    """The text without the lines at ``removed``, places among its lines with words.

    Arrays are paired with marks of their own length, never indexed inside a lambda, which would
    split the text again for each element.
    """
    lines, worded = F.split(text, "\n", -1), _worded(text)
    hits = F.zip_with(worded, _marks(F.size(worded), removed), lambda x, m: F.when(m["hit"], x["at"]))
    gone = F.filter(hits, lambda k: k.isNotNull())
    # array_join leaves nulls out.
    return F.array_join(F.zip_with(lines, _marks(F.size(lines), gone), lambda x, m: F.when(~m["hit"], x)), "\n")


def _stretches(places: Column) -> Column:
    """``(runs, longest)``: how many stretches of consecutive numbers the ordered ``places`` form, and the longest."""

    def state(runs: Column, size: Column, longest: Column, last: Column) -> Column:
        return F.struct(runs.alias("runs"), size.alias("size"), longest.alias("longest"), last.alias("last"))

    def step(held: Column, place: Column) -> Column:
        follows = place == held["last"] + 1
        size = F.when(follows, held["size"] + 1).otherwise(1)
        return state(F.when(follows, held["runs"]).otherwise(held["runs"] + 1), size, F.greatest(held["longest"], size), place)

    return F.aggregate(places, state(F.lit(0), F.lit(0), F.lit(0), F.lit(-2)), step)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES, report: str | None = None, min_words: int | None = MIN_WORDS) -> DataFrame:
    """The documents with all their columns, without the lines of later copies; ``n_chars`` is set anew.

    Runs of fewer than ``min_lines`` lines count when they have more than ``min_words`` words; with ``None`` they don't.
    ``report`` names a further column for ``(n_lines, n_removed, n_runs, longest_run)``.
    """
    row, removed = T.free_name(docs, "row"), T.free_name(docs, "removed")
    held = workspace.stage(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    text = F.col(text_col).cast("string")
    gone = removed_lines(held.select(F.col(row).alias("row"), F.col(id_col).alias("doc_id"), text.alias("text")), min_lines, min_words)
    joined = held.join(gone.select(F.col("row").alias(row), F.col("removed").alias(removed)), row, "left")
    clean = F.when(F.col(removed).isNull(), text).otherwise(_without(text, F.col(removed)))
    out = [
        clean.alias(c) if c == text_col
        else F.length(clean).cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col(f"`{c}`")
        for c in docs.columns
    ]
    if report:
        places = F.coalesce(F.col(removed), F.array().cast("array<int>"))
        stretches = _stretches(places)
        sizes = {"n_lines": F.coalesce(F.size(_worded(text)), F.lit(0)), "n_removed": F.size(places), "n_runs": stretches["runs"], "longest_run": stretches["longest"]}
        out.append(F.struct(*[v.cast("bigint").alias(k) for k, v in sizes.items()]).alias(report))
    return joined.select(*out)
