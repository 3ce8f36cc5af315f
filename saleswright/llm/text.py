"""Words, shingles and Arrow plumbing shared by the text operators.

A word is a run of bytes outside space and 09-0D, which is what ``bytes.split()`` yields.
Words repeat far more often than they are new, so each worker keeps a bounded table from
word to hash and a whole text becomes one ``join`` over it.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words a worker remembers before it starts anew; about 60 MB.
REMEMBERED = 300_000
#: Words in a shingle.
WIDTH = 5
#: Rows taken out of an Arrow batch at a time, so that long texts don't pile up as Python strings.
SLICE = 256
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)


class Remembered(dict):
    """A bounded word table that fills itself with ``make(word)``."""

    def __init__(self, make: Callable):
        super().__init__()
        self.make = make

    def __missing__(self, word):
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = self.make(word)
        return value


_hashes = Remembered(xxhash.xxh64_digest)


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash for each word of a UTF-8 text, in order."""
    return np.frombuffer(b"".join(map(_hashes.__getitem__, data.split())), ">u8").astype(np.uint64)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash for each run of ``width`` words; for fewer words, one for the whole sequence."""
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    n = len(hashes) - width + 1
    out = hashes[:n] + np.uint64(width)
    for k in range(1, width):
        out = (out ^ (out >> np.uint64(31))) * _MIX + hashes[k : k + n]
    out = (out ^ (out >> np.uint64(29))) * _MIX2
    return out ^ (out >> np.uint64(32))


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct shingles of a text with A-Z lower-cased; empty without words."""
    return np.unique(windows(word_hashes((text or "").encode().lower()), width))


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_batches(df: DataFrame, schema: str, work: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``mapInArrow`` whose workers look for this package where the driver found it, besides their own path."""
    here, env = str(Path(__file__).resolve().parents[2]), df.sparkSession.sparkContext.environment
    if here not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH", ""), here]))
    return df.mapInArrow(work, schema)


def arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def map_rows(df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], list], rows: int = SLICE) -> DataFrame:
    """``work`` on small Arrow slices, returning one list or array per column of ``schema``."""
    names = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, rows):
            columns = work(part)
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, names, strict=True)],
                schema=names,
            )

    return map_batches(df, schema, run)


def whole_text(name: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias("text")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it as long as the table has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
