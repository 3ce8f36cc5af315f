"""Token ids of whole texts by a public tokenizer.

The tokenizer's own splitting never joins what a space or line break separates, so a text's
ids are those of its space-separated pieces in a row. Each worker remembers the ids of the
pieces it has seen, as little-endian unsigned 32-bit bytes, and hands only new ones to the
library; a text is then one ``join``. A test compares with the library on whole texts.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.llm import text as T

#: Vocabulary of ``encoded`` and the id that ends each document.
VOCABULARY, END = "word_bpe_49k.json", 2
_END_BYTES = np.array([END], "<u4").tobytes()
#: Words in one generation of a worker's memory. When it is full it becomes the old one, from
#: which words that are asked for again move on; two generations take at most 300 MB.
REMEMBERED = 700_000
_loaded: dict[str, "Pieces"] = {}


def vocabulary_path(name: str) -> str:
    """A public vocabulary file; it lies at the same place on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(256 + k) for k, b in enumerate(rest)}


class Pieces(dict):
    """The ids of each piece, as bytes. A piece is what ``bytes.split()`` yields of a UTF-8 text.

    A plain word with a closing mark is two tokens of the tokenizer's own splitting, and
    case doesn't count; such pieces are put together from what is known of the word. A plain
    lower-case word needs no normalizing or splitting and goes straight to the library's model.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.letters = _byte_letters()
        self.old: dict[bytes, bytes] = {}

    def turn(self) -> None:
        """A new generation, if this one is full."""
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.encode(piece)
        self[piece] = ids
        return ids

    def encode(self, piece: bytes) -> bytes:
        text = piece.decode()
        stem, mark = (piece[:-1], piece[-1:]) if piece[-1] in b".,!?" else (piece, b"")
        plain = text[:-1] if mark else text
        if not (plain.isalpha() and (plain.isascii() or max(plain) <= "\u00ff")):
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        if mark or not plain.islower():
            return self[plain.lower().encode()] + (self[mark] if mark else b"")
        letters = plain if plain.isascii() else stem.decode("latin-1").translate(self.letters)
        return array("I", [x.id for x in self.model.tokenize(letters)]).tobytes()


def encode_texts(texts: list[bytes], path: str) -> list[bytes]:
    """Ids of each text with the end id, as little-endian unsigned 32-bit integers."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    known = _loaded[path]
    known.turn()
    return [b"".join(map(known.__getitem__, t.split())) + _END_BYTES for t in texts]


def narrow(ids: bytes) -> bytes:
    """32-bit ids as 16-bit ones where all fit; marked by a first byte."""
    wide = np.frombuffer(ids, "<u4")
    return b"\2" + wide.astype("<u2").tobytes() if not len(wide) or wide.max() < 1 << 16 else b"\4" + ids


def widen(stored: bytes) -> bytes:
    return stored[1:] if stored[:1] == b"\4" else np.frombuffer(stored, "<u2", offset=1).astype("<u4").tobytes()


def text_bytes(name: str = "text") -> Column:
    """The text's UTF-8 bytes, with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary").alias("text")


def encoded(rows: DataFrame, path: str, columns: str) -> DataFrame:
    """``columns`` (the schema of all but the last column, ``text`` as bytes), ``n_tokens`` and ``ids``."""

    def work(batch: pa.RecordBatch) -> list:
        ids = encode_texts(batch.column(batch.num_columns - 1).to_pylist(), path)
        return [*batch.columns[:-1], [len(x) // 4 for x in ids], [narrow(x) for x in ids]]

    return T.map_rows(rows, f"{columns}, n_tokens bigint, ids binary", work)
