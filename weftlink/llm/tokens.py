"""Token counts and hashed projections of texts, one pass, inside Arrow batches.

Byte-level pair encoding works on pieces that never cross a blank followed by a visible
character, so a text's count is the sum over its blank-separated pieces; pieces are counted
once and remembered.  Texts with a blank next to another white space are encoded as a whole.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Where the vocabulary file lies; a parameter of every operator.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the byte-level vocabularies split a text before pairs are merged.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DIMS = 3
HASHED = 1 << 12
_KEPT = 400_000
_ODD = re.compile(r" (?:\s|\Z)")
_loaded: dict[str, "Pieces"] = {}


class Pieces:
    """Counts tokens of texts; keeps what it has counted, up to a bound."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding("pieces", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        rng = np.random.default_rng(20)
        self.projection = rng.standard_normal((HASHED, DIMS)) / np.sqrt(DIMS)
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.sizes: list[int] = []
        self.slots: list[int] = []

    def _add(self, piece: str, text: str) -> int:
        got = self.at.get(piece)
        if got is None:
            got = self.at[piece] = len(self.sizes)
            self.sizes.append(len(self.encoding.encode_ordinary(text)))
            self.slots.append(zlib.crc32(piece.strip().lower().encode()) % HASHED)
        return got

    def ids(self, text: str) -> tuple[list[int], int]:
        """Piece numbers of a text, and the tokens that they miss (or have too many)."""
        first, *rest = text.split(" ")
        out = list(map(self.at.get, rest))
        if None in out:
            add = self._add
            out = [add(p, " " + p) if i is None else i for p, i in zip(rest, out)]
        more = 0
        if _ODD.search(text):
            more = len(self.encoding.encode_ordinary(text)) - sum(map(self.sizes.__getitem__, out))
        elif first:
            # a text's first piece has no blank before it
            more = len(self.encoding.encode_ordinary(first))
        return out, more

    def measure(self, texts: list[str], vectors: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Token counts, and unit-length projections of the hashed piece counts (zero for no pieces)."""
        if len(self.at) > _KEPT:
            self.clear()
        every, more = [], np.zeros(len(texts), np.int64)
        lengths = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            ids, more[i] = self.ids(text)
            lengths[i] = len(ids)
            every.append(np.array(ids, np.int64))
        flat = np.concatenate(every) if every else np.zeros(0, np.int64)
        ends = np.cumsum(lengths)

        def total(values: np.ndarray) -> np.ndarray:
            upto = np.concatenate([[0], np.cumsum(values)])
            return upto[ends] - upto[ends - lengths]

        sizes = total(np.array(self.sizes, np.int64)[flat]) + more
        if not vectors:
            return sizes, np.zeros((len(texts), 0))
        slots = np.array(self.slots, np.int64)[flat]
        out = np.stack([total(self.projection[slots, d]) for d in range(DIMS)], axis=1)
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return sizes, np.divide(out, norm, out=np.zeros_like(out), where=norm > 1e-9)


def pieces(path: str) -> Pieces:
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def measured(df: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...] = (), tokenizer: str = TOKENIZER, vectors: bool = True) -> DataFrame:
    """(id, kept columns, tokens[, v0, v1, v2]) of every row with a text; NULL texts give no row, '' has 0 tokens."""
    source = df.select(df[id_col].alias("id"), *[df[c] for c in keep], df[text_col].alias("text")).filter("text IS NOT NULL")
    fields = [f"`{n}` {t}" for n, t in source.dtypes if n != "text"] + ["tokens bigint"] + [f"v{d} double" for d in range(DIMS)] * vectors

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = pieces(tokenizer)
        for pdf in batches:
            for start in range(0, len(pdf), 512):
                part = pdf.iloc[start : start + 512]
                sizes, v = p.measure(part["text"].tolist(), vectors)
                out = part.drop(columns="text").assign(tokens=sizes)
                for d in range(v.shape[1]):
                    out[f"v{d}"] = v[:, d]
                yield out

    return source.mapInPandas(run, ", ".join(fields))
