"""Byte-level BPE over whole columns: a backtracking encoder on Aho-Corasick matches.

Two neighbouring tokens are compatible if BPE would leave the pair as it is;
a sequence of tokens is BPE's own result exactly if each pair is compatible.  So
a text piece is encoded from left to right with the longest match, stepping back
to the next shorter token where the pair rules one out; a bit per position keeps
it linear.  Which pairs are compatible follows from how each token splits into
the two it was merged from.
"""

from __future__ import annotations

import base64
import importlib
import importlib.util
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Default place of the vocabulary files: the installed package of public tokenizers.
PACKAGE = "public_tokenizers"
#: Pieces whose ids are remembered per worker.
CACHE = 200_000


def vocabulary_path(name: str) -> str:
    return importlib.import_module(PACKAGE).path(name)


def default_pattern() -> str:
    return importlib.import_module(PACKAGE).PATTERN


class ByteBPE:
    """Encoder and decoder of a ranked byte-level vocabulary (lines of base64 token and rank)."""

    def __init__(self, path: str, pattern: str):
        ranks = {}
        with open(path, "rb") as f:
            for line in f:
                if line.strip():
                    token, rank = line.split()
                    ranks[base64.b64decode(token)] = int(rank)
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            self.tokens[r] = t
        self.split_text = regex.compile(pattern)
        # decoding: all tokens' bytes end to end, and where each begins
        self.data = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.offsets = np.concatenate(([0], np.cumsum([len(t) for t in self.tokens])))
        automaton = ahocorasick.Automaton()
        for t, r in ranks.items():
            automaton.add_word(t.decode("latin-1"), r)
        automaton.make_automaton()
        self.automaton = automaton
        # the next shorter token that is a prefix, -1 without one
        self.shorter = [-1] * len(self.tokens)
        for t, r in ranks.items():
            for k in range(len(t) - 1, 0, -1):
                p = ranks.get(t[:k])
                if p is not None:
                    self.shorter[r] = p
                    break
        self.left, self.right = list(range(len(self.tokens))), list(range(len(self.tokens)))
        self.merged: dict[tuple[int, int], int] = {}
        for r, t in enumerate(self.tokens):
            if len(t) < 2:
                continue
            a = self.shorter[r]
            while a >= 0:
                b = ranks.get(t[len(self.tokens[a]) :])
                if b is not None and a < r and b < r and self.compatible(a, b):
                    self.merged[a, b] = r
                    self.left[r], self.right[r] = a, b
                    break
                a = self.shorter[a]
        self.cache: dict[str, list[int]] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether BPE leaves the tokens a and b apart: no merge across their border comes before those that made them."""
        limit = 1 << 60
        while True:
            m = self.merged.get((a, b))
            if m is not None and m < limit:
                return False
            if a > b:
                limit, a = a, self.right[a]
                if a == limit:  # a is a byte: now b must open
                    limit, b = b + 1, self.left[b]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, self.left[b]
                if b + 1 == limit:
                    limit, a = a, self.right[a]
                    if a == limit:
                        return True

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece, in time linear in its length."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        longest = [-1] * len(piece)
        for end, r in self.automaton.iter(piece.decode("latin-1")):
            start = end + 1 - len(self.tokens[r])
            if longest[start] < 0 or len(self.tokens[longest[start]]) < end + 1 - start:
                longest[start] = r
        open_ = bytearray(b"\x01") * (len(piece) + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while True:
            last = out[-1] if out else -1
            while token >= 0:
                end = at + len(self.tokens[token])
                if open_[end] and (last < 0 or self.compatible(last, token)):
                    out.append(token)
                    at = end
                    break
                token = self.shorter[token]
            else:  # nothing fits here: step back
                open_[at] = 0
                token = self.shorter[out[-1]]
                at -= len(self.tokens[out.pop()])
                continue
            if at == len(piece):
                return out
            token = longest[at]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text without special tokens; none for a null or empty text. Strings that look special are ordinary text."""
        if not text:
            return []
        out: list[int] = []
        cache = self.cache
        for piece in self.split_text.findall(text):
            ids = cache.get(piece)
            if ids is None:
                ids = self.encode_piece(piece.encode("utf-8", "surrogatepass"))
                if len(piece) <= 64:
                    if len(cache) >= CACHE:
                        cache.clear()
                    cache[piece] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return b""
        size = self.offsets[ids + 1] - self.offsets[ids]
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.offsets[ids], size)
        return self.data[at].tobytes()


@lru_cache(4)
def load(path: str, pattern: str) -> ByteBPE:
    return ByteBPE(path, pattern)


def _encode(path: str, pattern: str, count: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for b in batches:
            lo = 0
            size = np.diff(np.append(0, np.cumsum([len(t) if t else 1 for t in b.column(1).to_pylist()])))
            while lo < b.num_rows:  # output batches of about a million characters
                hi = lo + max(1, int(np.searchsorted(np.cumsum(size[lo:]), 1_000_000)))
                ids = [bpe.encode(t) for t in b.column(1).slice(lo, hi - lo).to_pylist()]
                col = pa.array(list(map(len, ids)), pa.int64()) if count else pa.array(ids, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), col], names=["id", "ids"])
                lo = hi

    return run


def encode_column(df: DataFrame, id_col: str, text_col: str, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row per input row: id_col and ids (array<int>). No shuffle; repeated rows stay repeated; null and empty texts give empty lists."""
    path, pattern = path or vocabulary_path("byte_bpe_50k.tiktoken"), pattern or default_pattern()
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_encode(path, pattern, False), f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def count_tokens(df: DataFrame, id_col: str, text_col: str, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row per input row: id_col and n_tokens (long)."""
    path, pattern = path or vocabulary_path("byte_bpe_50k.tiktoken"), pattern or default_pattern()
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_encode(path, pattern, True), f"id {kind}, n_tokens long").withColumnRenamed("id", id_col)
