"""A whole corpus in the ids of a public byte-level tokenizer.

A long text is encoded by halves, as a tree: two neighbours are joined by encoding a window round their boundary again, which grows until both its ends
stand where a word is followed by a blank. The tokenizer's pre-tokenizer never joins a word with what follows such a place and looks at nothing before it, so
tokens outside the window are final, and joining is associative. Decoding joins the parts up the same tree.
"""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import table

TOKENIZERS = os.environ.get("KITHWEAVE_TOKENIZERS", "/opt/tokenizers")
#: Characters of a leaf of the tree, and of a window's side at first.
LEAF, WINDOW = 16384, 64
#: The pre-tokenizer's pattern of the public byte-level vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SLICE = 256


class Encoder:
    def __init__(self, path: str, leaf: int = LEAF, window: int = WINDOW):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, i in ranks.items():
            self.lengths[i] = len(token)
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.leaf, self.window = leaf, window

    @staticmethod
    def _final(text: str, i: int) -> bool:
        """Is there a token boundary at i whatever stands around?"""
        return text[i] in " \n" and text[i - 1].isascii() and text[i - 1].isalnum()

    def _join(self, text: str, a: int, m: int, b: int, left: list[int], right: list[int]) -> list[int]:
        s, w = m - 1, self.window
        while s > a and not (m - s >= w and self._final(text, s)):
            s -= 1
        e = m + w
        while e < b and not self._final(text, e):
            e += 1
        e = min(e, b)
        cut_left, n = len(left), len(text[s:m].encode())
        while n > 0:
            cut_left -= 1
            n -= self.lengths[left[cut_left]]
        cut_right, r = 0, len(text[m:e].encode())
        while r > 0:
            r -= self.lengths[right[cut_right]]
            cut_right += 1
        if n or r:
            raise AssertionError("a window must end between tokens")
        return left[:cut_left] + self.encoding.encode_ordinary(text[s:e]) + right[cut_right:]

    def _tree(self, text: str, a: int, b: int) -> list[int]:
        if b - a <= self.leaf:
            return self.encoding.encode_ordinary(text[a:b])
        m = (a + b) // 2
        return self._join(text, a, m, b, self._tree(text, a, m), self._tree(text, m, b))

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if not text.isascii():  # a lone surrogate has no bytes of its own
            text = text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
        return self._tree(text, 0, len(text))

    def decode(self, ids: list[int], leaf: int = 4096) -> str:
        def tree(a: int, b: int) -> bytes:
            if b - a <= leaf:
                return b"".join(self.encoding.decode_tokens_bytes(ids[a:b]))
            m = (a + b) // 2
            return tree(a, m) + tree(m, b)

        return tree(0, len(ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def vocabulary(name: str = "byte_bpe_50k.tiktoken", folder: str | None = None) -> str:
    return os.path.join(folder or TOKENIZERS, name)


def encode_corpus(df: DataFrame, id_col: str, text_col: str, path: str | None = None) -> DataFrame:
    """(id, ids): the token ids of every text; an empty list for empty and null texts, text that looks like a special token is plain text.

    Every row gives one row, repeated ids too; an empty table gives an empty result; columns other than the two aren't read.
    """
    path = path or vocabulary()
    source = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                ids = [np.asarray(enc.encode(t), dtype=np.int32) for t in part.column(1).to_pylist()]
                offsets = np.zeros(len(ids) + 1, dtype=np.int32)
                np.cumsum([len(x) for x in ids], out=offsets[1:])
                values = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=["doc_id", "ids"])

    return source.mapInArrow(run, "doc_id bigint, ids array<int>")


def count_tokens(df: DataFrame, keep: list[str], text_col: str, path: str | None = None) -> DataFrame:
    """The columns `keep` and n_tokens of every text (0 for empty and null texts); the ids stay in the worker."""
    path = path or vocabulary()

    @F.pandas_udf("bigint")
    def n(texts):
        enc = encoder(path)
        return texts.map(lambda t: len(enc.encode(t)), na_action=None)

    return df.select(*keep, n(F.col(text_col)).alias("n_tokens"))


def p8_ids(spark, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"), "doc_id", "text")


def p8_counts(spark, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens) of every document."""
    return count_tokens(table(spark, sf_dir, "documents"), ["doc_id"], "text")


SQL: dict[str, str] = {}
