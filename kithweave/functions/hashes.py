"""MinHash and SimHash signatures."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

def _family(permutations: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(1)
    return rng.integers(1, 1 << 31, permutations, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 31, permutations, dtype=np.uint64)


def minhash(grams: list[str], permutations: int = 128) -> list[int] | None:
    """Signature of a set of strings: the least value of each of a fixed family of hashes; None for an empty set."""
    if not len(grams):
        return None
    base = np.array([int.from_bytes(hashlib.blake2b(g.encode(), digest_size=4).digest(), "little") for g in grams], dtype=np.uint64)
    mul, add = _family(permutations)
    with np.errstate(over="ignore"):
        mixed = (base[None, :] * mul[:, None] + add[:, None]) >> np.uint64(16)
    return (mixed & np.uint64(0xFFFFFFFF)).min(axis=1).astype(np.int64).tolist()


def minhash_col(grams: Column, permutations: int = 128) -> Column:
    @F.pandas_udf("array<bigint>")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([minhash(list(g), permutations) if g is not None else None for g in s], dtype=object)

    return run(grams)


def simhash(tokens: list[str]) -> int:
    """64 bits, each the sign of the sum of the tokens' bits, as a signed integer; 0 for no tokens."""
    if not len(tokens):
        return 0
    counts = Counter(tokens)
    codes = np.array([int.from_bytes(hashlib.md5(t.encode()).digest()[:8], "little") for t in counts], dtype=np.uint64)
    weights = np.array(list(counts.values()))
    bits = (codes[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    votes = (np.where(bits, 1, -1) * weights[:, None]).sum(axis=0) >= 0
    value = sum(1 << i for i in range(64) if votes[i])
    return value - (1 << 64) if value >= 1 << 63 else value


def simhash_col(tokens: Column) -> Column:
    @F.pandas_udf("bigint")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([simhash(list(t)) if t is not None else 0 for t in s], dtype="int64")

    return run(tokens)


def hamming_col(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))
