"""MurmurHash3 (x86, 32 bits) and the hashing trick. The only functions here that need Python; they take Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MASK = 0xFFFFFFFF


def _scramble(k: int) -> int:
    k = k * 0xCC9E2D51 & MASK
    return ((k << 15 | k >> 17) & MASK) * 0x1B873593 & MASK


def murmur3(data: bytes, seed: int = 42) -> int:
    """Unsigned 32-bit MurmurHash3_x86_32, after the published algorithm."""
    h, whole = seed, len(data) & ~3
    for (k,) in zip(np.frombuffer(data[:whole], "<u4").tolist()):
        h ^= _scramble(k)
        h = ((h << 13 | h >> 19) & MASK) * 5 + 0xE6546B64 & MASK
    if whole < len(data):
        h ^= _scramble(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & MASK
    h = (h ^ h >> 13) * 0xC2B2AE35 & MASK
    return h ^ h >> 16


def murmur3_many(tokens: list[bytes], seed: int = 42) -> np.ndarray:
    """murmur3() of many texts at once: those of one length go through the rounds together."""
    sizes = np.array([len(t) for t in tokens], np.int64)
    out = np.zeros(len(tokens), np.uint32)
    u = np.uint32
    turn = lambda x, r: (x << u(r)) | (x >> u(32 - r))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        raw = np.frombuffer(b"".join(tokens[i] for i in at), np.uint8).reshape(len(at), size)
        h = np.full(len(at), seed, u)
        for k in range(0, size & ~3, 4):
            word = np.ascontiguousarray(raw[:, k : k + 4]).view("<u4")[:, 0]
            h = turn(h ^ turn(word * u(0xCC9E2D51), 15) * u(0x1B873593), 13) * u(5) + u(0xE6546B64)
        if size & 3:
            word = np.zeros((len(at), 4), np.uint8)
            word[:, : size & 3] = raw[:, size & ~3 :]
            h ^= turn(word.view("<u4")[:, 0] * u(0xCC9E2D51), 15) * u(0x1B873593)
        h ^= u(size)
        h = (h ^ (h >> u(16))) * u(0x85EBCA6B)
        h = (h ^ (h >> u(13))) * u(0xC2B2AE35)
        out[at] = h ^ (h >> u(16))
    return out


def token_vectors(rows: list, dim: int, seed: int = 42) -> np.ndarray:
    """Signed hashing trick over lists of tokens, rows x dim: each token adds +1 or -1 to its bucket. Null counts as no token."""
    lists = [[t for t in r if t is not None] if r is not None else [] for r in rows]
    flat = [t for r in lists for t in r]
    out = np.zeros((len(lists), dim), np.float32)
    if flat:
        distinct, at = np.unique(np.array(flat, object), return_inverse=True)
        data = [t.encode() for t in distinct]
        bucket = (murmur3_many(data, seed) % np.uint32(dim)).astype(np.int64)
        sign = np.where(murmur3_many(data, seed + 1) < 1 << 31, 1.0, -1.0).astype(np.float32)
        row = np.repeat(np.arange(len(lists)), [len(r) for r in lists])
        np.add.at(out, (row, bucket[at]), sign[at])
    return out


def token_vector(tokens, dim: int, seed: int = 42) -> np.ndarray:
    return token_vectors([tokens], dim, seed)[0]


def murmur_column(value: Column) -> Column:
    """Unsigned murmur3 of a text as a long; null for null. Distinct values of a batch are hashed once."""

    @F.pandas_udf("long")
    def murmur_of(values: pd.Series) -> pd.Series:
        distinct = values.dropna().unique()
        known = dict(zip(distinct, murmur3_many([v.encode() for v in distinct]).tolist()))
        return values.map(known).astype("Int64")

    return murmur_of(value)


def hash_vector(tokens: Column, dim: int) -> Column:
    """array<float> of `dim` numbers from an array of tokens; null tokens count as no token."""

    @F.pandas_udf("array<float>")
    def vectors(batch: pd.Series) -> pd.Series:
        return pd.Series(list(token_vectors(batch.tolist(), dim)))

    return vectors(tokens)


def hashed_id(prefix: str, raw: Column) -> Column:
    """Prefix and eight lower-case hex digits of the murmur3 of `raw`."""
    return F.concat(F.lit(prefix), F.lpad(F.lower(F.hex(murmur_column(raw))), 8, "0"))
