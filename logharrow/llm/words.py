"""Vectorised word and window hashing over Arrow batches of text (NumPy, unsigned 64-bit wrap-around)."""

from __future__ import annotations

import numpy as np

#: Fixed odd multipliers for polynomial hashing modulo 2^64, and a finaliser's constants.
BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
WORD_BASE = np.uint64(0xD6E8FEB86659FD93)
SECOND_BASE = np.uint64(0xA0761D6478BD642F)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)

_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    got = _powers.get(int(base))
    if got is None or len(got) < n:
        size = max(1 << 16, 1 << int(n).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        got = _powers[int(base)] = np.multiply.accumulate(steps)
    return got[:n]


def prefix_hash(values: np.ndarray, base: np.uint64) -> np.ndarray:
    """Prefix sums P with P[j]-P[i] = sum of values[t]*base^t for t in [i, j)."""
    out = np.empty(len(values) + 1, np.uint64)
    out[0] = 0
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """Rabin-Karp hashes of spans, brought down to power 0 of the base, so that they don't depend on the place."""
    down = np.uint64(pow(int(base), -1, 1 << 64))
    return (prefix[ends] - prefix[starts]) * powers(down, len(prefix))[starts]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words [^\\x20\\x09-\\x0D]+ of all texts in order, and each text's first word (n+1 offsets)."""
    joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    gap = (joined == 32) | ((joined >= 9) & (joined <= 13))
    edge = np.diff(np.concatenate(([1], gap.view(np.int8))))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    prefix = prefix_hash(joined.astype(np.uint64) + np.uint64(1), BYTE_BASE)
    hashes = mix(span_hash(prefix, starts, ends, BYTE_BASE))
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
    return hashes, np.searchsorted(starts, bounds)


def window_hashes(hashes: np.ndarray, width: int, base: np.uint64 = WORD_BASE) -> np.ndarray:
    """Rabin-Karp hash of every window of `width` words; the windows run over text ends, callers mask those."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    prefix = prefix_hash(hashes, base)
    at = np.arange(n)
    return mix(span_hash(prefix, at, at + width, base))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def byte_batches(batches, column: str, limit: int = 1 << 21):
    """Cut Arrow batches so that each piece holds about `limit` bytes of text; yields (piece, texts as bytes)."""
    for batch in batches:
        texts = [b"" if t is None else t for t in batch.column(column).cast("binary").to_pylist()]
        start = held = 0
        for i, t in enumerate(texts):
            held += len(t) + 1
            if held >= limit:
                yield batch.slice(start, i + 1 - start), texts[start : i + 1]
                start, held = i + 1, 0
        if start < len(texts):
            yield batch.slice(start), texts[start:]
