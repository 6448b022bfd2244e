"""Document fingerprints: I-Match with several randomised lexicon subsets.

The lexicon holds the terms whose inverse document frequency lies in a band. Of each text the distinct terms in the
lexicon are sorted, and hashed under many random subsets of the lexicon. Subsets come in levels: at level l a subset
keeps each term with probability 2^-l, so that a text of n terms has some level at which a subset holds about one of
its terms. There, two texts agree in a subset's signature about as often as their terms overlap.

Every fingerprint ends with a few subsets that are drawn from all terms, so that texts with few or no terms in the lexicon
have one as well. All texts follow this one rule, and likeness is read over both parts.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logharrow.llm.words import byte_batches, mix, word_hashes

#: Band of the lexicon, in shares of all documents.
LOWEST_SHARE, HIGHEST_SHARE = 0.001, 0.05
#: Subsets of the lexicon, subsets of all terms, and levels of either.
SUBSETS, TAIL, LEVELS = 32, 8, 10
#: Text that one task compares, and rows of the sample that its range is cut by.
RANGE_BYTES, PER_RANGE = 16 << 20, 20
#: Share of the subsets that must hold a term of either text at the level that likeness is read at.
FILLED = 0.5
#: Two characters stand for the 12 bits of a signature; 0 is kept for a subset without terms.
DIGITS = np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz-_", np.uint8)
SEEDS = mix(np.arange(1, SUBSETS + TAIL + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def distinct_terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct words of each text, sorted within a text, and the text's number."""
    hashes, first = word_hashes(texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    order = np.lexsort((hashes, doc))
    hashes = hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[new], doc[new]


def document_frequencies(df: DataFrame, text_col: str = "text") -> DataFrame:
    """term (hash of a word) and df, the number of rows that have it; summed within each task before the shuffle."""

    def count(batches):
        import pyarrow as pa

        held, size = [], 0
        for _, texts in byte_batches(batches, "text"):
            terms, _ = distinct_terms(texts)
            terms, n = np.unique(terms, return_counts=True)
            held.append((terms, n))
            size += len(terms)
            if size > 4_000_000:
                yield from summed(pa, held)
                held, size = [], 0
        yield from summed(pa, held)

    def summed(pa, held):
        if held:
            terms, n = (np.concatenate(x) for x in zip(*held))
            terms, at = np.unique(terms, return_inverse=True)
            n = np.bincount(at, n).astype(np.int64)
            for i in range(0, len(terms), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(terms[i : i + 50_000].view(np.int64)), pa.array(n[i : i + 50_000])], ["term", "n"])

    return df.select(F.col(text_col).alias("text")).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("df"))


def lexicon(df: DataFrame, rows: int, text_col: str = "text") -> np.ndarray:
    """Sorted hashes of the terms in the band. Size bound: distinct terms of a mean document / LOWEST_SHARE."""
    kept = document_frequencies(df, text_col).where(F.col("df").between(LOWEST_SHARE * rows, max(HIGHEST_SHARE * rows, 2)))
    table = kept.select("term").toArrow()
    return np.sort(table.column("term").to_numpy().view(np.uint64))


def signatures(texts: list[bytes], terms: np.ndarray) -> np.ndarray:
    """12-bit signatures, texts x LEVELS x (SUBSETS + TAIL); 0 where no term of the text is in the subset."""
    all_hashes, all_docs = distinct_terms(texts)
    n = len(texts)
    known = terms[np.minimum(np.searchsorted(terms, all_hashes), len(terms) - 1)] == all_hashes if len(terms) else np.zeros(len(all_hashes), bool)
    banded = all_hashes[known], all_docs[known]
    out = np.zeros((n, LEVELS, SUBSETS + TAIL), np.uint16)
    size = n * LEVELS
    for j, seed in enumerate(SEEDS):
        hashes, doc = banded if j < SUBSETS else (all_hashes, all_docs)
        x = mix(hashes ^ seed)
        low = x & (~x + np.uint64(1))
        level = np.minimum(np.bitwise_count(low - np.uint64(1)), LEVELS - 1).astype(np.int64)
        cell = doc * LEVELS + level
        y = mix(x)
        # sums of 32-bit halves stay exact; the terms are distinct and sorted, so a sum over them is a hash of the set
        sums = [np.bincount(cell, (y >> np.uint64(s)) & np.uint64(0xFFFFFFFF), size).reshape(n, LEVELS)[:, ::-1].cumsum(1)[:, ::-1] for s in (0, 32)]
        some = np.bincount(cell, minlength=size).reshape(n, LEVELS)[:, ::-1].cumsum(1)[:, ::-1] > 0
        whole = mix(sums[0].astype(np.uint64) ^ mix(sums[1].astype(np.uint64)))
        out[:, :, j] = np.where(some, 1 + whole % np.uint64(4095), 0)
    return out


def spell(sig: np.ndarray) -> list[str]:
    flat = sig.reshape(len(sig), -1)
    return [DIGITS[np.stack([row >> 6, row & 63], 1).ravel()].tobytes().decode() for row in flat]


def read(fingerprint: str) -> np.ndarray:
    back = np.zeros(256, np.uint16)
    back[DIGITS] = np.arange(64)
    digits = back[np.frombuffer(fingerprint.encode(), np.uint8)]
    return (digits[0::2] * 64 + digits[1::2]).reshape(LEVELS, SUBSETS + TAIL)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of agreeing subsets, either part read at its sparsest level that is filled enough; 1 if neither text has any term."""
    agree = held = 0
    for part in (slice(0, SUBSETS), slice(SUBSETS, None)):
        x, y = a[:, part], b[:, part]
        filled = (x > 0) | (y > 0)
        n = filled.sum(1)
        level = max((k for k in range(LEVELS) if n[k] >= FILLED * x.shape[1]), default=0)
        agree, held = agree + ((x == y) & filled)[level].sum(), held + n[level]
    return float(agree / held) if held else 1.0


def fingerprint_texts(df: DataFrame, terms: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint of each row; no shuffle. Null text is as empty. `terms` is the lexicon()."""
    shared = df.sparkSession.sparkContext.broadcast(terms)

    def scan(batches):
        import pyarrow as pa

        for piece, texts in byte_batches(batches, "text", 1 << 20):
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(spell(signatures(texts, shared.value)))], ["doc_id", "fingerprint"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(scan, "doc_id long, fingerprint string")


def range_edges(rows: DataFrame, size: Column, range_bytes: int) -> np.ndarray:
    """Least (doc_id, h) of each range but the first, for ranges of about range_bytes of text; sorted, one pair a range.

    A seeded sample by hash of about PER_RANGE rows a range is sorted in Spark, and each PER_RANGE-th row is an edge.
    """
    spark = rows.sparkSession
    total = rows.agg(F.sum(size.cast("long")).alias("bytes"), F.count("*").alias("n")).first()
    ranges = max(-(-(total["bytes"] or 0) // range_bytes), spark.sparkContext.defaultParallelism)
    share = min(1.0, PER_RANGE * ranges / max(total["n"], 1))
    sample = rows.select("doc_id", "h").where(F.pmod(F.xxhash64(F.lit(11), "doc_id", "h"), F.lit(1 << 30)) < int(share * (1 << 30)))
    ordered = sample.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    step = max(1, int(share * total["n"] / ranges)) if total["n"] else 1

    def edges(batches):
        import pyarrow as pa

        seen = 0
        for batch in batches:
            at = np.flatnonzero((seen + np.arange(1, len(batch) + 1)) % step == 0)
            seen += len(batch)
            yield batch.take(pa.array(at))

    found = ordered.mapInArrow(edges, "doc_id long, h long").toArrow()  # one row a range
    return np.unique(_keys(found.column("doc_id").to_numpy(), found.column("h").to_numpy()))


def _keys(ids: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Pairs that sort by id and hash."""
    out = np.empty(len(ids), [("id", "i8"), ("h", "i8")])
    out["id"], out["h"] = ids, h
    return out


def fingerprint_neighbours(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Fingerprint each text, and its edited text against the next one in ascending id order.

    The edited text has its last quarter of code points replaced by the start of the next row's text (of the first
    row's after the last). Rows are dealt by ranges of id and a hash of the text, and the first row of each range goes to the
    range before as well, so each task has every neighbour that it needs. Texts travel compressed.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Null text is as
    empty, a null id comes first, rows with the same id follow in the order of that hash, so that many of them are spread
    over ranges; only rows equal in both share a range. A single row is its own next. An empty table gives an empty result.
    Extra columns are ignored.
    """
    spark = df.sparkSession
    rows = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    terms = lexicon(rows, rows.count())
    cuts = range_edges(rows, F.octet_length("text") + 64, range_bytes)

    def lowest(batches):
        import pyarrow as pa

        for batch in batches:
            keys = np.sort(_keys(batch.column("doc_id").to_numpy(), batch.column("h").to_numpy()))
            at = np.searchsorted(cuts, keys, "right")
            found, first = np.unique(at, return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(keys["id"][first]), pa.array(keys["h"][first])], ["part", "id", "h"])

    # first row of each range that has rows: one row a range
    least = rows.select("doc_id", "h").mapInArrow(lowest, "part long, id long, h long").groupBy("part").agg(F.min(F.struct("id", "h")).alias("key"))
    least = least.select("part", "key.id", "key.h").toArrow().sort_by("part")
    filled, firsts = least.column("part").to_numpy(), _keys(least.column("id").to_numpy(), least.column("h").to_numpy())
    shared = spark.sparkContext.broadcast((terms, cuts, filled, firsts))

    def deal(batches):
        """To its range; the lowest row of a range also to the range before, marked as a neighbour."""
        import pyarrow as pa
        import zstandard

        _, cuts, filled, firsts = shared.value
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            keys = _keys(batch.column("doc_id").to_numpy(), batch.column("h").to_numpy())
            parts = np.searchsorted(cuts, keys, "right")
            place = np.searchsorted(filled, parts)
            first = np.flatnonzero(firsts[place] == keys)
            packed = [squeeze(t) for t in batch.column("text").cast("binary").to_pylist()]
            row = np.concatenate((np.arange(len(keys)), first))
            part = np.concatenate((parts, filled[place[first] - 1]))  # before the first range comes the last
            mark = np.arange(len(row)) >= len(keys)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(keys["id"][row]), pa.array(keys["h"][row]), pa.array(mark), pa.array([packed[k] for k in row.tolist()], pa.binary())], ["part", "doc_id", "h", "neighbour", "packed"])

    def scan(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        held: list[tuple[int, str]] = []
        size, beyond = 0, None
        for batch in batches:  # the neighbour first, then the rows in order
            for mark, doc_id, packed in zip(*(batch.column(c).to_pylist() for c in ("neighbour", "doc_id", "packed"))):
                text = unpack(packed).decode()
                if mark:
                    beyond = text  # equal rows of the next range are the same text
                    continue
                held.append((doc_id, text))
                size += len(text)
                if size > 1 << 20 and len(held) > 1:
                    ready, held, size = held, [(doc_id, text)], len(text)
                    yield result(ready[:-1], ready[1:])
        if held:
            yield result(held, [*held[1:], (0, beyond)])

    def result(rows, nexts):
        import pyarrow as pa

        terms = shared.value[0]
        texts = [t for _, t in rows]
        edited = []
        for (_, t), (_, u) in zip(rows, nexts):
            n = len(t) // 4
            edited.append((t[: len(t) - n] + u[:n]).encode())
        plain = [t.encode() for t in texts]
        own, new = signatures([*plain, nexts[-1][1].encode()], terms), signatures(edited, terms)
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([None if d == -(1 << 63) else d for d, _ in rows], pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
                pa.array(spell(own[:n])), pa.array(spell(new)), pa.array([likeness(own[i], new[i]) for i in range(n)]), pa.array([likeness(own[i], own[i + 1]) for i in range(n)]),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    dealt = rows.mapInArrow(deal, "part int, doc_id long, h long, neighbour boolean, packed binary").repartitionById(len(cuts) + 1, "part")
    dealt = dealt.sortWithinPartitions(F.desc("neighbour"), "doc_id", "h")
    return dealt.mapInArrow(scan, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
