"""Substring dedup: Rabin-Karp hashes of fixed-length word windows, counted in Spark.

Every window of `width` words has a hash. A window can only repeat if its anchor repeats, the anchor being the least
hash among the window's SHINGLE-word shingles; equal windows have equal anchors. So each document first ships its
distinct anchors (about one in 18 words), and only windows with an anchor that two documents share are counted. Exact
copies (same word sequence) are settled by one hash of the whole sequence and ship no windows: all their words lie in
windows of an earlier document.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logharrow.llm.scratch import drop, materialise, release
from logharrow.llm.words import MIX_1, SECOND_BASE, byte_batches, mix, sliding_min, window_hashes, word_hashes

SHINGLE = 16
#: Text that is hashed at once; a worker needs about a hundred times this for its arrays.
BATCH_BYTES = 1 << 19


def window_anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """Anchor of every window of `width` words: its least shingle hash."""
    size = min(SHINGLE, width)
    shingles = window_hashes(hashes, size, SECOND_BASE)
    return sliding_min(shingles, width - size + 1) if len(shingles) >= width - size + 1 else np.empty(0, np.uint64)


def inside(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows that lie within one text, and the text of each."""
    n = np.maximum(np.diff(first) - width + 1, 0)
    doc = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[:-1][doc], doc


def _anchor_rows(docs: DataFrame, width: int) -> DataFrame:
    """First scan: doc_id, h (hash of the text), whole (hash of the word sequence), anchors (distinct ones of the document)."""

    def scan(batches):
        import pyarrow as pa

        for piece, texts in byte_batches(batches, "text", BATCH_BYTES):
            hashes, first = word_hashes(texts)
            starts, doc = inside(first, width)
            anchors = window_anchors(hashes, width)[starts]
            change = np.ones(len(anchors), bool)
            change[1:] = (anchors[1:] != anchors[:-1]) | (doc[1:] != doc[:-1])
            anchors, doc = anchors[change], doc[change]
            at = np.searchsorted(doc, np.arange(len(texts) + 1))
            lists = [np.unique(anchors[a:b]).view(np.int64) for a, b in zip(at, at[1:])]
            whole = [hashlib.sha256(b" ".join(t.split())).digest()[:16] for t in texts]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("h"), pa.array(whole, pa.binary()), pa.array(lists, pa.list_(pa.int64())), pa.array(np.diff(first))], ["doc_id", "h", "whole", "anchors", "n_words"])

    return docs.mapInArrow(scan, "doc_id long, h long, whole binary, anchors array<long>, n_words long")


def remove_repeats(df: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove each word covered by a window of `width` words whose word sequence also starts in a row with a smaller id.

    Words are runs without 0x20 and 0x09 to 0x0D. Windows are judged on the input. Returns doc_id, n_words, n_removed,
    kept (the words that stay, joined by one space) and spans (removed word ranges [from, to), merged and maximal).
    Null and empty texts have no words; texts of under `width` words lose nothing, copies of them included. Rows with
    the same id never take windows from each other, and each loses only what its own text repeats: rows are told apart by
    id and a hash of their text. A null id counts as larger than all others. An empty table gives an empty result. Extra
    columns are ignored. Aggregates are written before they are joined back to the rows that they come from, so that a
    very common text, anchor or window can be split over tasks.
    """
    top = (1 << 63) - 1
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(top)).alias("doc_id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    row = ["doc_id", "h"]
    scanned = materialise(_anchor_rows(docs, width), "anchors")

    # copies of a smaller id's word sequence
    wholes = scanned.where(F.col("n_words") >= width).select(*row, "whole")
    least = wholes.groupBy("whole").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").drop("most")
    copies = wholes.join(materialise(least, "whole-copies"), "whole").where("doc_id > least").select(*row).distinct()
    copies = materialise(copies, "copies")

    # anchors in two documents that are no copies
    own = scanned.select(*row, "anchors").join(copies, row, "left_anti")
    own = own.select(*row, F.explode("anchors").alias("anchor"))
    shared = own.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("anchor")
    wanted = own.join(materialise(shared, "anchors-of-two"), "anchor").groupBy(*row).agg(F.collect_set("anchor").alias("anchors"))
    wanted = materialise(wanted, "shared-anchors")
    drop(scanned)
    release(df.sparkSession)

    # second scan: hashes of the windows with such an anchor, only in documents that have one
    def windows(batches):
        import pyarrow as pa

        for piece, texts in byte_batches(batches, "text", BATCH_BYTES):
            hashes, first = word_hashes(texts)
            starts, doc = inside(first, width)
            anchors = window_anchors(hashes, width)[starts]
            keep = np.zeros(len(starts), bool)
            at = np.searchsorted(doc, np.arange(len(texts) + 1))
            for i, good in enumerate(piece.column("anchors").to_pylist()):
                keep[at[i] : at[i + 1]] = np.isin(anchors[at[i] : at[i + 1]], np.array(good, np.int64).view(np.uint64))
            starts, doc = starts[keep], doc[keep]
            ids, texts_of = (piece.column(c).to_numpy()[doc] for c in ("doc_id", "h"))
            one, two = window_hashes(hashes, width), window_hashes(mix(hashes + MIX_1), width, SECOND_BASE)
            for i in range(0, len(starts), 100_000):
                s = starts[i : i + 100_000]
                d = doc[i : i + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(ids[i : i + 100_000]), pa.array(texts_of[i : i + 100_000]), pa.array((s - first[d]).astype(np.int64)), pa.array(one[s].view(np.int64)), pa.array((two[s] >> np.uint64(33)).astype(np.int32))], ["doc_id", "h", "at", "h1", "h2"])

    some = docs.join(wanted, row)
    hashed = materialise(some.mapInArrow(windows, "doc_id long, h long, at long, h1 long, h2 int"), "windows")
    release(df.sparkSession)
    first_seen = hashed.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    first_seen = materialise(first_seen.select("h1", "h2", "least"), "repeated-windows")
    late = hashed.join(first_seen, ["h1", "h2"]).where("doc_id > least").groupBy(*row).agg(F.sort_array(F.collect_set("at")).alias("starts"))
    late = materialise(late, "late-windows")
    release(df.sparkSession)
    late = late.unionByName(copies.select(*row, F.array(F.lit(-1).cast("long")).alias("starts")))  # -1: all words

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            columns = batch.column("text").cast("binary").to_pylist(), batch.column("starts").to_pylist()
            out = [removed_from(text, starts, width) for text, starts in zip(*columns)]
            n, gone, kept, spans = zip(*out)
            ids = [None if x == top else x for x in batch.column("doc_id").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast("string"), pa.array(spans, pa.list_(pa.list_(pa.int64())))],
                ["doc_id", "n_words", "n_removed", "kept", "spans"],
            )

    return docs.join(late, row, "left").mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string, spans array<array<long>>")


def removed_from(text: bytes | None, starts: list[int] | None, width: int) -> tuple[int, int, bytes, list[list[int]]]:
    """Merge windows into maximal spans and cut them out."""
    words = (text or b"").split()
    if not starts or len(words) < width:
        return len(words), 0, b" ".join(words), []
    if starts[0] < 0:
        return len(words), len(words), b"", [[0, len(words)]]
    spans: list[list[int]] = []
    for at in starts:
        if spans and at <= spans[-1][1]:
            spans[-1][1] = at + width
        else:
            spans.append([at, at + width])
    kept, end = [], 0
    for a, b in spans:
        kept += words[end:a]
        end = b
    kept += words[end:]
    return len(words), len(words) - len(kept), b" ".join(kept), spans
