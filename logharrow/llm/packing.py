"""Packing: concatenate and cut."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logharrow.llm.scratch import lean, materialise
from logharrow.llm.tokens import encoder, text_batches


def tokenise(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, drops_space: bool = True) -> DataFrame:
    """Pass one: ids of each document with end_id after them, and where they start within their partition.

    A written table: doc_id, ids (little-endian unsigned 32-bit, binary), n_tokens, part, local_start. A null or empty text
    has the end id alone; null and repeated ids stay as they are; further columns, whatever their names, are ignored.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def encode(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, start, end = TaskContext.get().partitionId(), 0, np.array([end_id], "<u4").tobytes()
        enc = encoder(tokenizer_path, drops_space)
        for piece, texts in text_batches(batches, "text"):
            ids = [raw + end for raw in enc.encode(texts)]
            sizes = np.array([len(x) // 4 for x in ids])
            stops = start + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(ids, pa.binary()), pa.array(sizes), pa.array(np.full(len(ids), part)), pa.array(stops - sizes)], ["doc_id", "ids", "n_tokens", "part", "local_start"])
            start = int(stops[-1])

    return materialise(rows.mapInArrow(lean(encode), "doc_id long, ids binary, n_tokens long, part long, local_start long"), "tokens")


def pack(tokens: DataFrame, width: int = 4096) -> DataFrame:
    """Pass two: lay all documents end to end and cut the stream every `width` ids.

    Prefix sums over the partitions' token totals (one row a partition) give each partition's global offset. A
    document that crosses a window's edge gets one boundary record on either side. Only the last window is short.

    Returns doc_id, start, length, ids (binary slice), doc_tokens, sequence_id, offset: one row a piece. An empty
    table gives no pieces; a document always has its end id, so each document has a piece; equal documents and
    repeated ids are packed as often as they occur.
    """
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    base = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    placed = tokens.join(F.broadcast(base), "part").withColumn("at", F.col("base") + F.col("local_start"))
    first, last = F.expr(f"at div {width}"), F.expr(f"(at + n_tokens - 1) div {width}")
    # slices are cut before rows are made, so that a long document is copied once and not into each of its pieces
    start = lambda k: F.greatest(k * width - F.col("at"), F.lit(0))
    length = lambda k: F.least(F.col("n_tokens"), (k + 1) * width - F.col("at")) - start(k)
    piece = lambda k: F.struct(k.alias("sequence_id"), start(k).alias("start"), length(k).alias("length"), F.substring("ids", (4 * start(k) + 1).cast("int"), (4 * length(k)).cast("int")).alias("ids"))
    cut = placed.select("doc_id", "n_tokens", "at", F.explode(F.transform(F.sequence(first, last), piece)).alias("p")).select("doc_id", "n_tokens", "at", "p.*")
    return cut.select(
        "doc_id", "start", "length", "ids",
        F.col("n_tokens").alias("doc_tokens"), "sequence_id",
        (F.col("at") + F.col("start") - F.col("sequence_id") * width).alias("offset"),
    )


def assemble(pieces: DataFrame) -> DataFrame:
    """Whole sequences: sequence_id and its ids in order; a sequence has at most `width` ids, so groups are bounded."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
