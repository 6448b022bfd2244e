"""Token-id files: independent zstandard frames with a trailing seek table and checksums.

Layout of a file, in the zstandard seekable format:
  one or more frames for each document (at most FRAME_IDS ids each; every frame has a content checksum),
  a skippable frame with the document index (numbers of frames and ids, document ids),
  a skippable frame with the seek table: for each frame its compressed size, its plain size and the low 32 bits of
  the XXH64 of its plain bytes; then the number of frames, a descriptor byte and the closing magic number.
A reader fetches the table from the file's end and then only the frames of the documents it wants.
"""

from __future__ import annotations

import struct

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logharrow.llm.scratch import materialise, new_path
from logharrow.llm.tokens import encoder, text_batches

#: Fixed values of the zstandard seekable format, and this format's index frame.
SKIPPABLE_TABLE, SKIPPABLE_INDEX, SEEKABLE_END = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1
HAS_CHECKSUMS = 0x80
FRAME_IDS = 1 << 20
INDEX_MAGIC = b"LHTI"
#: A task starts a new file beyond so many ids or documents: what a writer holds in memory, and a reader's index, are bounded.
FILE_IDS, FILE_DOCS = 1 << 27, 1 << 19
#: Bytes that a reader of whole files fetches at once.
AHEAD = 4 << 20


class TokenFileWriter:
    """Writes one file to an open binary stream."""

    def __init__(self, stream, id_bytes: int, level: int = 3):
        import zstandard

        self.stream, self.id_bytes = stream, id_bytes
        self.squeeze = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.table: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, bool, int, int]] = []

    def _frame(self, plain: bytes) -> None:
        import xxhash

        packed = self.squeeze.compress(plain)
        self.stream.write(packed)
        self.table.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> (8 * self.id_bytes):
            raise ValueError(f"id {ids.max()} does not fit into {self.id_bytes} bytes")
        for at in range(0, len(ids), FRAME_IDS):
            self._frame(ids[at : at + FRAME_IDS].astype(f"<u{self.id_bytes}").tobytes())
        self.docs.append((doc_id or 0, doc_id is None, len(ids), -(-len(ids) // FRAME_IDS)))

    def close(self) -> None:
        import xxhash

        ids, null, n_ids, n_frames = (np.array(x) for x in zip(*self.docs)) if self.docs else (np.zeros(0),) * 4
        plain = ids.astype("<i8").tobytes() + null.astype("<u1").tobytes() + n_ids.astype("<u8").tobytes() + n_frames.astype("<u4").tobytes()
        body = INDEX_MAGIC + struct.pack("<BQ", self.id_bytes, len(self.docs)) + self.squeeze.compress(plain)
        self.stream.write(struct.pack("<II", SKIPPABLE_INDEX, len(body)) + body)
        self.table.append((len(body) + 8, 0, xxhash.xxh64_intdigest(body) & 0xFFFFFFFF))
        entries = b"".join(struct.pack("<III", *x) for x in self.table)
        self.stream.write(struct.pack("<II", SKIPPABLE_TABLE, len(entries) + 9) + entries + struct.pack("<IBI", len(self.table), HAS_CHECKSUMS, SEEKABLE_END))


class TokenFileReader:
    """Reads single documents, or all in file order, from a seekable binary stream; `ahead` bytes at once at least."""

    def __init__(self, stream, ahead: int = 0):
        import xxhash
        import zstandard

        self.stream, self.plain, self.ahead, self.block = stream, zstandard.ZstdDecompressor(), ahead, (0, b"")
        stream.seek(0, 2)
        end = stream.tell()
        n, flags, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEKABLE_END or flags != HAS_CHECKSUMS:
            raise ValueError("not a token file")
        self.sizes, _, self.sums = (np.frombuffer(self._at(end - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3).T.astype(np.int64))
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))
        body = self._at(int(self.starts[n - 1]) + 8, int(self.sizes[n - 1]) - 8)
        if body[:4] != INDEX_MAGIC or xxhash.xxh64_intdigest(body) & 0xFFFFFFFF != self.sums[n - 1]:
            raise ValueError("damaged document index")
        self.id_bytes, docs = struct.unpack("<BQ", body[4:13])
        raw = self.plain.decompress(body[13:]) if docs else b""
        at = np.cumsum([0, 8 * docs, docs, 8 * docs, 4 * docs])
        self.doc_ids, self.null, self.n_ids, self.n_frames = (np.frombuffer(raw[at[i] : at[i + 1]], kind) for i, kind in enumerate(("<i8", "<u1", "<u8", "<u4")))
        self.first = np.concatenate(([0], np.cumsum(self.n_frames))).astype(np.int64)

    def _at(self, start: int, n: int) -> bytes:
        first, held = self.block
        if not first <= start <= start + n <= first + len(held):
            self.stream.seek(start)
            first, held = self.block = start, self.stream.read(max(n, self.ahead))
        return held[start - first : start - first + n]

    def read(self, k: int) -> np.ndarray:
        """Ids of the file's k-th document; only its frames are decompressed and checked."""
        import xxhash

        parts = []
        for f in range(int(self.first[k]), int(self.first[k + 1])):
            plain = self.plain.decompress(self._at(int(self.starts[f]), int(self.sizes[f])))
            if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.sums[f]:
                raise ValueError(f"frame {f} is damaged")
            parts.append(np.frombuffer(plain, f"<u{self.id_bytes}"))
        return np.concatenate(parts) if parts else np.zeros(0, f"<u{self.id_bytes}")

    def find(self, doc_id: int) -> range:
        """Numbers of the documents of this id; ids ascend in a file, after those without one."""
        skip = int(self.null.sum())
        return range(skip + int(np.searchsorted(self.doc_ids[skip:], doc_id, "left")), skip + int(np.searchsorted(self.doc_ids[skip:], doc_id, "right")))

    def __iter__(self):
        for k in range(len(self.doc_ids)):
            yield (None if self.null[k] else int(self.doc_ids[k])), self.read(k)


def _open(path: str, mode: str):
    """A stream in the store that the path's scheme names."""
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    if mode == "w":
        store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        return store.open_output_stream(inner, compression=None)  # by default the suffix would squeeze it again
    return store.open_input_file(inner)


def write_token_files(df: DataFrame, tokenizer_path: str, out: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, id_bytes: int | None = None, drops_space: bool = False, partitions: int | None = None, file_ids: int = FILE_IDS, file_docs: int = FILE_DOCS) -> DataFrame:
    """Encode whole texts, append end_id to each and write token files in ascending id order below `out`.

    Returns the manifest, a written table with one row a file: part, number (in its part), path, n_docs, n_tokens, least and
    most (document ids). A file ends with the document that takes it to file_ids ids or file_docs documents.
    Files get a name of their own in each attempt of a task and count only if the manifest lists them, so a repeated task
    does no harm. An id takes id_bytes, by default two, or four if the vocabulary or end_id needs more; an id that does not
    fit raises. A null or empty text has the end id alone; a null id comes first; rows with the same id stay apart, ordered
    by text. Extra columns are ignored. An empty table gives an empty manifest.
    """
    if id_bytes is None:
        id_bytes = 2 if max(encoder(tokenizer_path, drops_space).top_id, end_id) < 1 << 16 else 4
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange(partitions, "doc_id") if partitions else rows.repartitionByRange("doc_id")
    rows = rows.sortWithinPartitions("doc_id", "text")

    def write(batches):
        import uuid

        import pyarrow as pa
        from pyspark import TaskContext

        part, number, writer, end = TaskContext.get().partitionId(), 0, None, np.array([end_id], "<u4").tobytes()
        enc = encoder(tokenizer_path, drops_space)

        def row():
            ids = [d for d, null, _, _ in writer.docs if not null]  # ascending
            n_tokens = sum(n for _, _, n, _ in writer.docs)
            writer.close()
            writer.stream.close()
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "number": pa.array([number], pa.int64()), "path": [path], "n_docs": [len(writer.docs)], "n_tokens": [n_tokens], "least": pa.array(ids[:1] or [None], pa.int64()), "most": pa.array(ids[-1:] or [None], pa.int64())})

        for piece, texts in text_batches(batches, "text"):
            for doc_id, raw in zip(piece.column("doc_id").to_pylist(), enc.encode(texts)):
                if writer is None:
                    path, held = f"{out}/part-{part:06d}-{number:06d}-{uuid.uuid4().hex}.tok.zst", 0
                    writer = TokenFileWriter(_open(path, "w"), id_bytes)
                ids = np.frombuffer(raw + end, "<u4")
                writer.add(doc_id, ids)
                held += len(ids)
                if held >= file_ids or len(writer.docs) >= file_docs:
                    yield row()
                    writer, number = None, number + 1
        if writer is not None:
            yield row()

    return materialise(rows.mapInArrow(write, "part long, number long, path string, n_docs long, n_tokens long, least long, most long"), "manifest")


def read_token_files(manifest: DataFrame, tasks: int | None = None) -> DataFrame:
    """Read listed files back: doc_id, start (ids of all documents before it), n_tokens, ids (unsigned 32-bit, binary)."""
    spark = manifest.sparkSession
    before = F.sum("n_tokens").over(Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1))  # one row a file
    files = manifest.withColumn("base", F.coalesce(before, F.lit(0))).select("path", "base")
    files = files.repartition(tasks or 4 * spark.sparkContext.defaultParallelism)

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                held, size = [], 0
                with _open(path, "r") as stream:
                    for doc_id, ids in TokenFileReader(stream, AHEAD):
                        raw = ids.astype("<u4").tobytes()
                        held.append((doc_id, start, len(ids), raw))
                        start, size = start + len(ids), size + len(raw)
                        if size > 1 << 22:
                            yield to_batch(pa, held)
                            held, size = [], 0
                if held:
                    yield to_batch(pa, held)

    def to_batch(pa, held):
        ids, starts, n, raw = zip(*held)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(n, pa.int64()), pa.array(raw, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def read_documents(manifest: DataFrame, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents of the ids in `wanted` (repeats and nulls count for nothing): doc_id, n_tokens, ids.

    Only files whose range of ids holds a wanted one are opened, and only the frames of wanted documents are read and
    decompressed. The manifest's ranges, one row a file, go to every task; ids that no file has give no row.
    """
    spark = manifest.sparkSession
    files = manifest.where("least is not null").select("least", "most", "path").toArrow().sort_by("least")
    shared = spark.sparkContext.broadcast((files.column("least").to_numpy(), files.column("most").to_numpy(), files.column("path").to_pylist()))

    def place(batches):
        """Each id to its files: ranges are disjoint but for a shared end."""
        import pyarrow as pa

        least, most, _ = shared.value
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            last, first = np.searchsorted(least, ids, "right"), np.searchsorted(most, ids, "left")
            n = np.maximum(last - first, 0)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)), pa.array(np.repeat(ids, n))], ["file", "doc_id"])

    def read(batches):
        import pyarrow as pa

        reader = opened = None
        for batch in batches:  # sorted by file
            held = []
            for file, doc_id in zip(batch.column("file").to_pylist(), batch.column("doc_id").to_pylist()):
                if file != opened:
                    opened, reader = file, TokenFileReader(_open(shared.value[2][file], "r"))
                for k in reader.find(doc_id):
                    ids = reader.read(k)
                    held.append((doc_id, len(ids), ids.astype("<u4").tobytes()))
            if held:
                ids, n, raw = zip(*held)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(raw, pa.binary())], ["doc_id", "n_tokens", "ids"])

    ids = wanted.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    placed = ids.mapInArrow(place, "file long, doc_id long").repartition("file").sortWithinPartitions("file", "doc_id")
    return placed.mapInArrow(read, "doc_id long, n_tokens long, ids binary")


def token_files_path(spark) -> str:
    return new_path(spark, "token-files")
