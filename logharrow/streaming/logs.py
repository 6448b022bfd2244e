"""Streams of W3C log files: every data line gets the header that governs it, across splits, files and micro-batches.

A log may be rotated into chunks (name.log, name.log.1, name.log.2, each perhaps compressed), and only the first may have a
header. A task that reads a split resolves all lines after the split's own first header where they are; only the lines
before it, and the last header of each split, go to the log's keyed state. There they are held until the split or chunk
before is known, in whichever order files come.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from logharrow.sources.w3c import header_tokens, parse
from logharrow.streaming.novelty import PROVIDER

#: A log's name and a chunk's number, at the end of a file's name before what compression adds; the first chunk has none.
CHUNK = r"^(.*?)(?:\.(\d+))?(?:\.gz)?$"
HEADER = "#Fields:"
LINE = "log string, chunk long, start long, kind string, header string, raw string"


def _split(batches, chunks: str):
    """Lines of splits, resolved where the split's own header is known. kind: line; early (before the split's first header); end (the split's last header, or null)."""
    import pyarrow as pa

    schema = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in LINE.split(", ")])
    at, header = None, None

    def row(kind, raw=None):
        name, chunk = re.match(chunks, at[0], re.S).groups()
        return {"log": name, "chunk": int(chunk or 0), "start": at[1], "kind": kind, "header": header, "raw": raw}

    for batch in batches:
        out = []
        for file, start, raw in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "raw"))):
            if at != (file, start):
                if at is not None:
                    out.append(row("end"))
                at, header = (file, start), None
            if raw.startswith(HEADER):
                header = raw
            elif raw and not raw.startswith("#"):
                out.append(row("line" if header is not None else "early", raw))
        yield pa.RecordBatch.from_pylist(out, schema)
    if at is not None:
        yield pa.RecordBatch.from_pylist([row("end")], schema)


class LastHeaders(StatefulProcessor):
    """State of a log: the last header of each chunk that its follower may still ask for, and the lines that wait."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.headers = handle.getMapState("headers", "chunk bigint", "header string")
        self.waiting = handle.getMapState("waiting", "chunk bigint", "lines string, inherits boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new: dict[int, list] = {}
        for batch in rows:
            for chunk, start, kind, header, raw in batch[["chunk", "start", "kind", "header", "raw"]].itertuples(index=False):
                new.setdefault(int(chunk), []).append((int(start), kind == "end", None if pd.isna(header) else header, raw))
        out = []
        for chunk, found in sorted(new.items()):
            # a file is read in one micro-batch: a split inherits from the one before it in the file
            last, early = None, []
            for _, is_end, header, raw in sorted(found, key=lambda r: (r[0], r[1])):
                if is_end:
                    last = header if header is not None else last
                elif last is not None:
                    out.append((last, raw))
                else:
                    early.append(raw)
            if last is not None:
                self.headers.updateValue((chunk,), (last,))
            if early or last is None:
                self.waiting.updateValue((chunk,), (json.dumps(early), last is None))
        for chunk in sorted(k[0] for k in self.waiting.keys()):
            before = self._before(chunk)
            if before is None:
                continue
            lines, inherits = self.waiting.getValue((chunk,))
            out += [(before, raw) for raw in json.loads(lines) if before]
            if inherits and before:
                self.headers.updateValue((chunk,), (before,))
            if not inherits or before:
                self.waiting.removeKey((chunk,))
        if out:
            yield pd.DataFrame(out, columns=["header", "raw"]).assign(log=key[0])[["log", "header", "raw"]]

    def _before(self, chunk: int) -> str | None:
        """The header that the chunk before ends with; "" before a log's first chunk; None if it isn't known yet."""
        if chunk == 0:
            return ""
        return self.headers.getValue((chunk - 1,))[0] if self.headers.containsKey((chunk - 1,)) else None

    def close(self) -> None:
        pass


def read_w3c_stream(spark: SparkSession, path: str, datetime_format: str = "%Y-%m-%d %H:%M:%S", files_per_trigger: int | None = None, chunks: str = CHUNK) -> DataFrame:
    """Parsed requests of log files as they arrive below path, as read_w3c() parses them.

    chunks: a pattern of whole paths, whose two groups are a log's name and a chunk's number, from 0 (or absent) without gaps.

    Lines before a log's first header drop out; lines of a chunk whose predecessor has not come wait for it. A file is read
    once, in whole: rotated chunks are files of their own. Sets the session's state store, as keyed processors need that one.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    reader = reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader
    lines = reader.load(path).select(F.make_valid_utf8("value").alias("raw"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    found = lines.mapInArrow(lambda batches: _split(batches, chunks), LINE)
    rest = found.where("kind <> 'line'").groupBy("log").transformWithStateInPandas(LastHeaders(), "log string, header string, raw string", "Append", "None")
    whole = found.where("kind = 'line'").select("log", "header", "raw").unionByName(rest)
    return parse(whole.select("raw", header_tokens(F.col("header")).alias("fields")), datetime_format)
