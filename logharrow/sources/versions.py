"""Commit files that are created only if absent: readers see whole versions, writers never share a number."""

from __future__ import annotations

import json
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

COMMITS, VERSIONS = "_commits", "_versions"


class Folder:
    """A folder in any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._type = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._type(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, below: str = "") -> list[str]:
        at = self._type(f"{self.path}/{below}".rstrip("/"))
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def exists(self, below: str) -> bool:
        return self._fs.exists(self._type(f"{self.path}/{below}"))

    def drop(self, below: str) -> None:
        self._fs.delete(self._type(f"{self.path}/{below}"), True)

    def create(self, below: str, text: str) -> bool:
        """Write a new file; False, and nothing is written, if there is one of this name."""
        at = self._type(f"{self.path}/{below}")
        if self._fs.exists(at):
            return False
        # written aside and renamed, so that a commit is there in whole or not at all
        aside = self._type(f"{self.path}/{below}.{uuid.uuid4().hex}")
        out = self._fs.create(aside, False)
        out.write(bytearray(text.encode()))
        out.close()
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(self.spark._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(aside, at, options)  # without OVERWRITE
            return True
        except Py4JJavaError as error:
            self._fs.delete(aside, False)
            if "FileAlreadyExists" in str(error.java_exception):
                return False
            raise

    def read(self, below: str) -> str:
        stream = self._fs.open(self._type(f"{self.path}/{below}"))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


class DatedVersions:
    """A date-partitioned table whose dates are replaced all at once.

    New rows go to a folder of their own. A numbered commit then names the folder of every date; the last commit is the
    table. A job that dies before its commit changes nothing; of two writers one takes the next number with the other's dates
    in it. Dates that were written plainly, before the first commit, belong to the table.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.folder = spark, Folder(spark, path)

    def commits(self) -> list[int]:
        return sorted(int(n) for n in self.folder.names(COMMITS) if n.isdigit())

    def current(self) -> tuple[int, dict[str, str]]:
        """Number of the last commit (0 for none), and the parent folder of each date's folder."""
        numbers = self.commits()
        if numbers:
            return numbers[-1], json.loads(self.folder.read(f"{COMMITS}/{numbers[-1]}"))
        return 0, {n.split("=")[1]: "" for n in self.folder.names() if n.startswith("date=")}

    def replace(self, dated: DataFrame, **options: Any) -> int:
        """Replace the dates that a table with a column `date` has; the commit's number. The table may read this one."""
        home = f"{VERSIONS}/{uuid.uuid4().hex}"
        dated.write.options(**options).partitionBy("date").parquet(f"{self.folder.path}/{home}")
        new = {n.split("=")[1]: home for n in self.folder.names(home) if n.startswith("date=")}
        while True:
            number, dates = self.current()
            if self.folder.create(f"{COMMITS}/{number + 1}", json.dumps(dates | new)):
                return number + 1

    def read(self, date: str | None = None) -> DataFrame:
        _, dates = self.current()
        homes: dict[str, list[str]] = {}
        for d, home in dates.items():
            if date is None or d == date:
                homes.setdefault(home, []).append(d)
        if not homes:  # the schema of any date, and no rows
            return self.read().limit(0)
        frames = []
        for home, days in sorted(homes.items()):
            base = f"{self.folder.path}/{home}".rstrip("/")
            frames.append(self.spark.read.option("mergeSchema", "true").option("basePath", base).parquet(*[f"{base}/date={d}" for d in sorted(days)]))
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionByName(frame, allowMissingColumns=True)
        return out

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete what only commits before the last `keep` name, and folders without a commit; call it while nobody writes."""
        numbers = self.commits()
        used = {home for n in numbers[-keep:] for home in json.loads(self.folder.read(f"{COMMITS}/{n}")).values()}
        gone = [f"{VERSIONS}/{n}" for n in self.folder.names(VERSIONS) if f"{VERSIONS}/{n}" not in used]
        for below in [*gone, *(f"{COMMITS}/{n}" for n in numbers[:-keep])]:
            self.folder.drop(below)
        return gone
