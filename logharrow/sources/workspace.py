"""Folders for tables that a run writes and reads again."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used in local mode where the session names no shared folder.
LOCAL_FALLBACK = "file:///tmp/checkpoints/logharrow"
_made: list[str] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below spark.checkpoint.dir that no other call gets; nothing is created."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{(root or LOCAL_FALLBACK).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return re.sub("^file:/+", "file:///", path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString())


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table that is read several times, and read it back: what comes before is computed once and survives lost executors."""
    path = new_folder(df.sparkSession, name)
    _made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mark() -> int:
    """How many tables materialise() has made in this driver: what comes later can be cleared alone."""
    return len(_made)


def clear(spark: SparkSession, since: int = 0) -> int:
    """Delete the tables that materialise() made since mark(), once no result reads them any more; their number."""
    gone = _made[since:]
    for path in gone:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    del _made[since:]
    return len(gone)
