"""Shared scratch space: written tables that cut lineage and survive lost executors."""

from __future__ import annotations

import gc
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from logharrow.sources.workspace import new_folder

_made: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call gets."""
    _made.append(new_folder(spark, name))
    return _made[-1]


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the scratch folder and read it back with the same schema."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mark() -> int:
    """How many scratch paths this driver has made: what comes later can be cleared alone."""
    return len(_made)


def clear(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> None:
    """Delete the scratch paths made since mark(), but for the table `keep`, once no result reads them any more."""
    kept = {f.rsplit("/", 1)[0] for f in keep.inputFiles()} if keep is not None else set()
    for path in _made[since:]:
        if path not in kept:
            drop_path(spark, path)
    _made[since:] = [path for path in _made[since:] if path in kept]


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path that nothing reads any more."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def give_back() -> None:
    """Return freed memory of this process to the system: Arrow's pool and the C library keep it otherwise, in workers that live on."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(f: Callable) -> Callable:
    """An Arrow function of batches that gives freed memory back at the end of its partition."""

    @wraps(f)
    def run(*args):
        yield from f(*args)
        gc.collect()
        give_back()

    return run


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished steps: it does so when the driver collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def drop(df: DataFrame) -> None:
    """Delete the files behind a table that materialise() returned."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        drop_path(df.sparkSession, folder)
