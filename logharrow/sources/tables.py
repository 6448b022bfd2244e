"""Parquet tables between stages, and alert files. All are partitioned by date."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logharrow.functions.segments import date_partition
from logharrow.sources.versions import DatedVersions


def write_by_date(df: DataFrame, path: str, ts_col: str = "timestamp", compression: str = "snappy", rows_per_file: int = 0, source: str | None = None) -> None:
    """Replace the dates that df has. Rows without a time have no date and are left out (dates_missing() counts them).

    If source, the path that df reads, is the same, or the table has been replaced so before, the dates change by a commit
    (see DatedVersions); else their folders are overwritten.
    """
    dated = df.where(F.col(ts_col).isNotNull()).withColumn("date", date_partition(F.col(ts_col)))
    options = {"compression": compression, "maxRecordsPerFile": rows_per_file}
    versions = DatedVersions(df.sparkSession, path)
    if (source and source.rstrip("/") == path.rstrip("/")) or versions.commits():
        versions.replace(dated, **options)
    else:
        dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**options).partitionBy("date").parquet(path)


def dates_missing(df: DataFrame, ts_col: str = "timestamp") -> int:
    return df.where(F.col(ts_col).isNull()).count()


def read_table(spark: SparkSession, path: str, date: str | None = None) -> DataFrame:
    """All dates, or one by partition pruning; files of different schema are merged by name. Of a table with commits, the last one."""
    versions = DatedVersions(spark, path)
    if versions.commits():
        return versions.read(date)
    table = spark.read.option("mergeSchema", "true").parquet(path)
    return table.where(F.col("date") == F.lit(date).cast("date")) if date else table


def write_alerts(alerts: DataFrame, payloads: Callable[[DataFrame], DataFrame], path: str, date: str | None = None) -> bool:
    """JSON lines below path/json and rows below path/parquet, both under date=...; nothing if there are no alerts.

    payloads: a function of the alerts. The rows are written first and read again for the rest, so the plan runs once.
    """
    part, spark = f"date={date or 'unknown'}", alerts.sparkSession
    written = f"{path}/parquet/{part}"
    alerts.write.mode("overwrite").parquet(written)
    stored = spark.read.schema(alerts.schema).parquet(written)
    if stored.isEmpty():
        jpath = spark._jvm.org.apache.hadoop.fs.Path(written)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
        return False
    payloads(stored).write.mode("overwrite").text(f"{path}/json/{part}")
    return True


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by name; columns that a frame lacks are null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
