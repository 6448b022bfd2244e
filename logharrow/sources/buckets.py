"""Tables bucketed and sorted by join keys, so that two of them meet without a shuffle, whoever reads them later."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from logharrow.sources.versions import Folder

SPEC = "_buckets"


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """Replace the table at path by df's rows, in `buckets` files by the keys' hash, each sorted by the keys.

    The shuffle that a later join would need is made here once. Keys that are a join's whole keys (segment and window, not the
    segment alone) also spread a hot segment over the buckets. The spec is kept beside the files.
    """
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    df.repartition(buckets, *keys).write.format("parquet").mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, as the path was given
    folder, fields = Folder(spark, path), [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    folder.drop(SPEC)
    folder.create(SPEC, json.dumps({"keys": keys, "buckets": buckets, "fields": fields}))


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table that write_bucketed() wrote, with its buckets known to the planner, in this or another session."""
    spec = json.loads(Folder(spark, path).read(SPEC))
    name = f"bucketed_{hashlib.sha256(f'{path} {json.dumps(spec)}'.encode()).hexdigest()[:32]}"
    quoted = lambda names: ", ".join(f"`{n}`" for n in names)
    columns = ", ".join(f"`{n}` {kind}" for n, kind in spec["fields"])
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({quoted(spec['keys'])}) SORTED BY ({quoted(spec['keys'])}) INTO {spec['buckets']} BUCKETS LOCATION '{location}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)
