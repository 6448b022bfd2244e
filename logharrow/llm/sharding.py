"""Sharding: two-pass external shuffle."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logharrow.llm.scratch import materialise

BUCKET_BYTES = 32 << 20
#: Shuffle partitions at most; each has buckets one after the other beyond that.
PARTITIONS = 10_000
#: Rows of one key that weigh more than this part of a bucket are dealt over buckets.
HOT_SHARE = 8


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A uniform permutation of range(n), drawn from the seed and the bucket's number."""
    order = np.arange(n)
    np.random.default_rng([seed, bucket]).shuffle(order)  # swaps each place, from the last, with one up to it
    return order


def _spread_hot_keys(rows: DataFrame, seed: int, bucket_bytes: int) -> DataFrame:
    """Number the rows of very common keys and put the number into their hash; all other rows stay as they are.

    Which of some equal rows gets which number makes no difference, so the layout is the same on any cluster.
    """
    heavy = rows.groupBy("_key").agg(F.sum("_weight").alias("bytes"), F.count("*").alias("n")).where((F.col("n") > 1) & (F.col("bytes") > bucket_bytes // HOT_SHARE))
    heavy = materialise(heavy.select("_key"), "heavy-keys")  # at most HOT_SHARE a bucket
    if heavy.isEmpty():
        return rows
    hot = materialise(rows.join(F.broadcast(heavy), "_key", "left_semi").withColumn("_part", F.spark_partition_id()), "heavy-rows")
    base = hot.groupBy("_key", "_part").agg(F.count("*").alias("n"))
    base = base.select("_key", "_part", (F.sum("n").over(Window.partitionBy("_key").orderBy("_part")) - F.col("n")).alias("base"))
    # a group of one key and one input partition is no larger than that partition
    within = F.row_number().over(Window.partitionBy("_key", "_part").orderBy("_tie"))
    numbered = hot.withColumn("_n", within).join(base, ["_key", "_part"]).withColumn("_key", F.xxhash64(F.lit(seed), "_key", F.col("base") + F.col("_n")))
    return rows.join(F.broadcast(heavy), "_key", "left_anti").unionByName(numbered.select(*rows.columns))


def shuffled_buckets(df: DataFrame, keys: list[str], weight: Column, seed: int, bucket_bytes: int) -> DataFrame:
    """Pass one: scatter rows by a seeded hash of `keys` into buckets of about bucket_bytes, permute each, write them.

    The number of buckets follows from the rows' weights and bucket_bytes alone. Returns the written table: record (struct
    of all input columns), bucket, position.
    """
    total = df.agg(F.sum(weight.cast("long"))).first()[0] or 0
    n = max(-(-int(total) // bucket_bytes), 1)
    key = F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])
    # two more hashes fix the order that the permutation starts from; rows that tie in them have equal keys
    rows = df.select(F.struct("*").alias("record"), key.alias("_key"), F.xxhash64(F.lit(seed + 1), *[F.col(k) for k in keys]).alias("_tie"), F.coalesce(weight.cast("long"), F.lit(0)).alias("_weight"))
    rows = _spread_hot_keys(rows, seed, bucket_bytes)
    parts = min(n, PARTITIONS)
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(n))).repartitionById(parts, F.pmod("_bucket", F.lit(parts)).cast("int"))
    rows = rows.sortWithinPartitions("_bucket", "_key", "_tie").select("record", "_bucket")
    schema = T.StructType([rows.schema["record"], T.StructField("bucket", T.LongType()), T.StructField("position", T.LongType())])

    def permute(batches):
        """One bucket of the partition after the other; only that one is held."""
        import pyarrow as pa

        def done(held, bucket):
            table = pa.Table.from_batches(held)
            order = fisher_yates(len(table), seed, bucket)
            for at in range(0, len(order), 2000):
                part = order[at : at + 2000]
                cut = table.take(pa.array(part))
                cut = cut.append_column("bucket", pa.array(np.full(len(part), bucket))).append_column("position", pa.array(np.arange(at, at + len(part))))
                yield from cut.combine_chunks().to_batches()

        held, now = [], None
        for batch in batches:
            buckets = batch.column("_bucket").to_numpy()
            cuts = [0, *(np.flatnonzero(buckets[1:] != buckets[:-1]) + 1).tolist(), len(buckets)]
            for a, b in zip(cuts, cuts[1:]):
                if a < b:
                    if held and buckets[a] != now:
                        yield from done(held, now)
                        held = []
                    now = int(buckets[a])
                    held.append(batch.slice(a, b - a).select(["record"]))
        if held:
            yield from done(held, now)

    return materialise(rows.mapInArrow(permute, schema), "shards")


def shuffle_to_shards(df: DataFrame, keys: list[str], weight: Column, shards: int = 16, seed: int = 7, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Put rows into shards in a uniformly random order; shard sizes in rows differ by one at most.

    Two-pass external shuffle: seeded hashes of `keys` scatter the rows into memory-sized buckets, a Fisher-Yates
    shuffle permutes each bucket, and the buckets are written. Each row's place in the chain of buckets is its
    rank; rank modulo `shards` is the shard and the quotient the slot, gapless from 0.

    Returns record (struct of all input columns, so that no name can clash), shard int, slot long.
    Null and empty values hash as any value. Rows that are equal in every key column come in any order among each
    other; many of them are spread over buckets. An empty table gives an empty result. A row larger than bucket_bytes has
    a bucket that is as large as that row.
    """
    written = shuffled_buckets(df, keys, weight, seed, bucket_bytes)
    counts = written.groupBy("bucket").count()  # one row a bucket of bucket_bytes
    base = counts.select("bucket", (F.sum("count").over(Window.orderBy("bucket")) - F.col("count")).alias("base"))
    ranked = written.join(F.broadcast(base), "bucket").withColumn("rank", F.col("base") + F.col("position"))
    return ranked.select("record", (F.col("rank") % shards).cast("int").alias("shard"), F.expr(f"rank div {shards}").alias("slot"))
