"""Sharding: counts, slots, records and the permutation."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from logharrow.llm.sharding import fisher_yates, shuffle_to_shards


def put(df, shards=16, **more):
    return shuffle_to_shards(df, ["doc_id", "text"], F.octet_length(F.coalesce("text", F.lit(""))) + 1, shards, **more)


def test_whole_and_even(docs, awkward):
    rows = awkward * 9
    got = put(docs(rows), 16, bucket_bytes=200_000).select("record.doc_id", "record.text", "record.bucket", "shard", "slot").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows) and {r.bucket for r in got} == {2}
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in sizes.items())


def test_repeatable_and_seeded(docs):
    df = docs([f"t{i}" for i in range(500)])
    place = lambda seed: {r[0]: (r[1], r[2]) for r in put(df, seed=seed).select("record.doc_id", "shard", "slot").collect()}
    a, b, c = place(7), place(7), place(8)
    assert a == b and a != c
    order = np.array([a[i][1] * 16 + a[i][0] for i in range(500)])
    assert abs(np.corrcoef(order, np.arange(500))[0, 1]) < 0.15


def test_very_common_rows_are_spread(docs):
    """A row that makes up most of the table lies in no single bucket, and the layout doesn't depend on the input's partitions."""
    df = docs([(1, "x" * 100)] * 600 + [(i, f"t{i}") for i in range(2, 50)])
    place = lambda parts: sorted((r[0], r[1], r[2]) for r in put(df.repartition(parts), bucket_bytes=4000).select("record.doc_id", "shard", "slot").collect())
    a = place(2)
    assert a == place(7) and len(a) == 648
    from logharrow.llm.sharding import shuffled_buckets

    sizes = shuffled_buckets(df, ["doc_id", "text"], F.octet_length("text") + 1, 7, 4000).where("record.doc_id = 1").groupBy("bucket").count().collect()
    assert len(sizes) > 10 and max(r["count"] for r in sizes) < 120


def test_few_partitions_give_the_same_layout(docs, monkeypatch):
    """Buckets are what they are however many of them a shuffle partition takes."""
    from logharrow.llm import sharding

    df = docs([(i, f"text {i}" * (i % 7)) for i in range(400)])
    place = lambda: sorted((r[0], r[1], r[2]) for r in put(df, bucket_bytes=600).select("record.doc_id", "shard", "slot").collect())
    many = place()
    monkeypatch.setattr(sharding, "PARTITIONS", 3)
    assert place() == many and len(many) == 400
    held = sharding.shuffled_buckets(df, ["doc_id", "text"], F.octet_length("text") + 1, 7, 600)
    assert held.select("bucket").distinct().count() > 10 and held.groupBy("bucket").agg((F.max("position") + 1 == F.count("*")).alias("gapless")).where("NOT gapless").count() == 0


def test_permutation_is_uniform():
    seen = Counter(tuple(fisher_yates(3, s, 0)) for s in range(3000))
    assert len(seen) == 6 and min(seen.values()) > 400
    assert sorted(fisher_yates(1000, 1, 2)) == list(range(1000)) and len(fisher_yates(0, 1, 2)) == 0


def test_empty(docs):
    assert put(docs([])).count() == 0
