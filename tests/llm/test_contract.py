"""Contracts of queries that SQL can't express, held against plain recomputation on a small table."""

import zlib

from logharrow.llm import queries as Q

SF = "/root/testdata/sf0.001"


def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_sharding(spark):
    got, docs = Q.op5_sharding(spark, SF).collect(), texts(spark)
    assert {r.doc_id for r in got} == set(docs) and len(got) == len(docs) and {r.law for r in got} == {"rows"}
    assert all((r.size, r.text_crc32) == (len(docs[r.doc_id].encode()) + 1, zlib.crc32(docs[r.doc_id].encode())) and r.grown_shard is None for r in got)
    for shard in range(16):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots))) and len(slots) in (len(docs) // 16, -(-len(docs) // 16))


def test_toxicity_reads_no_held_out_label(spark, tmp_path):
    """Scores stay the same if the labels of held-out rows are turned round."""
    from pyspark.sql import functions as F

    for name in ("documents", "labels"):
        table = spark.read.parquet(f"{SF}/{name}.parquet")
        if name == "labels":
            table = table.withColumn("toxic", F.when(Q.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    plain, turned = ({r.doc_id: (round(r.score, 9), r.held_out, r.predicted) for r in Q.op7_toxicity(spark, sf).collect()} for sf in (SF, str(tmp_path)))
    assert plain == turned and all(h == (zlib.crc32(str(i).encode()) % 5 == 0) and p == (s >= 0.5) for i, (s, h, p) in plain.items())
