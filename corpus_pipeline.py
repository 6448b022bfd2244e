"""Training-data pipeline over the documents table: each stage reads all that its predecessor kept.

Every stage takes the documents' columns and returns them (the last one: pieces of sequences); further columns, whatever
their names, are dropped. Null and empty texts, repeated rows and repeated or null ids stay rows of their own, and rows
of one id are told apart by their text. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logharrow.llm.decontamination import mark
from logharrow.llm.lines import remove_repeated_lines
from logharrow.llm.packing import pack, tokenise
from logharrow.llm.queries import vocabulary
from logharrow.llm.scratch import clear, materialise
from logharrow.llm.scratch import mark as scratch_mark
from logharrow.llm.simhash import similar_rows
from logharrow.llm.toxicity import fit, score

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
REJECT_FROM = 0.5
#: Line dedup: repeated runs of so many lines, or of so many characters.
MIN_LINES, MIN_CHARS = 2, 50
#: Near-duplicates: Jaccard similarity of the sets of five-word shingles.
SHINGLE_WORDS, SIMILARITY = 5, 0.8


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of REJECT_FROM or more go. Labels of ids that occur twice count once for each row."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model, score_col="toxicity").where(F.col("toxicity") < REJECT_FROM).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go from the texts; all documents stay, a copied one with an empty text."""
    return remove_repeated_lines(docs, MIN_LINES, MIN_CHARS).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the least id stays. Rows equal in id and text stay or go together; texts without words are one group."""
    found = similar_rows(docs.select(*COLUMNS), SHINGLE_WORDS, SIMILARITY)
    gone = materialise(found.select(F.col("doc_id").alias("gone_id"), F.col("h").alias("gone_h")), "near-duplicates")
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.xxhash64("text") == F.col("gone_h"))  # a null text has a hash as well
    return docs.select(*COLUMNS).join(gone, same, "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, re-parameterised or not, go."""
    return mark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("n_items = 0").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 token ids: doc_id, start, length, ids, doc_tokens, sequence_id, offset."""
    return pack(tokenise(docs, vocabulary("word_bpe_49k.json"), end_id=2), width=4096)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("simhash_near_dedup", near_dedup), ("decontamination", decontamination), ("packing", packing)]

#: The score is a fitted model's, which SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the scratch folder and read again; what a stage wrote besides is deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before = scratch_mark()
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        clear(spark, before, keep=docs)
    return STAGES[-1][1](spark, docs, sf_dir)
