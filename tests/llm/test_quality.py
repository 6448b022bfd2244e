"""Quality classifier: parts against plain recomputation, held-out accuracy, edges."""

import zlib

import numpy as np
import pytest

from logharrow.llm import quality as Q
from logharrow.llm import queries

SF = "/root/testdata/sf0.01"



def test_statistics_of_small_texts():
    found = {s: Q.statistics([t.encode() for t in ("", " \n", "One two. TWO two\n\nOne two.\nx#y 12 ééé")])[:, k] for k, s in enumerate(Q.STATISTICS)}
    assert all(np.isfinite(v).all() for v in found.values())
    third = {k: v[2] for k, v in found.items()}
    # words: One two. TWO two One two. x#y 12 ééé
    assert np.isclose(third["words"], np.log1p(9)) and np.isclose(third["lines"], np.log1p(3)) and np.isclose(third["word_length"], (3 + 4 + 3 + 3 + 3 + 4 + 3 + 2 + 3) / 9)
    assert np.isclose(third["upper_words"], 1 / 9) and np.isclose(third["capital_words"], 3 / 9) and np.isclose(third["marked_words"], 2 / 9) and np.isclose(third["number_words"], 1 / 9)
    assert np.isclose(third["repeated_lines"], 0) and np.isclose(third["distinct_pairs"], 7 / 8) and np.isclose(third["marked_lines"], 1 / 3)
    assert np.isclose(found["repeated_lines"][0], 0) and found["length"][0] == 0


def test_pool_against_brute_force():
    r = np.random.default_rng(1)
    for _ in range(200):
        n = r.integers(1, 9)
        y, w = r.integers(0, 5, n) / 4, r.integers(1, 4, n).astype(float)
        # min-max formula of isotonic regression
        mean = lambda a, b: (y[a : b + 1] @ w[a : b + 1]) / w[a : b + 1].sum()  # noqa: E731, B023
        want = [max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
        assert np.allclose(Q.pool(y, w), want)


def test_sums_equal_whole_matrix(spark):
    """Moments and normal equations over partitions, some of them empty, equal those of one matrix; a large mean keeps its digits."""
    r = np.random.default_rng(2)
    x = (r.standard_normal((300, len(Q.STATISTICS))) + 1000).astype(np.float32)
    y = r.integers(0, 2, 300).astype(float)
    rows = spark.createDataFrame([(i, v.tolist(), float(t)) for i, (v, t) in enumerate(zip(x, y))], "doc_id long, stats array<float>, y double").repartition(17)
    n, mean, deviation = Q.moments(rows)
    assert n == 300 and np.allclose(mean, x.astype(float).mean(0)) and np.allclose(deviation, x.astype(float).std(0), rtol=1e-9)
    model = Q.QualityModel(mean, deviation, r.standard_normal((x.shape[1], 20)), r.uniform(0, 6, 20), np.zeros(21), np.zeros(1), np.zeros(1))
    square, right = Q.normal_equations(rows, model)
    z = model.fourier(x.astype(float))
    assert np.allclose(square, z.T @ z) and np.allclose(right, z.T @ y)


def test_features_approximate_the_kernel():
    r = np.random.default_rng(3)
    width = len(Q.STATISTICS)
    model = Q.QualityModel(np.zeros(width), np.ones(width), r.standard_normal((width, 20_000)) / (1.5 * np.sqrt(width)), r.uniform(0, 2 * np.pi, 20_000), None, None, None)
    x = r.standard_normal((8, width))
    z = model.fourier(x)[:, :-1]
    gauss = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * 1.5**2 * width))
    assert np.abs(z @ z.T - gauss).max() < 0.05


def test_held_out_accuracy(spark):
    got = queries.op12_quality_classifier(spark, "/root/testdata/sf0.1").collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    assert len(got) == spark.read.parquet("/root/testdata/sf0.1/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in got)
    held = [(r.predicted, label[r.doc_id]) for r in got if r.held_out and r.doc_id in label]
    assert np.mean([p == y for p, y in held]) > 0.97 and np.mean([p for p, y in held if y]) > 0.98


def test_held_out_labels_are_not_read(spark, tmp_path):
    from pyspark.sql import functions as F

    for name in ("documents", "labels"):
        rows = spark.read.parquet(f"{SF}/{name}.parquet")
        if name == "labels":
            rows = rows.withColumn("quality", F.when(queries.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    plain, turned = ({r.doc_id: round(r.score, 9) for r in queries.op12_quality_classifier(spark, sf).collect()} for sf in (SF, str(tmp_path)))
    assert plain == turned


@pytest.mark.filterwarnings("error::RuntimeWarning")
def test_edges(spark, docs, awkward, rows):
    stats = Q.document_statistics(docs(awkward))
    label = lambda pairs: spark.createDataFrame(pairs, "doc_id long, quality int")
    score = lambda labels: [r.score for r in Q.with_score(stats, Q.fit(stats, labels)).collect()]
    assert set(score(label([]))) == {0.5 * (1 - Q.ORDER_WEIGHT)}
    assert len(set(score(label([(7001, 1), (7002, 0)])))) == 1  # labels that meet no document
    assert len(set(score(label([(1, 1), (4, 1), (None, 0), (2, None)])))) == 1  # one kind only
    found = score(label([(1, 0), (4, 1), (4, 0), (6, 1), (7, 0), (8, 1)]))
    assert len(found) == len(awkward) and all(0 <= s <= 1 for s in found)
    none = Q.document_statistics(docs([]))
    assert Q.with_score(none, Q.fit(none, label([(1, 1)]))).collect() == []
