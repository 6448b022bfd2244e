"""The pipeline's stages and contract."""

from collections import defaultdict

import corpus_pipeline as C
import pytest

import __spark_entry__ as E
from logharrow.llm.simhash import similar_rows

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [n for n, _ in C.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for _, stage in C.STAGES[:-1]:
        docs = C.materialise(stage(spark, docs, SF), "test-stage")
        assert docs.columns == C.COLUMNS
        counts.append(docs.count())
    assert counts[0] > counts[1] == counts[2] > counts[3] >= counts[4] > 0
    pieces = C.STAGES[-1][1](spark, docs, SF).select("doc_id").distinct()
    assert pieces.count() == counts[4]


def test_stage_edges(spark, docs, awkward):
    """Nulls, empty and very long texts, repeated rows and ids, extra columns with clashing names, and an empty table."""
    odd = docs([*awkward, (6, "another text of row six"), (None, None)]).withColumnsRenamed({"h": "score", "key": "toxicity", "rank": "gone_id"})
    kept = {}
    for name, stage in C.STAGES[:-1]:
        got = stage(spark, odd, SF)
        assert got.columns == C.COLUMNS
        kept[name] = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
        assert stage(spark, odd.limit(0), SF).count() == 0
    rows = sorted(((r.doc_id, r.text) for r in odd.collect()), key=str)
    assert kept["toxicity"] == kept["decontamination"] == rows and len(kept["line_dedup"]) == len(rows)
    # of texts without words and of copies one row stays; rows of id 6 that differ are told apart
    assert sum(not (t or "").split() for _, t in kept["simhash_near_dedup"]) == 1
    assert (6, "another text of row six") in kept["simhash_near_dedup"] and [i for i, t in kept["simhash_near_dedup"] if t == awkward[3][1]] == [4]
    pieces = C.packing(spark, odd, SF)
    assert pieces.select("doc_id").distinct().count() == len({i for i, _ in rows}) and C.packing(spark, odd.limit(0), SF).count() == 0


def test_near_duplicates_by_brute_force(spark):
    """Recall over all pairs of distinct texts of sf0.1 at similarity 0.8 or more, and no removal without such a link."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    gone = {r.doc_id for r in similar_rows(docs).collect()}
    first, sets, places = {}, {}, defaultdict(list)
    for r in docs.select("doc_id", "text").orderBy("doc_id").collect():
        words = (r.text or "").encode().lower().split()
        width = min(5, len(words))
        shingles = frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1)) if words else frozenset()
        if shingles in first:
            assert r.doc_id in gone  # equal sets are one class
            continue
        first[shingles] = r.doc_id
        sets[r.doc_id] = shingles
        for s in shingles:
            places[s].append(r.doc_id)
    # a pair of similarity 0.8 shares four fifths of its shingles, so at least one that few texts have is among them
    pairs, linked = set(), set()
    for ids in places.values():
        if 2 <= len(ids) <= 60:
            pairs.update((a, b) for k, a in enumerate(ids) for b in ids[k + 1 :])
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
            linked.add((a, b))
    assert len(linked) > 20
    found = sum(b in gone for _, b in linked)
    assert found >= 0.9 * len(linked), f"{found} of {len(linked)}"
    later = {b for _, b in linked}
    assert all(i in later for i in gone if i in sets)


@pytest.mark.parametrize("name", ["pipeline", *(f"op{k}_" for k in range(1, 11))])
def test_registered(name):
    assert any(n.startswith(name) for n in E.queries()) and set(E.oracle_sql()) <= set(E.queries())
