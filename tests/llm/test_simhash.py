"""SimHash near-duplicates against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from logharrow.llm import simhash as S
from logharrow.llm.components import components


def brute(ids, fps, more, distance, in_all):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, f, m in zip(ids, fps, more):
        for j, g, n in zip(ids, fps, more):
            d = (f ^ g).bit_count()
            if d <= distance and d + (m ^ n).bit_count() <= in_all and find(i) != find(j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("distance,blocks,in_all", [(4, 3, 4), (4, 2, 4), (9, 5, 19), (7, 4, 7)])
def test_links_lose_nothing(spark, distance, blocks, in_all, monkeypatch):
    r = random.Random(distance)
    seeds = [(r.getrandbits(64), r.getrandbits(64)) for _ in range(25)]
    flip = lambda x, k: x ^ sum(1 << b for b in r.sample(range(64), k))
    pairs = list(dict.fromkeys((flip(f, r.randint(0, distance)), flip(m, r.randint(0, 8)) if in_all > distance else 0) for f, m in seeds for _ in range(12)))
    ids = r.sample(range(10_000), len(pairs))
    signed = lambda x: int(np.uint64(x).view(np.int64))
    want = brute(ids, [f for f, _ in pairs], [m for _, m in pairs], distance, in_all)
    nodes = spark.createDataFrame([(i, signed(f), signed(m)) for i, (f, m) in zip(ids, pairs)], "node long, fp long, more long").repartition(3)
    for hot in (20_000, 6):  # all anchors whole, then the full ones split into tiles
        monkeypatch.setattr(S, "HOT_ANCHOR", hot)
        got = {x.node: x.root for x in components(S.near_links(nodes, distance, in_all, blocks)).collect()}
        assert {i: got.get(i, i) for i in ids} == want


def test_texts(docs, prose, awkward):
    base = prose(300, 3)
    rows = awkward + [(100 + i, base.upper() if i == 1 else base + " tail" * (i % 3)) for i in range(6)]
    got = S.simhash_components(docs(rows)).collect()
    assert len(got) == len(rows)
    fps = {r.doc_id: r.fp for r in got}
    for i, t in rows:
        words = (t or "").encode().lower().split()
        assert i is None or fps[i] == int(np.uint64(S.simhash(S.shingle_hashes((t or "").encode(), 4))).view(np.int64)) and (words or fps[i] == 0)
    comp = {r.doc_id: r.component_id for r in got}
    assert comp[1] == comp[2] == comp[3] == 1 and comp[5] == 4 and comp[8] == 7 and comp[6] == comp[9] == 6 and comp[None] is None
    assert all(comp[100 + i] == 100 for i in (0, 3))
    assert S.simhash_components(docs([])).count() == 0


def test_shingles():
    import xxhash

    want = [xxhash.xxh64_intdigest(x, 42) for x in (b"a b c d", b"b c d e")]
    assert S.shingle_hashes(b" A  b\tC\nd e", 4).tolist() == want
    assert S.shingle_hashes("É b".encode(), 4).tolist() == [xxhash.xxh64_intdigest("É b".encode(), 42)]
    assert S.simhash(np.array([1, 3, 2], np.uint64)) == 3 and S.simhash(np.array([1, 2], np.uint64)) == 0


def test_components(spark):
    r = random.Random(1)
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    links = chain + star + [(b, a) for a, b in chain[:3]] + [(5, 5)]
    r.shuffle(links)
    got = {x.node: x.root for x in components(spark.createDataFrame([*links, (None, 1)], "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{1000 + i: 1000 for i in range(1, 50)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("crowd", [S.CROWD, 0])
def test_exact_similarity(spark, docs, prose, monkeypatch, crowd):
    """Links are those of similarity 0.8 or more: above it none is lost, below it none is made, and rows of one id stay apart.

    With crowd 0, all that the nearest partners don't settle goes by sketches.
    """
    monkeypatch.setattr(S, "CROWD", crowd)
    monkeypatch.setattr(S, "NEAREST", 1)
    r = random.Random(11)
    rows, want = [], set()
    for k in range(120):
        words = prose(300, 500 + k).split()
        edits = 5 if k % 2 else 9  # each changes 5 of 296 shingles: similarity 0.844 or 0.736
        changed = list(words)
        for at in r.sample(range(10, 290, 6), edits):
            changed[at] = f"other{k}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(changed))]
        if k % 2:
            want.add(2 * k + 1)
    rows += [(1000, prose(50, 1)), (1001, prose(50, 1)), (1001, prose(50, 2)), (None, prose(50, 3)), (None, prose(50, 2))]
    got = [(x.doc_id, x.h) for x in S.similar_rows(docs(rows)).collect()]
    pairs = {i for i, _ in got if i is not None and i < 1000}
    assert not pairs - want and len(pairs) >= 0.97 * len(want)
    assert sorted(str(i) for i, _ in got if i is None or i >= 1000) == ["1001", "None"]
    assert S.similar_rows(docs([])).count() == 0


def test_crowds(spark, docs, prose):
    """A crowd of texts that are not quite similar gives few candidates; pairs that are similar among them are found."""
    r, base, rows = random.Random(3), prose(200, 77).split(), []
    for k in range(260):
        words = list(base)
        for at in r.sample(range(len(words)), 16):
            words[at] = f"w{k}x{at}"
        rows.append((k, " ".join(words)))
        if k % 20 == 0:
            rows.append((1000 + k, " ".join([*words[:-1], "end"])))
    got = {x.doc_id for x in S.similar_rows(docs(rows)).collect()}
    sets = {i: set(S.shingle_hashes(t.encode(), 5).tolist()) for i, t in rows}
    root = {i: i for i in sets}
    ids = sorted(sets)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                a_, b_ = find(a), find(b)
                root[max(a_, b_)] = min(a_, b_)
    assert got == {i for i in ids if find(i) != i} and len(got) >= 13


def _crowd(spark, n=300):
    """Nodes whose two fingerprints lie 9 random bits of 64 from one centre, and their near pairs that surely meet."""
    rng = np.random.default_rng(5)
    codes = [rng.integers(0, 2**63, dtype=np.uint64) ^ np.array([sum(1 << int(b) for b in rng.choice(64, 9, False)) for _ in range(n)], np.uint64) for _ in range(2)]
    nodes = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(zip(*(c.view(np.int64) for c in codes)))], "node long, fp long, more long")
    bits = [np.bitwise_count(c[:, None] ^ c[None]).astype(int) for c in codes]
    near = (bits[0] <= 22) & (sum(bits) <= 36) & (sum(bits) <= 2 * 5 * 2 - 1)
    return nodes.repartition(4), {(a, b) for a, b in np.argwhere(near).tolist() if a < b}, {(a, b) for a, b in np.argwhere((bits[0] <= 22) & (sum(bits) <= 36)).tolist() if a < b}


def test_a_pair_among_sketches_is_given_once(spark):
    nodes, sure, near = _crowd(spark)
    given = S.near_links(nodes, 22, 36, 5, 9).collect()
    once = S.near_links(nodes.withColumn("sketch", F.expr("cast(repeat('x', 256) as binary)")), 22, 36, 5, 9).collect()
    assert len(given) > 2 * len(once) and {tuple(r) for r in given} == {tuple(r) for r in once}
    assert len(once) == len(set(once)) and sure <= {tuple(r) for r in once} <= near


def test_marks_of_a_crowd_grow_with_it_and_lose_no_pair(spark):
    nodes, _, _ = _crowd(spark)
    met = {tuple(r) for r in S.near_links(nodes, 22, 36, 5, 9).collect()}
    first = S.near_links(nodes, 22, 36, 5, 9, 2, 8).where("a = b").collect()
    dense = {r.a for r in first}
    flagged = nodes.withColumn("dense", F.col("node").isin(list(dense)).cast("long"))
    found = S.near_links(flagged, 22, 36, 5, 9, None, 8).collect()
    marks, pairs = [r for r in found if r.a == r.b], {tuple(r) for r in found if r.a < r.b}
    crowded = dense | {r.a for r in marks}
    assert len(first) <= 10 * nodes.count() and sum(r.a in dense for r in marks) <= 10 * len(dense)
    assert all(p in pairs or set(p) <= crowded for p in met)


def test_a_crowd_meets_by_its_sketches_on_few_rows(spark, monkeypatch):
    """24 rows a node, where anchors take over 80; every pair of near sketches that agrees in a byte is given, once, with tiles or without."""
    nodes, _, near = _crowd(spark)
    rng = np.random.default_rng(6)
    centre = rng.integers(0, 256, 256, dtype=np.uint8)
    sketches = [np.bitwise_xor(centre, np.packbits(rng.random(2048) < 0.08)).tobytes() for _ in range(nodes.count())]
    there = nodes.join(spark.createDataFrame(list(enumerate(map(bytearray, sketches))), "node long, sketch binary"), "node")
    codes = np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, 256)
    apart = [int(np.bitwise_count(codes[a] ^ codes[b]).sum()) for a, b in near]
    meet = [bool((codes[a, : S.BANDS] == codes[b, : S.BANDS]).any()) for a, b in near]
    want = sorted(p for p, d, m in zip(near, apart, meet) if d <= S.SKETCH_DISTANCE and m)
    alike = [m for d, m in zip(apart, meet) if d <= 310]
    assert len(want) > 100 and sum(alike) >= 0.998 * len(alike)
    _, _, homes = S.bands_of(codes.copy().view(np.uint64), S.BANDS)
    anchors = sum(len(S.anchors(np.array([r[c] for r in nodes.collect()], np.int64).view(np.uint64), 9, 5)[0]) for c in ("fp", "more"))
    assert len(homes) == S.BANDS * len(codes) and 3 * len(homes) < anchors
    for hot in (20_000, 40):
        monkeypatch.setattr(S, "HOT_ANCHOR", hot)
        assert sorted(tuple(r) for r in S.near_links(there, 22, 36, 5, 9, bands=S.BANDS).collect()) == want


@pytest.mark.parametrize("words", [1, 1 << 18])
def test_filter_of_texts_loses_none(spark, words, monkeypatch):
    """Rows with null keys and repeated rows pass as others do; a full filter lets all pass."""
    monkeypatch.setattr(S, "FILTER_WORDS", words)
    rows = spark.createDataFrame([(i if i % 7 else None, i * i, "x") for i in [*range(2000), 14]], "i long, j long, text string")
    wanted = rows.where("j % 10 = 6").select(F.col("i").alias("doc_id"), F.col("j").alias("h"))
    got = S.may_be_among(rows, ["i", "j"], wanted, ["doc_id", "h"])
    assert got.columns == ["i", "j", "text"]
    passed = sorted(((r.i, r.j) for r in got.collect()), key=str)
    needed = sorted(((r.i, r.j) for r in rows.where("j % 10 = 6").collect()), key=str)
    assert not set(needed) - set(passed) and passed.count((None, 196)) == needed.count((None, 196)) == 2
    assert len(passed) == 2001 if words == 1 else len(passed) <= len(needed) + 5
    assert S.may_be_among(rows, ["i", "j"], wanted.limit(0), ["doc_id", "h"]).count() == 0


def test_first_look_sends_each_class_to_its_own_anchors_only(spark, docs, prose, monkeypatch):
    """The first of the two comparisons takes ten rows a class, the second all anchors."""
    reaches, links = [], S.near_links
    monkeypatch.setattr(S, "near_links", lambda nodes, *args, **more: (reaches.append(args[3]), links(nodes, *args, **more))[1])
    assert S.similar_rows(docs([prose(60, k) for k in range(20)])).count() == 0
    assert reaches == [0, S.REACH]
    fps = np.arange(100, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert len(S.anchors(fps, 0, 5)[0]) == 500 and len(S.anchors(fps, S.REACH, 5)[0]) > 4000


def test_unlike_texts_do_not_meet(spark, docs, prose, monkeypatch):
    """At anchors of the fingerprints each of n unlike texts met some n / 9 others, so comparisons grew with the square of the corpus."""
    seen, links = [], S.near_links
    monkeypatch.setattr(S, "near_links", lambda nodes, *args, **more: (seen.append(nodes), links(nodes, *args, **more))[1])
    texts = [prose(60, k) for k in range(300)]
    assert S.similar_rows(docs([*texts, texts[7] + " end"])).count() == 1
    for nodes in seen:
        _, keys, homes = S.groups_of(np.frombuffer(b"".join(r.least for r in nodes.select("least").collect()), np.uint64).reshape(-1, S.MEETINGS))
        n = np.unique(keys, return_counts=True)[1]
        assert len(keys) == 301 * S.MEETINGS and homes.all() and (n * (n - 1)).sum() < 2 * S.MEETINGS + 50


def test_least_hashes_meet_by_similarity():
    """Sets of similarity 0.8 share a number in all but 0.02 %, of 0.1 hardly ever; order and length make no difference."""
    rng = np.random.default_rng(9)
    shared = lambda inner, outer: [np.any(S.least_hashes(np.concatenate((x[:inner], x[inner : inner + outer]))) == S.least_hashes(np.concatenate((x[:inner], x[inner + outer :])))) for x in (rng.integers(0, 2**64, inner + 2 * outer, np.uint64) for _ in range(1500))]
    assert sum(shared(160, 20)) >= 1497 and sum(shared(20, 90)) <= 15
    long = rng.integers(0, 2**64, 10_000, np.uint64)
    assert (S.least_hashes(long) == S.least_hashes(long[::-1])).all() and len(S.least_hashes(long[:0])) == S.MEETINGS
