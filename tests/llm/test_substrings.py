"""Substring dedup against brute force."""

import random
import re

from logharrow.llm.substrings import remove_repeats


def brute(rows, width):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    top = float("inf")
    first = {}
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            first[key] = min(first.get(key, top), top if i is None else i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < (top if i is None else i):
                gone.update(range(k, k + width))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def run(df, width):
    return sorted(map(tuple, remove_repeats(df, width).select("doc_id", "n_words", "n_removed", "kept").collect()), key=str)


def test_random_texts(docs, prose):
    r = random.Random(5)
    parts = [prose(r.randint(20, 90), k) for k in range(12)]
    rows = [(i, r.choice([" ", "\n", " \t"]).join(r.choice(parts) for _ in range(r.randint(1, 4)))) for i in r.sample(range(1000), 70)]
    rows += [(2000, rows[0][1]), (2001, "w " * 300), (2002, "w " * 120)]
    for width in (20, 50):
        assert run(docs(rows), width) == brute(rows, width)


def test_edges(docs, awkward):
    rows = [x for x in awkward if x[0] != 6] + [(None, awkward[3][1])]
    assert run(docs(rows), 50) == brute(rows, 50)
    assert remove_repeats(docs([])).count() == 0


def test_spans(docs, prose):
    shared = prose(60, 9)
    got = remove_repeats(docs([(1, "a b " + shared), (2, "x " + shared + " y " + shared)]), 50).where("doc_id = 2").first()
    assert got.spans == [[1, 61], [62, 122]] and got.kept == "x y"


def test_rows_of_one_id(docs, prose):
    """Rows that share an id (or have none) keep what only another of them repeats."""
    shared, own = prose(70, 3), [prose(80, 40 + k) for k in range(4)]
    rows = [(1, shared), (5, shared), (5, own[0]), (5, own[1] + " " + shared), (None, shared), (None, own[2]), (None, own[3]), (None, own[3]), (6, own[3])]
    assert run(docs(rows), 50) == brute(rows, 50)
