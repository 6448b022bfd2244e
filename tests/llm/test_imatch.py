"""I-Match fingerprints: neighbours by brute force, equal texts, likeness."""

import hashlib

import numpy as np

from logharrow.llm import imatch as M
from logharrow.llm.imatch import fingerprint_neighbours, fingerprint_texts, lexicon, likeness, read


def edited(t, u):
    n = len(t) // 4
    return t[: len(t) - n] + u[:n]


def test_neighbours(docs, prose):
    rows = [(i * 3, prose(5 + 7 * (i % 13), i % 20)) for i in range(60)] + [(500, ""), (501, None), (502, "x")]
    got = {r.doc_id: r for r in fingerprint_neighbours(docs(rows), range_bytes=4000).collect()}
    texts = [t or "" for _, t in rows]
    for k, (i, _) in enumerate(rows):
        t, u = texts[k], texts[(k + 1) % len(rows)]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited(t, u).encode()).hexdigest()
        assert (got[i].fingerprint == got[rows[(k + 1) % len(rows)][0]].fingerprint) == (t == u)
        assert got[i].near_next == likeness(read(got[i].fingerprint), read(got[rows[(k + 1) % len(rows)][0]].fingerprint))
        assert 0 <= got[i].near_edited <= 1
    same = {}
    for (i, _), t in zip(rows, texts):
        same.setdefault(t, set()).add(got[i].fingerprint)
    assert all(len(s) == 1 for s in same.values())
    long = [i for (i, _), t in zip(rows, texts) if len(t.split()) > 30]
    assert sum(got[i].near_edited for i in long) / len(long) > 0.25 > 0.1 > sum(got[i].near_next for i in long) / len(long)


def test_edges(docs, awkward):
    got = fingerprint_neighbours(docs(awkward)).collect()
    assert sorted((r.doc_id is None, r.n_chars) for r in got) == sorted((i is None, len(t or "")) for i, t in awkward)
    assert fingerprint_neighbours(docs([])).count() == 0
    (one,) = fingerprint_neighbours(docs(["a b c d e f g h"])).collect()
    assert one.near_next == 1.0


def test_text_fingerprints(docs, prose):
    df = docs([prose(80, i) for i in range(20)])
    terms = lexicon(df, 20)
    assert (terms[1:] > terms[:-1]).all()
    assert fingerprint_texts(df, terms).select("fingerprint").distinct().count() == 20


def brute_fingerprint(text, band):
    """Signatures by the docstrings' rules, one term at a time."""
    hashes = {int(M.word_hashes([w.encode()])[0][0]) for w in (text or "").encode().decode().split()}
    mix = lambda x: int(M.mix(np.array([x], np.uint64))[0])
    out = np.zeros((M.LEVELS, M.SUBSETS + M.TAIL), np.uint16)
    for j, seed in enumerate(M.SEEDS.tolist()):
        for k in range(M.LEVELS):
            mine = [y for h in hashes if j >= M.SUBSETS or h in band for y in [mix(h ^ seed)] if min((y & -y).bit_length() - 1 if y else 64, M.LEVELS - 1) >= k]
            if mine:
                low, high = (sum(mix(y) >> s & 0xFFFFFFFF for y in mine) for s in (0, 32))
                out[k, j] = 1 + mix(low ^ mix(high)) % 4095
    return out


def test_fingerprints_by_brute_force(docs, prose):
    texts = [prose(4 + 3 * i, i % 9) for i in range(25)] + ["rare", "", "x y"]
    df = docs(texts)
    words = [set(t.split()) for t in texts]
    frequency = {w: sum(w in ws for ws in words) for ws in words for w in ws}
    band = {int(M.word_hashes([w.encode()])[0][0]) for w, n in frequency.items() if M.LOWEST_SHARE * len(texts) <= n <= max(M.HIGHEST_SHARE * len(texts), 2)}
    terms = lexicon(df, len(texts))
    assert set(terms.tolist()) == band
    for r in fingerprint_texts(df, terms).collect():
        assert (read(r.fingerprint) == brute_fingerprint(texts[r.doc_id], band)).all()


def test_many_rows_of_one_id(docs, prose):
    """Rows without an id are spread over ranges and chained in the order of their hash."""
    rows = [(None, prose(40, i)) for i in range(300)] + [(5, "a"), (6, "b")]
    got = fingerprint_neighbours(docs(rows), range_bytes=3000).collect()
    texts = {hashlib.sha256(edited(t, u).encode()).hexdigest() for _, t in rows for _, u in rows}
    assert len(got) == 302 and {r.edited_sha256 for r in got} <= texts
