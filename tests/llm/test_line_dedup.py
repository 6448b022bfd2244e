"""Line dedup against brute force."""

import random

from pyspark.sql import functions as F

from logharrow.llm.lines import line_table, longest_matches, remove_repeated_lines, repeated_runs, suffix_levels


def sequences(rows):
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        out.append((i, t, lines, [k for k, x in enumerate(lines) if x.strip(" ")]))
    return out


def longest(rows):
    """(document number, pos) -> length of the longest run there that also starts earlier."""
    seqs = [[lines[k] for k in at] for _, _, lines, at in sequences(rows)]
    seen, out = set(), {}
    for d, s in enumerate(seqs):
        for p in range(len(s)):
            n = 0
            while p + n < len(s) and tuple(s[p : p + n + 1]) in seen:
                n += 1
            out[(d, p)] = n
            # a run that starts here is earlier for all later places
            for k in range(1, len(s) - p + 1):
                seen.add(tuple(s[p : p + k]))
    return out


def brute(rows, m, chars=None):
    """rows: (id, text) in order; kept texts."""
    match, out = longest(rows), []
    for d, (i, t, lines, at) in enumerate(sequences(rows)):
        gone = set()
        for p in range(len(at)):
            run = at[p : p + match[(d, p)]]
            if run and (len(run) >= m or chars is not None and sum(len(lines[k]) for k in run) >= chars):
                gone.update(run)
        out.append((i, None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in gone), 0 if t is None else len(lines), len(gone)))
    return out


def random_rows(seed, n=60):
    r = random.Random(seed)
    return [(i, "\n".join(r.choice(["a", "b", "c", "d", "", " ", "e f", "g h i j"]) for _ in range(r.randint(0, 25)))) for i in range(n)]


def test_random_lines(docs):
    rows = random_rows(3) + [(100 + i, "\n".join(f"line {k}" for k in range(5 * i, 40))) for i in range(4)]
    for m, chars in ((2, None), (3, 6)):
        got = remove_repeated_lines(docs(rows), m, chars).select("doc_id", "text", "n_lines", "n_removed").collect()
        assert sorted(map(tuple, got)) == sorted(brute(rows, m, chars))


def test_longest_matches_and_maximal_runs(docs):
    """Lengths equal brute force, each source is an earlier copy, and runs are the matches that can't be extended to the left."""
    rows = random_rows(8, 40) + [(50, "\n".join("abcdabcdab")), (51, "\n".join("xabcdabcdaby")), (52, "\n".join("a" * 20))]
    lines = line_table(docs(rows).select(F.struct(F.col("doc_id").alias("id")).alias("doc"), "text"))
    index = {i: d for d, (i, _) in enumerate(rows)}
    seqs = [[x[2][k] for k in x[3]] for x in sequences(rows)]
    want = {k: n for k, n in longest(rows).items() if n}
    found = longest_matches(suffix_levels(lines)).collect()
    got = {(index[r.doc.id], r.pos): r.length for r in found}
    assert got == want and len(found) == len(got)
    for r in found:
        a, b = (index[r.source.doc.id], r.source.pos), (index[r.doc.id], r.pos)
        assert a < b and seqs[a[0]][a[1] : a[1] + r.length] == seqs[b[0]][b[1] : b[1] + r.length]
    runs = {(index[r.doc.id], r.start, r.length) for r in repeated_runs(lines, 2, None)[0].collect()}
    assert runs == {(d, p, n) for (d, p), n in want.items() if n >= 2 and want.get((d, p - 1)) != n + 1}


def test_edges(docs, awkward):
    got = remove_repeated_lines(docs(awkward), 1)
    assert got.columns == [c for c in docs([]).columns if c != "text"] + ["text", "n_lines", "n_removed"]
    texts = {(r.doc_id, r.n_removed): r.text for r in got.collect()}
    assert texts[(2, 0)] is None and texts[(1, 0)] == "" and texts[(5, 1)] == "" and texts[(8, 1)] == "" and texts[(4, 0)] == dict(awkward[3:4])[4]
    assert got.where("doc_id = 6 and n_removed = 0").count() == 2  # equal rows are copies of no earlier row
    assert remove_repeated_lines(docs([])).count() == 0


def test_suffix_order(docs):
    """Ranks are in the order of the lines' hash sequences, and equal exactly for equal prefixes."""
    rows = [(1, "a\nb\na\nb\na"), (2, "b\na\nb\na\nc"), (3, "c\na\nb")]
    cut = docs(rows).select(F.col("doc_id").alias("doc"), "text")
    key = {tuple(r)[:2]: (r.x, r.y) for r in line_table(cut).select("doc", "pos", "x", "y").collect()}
    levels = suffix_levels(line_table(cut))
    assert len(levels) == 3
    ranks = {(r.doc, r.pos): r.rank for r in levels[1].collect()}
    prefix = lambda p: tuple(key[(p[0], p[1] + k)] for k in range(2))
    for p in ranks:
        for q in ranks:
            assert (ranks[p] == ranks[q]) == (prefix(p) == prefix(q))
    assert set(ranks) == {(1, 0), (1, 1), (1, 2), (1, 3), (2, 0), (2, 1), (2, 2), (3, 1)}
    assert {(r.doc, r.pos) for r in levels[2].collect()} == {(1, 1), (2, 0)}
