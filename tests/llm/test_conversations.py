"""Conversation repair against all edits of small conversations, and against one piece a conversation."""

import hashlib
import itertools
import random
import re

import pytest

from logharrow.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, times int, h1 int, place string, head string, conv string"
WHITE = re.compile(r"[^\x20\x09-\x0D]")


def plain(rows):
    """Report of one conversation from its rows (turn, role, text), by trying states and edits row by row, audits in full."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        full = WHITE.findall(text)
        faults.append("blank" if not full else "duplicate" if (role, text) in seen else "truncated" if full[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    good = re.compile("(s?(ua)+)?")
    # partial results: initials so far (only those that can still be completed) -> least (cost, audit, lines)
    best = {"": (0, "", ())}

    def grown(best):
        """With up to three inserts at this place."""
        for _ in range(3):
            for made, (cost, audit, lines) in list(best.items()):
                for role in ("user", "assistant"):
                    put(best, made + role[0], (cost + 2, audit + "I", (*lines, f"{role}:")))
        return best

    def put(best, made, value):
        made = re.sub("^(s?ua)(ua)+", r"\1", made)  # further pairs change nothing
        if any(good.fullmatch(made + rest) for rest in ("", "a", "ua")) and (made not in best or value < best[made]):
            best[made] = value

    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for made, (cost, audit, lines) in grown(best).items():
            put(after, made, (cost + 3, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                late = fault == "truncated"
                put(after, made + (role[:1] or "?"), (cost + late, audit + "K", (*lines, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    put(after, made + new[0], (cost + 2 + late, audit + "R", (*lines, f"{new}:{text}")))
        best = after
    cost, audit, lines = min(v for made, v in grown(best).items() if good.fullmatch(made))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(table):
    by = {}
    for conv, turn, role, text, times in table:
        rows = by.setdefault(conv, [])
        rows += [(turn, " " if role is None else role, " " if text is None else text)] * (1 if times is None else times)
    return sorted(((c, *plain(rows)) for c, rows in by.items()), key=str)


def frame(spark, table):
    return spark.createDataFrame([(*r, 1, "p", "h", "c") for r in table], SCHEMA).repartition(3)


def draw(r, n_convs, longest, ordinary=0.7):
    out = []
    for c in range(n_convs):
        for t in range(r.randint(1, longest)):
            if r.random() < ordinary:
                out.append((c, t, ("user", "assistant")[t % 2], f"Text {t}.", 1))
            else:
                role = r.choice(["system", "user", "assistant", "tool", "", None, "User", "u"])
                out.append((c, r.choice([t, t, t + 2, None, 0]), role, r.choice(["A.", "b", "", None, " \t", "c!\n", "Text 1."]), r.choice([1, 1, 0, 2, None])))
    r.shuffle(out)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_equals_all_edits(spark, rows, seed):
    table = draw(random.Random(seed), 60, 7, (0.3, 0.7, 0.9)[seed])
    table += [(None, 1, "user", "Hi.", 1), (None, None, "assistant", "Yes.", 1), (901, 5, "user", "gone.", 0), (902, -(2**63), "user", "a.", 1), (902, 2**63 - 1, "assistant", "b.", 1)]
    got = rows(C.repair(frame(spark, table), times_col="times", texts=False))
    want = [(c, min(g, 2**63 - 1), *rest) for c, g, *rest in expected(table)]
    assert got == want


@pytest.mark.parametrize("size", [1, 2, 5])
def test_chunks_change_nothing(spark, rows, monkeypatch, size):
    """Conversations cut into small chunks, which only meet by their end vectors, exits and running hashes."""
    table = draw(random.Random(size), 25, 9, 0.5) + [(500, t, r, x, 1) for t, (r, x) in enumerate([("user", "q."), ("assistant", "x")] * 20 + [("assistant", "z.")] * 15)]
    monkeypatch.setattr(C, "CHUNK_ROWS", size)
    found = C.repair(frame(spark, table), times_col="times")
    assert rows(found.drop("repaired")) == expected(table)
    for r in found.collect():
        assert hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in r.repaired).encode()).hexdigest() == r.repaired_sha256


def test_rerun_stops_where_vectors_agree():
    """A rerun from any end vector gives what a whole run gives."""
    r = random.Random(5)
    vectors = [C.END, (0, 0, 0, 0), (4, 2, 0, 2), (0, 2, 0, 2), (3, 3, 2, 0)]
    for _ in range(300):
        codes = bytes(r.choice([0, 1, 3, 3, 4, 5, 5, 6, 7]) for _ in range(r.randint(0, 30)))
        a, b = r.choice(vectors), r.choice(vectors)
        start, total, _ = C.backward(codes, a)
        assert C.rerun(codes, a, b, start, total) == C.backward(codes, b)[:2]


def test_steps_against_paths():
    """Costs to go of up to four rows against every string of edits."""
    for codes in itertools.product([0, 1, 3, 4, 5, 7], repeat=3):
        start, total, _ = C.backward(bytes(codes), C.END)
        for state in range(4):
            assert start[state] + total == _cheapest(codes, state)


def _cheapest(codes, state, inserts=3):
    if not codes:
        done = 0 if state in (0, 3) else 99
    else:
        done = 3 + _cheapest(codes[1:], state)
        if codes[0]:
            kind, cut = divmod(codes[0] - 1, 2)
            to = C.KEPT.get((state, "sua "[kind]))
            if to is not None:
                done = min(done, cut + _cheapest(codes[1:], to))
            done = min(done, 2 + cut + _cheapest(codes[1:], C.NEXT[state]))
    return min(done, 2 + _cheapest(codes, C.NEXT[state], inserts - 1)) if inserts else done


def test_empty(spark, rows):
    assert rows(C.repair(frame(spark, []), times_col="times")) == []
    got = rows(C.repair(frame(spark, [(1, 1, "user", "x.", 0)]), times_col="times", texts=False))
    assert got == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
