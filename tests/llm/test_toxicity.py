"""Toxicity: decoding, held-out accuracy, edges."""

import itertools
import random

import pytest

from logharrow.llm import toxicity as T

BAD = ["grumpf", "snark", "vexnol"]


@pytest.fixture(scope="module")
def corpus(prose):
    r = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        words, y = prose(60, i).split(), int(i % 4 == 0)
        for _ in range(3 * y):
            words.insert(r.randrange(60), r.choice(BAD))
        rows.append((i, " ".join(words)))
        labels.append((i, y))
    return rows, labels


@pytest.fixture
def model(spark, docs, corpus):
    return T.fit(docs(corpus[0]), spark.createDataFrame(corpus[1][:300], "doc_id long, toxic int"))


def test_scores_and_decoding(spark, docs, corpus, model, prose):
    got = {r.doc_id: r.score for r in T.score(docs(corpus[0]), model).collect()}
    held = [(got[i] >= 0.5) == bool(y) for i, y in corpus[1][300:]]
    assert sum(held) / len(held) > 0.97
    for hidden in ("gr0mpf", "GRUUUMPF!!", "g r u m p f", "s.n.a.r.k", "$nark", "5nark***", "v3xn0l"):
        word = T.decode(hidden, model.logp) if " " in hidden else T.restore(hidden, model.logp)
        assert word in BAD or hidden == "gr0mpf"
    clean = prose(60, 9999)
    extra = docs([(1, clean + " 5nark v3xn0l $nark"), (2, clean), (3, clean + " s n a r k and v e x n o l and g r u m p f"), (4, None), (5, ""), (6, clean + " 12345 a@b.c !!! ###")])
    again = {r.doc_id: r.score for r in T.score(extra, model).collect()}
    assert T.decode("a s n a r k", model.logp).endswith("snark") and "vexnol" in T.spaced_words("x  v e x\tn o l", model.logp) + T.spaced_words("b  v e x n o l\nto", model.logp)
    assert set(T.features("snark")) <= set(T.token_features("snaark", model.logp)) and len(T.decode("a " * 20_000, model.logp)) < 40_000
    assert again[1] > 0.5 > again[2] and again[3] > 0.5 > again[6] and again[4] == again[5] < 0.5


@pytest.mark.filterwarnings("error::RuntimeWarning")
def test_labels_without_texts(spark, docs):
    """Labels of both kinds, none of a document, or of one kind only: the labels' base rate."""
    label = lambda rows: spark.createDataFrame(rows, "doc_id long, toxic int")
    for labels in ([(900, 1), (901, 0), (902, 0)], [(0, 1), (901, 0), (902, 0)], [(2, 1), (901, 0), (902, 0)]):
        got = T.score(docs(["a text", "", None]), T.fit(docs(["a text", "", None]), label(labels)))
        assert [r.score for r in got.collect()] == pytest.approx([2 / 5] * 3)


@pytest.mark.filterwarnings("error::RuntimeWarning")
def test_edges(spark, docs, awkward):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = T.fit(docs(awkward), none)
    got = T.score(docs(awkward), model)
    assert {r.score for r in got.collect()} == {0.5} and got.columns == [*docs([]).columns, "score"]
    one_kind = T.fit(docs([]), spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, toxic int"))
    assert T.score(docs(["a"]), one_kind).first().score == pytest.approx(2 / 3)


def test_counts_cover_the_corpus(docs):
    counts = T.count_grams(docs(["abcd", "abcd", None])).reshape((T.CLASSES,) * 4)
    assert counts[1, 2, 3, 4] == 2 and T.log_model(counts.ravel()).shape == (T.CLASSES**4,)


def test_decoding_is_optimal(model):
    """Against every path of the lattice, by cost."""
    r = random.Random(9)
    for _ in range(60):
        token = "".join(r.choice("aabkno013$!.- l") for _ in range(r.randint(1, 8)))
        paths, got = list(all_paths(token, model.logp)), T.decode(token, model.logp)
        assert min(c for text, c in paths if text == got) == pytest.approx(min(c for _, c in paths), abs=1e-4)


def all_paths(token, logp):
    """Every path of the lattice: its letters and its cost."""
    token = token.lower()
    columns = []
    for i, c in enumerate(token):
        options = [(c, 0.0)] if c.isalpha() else []
        repeat = i and token[i - 1] == c and (c.isalpha() or c in T.LOOKALIKES)
        options += [(x, T.COST_LOOKALIKE) for x in T.LOOKALIKES.get(c, "")] + ([("", T.COST_REPEAT)] if repeat else []) + ([(" ", T.COST_BLANK)] if c == " " else [])
        columns.append(options + ([("", T.COST_SEPARATOR)] if c in T.SEPARATORS or not options else []))
    for path in itertools.product(*columns):
        text = "".join(x for x, _ in path)
        classes = [0, 0, 0, *map(T.char_class, text), 0]
        yield text, sum(p for _, p in path) - sum(float(logp[((classes[k] * 28 + classes[k + 1]) * 28 + classes[k + 2]) * 28 + classes[k + 3]]) for k in range(len(text) + 1))


def test_grams_are_counted_in_little_memory(monkeypatch):
    """Counts don't depend on how many grams are taken at once, and a batch takes a few bytes for each of its own."""
    import tracemalloc

    import numpy as np

    from logharrow.llm import toxicity as T

    texts = ["Plain words, ünd Ärger 12\n".encode() * 40_000, b"", b"x"] * 2
    want = np.zeros(T.CLASSES**4, np.int64)
    fold = [ord(chr(b).lower()) - 96 if chr(b).isascii() and chr(b).isalpha() else 27 if b >= 192 else 0 for b in range(256)]
    short = [texts[0][:540], b"", b"x"]
    letters = [fold[b] for b in b"   ".join(short) + b"   " if b < 128 or b >= 192]
    for a, b, c, d in zip(letters, letters[1:], letters[2:], letters[3:]):
        want[((a * T.CLASSES + b) * T.CLASSES + c) * T.CLASSES + d] += 1
    for n in (1, 7, 1 << 18):
        monkeypatch.setattr(T, "GRAMS_AT_ONCE", n)
        total = np.zeros(T.CLASSES**4, np.int64)
        T.add_grams(total, short)
        assert (total == want).all()
    tracemalloc.start()
    T.add_grams(total, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 * sum(map(len, texts))
