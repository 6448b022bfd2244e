"""Toxicity: noisy-channel deobfuscation, then a score of the restored text.

A character language model (interpolated 4-grams) is counted over the whole corpus. A token that looks obfuscated
(signs or digits among letters, repeated letters, letters spaced out) becomes a lattice: each character may stand for
itself, for a letter that it resembles, or for nothing if it separates or repeats; a blank between spaced letters may also
stay, as the end of a word. Viterbi decoding finds the likeliest letters under channel costs and the language model. The
score is a logistic regression over restored words and their beginnings, fitted on labelled rows that are not held out.
All features are hashed into one space of fixed size; the penalty alone decides which of them matter.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logharrow.llm.scratch import give_back, lean
from logharrow.llm.words import byte_batches

#: What a sign or digit may stand for. Fixed values.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i"}
SEPARATORS = set(".-_*~^'`/\\:,;#%&=​‌‍\xad ")
#: Grams of a batch of texts that are numbered at once.
GRAMS_AT_ONCE = 1 << 18
#: Channel costs in nats: a lookalike, a dropped separator, a dropped repeat, a blank that stays between spaced letters.
COST_LOOKALIKE, COST_SEPARATOR, COST_REPEAT, COST_BLANK = 0.7, 0.3, 0.4, 1.0
#: Nats by which a doubled letter must surprise the language model to be taken for an obfuscation: an unknown letter has some four.
DOUBLED = 3.0
#: Character classes of the language model: boundary, a-z, any other letter.
CLASSES = 28
#: Bound of the classifier: labelled rows that it is fitted on. Size of the space that features are hashed into.
TRAINING_ROWS, SPACE = 6_000, 1 << 17
BEGINNINGS = (3, 4, 5, 6, 8)
CACHE_ENTRIES = 150_000
#: Of the fit: rounds, step, weight of the squared weights, and the deviation at which a feature is half trusted.
ROUNDS, STEP, PENALTY, DOUBT = 80, 0.08, 1.0, 6.0
#: Entries that the fit looks at together.
ENTRIES = 1 << 19
#: Three or more single characters in a row, and white space that surely ends a word between them.
SPACED, WIDE = re.compile(r"(?<!\S)(?:\S\s+){2,}\S(?!\S)"), re.compile(r"\s{2,}|[^\S ]")
EDGES = "".join(sorted({chr(i) for i in range(33, 127) if not chr(i).isalnum()} - set("@$!|+(")) ) + "¡¿«»“”„‘’…–—"
PLAIN = re.compile(r"[^\W\d_]+", re.UNICODE)
RUN, DOUBLE = re.compile(r"(.)\1\1"), re.compile(r"(.)\1")


def char_class(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0


def add_grams(total: np.ndarray, texts: list[bytes]) -> None:
    """Count the 4-grams of these texts; GRAMS_AT_ONCE at a time, as a gram's number takes eight bytes and more on the way."""
    fold = np.zeros(256, np.uint8)
    fold[97:123] = fold[65:91] = np.arange(1, 27)
    fold[192:256] = 27  # a letter's first byte above ASCII stands for it; bytes that follow are left out
    raw = np.frombuffer(b"   ".join(texts) + b"   ", np.uint8)
    letters = fold[raw[(raw < 128) | (raw >= 192)]]
    for at in range(0, len(letters) - 3, GRAMS_AT_ONCE):
        c = letters[at : at + GRAMS_AT_ONCE + 3].astype(np.int64)
        np.add.at(total, ((c[:-3] * CLASSES + c[1:-2]) * CLASSES + c[2:-1]) * CLASSES + c[3:], 1)


def count_grams(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of character 4-grams over all rows; CLASSES^4 numbers, whatever the size of the input."""

    def scan(batches):
        import pyarrow as pa

        total = np.zeros(CLASSES**4, np.int64)
        for _, texts in byte_batches(batches, "text"):
            add_grams(total, texts)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])

    summed = df.select(F.col(text_col).alias("text")).mapInArrow(lean(scan), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CLASSES**4)
    out[summed.column("gram").to_numpy()] = summed.column("n").to_numpy()
    return out


def log_model(counts: np.ndarray, mass: float = 5.0) -> np.ndarray:
    """log P(c4 | c1 c2 c3): each order is smoothed with `mass` pseudo-counts from the order below."""
    four = counts.reshape((CLASSES,) * 4)
    p = np.full(CLASSES, 1 / CLASSES)
    for grams in (four.sum((0, 1, 2)), four.sum((0, 1)), four.sum(0), four):
        p = (grams + mass * p) / (grams.sum(-1, keepdims=True) + mass)
    return np.log(p).astype(np.float32).ravel()


def decode(token: str, logp: np.ndarray) -> str:
    """Viterbi: the likeliest letters behind a token. State: the last three classes; ties go to the first found."""
    token = token.lower()
    # a path is (cost, its last letter and the path before it), so that long tokens cost no copies
    best: dict[tuple[int, int, int], tuple[float, tuple | None]] = {(0, 0, 0): (0.0, None)}
    for i, c in enumerate(token):
        options: list[tuple[str, float]] = []
        if c.isalpha():
            options.append((c, 0.0))
            if i and token[i - 1] == c:
                options.append(("", COST_REPEAT))
        options += [(x, COST_LOOKALIKE) for x in LOOKALIKES.get(c, "")]
        if c in LOOKALIKES and i and token[i - 1] == c:
            options.append(("", COST_REPEAT))
        if c == " ":
            options.append((" ", COST_BLANK))
        if c in SEPARATORS or not options:
            options.append(("", COST_SEPARATOR))
        after: dict[tuple[int, int, int], tuple[float, tuple | None]] = {}
        for (x, y, z), (cost, path) in best.items():
            for letter, price in options:
                if letter:
                    k = char_class(letter)
                    state, total, longer = (y, z, k), cost + price - float(logp[((x * CLASSES + y) * CLASSES + z) * CLASSES + k]), (letter, path)
                else:
                    state, total, longer = (x, y, z), cost + price, path
                if state not in after or total < after[state][0]:
                    after[state] = (total, longer)
        best = after
    ended = [(cost - float(logp[((x * CLASSES + y) * CLASSES + z) * CLASSES]), path) for (x, y, z), (cost, path) in best.items()]
    path, letters = min(ended, key=lambda e: e[0])[1], []
    while path is not None:
        letter, path = path
        letters.append(letter)
    return "".join(reversed(letters))


def restore(token: str, logp: np.ndarray) -> str:
    """A token's word in lower case: plain tokens as they are, obfuscated ones decoded, others empty."""
    core = token.strip(EDGES)
    if PLAIN.fullmatch(core):
        return core.lower() if not RUN.search(core.lower()) else decode(core, logp)
    core = core if any(c in LOOKALIKES for c in core) else core.strip("!|+(")
    bare = core.rstrip("!$|+(").lstrip("!|+(")
    if PLAIN.fullmatch(bare) and len(core) - len(bare) > 1:
        return restore(bare, logp)
    return decode(core, logp) if any(c.isalpha() for c in core) or "@" in core or "$" in core else ""


def features(word: str) -> list[int]:
    """Numbers in the feature space of a word and of its beginnings."""
    return [zlib.crc32(f.encode()) % SPACE for f in (word + "$", *(word[:n] for n in BEGINNINGS if len(word) >= n))] if word else []


def surprise(word: str, logp: np.ndarray) -> float:
    """-log P of a word's letters under the language model."""
    k = [0, 0, 0, *map(char_class, word), 0]
    return -sum(float(logp[((k[i] * CLASSES + k[i + 1]) * CLASSES + k[i + 2]) * CLASSES + k[i + 3]]) for i in range(len(word) + 1))


def token_features(token: str, logp: np.ndarray) -> tuple[int, ...]:
    """Features of a token's word; where doubled letters surprise by more than DOUBLED each, also those of the likeliest word."""
    word = restore(token, logp)
    out = features(word)
    bare = DOUBLE.sub(r"\1", word)
    if len(bare) < len(word) and surprise(word, logp) - surprise(bare, logp) > DOUBLED * (len(word) - len(bare)):
        single = decode(word, logp)
        out += features(single) if single != word else []
    return tuple(out)


def spaced_words(text: str, logp: np.ndarray) -> list[str]:
    """Words behind single characters in a row; a wide gap ends a word, a single blank may."""
    runs = (part for m in SPACED.finditer(text) for part in WIDE.split(m.group()))
    return [w for part in runs if len(part) > 1 for w in decode(part, logp).split()]


@dataclass
class ToxicityModel:
    logp: np.ndarray
    weights: np.ndarray
    bias: float
    cache: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def hits(self, text: str) -> tuple[list[int], int]:
        """Numbers of the features that occur, with repeats, and the text's tokens."""
        tokens, cache, found = text.split(), self.cache, []
        for t in tokens:
            got = cache.get(t)
            if got is None:
                if len(cache) > CACHE_ENTRIES:
                    cache.clear()
                got = token_features(t, self.logp)
                if len(t) <= 64:
                    cache[t] = got
            found += got
        for word in spaced_words(text, self.logp):
            found += features(word)
        return found, len(tokens)

    def score(self, text: str) -> float:
        at, often = inputs(*self.hits(text))
        z = float(self.weights[0, at].sum() + self.weights[1, at] @ often) + self.bias
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def inputs(found: list[int], tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers, and how often each occurs in a hundred words, damped."""
    at, n = np.unique(np.array(found, np.int32), return_counts=True)
    return at, np.log1p(100 * n / max(tokens, 1)).astype(np.float32)


def _fit(row: np.ndarray, at: np.ndarray, often: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression with an L2 penalty by Adam. Entry k: row[k] has feature at[k], in presence and in often[k].

    Each feature is scaled by how surely it goes with a label, z^2 / (z^2 + DOUBT^2), z being the deviation of its toxic rows
    from their expected number in standard deviations. So the penalty is the heavier the less a feature has shown.
    """
    n, size, share = len(y), SPACE, y.mean()
    parts = [slice(i, i + ENTRIES) for i in range(0, len(at), ENTRIES)]  # so that no array of the size of all entries is made
    seen, toxic = np.zeros(size), np.zeros(size)
    for p in parts:
        seen += np.bincount(at[p], minlength=size)
        toxic += np.bincount(at[p], y[row[p]], size)
    z = (toxic - share * seen) ** 2 / np.maximum(seen * share * (1 - share), 1e-9)
    trust = z / (z + DOUBT**2)
    w, b = np.zeros((2, size)), math.log((y.sum() + 1) / (n - y.sum() + 1))
    m, v = np.zeros((2, size)), np.zeros((2, size))
    mb = vb = 0.0
    for t in range(1, ROUNDS + 1):
        z, (present, rate) = np.full(n, b), w * trust
        for p in parts:
            z += np.bincount(row[p], present[at[p]] + rate[at[p]] * often[p], n)
        miss = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g = PENALTY * w
        for p in parts:
            far = miss[row[p]]
            g[0] += np.bincount(at[p], far, size) * trust
            g[1] += np.bincount(at[p], far * often[p], size) * trust
        g /= n
        gb = miss.sum() / n
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        scale = lambda m, v: STEP * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - scale(m, v), b - scale(mb, vb)
    return (w * trust).astype(np.float32), float(b)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Count the language model over all docs and fit the classifier on at most TRAINING_ROWS of `labels`.

    labels: id_col and label_col (0 or 1); rows with a null are left out, and of a repeated id the greatest label holds. The
    sample is the TRAINING_ROWS least ids by hash, so it is the same on each run. Without labelled texts of both kinds, scores
    are the labels' base rate (one half without any).
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    logp = log_model(count_grams(docs))
    picked = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).dropna()
    picked = picked.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAINING_ROWS)
    size = picked.agg(F.count_if(F.col("y") > 0).alias("yes"), F.count_if(F.col("y") <= 0).alias("no")).first()
    model = ToxicityModel(logp, np.zeros((2, SPACE), np.float32), math.log((size["yes"] + 1) / (size["no"] + 1)))
    sample = docs.join(F.broadcast(picked), "doc_id").select("doc_id", "text", "y").where("text is not null")  # 12 bytes a row
    partial = spark.sparkContext.broadcast(model)

    def vectors(batches):
        import pyarrow as pa

        for batch in batches:
            rows = [inputs(*partial.value.hits(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.list_(pa.float32())), batch.column("y")], ["doc_id", "at", "often", "y"])

    # bounded: TRAINING_ROWS x the distinct features of a text, 8 bytes each; in the order of ids, so that sums are the same on each run
    got = sample.mapInArrow(lean(vectors), "doc_id long, at array<int>, often array<float>, y int").toArrow().sort_by("doc_id")
    at, often = (got.column(c).combine_chunks() for c in ("at", "often"))  # flat arrays, never a Python object an entry
    row = np.repeat(np.arange(len(got), dtype=np.int32), at.value_lengths().to_numpy())
    y = (got.column("y").to_numpy() > 0).astype(float)
    if 0 < y.sum() < len(y):  # of the labels that have a text
        model.weights, model.bias = _fit(row, at.flatten().to_numpy(), often.flatten().to_numpy(), y)
    del got, at, often
    give_back()  # some hundred MB of the driver that no later step needs
    model.cache.clear()
    return model


def score(df: DataFrame, model: ToxicityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns of df and the score of each text (0 to 1), replacing a column of that name.

    Null and empty texts get the score of no evidence.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(texts):
        import pandas as pd

        own = shared.value
        out = pd.Series([own.score(t or "") for t in texts], dtype="float64")
        give_back()  # once a batch: a text's arrays are many and short-lived
        return out

    return df.withColumn(score_col, scores(F.col(text_col)))
