"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

One scan turns each text into some thirty numbers (shares of kinds of characters, word and line lengths, repetition), which
are written and read from there. cos(W x + b) with Gaussian W approximates a Gaussian kernel over the standardised numbers.
The ridge regression needs only Z'Z and Z'y: every partition sums its own, sums are added in two steps, and the driver gets
at most FOLDED matrices of fixed size, however many rows are labelled. A share of the labelled rows is kept from the
regression and counted by parts of the raw score; pooling adjacent violators over the counts gives the calibration.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logharrow.llm.scratch import materialise
from logharrow.llm.words import byte_batches, window_hashes, word_hashes

#: Fourier features, width of the kernel in standard deviations a statistic, weight of the ridge a row.
FEATURES, WIDTH, RIDGE = 384, 1.5, 1e-3
#: Standardised statistics are cut off here.
BOUND = 6.0
#: One in so many labelled rows calibrates; parts of the raw score that are counted for it.
CALIBRATION_SHARE, PARTS = 5, 1024
#: Partial sums that reach the driver at most.
FOLDED = 8
#: Weight of the raw score beside the calibrated one, so that rows of one step keep an order.
ORDER_WEIGHT = 0.01

STATISTICS = [
    "length", "words", "lines", "upper", "lower", "beyond_ascii", "digits", "sentence_marks", "signs", "brackets", "white", "word_length", "long_words", "single_letters", "upper_words", "capital_words",
    "marked_words", "sign_words", "number_words", "distinct_words", "distinct_pairs", "distinct_fours", "adjacent_repeats", "commonest_word", "word_entropy", "line_length", "repeated_lines", "marked_lines", "byte_entropy", "doubled_signs",
]


def _kinds() -> np.ndarray:
    """A class for each byte: 0 none, 1 upper, 2 lower, 3 lead byte beyond ASCII, 4 digit, 5 sentence mark, 6 sign, 7 bracket or quote, 8 white space, 9 byte that continues."""
    kind = np.zeros(256, np.uint8)
    kind[65:91], kind[97:123], kind[192:256], kind[48:58], kind[128:192] = 1, 2, 3, 4, 9
    for group, chars in ((5, b".,;:!?"), (6, b"#$%&*+/<=>@\\^_`|~-"), (7, b"()[]{}\"'"), (8, b" \t\n\x0b\x0c\r")):
        kind[list(chars)] = group
    return kind


KINDS = _kinds()


def _spread(n: np.ndarray) -> float:
    """Entropy of counts over that of as many equal ones; 1 for one row or none."""
    total = n.sum()
    if total < 2:
        return 1.0
    p = n[n > 0] / total
    return float(-(p * np.log(p)).sum() / np.log(total))


def statistics(texts: list[bytes]) -> np.ndarray:
    """A row of STATISTICS for each text; texts without words have zeros where a share has no base."""
    out = np.zeros((len(texts), len(STATISTICS)))
    hashes, first = word_hashes(texts)
    for t, text in enumerate(texts):
        raw = np.frombuffer(text, np.uint8)
        kind = KINDS[raw]
        n = np.bincount(kind, minlength=10).astype(float)
        chars, dark = max(len(raw) - n[9], 1), max(len(raw) - n[9] - n[8], 1)
        lines = [line for line in text.split(b"\n") if line.strip()]
        row = [np.log1p(len(raw) - n[9]), 0.0, np.log1p(len(lines)), n[1] / max(n[1] + n[2] + n[3], 1), n[2] / dark, n[3] / dark, n[4] / dark, n[5] / dark, n[6] / dark, n[7] / dark, n[8] / chars]
        own = hashes[first[t] : first[t + 1]]
        if len(own):
            gap = np.concatenate(([True], kind == 8, [True]))
            start, end = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:]) - 1
            heads, ends = kind[start], kind[end]
            below = np.concatenate(([0], np.cumsum(kind == 9)))
            length = end - start + 1 - (below[end + 1] - below[start])
            count = lambda k: np.concatenate(([0], np.cumsum(kind == k)))
            inside = lambda c: c[end + 1] - c[start]
            ups, lows = inside(count(1)), inside(count(2))
            many = len(own)
            _, often = np.unique(own, return_counts=True)
            distinct = lambda width: len(np.unique(window_hashes(own, width))) / (many - width + 1) if many >= width else 1.0
            row[1] = np.log1p(many)
            row += [length.mean(), (length > 15).mean(), (length == 1).mean(), ((ups > 1) & (lows == 0)).mean(), (heads == 1).mean(), (ends == 5).mean(), ((ends == 6) | (heads == 6)).mean(), (heads == 4).mean()]
            row += [np.log(len(often)) / np.log(many) if many > 1 else 1.0, distinct(2), distinct(4), (own[1:] == own[:-1]).mean() if many > 1 else 0.0, often.max() / many if many > 9 else 0.0, _spread(often)]
        else:
            row += [0.0] * 14
        if lines:
            row += [np.log1p(np.mean([len(x) for x in lines])), 1 - len(set(lines)) / len(lines), np.mean([KINDS[x.rstrip()[-1]] == 5 for x in lines])]
        else:
            row += [0.0] * 3
        p = np.bincount(raw)
        p = p[p > 0] / max(len(raw), 1)
        doubled = (raw[1:] == raw[:-1]) & (kind[1:] >= 5) & (kind[1:] <= 7)
        row += [float(-(p * np.log2(p)).sum()), doubled.sum() / dark]
        out[t] = row
    return out


def document_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and stats (array of float); a null text is empty. Every row keeps a row."""

    def scan(batches):
        import pyarrow as pa

        for piece, texts in byte_batches(batches, "text"):
            found = statistics(texts).astype(np.float32)
            at = np.arange(0, found.size + 1, found.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.ListArray.from_arrays(at, found.ravel())], ["doc_id", "stats"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(scan, "doc_id long, stats array<float>")


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS)).astype(float)


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    turn: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    #: Knots of the calibration: raw scores in ascending order, and their probabilities.
    raw: np.ndarray
    chance: np.ndarray

    def fourier(self, stats: np.ndarray) -> np.ndarray:
        """Features of rows, and a constant."""
        x = np.clip((stats - self.mean) / self.scale, -BOUND, BOUND)
        z = np.sqrt(2 / len(self.phase)) * np.cos(x @ self.turn + self.phase)
        return np.hstack([z, np.ones((len(x), 1))])

    def raw_score(self, stats: np.ndarray) -> np.ndarray:
        return self.fourier(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        z = self.raw_score(stats)
        return (1 - ORDER_WEIGHT) * np.interp(z, self.raw, self.chance) + ORDER_WEIGHT * np.clip(z, 0, 1)


def pool(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Isotonic regression by pooling adjacent violators: the non-decreasing values nearest in weighted squares."""
    blocks: list[list[float]] = []
    for v, w in zip(value, weight):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, n = blocks.pop()
            u = blocks[-1]
            u[0], u[1], u[2] = (u[0] * u[1] + v * w) / (u[1] + w), u[1] + w, u[2] + n
    return np.repeat([b[0] for b in blocks], [b[2] for b in blocks])


def moments(rows: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number, mean and deviation of each statistic: partitions merge means and squared deviations, which keeps digits."""

    def part(batches):
        import pyarrow as pa

        n, mean, far = 0, np.zeros(len(STATISTICS)), np.zeros(len(STATISTICS))
        for b in batches:
            if len(b):
                x = _matrix(b.column("stats"))
                n, mean, far = _merge((n, mean, far), (len(x), x.mean(0), ((x - x.mean(0)) ** 2).sum(0)))
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([mean.tobytes()]), pa.array([far.tobytes()])], ["n", "mean", "far"])

    def add(batches):
        import pyarrow as pa

        total = (0, np.zeros(len(STATISTICS)), np.zeros(len(STATISTICS)))
        for b in batches:
            for n, mean, far in zip(*(b.column(c).to_pylist() for c in ("n", "mean", "far"))):
                total = _merge(total, (n, np.frombuffer(mean), np.frombuffer(far)))
        yield pa.RecordBatch.from_arrays([pa.array([total[0]]), pa.array([total[1].tobytes()]), pa.array([total[2].tobytes()])], ["n", "mean", "far"])

    schema, total = "n long, mean binary, far binary", (0, np.zeros(len(STATISTICS)), np.zeros(len(STATISTICS)))
    for r in rows.select("stats").mapInArrow(part, schema).repartition(FOLDED).mapInArrow(add, schema).sort("n", "mean").collect():
        total = _merge(total, (r["n"], np.frombuffer(r["mean"]), np.frombuffer(r["far"])))
    n, mean, far = total
    return n, mean, np.sqrt(far / max(n, 1))


def _merge(a: tuple, b: tuple) -> tuple:
    (n, mean, far), (m, other, more) = a, b
    if not n or not m:
        return (m, other, far + more) if not n else (n, mean, far + more)
    gap = other - mean
    return n + m, mean + gap * (m / (n + m)), far + more + gap**2 * (n * m / (n + m))


def normal_equations(rows: DataFrame, model: QualityModel) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y over all rows of stats and y: a matrix a partition, added in FOLDED tasks and then in the driver."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    size = len(model.phase) + 1

    def part(batches):
        import pyarrow as pa

        total = np.zeros((size, size + 1))
        for b in batches:
            if len(b):
                z = shared.value.fourier(_matrix(b.column("stats")))
                total[:, :size] += z.T @ z
                total[:, size] += z.T @ b.column("y").to_numpy(zero_copy_only=False)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["sums"])

    def add(batches):
        import pyarrow as pa

        total = np.zeros(size * (size + 1))
        for b in batches:
            for sums in b.column("sums"):
                total += np.frombuffer(sums.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["sums"])

    folded = rows.select("stats", "y").mapInArrow(part, "sums binary").repartition(FOLDED).mapInArrow(add, "sums binary").collect()
    total = sum((np.frombuffer(r["sums"]) for r in sorted(folded, key=lambda r: r["sums"])), np.zeros(size * (size + 1))).reshape(size, size + 1)
    return total[:, :size], total[:, size]


def fit(stats: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", seed: int = 12) -> QualityModel:
    """Fit on all labelled rows of document_statistics().

    labels: id_col and label_col (0 or 1); rows with a null are left out, and of a repeated id the greatest label holds.
    Labelled ids that no row has count for nothing; an id that several rows have counts for each. Without rows of both
    labels, every score is the base rate (one half without any).
    """
    width = len(STATISTICS)
    draw = np.random.default_rng(seed)
    turn, phase = draw.standard_normal((width, FEATURES)) / (WIDTH * np.sqrt(width)), draw.uniform(0, 2 * np.pi, FEATURES)
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), (F.col(label_col).cast("int") > 0).cast("double").alias("y")).dropna().groupBy("doc_id").agg(F.max("y").alias("y"))
    rows = materialise(stats.join(known, "doc_id").select("doc_id", "stats", "y"), "labelled-statistics")
    counts = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0.0)).alias("yes")).first()
    n, yes = counts["n"], counts["yes"]
    base = (yes + 1) / (n + 2)
    model = QualityModel(np.zeros(width), np.ones(width), turn, phase, np.zeros(FEATURES + 1), np.zeros(1), np.full(1, base))
    if not 0 < yes < n:
        return model
    _, model.mean, deviation = moments(rows)
    model.scale = np.where(deviation > 1e-9, deviation, 1.0)
    calibrates = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(CALIBRATION_SHARE)) == 0
    fitted = rows.where(~calibrates)
    square, right = normal_equations(fitted, model)
    model.weights = np.linalg.solve(square + RIDGE * max(square[-1, -1], 1) * np.diag([*np.ones(FEATURES), 1e-6]) / FEATURES, right)
    # counted by parts of the raw score; with few rows all labelled ones calibrate
    held = rows.where(calibrates) if n >= 20 * CALIBRATION_SHARE else rows
    part = F.least(F.greatest(F.floor((F.col("raw") + 0.5) / 2 * PARTS), F.lit(0)), F.lit(PARTS - 1))
    raw = with_score(held, model, "raw", raw=True)
    seen = sorted(raw.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.sum("y").alias("yes"), F.avg("raw").alias("at")).collect(), key=lambda r: r["part"])
    if not seen:
        return model
    weight = np.array([r["n"] for r in seen], float)
    chance = pool(np.array([r["yes"] for r in seen]) / weight, weight)
    block = np.cumsum(np.concatenate(([0], np.diff(chance) > 0)))
    total, at = np.bincount(block, weight), np.bincount(block, weight * [r["at"] for r in seen])
    hits = np.bincount(block, weight * chance)
    # one row of the base rate beside each step's, so that no score is 0 or 1 for want of rows; straight lines between the steps' means
    model.raw, model.chance = at / total, pool((hits + base) / (total + 1), total)
    return model


def with_score(stats: DataFrame, model: QualityModel, score_col: str = "score", raw: bool = False) -> DataFrame:
    """All columns of a table of stats, and the score of each row."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(values):
        import pandas as pd

        x = np.stack(values.to_numpy()).astype(float) if len(values) else np.zeros((0, len(STATISTICS)))
        return pd.Series(shared.value.raw_score(x) if raw else shared.value.score(x), dtype="float64")

    return stats.withColumn(score_col, scores(F.col("stats")))
