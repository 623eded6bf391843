"""Quality scores: random Fourier features of document statistics, ridge, isotonic calibration.

Random Fourier features approximate a Gaussian kernel over standardised statistics; the ridge
fit needs only sums over training rows (the normal equations), which tasks form for their own
rows and Spark adds up; pool-adjacent-violators on a histogram of held-back scores turns them
into probabilities.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.llm.common import map_texts, remainder, written

_SYMBOLS = np.frombuffer(b"#*$%&|<>@^~_=+\\/{}[]", np.uint8)
_MARKS = np.frombuffer(b".,;:!?'\"()-", np.uint8)

STATISTICS = (
    "log_bytes", "log_words", "mean_word", "spread_word", "longest_word", "short_words", "upper", "digits", "symbols",
    "marks", "commas_stops", "exclaims", "bars", "non_ascii", "spaces", "entropy", "distinct", "top_word", "distinct_pairs",
    "line_words", "dup_lines", "marked_words", "capital_words", "plain_words", "same_next",
)


def statistics(text: str | None) -> list[float]:
    """Statistics of a whole text, each of moderate size; an empty text has zeros."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(data)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    lengths = np.fromiter(map(len, words), np.int64, n)
    shares = counts[counts > 0] / size
    letters = counts[65:91].sum() + counts[97:123].sum()
    lines = [x for x in data.split(b"\n") if x.strip()]
    kinds = Counter(words)
    return [
        np.log1p(size), np.log1p(n), float(lengths.mean()), float(lengths.std()), np.log1p(lengths.max()), float((lengths <= 3).mean()),
        counts[65:91].sum() / max(1, letters), counts[48:58].sum() / size, counts[_SYMBOLS].sum() / n, counts[_MARKS].sum() / n,
        (counts[44] + counts[46]) / n, counts[33] / n, counts[124] / n, counts[128:].sum() / size, counts[[9, 10, 11, 12, 13, 32]].sum() / size,
        float(-(shares * np.log2(shares)).sum()), len(kinds) / n ** 0.85, max(kinds.values()) / n, len(set(zip(words, words[1:], strict=False))) / n,
        np.log1p(n / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)), sum(map(_marked, kinds)) / len(kinds),
        sum(1 for w in kinds if 65 <= w[0] <= 90) / len(kinds), sum(map(bytes.isalpha, kinds)) / len(kinds),
        sum(map(operator.eq, words, words[1:])) / n,
    ]


def _marked(word: bytes) -> bool:
    """It ends in two ASCII marks at least."""
    return len(word) > 2 and word[-1] < 128 and word[-2] < 128 and not word[-2:].isalnum() and not word[-1:].isalnum() and not word[-2:-1].isalnum()


def document_statistics(docs: DataFrame, keep: tuple[str, ...], text_col: str) -> DataFrame:
    def make():
        return lambda texts: [[statistics(t) for t in texts]]

    return map_texts(docs, text_col, keep, make, [("stats", "array<double>")])


@dataclass(frozen=True)
class QualityConfig:
    features: int = 256
    bandwidth: float = 1.0  # of the kernel, in units of sqrt(number of statistics)
    ridge: float = 1e-3  # of the mean diagonal of the normal equations
    bins: int = 1000
    seed: int = 11
    threshold: float = 0.3
    #: About so many labelled rows are fitted at most: those least by a hash of their id.
    most_rows: int = 2_000_000


class Fourier:
    """Maps standardised statistics to random Fourier features and a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, config: QualityConfig):
        rng = np.random.default_rng(config.seed)
        size = len(mean)
        self.mean, self.spread, self.count = mean, spread, config.features
        self.turn = rng.normal(size=(size, config.features)) / (config.bandwidth * np.sqrt(size))
        self.shift = rng.uniform(0, 2 * np.pi, config.features)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.spread, -6, 6)
        z = np.sqrt(2 / self.count) * np.cos(x @ self.turn + self.shift)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def normal_equations(rows: DataFrame, fourier: Fourier) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y over ``rows`` (stats, label): summed by task, then by cell."""
    size = fourier.count + 1

    def run(batches):
        total = np.zeros((size, size + 1))
        for batch in batches:
            if batch.num_rows:
                z = fourier(_matrix(batch.column(0)))
                total += z.T @ np.concatenate([z, batch.column(1).to_numpy()[:, None]], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "row"])

    parts = rows.select("stats", F.col("label").cast("double")).mapInArrow(run, "i int, row array<double>")
    cells = parts.select("i", F.posexplode("row").alias("j", "value")).groupBy("i", "j").agg(F.sum("value").alias("value"))
    total = np.zeros((size, size + 1))
    for i, j, value in cells.collect():  # a fixed number of cells
        total[i, j] = value
    return total[:, :size], total[:, size]


def isotonic(centres: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (score, probability), both ascending."""
    blocks: list[list[float]] = []
    for c, s, n in zip(centres, sums, counts, strict=True):
        if not n:
            continue
        blocks.append([c * n, s, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            c2, s2, n2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + c2, blocks[-1][1] + s2, blocks[-1][2] + n2]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


@dataclass(frozen=True)
class QualityModel:
    fourier: Fourier
    weights: np.ndarray
    knots: tuple[np.ndarray, np.ndarray]

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.fourier(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), *self.knots), 0.0, 1.0)


def fit(labelled: DataFrame, config: QualityConfig, fold: Column) -> QualityModel | None:
    """Fit ``labelled`` (stats, label, key): rows of ``fold`` calibrate, the others are fitted."""
    count = labelled.count()
    if not count:
        return None
    if count > config.most_rows:
        share = int((1 << 30) * config.most_rows / count)
        labelled = labelled.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < share)
    rows = labelled.filter(~fold)
    size = len(STATISTICS)
    sums = rows.select(
        F.count("*"), *[f(F.get("stats", F.lit(i))) for i in range(size) for f in (F.avg, F.stddev_pop)]
    ).first()
    if not sums[0]:
        rows, fold = labelled, F.lit(True)
        sums = rows.select(F.count("*"), *[f(F.get("stats", F.lit(i))) for i in range(size) for f in (F.avg, F.stddev_pop)]).first()
    fourier = Fourier(np.array(sums[1::2]), np.maximum(np.array(sums[2::2]), 1e-6), config)
    left, right = normal_equations(rows, fourier)
    weights = np.linalg.solve(left + config.ridge * np.trace(left) / len(left) * np.eye(len(left)), right)
    model = QualityModel(fourier, weights, (np.array([0.0, 1.0]), np.array([0.0, 1.0])))
    bins = config.bins

    def run(batches):
        sums, counts = np.zeros(bins), np.zeros(bins)
        for batch in batches:
            if batch.num_rows:
                at = np.clip((model.raw(_matrix(batch.column(0))) + 0.5) / 2 * bins, 0, bins - 1).astype(int)
                sums += np.bincount(at, batch.column(1).to_numpy(), bins)
                counts += np.bincount(at, minlength=bins)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(sums[some]), pa.array(counts[some])], ["bin", "good", "n"])

    table = labelled.filter(fold).select("stats", F.col("label").cast("double")).mapInArrow(run, "bin int, good double, n double")
    good, n = np.zeros(bins), np.zeros(bins)
    for b, s, c in table.groupBy("bin").agg(F.sum("good"), F.sum("n")).collect():  # at most ``bins`` rows
        good[b], n[b] = s, c
    if n.any():
        centres = (np.arange(bins) + 0.5) / bins * 2 - 0.5
        return QualityModel(fourier, weights, isotonic(centres, good, n))
    return model


def score_quality(
    docs: DataFrame, labels: DataFrame, learn: Callable[[Column], Column], keep: tuple[str, ...] = ("doc_id",), config: QualityConfig | None = None,
    id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality",
) -> DataFrame:
    """``(*keep, score, predicted)`` of every row; ``learn`` says by the id whose labels count.

    ``score`` is the calibrated probability of label 1.  Null and empty texts have zero
    statistics and are scored by them; rows without a label, or with a null one, are not
    fitted; with no labels at all the score is 0.5.  Whole texts count, however long.  Repeated
    rows are scored one by one, so are rows without an id, which match no label; equal scores
    are equally judged; other columns are not read; an empty table gives an empty result.  One pass over the texts yields the small table that is
    joined with the labels, another scores; texts are never shuffled.
    """
    config = config or QualityConfig()
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    marked = labels.select(F.col(label_id).alias("key"), F.col(label_col).cast("double").alias("label")).filter("label IS NOT NULL")
    chosen = marked.filter(learn(F.col("key")))
    labelled = written(document_statistics(rows, ("key",), "text").join(chosen, "key"), "labelled")
    model = fit(labelled, config, remainder(F.concat(F.col("key").cast("string"), F.lit("/fold")), 5) == 0)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def work(texts):
            stats = np.array([statistics(t) for t in texts])
            score = sent.value.score(stats) if sent.value is not None and len(texts) else np.full(len(texts), 0.5)
            return [score, (score >= config.threshold).astype(np.int32)]

        return work

    return map_texts(docs, text_col, keep, make, [("score", "double"), ("predicted", "int")])
