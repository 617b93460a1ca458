"""Quality of texts: ridge regression on random Fourier features, then isotonic calibration.

Each text becomes a few statistics (lengths, shares of letters, digits, signs and capitals,
repeated words and lines, marks glued to words). Random Fourier features of these approximate
a Gaussian kernel. The normal equations are summed over partitions, so that only a matrix of
``FEATURES`` squared reaches the driver for each of ``FOLDS`` folds, and solved there. Every
labelled document is scored by weights that were fitted on the other folds; these raw scores
are pooled into ``BINS`` bins and made monotone by pooling adjacent violators, and that curve
turns raw scores into probabilities. All folds together give the final weights. It is the same
at every size.

Null and empty texts have statistics of zero and are scored like any other; very long texts are
read whole. Repeated rows are scored each, and each counts in the fit; rows of one doc_id lie in
one fold. A doc_id with unlike labels counts as label 1. Null labels and labels without a
document are left out. Without both labels among the training rows every score is the share of
label 1, or 0.5 without rows. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmart.llm.common import Prefixes, mixed, slices, utf8, word_spans, written

FEATURES = 192
BINS = 400
RIDGE = 1.0
#: Width of the kernel, in standard deviations of the statistics times their root number.
WIDTH = 2.0
#: Parts of the training rows, each scored by weights that do not know it.
FOLDS = 4

_CLASSES = {
    "letter": [*range(65, 91), *range(97, 123), *range(128, 256)], "upper": range(65, 91),
    "digit": range(48, 58), "blank": [32, *range(9, 14)], "line": [10], "point": b".,;:?",
    "shout": b"!", "mark": b"#$%&*@^~_=+|<>\\/{}[]()", "bar": b"|",
}
_MEMBER = {k: np.isin(np.arange(256), list(v)) for k, v in _CLASSES.items()}
STATISTICS = (
    "log_bytes", "log_words", "log_lines", *(k + "_share" for k in _CLASSES), "word_length",
    "word_spread", "distinct_words", "top_word", "capital_words", "marked_words", "shout_words",
    "distinct_lines", "distinct_pairs", "short_words", "long_words", "line_length", "entropy")


def _distinct(rows: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row: number of different keys, and of its most frequent key's occurrences."""
    if not len(keys):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((keys, rows))
    r, k = rows[order], keys[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1])
    at = np.flatnonzero(new)
    most = np.zeros(n)
    np.maximum.at(most, r[at], np.diff(np.append(at, len(r))))
    return np.bincount(r[at], minlength=n), most


def _part(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    n, size = len(starts) - 1, np.diff(starts).astype(float)
    if not len(data):
        return np.zeros((n, len(STATISTICS)))
    total = np.maximum(size, 1)
    row = np.repeat(np.arange(n), np.diff(starts))

    def per_row(flags: np.ndarray) -> np.ndarray:
        return np.bincount(row[flags], minlength=n).astype(float)

    counts = {k: per_row(m[data]) for k, m in _MEMBER.items()}
    begin, end, owner = word_spans(data, starts)
    words = np.bincount(owner, minlength=n).astype(float)
    some = np.maximum(words, 1)
    length = (end - begin).astype(float)
    mean = np.bincount(owner, length, n) / some
    square = np.bincount(owner, length ** 2, n) / some
    prefixes = Prefixes(data)
    hashes = prefixes.spans(begin, end)
    different, most = _distinct(owner, hashes, n)
    pairs = hashes[1:] * np.uint64(3) + mixed(hashes[:-1])
    same = owner[1:] == owner[:-1] if len(owner) else np.zeros(0, bool)
    two, _ = _distinct(owner[1:][same], pairs[same], n)
    breaks = np.flatnonzero(data == 10)
    line_begin = np.unique(np.concatenate([starts[:-1][size > 0], breaks + 1]))
    line_begin = line_begin[line_begin < len(data)]
    line_owner = np.searchsorted(starts, line_begin, "right") - 1
    line_end = np.append(line_begin[1:], len(data))
    lines = np.bincount(line_owner, minlength=n).astype(float)
    many = np.maximum(lines, 1)
    unlike, _ = _distinct(line_owner, prefixes.spans(line_begin, line_end), n)

    def words_with(flags: np.ndarray) -> np.ndarray:
        return np.bincount(owner[flags], minlength=n) / some

    first, last = (data[begin], data[end - 1]) if len(begin) else (data[:0], data[:0])
    second = data[np.minimum(begin + 1, len(data) - 1)]
    histogram = np.bincount(row * 64 + (data >> 2), minlength=n * 64).reshape(n, 64) / total[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        entropy = -np.where(histogram > 0, histogram * np.log2(histogram), 0).sum(axis=1)
    return np.column_stack([
        np.log1p(size), np.log1p(words), np.log1p(lines), *(c / total for c in counts.values()),
        np.log1p(mean), np.sqrt(np.maximum(square - mean ** 2, 0)) / np.maximum(mean, 1),
        different / some, most / some,
        words_with(_MEMBER["upper"][first] & _MEMBER["upper"][second]),
        words_with(_MEMBER["mark"][last]), words_with(_MEMBER["shout"][last]),
        unlike / many, two / np.maximum(words - 1, 1), words_with(length <= 2),
        words_with(length >= 15), np.log1p(size / many), entropy])


def statistics(column: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` for each text."""
    data, starts = utf8(column)
    parts = [_part(data[starts[i]:starts[j]], starts[i:j + 1] - starts[i]) for i, j in slices(starts)]
    return np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))


def described(docs: DataFrame) -> DataFrame:
    """doc_id and ``stats``, an array of the text's statistics."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = statistics(batch.column("text"))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(stats.ravel()), stats.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), flat.cast(pa.list_(pa.float64()))], names=["doc_id", "stats"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, stats array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATISTICS))


class Model:
    """Scales statistics, maps them to random features, and scores them."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        width = WIDTH * np.sqrt(len(mean))
        self.mean, self.scale = mean, 1 / np.where(spread > 1e-9, spread, 1)
        self.waves = rng.normal(size=(len(mean), FEATURES - 1)) / width
        self.phases = rng.uniform(0, 2 * np.pi, FEATURES - 1)
        self.weights = np.zeros(FEATURES)
        self.knots, self.levels = np.array([0.0]), np.array([0.5])

    def features(self, stats: np.ndarray) -> np.ndarray:
        scaled = np.clip((stats - self.mean) * self.scale, -8, 8)
        waves = np.cos(scaled @ self.waves + self.phases) * np.sqrt(2 / (FEATURES - 1))
        return np.column_stack([waves, np.ones(len(stats))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def scores(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated; a thousandth follows the raw score, so that equal levels keep an order."""
        raw = self.raw(stats)
        level = np.interp(raw, self.knots, self.levels)
        return np.clip(0.999 * level + 0.001 / (1 + np.exp(-4 * (raw - 0.5))), 0, 1)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The closest rising sequence, by pooling neighbours that fall."""
    pools: list[list[float]] = []
    for v, w in zip(values.tolist(), weights.tolist()):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v2, w2, n2 = pools.pop()
            v1, w1, n1 = pools.pop()
            pools.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.repeat([p[0] for p in pools], [int(p[2]) for p in pools])


def _equations(model: Model):
    """Each partition's sums: one row for each fold and feature, with the label's product at the end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOLDS, FEATURES, FEATURES + 1))
        for batch in batches:
            x = model.features(_matrix(batch.column("stats")))
            y, fold = batch.column("quality").to_numpy().astype(float), batch.column("fold").to_numpy()
            for f in np.unique(fold):
                mine = fold == f
                total[f] += x[mine].T @ np.column_stack([x[mine], y[mine]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(FOLDS), FEATURES)), pa.array(np.tile(np.arange(FEATURES), FOLDS)),
             pa.array(list(total.reshape(-1, FEATURES + 1)), pa.list_(pa.float64()))],
            names=["fold", "feature", "sums"])
    return run


def solved(normal: np.ndarray) -> np.ndarray:
    return np.linalg.solve(normal[:, :-1] + RIDGE * np.eye(FEATURES), normal[:, -1])


def _bins(model: Model, weights: np.ndarray, low: float, high: float):
    """Rows and labels by raw score, each row scored by the weights that do not know its fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BINS, 2))
        for batch in batches:
            own = weights[batch.column("fold").to_numpy()]
            raw = (model.features(_matrix(batch.column("stats"))) * own).sum(axis=1)
            at = np.clip((raw - low) / (high - low) * BINS, 0, BINS - 1).astype(int)
            total[:, 0] += np.bincount(at, minlength=BINS)
            total[:, 1] += np.bincount(at, batch.column("quality").to_numpy().astype(float), BINS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BINS)), pa.array(total[:, 0]), pa.array(total[:, 1])], names=["bin", "n", "good"])
    return run


def equations(train: DataFrame, model: Model) -> np.ndarray:
    """The normal equations of each fold of ``train`` (stats, quality, fold), label products last."""
    sums = (
        train.mapInArrow(_equations(model), "fold long, feature long, sums array<double>")
        .select("fold", "feature", F.posexplode("sums").alias("column", "value"))
        .groupBy("fold", "feature", "column").agg(F.sum("value").alias("value")).toPandas())
    normal = np.zeros((FOLDS, FEATURES, FEATURES + 1))
    normal[sums.fold.to_numpy(), sums.feature.to_numpy(), sums["column"].to_numpy()] = sums.value
    return normal


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """Learns from the rows of ``stats`` that ``labels`` (doc_id, quality 0 or 1) has; all of them."""
    marked = labels.where("quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).alias("fold")
    train = written(stats.join(marked, "doc_id").select("doc_id", "stats", "quality", fold), "train")
    columns = [F.col("stats")[i] for i in range(len(STATISTICS))]
    moments = train.agg(
        F.array(*[F.avg(c) for c in columns]).alias("mean"),
        F.array(*[F.stddev_pop(c) for c in columns]).alias("spread"),
        F.avg("quality").alias("good"), F.count("*").alias("n")).first()
    if not moments.n:
        return Model(np.zeros(len(STATISTICS)), np.ones(len(STATISTICS)))
    model = Model(np.array(moments.mean), np.array(moments.spread))
    model.levels = np.array([moments.good])
    if moments.good in (0, 1):
        return model
    normal = equations(train, model)
    whole = normal.sum(axis=0)
    model.weights = solved(whole)
    weights = np.stack([solved(whole - part) for part in normal])
    low, high = -0.25, 1.25
    bins = (
        train.mapInArrow(_bins(model, weights, low, high), "bin long, n double, good double")
        .groupBy("bin").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
        .where("n > 0").orderBy("bin").toPandas())
    n, good = bins.n.to_numpy(), bins.good.to_numpy()
    model.knots = low + (bins.bin.to_numpy() + 0.5) * (high - low) / BINS
    model.levels = isotonic(good / n, n)
    return model


def scored(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row of ``stats``."""
    shared = stats.sparkSession.sparkContext.broadcast(model)
    kind = stats.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(shared.value.scores(_matrix(batch.column("stats"))))],
                names=["doc_id", "score"])

    return stats.mapInArrow(run, f"doc_id {kind}, score double")
