"""Quality classifier (operator 9): random Fourier features over document
statistics, ridge regression by normal equations, isotonic calibration.

Statistics of every text are computed once. The labelled rows of the learning
folds are standardised and mapped to ``FEATURES`` cosines that approximate a
Gaussian kernel; each partition sums its part of the normal equations, per
fold, and the sums (bounded by the number of features) meet on the driver. A
solution without a fold scores that fold; those scores, in at most ``BINS``
bins, are calibrated by pooling adjacent violators. The solution over all
learning folds scores all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binary_values, byte_slices, id_and_text, id_fold, staged

FOLDS, HELD_OUT_FOLD = 5, 0
THRESHOLD = 0.3
FEATURES = 256
RIDGE = 1e-3
BINS = 1024
SEED = 7
STATISTICS = (
    "log_bytes log_words word_length word_length_sd longest_word upper lower digits other_ascii non_ascii spaces "
    "distinct_words top_word repeated_next capital_words marked_words symbols_in_words distinct_lines log_lines "
    "line_bytes short_lines byte_entropy stops commas"
).split()
_CLASS = np.full(256, 3)  # 0 upper, 1 lower, 2 digit, 3 other ASCII, 4 beyond ASCII, 5 white space
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 4
_CLASS[[9, 10, 11, 12, 13, 32]] = 5
_PLAIN = b".,;:?!'\"()-"


def statistics(text: bytes) -> list[float]:
    """The statistics of one text, all finite; zeros for the empty text."""
    if not text:
        return [0.0] * len(STATISTICS)
    n = len(text)
    bytes_ = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    by_class = np.bincount(_CLASS, weights=bytes_, minlength=6) / n
    share = bytes_[bytes_ > 0] / n
    entropy = float(-(share * np.log2(share)).sum())
    words = text.split()
    m = max(len(words), 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    repeated = sum(map(bytes.__eq__, words[1:], words[:-1])) if len(words) > 1 else 0
    capital = sum(w[:1].isupper() for w in words)
    marked = sum(not (w[-1:].isalnum() or w[-1] >= 128) for w in words)
    plain = sum(bytes_[c] for c in _PLAIN)
    lines = text.split(b"\n")
    return [
        math.log(n), math.log(m), float(sizes.mean()), float(sizes.std()), math.log1p(int(sizes.max())),
        *by_class.tolist(), len(counts) / m, max(counts.values(), default=0) / m, repeated / m, capital / m,
        marked / m, float(by_class[3] * n - plain) / m, len(set(lines)) / len(lines), math.log(len(lines)),
        math.log1p(n / len(lines)), sum(len(x) < 20 for x in lines) / len(lines), entropy,
        bytes_[46] / m, bytes_[44] / m,
    ]


def _statistics_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in byte_slices(batches):
        rows = np.asarray([statistics(t) for t in binary_values(part.column("text"))], np.float64)
        offsets = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * len(STATISTICS))
        yield pa.RecordBatch.from_arrays(
            [*(part.column(i) for i in range(part.num_columns - 1)),
             pa.ListArray.from_arrays(offsets, pa.array(rows.reshape(-1)))],
            [*part.schema.names[:-1], "stats"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


class Map(NamedTuple):
    """Standardisation and random Fourier features."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.directions + self.phases) * math.sqrt(2 / len(self.phases))
        return np.concatenate([waves, np.ones((len(z), 1))], axis=1)


def random_map(mean: np.ndarray, scale: np.ndarray, features: int = FEATURES, seed: int = SEED) -> Map:
    """Directions of a Gaussian kernel whose width is the root of twice the
    number of statistics, the typical distance of two standardised rows."""
    rng = np.random.default_rng(seed)
    width = math.sqrt(2 * len(mean))
    return Map(mean, scale, rng.standard_normal((len(mean), features)) / width, rng.uniform(0, 2 * math.pi, features))


def _normal_equations(feature_map: Map):
    """Per partition and fold: sums of z z', z y and rows, as one blob."""
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            z = feature_map(_matrix(batch.column("stats")))
            y = batch.column("y").to_numpy().astype(float)
            fold = batch.column("fold").to_numpy()
            for f in np.unique(fold).tolist():
                zf = z[fold == f]
                part = np.concatenate([zf.T @ zf, (zf.T @ y[fold == f])[:, None]], axis=1)
                sums[f] = sums.get(f, 0.0) + part
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
            ["fold", "sums"])
    return emit


def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for f, blob in zip(batch.column("fold").to_pylist(), batch.column("sums").to_pylist()):
            sums[f] = sums.get(f, 0.0) + np.frombuffer(blob)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int64()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
        ["fold", "sums"])


def _solve(sums: np.ndarray, ridge: float) -> np.ndarray:
    a, b = sums[:, :-1], sums[:, -1]
    rows = a[-1, -1]  # the constant feature counts the rows
    penalty = np.full(len(b), ridge * max(rows, 1.0))
    penalty[-1] = 1e-9
    return np.linalg.solve(a + np.diag(penalty), b)


def pool_adjacent_violators(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Non-decreasing fit of least squares."""
    blocks: list[list[float]] = []  # mean, weight, members
    for v, w in zip(value, weight):
        blocks.append([float(v), float(w), 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.empty(0)


class Model(NamedTuple):
    feature_map: Map
    weights: np.ndarray
    knots: np.ndarray       # raw scores, ascending
    calibrated: np.ndarray  # scores in 0..1 at the knots

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = self.feature_map(stats) @ self.weights
        return np.clip(np.interp(raw, self.knots, self.calibrated), 0.0, 1.0)


def _bins_of(feature_map: Map, by_fold: dict[int, np.ndarray]):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = feature_map(_matrix(batch.column("stats")))
            fold = batch.column("fold").to_numpy()
            raw = np.zeros(len(z))
            for f, weights in by_fold.items():
                raw[fold == f] = z[fold == f] @ weights
            at = np.clip(np.floor((raw + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int64)  # -0.5 to 1.5
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw), batch.column("y")], ["bin", "raw", "y"])
    return emit


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "id", label_id: str = "doc_id",
        label_col: str = "quality", seed: int = SEED) -> Model | None:
    """Learn from the labelled rows of all folds but the held-out one; None when
    there are no such rows. Labels other than 0 and 1 are passed over, a
    document labelled several times counts by its highest label."""
    y = (labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(label_id).alias("_id"))
         .agg(F.max(label_col).cast("double").alias("y")))
    train = staged(
        stats.join(y, F.col(id_col) == F.col("_id")).where(F.col("fold") != HELD_OUT_FOLD)
        .select("fold", "stats", "y"), "labelled")
    cells = [F.col("stats")[i] for i in range(len(STATISTICS))]
    moments = train.agg(F.count("*"), *[F.avg(c) for c in cells], *[F.stddev_pop(c) for c in cells]).first()
    if not moments[0]:
        return None
    d = len(STATISTICS)
    mean, sd = np.asarray(moments[1:d + 1], float), np.asarray(moments[d + 1:], float)
    feature_map = random_map(mean, np.where(sd > 1e-9, sd, 1.0), seed=seed)
    sums = train.mapInArrow(_normal_equations(feature_map), "fold long, sums binary")
    group = max(1, math.isqrt(train.rdd.getNumPartitions()))  # sums of sums: few blobs for the driver
    sums = sums.repartition(group).mapInArrow(_added, "fold long, sums binary")
    total: dict[int, np.ndarray] = {}
    for row in sums.toLocalIterator():
        blob = np.frombuffer(bytes(row["sums"])).reshape(FEATURES + 1, FEATURES + 2)
        total[row["fold"]] = total.get(row["fold"], 0.0) + blob
    everything = sum(total.values())
    without = {f: _solve(everything - s, RIDGE) if len(total) > 1 else _solve(everything, RIDGE) for f, s in total.items()}
    bins = (train.mapInArrow(_bins_of(feature_map, without), "bin long, raw double, y double")
            .groupBy("bin").agg(F.avg("raw").alias("raw"), F.avg("y").alias("y"), F.count("*").alias("n"))
            .orderBy("bin").collect())  # at most BINS rows
    knots = np.asarray([r["raw"] for r in bins])
    calibrated = pool_adjacent_violators(np.asarray([r["y"] for r in bins]), np.asarray([r["n"] for r in bins]))
    return Model(feature_map, _solve(everything, RIDGE), knots, calibrated)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                   text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality",
                   keep: bool = False) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per input row; with
    ``keep``, all columns of ``docs`` besides the score (as ``_score``).

    Labels are learned from rows whose crc32(id as text) mod 5 is not 0; only
    the text enters a score. Null and empty texts have statistics of zero and a
    score like any other. A null id is not held out and has no label. Repeated
    rows count once each. Without labels to learn from every score is 0.5. An
    empty table gives no rows.
    """
    if keep:
        slim = docs.withColumn("_text", F.col(text_col).cast("string"))
    else:
        slim = docs.select(*id_and_text(docs, id_col, text_col))
    fold = id_fold(F.col(id_col), FOLDS)
    plain = docs.select(F.col(id_col).alias("id"), fold.alias("fold"), F.col(text_col).cast("string").alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    stats = plain.mapInArrow(_statistics_of, f"id {kind}, fold long, stats array<double>")
    if keep:
        model = fit(stats, labels, label_id=label_id, label_col=label_col)
    else:
        stats = staged(stats, "statistics")
        model = fit(stats, labels, label_id=label_id, label_col=label_col)

    def score_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, "_text"):
            rows = np.asarray([statistics(t) for t in binary_values(part.column("_text"))], np.float64)
            score = model.score(rows) if model else np.full(len(rows), 0.5)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(score)], [*part.schema.names[:-1], "_score"])

    def score_stats(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column("stats"))
            score = model.score(rows) if model else np.full(len(rows), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("fold"), pa.array(score)],
                                             ["id", "fold", "score"])

    if keep:
        schema = T.StructType([*docs.schema.fields, T.StructField("_score", T.DoubleType())])
        return slim.mapInArrow(score_texts, schema)
    scored = stats.mapInArrow(score_stats, f"id {kind}, fold long, score double")
    return scored.select(
        F.col("id").alias(id_col), F.coalesce(F.col("fold") == HELD_OUT_FOLD, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, as they are, that the classifier doesn't reject."""
    return quality_scores(docs, labels, threshold, keep=True).where(F.col("_score") >= threshold).drop("_score")
