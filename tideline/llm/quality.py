"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import crc32_mod, hash_share, partition_sums, saved

SAMPLE_ROWS = 20_000
FOURIER = 384
WIDTH = 1.0
RIDGE = 1e-3
BINS = 512
HOLD_OUT = (3, 1)
CALIBRATE = 0.25

_LOWER, _UPPER, _DIGIT, _SPACE, _NEWLINE, _STOP, _BANG, _BAR, _SYMBOL, _OTHER = range(10)
_KINDS = 10
_classes: np.ndarray | None = None


def _kind(code: int) -> int:
    char = chr(code)
    if char == "\n":
        return _NEWLINE
    if char.isspace():
        return _SPACE
    if char.isdigit():
        return _DIGIT
    if char.isupper():
        return _UPPER
    if char.isalpha():
        return _LOWER
    if char in ".,;:'\"()-?":
        return _STOP
    if char == "!":
        return _BANG
    if char == "|":
        return _BAR
    return _SYMBOL if code < 128 else _OTHER


def _class_table() -> np.ndarray:
    """Kind of each code point of the basic plane; the last entry stands for all others. Built once per process."""
    global _classes
    if _classes is None:
        _classes = np.array([_kind(c) if not 0xD800 <= c < 0xE000 else _OTHER for c in range(0xFFFF)] + [_OTHER], np.uint8)
    return _classes


def statistics(text: str | None) -> np.ndarray:
    """The statistics of one whole text; NULL counts as empty, for which all are finite too."""
    text = text or ""
    n = len(text)
    codes = np.minimum(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32), 0xFFFF)
    kinds = np.bincount(_class_table()[codes], minlength=_KINDS).astype(float)
    letters = kinds[_LOWER] + kinds[_UPPER]
    words = text.split()
    counts = Counter(words)
    n_words = len(words)
    lines = [x for x in text.split("\n") if x]
    n_lines = len(lines)
    repeated = n_lines - len(set(lines))
    top = max(counts.values(), default=0)
    closed = sum(x.rstrip()[-1:] in (".", "?", "!", "\"", ":") for x in lines)
    share = lambda a, b: a / b if b else 0.0
    return np.array([
        np.log1p(n), np.log1p(n_words), np.log1p(n_lines),
        share(kinds[_UPPER], letters), share(letters, n), share(kinds[_DIGIT], n), share(kinds[_SPACE], n),
        share(kinds[_STOP], n_words), share(kinds[_BANG], n_words), share(kinds[_BAR], n_words),
        share(kinds[_SYMBOL], n_words), share(kinds[_OTHER], n_words),
        share(letters, n_words), share(len(counts), n_words), share(top, n_words),
        share(sum(map(eq, words, words[1:])), n_words),
        share(repeated, n_lines), share(closed, n_lines), np.log1p(share(n, n_lines)),
        share(sum(w.isupper() and len(w) > 1 for w in counts), len(counts)),
        share(sum(not w[-1].isalpha() for w in counts), len(counts)),
    ])


N_STATS = len(statistics(""))


@dataclass
class QualityModel:
    """Everything that scoring needs; a few hundred kilobytes, whatever the corpus."""

    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    shift: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        inner = np.clip((stats - self.mean) / self.scale, -5, 5)
        return np.hstack([np.cos(inner @ self.waves + self.shift) * np.sqrt(2 / len(self.shift)), np.ones((len(stats), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated, 0 to 1. A thousandth of the raw score keeps the order inside flat steps."""
        raw = self.raw(stats)
        fitted = np.interp(raw, self.knots, self.values)
        return np.clip(0.999 * fitted + 0.001 * np.clip(raw, 0, 1), 0, 1)


def isotonic(x: np.ndarray, good: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing fit of good/total over x by pooling neighbours; knots at block centres. Each block is
    smoothed by one case of each label, so that no score is exactly 0 or 1."""
    blocks: list[list[float]] = []
    for a, g, t in zip(x, good, total):
        if t:
            blocks.append([a * t, g, t])
            while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
                top = blocks.pop()
                blocks[-1] = [p + q for p, q in zip(blocks[-1], top)]
    centres = np.array([b[0] / b[2] for b in blocks])
    values = np.maximum.accumulate(np.array([(b[1] + 0.5) / (b[2] + 1) for b in blocks]))
    return centres, values


def _stats_of(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return np.array([statistics(t) for t in batch.column(column).to_pylist()]).reshape(-1, N_STATS)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, fourier: int = FOURIER,
        width: float = WIDTH, ridge: float = RIDGE, seed: int = 7) -> QualityModel:
    """Learn from labelled rows outside the held-out fold (crc32 of the id mod 3 is 1).

    sample_rows bounds the labels that are used: of n labels each is taken with probability sample_rows / n, by a
    hash of its id. A quarter of them calibrates, the rest fits. Labels without an id or value are not used; repeated ones
    count once. Without labels of both kinds the score is their share, or 0.5 if there are none.
    """
    usable = (labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("label"))
              .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1))
              .filter(crc32_mod(F.col("id"), HOLD_OUT[0]) != HOLD_OUT[1]).distinct())
    n = usable.count()
    chosen = usable.filter(hash_share("id", seed=seed) < min(1.0, sample_rows / max(n, 1)))
    # At most about sample_rows rows of 12 bytes, whatever the corpus.
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array(list(_stats_of(batch, 0)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([values, batch.column(1), batch.column(2)], ["stats", "label", "part"])

    # In a few partitions, as every one of them sends a whole matrix to be added.
    sample = saved(joined.select("text", "label", hash_share("id", seed=seed + 1).alias("part"))
                   .mapInArrow(stats, "stats array<double>, label int, part double").repartition(16))

    def moments(batches):
        total = None
        for batch in batches:
            x = np.array(batch.column(0).to_pylist()).reshape(-1, N_STATS)
            one = np.concatenate([[len(x), sum(batch.column(1).to_pylist())], x.sum(0), (x * x).sum(0)])
            total = one if total is None else total + one
        return total

    sums = partition_sums(sample, moments)
    rng = np.random.default_rng(seed)
    if sums is None:
        sums = np.concatenate([[0, 0], np.zeros(2 * N_STATS)])
    count, ones = sums[:2]
    mean = sums[2:2 + N_STATS] / max(count, 1)
    scale = np.sqrt(np.maximum(sums[2 + N_STATS:] / max(count, 1) - mean**2, 1e-8))
    model = QualityModel(mean, scale, rng.normal(size=(N_STATS, fourier)) * width / np.sqrt(N_STATS),
                         rng.uniform(0, 2 * np.pi, fourier), np.zeros(fourier + 1), np.zeros(1), np.full(1, 0.5))
    if not 0 < ones < count:
        model.values[:] = ones / count if count else 0.5
        return model
    size = fourier + 1

    def equations(batches):
        total = None
        for batch in batches:
            x = model.features(np.array(batch.column(0).to_pylist()).reshape(-1, N_STATS))
            one = np.concatenate([(x.T @ x).ravel(), x.T @ np.array(batch.column(1).to_pylist(), float)])
            total = one if total is None else total + one
        return total

    solved = partition_sums(sample.filter(F.col("part") >= CALIBRATE), equations)
    if solved is None:
        solved = partition_sums(sample, equations)
    left, right = solved[:size * size].reshape(size, size), solved[size * size:]
    model.weights = np.linalg.solve(left + ridge * max(count, 1) * np.eye(size) / size, right)

    def binned(batches):
        total = np.zeros((BINS + 2, 3))
        for batch in batches:
            raw = model.raw(np.array(batch.column(0).to_pylist()).reshape(-1, N_STATS))
            at = np.clip(((raw + 0.5) / 2 * BINS).astype(int), 0, BINS + 1)
            np.add.at(total, (at, 0), raw)
            np.add.at(total, (at, 1), batch.column(1).to_pylist())
            np.add.at(total, (at, 2), 1)
        return total.ravel()

    table = partition_sums(sample.filter(F.col("part") < CALIBRATE), binned)
    table = (partition_sums(sample, binned) if table is None or not table.any() else table).reshape(-1, 3)
    full = table[table[:, 2] > 0]
    model.knots, model.values = isotonic(full[:, 0] / full[:, 2], full[:, 1], full[:, 2])
    return model


def score(docs: DataFrame, model: QualityModel, keep: DataFrame | None = None) -> DataFrame:
    """doc_id, held_out, score (0 to 1, NULL and empty texts too), predicted for every row, from the whole text.

    Texts of any length are read whole, repeated rows get the same result, and an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.score(_stats_of(batch, 1)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    out = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, score double, predicted int")
    return out.select("doc_id", (crc32_mod(F.col("doc_id"), HOLD_OUT[0]) == HOLD_OUT[1]).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The rows that the classifier accepts, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            at = batch.schema.get_field_index("text") if at is None else at
            if batch.num_rows:
                yield batch.filter(pa.array(shared.value.score(_stats_of(batch, at)) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
