"""Language identification by string kernels.

The kernel of two texts is the blended-spectrum presence kernel: how many character n-grams (n = 1 to 3) occur in both,
over the root of the product of their own numbers. A bounded set of labelled texts are the landmarks of a Nystroem
approximation; ridge regression, one language against the rest, is fitted in that space, on features of length one. A batch
of texts is scored by matrix products: kernels by the whitening of the landmarks, then features by weights.

N-grams are told apart by 64 bits, not folded into fewer places, and the length of the features is taken out. So a text far longer
than the landmarks, which holds most of their n-grams by chance, is scored by the same measure as a short one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import crc32_mod, partition_sums, saved, text_chunks

GRAMS = 3
LANDMARKS = 160
SAMPLE_PER_LANGUAGE = 1_000
# Longer texts are scored like any other, but take no part in the fit.
FIT_CHARS = 100_000
RIDGE = 1e-4
HOLD_OUT = (5, 0)
UNKNOWN = "und"
_STEP = 1 << 18
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """Which code points are letters; built once per process."""
    global _letters
    if _letters is None:
        _letters = np.array([chr(c).isalpha() for c in range(0x110000)])
    return _letters


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def grams(text: str | None) -> Iterator[np.ndarray]:
    """64-bit values of the n-grams of the lower-cased text, in steps and with repeats; nothing without a letter.

    Whatever is not a letter counts as one blank, and a blank stands before and after the text. All of the text is
    read, in steps, so memory does not grow with it beyond its own code points. No value is zero.
    """
    if not text:
        return
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letter_table()[codes]
    if not letter.any():
        return
    codes = np.where(letter, codes, 32)
    blank = codes == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    codes = codes[keep]
    codes = np.concatenate([[32], codes, [32] if codes[-1] != 32 else []]).astype(np.uint64)
    for begin in range(0, len(codes), _STEP):
        part = codes[begin:begin + _STEP + GRAMS - 1]
        # Three code points of 21 bits are one number of 63; shorter n-grams have zeros above. The bijection spreads them.
        value = np.zeros(len(part), np.uint64)
        for n in range(GRAMS):
            if len(part) <= n:
                break
            value = (value[:len(part) - n] << np.uint64(21)) | part[n:]
            own = value[:min(len(value), _STEP)]
            yield own * np.uint64(0x9E3779B97F4A7C15)


def presence(text: str | None) -> np.ndarray | None:
    """The different n-grams of the text, ascending; None without a letter."""
    found = [np.unique(g) for g in grams(text)]
    return np.unique(np.concatenate(found)) if found else None


class GramTable:
    """Numbers of known n-grams by open addressing in an array at most a quarter full."""

    def __init__(self, known: np.ndarray):
        bits = max(10, (4 * len(known)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.number = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        self.reach, left = 0, np.arange(len(known))
        while len(left):
            at = ((known[left] >> self.shift).astype(np.int64) + self.reach) & self.mask
            free = self.number[at] < 0
            # Of several for one place the last stays, the others go on.
            self.number[at[free]] = left[free]
            self.keys[at[free]] = known[left[free]]
            left = left[self.number[at] != left]
            self.reach += 1

    def find(self, values: np.ndarray) -> np.ndarray:
        """Numbers of those values that are known, with repeats."""
        at = (values >> self.shift).astype(np.int64)
        found = []
        for _ in range(self.reach):
            same = self.keys[at] == values
            if same.any():
                found.append(self.number[at[same]])
            on = ~same & (self.number[at] >= 0)
            if not on.any():
                break
            values, at = values[on], (at[on] + 1) & self.mask
        return np.concatenate(found) if found else np.zeros(0, np.int32)


@dataclass
class LanguageModel:
    """The landmarks' n-grams, the whitening of their kernel, and one column of weights per language."""

    languages: list[str]
    landmarks: list[np.ndarray]
    whiten: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def __post_init__(self) -> None:
        self.known, of = np.unique(np.concatenate([*self.landmarks, np.zeros(0, np.uint64)]), return_inverse=True)
        sizes = np.array([len(m) for m in self.landmarks], np.int64)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(of, kind="stable")
        # Postings: of each known n-gram the landmarks that hold it.
        self.holders = owner[order].astype(np.int32)
        self.ends = np.cumsum(np.bincount(of, minlength=len(self.known)))
        self.scale = 1 / np.sqrt(np.maximum(sizes, 1))
        self._table: GramTable | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_table": None}

    def kernels(self, found: Iterator[np.ndarray]) -> np.ndarray | None:
        """Kernels of one text with the landmarks, but for the root of the text's own number; None without n-grams."""
        self._table = self._table or GramTable(self.known)
        here, some = np.zeros(len(self.known), bool), False
        for values in found:
            here[self._table.find(values)] = True
            some = True
        if not some:
            return None
        ends = self.ends[here]
        counts = ends - np.append(0, self.ends)[:-1][here]
        total = np.cumsum(counts)
        at = np.repeat(ends - total, counts) + np.arange(total[-1] if len(total) else 0)
        return np.bincount(self.holders[at], minlength=len(self.scale)) * self.scale

    def features(self, kernels: np.ndarray) -> np.ndarray:
        """Nystroem features of length one; zeros for a text that shares nothing with the landmarks."""
        raw = kernels @ self.whiten
        length = np.sqrt((raw * raw).sum(1, keepdims=True))
        return np.divide(raw, length, out=np.zeros_like(raw), where=length > 0)

    def decide(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score per text; the score is the regression value of the chosen language in 0 to 1."""
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, scores
        found = [self.kernels(grams(t)) for t in texts]
        known = [i for i, k in enumerate(found) if k is not None]
        if known:
            values = self.features(np.array([found[i] for i in known])) @ self.weights
            best = values.argmax(1)
            for i, k, v in zip(known, best, values[np.arange(len(known)), best]):
                names[i], scores[i] = self.languages[k], min(max(float(v + 1) / 2, 0.0), 1.0)
        return names, scores


def _landmarks(sample: DataFrame, landmarks: int, languages: int) -> list[np.ndarray]:
    """N-grams of texts dealt to the languages in turn, in the sample's order; at least one text per language."""
    first = Window.partitionBy("lang").orderBy("order")
    chosen = (sample.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= landmarks)
              .orderBy("nth", "lang").limit(max(landmarks, languages)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [presence(t).astype("<u8").tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), *batch.columns[1:]], ["grams", "nth", "lang"])

    rows = chosen.select("text", "nth", "lang").mapInArrow(run, "grams binary, nth int, lang string").collect()
    return [np.frombuffer(r.grams, "<u8") for r in sorted(rows, key=lambda r: (r.nth, r.lang))]


def fit(docs: DataFrame, landmarks: int = LANDMARKS, per_language: int = SAMPLE_PER_LANGUAGE, ridge: float = RIDGE,
        seed: int = 5) -> LanguageModel:
    """Learn from text and lang of rows outside the held-out fold (crc32 of the id mod 5 is 0) with both present.

    per_language bounds the rows: of each language's different texts those with the smallest seeded hashes are used, a share
    of them that makes about per_language (all, if there are fewer). Texts without a letter or of more than FIT_CHARS code points are
    left out. Landmarks are dealt to the languages in turn, at least one to each. The model has one column per
    language. Without usable rows it knows no language and every prediction is `und`.
    """
    usable = (docs.filter(F.col("lang").isNotNull() & (F.length("text") <= FIT_CHARS) & F.col("text").rlike("\\p{L}"))
              .filter(crc32_mod(F.col("doc_id"), HOLD_OUT[0]) != HOLD_OUT[1])
              .select("text", "lang", F.xxhash64(F.lit(seed), "text").alias("order")))
    # Copies are combined in the tasks that read them, so one text of very many rows costs no more than one; of a language only a number is formed.
    sizes = usable.select("lang", "order").distinct().groupBy("lang").agg(F.count("*").alias("n")).collect()
    below = F.lit(False)
    for row in sizes:
        cut = (1 << 63) - 1 if row.n <= per_language else int((per_language / row.n) * (1 << 63))
        below = below | ((F.col("lang") == row.lang) & (F.shiftrightunsigned("order", 1) <= cut))
    sample = saved(usable.filter(below).groupBy("lang", "order").agg(F.min("text").alias("text")).repartition(16, "order")
                   .filter(F.col("text").isNotNull()))
    languages = sorted(row.lang for row in sizes)
    model = LanguageModel(languages, _landmarks(sample, landmarks, len(languages)) if languages else [])
    if not model.landmarks:
        return LanguageModel([], [])
    between = np.array([model.kernels(iter([m])) for m in model.landmarks]) * model.scale[:, None]
    values, vectors = np.linalg.eigh(between)
    solid = values > 1e-6 * values.max()
    model.whiten = vectors[:, solid] / np.sqrt(values[solid])
    size = model.whiten.shape[1]
    column = {name: k for k, name in enumerate(languages)}

    def equations(batches):
        total = None
        for batch in batches:
            rows = [(k, lang) for k, lang in zip((model.kernels(grams(t)) for t in batch.column(0).to_pylist()), batch.column(1).to_pylist())
                    if k is not None]
            if not rows:
                continue
            x = model.features(np.array([k for k, _ in rows]))
            y = np.full((len(x), len(languages)), -1.0)
            y[np.arange(len(x)), [column[lang] for _, lang in rows]] = 1.0
            one = np.concatenate([(x.T @ x).ravel(), (x.T @ y).ravel(), [len(x)]])
            total = one if total is None else total + one
        return total

    sums = partition_sums(sample.select("text", "lang"), equations)
    left, right = sums[:size * size].reshape(size, size), sums[size * size:-1].reshape(size, -1)
    model.weights = np.linalg.solve(left + ridge * sums[-1] * np.eye(size), right)
    return model


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row, from the whole text alone.

    NULL texts and texts without a letter are `und` with score 0. Ties go to the language first in code point order. Repeated
    rows get the same result, and an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin, stop in text_chunks(whole, 1, 1 << 20):
                batch = whole.slice(begin, stop - begin)
                names, scores = shared.value.decide(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores)],
                                                 ["doc_id", "lang_pred", "score"])

    out = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")
    return out.select("doc_id", (crc32_mod(F.col("doc_id"), HOLD_OUT[0]) == HOLD_OUT[1]).alias("held_out"), "lang_pred", "score")
