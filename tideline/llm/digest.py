"""Document fingerprints by quartile bucket digests.

Byte triplets of the UTF-8 text (inside a sliding window of five bytes) are hashed into 256 buckets. The digest says for every
bucket in which quartile of all bucket counts its count lies (2 bits), and the length on a logarithmic scale. Digests are
compared by a bounded difference score.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 256
# Pairs of places after the first byte that make a triplet with it.
TRIPLETS = ((1, 2), (1, 3), (2, 3), (1, 4))
LENGTH_STEP = 1.1
LENGTH_CAP = 32
ROWS_PER_RANGE = 2_000
MAX_RANGES = 10_000
_NO_ID = -(1 << 63)
_STEP = 1 << 18


def digest(text: str) -> np.ndarray:
    """257 small numbers: the quartile (0 to 3) of each bucket and the logarithmic length class."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    for begin in range(0, len(data), _STEP):
        part = data[begin:begin + _STEP + 4].astype(np.uint32)
        for k, (i, j) in enumerate(TRIPLETS):
            n = min(len(part) - j, _STEP)
            if n <= 0:
                continue
            mixed = (part[:n] * np.uint32(0x9E3779B1) ^ part[i:i + n] * np.uint32(0x85EBCA77) ^ part[j:j + n] * np.uint32(0xC2B2AE3D))
            mixed = (mixed + np.uint32(k * 0x27D4EB2F)) * np.uint32(0x165667B1)
            counts += np.bincount(mixed >> np.uint32(24), minlength=BUCKETS)
    ordered = np.sort(counts)
    q1, q2, q3 = ordered[BUCKETS // 4 - 1], ordered[BUCKETS // 2 - 1], ordered[3 * BUCKETS // 4 - 1]
    quartile = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    size = min(int(np.log(len(data) + 1) / np.log(LENGTH_STEP)), 255)
    return np.append(quartile, np.uint8(size)).astype(np.uint8)


def encode(found: np.ndarray) -> str:
    """130 hex digits: two for the length, then two bits per bucket."""
    quartiles = found[:BUCKETS].reshape(-1, 4)
    packed = (quartiles << np.array([6, 4, 2, 0], np.uint8)).sum(1).astype(np.uint8)
    return f"{int(found[BUCKETS]):02x}{packed.tobytes().hex()}"


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 for equal digests, down to 0. A bucket two quartiles apart counts more than two one apart; a difference of the
    length counts up to a cap. The score is one minus the share of the largest difference."""
    apart = np.abs(a[:BUCKETS].astype(np.int64) - b[:BUCKETS])
    cost = int(np.array([0, 1, 3, 6])[apart].sum())
    length = min(abs(int(a[BUCKETS]) - int(b[BUCKETS])), LENGTH_CAP)
    return 1.0 - (cost + 4 * length) / (6 * BUCKETS + 4 * LENGTH_CAP)


def edited(text: str, following: str) -> str:
    """The last floor(n/2) code points replaced by the first as many (or all) of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _cuts(ids: DataFrame, ranges: int) -> list[int]:
    """Ids that cut the table into about equal ranges: a few numbers, only to deal out the work. An id of many rows comes
    several times."""
    if ranges < 2:
        return []
    shares = [(i + 1) / ranges for i in range(ranges - 1)]
    found = ids.agg(F.percentile_approx("id", F.array(*[F.lit(s) for s in shares]), F.lit(10_000)).alias("cuts")).first().cuts
    return sorted(found or [])


def _range_of(cuts: np.ndarray, at: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Range of each row, ascending with (at, h). An id that is a cut m times has m ranges, by its rows' hashes."""
    low, high = np.searchsorted(cuts, at, "left"), np.searchsorted(cuts, at, "right")
    share = (h.astype(np.float64) + 2.0**63) / 2.0**64
    return (low + np.minimum((share * (high - low)).astype(np.int64), np.maximum(high - low - 1, 0))).astype(np.int32)


def fingerprint_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row.

    The next document is the one with the next larger (id, text hash); after the last comes the first, and a single one is its own
    next. NULL ids come first. NULL texts count as empty. Rows alike in id and text are one after the other. Texts of any length
    are read whole, and an empty table gives no rows.

    Rows are dealt to ranges of (id, text hash) that are sorted and read as a stream, so each text moves once; an id of very many
    rows has several. The first row of a range is also sent to the range before, where it is the next of the last row.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn(
        "at", F.coalesce("id", F.lit(_NO_ID)))
    ids = rows.select(F.col("at").alias("id"))
    cuts = np.array(_cuts(ids, int(min(MAX_RANGES, -(-ids.count() // ROWS_PER_RANGE)))), np.int64)

    @F.pandas_udf("int")
    def range_of(at: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series(_range_of(cuts, at.to_numpy(np.int64), h.to_numpy(np.int64)))

    light = rows.select("at", F.xxhash64("text").alias("h")).withColumn("range", range_of("at", "h"))
    # One row per range; at most MAX_RANGES of them.
    heads = sorted((r.range, r.head.at, r.head.h) for r in
                   light.groupBy("range").agg(F.min(F.struct("at", "h")).alias("head")).collect())
    first = {(at, h): heads[k - 1][0] for k, (_, at, h) in enumerate(heads)}
    head_ids = np.array([at for _, at, _ in heads], np.int64)

    @F.pandas_udf("array<int>")
    def ranges_of(at: pd.Series, h: pd.Series) -> pd.Series:
        at = at.to_numpy(np.int64)
        own = _range_of(cuts, at, h.to_numpy(np.int64))
        out = own[:, None].tolist()
        for i in np.flatnonzero(np.isin(at, head_ids)):
            before = first.get((int(at[i]), int(h.iloc[i])))
            if before is not None:
                out[i].append(before)
        return pd.Series(out)

    dealt = rows.withColumn("h", F.xxhash64("text")).select("at", "id", "h", "text", F.posexplode_outer(ranges_of("at", "h")).alias("extra", "range"))
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = dealt.repartition(parts, "range").sortWithinPartitions("range", "extra", "at", "h")

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def one(before: tuple, text: str, mark: np.ndarray) -> tuple:
        name, old, own = before
        new = edited(old, text)
        changed = digest(new)
        return (name, len(old), hashlib.sha256(new.encode("utf-8", "replace")).hexdigest(), encode(own), encode(changed),
                likeness(own, changed), likeness(own, mark))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, now = None, None
        for batch in batches:
            out = []
            for where, extra, name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                                batch.column(2).to_pylist(), batch.column(3)):
                if where != now:
                    before, now = None, where
                if extra and before is None:
                    continue
                text = text.as_py()
                mark = digest(text)
                if before is not None:
                    out.append(one(before, text, mark))
                before = None if extra else (name, text, mark)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    return ordered.select("range", "extra", "id", "text").mapInArrow(
        run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
