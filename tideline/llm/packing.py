"""Packing documents into training sequences by vector best-fit."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import row_key, saved, text_chunks
from tideline.llm.encoding import CHUNK, encoder

SEQUENCE = 2048
END_ID = 0
TOKENIZER = "word_bpe_49k.json"
GROUP = 16_384


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE,
           end_id: int = END_ID) -> DataFrame:
    """doc_id, h, piece, start, length, ids_crc32: each document's ids and then end_id, cut every `sequence` ids.

    NULL text counts as empty: its one id is end_id. `h` is a hash of id, text and piece. Texts of any length are encoded
    whole, and an empty table gives no pieces.
    """
    kind = [("doc_id", pa.int64()), ("h", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
            ("ids_crc32", pa.int64())]
    end = np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).batch
        for whole in batches:
            for begin, stop in text_chunks(whole, 2, CHUNK):
                batch = whole.slice(begin, stop - begin)
                ids, counts = encode(batch.column(2))
                names, hashes, at, out = batch.column(0).to_pylist(), batch.column(1).to_pylist(), 0, []
                for name, h, count in zip(names, hashes, counts.tolist()):
                    own = np.concatenate([ids[at:at + count], end]).astype("<u4", copy=False)
                    at += count
                    for piece, start in enumerate(range(0, len(own), sequence)):
                        part = own[start:start + sequence]
                        out.append((name, h, piece, start, len(part), zlib.crc32(part)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), kind)], names=[n for n, _ in kind])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(row_key(id_col, F.col(text_col))).alias("h"),
                       F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, h bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(lengths: np.ndarray, capacity: tuple[int, int, int], weights: tuple[float, float, float] = (1.0, 0.05, 0.05),
             rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece. A bin has three capacities: tokens, documents, attention cost (sum of length squared).

    Pieces come longest first. Among the open bins that have room in every dimension one is selected: with rule "norm" the
    one whose residual after placing has the least weighted norm, with "dot" the one whose residual has the largest weighted
    dot product with the piece, all as shares of the capacities. Ties go to the older bin. A piece that fits
    nowhere opens a bin, also if it is larger than a capacity (it then stays alone).
    """
    cap_t, cap_d, cap_c = map(float, capacity)
    w_t, w_d, w_c = (w / c**2 for w, c in zip(weights, (cap_t, cap_d, cap_c)))
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    # Residuals of the open bins, in opening order; full bins are swept out now and then.
    open_t, open_d, open_c = np.zeros(256), np.zeros(256), np.zeros(256)
    name = np.zeros(256, np.int64)
    m, used, since = 0, 0, 0
    for i in np.argsort(-lengths, kind="stable"):
        size = float(lengths[i])
        since += 1
        if since > 512:
            live = np.flatnonzero((open_t[:m] > 0) & (open_d[:m] > 0) & (open_c[:m] > 0))
            for a in (open_t, open_d, open_c, name):
                a[:len(live)] = a[live]
            m, since = len(live), 0
        pick = -1
        if m:
            t, d, c = open_t[:m] - size, open_d[:m] - 1, open_c[:m] - size * size
            if rule == "norm":
                value = w_t * t * t + w_d * d * d + w_c * c * c
            else:
                value = -(w_t * open_t[:m] * size + w_d * open_d[:m] + w_c * open_c[:m] * size * size)
            value[(t < 0) | (d < 0) | (c < 0)] = np.inf
            best = int(value.argmin())
            if value[best] < np.inf:
                pick = best
        if pick < 0:
            if m == len(name):
                open_t, open_d, open_c, name = (np.concatenate([a, np.zeros_like(a)]) for a in (open_t, open_d, open_c, name))
            pick, m = m, m + 1
            open_t[pick], open_d[pick], open_c[pick], name[pick] = cap_t, cap_d, cap_c, used
            used += 1
        bins[i], offsets[i] = name[pick], int(cap_t - open_t[pick])
        open_t[pick] -= size
        open_d[pick] -= 1
        open_c[pick] -= size * size
    return bins, offsets


def pack(parts: DataFrame, capacity: tuple[int, int, int] = (SEQUENCE, SEQUENCE, SEQUENCE * SEQUENCE), group: int = GROUP,
         rule: str = "norm") -> DataFrame:
    """The pieces with sequence_id and offset. Groups of about `group` pieces, dealt by hash, are packed each in a task.

    A group wastes at most about one sequence; a full piece is a sequence of its own. Repeated rows are pieces of their own.
    """
    parts = saved(parts)
    n = parts.filter(F.col("length") < capacity[0]).count()
    groups = max(1, round(n / group))
    full = parts.filter(F.col("length") >= capacity[0]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"))
    # The row number inside its part spreads repeated rows, whose hashes are equal; the table is kept, so it is stable.
    dealt = parts.filter(F.col("length") < capacity[0]).withColumn(
        "g", F.pmod(F.xxhash64("h", "piece", F.monotonically_increasing_id()), F.lit(groups)).cast("int"))

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        bins, offsets = best_fit(rows["length"].to_numpy(), capacity, rule=rule)
        ids = (int(key[0].as_py()) << 32) + bins
        return rows.select(["doc_id", "piece", "start", "length", "ids_crc32"]).append_column(
            "sequence_id", pa.array(ids, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    packed = dealt.groupBy("g").applyInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
    return packed.unionByName(full)
