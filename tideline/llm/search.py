"""Exact top-k inner products by MaxScore over integer vectors.

A vector's components are its terms. In a shard, a term's contribution to a query is counted from the least one that any vector
has, so the posting list of a term holds the vectors above that, and the term's bound is the largest gain. Terms are sorted
by bound; the non-essential ones are as many of the smallest as cannot lift a vector to the k-th best score by themselves. Vectors are taken
block by block: the postings of the essential terms are traversed, vectors that the others cannot lift to the threshold are
dropped, and for the rest the others are probed, largest bound first, while a vector is competitive. Every block may raise the
threshold, which moves the split. Shards are merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import saved

SCALE = 1024
TOP = 10
EVERY = 100
# Vectors of a shard while there are fewer shards than tasks, and bytes of a shard from then on.
SHARD = 16_384
SHARD_BYTES = 1 << 25
BLOCK = 4096
PROBE = 8


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, v (BIGINT array of floor(scale * x)) of the vectors that take part.

    Rows with a NULL id, a NULL vector or a NULL or non-finite component take no part. Rows alike in id and
    vector are one vector. Shorter vectors count as padded with zeros.
    """
    x = F.col("x")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    given = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    return (given.filter(F.col("vec_id").isNotNull() & x.isNotNull() & finite)
            .select("vec_id", F.transform("x", lambda c: F.floor(c * scale).cast("bigint")).alias("v")).distinct())


class Shard:
    """Postings of one shard: term by term the components of all its vectors in the order of their ids, with their range."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, rows = ids[order], rows[order]
        self.postings = np.ascontiguousarray(rows.T)
        self.low, self.high = (f(rows, 0, initial=0).astype(np.float64) for f in (np.min, np.max))
        self.read = 0  # components looked at

    def tops(self, own: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query (ids, scores) of the k best vectors but the one of its own id; equal scores go to the smaller id."""
        asked = [_Query(int(o), q[:len(self.postings)].astype(np.float64), self.low, self.high, k) for o, q in zip(own, queries)]
        for begin in range(0, len(self.ids), BLOCK):
            ids, block = self.ids[begin:begin + BLOCK], self.postings[:, begin:begin + BLOCK].astype(np.float64)
            for query in asked:
                self.read += query.take(ids, block)
        return [(q.ids, q.scores) for q in asked]


class _Query:
    """One query on its way through the blocks of a shard."""

    def __init__(self, own: int, query: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        ends = query * low[:len(query)], query * high[:len(query)]
        least, most = np.minimum(*ends), np.maximum(*ends)
        terms = np.argsort(least - most, kind="stable")
        self.terms = terms[query[terms] != 0]
        self.own, self.k, self.weights = own, k, query[self.terms]
        # What the terms from the j-th on give at most, and what a vector reaches at most without a gain in the first j.
        self.rest = np.append(np.cumsum(most[self.terms][::-1])[::-1], 0.0)
        self.without = np.append(0.0, np.cumsum(least[self.terms])) + self.rest
        self.ids, self.scores, self.limit = np.zeros(0, np.int64), np.zeros(0), -np.inf

    def take(self, ids: np.ndarray, block: np.ndarray) -> int:
        """Take in a block of vectors (a column each); returns how many components were read."""
        n = len(self.terms)
        # The essential terms: the fewest without which the threshold is out of reach. `without` falls from term to term.
        done = n if self.limit == -np.inf else min(int(np.searchsorted(-self.without, -self.limit, side="right")), n)
        found, left = self.weights[:done] @ block[self.terms[:done]], self.terms[done:]
        read = done * len(ids)
        while done < n:
            keep = found + self.rest[done] >= self.limit
            alive = int(keep.sum())
            if not alive:
                return read
            # Postings are cut to the vectors still competitive whenever half of them are gone.
            if 2 * alive < len(ids):
                ids, found, block = ids[keep], found[keep], block[left][:, keep]
                left = np.arange(len(left))
            step, left = left[:PROBE], left[PROBE:]
            found = found + self.weights[done:done + PROBE] @ block[step]
            read += len(step) * len(ids)
            done += len(step)
        better = (found >= self.limit) & (ids != self.own)
        if better.any():
            ids, scores = np.concatenate([self.ids, ids[better]]), np.concatenate([self.scores, found[better]])
            best = np.lexsort((ids, -scores))[:self.k]
            self.ids, self.scores = ids[best], scores[best]
            self.limit = self.scores[-1] if len(best) == self.k else -np.inf
        return read


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    sizes = np.diff(np.asarray(column.offsets))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), flat.dtype)
    row = np.repeat(np.arange(len(column)), sizes)
    nth = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, nth] = flat
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP, shard: int = SHARD) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query the k vectors with the highest integer inner product.

    Both frames are (vec_id, v). A vector with the query's own id is no candidate; ties go to the smaller id. Exact while
    scores stay below 2**53. Vectors are dealt to shards by hash, in the smallest integers that hold them: of about `shard` vectors
    while there are fewer shards than shuffle partitions, later of SHARD_BYTES. Each shard reads the queries as a stream of
    batches, and hands on k rows per query, of which the merge keeps k. An empty table, or one without queries, gives no rows.
    """
    spark = vectors.sparkSession
    shape = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.min(F.array_min("v")).alias("low"),
                        F.max(F.array_max("v")).alias("high")).first()
    asked = queries.agg(F.max(F.size("v")).alias("width"), F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high")).first()
    width = max(shape.width or 0, asked.width or 0, 1)
    most = max(-(shape.low or 0), -(asked.low or 0), (shape.high or 0) + 1, (asked.high or 0) + 1)
    kind, size = ("smallint", 2) if most <= 1 << 15 else ("int", 4) if most <= 1 << 31 else ("bigint", 8)
    parts, n = int(spark.conf.get("spark.sql.shuffle.partitions")), shape.n or 0
    shards = max(1, -(-n * width * size // SHARD_BYTES), min(parts, -(-n // shard)))
    v = F.col("v").cast(f"array<{kind}>").alias("v")
    stored = vectors.select(F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"), "vec_id", v)
    asking = queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "vec_id", v)
    both = stored.unionByName(asking).repartition(parts, "shard").sortWithinPartitions("shard", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, rows, index = None, [], [], None
        for batch in batches:
            where, kind, names = (batch.column(c).to_numpy() for c in range(3))
            values = _matrix(batch.column(3), width)
            edges = np.flatnonzero((np.diff(where) != 0) | (np.diff(kind) != 0)) + 1
            for i, j in zip([0, *edges], [*edges, len(where)]):
                if i == j:
                    continue
                if where[i] != now:
                    now, ids, rows, index = where[i], [], [], None
                if kind[i] == 0:
                    ids.append(names[i:j])
                    rows.append(values[i:j])
                    continue
                if not ids:
                    continue
                index = index or Shard(np.concatenate(ids), np.concatenate(rows))
                found = [(int(q), *best) for q, best in zip(names[i:j], index.tops(names[i:j], values[i:j], k))]
                query = np.repeat([q for q, _, _ in found], [len(x) for _, x, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query.astype(np.int64)), pa.array(np.concatenate([x for _, x, _ in found]).astype(np.int64)),
                     pa.array(np.concatenate([x for _, _, x in found]).astype(np.int64))], ["query_id", "vec_id", "score"])

    found = both.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(table: DataFrame, every: int = EVERY, k: int = TOP, **options) -> DataFrame:
    """Queries are the vectors whose id is divisible by `every`; candidates are all vectors but the query's own."""
    vectors = saved(integer_vectors(table))
    return top_k(vectors, vectors.filter(F.col("vec_id") % every == 0), k, **options)
