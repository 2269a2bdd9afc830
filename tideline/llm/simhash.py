"""SimHash near-duplicates, linked through the anchor points of a covering code.

The 64 bits are cut into three groups of 22, 21 and 21 bits. Two fingerprints that differ in at most 4 bits differ in at
most 1 bit of some group. The anchors of a group are the words of the binary Golay code of length 23; the group's bits are
padded with zeros. Every word lies within 3 bits of exactly one anchor (the covering radius). So in that group both
fingerprints lie within 3 + 1 bits of the first one's anchor. Each fingerprint is replicated to every anchor within 4 bits, and
fingerprints are compared per anchor. Finer anchors (`FINE`, pairs of smaller groups) give the same links from
more replicas and smaller anchors, for larger corpora.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import row_key, saved
from tideline.llm.components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
# Generator polynomials of the binary Golay code (length 23) and of the Hamming code (length 31).
GOLAY = 0b101011100011
HAMMING = 0b100101
TILE = 4096
# From so many distinct fingerprints on, finer anchors pay.
FINE_FROM = 20_000_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz     ")


def fingerprint(text: str | None) -> int:
    """64-bit SimHash of 4-word shingles, repeats included; 0 without words."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split(b" ")
    words = [w for w in words if w]
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words])
    joined = b" ".join(words)
    starts = np.concatenate([[0], ends[:-1]])
    n = max(len(words) - SHINGLE + 1, 1)
    stops = ends[min(SHINGLE, len(words)) - 1:] - 1
    digest = xxhash.xxh64_intdigest
    sums, total = np.zeros(64, np.int64), 0
    for begin in range(0, n, 1 << 16):
        a, z = starts[begin:begin + (1 << 16)][:n - begin].tolist(), stops[begin:begin + (1 << 16)].tolist()
        hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(a, z)], np.uint64)
        sums += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * sums > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fp (BIGINT, the unsigned bits as signed) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], ["id", "fp"])

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id bigint, fp bigint")


@dataclass(frozen=True)
class Anchors:
    """Covering of one group of fingerprint bits: a cyclic code cut to the group's length, and the bits it may differ in."""

    low: tuple[int, ...]
    sizes: tuple[int, ...]
    generator: int
    length: int
    radius: int
    slack: int

    def bits(self, prints: np.ndarray) -> np.ndarray:
        out, at = np.zeros(len(prints), np.uint64), 0
        for low, size in zip(self.low, self.sizes):
            out |= ((prints >> np.uint64(low)) & np.uint64((1 << size) - 1)) << np.uint64(at)
            at += size
        return out

    def syndrome_table(self) -> list[int]:
        """Remainder of each single-bit word by the generator."""
        degree, value, out = self.generator.bit_length() - 1, 1, []
        for _ in range(self.length):
            out.append(value)
            value <<= 1
            if value >> degree & 1:
                value ^= self.generator
        return out

    def patterns(self) -> tuple[np.ndarray, np.ndarray]:
        """(offsets by syndrome, error patterns): x ^ pattern is an anchor within radius + slack bits of x; the first
        pattern of a syndrome leads to the nearest anchor."""
        table = self.syndrome_table()
        found: dict[int, list[int]] = {}
        for weight in range(self.radius + self.slack + 1):
            for places in combinations(range(self.length), weight):
                syndrome = 0
                for place in places:
                    syndrome ^= table[place]
                found.setdefault(syndrome, []).append(sum(1 << p for p in places))
        rows = [found[s] for s in range(1 << (self.generator.bit_length() - 1))]
        return np.cumsum([0, *map(len, rows)]), np.array([e for r in rows for e in r], np.uint64)

    def syndromes(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        for place, value in enumerate(self.syndrome_table()[:sum(self.sizes)]):
            out ^= ((x >> np.uint64(place)) & np.uint64(1)).astype(np.int64) * value
        return out


COARSE = tuple(Anchors((low,), (size,), GOLAY, 23, 3, 1) for low, size in ((0, 22), (22, 21), (43, 21)))
# Five groups: 4 differing bits leave two groups with at most 1 between them.
_FIVE = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
FINE = tuple(Anchors((a[0], b[0]), (a[1], b[1]), HAMMING, 31, 1, 1) for a, b in combinations(_FIVE, 2))


def _replicas(prints: DataFrame, scheme: tuple[Anchors, ...]) -> DataFrame:
    """anchor, fp, home: each fingerprint at every anchor within reach; home at its nearest one of each group."""
    tables = [a.patterns() for a in scheme]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = np.asarray(batch.column(0))
            values = signed.view(np.uint64)
            for group, (anchors, (offsets, patterns)) in enumerate(zip(scheme, tables)):
                x = anchors.bits(values)
                syndromes = anchors.syndromes(x)
                counts = offsets[syndromes + 1] - offsets[syndromes]
                row = np.repeat(np.arange(len(x)), counts)
                first = np.repeat(np.cumsum(counts) - counts, counts)
                nth = np.arange(len(row)) - first
                anchor = (x[row] ^ patterns[offsets[syndromes][row] + nth]).astype(np.int64) + (group << 40)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(signed[row]), pa.array(nth == 0)],
                                                 ["anchor", "fp", "home"])

    return prints.select("fp").mapInArrow(run, "anchor bigint, fp bigint, home boolean")


def _tiled(rows: DataFrame, tile: int) -> DataFrame:
    """Cut large anchors into tiles of about tile homes by tile members; the rest are one tile."""
    large = (rows.groupBy("anchor").agg(F.count("*").alias("n"), F.count_if("home").alias("homes"))
             .filter(F.col("n") > tile)
             .select("anchor", F.ceil(F.col("n") / tile).cast("int").alias("across"),
                     F.greatest(F.ceil(F.col("homes") / tile), F.lit(1)).cast("int").alias("down")))
    at = lambda n: F.pmod(F.xxhash64(F.lit(3), "fp"), n).cast("int")
    cut = rows.join(large, "anchor", "left").withColumns(
        {"across": F.coalesce("across", F.lit(1)), "down": F.coalesce("down", F.lit(1))})
    span = lambda n: F.sequence(F.lit(0), n - 1)
    member = cut.select("anchor", "fp", F.lit(False).alias("home"), F.explode(F.transform(
        span(F.col("down")), lambda i: i * F.col("across") + at(F.col("across")))).alias("tile"))
    home = cut.filter("home").select("anchor", "fp", F.lit(True).alias("home"), F.explode(F.transform(
        span(F.col("across")), lambda j: at(F.col("down")) * F.col("across") + j)).alias("tile"))
    return member.unionByName(home)


def tile_forest(homes: np.ndarray, members: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links between homes and members within max_bits, thinned to a forest with the same components."""
    edges: list[tuple[int, int]] = []
    group = np.arange(len(members))
    block = max(1, (1 << 20) // max(len(members), 1))
    for begin in range(0, len(homes), block):
        some = homes[begin:begin + block]
        near = np.bitwise_count(some[:, None] ^ members[None, :]) <= max_bits
        near &= some[:, None] != members[None, :]
        for i in np.flatnonzero(near.any(1)):
            reached = np.flatnonzero(near[i])
            groups, at = np.unique(group[reached], return_index=True)
            edges += [(int(some[i]), int(members[reached[k]])) for k in at]
            if len(groups) > 1:
                group[np.isin(group, groups)] = groups[0]
    return edges


def _compare(tiles: DataFrame, max_bits: int) -> DataFrame:
    """a, b: linked fingerprints, a forest per tile."""

    def flush(table: np.ndarray) -> list[tuple[int, int]]:
        values, home = table["fp"].view(np.uint64), table["home"]
        # A fingerprint alone is its own home and member; two rows of a tile may also be two fingerprints.
        return tile_forest(values[home], values[~home], max_bits) if 0 < home.sum() < len(home) and (values != values[0]).any() else []

    kind = np.dtype([("anchor", "<i8"), ("tile", "<i4"), ("fp", "<i8"), ("home", "?")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros(0, kind)
        for last, batch in _with_last(batches):
            if batch is not None:
                new = np.zeros(batch.num_rows, kind)
                for k, name in enumerate(("anchor", "tile", "fp", "home")):
                    new[name] = batch.column(k).to_numpy(zero_copy_only=False)
                rest = np.concatenate([rest, new])
            if not len(rest):
                continue
            cuts = np.flatnonzero((rest["anchor"][1:] != rest["anchor"][:-1]) | (rest["tile"][1:] != rest["tile"][:-1])) + 1
            bounds = [0, *cuts.tolist(), *([len(rest)] if last else [])]
            edges = [e for i, j in zip(bounds, bounds[1:]) for e in flush(rest[i:j])]
            rest = rest[bounds[-1]:].copy()
            if edges:
                ends = np.array(edges, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy())], ["a", "b"])

    spark = tiles.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = tiles.select("anchor", "tile", "fp", "home").repartition(parts, "anchor", "tile").sortWithinPartitions("anchor", "tile")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def _with_last(batches: Iterator[pa.RecordBatch]):
    """The batches, then one call without a batch that says it was the last."""
    for batch in batches:
        yield False, batch
    yield True, None


def links(prints: DataFrame, max_bits: int = MAX_BITS, scheme: tuple[Anchors, ...] | None = None, tile: int = TILE) -> DataFrame:
    """a, b: pairs of distinct values of `fp` that connect all fingerprints within max_bits of each other.

    prints has one row per distinct fingerprint. Without a scheme their count decides between coarse anchors (16 replicas)
    and fine ones (155 replicas, anchors with a five-hundredth of the rows); the components are the same.
    """
    if max_bits > MAX_BITS:
        raise ValueError(f"these anchors cover up to {MAX_BITS} bits")
    scheme = scheme or (COARSE if prints.count() < FINE_FROM else FINE)
    return _compare(_tiled(_replicas(prints, scheme), tile), max_bits)


def classes(prints: DataFrame, max_bits: int = MAX_BITS, **options) -> DataFrame:
    """fp, least, root, component_id for rows (id, fp): least is the smallest id with that fingerprint, root names the
    fingerprint's component, component_id is the smallest id in it."""
    distinct = saved(prints.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(links(distinct, max_bits, **options))
    placed = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    best = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(best, "root").select("fp", "least", "root", "component_id")


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, **options) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row.

    NULL and empty texts have fingerprint zero and are linked like any other. Rows alike get the same result. A NULL id
    takes part; component_id is NULL only if a component has no other id. Texts of any length are read whole, and an empty table
    gives no rows.
    """
    prints = saved(fingerprints(docs, id_col, text_col))
    found = classes(prints, max_bits, **options)
    return prints.join(found, "fp").select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, max_bits: int = MAX_BITS, **options) -> DataFrame:
    """One row per component, the one with the smallest id (then the smallest text hash), all its columns unchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values), batch.column(2)], ["id", "fp", "key"])

    key = row_key("doc_id", F.col("text"))
    kind = dict(docs.select(key.alias("key")).dtypes)["key"]
    prints = saved(docs.select(F.col("doc_id").alias("id"), "text", key.alias("key")).mapInArrow(run, f"id bigint, fp bigint, key {kind}"))
    found = classes(prints, max_bits, **options)
    # Per component one key, combined in the tasks. Components are told apart by their root, as ids may repeat or be missing.
    first = prints.join(found, "fp").groupBy("root").agg(F.min("key").alias("first")).select("first")
    rows = docs.select(F.struct("*").alias("doc"), key.alias("key"))
    chosen = rows.join(first, F.col("key").eqNullSafe(F.col("first")), "left_semi")
    # Rows alike in id and text share the key; one of them stays.
    numbered = chosen.withColumn("nth", F.expr("row_number() over (partition by key order by key)")).filter("nth = 1")
    return numbered.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
