"""How far the sources of a language are apart, by the exact frequencies of the terms that the language keeps.

A first pass counts in how many documents of a language each term occurs. The kept terms are dealt by hash to shards of a few
thousand; each shard gets a minimal perfect hash (hash and displace) whose slots also store the terms. The second
pass looks every word up in broadcast shards, verifies it against the stored term, and counts it in the dense slots of its
document's group. What is broadcast is bounded: a vocabulary beyond BROADCAST bytes takes several passes, each
over some of the shards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import saved, text_chunks

KEEP = 10
TOP = 10
SCALE = 1_000_000_000
SHARD = 4096
# Bytes of shards that are broadcast at once, bytes of text that are split together, dense slots that a task holds.
BROADCAST = 1 << 26
CHUNK = 1 << 23
CELLS = 1 << 24
# Groups of one language that are compared with one another in one task.
TILE = 128
SEED = 42
_TRIALS = 1 << 20
_TERM = bytes(b >= 0x80 or chr(b).isalpha() for b in range(256))


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def _slot(h: np.ndarray, displacement: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    moved = _mix(h + displacement.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (moved % np.asarray(n, np.uint64)).astype(np.int64)


def hashes(terms: list[bytes], seed: int = SEED) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(t, seed) for t in terms), np.uint64, len(terms))


def displacements(h: np.ndarray) -> np.ndarray | None:
    """One number per bucket (about four keys each) that sends all keys to slots of their own, 0 to len(h) - 1.

    A bucket of one key names its slot itself, as -1 - slot. None if hashes are alike, or no number was found.
    """
    n, m = len(h), len(h) // 4 + 1
    bucket = (_mix(h) % np.uint64(m)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=m)
    ends = np.cumsum(sizes)
    found, free = np.zeros(m, np.int64), np.ones(n, bool)
    for b in np.argsort(-sizes, kind="stable"):
        own = h[order[ends[b] - sizes[b]:ends[b]]]
        if len(own) < 2:
            break
        begin, step = 0, 32
        while begin < _TRIALS:
            slots = _slot(own[None, :], np.arange(begin, begin + step)[:, None], n)
            good = free[slots].all(1)
            good[good] = (np.diff(np.sort(slots[good], 1), axis=1) > 0).all(1)
            if good.any():
                found[b] = begin + int(good.argmax())
                free[slots[good.argmax()]] = False
                break
            begin, step = begin + step, min(2 * step, 4096)
        else:
            return None
    singles = np.flatnonzero(sizes == 1)
    found[singles] = -1 - np.flatnonzero(free)
    return found


def build_shard(terms: list[bytes]) -> tuple[int, np.ndarray, list[bytes]]:
    """(seed, displacements, terms in the order of their slots)."""
    for seed in range(SEED, SEED + 64):
        h = hashes(terms, seed)
        found = displacements(h)
        if found is not None:
            places = shard_slots(h, found, len(terms))
            ordered = [b""] * len(terms)
            for term, place in zip(terms, places.tolist()):
                ordered[place] = term
            return seed, found, ordered
    raise ValueError("no perfect hash of a shard was found")


def shard_slots(h: np.ndarray, found: np.ndarray, n: int) -> np.ndarray:
    d = found[(_mix(h) % np.uint64(len(found))).astype(np.int64)]
    return np.where(d < 0, -1 - d, _slot(h, np.maximum(d, 0), n))


@dataclass
class LanguageShards:
    """The shards of one language that are at hand, their slots numbered on from each other."""

    shards: int
    names: list[int] = field(default_factory=list)

    def load(self, rows: list) -> LanguageShards:
        rows = sorted(rows, key=lambda r: r.shard)
        self.names = [r.shard for r in rows]
        self.n, self.base, self.buckets, self.bucket_base = (np.zeros(self.shards, np.int64) for _ in range(4))
        self.seeds = np.full(self.shards, SEED)
        found, keys, slots, buckets = [], [], 0, 0
        for r in rows:
            one = np.frombuffer(r.displacements, "<i8")
            self.n[r.shard], self.base[r.shard], self.buckets[r.shard], self.bucket_base[r.shard] = r.n, slots, len(one), buckets
            self.seeds[r.shard] = r.seed
            found.append(one)
            keys.append(_terms(r.ends, r.terms))
            slots, buckets = slots + r.n, buckets + len(one)
        self.found, self.keys, self.slots = np.concatenate(found), pa.concat_arrays(keys), slots
        return self

    def lookup(self, h: np.ndarray, words: pa.Array) -> np.ndarray:
        """Slots of words (with their hashes of SEED), -1 for a word that is no kept term."""
        shard = h.view(np.int64) % self.shards
        known = self.n[shard] > 0
        if not known.any():
            return np.full(len(h), -1)
        odd = np.flatnonzero(known & (self.seeds[shard] != SEED))
        if len(odd):
            h = h.copy()
            for i, word in zip(odd.tolist(), words.take(pa.array(odd)).to_pylist()):
                h[i] = xxhash.xxh64_intdigest(word, int(self.seeds[shard[i]]))
        bucket = (_mix(h) % np.maximum(self.buckets[shard], 1).astype(np.uint64)).astype(np.int64) + self.bucket_base[shard]
        d = self.found[np.where(known, bucket, 0)]
        slot = np.where(d < 0, -1 - d, _slot(h, np.maximum(d, 0), np.maximum(self.n[shard], 1)))
        slot = np.where(known, slot + self.base[shard], 0)
        # A word that is no kept term lands in some slot as well; only the stored term tells.
        same = np.asarray(pa.compute.equal(self.keys.take(pa.array(slot)), words))
        return np.where(known & same, slot, -1)


def _terms(ends: bytes, flat: bytes) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(ends) // 8, [None, pa.py_buffer(np.append(0, np.frombuffer(ends, "<i8")).astype(np.int64)), pa.py_buffer(flat)])


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(different words, number of each word in the texts among them, first word of each text and the end).

    Words are the longest runs of letters A-Z, a-z and code points above 127, with A-Z in lower case.
    """
    flat = pa.compute.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset:flat.offset + len(flat) + 1]
    low = int(bounds[0])
    raw = flat.buffers()[2].slice(low, int(bounds[-1]) - low).to_pybytes().lower() if bounds[-1] > low else b""
    bounds = bounds - low
    inside = np.frombuffer(raw.translate(_TERM), np.bool_)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    own = bounds[:-1][bounds[:-1] < bounds[1:]]
    begins[own] = inside[own]
    kept = np.frombuffer(raw, np.uint8)[inside]
    offsets = np.append(np.flatnonzero(begins[inside]), len(kept)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), np.searchsorted(np.flatnonzero(begins), bounds)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple], np.ndarray, pa.Array]]:
    """(groups, group of each text in ascending order, texts) of parts of the batches (lang, source, text)."""
    for whole in batches:
        for begin, stop in text_chunks(whole, 2, CHUNK):
            batch = whole.slice(begin, stop - begin)
            pairs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            groups = sorted(set(pairs))
            place = {g: i for i, g in enumerate(groups)}
            of = np.array([place[p] for p in pairs])
            order = np.argsort(of, kind="stable")
            yield groups, of[order], batch.column(2).take(pa.array(order))


def document_counts(docs: DataFrame) -> DataFrame:
    """lang, term (BINARY), n: parts of the numbers of documents that hold the term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups, of, texts in _chunks(batches):
            words, index, bounds = split_words(texts)
            if not len(words):
                continue
            langs = sorted({g[0] for g in groups})
            lang = np.array([langs.index(g[0]) for g in groups])
            doc = np.repeat(np.arange(len(of)), np.diff(bounds))
            once = np.unique(doc * len(words) + index)
            pairs, n = np.unique(lang[of[once // len(words)]] * len(words) + once % len(words), return_counts=True)
            yield pa.RecordBatch.from_arrays([
                pa.array(langs, pa.string()).take(pa.array(pairs // len(words))), words.take(pa.array(pairs % len(words))).cast(pa.binary()),
                pa.array(n.astype(np.int64))], ["lang", "term", "n"])

    return docs.select("lang", "source", "text").mapInArrow(run, "lang string, term binary, n bigint")


def shards_of(kept: DataFrame, shards: int) -> DataFrame:
    """lang, shard, n, seed, displacements, ends, terms: the perfect hash of every shard that has terms."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        # In a fixed order, so that a shard built again has the same slots.
        seed, found, terms = build_shard(sorted(rows["term"].to_pylist()))
        ends = np.cumsum([len(t) for t in terms]).astype("<i8")
        return pa.table({"lang": [key[0].as_py()], "shard": pa.array([key[1].as_py()], pa.int32()), "n": [len(terms)], "seed": [seed],
                         "displacements": [found.astype("<i8").tobytes()], "ends": [ends.tobytes()], "terms": [b"".join(terms)]})

    dealt = kept.select("lang", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int").alias("shard"), "term")
    return dealt.groupBy("lang", "shard").applyInArrow(
        run, "lang string, shard int, n bigint, seed bigint, displacements binary, ends binary, terms binary")


def recount(docs: DataFrame, rows: list, shards: int) -> DataFrame:
    """lang, source, shard, at, counts: parts of the occurrences per group and slot, of the given shards' terms."""
    by_lang: dict[str, list] = {}
    for row in rows:
        by_lang.setdefault(row.lang, []).append(row)
    shared = docs.sparkSession.sparkContext.broadcast({lang: LanguageShards(shards).load(own) for lang, own in by_lang.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value
        dense: dict[tuple, np.ndarray] = {}
        cells = seen = 0

        def parts() -> Iterator[pa.RecordBatch]:
            for (lang, source), slots in dense.items():
                own = tables[lang]
                used = np.flatnonzero(slots)
                edges = np.searchsorted(used, [*own.base[own.names], own.slots])
                out = [(lang, source, s, (used[i:j] - own.base[s]).astype("<u2").tobytes(), slots[used[i:j]].astype("<i8").tobytes())
                       for s, i, j in zip(own.names, edges[:-1], edges[1:]) if i < j]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                        pa.string(), pa.string(), pa.int32(), pa.binary(), pa.binary()))], ["lang", "source", "shard", "at", "counts"])

        for groups, of, texts in _chunks(batches):
            words, index, bounds = split_words(texts)
            if not len(words):
                continue
            h = hashes(words.to_pylist())
            first = np.searchsorted(of, np.arange(len(groups) + 1))
            slot, now = None, None
            for g, (lang, source) in enumerate(groups):
                if lang not in tables:
                    continue
                if lang != now:  # groups are sorted, so a language's texts stand together
                    last = max(k for k, other in enumerate(groups) if other[0] == lang)
                    used = np.unique(index[bounds[first[g]]:bounds[first[last + 1]]])
                    slot, now = np.full(len(words), -1), lang
                    slot[used] = tables[lang].lookup(h[used], words.take(pa.array(used)))
                if (lang, source) not in dense:
                    if cells + tables[lang].slots > CELLS or seen > 1 << 31:
                        yield from parts()
                        dense, cells, seen = {}, 0, 0
                    dense[lang, source] = np.zeros(tables[lang].slots, np.uint32)
                    cells += tables[lang].slots
                own = slot[index[bounds[first[g]]:bounds[first[g + 1]]]]
                np.add.at(dense[lang, source], own[own >= 0], 1)
                seen += len(own)
        yield from parts()

    return docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, shard int, at binary, counts binary")


def _summed(parts: DataFrame, *keys: str) -> DataFrame:
    """One row per key with `at`, `counts` and `total`; parts are added one after the other."""
    kinds = {"lang": "string", "source": "string", "shard": "int"}
    types = {"string": pa.string(), "int": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(1 << 16, np.int64)

        def row() -> pa.RecordBatch:
            used = np.flatnonzero(total)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], types[kinds[k]]) for k, v in zip(keys, now)] + [
                    pa.array([used.astype("<u2").tobytes()], pa.binary()), pa.array([total[used].astype("<i8").tobytes()], pa.binary()),
                    pa.array([int(total.sum())], pa.int64())], [*keys, "at", "counts", "total"])

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(len(keys))]
            for key, at, counts in zip(zip(*columns), batch.column(len(keys)), batch.column(len(keys) + 1)):
                if key != now:
                    if now is not None:
                        yield row()
                        total[:] = 0
                    now = key
                total[np.frombuffer(at.as_py(), "<u2")] += np.frombuffer(counts.as_py(), "<i8")
        if now is not None:
            yield row()

    dealt = parts.select(*keys, "at", "counts").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", at binary, counts binary, total bigint")


def _share(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), exactly."""
    over, rest = total + 2 * kept, counts + 2
    if int(rest.max(initial=0)) < (1 << 63) // SCALE:
        return 1 + rest * SCALE // over
    out = np.zeros_like(rest)
    for _ in range(3):  # digit by digit in base 1000, each step within 64 bits
        rest = rest * 1000
        out, rest = out * 1000 + rest // over, rest % over
    return 1 + out


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _dense(n: int, at: bytes | None, counts: bytes | None) -> np.ndarray:
    out = np.zeros(n, np.int64)
    if at:
        out[np.frombuffer(at, "<u2")] = np.frombuffer(counts, "<i8")
    return out


def _top_terms(counts: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """lang, source, item, value of the `top` terms of each group and shard (ties to the smaller term).

    counts: lang, shard, source, total, kept, at, counts. totals: the same per language (source NULL), with ends and terms;
    they head their shard, so that a task holds one shard's terms and streams the groups past them.
    """
    blank = F.lit(None).cast("binary")
    columns = ["lang", "shard", "source", "total", "kept", "at", "counts", "ends", "terms"]
    rows = totals.select(*columns).unionByName(counts.withColumns({"ends": blank, "terms": blank}).select(*columns))
    rows = rows.repartition("lang", "shard").sortWithinPartitions("lang", "shard", F.col("ends").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, q = None, None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["ends"] is not None:
                    terms = _terms(r["ends"], r["terms"])
                    q = _share(_dense(len(terms), r["at"], r["counts"]), r["total"], r["kept"])
                    continue
                at = np.frombuffer(r["at"], "<u2").astype(np.int64)
                p = _share(np.frombuffer(r["counts"], "<i8"), r["total"], r["kept"])
                above = np.flatnonzero(p > q[at])
                value, at = _apart(p[above], q[at[above]]), at[above]
                if len(value) > top:
                    near = value >= np.partition(value, len(value) - top)[len(value) - top]
                    value, at = value[near], at[near]
                items = terms.take(pa.array(at)).to_pylist()
                best = sorted(zip((-value).tolist(), items))[:top]
                out += [(r["lang"], r["source"], item, -v) for v, item in best]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.string(), pa.binary(), pa.int64()))],
                                                 ["lang", "source", "item", "value"])

    return rows.mapInArrow(run, "lang string, source string, item binary, value bigint").withColumn("item", F.col("item").cast("string"))


def _pairs(rows: DataFrame, tiles: int) -> DataFrame:
    """lang, source, item, value: parts per shard of the difference of every two groups of a language.

    rows: lang, shard, source, total, kept, n, at, counts for every group and shard. Groups are dealt to tiles by their
    source's hash; each two tiles of a shard meet in one task.
    """
    own = F.pmod(F.xxhash64("source"), F.lit(tiles)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
    rows = rows.withColumn("own", own).withColumn("other", other).withColumns(
        {"a": F.least("own", "other"), "b": F.greatest("own", "other")})
    keys = ["lang", "shard", "a", "b"]
    rows = rows.select(*keys, "own", "source", "total", "kept", "n", "at", "counts").repartition(*keys).sortWithinPartitions(*keys, "source")

    def compare(key: tuple, held: list) -> Iterator[pa.RecordBatch]:
        lang, _, a, b = key
        left, right = ([h for h in held if h[0] == t] for t in (a, b))
        if not left or not right:
            return
        matrix = np.stack([h[2] for h in right])
        out = []
        for i, (_, source, p) in enumerate(left):
            begin = i + 1 if a == b else 0
            value = _apart(p, matrix[begin:]).sum(1)
            out += [(source, h[1], v) for h, v in zip(right[begin:], value.tolist())]
        if out:
            one, two, value = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * 2 * len(out), pa.string()), pa.array(one + two, pa.string()),
                                              pa.array(two + one, pa.string()), pa.array(value + value, pa.int64())], ["lang", "source", "item", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for r in batch.to_pylist():
                key = tuple(r[k] for k in keys)
                if key != now:
                    if held:
                        yield from compare(now, held)
                    now, held = key, []
                counts = _dense(r["n"], r["at"], r["counts"])
                held.append((r["own"], r["source"], _share(counts, r["total"], r["kept"]) if r["n"] else counts))
        if held:
            yield from compare(now, held)

    return rows.mapInArrow(run, "lang string, source string, item string, value bigint")


def audit(docs: DataFrame, keep: int = KEEP, top: int = TOP, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
          shard: int = SHARD) -> DataFrame:
    """lang, source, part, item, value, rank: for each group (lang, source) its distance from every other source of the
    language (part `pair`), and the `top` terms that it uses more than the language does (part `term`).

    NULL text, lang and source count as ''. Every row is a document, repeated rows too. A language keeps the terms of at least
    `keep` of its documents; one without kept terms gives pairs of value 0 and no terms. Ties go to the item first in UTF-8 order.
    Counts are exact for texts of any length. An empty table gives no rows.
    """
    blank = [F.coalesce(F.col(c), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    docs = docs.select(*blank)
    kept = saved(document_counts(docs).groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= keep).select("lang", "term"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum(F.length("term") + 16).alias("bytes"))
    found = sizes.agg(F.max("kept").alias("most"), F.sum("bytes").alias("bytes")).first()
    passes = max(1, -(-(found.bytes or 0) * 2 // BROADCAST))
    shards = max(1, -(-(found.most or 0) // shard), passes if passes > 1 else 1)
    hashed = saved(shards_of(kept, shards))
    held = F.length("terms") + F.length("ends") + F.length("displacements")
    while passes < shards:
        largest = hashed.groupBy((F.col("shard") % passes).alias("p")).agg(F.sum(held).alias("bytes")).agg(F.max("bytes")).first()[0]
        if (largest or 0) <= BROADCAST:
            break
        passes = min(2 * passes, shards)
    parts = None
    for p in range(passes):
        one = recount(docs, hashed.filter(F.col("shard") % passes == p).collect(), shards)
        parts = one if parts is None else parts.unionByName(one)
    counts = saved(_summed(parts, "lang", "source", "shard"))

    kept_terms = sizes.select("lang", "kept")
    groups = (docs.select("lang", "source").distinct()
              .join(counts.groupBy("lang", "source").agg(F.sum("total").alias("total")), ["lang", "source"], "left")
              .join(kept_terms, "lang", "left").na.fill(0, ["total", "kept"]))
    groups = saved(groups)
    whole = counts.groupBy("lang").agg(F.sum("total").alias("total")).join(kept_terms, "lang")
    totals = (_summed(counts, "lang", "shard").drop("total").join(hashed.select("lang", "shard", "ends", "terms"), ["lang", "shard"])
              .join(whole, "lang").withColumn("source", F.lit(None).cast("string")))
    terms = _top_terms(counts.drop("total").join(groups, ["lang", "source"]), totals, top)

    most = groups.groupBy("lang").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    every = groups.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    every = (every.join(hashed.select("lang", "shard", "n"), ["lang", "shard"], "left").na.fill(0, ["n"])
             .join(counts.drop("total"), ["lang", "source", "shard"], "left"))
    pairs = _pairs(every, max(1, -(-most // TILE))).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (pairs.withColumns({"part": F.lit("pair"), "rank": rank}).select(*columns)
            .unionByName(terms.withColumns({"part": F.lit("term"), "rank": rank}).filter(F.col("rank") <= top).select(*columns)))
