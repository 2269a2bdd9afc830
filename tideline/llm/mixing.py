"""Mixing sources to target weights by subset sums over exact document lengths."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import row_key, saved

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
WINDOW = 32_768
# The most sums of words that one knapsack tells apart, a bit and four bytes each.
LIMIT = 1 << 24
# The most work of one knapsack: words of reached sums times steps, about a second.
WORK = 1 << 29
SEED = 17
SUB_BITS = 12


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """key, doc_id, source, size: size is the number of [^\\x20\\x09-\\x0D]+ in the whole text, NULL counts 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # bytes.split() parts at exactly these six characters.
            sizes = [len(t.encode("utf-8", "replace").split()) if t else 0 for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sizes, pa.int64())], ["key", "doc_id", "source", "size"])

    light = docs.select(row_key(id_col, F.col(text_col)).alias("key"), F.col(id_col).alias("doc_id"),
                        F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    kinds = dict(light.dtypes)
    return light.mapInArrow(run, f"key {kinds['key']}, doc_id {kinds['doc_id']}, source string, size bigint")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, total: float | None = None) -> DataFrame:
    """source, size, weight, target for a table (source, size) with one row per source.

    Sources in code point order (NULL last) weigh weights[0], weights[1], ... repeating and share `total` (all
    sizes by default). A target stops at max_epochs times its source's size; the excess goes to the others by weight
    until none is above. Only one number per round comes to the driver; the ranking handles one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(order) - 1
    ranked = saved(sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                           (rank % len(weights) + 1).cast("int"))))
    sums = ranked.agg(F.sum("size").alias("s"), F.sum("weight").alias("w")).first()
    budget = float(sums.s or 0) if total is None else float(total)
    budget = min(budget, max_epochs * float(sums.s or 0))
    level = budget / sums.w if sums.w else 0.0
    cap = F.col("size") * float(max_epochs)
    while True:
        full = cap <= F.col("weight") * level
        got = ranked.agg(F.sum(F.when(full, cap).otherwise(0.0)).alias("capped"),
                         F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        if not got.open:
            break
        raised = (budget - got.capped) / got.open
        if raised <= level:
            break
        level = raised
    return ranked.withColumn("target", F.least(cap.cast("double"), F.col("weight") * level))


def _shifted(words: np.ndarray, by: int) -> np.ndarray:
    """The bits of a row of 64-bit words moved up by `by` places (down if negative)."""
    far, near = divmod(abs(by), 64)
    out = np.zeros_like(words)
    if far >= len(words):
        return out
    part = words[:len(words) - far] if by > 0 else words[far:]
    to = out[far:] if by > 0 else out[:len(words) - far]
    up, down = np.uint64(near), np.uint64(64 - near)
    to[:] = part << up if by > 0 else part >> up
    if near and by > 0:
        to[1:] |= part[:-1] >> down
    elif near:
        to[:-1] |= part[1:] << down
    return out


def _knapsack(lengths: np.ndarray, add: np.ndarray, drop: np.ndarray, goal: int, low: int, high: int, least: int = 0) -> np.ndarray:
    """How many documents of each length to add (or, negative, to drop) for a sum as near to `goal` as can be.

    At most add[i] and drop[i] of a length move, in powers of two; sums stay within low..high all the way. Lengths enter in the
    order given, until a sum is `least` from the goal, or until WORK is used up: then the nearest sum of the lengths so far counts.
    Below wins a tie. Reached sums are bits of words; per sum only the step that reached it first is kept.
    """
    size = high - low + 1
    first = np.full(size, -1, np.int32)
    reached = np.zeros(-(-size // 64), np.uint64)
    reached[-low // 64] = np.uint64(1 << (-low % 64))
    inside = np.uint64((1 << 64) - 1 >> -size % 64)
    near = [p for p in (goal - least - low, goal + least - low) if 0 <= p < size]
    steps: list[tuple[int, int]] = []
    # A step costs as much as its words, and some more whatever they are.
    allowed = max(1, WORK // (len(reached) + 4096))
    for i, length in enumerate(lengths.tolist()):
        for sign, remaining in ((1, int(add[i])), (-1, int(drop[i]))):
            remaining, power = min(remaining, (high - low) // length) if length else 0, 1
            while remaining > 0 and len(steps) < allowed and not any(int(reached[p // 64]) >> p % 64 & 1 for p in near):
                part = min(power, remaining)
                remaining -= part
                power *= 2
                new = _shifted(reached, sign * part * length) & ~reached
                new[-1] &= inside
                some = np.flatnonzero(new)
                bits = np.unpackbits(new[some].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                row, bit = np.nonzero(bits)
                first[some[row] * 64 + bit] = len(steps)
                reached |= new
                steps.append((i, sign * part))
    sums = np.flatnonzero(np.unpackbits(reached.astype("<u8").view(np.uint8), bitorder="little")[:size])
    at = int(sums[np.argmin(np.abs(sums - (goal - low)))])
    moved = np.zeros(len(lengths), np.int64)
    while first[at] >= 0:
        # What a sum came from was reached in an earlier step.
        i, part = steps[first[at]]
        moved[i] += part
        at -= part * int(lengths[i])
    return moved


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, window: int = WINDOW, limit: int = LIMIT) -> np.ndarray:
    """How many documents of each length to take, so that their lengths add up to `budget` as nearly as can be.

    lengths are distinct and positive. First the bulk is a proportional share of every length, topped up from the longest, and
    the remaining budget, at most about `window`, is met by a bounded knapsack over the documents left. If that is not the
    best that the lengths' common divisor allows, documents of any length are decided anew: all of them by one
    knapsack where twice the budget (or twice what it leaves out) is at most `limit` words, which is exact; else by
    exchanges around the bulk, where the sums on the way stay within limit / 2 words of it. Lengths above limit / 4 are
    then exchanged in coarser units first. Each of these at most four knapsacks stops at WORK; until then its answer is
    the nearest there is among the sums named.
    """
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    # No sum is nearer than the nearest multiple of the common divisor.
    over = budget % int(np.gcd.reduce(lengths))
    least = min(over, int(np.gcd.reduce(lengths)) - over)
    gap = lambda t: abs(int((lengths * t).sum()) - budget)
    # What the knapsack is left to fill: enough for any pattern of short documents.
    bulk = max(budget - window, 0)
    taken = np.floor(counts * (bulk / total)).astype(np.int64)
    rest = bulk - int((lengths * taken).sum())
    part = counts * (bulk / total) - taken
    for i in np.argsort(-part, kind="stable"):
        if part[i] > 0 and taken[i] < counts[i] and lengths[i] <= rest:
            taken[i] += 1
            rest -= int(lengths[i])
    for i in np.argsort(-lengths):
        more = min(int(counts[i] - taken[i]), rest // int(lengths[i]))
        taken[i] += more
        rest -= more * int(lengths[i])
    rest = budget - int((lengths * taken).sum())
    none, order, found = np.zeros_like(counts), np.argsort(-lengths), taken.copy()
    if rest + window <= limit:
        short = order[::-1][lengths[order[::-1]] <= rest + window]
        found[short] += _knapsack(lengths[short], (counts - taken)[short], none[short], rest, 0, rest + window, least)
    if gap(found) == least:
        return found
    smaller = min(budget, total - budget)
    if 2 * smaller <= limit:
        # Nothing taken, or nothing left out, is `smaller` off: no nearer sum lies beyond twice that.
        some = order[lengths[order] <= 2 * smaller]
        moved = none.copy()
        moved[some] = _knapsack(lengths[some], counts[some], none[some], smaller, 0, min(total, 2 * smaller), least)
        return moved if smaller == budget else counts - moved
    half = limit // 2
    unit = -(-4 * int(lengths.max()) // limit)
    for step in ([unit, 1] if unit > 1 else [1]):
        start = min((taken, found), key=gap) if step == 1 and unit > 1 else taken
        sizes = (lengths[order] + step // 2) // step
        moves = (sizes > 0) & (sizes <= half)
        some, rest = order[moves], budget - int((lengths * start).sum())
        taken = start.copy()
        taken[some] += _knapsack(sizes[moves], (counts - start)[some], start[some], max(min(round(rest / step), half), -half),
                                 -half, half, least if step == 1 else 0)
        found = min((found, taken), key=gap)
    return found


def _fit_sources(histogram: DataFrame, window: int) -> DataFrame:
    """source, size, take: for each source its length table (one row per distinct length) is fitted in one task."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        sizes = np.asarray(rows["size"])
        order = np.argsort(sizes, kind="stable")
        sizes, counts = sizes[order], np.asarray(rows["n"])[order]
        budget = int(rows["budget"][0].as_py())
        take = fit_budget(sizes, counts, budget, window)
        return pa.table({"slot": pa.array([rows["slot"][0].as_py()] * len(sizes), pa.int64()), "size": sizes, "take": take})

    return histogram.groupBy("slot").applyInArrow(run, "slot bigint, size bigint, take bigint")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, total: float | None = None, seed: int = SEED,
        window: int = WINDOW) -> DataFrame:
    """Every row as (key, doc_id, source, size, source_size, target, repeats): repeats is how often the mix takes it.

    A source takes each document floor(target / size) times; what then is missing from the target is fitted by lengths, and
    of each (source, length) the documents first in the order of a seeded hash are taken once more. That order
    is cut into 4,096 ranges by hash, so a length that holds any share of the rows is not one group. NULL sources
    are one source; NULL and empty texts have size 0 and are never taken. Rows alike in id, text and source may be taken
    apart: which of them is of no account. A text of any length is one document, counted whole. An empty table gives no rows.
    """
    light = saved(sized(docs, id_col, text_col, source_col).withColumn("order", F.xxhash64(F.lit(seed), "key")))
    histogram = saved(light.groupBy("source", "size").agg(F.count("*").alias("n")))
    per_source = targets(histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("size")),
                         weights, max_epochs, total)
    slots = saved(per_source.select(
        "source", F.col("size").alias("source_size"), "target",
        F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0).cast("bigint").alias("epochs"),
        F.monotonically_increasing_id().alias("slot")))
    same = lambda a, b: a.eqNullSafe(b)
    h = histogram.filter("size > 0").withColumnRenamed("source", "hs")
    budget = F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("bigint").alias("budget")
    fitted = _fit_sources(h.join(slots, same(F.col("hs"), F.col("source"))).select("slot", "size", "n", budget), window)
    fitted = saved(fitted.filter("take > 0"))
    rows = light.join(slots.withColumnRenamed("source", "ss"), same(F.col("source"), F.col("ss"))).drop("ss")

    # Rows of a (source, length) in ranges of the seeded order: whole ranges first, then ranks in the range where the count ends.
    sub = F.shiftright(F.col("order"), 64 - SUB_BITS)
    wanted = rows.join(fitted, ["slot", "size"]).withColumn("sub", sub)
    ranges = wanted.groupBy("slot", "size", "sub").agg(F.count("*").alias("n"), F.first("take").alias("take"))
    before = Window.partitionBy("slot", "size").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    edge = (ranges.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
            .select("slot", "size", "sub", (F.col("take") - F.col("before")).alias("room"), "n"))
    placed = rows.withColumn("sub", sub).join(edge.filter("room > 0"), ["slot", "size", "sub"], "left")
    # Only the one range per (source, length) where the count ends needs an order.
    ends = (F.col("room") > 0) & (F.col("room") < F.col("n"))
    by = Window.partitionBy("slot", "size", "sub").orderBy("order", "key")
    ranked = placed.filter(ends).withColumn("more", (F.row_number().over(by) <= F.col("room")).cast("bigint"))
    clear = placed.filter(~F.coalesce(ends, F.lit(False))).withColumn("more", F.col("room").isNotNull().cast("bigint"))
    return ranked.unionByName(clear).select(
        "key", "doc_id", "source", "size", "source_size", "target",
        (F.when(F.col("size") > 0, F.col("epochs")).otherwise(0) + F.col("more")).alias("repeats"))


def take_mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each row as often as the mix takes it, all columns unchanged; rows not taken go.

    Rows alike in id, text and source share what the mix takes of them. They are numbered in the partitions they are read
    from, and the partitions after each other, so no task gets all rows of one document. An empty table gives an empty one.
    """
    mixed = mix(docs, **options)
    taken = saved(mixed.groupBy("key", "source").agg(F.sum("repeats").alias("repeats"), F.count("*").alias("alike"))
                  .filter("repeats > 0").withColumnsRenamed({"key": "tk", "source": "ts"}))
    rows = docs.select(F.struct("*").alias("doc"), row_key("doc_id", F.col("text")).alias("key"),
                       F.col("source").cast("string").alias("source"), F.spark_partition_id().alias("part"))

    def joined(some: DataFrame) -> DataFrame:
        return rows.join(some, F.col("key").eqNullSafe(F.col("tk")) & F.col("source").eqNullSafe(F.col("ts")))

    copies = joined(taken.filter("alike = 1")).select("doc", F.col("repeats").alias("copies"))
    if not taken.filter("alike > 1").isEmpty():
        several = saved(joined(taken.filter("alike > 1")).select("doc", F.struct("tk", "ts").alias("same"), "part", "repeats", "alike"))
        before = F.sum("n").over(Window.partitionBy("same").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
        begin = (several.groupBy("same", "part").agg(F.count("*").alias("n"))
                 .select(F.col("same").alias("bs"), F.col("part").alias("bp"), F.coalesce(before, F.lit(0)).alias("begin")))
        own = F.row_number().over(Window.partitionBy("same", "part").orderBy("part"))
        placed = several.withColumn("own", own).join(begin, F.col("same").eqNullSafe(F.col("bs")) & (F.col("part") == F.col("bp")))
        share = F.floor(F.col("repeats") / F.col("alike")) + (F.col("begin") + F.col("own") <= F.col("repeats") % F.col("alike")).cast("bigint")
        copies = copies.unionByName(placed.select("doc", share.cast("bigint").alias("copies")))
    out = copies.filter("copies > 0").select("doc", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("_copy"))
    return out.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
