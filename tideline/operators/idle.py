"""The watermark of several sources, of which some may fall silent.

Each source has a watermark of its own, and the table's is the least of those of the sources that are awake. A source
falls asleep when more than `timeout` has passed since its last row, and wakes with its next one. The table's watermark never
goes back. Falling asleep is an event of its own here, placed between the rows by its time: it may let the watermark
advance before the next row comes.

There may be any number of sources, and no task sees them all. Events are numbered and cut into buckets. Inside a bucket a source
with events there has a value that holds from one event of it to the next. A source without events in a bucket has one value
throughout; such stretches of whole buckets are cut into aligned blocks of 1, 2, 4, ... buckets, so that a stretch of any
length is a few rows, and a bucket takes the least value of the blocks around it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.times import MILLISECOND, duration_us, micros, span
from tideline.operators.running import FOLD_BITS, SEQ_BITS, number_rows, running, seq_bucket
from tideline.operators.stored import stored

# At one time: sources that start, rows, a look at the watermark, then the sources that fall asleep, all at once.
_STARTED, _ROW, _LOOK, _ASLEEP = range(4)
_STATE = ["_v", "_a", "_m"]  # latest event time, last arrival, last time-out, each a running maximum per source
# Beyond any bucket, and the levels of blocks below it.
_END_LEVEL = 40
_NEVER, _NONE = -(1 << 63), (1 << 63) - 1


def _events(df: DataFrame, ts: str, source: str, arrival: str, seq: str, timeout: int) -> DataFrame:
    """Rows, time-outs, and the start of each source with the first arrival of all, ordered by (_at, _kind, _seq, _source)."""
    at, none = micros(arrival), F.lit(None).cast("bigint")
    rows = df.select(at.alias("_at"), F.lit(_ROW).alias("_kind"), F.col(seq).cast("bigint").alias("_seq"), F.col(source).alias("_source"),
                     micros(ts).alias("_v"), at.alias("_a"), none.alias("_m"), F.struct(*df.columns).alias("_record"))
    # Only the last row of a source in a stretch of one time-out can be followed by a longer silence.
    slot = (at - F.pmod(at, F.lit(timeout))).alias("_slot")
    last = (df.groupBy(F.col(source).alias("_source"), slot).agg((F.max(at) + timeout).alias("_at"))
            .select("_source", "_at"))
    begin = F.lit(df.select(F.min(at)).scalar())
    known = df.select(F.col(source).alias("_source")).distinct()
    started = known.select("_source", begin.alias("_at"), F.lit(_STARTED).alias("_kind"), begin.alias("_a"))
    waited = known.select("_source", (begin + timeout).alias("_at"))
    # A source may have two time-outs at one time; they say the same, once is enough.
    asleep = last.unionByName(waited).distinct().select("_source", "_at", F.lit(_ASLEEP).alias("_kind"), F.col("_at").alias("_m"))
    look = asleep.select("_at", F.lit(_LOOK).alias("_kind")).distinct()
    for more in (started, asleep, look):
        rows = rows.unionByName(more, allowMissingColumns=True)
    return rows


def _next_bucket(summary: DataFrame, fold_bits: int) -> DataFrame:
    """Add `_next`, the bucket of the source's next events, folded so that no task sees all buckets of a source."""
    coarse = F.shiftright("_b", fold_bits)
    tops = summary.groupBy("_source", coarse.alias("_c")).agg(F.min("_b").alias("_first"))
    following = F.lead("_first").over(Window.partitionBy("_source").orderBy("_c"))
    tails = tops.select("_source", "_c", following.alias("_b"), F.lit(1).alias("_tail")).filter(F.col("_b").isNotNull())
    stacked = summary.withColumns({"_c": coarse, "_tail": F.lit(0)}).unionByName(tails, allowMissingColumns=True)
    ordered = Window.partitionBy("_source", "_c").orderBy("_b")
    return stacked.withColumn("_next", F.lead("_b").over(ordered)).filter(F.col("_tail") == 0).drop("_c", "_tail")


def _least_elsewhere(states: DataFrame, timeout: int) -> DataFrame:
    """_b, _v: per bucket the least value of the sources that are awake and have no event in it."""
    awake = F.col("_a").isNotNull() & (F.col("_m").isNull() | (F.col("_m") < F.col("_a") + timeout))
    held = states.filter(awake).select(
        (F.col("_b") + 1).alias("l"), F.coalesce("_next", F.lit(1 << _END_LEVEL)).alias("r"), F.coalesce("_v", F.lit(_NEVER)).alias("_v"))
    blocks = F.expr("""flatten(transform(sequence(0, cast(floor(log2(r - l)) as int) + 1), k -> filter(array(
        CASE WHEN shiftright(l + shiftleft(1L, k) - 1, k) < shiftright(r, k) AND shiftright(l + shiftleft(1L, k) - 1, k) % 2 = 1
             THEN named_struct('k', k, 'block', shiftright(l + shiftleft(1L, k) - 1, k)) END,
        CASE WHEN shiftright(l + shiftleft(1L, k) - 1, k) < shiftright(r, k) AND shiftright(r, k) % 2 = 1
             THEN named_struct('k', k, 'block', shiftright(r, k) - 1) END), x -> x IS NOT NULL)))""")
    least = (held.filter("l < r").select("_v", F.explode(blocks).alias("x")).groupBy("x.k", "x.block").agg(F.min("_v").alias("_v")))
    around = states.select("_b").distinct().select("_b", F.explode(F.sequence(F.lit(0), F.lit(_END_LEVEL))).alias("k"))
    around = around.withColumn("block", F.expr("shiftright(_b, k)"))
    return around.join(least, ["k", "block"]).groupBy("_b").agg(F.min("_v").alias("_v"))


def _grouped_max(group: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Running maximum inside groups; rows of a group stand together, groups ascend."""
    levels, rank = np.unique(values, return_inverse=True)
    base = group * len(levels)
    return levels[np.maximum.accumulate(base + rank) - base]


def _range_min(begin: np.ndarray, end: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """The least value at each of n places, each value lying on the places from begin up to end."""
    size = 1 << max(n - 1, 1).bit_length()
    tree = np.full(2 * size, _NONE)
    low, high = begin + size, end + size
    while True:
        some = low < high
        if not some.any():
            break
        low, high, values = low[some], high[some], values[some]
        odd = (low & 1) == 1
        np.minimum.at(tree, low[odd], values[odd])
        odd = (high & 1) == 1
        np.minimum.at(tree, high[odd] - 1, values[odd])
        low, high = (low + 1) >> 1, high >> 1
    width = 1
    while width < size:
        below = tree[2 * width:4 * width].reshape(-1, 2)
        np.minimum(below, tree[width:2 * width, None], out=below)
        width *= 2
    return tree[size:size + n]


def _least_before(part: pa.Table, timeout: int) -> np.ndarray:
    """For the events of one bucket, in order: the least value of all awake sources just before."""
    kind = part["_part"].to_numpy()
    n = int((kind == 2).sum())
    fixed = kind == 0
    state = [pa.compute.fill_null(part[c], _NEVER).to_numpy() for c in _STATE]
    elsewhere = int(state[0][fixed].min(initial=_NONE))
    own = ~fixed
    codes = part["_source"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)[own]
    value, arrived, slept = (s[own] for s in state)
    place = np.where(kind[own] == 1, -1, np.cumsum(kind[own] == 2) - 1)
    order = np.lexsort((place, codes))
    codes, place = codes[order].astype(np.int64), place[order]
    value, arrived, slept = (_grouped_max(codes, s[order]) for s in (value, arrived, slept))
    awake = (arrived != _NEVER) & (slept < arrived + timeout)
    follows = np.append(codes[1:] == codes[:-1], False)
    end = np.where(follows, np.append(place[1:], 0) + 1, n)
    return np.minimum(_range_min((place + 1)[awake], end[awake], value[awake], n), elsewhere)


def idle_watermark(df: DataFrame, ts: str, source: str, arrival: str, seq: str, timeout: str, delay: str = "0 seconds", *,
                   slice_size: str = "1 minute", bucket_bits: int = SEQ_BITS, fold_bits: int = FOLD_BITS) -> DataFrame:
    """Add `wm_before`, the watermark over all sources that holds when a row arrives; NULL before there is one.

    Rows come in the order of (arrival, seq); seq is unique among rows of one arrival time. Every source of the table counts
    from the first arrival on: until its first row it holds the watermark back, for `timeout` at most. A source whose last row
    came more than `timeout` ago is left out. While all sources sleep the watermark stays. NULL is a source of its own. A row without an
    event time keeps its source awake and moves no watermark; a row without an arrival time is left out.

    slice_size: rows that arrive in one such slice of time share a task while rows are numbered.
    """
    limit = duration_us(timeout)
    rows = df.filter(F.col(arrival).isNotNull())
    events = _events(rows, ts, source, arrival, seq, limit)
    sliced = F.floor(F.col("_at") / duration_us(slice_size))
    numbered = number_rows(events, ["_at", "_kind", "_seq", "_source"], sliced, "_pos")
    numbered = stored(numbered.withColumn("_b", seq_bucket("_pos", bucket_bits)).drop("_at", "_seq"))

    summary = numbered.groupBy("_source", "_b").agg(*[F.max(c).alias(c) for c in _STATE])
    states = running(summary, ["_source"], ["_b"], {f"{c}_upto": ("max", c) for c in _STATE}, F.shiftright("_b", fold_bits))
    before = [F.col(f"{c}_upto_before").alias(c) for c in _STATE]
    upto = _next_bucket(states.select("_source", "_b", *[F.col(f"{c}_upto").alias(c) for c in _STATE]), fold_bits)

    order = {"_part": F.lit(2)}
    stacked = numbered.withColumns(order)
    for number, more in enumerate([_least_elsewhere(upto, limit), states.filter(F.col("_a_upto_before").isNotNull()).select("_source", "_b", *before)]):
        stacked = stacked.unionByName(more.withColumn("_part", F.lit(number)), allowMissingColumns=True)
    stacked = stacked.select("_b", "_part", "_pos", "_kind", "_source", *_STATE, "_record")
    dealt = stacked.repartition("_b").sortWithinPartitions("_b", "_part", "_pos")

    def finish(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        part = pa.Table.from_batches(held)
        least = _least_before(part, limit)
        own = part.filter(pa.compute.equal(part["_part"], 2)).select(["_pos", "_kind", "_record"]).combine_chunks()
        looked = np.isin(own["_kind"].to_numpy(), (_ROW, _LOOK))
        known = pa.array(least, mask=(least == _NEVER) | (least == _NONE) | ~looked)
        return own.append_column("_w", known).to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            bucket = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
            for i, j in zip(edges[:-1], edges[1:]):
                if i == j:
                    continue
                if held and bucket[i] != now:
                    yield finish(held)
                    held = []
                now = bucket[i]
                held.append(batch.slice(i, j - i))
        if held:
            yield finish(held)

    schema = T.StructType([stacked.schema["_pos"], stacked.schema["_kind"], stacked.schema["_record"], T.StructField("_w", T.LongType())])
    judged = running(dealt.mapInArrow(run, schema), [], ["_pos"], {"_wm": ("max", "_w")}, seq_bucket("_pos", bucket_bits))
    mark = F.timestamp_micros("_wm").cast(df.schema[ts].dataType) - span(delay) - F.lit(MILLISECOND)
    return judged.filter(F.col("_kind") == _ROW).select("_record.*", mark.alias("wm_before"))
