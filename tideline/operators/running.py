"""Running aggregates in arrival order that no single task has to see whole.

`agg().over(partitionBy(key).orderBy(seq))` sends one key (or, without a key, the whole table) to one task.
Here rows are cut into order-preserving buckets. Each bucket is aggregated with map-side combine, the
prefix over buckets is formed on those few rows, and every bucket then starts from one extra head row that
carries the prefix. Only that last step moves whole rows, once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


_MERGE = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}
_BUCKET, _COARSE, _HEAD = "_bucket", "_coarse", "_head"
SEQ_BITS = 16
FOLD_BITS = 16


def seq_bucket(seq: str | Column, bits: int = SEQ_BITS) -> Column:
    """Bucket of a unique BIGINT arrival number; holds at most 2**bits rows."""
    return F.shiftright(F.col(seq) if isinstance(seq, str) else seq, bits)


def _with_heads(rows: DataFrame, heads: DataFrame) -> DataFrame:
    return rows.withColumn(_HEAD, F.lit(0)).unionByName(
        heads.withColumn(_HEAD, F.lit(1)), allowMissingColumns=True
    )


def _prefix(summary: DataFrame, keys: list[str], merge: dict[str, str], fold_bits: int, levels: int) -> DataFrame:
    """Exclusive prefix over the buckets of each key, folded `levels` times, so that no task sees all buckets of a key."""

    def exclusive(frame: DataFrame, by: list, order: list) -> DataFrame:
        before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return frame.select(*keys, *order, *[_MERGE[kind](name).over(before).alias(name) for name, kind in merge.items()])

    if levels == 0:
        return exclusive(summary, keys or [F.lit(0)], [_BUCKET])
    leveled = summary.withColumn(_COARSE, F.shiftright(F.col(_BUCKET), fold_bits))
    tops = leveled.groupBy(*keys, _COARSE).agg(*[_MERGE[kind](name).alias(name) for name, kind in merge.items()])
    above = _prefix(tops.withColumnRenamed(_COARSE, _BUCKET), keys, merge, fold_bits, levels - 1)
    stacked = _with_heads(leveled, above.withColumnRenamed(_BUCKET, _COARSE))
    before = Window.partitionBy(*keys, _COARSE).orderBy(F.desc(_HEAD), _BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return stacked.select(
        *keys, _BUCKET, _HEAD, *[_MERGE[kind](name).over(before).alias(name) for name, kind in merge.items()]
    ).filter(F.col(_HEAD) == 0).drop(_HEAD)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    aggs: dict[str, tuple[str, str | Column]],
    bucket: Column,
    fold_bits: int = FOLD_BITS,
    levels: int = 1,
    start: DataFrame | None = None,
) -> DataFrame:
    """Add, per aggregate, `<name>` (up to and with the row) and `<name>_before` (rows before it).

    aggs: {name: (kind, column)} with kind in sum, count, max, min.
    order: columns that order the rows of a key uniquely; ascending.
    bucket: an integer that never decreases in that order. Rows of one (key, bucket) share a task.
    fold_bits: 2**fold_bits buckets share a task when the prefix over buckets is formed, for every key.
    levels: how often buckets are folded. One level suits dense numbers; if `order` is a sparse number (a hash, an
        id), two levels leave the last task at most 2**16 rows of a key whatever the numbers are.
    start: per key, one row with a value for each (sum or count) aggregate to begin from.
    """
    keys, order = list(keys), list(order)
    source = {}
    for name, (kind, column) in aggs.items():
        column = F.col(column) if isinstance(column, str) else column
        if kind == "count":
            column = F.when(column.isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
        source[f"_in_{name}"] = column
    merge = {f"_in_{name}": kind for name, (kind, _) in aggs.items()}

    rows = df.withColumns({_BUCKET: bucket.cast("bigint"), **source})
    summary = rows.groupBy(*keys, _BUCKET).agg(*[_MERGE[k](n).alias(n) for n, k in merge.items()])
    heads = _prefix(summary, keys, merge, fold_bits, levels)
    if start is not None:
        begin = start.select(*keys, *[F.col(name).alias(f"_start_{name}") for name in aggs])
        heads = heads.join(begin, keys, "left").select(
            *keys, _BUCKET,
            *[(F.coalesce(f"_in_{n}", F.lit(0)) + F.col(f"_start_{n}")).alias(f"_in_{n}") for n in aggs],
        )

    spec = Window.partitionBy(*keys, _BUCKET).orderBy(F.desc(_HEAD), *order)
    upto = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = spec.rowsBetween(Window.unboundedPreceding, -1)
    out = {}
    for name, (kind, _) in aggs.items():
        agg = _MERGE[kind](f"_in_{name}")
        zero = (lambda c: F.coalesce(c, F.lit(0).cast("bigint"))) if kind == "count" else (lambda c: c)
        out[name], out[f"{name}_before"] = zero(agg.over(upto)), zero(agg.over(before))
    return (
        _with_heads(rows, heads)
        .withColumns(out)
        .filter(F.col(_HEAD) == 0)
        .drop(_HEAD, _BUCKET, *merge)
    )


def number_rows(df: DataFrame, order: Sequence[str], bucket: Column, name: str = "seq", levels: int = 1) -> DataFrame:
    """Dense row number from 0 in the order of any columns that order the rows uniquely, without a single-task sort.

    bucket: an integer that never decreases in that order, such as the minute of the first column. Rows of one
    bucket share a task. One level suits slices of time; take two for buckets that are sparse numbers. Nothing runs before the
    result is used.
    """
    numbered = running(df, [], order, {"_n": ("count", F.lit(1))}, bucket, levels=levels)
    return numbered.withColumn(name, F.col("_n_before")).drop("_n", "_n_before")
