"""Exact distinct counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.times import MILLISECOND


# Ids of a range that are kept as a sorted list of places; more of them are a bitmap, which takes as many bytes.
SPARSE = 2048


def _containers(places: DataFrame, by: list[str], bits: DataFrame | None = None) -> DataFrame:
    """by, `places` or `bits`: one container per range from different places (by, pos), and bitmaps to be joined to them."""
    lists = places.groupBy(*by).agg(F.collect_list("pos").alias("places"))
    if bits is not None:
        lists = (lists.withColumn("bits", F.lit(None).cast("binary")).unionByName(bits, allowMissingColumns=True)
                 .groupBy(*by).agg(F.first("places", True).alias("places"), F.first("bits", True).alias("bits")))
    else:
        lists = lists.withColumn("bits", F.lit(None).cast("binary"))
    few = F.col("bits").isNull() & (F.size("places") <= SPARSE)
    sparse = lists.filter(few).select(*by, F.array_sort("places").alias("places"), "bits")
    rest = lists.filter(~few)
    made = (rest.select(*by, F.explode("places").alias("pos")).groupBy(*by).agg(F.bitmap_construct_agg(F.col("pos").cast("bigint")).alias("bits")))
    if bits is not None:
        made = made.unionByName(rest.filter(F.col("bits").isNotNull()).select(*by, "bits")).groupBy(*by).agg(F.bitmap_or_agg("bits").alias("bits"))
    return sparse.unionByName(made.withColumn("places", F.lit(None).cast("array<smallint>")))


def bitmap_state(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Mergeable state of the distinct ids per key: keys, bucket, and `places` or `bits`.

    A bucket is a range of 32,768 ids, Spark's own. Up to SPARSE ids of it are a sorted list of their places, two bytes
    each; more are a bitmap of 4 KB. So dense ids take a bit each and scattered ones a few bytes. Ids are made distinct before they are
    gathered: a container never sees more of them than its range has.
    """
    number = F.col(id_col).cast("bigint")
    places = (df.filter(F.col(id_col).isNotNull())
              .select(*keys, F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).cast("smallint").alias("pos")).distinct())
    return _containers(places, [*keys, "bucket"])


def bitmap_rollup(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge state to coarser keys. Lists are joined as lists while they are short, bitmaps by OR, and one kind with the other as bitmaps."""
    by = [*keys, "bucket"]
    places = state.filter(F.col("places").isNotNull()).select(*by, F.explode("places").alias("pos")).distinct()
    bits = state.filter(F.col("bits").isNotNull()).groupBy(*by).agg(F.bitmap_or_agg("bits").alias("bits"))
    return _containers(places, by, bits)


def bitmap_cardinality(state: DataFrame, keys: Sequence[str], name: str = "uv") -> DataFrame:
    own = F.when(F.col("places").isNotNull(), F.size("places")).otherwise(F.bitmap_count("bits")).cast("bigint")
    counted = F.sum(own).alias(name)
    if keys:
        return state.groupBy(*keys).agg(counted)
    return state.agg(F.coalesce(counted, F.lit(0).cast("bigint")).alias(name))


def bitmap_distinct(df: DataFrame, keys: Sequence[str], id_col: str, name: str = "uv") -> DataFrame:
    """Exact distinct count of BIGINT ids through containers; keys may be empty.

    Pays off for state that is kept and merged; for a single count use countDistinct.
    """
    return bitmap_cardinality(bitmap_state(df, keys, id_col), keys, name)


def distinct_per_key(df: DataFrame, key: str, hour_end: str, device: str, wm_before: str | Column) -> DataFrame:
    """Distinct devices per (key, hour), without rows that arrive after the hour was closed.

    The hour is closed once the watermark is past its end by more than 1 ms (`wm_before` is from
    `replay_watermark`).
    """
    mark = F.col(wm_before) if isinstance(wm_before, str) else wm_before
    closed = F.coalesce(F.col(hour_end) + F.lit(MILLISECOND) < mark, F.lit(False))
    return df.filter(~closed).groupBy(key, hour_end).agg(F.countDistinct(device).alias("devices"))
