"""Line deduplication by overlapping windows of three lines. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import row_key

WINDOW = 3


def _windows(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """One row per document and place where `width` consecutive lines start: key, pos, w (128 bits).

    Windows of blank lines only are not taken.
    """
    lines = F.split(F.col(text), "\n", -1)
    hashes = F.transform("_lines", lambda x: F.xxhash64(x))
    # The second half of the hash starts from another seed, so that the pair has 128 independent bits.
    blank = F.transform("_lines", lambda x: F.length(F.trim(x)) == 0)
    starts = F.when(F.size("_lines") >= width, F.sequence(F.lit(0), F.size("_lines") - width))
    window = lambda i: F.struct(
        i.alias("pos"),
        F.struct(F.xxhash64(*[F.element_at("_hash", i + k + 1) for k in range(width)]).alias("h1"),
                 F.xxhash64(F.lit(1), *[F.element_at("_lines", i + k + 1) for k in range(width)]).alias("h2")).alias("w"),
        F.forall(F.slice("_blank", i + 1, width), lambda b: b).alias("blank"),
    )
    split = docs.select(F.col(key), lines.alias("_lines"))
    ready = split.select(key, "_lines", hashes.alias("_hash"), blank.alias("_blank"), starts.alias("_starts"))
    # The arrays end here: only small structs are exploded, never beside the text.
    found = ready.select(key, F.transform("_starts", window).alias("_found"))
    # Outer, because a plain explode makes the planner filter on the whole expression, written out and so split once per line.
    return found.select(key, F.explode_outer("_found").alias("_f")).filter(~F.col("_f.blank")).select(key, "_f.pos", "_f.w")


def removed_lines(docs: DataFrame, key: str = "key", text: str = "text", width: int = WINDOW) -> DataFrame:
    """key, removed: sorted line numbers (from 0) that later occurrences of a window cover.

    A window that occurs again anywhere in the corpus stays at its first place, by (key, line number). Every other place
    of it covers its lines; the covered places of a document are merged. A place that overlaps the first one in the
    same document covers only what lies beyond it.
    """
    windows = _windows(docs, key, text, width)
    place = F.struct(F.col(key).alias("key"), F.col("pos").alias("pos"))
    # Rows are combined per task before they are shuffled, so a window of very many places costs no more than one.
    first = (windows.groupBy("w").agg(F.min(place).alias("first"), F.max(place).alias("last"))
             .filter(F.col("first") != F.col("last")))
    later = windows.join(first.select("w", "first"), "w").filter(place != F.col("first"))
    begin = F.when(F.col("first.key").eqNullSafe(F.col(key)),
                   F.greatest(F.col("pos"), F.col("first.pos") + width)).otherwise(F.col("pos"))
    covered = later.select(key, "pos", begin.alias("begin")).filter(F.col("begin") < F.col("pos") + width)
    # At most one entry per line of the document itself.
    spans = covered.groupBy(key).agg(F.collect_set(F.struct("begin", "pos")).alias("spans"))
    return spans.select(key, F.array_sort(F.array_distinct(F.flatten(F.transform(
        "spans", lambda s: F.sequence(s["begin"], s["pos"] + (width - 1)))))).alias("removed"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """Every row with `doc` (all its columns), `text` without the removed lines, n_lines and n_removed.

    Lines end at \\n. NULL text has no lines, comes back as NULL and counts 0. Texts with fewer than three lines keep
    them all. Rows alike in id and text are one document: their windows count once and they keep the same lines.
    Rows with the same id and other texts, and rows with NULL ids, are told apart by their text. Texts of any length are read
    whole, and an empty table gives no rows.
    """
    keyed = docs.select(F.struct("*").alias("doc"), row_key(id_col, F.col(text_col)).alias("key"))
    texts = docs.select(row_key(id_col, F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    removed = removed_lines(texts, "key", "text", width)
    joined = keyed.join(removed.withColumnRenamed("key", "of"), F.col("key").eqNullSafe(F.col("of")), "left")
    text = F.col("doc").getField(text_col)
    # The lines are a column of their own: written into the lambda below, the text would be split once per line.
    ready = joined.select("doc", "removed", text.alias("whole"), F.split(text, "\n", -1).alias("lines"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("removed"))
    kept = F.array_join(F.transform(left, lambda i: F.element_at("lines", i + 1)), "\n")
    return ready.select(
        "doc",
        F.when(F.col("removed").isNull(), F.col("whole")).otherwise(kept).alias("text"),
        F.when(F.col("whole").isNull(), F.lit(0)).otherwise(F.size("lines")).cast("bigint").alias("n_lines"),
        F.when(F.col("removed").isNull(), F.lit(0)).otherwise(F.size("removed")).cast("bigint").alias("n_removed"),
    )
