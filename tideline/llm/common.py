"""Helpers that the training-data operators share.

Conventions of every operator here:

* A row is told apart by its id and the whole text (`row_key`). Rows alike in both are the same document and get
  the same result; NULL ids are allowed unless a docstring says otherwise.
* An operator reads only the columns it names. Other columns, whatever they are called, never clash: where they come
  back, they travel packed in one struct.
"""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: str | Column) -> Column:
    """A-Z in lower case, every other code point as it is."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def row_key(id_col: str | Column, text: Column) -> Column:
    """(id, two 64-bit hashes of the text): what tells documents apart even if ids repeat or are NULL."""
    id_col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.struct(id_col.alias("id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))


def crc32_mod(id_col: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo a small number; NULL ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def crc32_mod_of(value, divisor: int) -> int:
    return zlib.crc32(b"" if value is None else str(value).encode()) % divisor


def hash_share(*cols: str | Column, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the values alone."""
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Checkpoints go to spark.checkpoint.dir. A folder of our own only where that is unset, in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
    context.setCheckpointDir(folder)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of ours, wherever Spark keeps it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def saved(df: DataFrame) -> DataFrame:
    """The frame computed once and kept in the shared folder, so that lost executors cost no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def partition_sums(df: DataFrame, fold: Callable[[Iterator[pa.RecordBatch]], np.ndarray],
                   merge: Callable[[np.ndarray, np.ndarray], np.ndarray] = np.add) -> np.ndarray | None:
    """Add up (or else merge) one float64 array per partition. The arrays have a fixed shape, whatever the rows; they are added
    in tasks first, so the driver gets a few of them."""
    spark = df.sparkSession

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = fold(batches)
        if part is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([part.astype("<f8").tobytes()], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column(0):
                one = np.frombuffer(value.as_py(), "<f8")
                total = one.copy() if total is None else merge(total, one)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([total.tobytes()], pa.binary())})

    parts = df.mapInArrow(each, "part binary")
    rows = parts.repartition(min(8, int(spark.conf.get("spark.sql.shuffle.partitions")))).mapInArrow(add, "part binary").collect()
    total = None
    for row in rows:
        one = np.frombuffer(row.part, "<f8")
        total = one.copy() if total is None else merge(total, one)
    return total


def text_chunks(batch: pa.RecordBatch, column: int, limit: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch whose texts together have about `limit` bytes (a longer text stands alone)."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0))
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += int(size)
    if len(sizes) > start:
        yield start, len(sizes)
