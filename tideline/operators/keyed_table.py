"""Upsert tables as queries over a commit log.

A log is any table with `_commit` (a growing BIGINT), `_op` ('U' upsert, 'D' delete) and the row's columns.
The version of a key with the greatest ordering value counts; equal values go to the later commit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.times import duration_us, micros

COMMIT, OP = "_commit", "_op"
UPSERT, DELETE = "U", "D"


def _names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def latest_versions(log: DataFrame, keys: str | Sequence[str], ordering: str,
                    tie: Sequence[str] = ()) -> DataFrame:
    """The deciding log row of each key, deletes included.

    Spark keeps one row per key and task ahead of the shuffle (row_number() = 1), so a key with very many
    versions does not gather in one place. `tie` orders equal versions of one commit; by default a row hash.
    """
    ties = [F.desc(c) for c in tie] or [F.desc(F.xxhash64(*log.columns))]
    newest = Window.partitionBy(*_names(keys)).orderBy(F.desc_nulls_last(ordering), F.desc(COMMIT), *ties)
    return log.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") == 1).drop("_rn")


def upsert_latest(log: DataFrame, keys: str | Sequence[str], ordering: str, tie: Sequence[str] = ()) -> DataFrame:
    """Current rows: one per key, without deleted keys."""
    return latest_versions(log, keys, ordering, tie).filter(F.col(OP) != DELETE).drop(OP, COMMIT)


def snapshot(log: DataFrame, keys, ordering: str, as_of: int, tie: Sequence[str] = ()) -> DataFrame:
    """State as of a commit."""
    return upsert_latest(log.filter(F.col(COMMIT) <= as_of), keys, ordering, tie)


def incremental(log: DataFrame, keys, ordering: str, frm: int, to: int, tie: Sequence[str] = ()) -> DataFrame:
    """Latest version, with its `_commit` and `_op`, of each key committed after `frm` and up to `to`."""
    return latest_versions(log.filter((F.col(COMMIT) > frm) & (F.col(COMMIT) <= to)), keys, ordering, tie)


def compaction_commit(log: DataFrame, every: int = 3) -> DataFrame:
    """One row `last`: the commit of the last compaction when every `every`-th commit compacts; NULL before it.

    Commits are counted; of their numbers only the largest `every` are gathered.
    """
    if every < 1:
        raise ValueError("every must be at least 1")
    commits = log.select(COMMIT).distinct()
    top = commits.orderBy(F.desc(COMMIT)).limit(every).agg(F.sort_array(F.collect_list(COMMIT), asc=False).alias("top"))
    counted = commits.agg(F.count("*").alias("n")).scalar()
    # The last compaction lies behind the n % every newest commits.
    place = F.when(counted >= every, (counted % every).cast("int") + 1)
    return top.select(F.try_element_at("top", place).alias("last"))


def compaction_commit_timed(commits: DataFrame, time: str, every: int = 3, span_text: str = "30 seconds") -> DataFrame:
    """One row `last`: the commit of the last compaction when one runs with the first commit that is at least `every` commits
    and at least the span of time after the compaction before; NULL before it.

    commits has one row per commit with its time, which does not go back; the first compaction counts commits from the
    first one on, and time from that one's. They are read in order as one stream of which only the last compaction is held: a
    light row per commit, whatever the commits hold.
    """
    if every < 1:
        raise ValueError("every must be at least 1")
    step = duration_us(span_text)
    ordered = commits.select(F.col(COMMIT).cast("bigint").alias(COMMIT), micros(time).alias("_us"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, since, count = None, None, 0
        for batch in batches:
            numbers, times = (batch.column(i).to_numpy() for i in range(2))
            at = 0
            if since is None and len(times):
                since = int(times[0])
            while at < len(times):
                # Both waits at once: the number of commits, and the time by binary search.
                due = max(at + every - count - 1, at + int(np.searchsorted(times[at:], since + step)))
                if due >= len(times):
                    count += len(times) - at
                    break
                last, since, count, at = int(numbers[due]), int(times[due]), 0, due + 1
        yield pa.RecordBatch.from_arrays([pa.array([last], pa.int64())], ["last"])

    one = ordered.repartition(1).sortWithinPartitions(COMMIT)
    return one.mapInArrow(run, "last bigint").agg(F.max("last").alias("last"))


def read_optimized(log: DataFrame, keys, ordering: str, every: int = 3, tie: Sequence[str] = (), *, commits: DataFrame | None = None,
                   time: str = "time", span_text: str = "30 seconds") -> DataFrame:
    """State as of the last compaction: nothing of the commits after it. With `commits`, one row per commit with its time, a compaction
    waits for the number of commits and for the span of time."""
    last = compaction_commit(log, every) if commits is None else compaction_commit_timed(commits, time, every, span_text)
    return upsert_latest(log.filter(F.col(COMMIT) <= last.scalar()), keys, ordering, tie)


def delete_keys(log: DataFrame, keys_df: DataFrame, keys, ordering: str, commit: int | None = None,
                tie: Sequence[str] = ()) -> DataFrame:
    """The log with a delete appended for every listed key it holds.

    A delete repeats the deciding version of its key in a later commit, which therefore wins. By default the
    commit is the one after the last.
    """
    names = _names(keys)
    touched = log.join(keys_df.select(*names).distinct(), names, "left_semi")
    number = F.lit(commit).cast("bigint") if commit is not None else log.select(F.max(COMMIT)).scalar() + 1
    deletes = latest_versions(touched, names, ordering, tie).withColumns({COMMIT: number, OP: F.lit(DELETE)})
    return log.unionByName(deletes)


def compact(log: DataFrame, keys, ordering: str, as_of: int, tie: Sequence[str] = ()) -> DataFrame:
    """The log with everything up to a commit reduced to the deciding version of each key.

    Any state from that commit on reads the same from the shorter log. Deletes stay, because an upsert that comes
    later may carry a smaller ordering value.
    """
    return latest_versions(log.filter(F.col(COMMIT) <= as_of), keys, ordering, tie).unionByName(
        log.filter(F.col(COMMIT) > as_of)
    )


def merge_rows(table: DataFrame, changes: DataFrame, keys, ordering: str, tie: Sequence[str] = ()) -> DataFrame:
    """A table with a batch of upserts merged in: the copy-on-write view of one commit."""
    return upsert_latest(as_commit(table, 0).unionByName(as_commit(changes, 1)), keys, ordering, tie)


# -- a current table, copied on write -----------------------------------------------------------------

BUCKET = "_bucket"


def _bucket_of(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder)


def read_current(spark: SparkSession, path: str, row_schema: T.StructType) -> DataFrame:
    """The rows of a table that `copy_on_write` keeps."""
    return spark.read.schema(row_schema).parquet(path).select(*row_schema.names)


def copy_on_write(changes: DataFrame, path: str, keys: str | Sequence[str], ordering: str, buckets: int, tie: Sequence[str] = (),
                  op: str | None = None) -> None:
    """Merge changes into the table at `path`, a folder of Parquet files with one row per key that anyone can read.

    Keys are dealt to `buckets` folders by hash, a number that stays for the life of the table. Only the buckets of the changed keys
    are read, merged in a folder beside the table, and overwritten; files of the others stay as they are. The version
    with the greatest ordering value counts; of equal ones that of the changes. A repeated call changes nothing, and one that broke off is
    mended by a repeat. op: a column of 'U' and 'D'; a deleted key is taken out of the table, and comes back with its next change.
    """
    spark = changes.sparkSession
    names, columns = _names(keys), [c for c in changes.columns if c != op]
    kind = F.lit(UPSERT) if op is None else F.col(op)
    new = changes.select(*columns, F.lit(1).cast("bigint").alias(COMMIT), kind.alias(OP)).withColumn(BUCKET, _bucket_of(names, buckets))
    new.persist()
    staged = f"{path.rstrip('/')}_staged"
    try:
        touched = [r[0] for r in new.select(BUCKET).distinct().collect()]  # at most `buckets` numbers
        if not touched:
            return
        both = new
        if _exists(spark, path):
            stored = T.StructType([*changes.select(*columns).schema.fields, T.StructField(BUCKET, T.IntegerType())])
            old = spark.read.schema(stored).parquet(path).filter(F.col(BUCKET).isin(touched))
            both = new.unionByName(old.withColumns({COMMIT: F.lit(0).cast("bigint"), OP: F.lit(UPSERT)}))
        merged = upsert_latest(both, names, ordering, tie).select(*columns, BUCKET)
        merged.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(staged)
        # A bucket whose last key was deleted has no rows left to overwrite it with.
        left = spark.read.schema(merged.schema).parquet(staged)
        gone = set(touched) - {r[0] for r in left.select(BUCKET).distinct().collect()}
        left.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
        for bucket in gone:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{BUCKET}={bucket}")
            folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
    finally:
        new.unpersist()


def as_commit(rows: DataFrame, commit: int, op: str = UPSERT) -> DataFrame:
    """Stamp rows for the log. With commit 0 this takes over an existing table."""
    return rows.withColumns({COMMIT: F.lit(commit).cast("bigint"), OP: F.lit(op)})


def bootstrap(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """An existing Parquet table as commit 0 of a log."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return as_commit(reader.parquet(path), 0)


def evolve(*logs: DataFrame) -> DataFrame:
    """Logs of different schema versions as one; columns a version lacks are NULL."""
    first, *rest = logs
    for log in rest:
        first = first.unionByName(log, allowMissingColumns=True)
    return first


def _complete(spark: SparkSession, folder: str) -> bool:
    """Whether a write into the folder has been committed."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return mark.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(mark)


def write_commit(rows: DataFrame, path: str, commit: int, op: str = UPSERT, partition_by: Sequence[str] = (),
                 once: bool = False) -> None:
    """Write one commit of a log. A commit has its own folder, which a repeated write replaces.

    once: a commit that is already complete stays as it is. A replaced folder has new files, which `stream_log` would
    follow as new rows, so a writer that may repeat itself (a streaming batch) asks for this.

    The rebalance hint gathers a partition value into few files, and still splits a value with very many rows.
    """
    folder = f"{path}/{COMMIT}={int(commit)}"
    if once and _complete(rows.sparkSession, folder):
        return
    by = list(partition_by)
    staged = rows.withColumn(OP, F.lit(op))
    if by:
        staged = staged.hint("rebalance", *by).sortWithinPartitions(*by)
    staged.write.mode("overwrite").partitionBy(*by).parquet(folder)


def bulk_insert(rows: DataFrame, path: str, commit: int, partition_by: Sequence[str] = ()) -> None:
    """Append rows as a commit without looking for earlier versions of their keys."""
    write_commit(rows, path, commit, UPSERT, partition_by)


def log_schema(row_schema: T.StructType) -> T.StructType:
    return T.StructType([*row_schema.fields, T.StructField(OP, T.StringType()), T.StructField(COMMIT, T.LongType())])


def read_log(spark: SparkSession, path: str, row_schema: T.StructType) -> DataFrame:
    """The whole log. `_commit` is a partition column, so commit ranges prune folders."""
    return spark.read.schema(log_schema(row_schema)).parquet(path)


def stream_log(spark: SparkSession, path: str, row_schema: T.StructType, **options) -> DataFrame:
    """New commits as they are written."""
    return spark.readStream.schema(log_schema(row_schema)).options(**options).parquet(path)
