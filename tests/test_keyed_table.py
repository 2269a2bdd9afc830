from __future__ import annotations

import random

import pytest
from data import at
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators import keyed_table as K

SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("span", T.IntegerType()),
    T.StructField("ts", T.TimestampNTZType()), T.StructField("app", T.StringType()),
])


def rows(spark, data):
    return spark.createDataFrame([(i, v, at(t), app) for i, v, t, app in data], SCHEMA)


def state(df):
    return {r.id: r.span for r in df.collect()}


def write_history(spark, path):
    K.bulk_insert(rows(spark, [("a", 1, 0, "x/1"), ("b", 2, 0, "y")]), path, 1, ["app"])
    K.write_commit(rows(spark, [("a", 3, 5, "x/1"), ("c", 4, 1, "y")]), path, 2, partition_by=["app"])
    K.write_commit(rows(spark, [("a", 9, 2, "x/1"), ("b", 5, 0, "z")]), path, 3, partition_by=["app"])
    K.write_commit(rows(spark, [("c", 7, 9, "y")]), path, 4, partition_by=["app"])


def test_queries_over_a_log(spark, tmp_path):
    path = str(tmp_path / "log")
    write_history(spark, path)
    log = K.read_log(spark, path, SCHEMA)
    # a: the row of commit 3 is older than that of commit 2; b: equal stamps, the later commit wins.
    assert state(K.upsert_latest(log, "id", "ts")) == {"a": 3, "b": 5, "c": 7}
    assert state(K.snapshot(log, "id", "ts", 1)) == {"a": 1, "b": 2}
    assert state(K.incremental(log, "id", "ts", 2, 4)) == {"a": 9, "b": 5, "c": 7}
    assert state(K.read_optimized(log, "id", "ts")) == {"a": 3, "b": 5, "c": 4}
    assert state(K.read_optimized(log, "id", "ts", every=5)) == {}
    assert {r.app for r in log.select("app").collect()} == {"x/1", "y", "z"}


def test_repeated_commit_counts_once(spark, tmp_path):
    path = str(tmp_path / "log")
    for _ in range(2):
        K.write_commit(rows(spark, [("a", 1, 0, "x")]), path, 1)
    assert K.read_log(spark, path, SCHEMA).count() == 1


def test_commit_range_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "log")
    write_history(spark, path)
    plan = K.incremental(K.read_log(spark, path, SCHEMA), "id", "ts", 2, 4)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_commit" in plan


def test_one_row_per_key_leaves_each_task(spark, tmp_path):
    path = str(tmp_path / "log")
    write_history(spark, path)
    plan = K.upsert_latest(K.read_log(spark, path, SCHEMA), "id", "ts")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_delete(spark, tmp_path):
    path = str(tmp_path / "log")
    write_history(spark, path)
    log = K.read_log(spark, path, SCHEMA)
    gone = spark.createDataFrame([("a",), ("nobody",), ("a",)], "id string")
    after = K.delete_keys(log, gone, "id", "ts")
    assert state(K.upsert_latest(after, "id", "ts")) == {"b": 5, "c": 7}
    assert state(K.snapshot(after, "id", "ts", 4)) == {"a": 3, "b": 5, "c": 7}
    again = after.unionByName(K.as_commit(rows(spark, [("a", 42, 50, "x")]), 6))
    assert state(K.upsert_latest(again, "id", "ts")) == {"a": 42, "b": 5, "c": 7}


def test_null_ordering_loses(spark):
    log = K.as_commit(rows(spark, [("a", 1, 0, "x")]), 1).unionByName(
        K.as_commit(rows(spark, [("a", 2, 0, "x")]).withColumn("ts", F.lit(None).cast("timestamp_ntz")), 2))
    assert state(K.upsert_latest(log, "id", "ts")) == {"a": 1}


def test_struct_key_and_several_keys(spark):
    log = K.as_commit(rows(spark, [("a", 1, 0, "x"), ("a", 2, 1, "x"), ("a", 3, 0, "y")]), 1)
    assert K.upsert_latest(log, ["id", "app"], "ts").count() == 2
    by_struct = log.withColumn("key", F.struct("id", "app"))
    assert sorted(r.span for r in K.upsert_latest(by_struct, "key", "ts").collect()) == [2, 3]


def test_schema_change_and_bootstrap(spark, tmp_path):
    old = str(tmp_path / "table")
    rows(spark, [("a", 1, 0, "x"), ("b", 2, 0, "x")]).write.parquet(old)
    first = K.bootstrap(spark, old, SCHEMA)
    second = K.as_commit(rows(spark, [("a", 5, 9, "x")]).withColumn("url", F.lit("/u")), 1)
    latest = K.upsert_latest(K.evolve(first, second), "id", "ts")
    assert {(r.id, r.span, r.url) for r in latest.collect()} == {("a", 5, "/u"), ("b", 2, None)}


def test_compacted_log_reads_the_same(spark, tmp_path):
    path = str(tmp_path / "log")
    write_history(spark, path)
    log = K.delete_keys(K.read_log(spark, path, SCHEMA), spark.createDataFrame([("b",)], "id string"), "id", "ts")
    for as_of in range(0, 6):
        short = K.compact(log, "id", "ts", as_of)
        for commit in range(as_of, 7):
            assert state(K.snapshot(short, "id", "ts", commit)) == state(K.snapshot(log, "id", "ts", commit))
    late_and_old = K.as_commit(rows(spark, [("b", 77, -9, "y")]), 9)
    assert "b" not in state(K.upsert_latest(K.compact(log, "id", "ts", 5).unionByName(late_and_old), "id", "ts"))


def test_merge_rows(spark):
    table = rows(spark, [("a", 1, 5, "x"), ("b", 2, 5, "x")])
    batch = rows(spark, [("a", 9, 4, "x"), ("b", 8, 5, "x"), ("c", 3, 0, "x")])
    assert state(K.merge_rows(table, batch, "id", "ts")) == {"a": 1, "b": 8, "c": 3}


def brute_compactions(times, every, wait):
    """Commits that compact: the first `every` commits and `wait` after the one before (or after the first commit)."""
    found, since, count = [], times[0], 0
    for n, t in enumerate(times):
        count += 1
        if count >= every and t >= since + wait:
            found.append(n)
            since, count = t, 0
    return found


@pytest.mark.parametrize("every,wait", [(3, 30), (1, 0), (1, 50), (7, 1), (3, 10_000)])
def test_compaction_by_number_and_time(spark, every, wait):
    rng = random.Random(every)
    for length in (1, 2, 40, 300):
        times, now = [], 0
        for _ in range(length):
            now += rng.choice([0, 1, 5, 40])
            times.append(now)
        commits = spark.createDataFrame([(n * 2, at(t)) for n, t in enumerate(times)], "_commit bigint, time timestamp_ntz").repartition(3)
        got = K.compaction_commit_timed(commits, "time", every, f"{wait} seconds").first().last
        found = brute_compactions(times, every, wait)
        assert got == (found[-1] * 2 if found else None)
    assert K.compaction_commit_timed(commits.limit(0), "time").first().last is None


def files(path):
    return {p.relative_to(path): (p.stat().st_mtime_ns, p.stat().st_ino) for p in path.rglob("*.parquet")}


def test_copy_on_write_rewrites_the_touched_buckets_alone(spark, tmp_path):
    path, schema = tmp_path / "table", "k bigint, v string, t bigint, op string"
    made = lambda some: spark.createDataFrame(some, schema)
    merge = lambda some: K.copy_on_write(made(some), str(path), "k", "t", 8, op="op")
    shape = made([]).drop("op").schema
    read = lambda: {r.k: (r.v, r.t) for r in K.read_current(spark, str(path), shape).collect()}
    merge([(k, f"v{k}", 1, "U") for k in range(100)])
    assert read() == {k: (f"v{k}", 1) for k in range(100)}
    before = files(path)
    merge([(3, "new", 2, "U"), (3, "newer", 3, "U"), (5, "old", 0, "U"), (7, None, 2, "D"), (200, "more", 1, "U")])
    expected = {k: (f"v{k}", 1) for k in range(100) if k != 7} | {3: ("newer", 3), 200: ("more", 1)}
    assert read() == expected
    touched = {r[0] for r in made([(k, "", 0, "") for k in (3, 5, 7, 200)]).select(K._bucket_of(["k"], 8)).collect()}
    after, own = files(path), lambda f: int(f.parts[0].split("=")[1])
    assert len(touched) < 8 and {f: s for f, s in before.items() if own(f) not in touched} == {f: s for f, s in after.items() if own(f) not in touched}
    # A repeat, and nothing at all, change nothing.
    merge([(3, "new", 2, "U"), (3, "newer", 3, "U"), (5, "old", 0, "U"), (7, None, 2, "D"), (200, "more", 1, "U")])
    assert read() == expected
    merge([])
    assert read() == expected
    # Equal versions go to the later change, and a bucket may lose all its keys.
    merge([(3, "again", 3, "U")] + [(k, None, 9, "D") for k in [*range(100), 200] if k != 3])
    assert read() == {3: ("again", 3)}
    merge([(7, "back", 1, "U")])
    assert read() == {3: ("again", 3), 7: ("back", 1)}


def test_copy_on_write_of_two_keys(spark, tmp_path):
    path = str(tmp_path / "table")
    one = spark.createDataFrame([("a", None, 1), ("a", 2, 1), (None, 2, 1)], "x string, y int, t int")
    K.copy_on_write(one, path, ["x", "y"], "t", 3)
    K.copy_on_write(spark.createDataFrame([("a", None, 5)], one.schema), path, ["x", "y"], "t", 3)
    assert sorted(map(tuple, K.read_current(spark, path, one.schema).collect()), key=str) == sorted([("a", None, 5), ("a", 2, 1), (None, 2, 1)], key=str)
