"""Mergeable states: containers of ids, and aggregates that users write."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tideline.operators import distinct
from tideline.operators.userdefined import Aggregate, Distinct, Stats, aggregate, register_aggregate


def ids_table(spark, seed=0):
    """Keys with scattered ids, with dense ones, with both, with exactly as many as a list takes and one more, and copies."""
    rng = random.Random(seed)
    rows = [("scattered", d, rng.randrange(1 << 60)) for d in range(3) for _ in range(700)]
    rows += [("dense", d, i) for d in range(3) for i in range(d * 2000, d * 2000 + 5000)]
    rows += [("both", 0, i) for i in range(40_000)] + [("both", 1, i * 500) for i in range(200)] + [("both", 2, -5)]
    rows += [("edge", 0, i * 3 + 3) for i in range(distinct.SPARSE)] + [("edge", 1, i * 3 + 3) for i in range(distinct.SPARSE + 1)]
    rows += [(k, d, i) for k, d, i in rows[:500]] + [("none", 0, None), (None, 0, 7), (None, 1, 7)]
    return spark.createDataFrame(rows, "k string, d int, id bigint")


def test_state_is_exact_and_of_two_kinds(spark):
    table = ids_table(spark)
    state = distinct.bitmap_state(table, ["k", "d"], "id").cache()
    expected = {(r.k, r.d): r.n for r in table.groupBy("k", "d").agg(F.countDistinct("id").alias("n")).collect() if r.n}
    assert {(r.k, r.d): r.uv for r in distinct.bitmap_cardinality(state, ["k", "d"]).collect()} == expected
    assert all((r.places is None) != (r.bits is None) for r in state.collect())
    assert all(r.places == sorted(set(r.places)) and len(r.places) <= distinct.SPARSE for r in state.collect() if r.places is not None)
    kinds = {(r.k, r.d): r.places is None for r in state.filter("k = 'edge' AND bucket = 1").collect()}
    assert kinds == {("edge", 0): False, ("edge", 1): True}


def test_scattered_ids_take_little(spark):
    rng = random.Random(3)
    table = spark.createDataFrame([(rng.randrange(1 << 60),) for _ in range(2000)], "id bigint")
    state = distinct.bitmap_state(table, [], "id")
    size = state.agg(F.sum(F.coalesce(F.size("places") * 2, F.length("bits"))).alias("n")).first().n
    assert size < 8_000 and distinct.bitmap_cardinality(state, []).first().uv == 2000


@pytest.mark.parametrize("keys", [["k"], []])
def test_rollup_of_both_kinds(spark, keys):
    table = ids_table(spark, 1)
    daily = distinct.bitmap_state(table, ["k", "d"], "id")
    merged = distinct.bitmap_rollup(daily, keys)
    got = {tuple(r[:-1]): r.uv for r in distinct.bitmap_cardinality(merged, keys).collect()}
    expected = {tuple(r[:-1]): r.n for r in table.groupBy(*keys).agg(F.countDistinct("id").alias("n")).collect() if r.n}
    assert got == expected
    # Merged state is state: it merges on.
    again = distinct.bitmap_cardinality(distinct.bitmap_rollup(merged, []), [])
    assert again.first().uv == table.select(F.countDistinct("id")).first()[0]


def test_containers_of_nothing(spark):
    table = spark.createDataFrame([], "k string, id bigint")
    assert distinct.bitmap_distinct(table, ["k"], "id").collect() == []
    assert distinct.bitmap_distinct(table, [], "id").first().uv == 0


def longest():
    # A class of this function travels by value; workers can't import the tests.
    class Longest(Aggregate):
        """Two inputs: the value that goes with the largest place, and how often rows were taken in at all."""

        result_type = "last string, batches int"

        def create(self):
            return None, None, 0

        def add(self, state, *columns):
            at = pa.compute.index(columns[0], pa.compute.max(columns[0])).as_py()
            return self.merge(state, (columns[0][at].as_py(), columns[1][at].as_py(), 1))

        def merge(self, state, other):
            first, second = sorted([state, other], key=lambda s: (s[0] is not None, s[0] or 0))
            return second[0], second[1], state[2] + other[2]

        def result(self, state):
            return state[1], state[2]

    return Longest()


def numbers(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", None]), rng.choice([1, 2, None]), rng.choice([None, rng.randrange(-50, 50), 1 << 45]), i) for i in range(3000)]
    return spark.createDataFrame(rows, "k string, j int, v bigint, i bigint").repartition(7)


@pytest.mark.parametrize("keys", [["k"], ["k", "j"], []])
@pytest.mark.parametrize("small", [{}, {"limit": 1, "parts": 2}])
def test_stats_equal_the_built_in_ones(spark, keys, small):
    table = numbers(spark)
    got = aggregate(table, keys, Stats(), ["v"], **small)
    n = F.col("v").cast("decimal(38,0)")
    expected = table.groupBy(*keys).agg(F.max("v").alias("max"), F.min("v").alias("min"), F.sum(n).cast("bigint").alias("sum"),
                                        F.count("v").alias("counts"))
    assert got.columns == [*keys, "max", "min", "sum", "avg", "counts"]
    rows = {tuple(r[c] for c in [*keys, "max", "min", "sum", "counts"]) for r in got.collect()}
    assert rows == {tuple(r[c] for c in [*keys, "max", "min", "sum", "counts"]) for r in expected.collect()}
    assert all(r.avg == r.sum / r.counts for r in got.collect())


def test_distinct_and_two_inputs(spark):
    table = numbers(spark)
    got = {r.k: r.uv for r in aggregate(table, ["k"], Distinct(), ["v"]).collect()}
    assert got == {r.k: r.n for r in table.groupBy("k").agg(F.countDistinct("v").alias("n")).collect()}
    last = {r.k: r.last for r in aggregate(table.withColumn("s", F.col("i").cast("string")), ["k"], longest(), ["i", "s"]).collect()}
    assert last == {r.k: str(r.n) for r in table.groupBy("k").agg(F.max("i").alias("n")).collect()}
    assert aggregate(table.limit(0), ["k"], Stats(), ["v"]).collect() == []


def test_only_states_are_shuffled(spark):
    """Every task folds its rows before the first exchange, a hot key gives one state per task, and none is grouped by rows."""
    table = numbers(spark)
    plan = aggregate(table, ["k"], Stats(), ["v"])._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroups" not in plan and plan.count("MapInArrow") == 3
    below = plan[plan.rindex("MapInArrow"):]
    assert "RepartitionByExpression" not in below
    [hot] = aggregate(table.filter("k = 'hot'"), ["k"], longest(), ["i", "k"]).collect()
    assert hot.batches == 7  # one state from each of the seven tasks


def test_from_sql(spark):
    table = numbers(spark)
    table.createOrReplaceTempView("numbers_for_sql")
    register_aggregate(spark, "number_stats", Stats(), "string")
    got = spark.sql("""SELECT key, r.* FROM (SELECT key, number_stats_result(number_stats_merge(state)) AS r
                       FROM number_stats_partial(TABLE(SELECT k, v FROM numbers_for_sql)) GROUP BY key)""")
    expected = aggregate(table, ["k"], Stats(), ["v"])
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, (tuple(r) for r in expected.collect())))
