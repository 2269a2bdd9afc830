"""User-defined aggregates with states that merge.

An aggregate says how a state begins, takes in columns, joins another state, and ends in a result. Every task folds its own
rows, batch by batch, into one state per key, and only states are shuffled. They are merged in two steps, first by key
and a part of the tasks, then by key. So no task gets the rows of a key, however many they are, and a key's states are as
many as the tasks.

From SQL, after `register_aggregate(spark, "stats", agg, "string")`:

    SELECT key, r.* FROM (SELECT key, stats_result(stats_merge(state)) AS r
                          FROM stats_partial(TABLE(SELECT k, v FROM t)) GROUP BY key)
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Keys that a task holds at once, and parts of the tasks in the first step of merging.
KEYS = 100_000
PARTS = 64


class Aggregate:
    """What a user writes. States are pickled between tasks, and should not grow with the rows of a key."""

    # Fields of the result, as DDL.
    result_type: str

    def create(self):
        raise NotImplementedError

    def add(self, state, *columns: pa.Array):
        """The state with some rows of one key taken in; NULLs are in the columns as they are in the table."""
        raise NotImplementedError

    def merge(self, state, other):
        raise NotImplementedError

    def result(self, state) -> tuple:
        raise NotImplementedError


class Stats(Aggregate):
    """max, min, sum, avg and counts of a whole-number column; NULLs are left out, and nothing but NULLs gives NULLs and 0."""

    result_type = "max bigint, min bigint, sum bigint, avg double, counts bigint"

    def create(self):
        return None, None, 0, 0

    def add(self, state, *columns):
        values = columns[0].drop_null()
        if not len(values):
            return state
        ends = pa.compute.min_max(values)
        return self.merge(state, (ends["max"].as_py(), ends["min"].as_py(), sum(values.to_pylist()), len(values)))

    def merge(self, state, other):
        if not state[3] or not other[3]:
            return state if state[3] else other
        return max(state[0], other[0]), min(state[1], other[1]), state[2] + other[2], state[3] + other[3]

    def result(self, state):
        most, least, total, n = state
        return most, least, total if n else None, total / n if n else None, n


class Distinct(Aggregate):
    """Exact number of different values of a whole-number column, NULLs left out. The state holds them: for keys of any
    size aggregate by (key, slice of the value's hash) and add the slices up."""

    result_type = "uv bigint"

    def create(self):
        return np.zeros(0, np.int64)

    def add(self, state, *columns):
        return self.merge(state, columns[0].drop_null().to_numpy(zero_copy_only=False).astype(np.int64))

    def merge(self, state, other):
        return np.unique(np.concatenate([state, other]))

    def result(self, state):
        return (len(state),)


def _groups(columns: list[pa.Array], rows: int) -> Iterator[tuple[tuple, np.ndarray]]:
    """(key, places of its rows) for the keys of a batch."""
    code = np.zeros(rows, np.int64)
    for column in columns:
        coded = column.dictionary_encode(null_encoding="encode")
        code = code * max(len(coded.dictionary), 1) + coded.indices.to_numpy(zero_copy_only=False)
        code = np.unique(code, return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    cuts = [0, *(np.flatnonzero(np.diff(code[order])) + 1).tolist(), rows]
    for begin, end in zip(cuts[:-1], cuts[1:]):
        if begin < end:
            at = order[begin:end]
            yield tuple(c[int(at[0])].as_py() for c in columns), at


class _Folding:
    """States by key of one task; handed on whenever there are KEYS of them."""

    def __init__(self, agg: Aggregate, n_keys: int, limit: int):
        self.agg, self.n_keys, self.limit, self.states = agg, n_keys, limit, {}

    def add(self, columns: list[pa.Array], rows: int) -> Iterator[list[tuple]]:
        for key, at in _groups(columns[:self.n_keys], rows):
            place = pa.array(at)
            state = self.states[key] if key in self.states else self.agg.create()
            self.states[key] = self.agg.add(state, *[c.take(place) for c in columns[self.n_keys:]])
            if len(self.states) >= self.limit:
                yield self.drain()

    def drain(self) -> list[tuple]:
        rows, self.states = [(*key, pickle.dumps(state)) for key, state in self.states.items()], {}
        return rows


def aggregate(df: DataFrame, keys: Sequence[str], agg: Aggregate, inputs: Sequence[str], *, limit: int = KEYS, parts: int = PARTS) -> DataFrame:
    """keys and the fields of the aggregate's result, a row per key. NULL keys are a key; without keys one row, none for an empty table."""
    keys = list(keys)
    fields = [T.StructField(f"_k{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
    of = list(range(len(keys)))

    def arrays(rows: list[tuple], like: pa.RecordBatch) -> list[pa.Array]:
        kinds = [like.schema.field(i).type for i in of]
        return [pa.array([r[i] for r in rows], kinds[i]) for i in of]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folding, last, task = _Folding(agg, len(keys), limit), None, TaskContext.get().partitionId()
        names = [*[f.name for f in fields], "_part", "_state"]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            part = pa.array(np.full(len(rows), task % parts, np.int32))
            return pa.RecordBatch.from_arrays([*arrays(rows, last), part, pa.array([r[-1] for r in rows], pa.binary())], names)

        for batch in batches:
            last = batch
            for rows in folding.add(batch.columns, batch.num_rows):
                yield out(rows)
        if folding.states:
            yield out(folding.drain())

    def merging(width: int, finish: bool):
        """States of equal first `width` columns become one; the rows come sorted by them."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, state, last, done = None, None, None, []

            def out() -> pa.RecordBatch:
                found = arrays(done, last)
                if finish:
                    values = zip(*[agg.result(s) for *_, s in done])
                    found += [pa.array(v, kind) for v, kind in zip(values, kinds)]
                    return pa.RecordBatch.from_arrays(found, [*[f.name for f in fields], *names])
                part = pa.array([r[width - 1] for r in done], pa.int32())
                return pa.RecordBatch.from_arrays([*found, part, pa.array([pickle.dumps(s) for *_, s in done], pa.binary())],
                                                  [*[f.name for f in fields], "_part", "_state"])

            for batch in batches:
                columns = [batch.column(i).to_pylist() for i in range(width)] + [batch.column(batch.num_columns - 1)]
                last = batch
                for key, packed in zip(zip(*columns[:-1]) if width else [()] * batch.num_rows, columns[-1]):
                    other = pickle.loads(packed.as_py())
                    if now is not None and key == now[0]:
                        state = agg.merge(state, other)
                        continue
                    if now is not None:
                        done.append((*now[0], state))
                    now, state = (key,), other
                if len(done) > 1000:
                    yield out()
                    done = []
            if now is not None:
                done.append((*now[0], state))
                yield out()

        return run

    result = T.StructType.fromDDL(agg.result_type)
    names, kinds = [f.name for f in result], [to_arrow_type(f.dataType) for f in result]
    states = T.StructType([*fields, T.StructField("_part", T.IntegerType()), T.StructField("_state", T.BinaryType())])
    rows = df.select(*[F.col(k).alias(f.name) for k, f in zip(keys, fields)], *inputs)
    by = [f.name for f in fields]
    partial = rows.mapInArrow(fold, states)
    some = partial.repartition(*by, "_part").sortWithinPartitions(*by, "_part").mapInArrow(merging(len(by) + 1, False), states)
    dealt = some.repartition(*by).sortWithinPartitions(*by) if by else some.coalesce(1)
    merged = dealt.mapInArrow(merging(len(by), True), T.StructType([*fields, *result.fields]))
    return merged.select(*[F.col(f.name).alias(k) for k, f in zip(keys, fields)], *names)


def register_aggregate(spark: SparkSession, name: str, agg: Aggregate, key_type: str) -> None:
    """For SQL: the table function `<name>_partial` folds the rows of TABLE(SELECT key, inputs...) in each task to (key, state); the
    aggregate `<name>_merge` joins states; `<name>_result` gives the result as a struct."""

    whole = {"bigint": "Int64", "int": "Int32", "double": "Float64"}
    fields = [(f.name, whole.get(f.dataType.simpleString(), "object")) for f in T.StructType.fromDDL(agg.result_type)]

    class Partial:
        def __init__(self):
            self.folding, self.kind = _Folding(agg, 1, KEYS), None

        def _table(self, rows: list[tuple]) -> pa.Table:
            return pa.table({"key": pa.array([r[0] for r in rows], self.kind), "state": pa.array([r[1] for r in rows], pa.binary())})

        def eval(self, batch: pa.RecordBatch):
            self.kind = batch.schema.field(0).type
            for rows in self.folding.add(batch.columns, batch.num_rows):
                yield self._table(rows)

        def terminate(self):
            if self.folding.states:
                yield self._table(self.folding.drain())

    def merge(states: pd.Series) -> bytes:
        total = agg.create()
        for state in states:
            total = agg.merge(total, pickle.loads(state))
        return pickle.dumps(total)

    def finish(states: pd.Series) -> pd.DataFrame:
        rows = [agg.result(pickle.loads(s)) for s in states]
        return pd.DataFrame({name: pd.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(fields)})

    merge.__annotations__ = {"states": pd.Series, "return": bytes}
    finish.__annotations__ = {"states": pd.Series, "return": pd.DataFrame}
    spark.udtf.register(f"{name}_partial", F.arrow_udtf(Partial, returnType=f"key {key_type}, state binary"))
    spark.udf.register(f"{name}_merge", F.pandas_udf(merge, "binary"))
    spark.udf.register(f"{name}_result", F.pandas_udf(finish, agg.result_type))
