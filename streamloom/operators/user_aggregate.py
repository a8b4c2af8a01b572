"""User-written aggregates: create, add, merge, result."""

from __future__ import annotations

import pickle
from abc import ABC, abstractmethod
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from streamloom.shipping import ship_by_value

ship_by_value(__name__)

KEYS_IN_MEMORY = 50_000
ROWS_PER_ADD = 100_000


class UserAggregate(ABC):
    """The four steps of an aggregate. ``merge`` is needed: keys are always aggregated in parts."""

    @abstractmethod
    def create(self) -> Any: ...

    @abstractmethod
    def add(self, acc: Any, rows: pd.DataFrame) -> Any: ...

    @abstractmethod
    def merge(self, a: Any, b: Any) -> Any: ...

    @abstractmethod
    def result(self, acc: Any) -> Any: ...


def aggregate_with(df: DataFrame, key: str, user: UserAggregate, result_type: str, name: str, fan_in: int = 64) -> DataFrame:
    """Aggregate per key in three steps, so no task sees the raw rows of a whole key.

    Each task folds its rows to one accumulator per key; accumulators meet first in ``fan_in`` groups per key
    and then once per key. Meeting ones are merged as a sorted run, one at a time. Prefer built-in aggregates where they can say the same.
    """
    # Keys meet as text: a whole-number column with a NULL in it would reach pandas as doubles, and large keys would fall together.
    key_type, own = df.schema[key].dataType.simpleString(), key
    df, key = df.withColumn("__key", F.col(key).cast("string")), "__key"

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[Any, Any] = {}

        def flush() -> pd.DataFrame:
            out = pd.DataFrame({
                key: pd.Series(list(held), dtype="object"),
                "part": TaskContext.get().partitionId() % fan_in,
                "acc": [pickle.dumps(acc) for acc in held.values()],
            })
            held.clear()
            return out

        def add(rows_of_all: list[pd.DataFrame]) -> None:
            for value, rows in pd.concat(rows_of_all).groupby(key, sort=False, dropna=False):
                value = None if pd.isna(value) else value
                held[value] = user.add(held[value] if value in held else user.create(), rows)

        waiting: list[pd.DataFrame] = []
        for batch in batches:
            waiting.append(batch)
            if sum(map(len, waiting)) >= ROWS_PER_ADD:
                add(waiting)
                waiting = []
            if len(held) >= KEYS_IN_MEMORY:
                yield flush()
        if waiting:
            add(waiting)
        if held:
            yield flush()

    def merge_runs(batches: Iterator[pd.DataFrame], emit) -> Iterator[pd.DataFrame]:
        """Rows come sorted by key: merge neighbours, hold one accumulator at a time."""
        current, acc, started = None, None, False
        for batch in batches:
            done = []
            for value, blob in zip(batch[key], batch["acc"]):
                value = None if pd.isna(value) else value
                if started and value == current:
                    acc = user.merge(acc, pickle.loads(blob))
                    continue
                if started:
                    done.append((current, emit(acc)))
                current, acc, started = value, pickle.loads(blob), True
            yield table(done)
        if started:
            yield table([(current, emit(acc))])

    def table(done: list[tuple[Any, Any]]) -> pd.DataFrame:
        return pd.DataFrame({
            key: pd.Series([k for k, _ in done], dtype="object"),
            "out": pd.Series([v for _, v in done], dtype="object"),
        })

    def merge_part(batches):
        return merge_runs(batches, pickle.dumps)

    def finish(batches):
        return merge_runs(batches, user.result)

    partial = df.mapInPandas(fold, f"`{key}` string, part int, acc binary")
    merged = (
        partial.repartition(key, "part").sortWithinPartitions(key, "part")
        .mapInPandas(merge_part, f"`{key}` string, out binary").withColumnRenamed("out", "acc")
    )
    finished = merged.repartition(key).sortWithinPartitions(key).mapInPandas(finish, f"`{key}` string, out {result_type}")
    return finished.select(F.col(key).cast(key_type).alias(own), F.col("out").alias(name))
