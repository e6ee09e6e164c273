"""User aggregates in Python that merge (V1).

A Python function over the whole list of an entity's values needs that list in
one task.  A function given as ``zero``, ``reduce``, ``merge`` and ``finish``
does not: tasks reduce each Arrow batch to one state per entity, and the states
are merged in rounds, at most ``FAN_IN`` of them in one group, so that a hot
entity is spread over tasks in every round but its small last one.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.functions.refs import ref
from wardline.session import checkpoint_dir

FAN_IN = 64


class UserAggregate:
    """The four steps of a mergeable aggregate; states are any values that pickle.

    ``zero()`` gives an empty state, ``reduce(state, values)`` folds a list of
    values in, ``merge(a, b)`` joins two states and ``finish(state)`` gives the
    result (null for None).  ``merge`` must not depend on the order of states.
    Give the steps as arguments, or override the methods.
    """

    def __init__(self, zero: Callable[[], Any] | None = None, reduce: Callable[[Any, list], Any] | None = None,
                 merge: Callable[[Any, Any], Any] | None = None, finish: Callable[[Any], Any] | None = None):
        for name, step in (("zero", zero), ("reduce", reduce), ("merge", merge), ("finish", finish)):
            if step is not None:
                setattr(self, name, step)

    def zero(self) -> Any:
        raise NotImplementedError

    def reduce(self, state: Any, values: list) -> Any:
        raise NotImplementedError

    def merge(self, a: Any, b: Any) -> Any:
        raise NotImplementedError

    def finish(self, state: Any) -> Any:
        return state


def aggregate_by(df: DataFrame, key: str, value: str, aggregate: UserAggregate, return_type: str = "double",
                 alias: str = "result", fan_in: int = FAN_IN) -> DataFrame:
    """(``key``, ``alias``): ``aggregate`` over the non-null values of each key; keys without values do not come.

    Each round of merging is checkpointed, as the number of rounds follows from
    the number of states of the key that has most: one round per factor of
    ``fan_in``.
    """
    if fan_in < 2:
        raise ValueError("fan_in must be 2 or more")
    checkpoint_dir(df.sparkSession)
    key_type = df.schema[key].dataType
    rows = df.select(ref(key).alias("_key"), ref(value).alias("_value")).where(F.col("_key").isNotNull() & F.col("_value").isNotNull())
    partial = T.StructType([T.StructField("_key", key_type), T.StructField("_state", T.BinaryType())])

    def reduce_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values: dict[Any, list] = {}
            for k, v in zip(batch["_key"].tolist(), batch["_value"].tolist()):
                values.setdefault(k, []).append(v)
            states = [(k, pickle.dumps(aggregate.reduce(aggregate.zero(), v))) for k, v in values.items()]
            yield pd.DataFrame(states, columns=["_key", "_state"])

    def merged(states: Iterable[bytes]) -> Any:
        total = aggregate.zero()
        for state in states:
            total = aggregate.merge(total, pickle.loads(state))
        return total

    def merge_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"_key": batch["_key"], "_state": [pickle.dumps(merged(x)) for x in batch["_states"]]})

    def finish_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({key: batch["_key"], alias: [aggregate.finish(merged(x)) for x in batch["_states"]]})

    # Spark puts a key's states, at most about ``fan_in``, into one row; a Python call then takes a batch of keys.
    together = F.collect_list("_state").alias("_states")
    states = rows.mapInPandas(reduce_batches, partial).checkpoint()
    while True:
        most = states.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
        if most <= fan_in:
            break
        counts = states.groupBy(F.col("_key").alias("_k")).agg(F.ceil(F.count(F.lit(1)) / fan_in).cast("int").alias("_parts"))
        salted = states.join(counts.where("_parts > 1").checkpoint(), F.col("_key") == F.col("_k"), "left")
        # States are dealt by their place, as equal ones would meet by their content.
        salted = salted.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.coalesce("_parts", F.lit(1))))
        states = salted.groupBy("_key", "_salt").agg(together).select("_key", "_states").mapInPandas(merge_batches, partial).checkpoint()
    out = T.StructType([T.StructField(key, key_type), T.StructField(alias, T._parse_datatype_string(return_type))])
    return states.groupBy("_key").agg(together).mapInPandas(finish_batches, out)
