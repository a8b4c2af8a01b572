"""Joins.

No join carries a broadcast hint: Catalyst and AQE broadcast a side only when its measured size is below
``spark.sql.autoBroadcastJoinThreshold``, and otherwise sort-merge with skewed partitions split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def connect_keyed_join(left: DataFrame, right: DataFrame, key: str, left_seq: str, right_seq: str) -> DataFrame:
    """Inner join of two streams on a key; ``later_side`` tells which row completed the pair."""
    return left.join(right, key, "inner").withColumn(
        "later_side", F.when(F.col(left_seq) > F.col(right_seq), "left").otherwise("right")
    )


def join_using(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Inner join on same-name columns; a column named twice counts once."""
    return left.join(right, list(dict.fromkeys(columns)), "inner")


def join_on(left: DataFrame, right: DataFrame, condition: Column) -> DataFrame:
    return left.join(right, condition, "inner")


def full_outer_orders(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Headers and details, each kept without a partner; ``id`` = ``order_id``.

    All details find their headers first, then headers without any detail are added: two left-sided joins, whose hot keys
    adaptive execution splits, where it cannot split a full outer one. A header key that occurs more than once pairs with each detail.
    """
    found = details.join(orders, orders["id"] == details["order_id"], "left")
    keys = details.select(F.col("order_id").alias("__key")).distinct()
    alone = orders.join(keys, orders["id"] == F.col("__key"), "left_anti")
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in details.schema.fields]
    return found.select(*orders.columns, *details.columns).union(alone.select(*orders.columns, *missing))


def dim_lookup(facts: DataFrame, fact_key: str, dim: DataFrame, dim_key: str, attributes: dict[str, Column]) -> DataFrame:
    """Add attributes of a dimension row found by key; a missing key gives NULLs."""
    found = dim.select(F.col(dim_key).alias("__dim_key"), *[c.alias(n) for n, c in attributes.items()])
    return facts.join(found, F.col(fact_key) == F.col("__dim_key"), "left").drop("__dim_key")


def left_join_one(left: DataFrame, right: DataFrame, left_key: str, right_key: str, name: str) -> DataFrame:
    """Each left row with its partner as one nested object (NULL fields if there is none)."""
    nested = right.select(F.struct("*").alias(name), F.col(right_key).alias("__key"))
    return left.join(nested, left[left_key] == F.col("__key"), "left").drop("__key")


def _listed(child: DataFrame, child_id: str) -> Column:
    return F.array_sort(F.collect_list(F.struct(F.col(child_id), *[F.col(c) for c in child.columns if c != child_id])))


def _with_list(parent: DataFrame, folded: DataFrame, parent_key: str, name: str) -> DataFrame:
    empty = F.array().cast(folded.schema[name].dataType)
    rows = parent.join(folded, parent[parent_key] == F.col("__key"), "left")
    return rows.withColumn(name, F.coalesce(name, empty)).drop("__key")


def left_join_list(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str, child_id: str, name: str) -> DataFrame:
    """Each parent as one object with all its children as a nested list, sorted by child id; empty without any.

    For parents whose children fit one value; ``left_join_many`` is for those whose children may not.
    """
    others = child.drop(child_key)
    folded = child.groupBy(F.col(child_key).alias("__key")).agg(_listed(others, child_id).alias(name))
    return _with_list(parent, folded, parent_key, name)


def left_join_many(
    parent: DataFrame, child: DataFrame, parent_key: str, child_key: str, child_id: str, name: str, slice_ids: int = 100_000,
) -> DataFrame:
    """Each parent with its children as nested lists, sorted by child id, in one row per slice of ``slice_ids`` ids.

    ``child_id`` is a unique whole number, so a list has ``slice_ids`` children at most and a parent with very many never becomes one
    value; ``slice`` numbers the slices. Children without an id are spread over slices -1, -2, … by a hash of the row. Children
    are folded before they are joined, and a parent without any has one row with an empty list and no slice.
    """
    spread = -1 - F.pmod(F.xxhash64(*child.columns), F.lit(1024))
    sliced = child.withColumn("slice", F.coalesce(F.floor(F.col(child_id) / slice_ids), spread))
    folded = sliced.groupBy(F.col(child_key).alias("__key"), "slice").agg(_listed(child, child_id).alias(name))
    return _with_list(parent, folded, parent_key, name)


def keep_listed(rows: DataFrame, field: str, listed: DataFrame, list_field: str) -> DataFrame:
    """Rows whose ``field`` is in the list; the list is thinned to its values first."""
    names = listed.select(F.col(list_field).alias("__listed")).distinct()
    return rows.join(names, rows[field] == F.col("__listed"), "left_semi")
