"""Change records ``{type, table, data}`` → fact topics and a dimension snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from streamloom.functions.json import to_rows
from streamloom.functions.text import upper_name
from streamloom.operators.joins import keep_listed
from streamloom.operators.ranking import first_per_key
from streamloom.schemas import CDC

# Change types and their letters.
OPERATIONS = {"insert": "I", "update": "U", "delete": "D", "bootstrap-insert": "I"}


def operation(change: Column) -> Column:
    """Letter of a change type; NULL for any other."""
    case = None
    for name, letter in OPERATIONS.items():
        case = F.when(change == name, letter) if case is None else case.when(change == name, letter)
    return case


def parse_changes(raw: DataFrame) -> DataFrame:
    """JSON text in ``value`` → ``type, table, data`` (data as it stands in the text) and ``op``; unknown types are dropped.

    Other columns of ``raw`` are kept.
    """
    rows = to_rows(raw, "value", CDC, raw=("data",))
    return rows.withColumn("op", operation(F.col("type"))).filter("op IS NOT NULL")


def fact_changes(changes: DataFrame, fact_tables: DataFrame) -> DataFrame:
    """Changes of fact tables as ``(topic, value)``. ``fact_tables`` has one column ``name``."""
    facts = keep_listed(changes, "table", fact_tables, "name")
    others = [c for c in facts.columns if c not in ("type", "table", "data", "op")]
    return facts.select(*others, upper_name("DWD", F.col("table"), F.col("op")).alias("topic"), F.col("data").alias("value"))


def dim_changes(changes: DataFrame, dim_tables: DataFrame) -> DataFrame:
    """Changes of dimension tables as ``(key, value)``; a delete is a change like any other."""
    dims = keep_listed(changes, "table", dim_tables, "name")
    others = [c for c in dims.columns if c not in ("type", "table", "data", "op")]
    key = upper_name("DIM", F.col("table"), F.coalesce(F.get_json_object("data", "$.id"), F.lit("null")))
    return dims.select(*others, key.alias("key"), F.col("data").alias("value"))


def dim_snapshot(keyed: DataFrame, seq: str = "seq") -> DataFrame:
    """Latest value per key."""
    return first_per_key(keyed, ["key"], [F.col(seq).desc()]).select("key", "value")


def dim_rows(snapshot: DataFrame, table: str, fields: dict[str, str], tables: list[str]) -> DataFrame:
    """Rows of one dimension out of the snapshot: ``id`` and the JSON ``fields`` (name → path).

    ``tables`` names all dimensions: a key belongs to the one with the longest name that fits, so ``user`` gets no row of ``user_info``.
    """
    prefix = f"DIM_{table.upper()}_"
    mine = F.col("key").startswith(prefix)
    for other in tables:
        if other.upper().startswith(f"{table.upper()}_"):
            mine &= ~F.col("key").startswith(f"DIM_{other.upper()}_")
    return snapshot.filter(mine).select(
        F.substr("key", F.lit(len(prefix) + 1)).alias("id"),
        *[F.get_json_object("value", f"$.{path}").alias(name) for name, path in fields.items()],
    )
