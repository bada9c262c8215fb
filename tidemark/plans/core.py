"""Dimensions and facts: projection, integrity gates, publish only after the gates hold."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.verdict import enforce, metrics, row_count, union_all
from tidemark.operators.balances import equation_failures
from tidemark.operators.keys import duplicate_keys, orphan_count
from tidemark.operators.standardise import standardise
from tidemark.schemas import ENTITIES
from tidemark.sources.sinks import point_to, replace_path

CORE_NAMES = {
    "branch": "dim_branch",
    "customer": "dim_customer",
    "account": "dim_account",
    "transaction": "fct_transaction",
    "daily_balance": "fct_daily_balance",
}

# Foreign keys the core gates look at. Accounts are gated on customers only; an unknown branch passes here and
# shows up in the foreign-key audit.
GATED_KEYS = {
    "account": (("missing_customers", "customer_id", "customer", "customer_id"),),
    "transaction": (
        ("missing_source_accounts", "source_account_id", "account", "account_id"),
        ("missing_destination_accounts", "destination_account_id", "account", "account_id"),
    ),
    "daily_balance": (("missing_accounts", "account_id", "account", "account_id"),),
}
COUNTED = ("transaction", "daily_balance")


def build_core(accepted_raw: DataFrame, entity_name: str) -> DataFrame:
    """Staging projection of accepted raw rows; core keeps it column by column."""
    return standardise(accepted_raw, entity_name)


def _gate(one_row: DataFrame, name: str) -> DataFrame:
    value = F.col(one_row.columns[0]).cast("bigint")
    return one_row.select(F.lit(name).alias("gate"), value.alias("violations"))


def gate_columns(entity_name: str) -> list[str]:
    """The columns of a core table that its gates look at."""
    wanted = [*ENTITIES[entity_name].key, *[column for _, column, _, _ in GATED_KEYS.get(entity_name, ())]]
    if entity_name == "daily_balance":
        wanted += ["opening_balance", "debit_total", "credit_total", "closing_balance"]
    return list(dict.fromkeys(wanted))


def gated_columns(entity_name: str, parent: str) -> list[str]:
    """The columns of a parent's core table that the gates of an entity look at."""
    return [key for _, _, table, key in GATED_KEYS.get(entity_name, ()) if table == parent]


def core_gates(
    entity_name: str, core: DataFrame, staging: DataFrame | int, dimensions: dict[str, DataFrame]
) -> DataFrame:
    """(gate, violations) rows of one core table; for staging its number of rows is enough."""
    gates = [
        _gate(duplicate_keys(core, *ENTITIES[entity_name].key).agg(row_count().alias("n")), "duplicate_keys")
    ]
    for gate, column, parent, key in GATED_KEYS.get(entity_name, ()):
        gates.append(_gate(orphan_count(core, column, dimensions[parent], key), gate))
    if entity_name in COUNTED:
        sizes, counted = metrics(core, rows=-row_count()), F.lit(0)
        if isinstance(staging, int):
            counted = F.lit(staging)
        else:
            sizes = metrics(staging, rows=row_count()).unionByName(sizes)
        gates.append(_gate(sizes.agg((F.sum("value") + counted).alias("n")), "staging_core_difference"))
    if entity_name == "daily_balance":
        gates.append(_gate(equation_failures(core).agg(row_count().alias("n")), "equation_failures"))
    return union_all(gates)


def publish(
    entity_name: str,
    core: DataFrame,
    staging: DataFrame,
    dimensions: dict[str, DataFrame],
    path: str,
    write: Callable[[DataFrame, str], None] = replace_path,
    label: str = "",
) -> DataFrame:
    """Write a candidate to a folder of its own, read it back, and make it current once its gates hold.

    The gates see the files written, not the plan they came from, so rows lost on the way are noticed. A failing gate or
    a write that breaks leaves the current version as it is, for readers too.
    """
    spark, folder = core.sparkSession, f"{path}/version-{uuid.uuid4().hex}"
    write(core, folder)
    candidate = spark.read.schema(core.schema).parquet(folder)
    enforce(core_gates(entity_name, candidate, staging, dimensions))
    point_to(spark, path, folder, label)
    return candidate
