"""Rule evaluation: one pass over the raw table yields both the accepted and the rejected side.

Validity and rejection are two separate predicates on purpose. A NULL in a compared column makes both
unknown, so such a row is neither accepted nor rejected; an account may also be both. Each predicate is
therefore closed with ``coalesce(..., false)`` on its own and never derived from the other.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import json_payload
from tidemark.functions.verdict import count_where, row_count, total
from tidemark.operators.keys import unique_by
from tidemark.operators.standardise import PROJECTIONS
from tidemark.schemas import OPEN_STATUS, Entity

@dataclass(frozen=True)
class Rule:
    """A rejection rule as data; ``fails`` is a SQL condition over the raw row and its resolved facts.

    The date of the run is available to conditions as ``as_of``.
    """

    rule_id: str
    severity: str
    message: str
    fails: str


@dataclass(frozen=True)
class Lookup:
    """Resolve ``column`` in ``dimension``; adds ``<name>_found`` and any extra facts.

    Extra facts (name -> SQL aggregate over the dimension rows of one key) keep the joined side unique per key, so a
    lookup can never multiply rows. ``laid_out`` says that rows come partitioned by the column, because the preparation of
    the book did that; a join with all keys of the dimension then costs them no exchange.
    """

    name: str
    column: str
    dimension: str
    key: str
    facts: dict[str, str] = field(default_factory=dict)
    laid_out: bool = False


@dataclass(frozen=True)
class RuleBook:
    """``accepts`` lists the conditions that an accepted row meets, all of them; one SQL text stands for a list of one."""

    entity: Entity
    accepts: str | tuple[str, ...]
    rules: tuple[Rule, ...]
    lookups: tuple[Lookup, ...] = ()
    prepare: Callable[[DataFrame], DataFrame] | None = None
    #: Whether the preparation chooses between versions of a record, which takes the lineage columns.
    by_version: bool = False

    def rule(self, rule_id: str) -> Rule:
        return next(r for r in self.rules if r.rule_id == rule_id)

    def conditions(self) -> tuple[str, ...]:
        return (self.accepts,) if isinstance(self.accepts, str) else self.accepts

    def resolved(self) -> set[str]:
        """The columns that the lookups add."""
        return {name for k in self.lookups for name in (f"{k.name}_found", *k.facts)}


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


Settle = Callable[[DataFrame, str], DataFrame]


def notable_keys(df: DataFrame, lookup: Lookup, dimension: DataFrame) -> DataFrame:
    """The foreign keys there is something to say about: those without a dimension row, and those with a fact.

    Used keys are made distinct first, which combines on the map side, so only keys are shuffled, never whole rows.
    """
    known, found = f"{lookup.name}_known_key", f"{lookup.name}_found"
    used = df.select(F.col(lookup.column).alias(known)).where(F.col(known).isNotNull()).distinct()
    keys = dimension.select(F.col(lookup.key).alias("dimension_key"))
    notable = used.join(keys, F.col(known) == F.col("dimension_key"), "left_anti").withColumn(found, F.lit(False))
    if lookup.facts:
        facts = [F.expr(f"{text} AS {name}") for name, text in lookup.facts.items()]
        per_key = unique_by(dimension, lookup.key, known, F.lit(True).alias(found), *facts)
        some = " OR ".join(f"{name} IS NOT NULL" for name in lookup.facts)
        notable = notable.unionByName(per_key.where(some), allowMissingColumns=True)
    return notable


def attach(
    df: DataFrame, lookup: Lookup, dimension: DataFrame, settle: Settle | None = None, used: DataFrame | None = None
) -> DataFrame:
    """Add ``<name>_found`` and the facts of a foreign key by a left join with its notable keys.

    No broadcast is forced. ``settle`` writes the notable keys first; Spark then knows their size before it plans the
    join, and while few keys fail it needs no exchange of the wide rows. Otherwise it sort-merges with adaptive splitting
    of hot keys. ``used`` are rows with all foreign keys of ``df``, and maybe more, where they are had cheaper than ``df``.
    """
    known, found = f"{lookup.name}_known_key", f"{lookup.name}_found"
    if lookup.laid_out:
        per_key = unique_by(dimension, lookup.key, known, F.lit(True).alias(found))
        return df.join(per_key, F.expr(f"{lookup.column} = {known}"), "left").drop(known)
    notable = notable_keys(df if used is None else used, lookup, dimension)
    if settle is not None:
        notable = settle(notable, f"keys-{lookup.name}")
    joined = df.join(notable, F.expr(f"{lookup.column} = {known}"), "left").drop(known)
    return joined.withColumn(found, F.expr(f"{lookup.column} IS NOT NULL AND coalesce({found}, TRUE)"))


def evaluate(
    raw: DataFrame,
    book: RuleBook,
    dimensions: Mapping[str, DataFrame] | None = None,
    as_of: Column | None = None,
    settle: Settle | None = None,
    used: DataFrame | None = None,
) -> DataFrame:
    """Raw columns plus ``is_valid`` and ``failed_rules``. ``settle`` and ``used`` are for the keys of lookups, see ``attach``.

    ``failed_rules`` is a bit mask, bit i standing for rule i of the book: eight bytes per row however many rules
    fail, computed and tested inside whole-stage code generation (array functions with lambdas are not).
    """
    today = (F.current_date() if as_of is None else as_of).alias("as_of")
    known, early, conditions = raw, (), book.conditions()
    if book.prepare is not None:
        known = book.prepare(raw)
    elif book.lookups:  # what the row alone tells is settled before the lookups, so its columns need not travel with it
        early = tuple(i for i, r in enumerate(book.rules) if not mentions(r.fails, book.resolved()))
        sure = [c for c in conditions if not mentions(c, book.resolved())]
        conditions = ["early_valid", *[c for c in conditions if c not in sure]]
        verdicts = [F.expr(rule_bits(book, early)).alias("early_failed"), F.expr(all_hold(sure)).alias("early_valid")]
        known = raw.select("*", today).select("*", *verdicts).drop("as_of")
    for lookup in book.lookups:
        known = attach(known, lookup, (dimensions or {})[lookup.dimension], settle, used)
    resolved = [f"coalesce({k.name}_found, FALSE) AS {k.name}_found" for k in book.lookups]
    facts = [name for k in book.lookups for name in k.facts]
    extra = [c for c in known.columns if c not in raw.columns and c not in facts and not c.endswith("_found")]
    known = known.select(*raw.columns, *extra, *facts, *[F.expr(r) for r in resolved], today)
    late = rule_bits(book, [i for i in range(len(book.rules)) if i not in early])
    return known.selectExpr(
        *raw.columns,
        # one by one, so that those on the row alone are filters below the lookups
        f"{all_hold(conditions)} AS is_valid",
        f"{late} | early_failed AS failed_rules" if early else f"{late} AS failed_rules",
    )


def looked_up(book: RuleBook, dimension: str) -> list[str]:
    """The columns of a dimension that the lookups of a book read: keys, and those that facts name."""
    found = [k for k in book.lookups if k.dimension == dimension]
    words = {w for k in found for text in k.facts.values() for w in re.findall(r"\w+", re.sub(r"'[^']*'", "", text))}
    facts = [c for c in PROJECTIONS.get(dimension, ()) if c in words]
    return list(dict.fromkeys([*(k.key for k in found), *facts]))


def mentions(condition: str, columns: set[str]) -> bool:
    """Whether any of the names occurs in a SQL text."""
    return any(re.search(rf"\b{re.escape(c)}\b", condition) for c in columns)


def all_hold(conditions: Iterable[str]) -> str:
    """SQL of a conjunction in which what is unknown does not hold."""
    return " AND ".join(["TRUE", *[f"coalesce({c}, FALSE)" for c in conditions]])


def rule_bits(book: RuleBook, positions: Iterable[int]) -> str:
    """SQL of the bit mask of some rules of a book; the others' bits are 0."""
    bits = [f"CASE WHEN {book.rules[i].fails} THEN {1 << i}L ELSE 0L END" for i in positions]
    return " | ".join(["0L", *bits])


def is_rejected() -> Column:
    return F.col("failed_rules") != 0


def failure_count() -> Column:
    """How many rules a record failed."""
    return F.bit_count("failed_rules").cast("bigint")


def accepted(evaluated: DataFrame) -> DataFrame:
    """Rows of the valid side, verdict columns dropped."""
    return evaluated.where("is_valid").drop("is_valid", "failed_rules")


def _rule_rows(evaluated: DataFrame, book: RuleBook) -> DataFrame:
    """One row per (record, failed rule). Rows without failures are dropped before the rules are unfolded."""
    listed = [
        f"named_struct('bit', {1 << i}L, 'rule_id', '{r.rule_id}', 'severity', '{r.severity}', "
        f"'error_message', {quoted(r.message)})"
        for i, r in enumerate(book.rules)
    ]
    unfolded = evaluated.where(is_rejected()).selectExpr("*", f"inline(array({', '.join(listed)}))")
    return unfolded.where(F.col("failed_rules").bitwiseAND(F.col("bit")) != 0)


def quarantine(evaluated: DataFrame, book: RuleBook, rejected_at: Column, keep: Sequence[str] = ()) -> DataFrame:
    """The ten-column quarantine layout, one row per failed rule; ``keep`` are further columns to carry along."""
    entity = book.entity
    return _rule_rows(evaluated, book).select(
        "migration_batch_id",
        "source_system",
        "source_table",
        "source_record_key",
        "rule_id",
        "severity",
        "error_message",
        json_payload(entity.schema, entity.payload).alias("raw_payload"),
        rejected_at.cast("timestamp").alias("rejected_at"),
        F.lit(OPEN_STATUS).alias("resolution_status"),
        *keep,
    )


def quarantine_keys(evaluated: DataFrame, book: RuleBook) -> DataFrame:
    """Key and rule of every quarantine row, without its payload: enough to count records, from few columns."""
    return _rule_rows(evaluated, book).select("source_record_key", "rule_id")


def source_quarantine(
    evaluated: DataFrame, book: RuleBook, record_key: Column, source_system: str, rejected_at: Column
) -> DataFrame:
    """Pre-migration variant: no batch id, and the whole source row as payload."""
    entity = book.entity
    return _rule_rows(evaluated, book).select(
        F.lit(source_system).alias("source_system"),
        F.lit(entity.source_table).alias("source_table"),
        record_key.alias("source_record_key"),
        "rule_id",
        "severity",
        "error_message",
        json_payload(entity.schema, entity.columns).alias("raw_payload"),
        rejected_at.cast("timestamp").alias("rejected_at"),
        F.lit(OPEN_STATUS).alias("resolution_status"),
    )


def rule_summary(quarantined: DataFrame) -> DataFrame:
    """Failures per rule and severity."""
    return quarantined.groupBy("rule_id", "severity").agg(row_count().alias("failures"))


def table_summary(quarantined: DataFrame) -> DataFrame:
    """Rejected rows per source table, plus the total line."""
    per_table = quarantined.groupBy("source_table").agg(row_count().alias("rejected_records"))
    whole = quarantined.agg(row_count().alias("rejected_records")).select(
        F.lit("Total").alias("source_table"), "rejected_records"
    )
    return per_table.unionByName(whole)


def disposition() -> Column:
    """What became of a record: VALID, REJECTED, BOTH or UNACCOUNTED."""
    return (
        F.when(F.col("is_valid") & is_rejected(), "BOTH")
        .when(F.col("is_valid"), "VALID")
        .when(is_rejected(), "REJECTED")
        .otherwise("UNACCOUNTED")
    )


def disposition_summary(evaluated: DataFrame, amount: str | None = None) -> DataFrame:
    """Rows, and the summed amount if asked for, per disposition."""
    extra = [total(amount).cast("decimal(38,2)").alias("amount")] if amount else []
    return (
        evaluated.withColumn("disposition", disposition())
        .groupBy("disposition")
        .agg(row_count().alias("records"), *extra)
    )


def staging_counts(evaluated: DataFrame) -> DataFrame:
    """One row: raw rows, valid rows, distinct rejected record keys and rule failures.

    The rules are evaluated once. Only rejected keys take part in the grouping; all other rows share the
    NULL group and leave each map task as a single partial row.
    """
    rejected_key = F.when(is_rejected(), F.col("source_record_key"))
    per_key = evaluated.groupBy(rejected_key.alias("rejected_key")).agg(
        row_count().alias("raw_rows"),
        count_where(F.col("is_valid")).alias("valid_rows"),
        F.sum(failure_count()).alias("failures"),
    )
    return per_key.agg(
        F.coalesce(F.sum("raw_rows"), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum("valid_rows"), F.lit(0)).alias("valid_rows"),
        F.count("rejected_key").alias("rejected_records"),
        F.coalesce(F.sum("failures"), F.lit(0)).alias("rule_failures"),
    )


def staging_gate(evaluated: DataFrame) -> DataFrame:
    """The counts plus status: PASS when raw = valid + distinct rejected."""
    balanced = F.col("raw_rows") == F.col("valid_rows") + F.col("rejected_records")
    return staging_counts(evaluated).withColumn("status", F.when(balanced, "PASS").otherwise("FAIL"))
