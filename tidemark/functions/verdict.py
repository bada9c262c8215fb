"""Long-format metrics and the PASS/FAIL checks computed from them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALUE_TYPE = "decimal(38,2)"


def row_count() -> Column:
    return F.count(F.lit(1))


def total(column: str | Column) -> Column:
    """SUM that is 0 on empty input."""
    return F.coalesce(F.sum(column), F.lit(0).cast("decimal(18,2)"))


def count_where(condition: Column) -> Column:
    """COUNT(*) FILTER (WHERE condition)."""
    return F.count(F.when(condition, F.lit(1)))


def metrics(df: DataFrame, **aggregates: Column) -> DataFrame:
    """Compute all aggregates in one pass and return them as rows (metric, value)."""
    one_row = df.agg(*[a.cast(VALUE_TYPE).alias(n) for n, a in aggregates.items()])
    pairs = [F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in aggregates]
    return one_row.select(F.inline(F.array(*pairs)))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class Check:
    """``source`` and ``target`` hold metric names or constants; several are added up, none means 0."""

    name: str
    source: tuple[str | int, ...]
    target: tuple[str | int, ...]
    is_amount: bool = False


def _value_text(value: Column, is_amount: bool) -> Column:
    return value.cast("string") if is_amount else value.cast("bigint").cast("string")


def check_rows(measured: DataFrame, checks: list[Check], run_at: Column) -> DataFrame:
    """Turn (metric, value) rows into (run_at, check_name, source_value, target_value, variance, status).

    The metric rows are folded into a single row by conditional aggregation, so no join is needed.
    """
    wanted = sorted({m for c in checks for m in (*c.source, *c.target) if isinstance(m, str)})
    folded = measured.agg(*[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in wanted])

    def side(parts: tuple[str | int, ...]) -> Column:
        start = F.lit(0).cast(VALUE_TYPE)
        columns = [F.col(p) if isinstance(p, str) else F.lit(p) for p in parts]
        return reduce(lambda a, b: (a + b).cast(VALUE_TYPE), columns, start)

    rows = []
    for check in checks:
        left, right = side(check.source), side(check.target)
        variance = (left - right).cast(VALUE_TYPE)
        rows.append(
            F.struct(
                F.lit(check.name).alias("check_name"),
                _value_text(left, check.is_amount).alias("source_value"),
                _value_text(right, check.is_amount).alias("target_value"),
                _value_text(variance, check.is_amount).alias("variance"),
                F.when(variance == 0, "PASS").otherwise("FAIL").alias("status"),
            )
        )
    return folded.select(F.inline(F.array(*rows))).select(run_at.alias("run_at"), "*")


def failed_checks(checks: DataFrame) -> DataFrame:
    """How many checks ran and how many failed."""
    return checks.agg(
        row_count().alias("checks"),
        count_where(F.col("status") == "FAIL").alias("failed_checks"),
    )


class GateFailure(RuntimeError):
    """A gate found violations; nothing was published."""


def enforce(gates: DataFrame) -> None:
    """Raise if any (gate, violations) row is non-zero. Only the handful of gate rows is fetched."""
    broken = gates.where("violations <> 0").collect()
    if broken:
        raise GateFailure("; ".join(f"{r.gate}: {r.violations}" for r in broken))
