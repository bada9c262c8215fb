"""Canonical text of typed values: the byte-exact base of hashes, keys and payloads.

The expressions are assembled as SQL text and parsed once, which keeps planning cheap for wide tables.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def instant_text(value: str) -> str:
    """SQL for an instant as text with the non-zero digits of its fraction and the zone offset.

    Examples: 2024-01-02 03:04:05+00, 2024-01-02 03:04:05.25+00. No digit is lost, so two versions of a record that
    differ below the second have different hashes, keys and payloads.
    """
    return f"concat(CAST({value} AS STRING), date_format({value}, 'x'))"


def canonical_text(field: T.StructField) -> str:
    """SQL for the text of a key, date, decimal, flag or instant; doubles are refused."""
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        raise TypeError(f"{field.name}: floating point has no canonical text")
    if isinstance(field.dataType, T.TimestampType):
        return instant_text(field.name)
    if isinstance(field.dataType, T.StringType):
        return field.name
    return f"CAST({field.name} AS STRING)"


def record_key(schema: T.StructType, key: tuple[str, ...]) -> Column:
    """Primary key as text; the parts of a composite key are joined by a pipe."""
    return F.expr(f"concat_ws('|', {', '.join(canonical_text(schema[c]) for c in key)})")


def record_hash(schema: T.StructType, columns: tuple[str, ...], blank_when_null: tuple[str, ...] = ()) -> Column:
    """SHA-256 over the pipe-joined business columns.

    ``concat_ws`` skips NULLs, so only the columns in ``blank_when_null`` keep their place when empty.
    """
    parts = [
        f"coalesce({canonical_text(schema[c])}, '')" if c in blank_when_null else canonical_text(schema[c])
        for c in columns
    ]
    return F.expr(f"sha2(concat_ws('|', {', '.join(parts)}), 256)")


def json_payload(schema: T.StructType, columns: tuple[str, ...]) -> Column:
    """JSON object of the raw values in the given order, NULLs kept, instants as text."""
    fields = [
        f"'{c}', {canonical_text(schema[c])}" if isinstance(schema[c].dataType, T.TimestampType) else f"'{c}', {c}"
        for c in columns
    ]
    return F.expr(f"to_json(named_struct({', '.join(fields)}), map('ignoreNullFields', 'false'))")
