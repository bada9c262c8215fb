"""Row-wise operators: new columns computed from a text column in Arrow batches, beside the columns a row has."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm import memory
from tidemark.llm.texts import PORTION_BYTES, encoded, portions


def with_text_columns(
    docs: DataFrame,
    text_column: str,
    added: T.StructType,
    compute: Callable[[list[bytes]], list[pa.Array]],
    most: int = PORTION_BYTES,
    owner: str | None = None,
) -> DataFrame:
    """Add the columns that ``compute`` makes of a list of UTF-8 texts; one that a row already has is replaced.

    Rows stay in their task and order. Texts reach ``compute`` in portions of about ``most`` bytes, a longer text alone.
    ``owner`` names what workers may keep between these tasks (``memory``).
    """
    stay = [f for f in docs.schema.fields if f.name not in added.names]
    names = [f.name for f in stay]

    def run(batches):
        memory.begin(owner)
        for part in portions(batches, text_column, most):
            made = compute(encoded(part.column(text_column)))
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *made], [*names, *added.names])

    return docs.mapInArrow(run, T.StructType([*stay, *added.fields]))
