"""Token counts: batch encoding inside Arrow functions that returns lengths only.

Texts come in portions of about the same bytes. Each is cut at safe boundaries, so a very long text costs the library
short segments; the distinct segments of a portion are encoded in batches balanced by bytes, and only lengths stay.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.rows import with_text_columns
from tidemark.llm.segments import counting

ADDED = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])


def token_counts(docs: DataFrame, tokenizer: str, text_column: str = "text") -> DataFrame:
    """The documents with ``n_bytes`` (UTF-8) and ``n_tokens``, as the tokenizers library counts them.

    ``tokenizer`` is the path of its JSON file, present on every machine. Special strings inside texts count as the
    library takes them by default. Null and empty texts: 0. Repeated rows are counted each; a column named like a result
    is replaced.
    """

    def compute(texts: list[bytes]) -> list[pa.Array]:
        counts = [sum(lengths) for lengths in counting(tokenizer)(texts)]
        return [pa.array([len(t) for t in texts], pa.int64()), pa.array(counts, pa.int64())]

    return with_text_columns(docs, text_column, ADDED, compute, owner=tokenizer)
