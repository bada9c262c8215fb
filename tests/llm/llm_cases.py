"""Documents that hold what real tables may hold: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for their own columns.
CLASHING = (
    "chunk kept_text fingerprint component component_id n_tokens n_words kept clean_text row place key mask size words copies "
    "target taken source_size part piece_ids piece_offsets decoded dedup_text dedup_lines dedup_removed text_hash text_md5 hash"
).split()


def words(text):
    return WORD.findall(text or "")


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}{rng.choice(['', '', '', ',', '.'])}" for _ in range(n))


def rows(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    passage = prose(rng, 60)
    block = "\n".join(prose(rng, 8) + "." for _ in range(4))
    out = []
    for i in range(40):
        text = prose(rng, rng.randrange(12, 120))
        if i % 4 == 0:
            text += " " + passage
        if i % 5 == 0:
            text = block + "\n" + text + "\n\n" + block
        out.append((i * 3 + 1, text, "en", f"src{i % 4}", len(text)))
    out += [(200 + i, out[2][1], "en", "src0", 1) for i in range(3)]  # copies
    out += [
        (300, None, None, None, None),
        (301, "", "en", "src1", 0),
        (302, " \n\t \n ", "en", "src1", 6),
        (303, "one", "en", "é", 3),
        (304, "one two", "en", "src2", 7),
        (305, "é́  Ünï ▁ <|endoftext|> </s> x  y\r\nz \x1c 日本語 " * 9, "fr", None, 1),
        (None, out[3][1], "en", "src3", 1),
        (None, prose(rng, 40), None, "src3", 1),
        (306, prose(rng, 30_000, 5000), "de", "src1", 1),  # long
        (307, "x" * 50_000, "de", "src1", 1),  # one long word
        (308, "dup\ndup\ndup\ndup\ndup\ndup", "de", "src1", 1),
    ]
    out += [out[1], out[1], (4, "another text under a used id " + passage, "en", "src0", 1)]  # repeated rows and id
    return out


def documents(spark: SparkSession, clashing: bool = True, seed: int = 1) -> DataFrame:
    df = spark.createDataFrame(rows(seed), SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("own") for c in CLASHING}) if clashing else df


def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def bag(values) -> list:
    """For comparing rows in any order, nulls included."""
    return sorted(values, key=repr)
