"""Small tables with the cases that every operator must take: nulls, empty and long texts, ties, repeated rows."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "key string, block int, kept string, size string, score string, rule string, host string, shard string, id string, component string"


def prose(seed: int, words: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice("the of and to alpha beta gamma delta river stone cloud paper seven green".split()) + pick.choice("abcdefgh") for _ in range(words))


LONG = prose(1, 30_000)
TEXTS = [
    (1, prose(2, 80)),
    (2, prose(2, 80)),  # an exact copy
    (3, prose(2, 79) + " changed"),  # a near copy
    (4, prose(2, 80).upper()),  # equal but for case
    (5, None),
    (6, ""),
    (7, " \t\n\x0b\r"),
    (8, LONG),
    (9, LONG + " end"),
    (10, "one"),
    (11, "É é Ω ß x"),
    (12, "!!! ### |||"),
    (12, "another text of the same id"),
    (13, prose(3, 60)),
    (13, prose(3, 60)),  # a repeated row
    (None, prose(4, 50)),
    (None, None),
]


def edge_documents(spark: SparkSession) -> DataFrame:
    rows = [(i, t, "en" if (i or 0) % 2 else None, [None, "a", "b", "c"][(i or 0) % 4], len(t or "")) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


def clashing_documents(spark: SparkSession) -> DataFrame:
    """The same rows with more columns, whose names the operators use or return."""
    from pyspark.sql import functions as F

    docs = edge_documents(spark)
    names = [c.split()[0] for c in CLASHING.split(", ")]
    return docs.withColumns({c: F.lit("x") for c in names})


def empty_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def rows(frame: DataFrame, *columns: str) -> list[tuple]:
    found = [tuple(r) for r in frame.select(*columns).collect()]
    return sorted(found, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))
