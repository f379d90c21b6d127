"""Sinks. All write from the executors; one output file only on request."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

_CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """``single_file`` sends all rows through one task: for small result tables only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(**_CSV).csv(path)


def write_splits_csv(df: DataFrame, path: str, columns: Sequence[str] = ("Review", "Rating", "Sentiment")) -> None:
    """Both sides of a ``stable_split`` as CSV, in one pass: folders ``split=train`` and ``split=test``."""
    df.select("split", *columns).write.mode("overwrite").partitionBy("split").options(**_CSV).csv(path)


def write_vectors(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_payload_json(df: DataFrame, path: str) -> None:
    """A nested one-row table as JSON; absent values are written as null."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
