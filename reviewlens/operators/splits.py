"""Train/test splits that do not depend on how the rows are partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.hashing import joined, md5_number, md5_unit

TRAIN, TEST = "train", "test"


def split_key(columns: Sequence[Column], method: str = "murmur3") -> Column:
    """A number from 0 to 99 that depends on the row content only.

    ``murmur3`` is ``abs(hash(...)) % 100``; the hash is widened first because the absolute value
    of the smallest int does not fit an int. ``md5`` can be recomputed by other engines.
    """
    if method == "murmur3":
        return (F.abs(F.hash(*columns).cast("long")) % 100).cast("int")
    if method == "md5":
        return (md5_number(joined(*columns)) % 100).cast("int")
    raise ValueError(f"unknown method {method!r}")


def stable_split(
    df: DataFrame,
    columns: Sequence[str] = ("Review", "Rating"),
    train_percent: int = 80,
    method: str = "murmur3",
) -> DataFrame:
    """Adds ``split_key`` and ``split`` ('train' or 'test')."""
    key = split_key([F.col(name) for name in columns], method)
    return df.withColumn("split_key", key).withColumn(
        "split", F.when(F.col("split_key") < train_percent, TRAIN).otherwise(TEST)
    )


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42, key: Sequence[str] | None = None
) -> DataFrame:
    """Adds ``part`` (0, 1, ...) by a seeded draw per row, in proportion to ``weights``.

    ``DataFrame.randomSplit`` draws by row position, so a lost executor or another partitioning may
    change its parts. Here the draw hashes the seed and the ``key`` columns (all by default); rows
    equal in these go to the same part.
    """
    total, upto, bounds = float(sum(weights)), 0.0, []
    for weight in weights[:-1]:
        upto += weight
        bounds.append(upto / total)
    draw = md5_unit(joined(F.lit(seed), *[F.col(name) for name in key or df.columns]))
    part = sum([F.when(draw >= bound, 1).otherwise(0) for bound in bounds], F.lit(0))
    return df.withColumn("part", part.cast("int"))


def part(df: DataFrame, value: int | str) -> DataFrame:
    """One side of a split, without the split columns."""
    column = "split" if isinstance(value, str) else "part"
    return df.filter(F.col(column) == value).drop("split", "split_key", "part")


def concat_splits(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.unionByName(test)
