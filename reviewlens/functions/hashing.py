"""Content hashes used for reproducible choices, independent of how rows are partitioned."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined(*columns: Column) -> Column:
    """The columns as one string; nulls stay distinct from empty strings."""
    return F.concat_ws("|", *[F.coalesce(column.cast("string"), F.lit("\u0000")) for column in columns])


def md5_number(key: Column, digits: int = 8) -> Column:
    """The first hex digits of the MD5 sum as a long."""
    return F.conv(F.substring(F.md5(key), 1, digits), 16, 10).cast("long")


def md5_unit(key: Column) -> Column:
    """A double in [0, 1) from 52 bits of the MD5 sum."""
    return md5_number(key, 13) / F.lit(float(2**52))
