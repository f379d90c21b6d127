"""Small column helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The white space that separates words: space, tab, newline, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Working column names that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without its own columns of these names, which the result columns replace."""
    drop = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in drop])


def set_aside(df: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its own columns of these names renamed out of the way, and the renaming back."""
    clash = [c for c in df.columns if c.lower() in {n.lower() for n in names}]
    back = dict(zip(free_names(df, *(f"own_{c}" for c in clash)), clash))
    return df.withColumnsRenamed({c: free for free, c in back.items()}), back


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else changed; null becomes empty.

    ``lower`` does the same as ``translate`` where all characters are ASCII, and is much faster.
    """
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def word_array(text: Column) -> Column:
    """Words between white space as an array; null gives an empty array."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES[1:], " " * (len(SPACES) - 1))
    return F.array_remove(F.split(spaced, " "), "")
