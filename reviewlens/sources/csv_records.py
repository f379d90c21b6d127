"""Records of CSV files with newlines inside quoted fields, read by many tasks for each file.

A newline ends a record when the quotes before it are even in number. Spark's text source deals a file to ranges of
whole lines; the first pass counts the quotes of each range, and their running parity tells whether a range begins
inside a quoted field. The second pass cuts each range into records alone. Only records that cross a range boundary,
at most two pieces per range, are put together in a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_WHOLE, _CLOSING, _OPENING = 0, 1, 2  # a record, its end, and its beginning
_OUT = "file string, range long, header boolean, kind int, record string"


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    lines = spark.read.text(path, lineSep="\n")
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"))


def inside_ranges(lines: DataFrame) -> dict[str, list[int]]:
    """Per file, the starts of the ranges that begin inside a quoted field: one number for a range at most."""
    odd = (F.sum(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2).alias("odd")
    order = W.partitionBy("file").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = lines.groupBy("file", "range").agg(odd).withColumn("before", F.coalesce(F.sum("odd").over(order), F.lit(0)) % 2)
    found: dict[str, list[int]] = {}
    for row in ranges.filter("before = 1").select("file", "range").collect():
        found.setdefault(row["file"], []).append(row["range"])
    return found


def _cut(inside):
    """Function from the lines of whole ranges, in order, to their records and pieces of records."""

    def cut(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        where, odd, first, pending, opened = None, 0, False, [], False

        def rows(place, kinds, records, header=False):
            count = len(kinds)
            file, start = place
            flags = np.zeros(count, bool)
            flags[:1] = header
            return pa.RecordBatch.from_arrays(
                [pa.array([file] * count, pa.string()), pa.array([start] * count, pa.int64()), pa.array(flags), pa.array(kinds, pa.int32()), records],
                names=["file", "range", "header", "kind", "record"],
            )

        def rest():
            """What is left of a range whose last record is not closed."""
            kind = _OPENING if opened else _CLOSING
            return rows(where, [kind], pa.array(["\n".join(pending)], pa.string()), first)

        for batch in batches:
            files, starts, values = (batch[name] for name in ("file", "range", "value"))
            numbers = starts.to_numpy()
            changes = np.flatnonzero(numbers[1:] != numbers[:-1]) + 1 if len(numbers) else []
            names = files.to_pylist() if files.null_count == 0 and len(pc.unique(files)) > 1 else None
            if names:
                changes = sorted({*changes, *(i for i in range(1, len(names)) if names[i] != names[i - 1])})
            bounds = [0, *changes, len(numbers)]
            for low, high in zip(bounds, bounds[1:]):
                if low == high:
                    continue
                place = (files[low].as_py(), int(numbers[low]))
                if place != where:
                    if pending:
                        yield rest()
                    where, odd = place, int(place[1] in inside.value.get(place[0], ()))
                    first, pending, opened = place[1] == 0, [], False
                part = values.slice(low, high - low)
                after = (odd + np.cumsum(pc.count_substring(part, '"').to_numpy())) % 2
                before = np.concatenate(([odd], after[:-1]))
                odd = int(after[-1])
                whole = (before == 0) & (after == 0)
                kinds, records = [], []
                for i in np.flatnonzero(~whole).tolist():
                    if before[i] == 0:
                        pending, opened = [part[i].as_py()], True
                    else:
                        pending.append(part[i].as_py())
                        if after[i] == 0:
                            kinds.append(_WHOLE if opened else _CLOSING)
                            records.append("\n".join(pending))
                            pending, opened = [], False
                plain = part.filter(pa.array(whole))
                if len(plain):
                    yield rows(place, np.zeros(len(plain), np.int32), plain, first and bool(whole[0]))
                if kinds:
                    yield rows(place, kinds, pa.array(records, pa.string()), first and not whole[0] and kinds[0] == _WHOLE)
                first = first and not len(plain) and not kinds
        if pending:
            yield rest()

    return cut


def csv_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(file, header, record)``: one row per record, with its quotes; ``header`` marks the first of each file.

    Quotes stand around fields and doubled inside them. Lines end with a newline; a carriage return before the one
    that ends a record is cut off, others stay. Empty records are left out. A file whose last field is never closed
    gives what there is as its last record. Order is not kept. A compressed file is one range.
    """
    lines = _lines(spark, path)
    inside = spark.sparkContext.broadcast(inside_ranges(lines))
    cut = lines.mapInArrow(_cut(inside), _OUT)
    pieces = cut.filter(F.col("kind") != _WHOLE)
    # Pieces of a record follow its beginning, up to the next one; there are at most two for a range.
    order = W.partitionBy("file").orderBy("range", "kind")
    begun = F.max(F.when(F.col("kind") == _OPENING, F.col("range"))).over(order.rowsBetween(W.unboundedPreceding, 0))
    whole = F.transform(F.array_sort(F.collect_list(F.struct("range", "kind", "record"))), lambda piece: piece["record"])
    joined = pieces.withColumn("begun", begun).groupBy("file", "begun").agg(
        F.bool_or("header").alias("header"), F.array_join(whole, "\n").alias("record")
    )
    records = cut.filter(F.col("kind") == _WHOLE).select("file", "header", "record").unionByName(joined.select("file", "header", "record"))
    bare = F.regexp_replace(F.when(F.col("header"), F.regexp_replace("record", r"\A﻿", "")).otherwise(F.col("record")), r"\r\z", "")
    return records.select("file", "header", bare.alias("record")).filter("record <> ''")
