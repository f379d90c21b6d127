"""Conversions between ML vectors, arrays and sparse (indices, values) pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_vector(values: Column) -> Column:
    return array_to_vector(values.cast("array<double>"))


def to_array(vector: Column) -> Column:
    return vector_to_array(vector)


def positive_probability(probability: Column) -> Column:
    """Probability of class 1."""
    return vector_to_array(probability)[1]


def margin_to_probability(raw: Column, mllib_scale: bool = False) -> Column:
    """Logistic function of the class-1 margin; MLlib's boosted trees double the margin first."""
    margin = vector_to_array(raw)[1]
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(margin * 2 if mllib_scale else margin)))


def sparse_entries(df: DataFrame, vector: str, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns plus ``indices`` and ``values`` of a vector column; a sparse vector is not made dense."""
    fields = df.select(*keep, F.unwrap_udt(vector).alias("_v"))
    every = F.when(F.size("_v.values") > 0, F.sequence(F.lit(0), F.size("_v.values") - 1)).otherwise(F.array().cast("array<int>"))
    return fields.select(*keep, F.coalesce("_v.indices", every).alias("indices"), F.col("_v.values").alias("values"))


def sparse_vectors(df: DataFrame, size: int, keep: Sequence[str], out: str) -> DataFrame:
    """``keep`` columns plus a sparse vector built from ``indices`` (ascending) and ``values``."""

    def pack(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            rows = batch.num_rows
            vector = pa.StructArray.from_arrays(
                [
                    pa.array(np.zeros(rows, dtype=np.int8)),
                    pa.array(np.full(rows, size, dtype=np.int32)),
                    batch.column(batch.schema.get_field_index("indices")),
                    batch.column(batch.schema.get_field_index("values")),
                ],
                names=["type", "size", "indices", "values"],
            )
            rest = [batch.column(batch.schema.get_field_index(name)) for name in keep]
            yield pa.RecordBatch.from_arrays([*rest, vector], names=[*keep, out])

    schema = T.StructType([df.schema[name] for name in keep] + [T.StructField(out, VectorUDT())])
    return df.select(*keep, "indices", "values").mapInArrow(pack, schema)
