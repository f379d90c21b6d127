"""Terms and labels numbered by frequency without the driver, for vocabularies of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewlens.functions.vectors import sparse_vectors
from reviewlens.session import stage


def numbered(df: DataFrame, order: list[Column], out: str = "id") -> DataFrame:
    """Adds 0, 1, 2, ... in the given order, which should tell all rows apart.

    The rows are dealt to ranges of the order and written; rows are counted per range, and the counts of the ranges
    before are added to the place within the range. No task sees more than a range.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage(df.repartitionByRange(slices, *order).withColumn("_slice", F.spark_partition_id()), "ranged")
    before = W.partitionBy().orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)  # one row for a range
    starts = ranged.groupBy("_slice").agg(F.count(F.lit(1)).alias("n")).select(
        "_slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start")
    )
    place = F.row_number().over(W.partitionBy("_slice").orderBy(*order)).alias("_place")
    joined = ranged.select("*", place).join(starts, "_slice")
    return joined.withColumn(out, F.col("_start") + F.col("_place") - 1).drop("_slice", "_start", "_place")


def _counted(tokens: Column) -> Column:
    """``(term, tf)`` entries of a token list, from the runs of equal tokens of the sorted list."""

    def runs(given: Column) -> Column:
        size = F.size(given)
        places = F.sequence(F.lit(0), size - 1)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(given, i) != F.get(given, i - 1)))
        ends = F.concat(F.slice(starts, 2, size), F.array(size))
        return F.zip_with(starts, ends, lambda a, b: F.when(a.isNotNull(), F.struct(F.get(given, a).alias("term"), (b - a).cast("long").alias("tf"))))

    # Bound to a variable, the list is sorted once; null tokens are no terms.
    kept = F.array_sort(F.filter(tokens, lambda t: t.isNotNull()))
    return F.transform(F.array(kept), lambda given: F.when(F.size(given) > 0, runs(given)))[0]


def document_terms(df: DataFrame, key: str, tokens: str) -> DataFrame:
    """``(key, term, tf)``. Rows that share a key are one.

    Each row counts its own tokens where it is. The counts only move to be added up if keys repeat, which is looked up
    in the keys alone.
    """
    counted = df.select(key, F.inline_outer(_counted(F.col(tokens)))).filter(F.col("term").isNotNull())
    if df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).isEmpty():
        return counted
    return counted.groupBy(key, "term").agg(F.sum("tf").alias("tf"))


def term_dictionary(df: DataFrame, key: str, tokens: str, min_df: int = 2, vocab_size: int | None = None) -> DataFrame:
    """``(term, id, n, df)`` of the terms in at least ``min_df`` rows, by falling frequency, ties by term.

    The ids are those of a ``CountVectorizer`` vocabulary; ``vocab_size`` keeps the first ones, None all of them.
    """
    totals = document_terms(df, key, tokens).groupBy("term").agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("df"))
    terms = numbered(totals.filter(F.col("df") >= min_df), [F.desc("n"), F.asc("term")])
    kept = terms if vocab_size is None else terms.filter(F.col("id") < vocab_size)
    return stage(kept.select("term", "id", "n", "df"), "dictionary")


def dictionary_vectors(
    df: DataFrame, key: str, tokens: str, dictionary: DataFrame, size: int, rows: int | None = None, out: str = "features"
) -> DataFrame:
    """``(key, vector)`` for every ``key``: term counts at the dictionary's ids, of length ``size``.

    With ``rows``, the number of rows the dictionary was fitted on, counts are weighed by ``ln((rows + 1) / (df + 1))``.
    Tokens are counted per document, joined with the dictionary by term, and put together by one aggregation;
    documents without known terms get an empty vector. Rows that share a key are one document.
    """
    counted = document_terms(df, key, tokens)
    weight = F.lit(1.0) if rows is None else F.log((F.lit(rows) + 1) / (F.col("df") + 1))
    known = counted.join(dictionary.select("term", "id", "df"), "term")
    entry = F.struct(F.col("id").cast("int").alias("id"), (F.col("tf") * weight).alias("value"))
    # A document whose terms are all unknown keeps its row by this mark.
    marks = df.select(key, F.lit(None).cast(known.select(entry.alias("e")).schema["e"].dataType).alias("e"))
    both = known.select(key, entry.alias("e")).unionByName(marks)
    lists = both.groupBy(key).agg(F.array_sort(F.collect_list("e")).alias("e"))
    return sparse_vectors(lists.select(key, F.col("e.id").alias("indices"), F.col("e.value").alias("values")), size, [key], out)


def label_dictionary(df: DataFrame, column: str) -> DataFrame:
    """``(value, id, n)``: values by falling frequency, ties by value, as ``fit_label_index`` numbers them."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return stage(numbered(counts, [F.desc("n"), F.asc("value")]).select("value", "id", "n"), "labels")


def index_by(df: DataFrame, column: str, dictionary: DataFrame, out: str = "label", on_unseen: str = "skip") -> DataFrame:
    """``df`` with the number of each row's value; rows of unseen values are skipped, kept as the next number, or null.

    ``on_unseen`` is 'skip', 'keep' or 'null'. Both sides are plain tables, so that a frequent value is split between
    tasks unless the dictionary is small enough for Spark to broadcast it.
    """
    numbers = dictionary.select(F.col("value").alias("_value"), F.col("id").cast("double").alias(out))
    joined = df.join(numbers, F.col(column) == F.col("_value"), "inner" if on_unseen == "skip" else "left").drop("_value")
    if on_unseen != "keep":
        return joined
    size = dictionary.agg(F.count(F.lit(1)).cast("double").alias("n")).scalar()
    return joined.withColumn(out, F.coalesce(out, size))
