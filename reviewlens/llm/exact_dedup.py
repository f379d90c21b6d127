"""Exact deduplication: two passes over a Bloom filter, after which only possible copies shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.columns import free_names, lower_ascii, without
from reviewlens.session import stage

#: Filter bits for each row; two are set, so about 1.4 % of the unique rows shuffle needlessly.
BITS_PER_ROW = 16
#: Bound on the broadcast filter: 2 million words of 64 bits. Beyond it, the filter is fuller and more rows
#: shuffle; the result stays the same.
MAX_FILTER_BITS = 2**27
RESULT = ("keep_id", "group_size", "kept", "text_sha256")


def repeat_filter(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """First pass: the blocked filter (``block``, ``word``) of cells that at least two rows hit.

    Each key sets two bits of one 64-bit word. Cells are counted with map-side aggregation, so a key that a
    third of the rows share is one record per task.
    """
    block, first, second = _place(F.col(key), bits)
    cells = keys.select(F.explode(F.array(block * 64 + first, block * 64 + second)).alias("cell"))
    return (
        cells.groupBy("cell")
        .agg(F.count("*").alias("hits"))
        .filter("hits > 1")
        .groupBy(F.shiftright("cell", 6).alias("block"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(cell & 63 as int))")).alias("word"))
    )


def _place(key, bits: int):
    block = F.pmod(key, F.lit(bits // 64))
    first = F.shiftrightunsigned(key, 40).bitwiseAND(63).cast("int")
    second = F.pmod(first + 1 + F.pmod(F.shiftrightunsigned(key, 46), F.lit(63)), F.lit(64)).cast("int")
    return block, first, second


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """Columns of ``docs`` plus ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when they are identical after lower-casing A-Z; of equal texts the row with the largest id
    stays. The first pass counts hashes in the cells of a Bloom filter; the second tests every row against the
    cells hit twice. Rows that miss it are unique and pass straight through. The others shuffle, by digest,
    and are grouped exactly.

    Null text counts as empty, and empty texts are copies of one another. A null id is below all others; it
    stays only where all ids of a group are null. Rows that repeat an id with an equal text are one document:
    one of them is returned. Rows that repeat an id with another text are documents of their own. Columns of
    ``docs`` with the names of result columns are replaced. An empty table gives an empty result.
    """
    docs = without(docs, *RESULT)
    key, word, block, block_of, possible = free_names(docs, "key", "word", "block", "block_of", "possible")
    hashed = docs.withColumn(key, F.xxhash64(lower_ascii(F.col(text_col))))
    rows = docs.count()
    bits = 2**10
    while bits < min(rows * BITS_PER_ROW, max_filter_bits):
        bits *= 2
    bloom = stage(repeat_filter(hashed.select(F.col(key).alias("key")), "key", bits), "repeats")

    place, first, second = _place(F.col(key), bits)
    tested = (
        hashed.withColumn(block_of, place)
        .join(F.broadcast(bloom.select(F.col("block").alias(block), F.col("word").alias(word))), F.col(block_of) == F.col(block), "left")
        .withColumn(possible, F.coalesce((F.getbit(word, first) == 1) & (F.getbit(word, second) == 1), F.lit(False)))
        .drop(key, word, block, block_of)
        .withColumn("text_sha256", F.sha2(lower_ascii(F.col(text_col)), 256))
    )
    unique = tested.filter(~F.col(possible)).drop(possible).withColumns(
        {"keep_id": F.col(id_col), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)}
    )
    copies = stage(tested.filter(possible).drop(possible).dropDuplicates([id_col, "text_sha256"]), "possible")
    groups = stage(
        copies.groupBy("text_sha256").agg(F.max(id_col).alias("keep_id"), F.count("*").alias("group_size")), "groups"
    )
    # Both sides of the join are plain exchanges, so that a group with many rows is split between tasks.
    grouped = copies.join(groups, "text_sha256").withColumn("kept", F.col(id_col).eqNullSafe(F.col("keep_id")))
    columns = [*docs.columns, *RESULT]
    return unique.select(columns).unionByName(grouped.select(columns))
