"""Near-duplicate lines: a segment-partition edit join whose pairs are verified bit-parallel within a band."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.columns import free_names
from reviewlens.llm.components import connected_components
from reviewlens.session import stage

#: Edits between linked lines at most. Where the shorter line has fewer than ``LONG`` characters, one edit links, and
#: below ``SHORT`` none does, as a segment would be empty.
DISTANCE, LONG, SHORT = 2, 32, 3
#: Members of a block; a bucket with more is compared in pairs of blocks.
BLOCK = 256
_TRIM = " \t\r\x0b\x0c"


def placements(distance: int) -> list[tuple[int, int, int]]:
    """(shorter by, segment, shift) of every substring that a line looks up, its own segments first.

    A line looks for the segments of lines as long as itself or up to ``distance`` shorter. If at most
    ``distance`` edits turn one line into another, a segment is untouched, with few edits on either side of
    it: segment i can only be shifted by as many places as edits can stand before it, and after it.
    """
    own = [(0, i, 0) for i in range(distance + 1)]
    found = [
        (short, i, shift)
        for short in range(distance + 1)
        for i in range(distance + 1)
        for shift in range(max(-i, short - (distance - i)), min(i, short + distance - i) + 1)
    ]
    return own + [p for p in found if p not in own]


def segment_keys(lines: DataFrame, distance: int) -> DataFrame:
    """``line_id``, ``bucket`` and ``own`` for each placement in each line.

    A bucket is a hash of segment number, length of the line that has it, and content; ``own`` is 1 for the
    line's segments. Lengths are columns of their own, so that no line is measured again for each placement.
    """
    parts = distance + 1
    measured = lines.select("line_id", "line", F.length("line").alias("chars"))
    sizes = []
    for short in range(parts):
        length = F.col("chars") - short
        sizes += [F.floor(length / parts).cast("int").alias(f"size{short}"), (parts - length % parts).alias(f"longer{short}")]
    measured = measured.select("*", *sizes)
    structs = []
    for short, i, shift in placements(distance):
        base, longer = F.col(f"size{short}"), F.col(f"longer{short}")  # segments from ``longer`` on have one character more
        start = base * i + F.greatest(i - longer, F.lit(0)) + (shift + 1)
        content = F.substring(F.col("line"), start, base + F.when(longer <= i, 1).otherwise(0))
        bucket = F.xxhash64(F.lit(i), F.col("chars") - short, content)
        structs.append(F.struct(bucket.alias("bucket"), F.lit(int((short, shift) == (0, 0))).cast("byte").alias("own")))
    return measured.select("line_id", F.inline(F.array(structs)))


def within(first: str, second: str, distance: int) -> bool:
    """Whether the edit distance is at most ``distance``, with one band of 2 * distance + 1 bits per character.

    Bit b of column j stands for row j - distance + b. The vertical differences of a column are two bit
    vectors; the window moves down by one row with every column. The distance is read along the diagonal that
    ends in the last cell, where values never fall.
    """
    if abs(len(first) - len(second)) > distance:
        return False
    places: dict[str, int] = {}
    for row, char in enumerate(first):
        places[char] = places.get(char, 0) | 1 << row
    full = (1 << (2 * distance + 1)) - 1
    plus, minus = full & ~((1 << (distance + 1)) - 1), 0
    end = 1 << (len(first) - len(second) + distance)
    score = max(0, len(first) - len(second))
    for column, char in enumerate(second):
        match = places.get(char, 0)
        match = (match >> (column - distance) if column > distance else match << (distance - column)) & full
        plus, minus = plus >> 1 | 1 << (2 * distance), minus >> 1
        level = ((((match & plus) + plus) ^ plus) | match | minus) & full  # no rise along the diagonal
        if not level & end:
            score += 1
            if score > distance:
                return False
        right_up, right_down = minus | (full & ~(level | plus)), level & plus
        right_up = (right_up << 1 | 1) & full
        plus, minus = (right_down << 1 | ~(level | right_up)) & full, right_up & level
    return True


def _links(ids: list[int], lines: list[str], distance: int) -> Iterator[tuple[int, int]]:
    """Links of a block that join its lines into classes, at most one fewer than there are lines."""
    if len(set(ids)) < 2:
        return
    chars = np.zeros((len(lines), 64), np.int16)
    for row, line in zip(chars, lines):
        row += np.bincount(np.frombuffer(line.encode("utf-32-le"), np.uint32) & 63, minlength=64).astype(np.int16)
    parent = list(range(len(ids)))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(1, len(ids)):
        # An edit changes two counts of characters by one at most, and so does not more than 2 * distance.
        near = np.flatnonzero(np.abs(chars[:i] - chars[i]).sum(1) <= 2 * distance)
        for j in near:
            a, b = root(i), root(int(j))
            if a != b and within(lines[i], lines[j], distance):
                parent[a] = b
                if ids[i] != ids[j]:
                    yield ids[i], ids[j]


def _block_links(distance: int):
    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Batches are sorted by block; the last block of a batch may go on in the next."""
        rest: pd.DataFrame | None = None
        for batch in batches:
            whole = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if len(whole):
                block = whole[["bucket", "i", "j"]].to_numpy()
                edges = [0, *(np.flatnonzero((block[1:] != block[:-1]).any(1)) + 1)]
                yield compare(whole, edges)
                rest = whole.iloc[edges[-1] :]
        if rest is not None:
            yield compare(rest, [0, len(rest)])

    def compare(whole: pd.DataFrame, edges: list[int]) -> pd.DataFrame:
        ids, lines = whole["line_id"].tolist(), whole["line"].tolist()
        found = [link for low, high in zip(edges, edges[1:]) for link in _links(ids[low:high], lines[low:high], distance)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return links


def line_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE, long_chars: int = LONG
) -> DataFrame:
    """One row per distinct line: ``line``, ``doc_id``, ``copies``, ``line_class``, ``class_doc_id``, ``kept``.

    Texts are split at line feeds and lines trimmed; blank lines are left out. ``copies`` counts a line's
    occurrences and ``doc_id`` is the smallest id of a document with it. Lines are linked when few
    edits of single characters turn one into the other: at most ``distance`` where the shorter one has ``long_chars``
    characters or more, else one; lines of one or two characters are only equal or different. Lines that can be reached over links share ``line_class``, a number of this
    run, and ``class_doc_id``, the smallest id of their documents. One line of each class is kept: the one with
    the smallest ``doc_id``, then the first by code point.

    1. Equal lines become one row. 2. Each line gives the hashes of its ``distance + 1`` segments and of the
    substrings at which a segment of another line can stand. 3. A hash that is a segment of one line and
    occurs in another is a bucket. 4. Buckets are compared in blocks of bounded size, spread over all tasks;
    a block gives fewer links than it has lines. Copies never meet, and the same members are compared once.

    Null texts have no lines; null ids count only where a line has no other. Repeated rows add to ``copies``.
    Other columns are left out. An empty table gives an empty result.
    """
    occurrences = docs.select(F.col(id_col).alias("doc_id"), F.explode(F.split(F.col(text_col), "\n")).alias("raw"))
    lines = (
        occurrences.select("doc_id", F.trim("raw", F.lit(_TRIM)).alias("line"))
        .filter("line != ''")
        .groupBy("line")
        .agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    )
    lines = stage(lines.withColumn("line_id", F.monotonically_increasing_id()), "lines")
    named, chars = lines.select("line_id", "line"), F.length("line")
    # A line of ``long_chars`` meets those one character shorter among the short ones. Their smaller join comes first, so
    # that its shuffles are gone when the larger one runs.
    links = stage(_line_links(named.filter(chars.between(SHORT, long_chars)), 1), "short-links")
    links = links.unionByName(_line_links(named.filter(chars >= long_chars), distance))
    components = stage(connected_components(links), "line-classes")
    placed = stage(
        lines.join(components, lines["line_id"] == components["node"], "left").select(
            "line", "doc_id", "copies", F.coalesce("component", "line_id").alias("line_class"), F.col("component").isNotNull().alias("linked")
        ),
        "placed",
    )
    alone = placed.filter("not linked").withColumn("class_doc_id", F.col("doc_id")).withColumn("kept", F.lit(True))
    linked = placed.filter("linked")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col("line").cast("binary").alias("bytes")))
    heads = stage(linked.groupBy("line_class").agg(first.alias("first")), "heads")
    grouped = (
        linked.join(heads, "line_class")
        .withColumn("class_doc_id", F.col("first.doc_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("line").cast("binary") == F.col("first.bytes")))
    )
    columns = ["line", "doc_id", "copies", "line_class", "class_doc_id", "kept"]
    return alone.select(columns).unionByName(grouped.select(columns))


def _line_links(lines: DataFrame, distance: int) -> DataFrame:
    keys = stage(segment_keys(lines, distance), "keys")
    buckets = stage(
        keys.groupBy("bucket")
        .agg(F.min("line_id").alias("low"), F.max("line_id").alias("high"), F.max("own").alias("own"))
        .filter("low != high and own = 1")
        .select("bucket"),
        "buckets",
    )
    members = stage(keys.join(buckets, "bucket").select("bucket", "line_id").distinct(), "members")
    compared = (
        members.groupBy("bucket")
        .agg(F.count("*").alias("members"), F.expr("bit_xor(xxhash64(line_id))").alias("x"), F.expr("bit_xor(xxhash64(line_id, 1))").alias("y"))
        .groupBy("members", "x", "y")
        .agg(F.min("bucket").alias("bucket"), F.expr(f"cast(ceil(members / {BLOCK}.0) as int)").alias("blocks"))
    )
    compared = stage(compared.select("bucket", "blocks"), "compared")
    parts = (
        members.join(compared, "bucket")
        .withColumn("mine", F.pmod(F.xxhash64("line_id", F.lit(2)), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select("bucket", "line_id", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    )
    block = ["bucket", "i", "j"]
    return (
        parts.join(lines, "line_id")
        .repartition(*block)
        .sortWithinPartitions(*block)
        .mapInPandas(_block_links(distance), "a long, b long")
    )


def line_dedup(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with only those lines that ``classes`` (of ``line_classes``) keeps, at their first document.

    Every line of a class but the kept one goes, and of the kept line all but the occurrence in the document
    with the smallest id. Blank lines go too. Documents without lines left have empty text. Rows that repeat an
    id with an equal text are one document; with another text, each may keep the line.
    """
    own_id, own_text, new_text = free_names(docs, "own_id", "own_text", "new_text")
    text_key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    numbered = docs.select(F.col(id_col).alias("id"), text_key.alias("key"), F.posexplode(F.split(F.col(text_col), "\n")).alias("number", "raw"))
    kept = stage(classes.filter("kept").select(F.col("line").alias("kept_line"), F.col("doc_id").alias("kept_id")), "kept-lines")
    lines = numbered.withColumn("line", F.trim("raw", F.lit(_TRIM)))
    left = lines.join(kept, (F.col("line") == F.col("kept_line")) & F.col("id").eqNullSafe(F.col("kept_id")), "left_semi")
    first = left.groupBy("id", "key", "line").agg(F.min("number").alias("number"))
    ordered = F.sort_array(F.collect_list(F.struct("number", "line")))["line"]
    texts = first.groupBy(F.col("id").alias(own_id), F.col("key").alias(own_text)).agg(F.array_join(ordered, "\n").alias(new_text))
    same = F.col(id_col).eqNullSafe(F.col(own_id)) & (text_key == F.col(own_text))
    joined = docs.join(texts, same, "left").withColumn(text_col, F.coalesce(new_text, F.lit("")))
    return joined.drop(own_id, own_text, new_text)
