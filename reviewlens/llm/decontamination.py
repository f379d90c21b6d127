"""Benchmark decontamination: passages of test items in training documents, found by winnowing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.session import stage

#: Words of a window, the shortest shared span that is always found, and words of a k-gram at most.
WINDOW, GRAM = 10, 5
#: Filter bits for each fingerprint, of which four are set in one 64-bit word.
BITS_PER_PRINT, SET_BITS = 16, 4
#: Bound on the broadcast filter, 2 million words of 64 bits. The fingerprints of a larger benchmark are dealt to
#: several filters of this size, and the documents are read once for each.
MAX_FILTER_BITS = 2**27
MEMORY = 1_000_000  # word hashes that a worker keeps

#: A-Z in lower case, a-z and digits as they are, all else below 128 a space; bytes of longer characters stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_MULTIPLIER, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def words_of(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text, A-Z lower-cased; none for null."""
    return text.translate(_FOLD).split() if text else []


class _Hashes(dict):
    """Hash of every word seen, up to a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh64_intdigest(word)
        if len(self) < MEMORY:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words, in order."""
    count = len(hashes) - size + 1
    total = np.zeros(count, np.uint64)
    for j in range(size):
        total = total * _MULTIPLIER + hashes[j : j + count]
    total ^= total >> np.uint64(32)
    total *= _MIX
    return total ^ (total >> np.uint64(29))


def window_prints(hashes: np.ndarray, window: int, gram: int = GRAM) -> np.ndarray:
    """The fingerprint of every window of ``window`` words: the smallest hash of its k-grams.

    Neighbouring windows mostly share their smallest k-gram, so a text has few distinct fingerprints, and equal
    windows have equal ones wherever they stand.
    """
    if len(hashes) < window:
        return np.empty(0, np.uint64)
    grams = gram_hashes(hashes, min(gram, window))
    count = len(hashes) - window + 1
    lowest = grams[:count].copy()
    for j in range(1, len(grams) - count + 1):
        np.minimum(lowest, grams[j : j + count], out=lowest)
    return lowest


def _placed(prints: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The filter word of a fingerprint, and its mask. ``_filter`` computes the same in Spark."""
    mask = np.zeros(len(prints), np.uint64)
    for i in range(SET_BITS):
        mask |= np.uint64(1) << ((prints >> np.uint64(40 + 6 * i)) & np.uint64(63))
    return (prints & np.uint64(words - 1)).astype(np.int64), mask


def _filter(prints: DataFrame, words: int) -> np.ndarray:
    """Blocked Bloom filter of a column ``print``, put together in Spark; its size is bounded."""
    mask = F.lit(0).cast("long")
    for i in range(SET_BITS):
        bit = F.shiftrightunsigned("print", 40 + 6 * i).bitwiseAND(63).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    cells = prints.groupBy(F.col("print").bitwiseAND(words - 1).alias("word")).agg(F.bit_or(mask).alias("mask")).toArrow()
    out = np.zeros(words, np.uint64)
    out[cells["word"].to_numpy()] = cells["mask"].to_numpy().view(np.uint64)
    return out


def _item_windows(item_col: str, text_col: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def windows(batches):
        hashes = _Hashes()
        for batch in batches:
            items, sizes, prints, texts = [], [], [np.empty(0, np.uint64)], []
            for item, text in zip(batch[item_col], batch[text_col].cast(pa.binary())):
                words = words_of(text.as_py())
                size = min(WINDOW, len(words))
                if size:
                    found = window_prints(hashes.of(words), size)
                    prints.append(found)
                    items += [item.as_py()] * len(found)
                    sizes += [size] * len(found)
                    texts += [b" ".join(words[s : s + size]) for s in range(len(found))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(items, pa.string()),
                    pa.array(sizes, pa.int32()),
                    pa.array(np.concatenate(prints).view(np.int64)),
                    pa.array(texts, pa.binary()),
                ],
                ["item", "size", "print", "window"],
            )

    return windows


def _candidates(id_col: str, text_col: str, sizes: list[int], bloom):
    """Per document its key, number of words, and the windows whose fingerprint may be one of an item."""

    def candidates(batches):
        import hashlib

        hashes, words_set = _Hashes(), bloom.value
        for batch in batches:
            keys, counts, upto, starts, lengths, texts = [], [], [0], [], [], []
            for text in batch[text_col].cast(pa.binary()):
                text = text.as_py() or b""
                words = words_of(text)
                numbers = hashes.of(words)
                for size in sizes:
                    prints = window_prints(numbers, size)
                    if not len(prints):
                        continue
                    # The winnowed fingerprints: one for each run of windows that share their smallest k-gram.
                    first = np.flatnonzero(np.concatenate(([True], prints[1:] != prints[:-1])))
                    place, mask = _placed(prints[first], len(words_set))
                    hit = (words_set[place] & mask) == mask
                    if hit.any():
                        runs = np.diff(np.append(first, len(prints)))
                        places = np.flatnonzero(np.repeat(hit, runs)).tolist()
                        starts += places
                        lengths += [size] * len(places)
                        texts += [b" ".join(words[s : s + size]) for s in places]
                keys.append(hashlib.md5(text).digest())
                counts.append(len(words))
                upto.append(len(starts))
            windows = pa.StructArray.from_arrays(
                [pa.array(starts, pa.int32()), pa.array(lengths, pa.int32()), pa.array(texts, pa.binary())],
                ["start", "size", "window"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch[id_col],
                    pa.array(keys, pa.binary()),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(upto, pa.int32()), windows),
                ],
                [id_col, "text_key", "n_words", "windows"],
            )

    return candidates


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    max_filter_bits: int = MAX_FILTER_BITS,
) -> DataFrame:
    """``(id, n_words, n_hit, spans, item_ids)`` for every row of ``docs``.

    ``spans`` are the runs of words, as ``start`` and ``end``, that stand in occurrences of item windows, in order
    and without overlaps; ``n_hit`` is their number of words; ``item_ids`` are the items with such windows, as
    strings, sorted. A window is ten consecutive words of an item; an item of fewer words is one window.

    The fingerprint of a window is the smallest hash of its five-word grams, and a text keeps one for each run of
    windows that share it: two texts with a window in common have a fingerprint in common, whatever surrounds it.
    A Bloom filter of the items' fingerprints, of bounded size, is broadcast; windows of documents that pass are
    joined with the items' windows word by word, so that no hash decides.

    A null text has no words, like an empty one. A null item id is no item: the words of its text are hit, but it
    is not in ``item_ids``. Rows that repeat an id are judged each by their own text; items that repeat an id are one
    item with the windows of all its texts. Other columns are not read. An empty benchmark hits nothing; an empty
    table gives an empty result.
    """
    read = items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text"))
    windows = stage(
        read.mapInArrow(_item_windows("item", "text"), "item string, size int, print long, window binary").distinct(), "item-windows"
    )
    count, sizes = windows.agg(F.approx_count_distinct("print", 0.02), F.collect_set("size")).first()
    passes = max(1, -(-count * BITS_PER_PRINT // max_filter_bits))
    words = 2**10
    while words * 64 < min(count * BITS_PER_PRINT, max_filter_bits):
        words *= 2

    context = docs.sparkSession.sparkContext
    schema = docs.select(id_col).schema.simpleString()[7:-1]
    out = f"{schema}, text_key binary, n_words long, windows array<struct<start: int, size: int, window: binary>>"
    found = []
    for number in range(passes):
        prints = windows.filter(F.pmod(F.shiftright("print", 32), F.lit(passes)) == number)
        bloom = context.broadcast(_filter(prints, words))
        judge = _candidates(id_col, text_col, sorted(sizes), bloom)
        found.append(stage(docs.select(id_col, text_col).mapInArrow(judge, out), "candidates"))

    places = found[0].select("text_key", F.explode("windows").alias("w"))
    for more in found[1:]:
        places = places.unionByName(more.select("text_key", F.explode("windows").alias("w")))
    sets = _item_sets(windows)
    hits = stage(
        places.select("text_key", "w.*").join(sets.select("window", "set"), "window").select("text_key", "start", "size", "set").distinct(),
        "hits",
    )
    judged = stage(_spans(hits).join(_items_of(hits, sets, windows), "text_key"), "judged")
    # Both sides are plain exchanges of written tables, so that many copies of one text are split between tasks.
    return found[0].select(id_col, "text_key", "n_words").join(judged, "text_key", "left").select(
        id_col,
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<start: int, end: int>>")).alias("spans"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def _item_sets(windows: DataFrame) -> DataFrame:
    """``(window, set)``: windows that stand in the same items share a set, named by one of them.

    Sets are compared by their size and two combined hashes, so that a window of very many items is never
    gathered in one row.
    """
    signed = windows.groupBy("window").agg(
        F.struct(
            F.count("item").alias("n"),
            F.bit_xor(F.when(F.col("item").isNotNull(), F.xxhash64("item"))).alias("a"),
            F.bit_xor(F.when(F.col("item").isNotNull(), F.xxhash64(F.lit(1), "item"))).alias("b"),
        ).alias("signature")
    )
    signed = stage(signed, "signatures")
    names = signed.groupBy("signature").agg(F.min("window").alias("set"))
    joined = signed.alias("s").join(names.alias("n"), F.expr("s.signature <=> n.signature"))
    return stage(joined.select("s.window", "n.set"), "item-sets")


def _spans(hits: DataFrame) -> DataFrame:
    """``(text_key, n_hit, spans)``: the union of the windows hit. A group is the hits of one text."""
    from pyspark.sql import Window as W

    order = W.partitionBy("text_key").orderBy("start", "end")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    runs = (
        hits.select("text_key", "start", (F.col("start") + F.col("size")).alias("end")).distinct()
        .withColumn("apart", F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True)))
        .withColumn("run", F.sum(F.col("apart").cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy("text_key", "run")
        .agg(F.struct(F.min("start").alias("start"), F.max("end").alias("end")).alias("span"))
    )
    return runs.groupBy("text_key").agg(
        F.sum(F.col("span.end") - F.col("span.start")).alias("n_hit"), F.array_sort(F.collect_list("span")).alias("spans")
    )


def _items_of(hits: DataFrame, sets: DataFrame, windows: DataFrame) -> DataFrame:
    """``(text_key, item_ids)``. Texts that hit the same sets of items have the list made once."""
    combined = stage(hits.groupBy("text_key").agg(F.array_sort(F.collect_set("set")).alias("sets")), "combined")
    named = windows.join(sets.filter("window = set"), "window").select("set", "item").distinct()
    lists = (
        combined.select("sets").distinct().withColumn("set", F.explode("sets")).join(named, "set")
        .groupBy("sets")
        .agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    )
    return combined.join(lists, "sets").select("text_key", "item_ids")
