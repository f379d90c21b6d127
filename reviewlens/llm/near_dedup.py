"""Near-duplicate classes from SetSketch registers, with every link confirmed on the full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.columns import free_names, without
from reviewlens.llm.components import connected_components
from reviewlens.session import stage

#: A register holds floor(1 - log_BASE(minimum of exponential variates of rate RATE)), cut to 16 bits.
BASE, RATE, TOP = 1.001, 20.0, 2**16 - 1
#: 20 bands of 4 registers miss a pair of similarity 0.85 with probability 4e-7.
BANDS, BAND_WIDTH = 20, 4
REGISTERS = BANDS * BAND_WIDTH
#: A pair is dropped unread only if its estimate lies this many standard errors below the threshold.
SLACK = 5.0
#: Members of a block in the exact comparison of buckets that still hold several components.
BLOCK = 256
RESULT = ("n_shingles", "component_id", "kept")

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xA0761D6478BD642F)
    return x ^ (x >> _U(32))


_SEEDS = _mix(np.arange(1, REGISTERS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; of the whole sequence where it has fewer words."""
    words = (text or "").encode().lower().split()  # on bytes, these know ASCII letters and white space only
    if not words:
        return np.empty(0, _U)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))
    width = min(size, len(words))
    shingles = np.full(len(words) - width + 1, width, _U)
    for i in range(width):
        shingles = _mix(shingles * _U(0x9E3779B97F4A7C15) + hashes[i : len(words) - width + 1 + i])
    return np.unique(shingles)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """Sketches of non-empty sets, one row each: exponentially spaced, truncated minima."""
    lengths = np.fromiter(map(len, sets), np.int64, len(sets))
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    everything = np.concatenate(sets)
    out = np.empty((len(sets), REGISTERS), np.uint16)
    for i, seed in enumerate(_SEEDS):
        lowest = np.minimum.reduceat(_mix(everything ^ seed), starts)
        exponential = -np.log1p(-(lowest.astype(np.float64) + 0.5) / 2.0**64) / RATE
        out[:, i] = np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP)
    return out


def _sketch_batches(size: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, first, words = [], 0, 0
            for i, text in enumerate(batch.column("text"), 1):
                sets.append(shingle_set(text.as_py(), size))
                words += len(sets[-1])
                if words > 300_000 or i == batch.num_rows:
                    yield _sketched(batch.slice(first, i - first).select(["id", "key"]), sets)
                    sets, first, words = [], i, 0

    return sketch


def _sketched(rows: pa.RecordBatch, sets: list[np.ndarray]) -> pa.RecordBatch:
    full = [i for i, s in enumerate(sets) if len(s)]
    sketches: list[bytes | None] = [None] * len(sets)
    for i, row in zip(full, registers([sets[i] for i in full]) if full else ()):
        sketches[i] = row.tobytes()
    return pa.RecordBatch.from_arrays(
        [
            *rows.columns,
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
            pa.array(sketches, pa.binary()),
        ],
        names=["id", "key", "n", "digest", "registers"],
    )


def estimate(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity, from the registers of two sets that are larger, smaller and equal.

    With relative sizes u + v = 1 and p(x) = -log_b(1 - x (b - 1) / b), a register of the left set is larger
    with probability p(u - v J) and smaller with p(v - u J). The likelihood is concave in J.
    """
    more, less = (left > right).sum(1), (left < right).sum(1)
    same = left.shape[1] - more - less
    u = n_left / (n_left + n_right)
    v = 1 - u

    def p(x):
        return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        a, b = p(u - v * j), p(v - u * j)
        return more * np.log(a) + less * np.log(b) + same * np.log(np.maximum(1 - a - b, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):
        third = (high - low) / 3
        rising = likelihood(low + third) < likelihood(high - third)
        low, high = np.where(rising, low + third, low), np.where(rising, high, high - third)
    return (low + high) / 2


def _likely(threshold: float):
    least = threshold - SLACK * np.sqrt(threshold * (1 - threshold) / REGISTERS)

    def filter_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                left, right = (np.frombuffer(b"".join(batch[c]), np.uint16).reshape(-1, REGISTERS) for c in ("ra", "rb"))
                similarity = estimate(left, right, batch["na"].to_numpy(float), batch["nb"].to_numpy(float))
                yield batch[["a", "b"]].assign(similarity=similarity)[similarity >= least]

    return filter_pairs


def _confirmed(size: int, percent: int):
    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known, x, keep = None, None, []
            for a, b, ta, tb in zip(batch["a"], batch["b"], batch["ta"], batch["tb"]):
                if known != (a, ta):  # pairs of one pivot follow one another
                    known, x = (a, ta), shingle_set(ta, size)
                y = shingle_set(tb, size)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.loc[keep, ["a", "b"]]

    return confirm


def _block_links(size: int, percent: int):
    """Links between the components that meet in one pair of blocks, at most one fewer than there are."""

    def links(block: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int]] = []
        block = block.drop_duplicates(["id", "text"])
        component = block["component"].to_numpy()
        if len(np.unique(component)) > 1:
            sets = [shingle_set(t, size) for t in block["text"]]
            common = _common(sets)
            n = np.fromiter(map(len, sets), np.int64, len(sets))
            linked = 100 * common >= percent * (n[:, None] + n[None, :] - common)
            linked &= component[:, None] != component[None, :]
            parent = {c: c for c in component}

            def root(c):
                while parent[c] != c:
                    c = parent[c]
                return c

            for i, j in zip(*np.nonzero(np.triu(linked))):
                a, b = root(component[i]), root(component[j])
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    found.append((component[i], component[j]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return links


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, from products of incidence matrices of bounded width."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner = owner[shared]
    _, column = np.unique(column[shared], return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.int64)
    width = 4096
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        low, high = np.searchsorted(column, (first, first + width))
        matrix = np.zeros((len(sets), width), np.float32)
        matrix[owner[low:high], column[low:high] - first] = 1
        common += np.rint(matrix @ matrix.T).astype(np.int64)
    np.fill_diagonal(common, [len(s) for s in sets])
    return common


def near_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """The id, ``n_shingles``, ``component_id`` and ``kept`` of every row of ``docs``; no text is carried.

    Two documents are linked when the Jaccard similarity of their sets of ``shingle``-word shingles (A-Z
    lower-cased) is at least ``percent``/100. ``component_id`` is the smallest id that can be reached over
    links; that document is kept.

    1. Each text becomes a SetSketch. Equal sets are grouped, so that any number of copies is one node.
    2. Bands of registers are hashed into buckets. In every bucket the member with the smallest hash is the
       pivot, and each other member is a pair with it: a bucket gives fewer pairs than it has members.
    3. Similarities are estimated by likelihood; each node's likeliest pivot is confirmed on the full sets.
    4. Buckets that still hold several components after that are compared exactly, in pairs of blocks of
       bounded size spread over all tasks. This finds the links that no pivot showed.

    Ids are integers. Documents without words, and null texts, have empty sets and are linked with nothing.
    Texts shorter than a shingle are one shingle. Rows that repeat an id are judged each by its own text. A row
    without id is found through its equal copies and otherwise has a null ``component_id`` and is kept. An
    empty table gives an empty result.
    """
    classes = _classes(docs, id_col, text_col, shingle, percent)
    return classes.drop("key").withColumnRenamed("id", id_col)


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """``docs`` with the columns that ``near_classes`` finds; columns of the same names are replaced."""
    docs = without(docs, *RESULT)
    key, found_id, found_key = free_names(docs, "key", "found_id", "found_key")
    found = _classes(docs, id_col, text_col, shingle, percent).distinct()
    found = found.withColumnsRenamed({"id": found_id, "key": found_key})
    docs = docs.withColumn(key, _text_key(text_col))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(found_id)) & (F.col(key) == F.col(found_key))
    return docs.join(found, same).drop(key, found_id, found_key)


def _text_key(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _classes(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    texts = docs.select(F.col(id_col).cast("long").alias("id"), _text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    sketches = stage(
        texts.mapInArrow(_sketch_batches(shingle), "id long, key long, n long, digest binary, registers binary"), "sketches"
    )
    nodes = stage(
        sketches.filter("digest is not null")
        .groupBy("digest")
        .agg(F.min("id").alias("node"), F.first("n").alias("n"), F.first("registers").alias("registers")),
        "nodes",
    )
    components = _components(texts.select("id", "text"), nodes.filter("node is not null"), shingle, percent)
    labels = stage(
        nodes.join(components, "node", "left").select("digest", F.coalesce("component", "node").alias("component")), "labels"
    )
    return sketches.join(labels, "digest", "left").select(
        "id", "key", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    ).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def _components(texts: DataFrame, nodes: DataFrame, shingle: int, percent: int) -> DataFrame:
    bands = nodes.select(
        F.col("node").alias("id"),
        F.explode(
            F.array([F.xxhash64(F.lit(i), F.substring("registers", 1 + 2 * BAND_WIDTH * i, 2 * BAND_WIDTH)) for i in range(BANDS)])
        ).alias("bucket"),
    )
    # xxhash64 of one long is a bijection: it orders the nodes at random and has no ties.
    buckets = stage(
        bands.groupBy("bucket").agg(F.count("*").alias("members"), F.min_by("id", F.xxhash64("id")).alias("pivot")).filter("members > 1"),
        "buckets",
    )
    members = stage(bands.join(buckets, "bucket"), "members")
    sketch = nodes.select("node", "n", "registers")
    pairs = (
        members.filter("id != pivot")
        .select(F.col("pivot").alias("a"), F.col("id").alias("b"))
        .distinct()
        .join(sketch.toDF("a", "na", "ra"), "a")
        .join(sketch.toDF("b", "nb", "rb"), "b")
        .mapInPandas(_likely(percent / 100), "a long, b long, similarity double")
    )
    likely = stage(pairs.groupBy("b").agg(F.max_by("a", F.struct("similarity", "a")).alias("a")).filter("a != b"), "likely")
    needed = members.select("id").distinct()
    whole = stage(texts.join(needed, "id", "left_semi"), "member-texts")
    links = (
        likely.join(whole.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
        .join(whole.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
        .mapInPandas(_confirmed(shingle, percent), "a long, b long")
    )
    first = stage(connected_components(links).withColumnRenamed("component", "first"), "components")

    placed = stage(
        members.join(first, members["id"] == first["node"], "left").select(
            "bucket", "id", "members", F.coalesce("first", "id").alias("component")
        ),
        "placed",
    )
    open_buckets = stage(
        placed.groupBy("bucket")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.count("*").alias("members"),
            F.expr("bit_xor(xxhash64(id))").alias("x"),
            F.expr("bit_xor(xxhash64(id, 1))").alias("y"),
        )
        .filter("low != high")
        .groupBy("members", "x", "y")  # the same members in several bands are compared once
        .agg(F.min("bucket").alias("bucket"), F.expr(f"cast(ceil(members / {BLOCK}.0) as int)").alias("blocks")),
        "open-buckets",
    )
    parts = (
        placed.drop("members")
        .join(open_buckets.select("bucket", "blocks"), "bucket")
        .withColumn("own", F.pmod(F.xxhash64("id", F.lit(2)), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select("bucket", "id", "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )
    more = (
        parts.join(whole, "id")
        .groupBy("bucket", "i", "j")
        .applyInPandas(_block_links(shingle, percent), "a long, b long")
    )
    second = stage(connected_components(more), "components")
    # A component's members: what the first step joined, under the name that the second step gives it.
    everyone = first.select("node", F.col("first").alias("own")).unionByName(
        second.join(first, "node", "left_anti").select("node", F.col("node").alias("own"))
    )
    return everyone.join(second.toDF("own", "second"), "own", "left").select(
        "node", F.coalesce("second", "own").alias("component")
    )
