"""Prefix trie of conversations: equal ones are collapsed to weighted sequences, whose prefixes are aggregated.

Texts are hashed once. From there on a turn is a position, a digest and a size, and a prefix is named by its length
and the combined hashes of its (position, digest) pairs, so that prefixes come from running combinations and the
parent of a prefix from taking its last turn out again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewlens.session import stage

BLOCK = 1024  # turns of a conversation that are combined within one group
KEY = ("depth", "k1", "k2")


def _before(order: W) -> W:
    return order.rowsBetween(W.unboundedPreceding, -1)


def ordered_turns(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``(conv_id, position, digest, size)``: turns numbered from 1 per conversation, null turns first.

    Null roles and texts are empty; ``digest`` is the SHA-256 of both and ``size`` the text's UTF-8 bytes. Turns of
    equal number go by digest. Rows without a conversation id belong to none and are left out. Rows are first
    dealt to ranges of (id, turn), so that one conversation with a large share of all rows spreads over tasks.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.unhex(F.sha2(named, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )
    slices = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = turns.repartitionByRange(slices, "conv_id", "turn", "digest").withColumn("slice", F.spark_partition_id())
    ranged = stage(ranged, "turns")
    starts = ranged.groupBy("conv_id", "slice").agg(F.count("*").alias("n")).select(
        "conv_id", "slice", F.coalesce(F.sum("n").over(_before(W.partitionBy("conv_id").orderBy("slice"))), F.lit(0)).alias("start")
    )
    place = F.row_number().over(W.partitionBy("conv_id", "slice").orderBy("turn", "digest"))
    numbered = ranged.withColumn("place", place).join(starts, ["conv_id", "slice"])
    return stage(numbered.select("conv_id", (F.col("start") + F.col("place")).alias("position"), "digest", "size"), "ordered")


def shared_head(conv_id: Column, most: int = 9) -> Column:
    """How many turns a conversation takes from the first of its group: a hash of its id below ``most``."""
    return F.crc32(conv_id.cast("string").cast("binary")) % most


def rebuilt_conversations(turns: DataFrame, group: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Every conversation with its head taken from its group's first, as turns, and the ids of all conversations.

    The group of id c is led by c - c % ``group``. With h = ``shared_head``, a conversation is the first h turns of
    its leader (all if it has fewer, none if there is no leader) and its own turns after the first h. It may have no
    turn left; its id is in the second table all the same.
    """
    counts = stage(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "counts")
    members = counts.select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("leader"), shared_head(F.col("conv_id"), most).alias("h"))
    leaders = counts.select(F.col("conv_id").alias("leader"), F.col("n").alias("led"))
    members = stage(
        members.join(leaders, "leader", "left").withColumn("head", F.least("h", F.coalesce("led", F.lit(0).cast("long")))), "members"
    )
    heads = (
        turns.filter(F.col("position") < most).withColumnRenamed("conv_id", "leader")
        .join(members.select("conv_id", "leader", "h"), "leader").filter("position <= h")
        .select("conv_id", "position", "digest", "size")
    )
    tails = (
        turns.join(members.select("conv_id", "h", "head"), "conv_id").filter("position > h")
        .select("conv_id", (F.col("position") - F.col("h") + F.col("head")).alias("position"), "digest", "size")
    )
    return stage(heads.unionByName(tails), "rebuilt"), members.select("conv_id")


def _running(turns: DataFrame, combine, names: Sequence[str]) -> DataFrame:
    """Adds to each name the combination of it over all earlier positions of the conversation, as ``name_before``.

    Blocks of positions are combined first, then the blocks before each, then the positions within: no group is
    larger than a block, or than the number of blocks.
    """
    blocked = turns.withColumn("block", F.floor((F.col("position") - 1) / BLOCK))
    totals = blocked.groupBy("conv_id", "block").agg(*(combine(n).alias(n) for n in names))
    order = _before(W.partitionBy("conv_id").orderBy("block"))
    totals = totals.select("conv_id", "block", *(combine(n).over(order).alias(f"{n}_blocks") for n in names))
    inside = _before(W.partitionBy("conv_id", "block").orderBy("position"))
    out = blocked.withColumns({f"{n}_inside": combine(n).over(inside) for n in names}).join(totals, ["conv_id", "block"])
    zero = F.lit(0).cast("long")
    for n in names:
        both = F.array(F.coalesce(f"{n}_blocks", zero), F.coalesce(f"{n}_inside", zero))
        joined = both[0].bitwiseXOR(both[1]) if combine is F.bit_xor else both[0] + both[1]
        out = out.withColumn(f"{n}_before", joined)
    return out.drop("block", *(f"{n}_{part}" for n in names for part in ("blocks", "inside")))


def prefix_trie(turns: DataFrame, ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The nodes of the trie of all conversations, and where each conversation ends.

    ``turns`` are ``(conv_id, position, digest, size)``, positions from 1 without gaps; ``ids`` names all conversations,
    also those without turns. Nodes are ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved)`` with
    the key ``(depth, k1, k2)``: a node is a sequence of the first ``depth`` turns, ``conv_id`` the smallest
    conversation that starts with it, ``saved`` the sum over its subtree of ``(n_convs - 1) * size`` of the last
    turns: what storing the trie saves. Ends are ``(conv_id, depth, k1, k2)``, a row for each conversation.

    1. A conversation's name is the combination of its hashed turns; equal ones become one sequence with a weight,
       the smallest id and its list of ends (the rows of ``ends`` with its key).
    2. Only one conversation of each sequence is expanded into prefixes. Sequences that are proper prefixes of
       another drop out by an anti-join; those that stay are the leaves.
    3. Weighted prefixes are aggregated to nodes. Each node's value is charged to its smallest conversation, summed
       from the end of that conversation, and added up over all conversations of a node: its subtree.

    Repeated ids count once. An empty ``ids`` gives no nodes; conversations without turns give the root alone.
    """
    ids = (turns if ids is None else ids).select("conv_id").distinct()
    hashed = turns.select(
        "conv_id", "position", "size", F.xxhash64("position", "digest").alias("k1"), F.xxhash64("digest", "position").alias("k2")
    )
    named = hashed.groupBy("conv_id").agg(F.count("*").alias("depth"), F.bit_xor("k1").alias("k1"), F.bit_xor("k2").alias("k2"))
    zero = F.lit(0).cast("long")
    ends = stage(ids.join(named, "conv_id", "left").select("conv_id", *(F.coalesce(c, zero).alias(c) for c in KEY)), "ends")
    sequences = stage(ends.groupBy(*KEY).agg(F.count("*").alias("weight"), F.min("conv_id").alias("conv_id")), "sequences")

    expanded = hashed.join(sequences.select("conv_id", "weight"), "conv_id")
    run = _running(expanded, F.bit_xor, ("k1", "k2"))
    prefixes = stage(
        run.select(
            "conv_id",
            F.col("position").alias("depth"),
            F.col("k1_before").bitwiseXOR(F.col("k1")).alias("k1"),
            F.col("k2_before").bitwiseXOR(F.col("k2")).alias("k2"),
            F.col("k1_before").alias("p1"),
            F.col("k2_before").alias("p2"),
            "size",
            "weight",
        ),
        "prefixes",
    )
    proper = prefixes.select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).distinct()
    leaves = stage(sequences.join(proper, list(KEY), "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf")), "leaves")

    inner = (
        prefixes.join(leaves, "conv_id", "left")
        .groupBy(*KEY)
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.sum("weight").alias("n_convs"),
            F.coalesce(F.sum("leaf"), zero).alias("n_leaves"),
            F.min("size").alias("size"),
            F.min("p1").alias("p1"),
            F.min("p2").alias("p2"),
        )
    )
    top = sequences.join(leaves, "conv_id", "left").agg(
        F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.coalesce(F.sum("leaf"), zero).alias("n_leaves")
    )
    none = F.lit(None).cast("long")
    root = top.filter("conv_id IS NOT NULL").select(
        *(zero.alias(c) for c in KEY), "conv_id", "n_convs", "n_leaves", zero.alias("size"), none.alias("p1"), none.alias("p2")
    )
    nodes = stage(inner.unionByName(root), "nodes")

    value = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("size")).alias("value"))
    owned = prefixes.join(value, ["conv_id", "depth"], "left").select(
        "conv_id", F.col("depth").alias("position"), "k1", "k2", F.coalesce("value", zero).alias("value")
    )
    owned = stage(owned, "owned")
    totals = owned.groupBy("conv_id").agg(F.sum("value").alias("total"))
    below = _running(owned, F.sum, ("value",)).join(totals, "conv_id").select(
        F.col("position").alias("depth"), "k1", "k2", (F.col("total") - F.col("value_before")).alias("below")
    )
    saved = below.groupBy(*KEY).agg(F.sum("below").alias("saved"))
    saved = saved.unionByName(owned.agg(F.coalesce(F.sum("value"), zero).alias("saved")).select(*(zero.alias(c) for c in KEY), "saved"))

    parent = (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")
    children = nodes.filter("depth > 0").select(*parent).groupBy(*KEY).agg(F.count("*").alias("n_children"))
    full = stage(nodes.join(children, list(KEY), "left").join(saved, list(KEY)), "full-nodes")
    up = nodes.select(*(F.col(c).alias(f"up_{c}") for c in KEY), F.col("conv_id").alias("parent_conv_id"))
    linked = full.join(up, F.expr("depth - 1 = up_depth AND p1 = up_k1 AND p2 = up_k2"), "left")
    result = linked.select(
        "conv_id", *KEY, "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved"
    )
    return result, ends


def end_digests(ends: DataFrame) -> DataFrame:
    """``(depth, k1, k2, ends_sha256)``: SHA-256 of the ids that end in a node, ascending, comma-joined.

    A node's ids run through the digest in sorted order, one after another; no list of them is ever gathered.
    """
    import hashlib

    import pyarrow as pa

    def digests(batches):
        current, digest = None, None
        for batch in batches:
            out = []
            for *key, conv in zip(*(batch[c].to_pylist() for c in (*KEY, "conv_id"))):
                if key == current:
                    digest.update(b",%d" % conv)
                else:
                    if current is not None:
                        out.append((*current, digest.hexdigest()))
                    current, digest = key, hashlib.sha256(b"%d" % conv)
            yield _table(out)
        if current is not None:
            yield _table([(*current, digest.hexdigest())])

    def _table(rows):
        columns = list(zip(*rows)) or [()] * 4
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*KEY, "ends_sha256"])

    ordered = ends.select(*KEY, "conv_id").repartition(*KEY).sortWithinPartitions(*KEY, "conv_id")
    return ordered.mapInArrow(digests, "depth long, k1 long, k2 long, ends_sha256 string")


def last_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """``nodes`` below the root with the ``digest`` of their last turn; ``turns`` as given to ``prefix_trie``."""
    return nodes.join(turns.select("conv_id", F.col("position").alias("depth"), "digest"), ["conv_id", "depth"])
