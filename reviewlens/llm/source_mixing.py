"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.columns import free_names, without, word_array
from reviewlens.session import stage

#: Documents of a shard, about: sources are dealt to as many shards as their documents need.
SHARD_DOCS = 4096
#: Blocks in the smallest target of a shard, at least: how fine the apportionment is.
FINENESS = 256
#: Bound on the table of sums that a shard's exact selection needs.
SUMS_BYTES = 16 * 2**20
#: Divisors that are tried in one job.
DIVISORS = 48
RESULT = ("size", "source_size", "target", "taken")


def targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``sources`` (source, source_size) with ``target``, which add up to ``share`` of all sizes.

    Weights are given in turn to the sources by code point, null last. No target exceeds ``most`` times its
    source's size; what is cut off goes to the others by weight. With level t, a target is
    min(weight t, most size). The sum of these minima is the least, over all k, of the k smallest caps (by
    cap/weight) plus t times the remaining weights, so t is the largest solution of those lines.

    One row per source is sorted in one task.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array([F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    caps = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    up_to = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = up_to.rowsBetween(Window.unboundedPreceding, -1)
    from_here = up_to.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * float(share)
    line = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(from_here)
    return (
        caps.withColumn("line", line)
        .withColumn("level", F.max("line").over(everything))
        .withColumn("target", F.least(F.col("weight") * F.col("level"), F.col("cap")))
        .select("source", "source_size", "cap", "target")
    )


def apportion(parties: DataFrame, block: float, seats: int, keys: Sequence[str] = ("source",)) -> DataFrame:
    """``parties`` (with ``target``) and ``seats``: the blocks that go to the highest quotients target/(2j+1).

    These are the targets over a common divisor, rounded, for the divisor at which they add up to ``seats``. It is
    searched from ``block`` on, by aggregates over many divisors at once; no quotients are listed. Where a tie
    leaves no such divisor, the last seats go to the first of the tied parties in the order of ``keys``.
    """

    def rounded(divisor: float):
        return F.floor(F.col("target") / F.lit(divisor) + 0.5).cast("long")

    def totals(divisors: Sequence[float]) -> list[int]:
        return [n or 0 for n in parties.agg(*(F.sum(rounded(d)) for d in divisors)).first()]

    low, high = float(block), float(block)  # at least, and at most, as many seats as wanted
    (total,) = totals([block])
    while total < seats and low > 1e-300:
        low /= 2
        (total,) = totals([low])
    while total > seats:
        high *= 2
        (total,) = totals([high])
    low = min(low, high)
    (many, few) = totals([low, high])
    while many != seats and few != seats:
        between = [d for d in np.linspace(low, high, DIVISORS + 2)[1:-1].tolist() if low < d < high]
        if not between:
            break
        found = dict(zip(between, totals(between)))
        low = max([low, *(d for d, n in found.items() if n >= seats)])
        high = min([high, *(d for d, n in found.items() if n <= seats)])
        many, few = found.get(low, many), found.get(high, few)
    if many == seats or few == seats:
        return parties.withColumn("seats", rounded(low if many == seats else high))
    tied = parties.withColumns({"_seats": rounded(high), "_more": rounded(low) - rounded(high)}).filter("_more > 0")
    quotient = F.desc(F.col("target") / (2 * F.col("_seats") + 1))
    order = [F.col(k).asc_nulls_last() for k in keys]
    last = tied.orderBy(quotient, *order).limit(max(seats - few, 0)).select(*(F.col(k).alias(f"_{k}") for k in keys), F.lit(1).alias("_one"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    joined = parties.join(last, same, "left").withColumn("seats", rounded(high) + F.coalesce("_one", F.lit(0)))
    return joined.select(*parties.columns, "seats")


def _nearest_sum(sizes: list[int], quota: int) -> np.ndarray:
    """The documents whose sizes add up as near to ``quota`` as possible; of two sums equally near, the smaller one."""
    reached = [1]  # bit s: some of the documents so far add up to s
    for size in sizes:
        reached.append(reached[-1] | reached[-1] << size)
    below = (reached[-1] & ((1 << (quota + 1)) - 1)).bit_length() - 1
    above = reached[-1] >> (quota + 1)
    upper = quota + (above & -above).bit_length() if above else None
    left = upper if upper is not None and upper - quota < quota - below else below
    taken = np.zeros(len(sizes), bool)
    for i in range(len(sizes) - 1, -1, -1):
        if not reached[i] >> left & 1:
            taken[i] = True
            left -= sizes[i]
    return taken


def fill_quota(sizes: np.ndarray, quota: int) -> np.ndarray:
    """Which of the documents, in order, are taken so that their sizes come near ``quota``.

    Where the table of all reachable sums fits ``SUMS_BYTES``, the sum is the nearest there is, from documents as early
    as possible. Larger shards have so many documents that steps do: each document that still fits is taken, then
    the one document is added, left out, or exchanged for another that brings the sum nearest to the quota,
    until none brings it nearer.
    """
    if len(sizes) * int(sizes.sum()) <= 8 * SUMS_BYTES:
        return _nearest_sum(sizes.tolist(), quota)
    taken = np.zeros(len(sizes), bool)
    left = quota
    for i, size in enumerate(sizes.tolist()):
        if 0 < size <= left:
            taken[i] = True
            left -= size
    while left:
        inside, outside = np.flatnonzero(taken), np.flatnonzero(~taken & (sizes > 0))
        # Sizes that can go out (none, or a document's) against those that can come in, the nearest by bisection.
        out, come = np.concatenate(([0], sizes[inside])), np.concatenate(([0], sizes[outside]))
        order = np.argsort(come, kind="stable")
        wanted = out + left
        place = np.searchsorted(come[order], wanted)
        best = None
        for near in (np.clip(place, 0, len(come) - 1), np.clip(place - 1, 0, len(come) - 1)):
            miss = np.abs(wanted - come[order][near])
            i = int(np.argmin(miss))
            if best is None or miss[i] < best[0]:
                best = (int(miss[i]), i, int(order[near[i]]))
        if best[0] >= abs(left):
            break
        _, goes, comes = best
        if goes:
            taken[inside[goes - 1]] = False
        if comes:
            taken[outside[comes - 1]] = True
        left = quota - int(sizes[taken].sum())
    return taken


def _select(shard: pd.DataFrame) -> pd.DataFrame:
    """The documents of one shard of a source, and how often each is taken."""
    shard = shard.sort_values(["order", "tie", "size"], kind="stable")
    words = shard["size"].to_numpy() * shard["copies"].to_numpy()
    quota, total = int(shard["quota"].iloc[0]), int(words.sum())
    times = quota // total if total else 0
    once = fill_quota(words, quota - times * total) if total else np.zeros(len(words), bool)
    return shard[["source", "order", "tie", "size"]].assign(times=times + once)


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target`` (of the source) and ``taken`` (words).

    Targets come from ``targets``. A source's documents are dealt by a seeded hash to shards of about ``SHARD_DOCS``,
    and its target to its shards by their words. All targets are cut into equal blocks, so small that the least
    one has ``FINENESS``; ``apportion`` gives each shard of each source whole blocks by highest quotients: its quota.
    In a shard all documents are taken as often as the quota holds the whole shard, and for the rest of it whole
    documents in the order of the hash, see ``fill_quota``; ``taken`` is a multiple of ``size``. A shard misses its
    quota by less than its smallest document that is left. No document exceeds ``most`` times its size, and reruns agree.

    Words are counted once; hashes and sizes are dealt, texts are not.

    Null text has no words; a null source is a source, the last one. Rows that repeat an id are documents of their
    own; those that repeat id and text are taken together. Columns of the same names are replaced. An empty
    table gives an empty result.
    """
    docs = without(docs, *RESULT)
    order, tie = free_names(docs, "order", "tie")
    keyed = docs.withColumns({order: F.xxhash64(F.lit(seed), F.col(id_col)), tie: F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))})
    sized = keyed.select(
        F.col(source_col).alias("source"), F.col(order).alias("order"), F.col(tie).alias("tie"),
        F.size(word_array(F.col(text_col))).cast("long").alias("size"),
    )
    sized = stage(sized.groupBy("source", "order", "tie", "size").agg(F.count("*").alias("copies")), "sizes")

    totals = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count("*").alias("docs"))
    totals = stage(totals, "totals")
    sources = targets(totals.select("source", "source_size"), weights, share, most)
    sources = stage(sources.alias("s").join(totals.alias("t"), F.expr("s.source <=> t.source")).select("s.*", "docs"), "sources")
    of = sources.select(F.col("source").alias("of"), F.ceil(F.col("docs") / SHARD_DOCS).alias("shards"), "source_size", "target")
    dealt = sized.join(of, F.col("source").eqNullSafe(F.col("of"))).withColumn("shard", F.pmod(F.xxhash64("order", "tie"), "shards"))
    cells = dealt.groupBy("source", "shard").agg(
        F.sum(F.col("size") * F.col("copies")).alias("words"), F.first("source_size").alias("source_size"), F.first("target").alias("whole")
    )
    goal = F.when(F.col("source_size") > 0, F.col("whole") * F.col("words") / F.col("source_size")).otherwise(0.0)
    cells = stage(cells.select("source", "shard", "words", goal.alias("target")), "cells")
    whole, least = cells.filter("target > 0").agg(F.sum("target"), F.min("target")).first()
    block = max(1.0, (least or 1.0) / FINENESS)
    quotas = apportion(cells, block, round((whole or 0.0) / block), ("source", "shard"))
    quota = F.least(F.round(F.col("seats") * block).cast("long"), F.col("words") * int(most))
    quotas = stage(quotas.select(F.col("source").alias("of_source"), F.col("shard").alias("of_shard"), quota.alias("quota")), "quotas")

    same = F.col("source").eqNullSafe(F.col("of_source")) & (F.col("shard") == F.col("of_shard"))
    chosen = dealt.join(quotas, same).select("source", "shard", "order", "tie", "size", "copies", "quota")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sized.select("source", "order", "tie", "size").schema)
    chosen = chosen.groupBy("source", "shard").applyInPandas(_select, f"{kinds}, times long")
    figures = sources.select(F.col("source").alias("of"), "source_size", "target")
    chosen = stage(chosen.join(figures, F.col("source").eqNullSafe(F.col("of"))).drop("of"), "chosen")

    names = dict(zip(chosen.columns, free_names(keyed, *(f"chosen_{c}" for c in chosen.columns))))
    chosen = chosen.withColumnsRenamed(names)
    found = keyed.join(
        chosen,
        (F.col(order) == F.col(names["order"])) & (F.col(tie) == F.col(names["tie"])) & F.col(source_col).eqNullSafe(F.col(names["source"])),
    )
    size = F.col(names["size"])
    return found.select(
        *(F.col(f"`{c}`") for c in docs.columns),
        size.alias("size"),
        F.col(names["source_size"]).alias("source_size"),
        F.col(names["target"]).alias("target"),
        (F.col(names["times"]) * size).alias("taken"),
    )


def mixed_rows(mixed: DataFrame) -> DataFrame:
    """The mixture itself: a row for each time a document is taken, without the columns of ``mix_sources``.

    A document is repeated ``taken / size`` times, which is whole for rows of ``mix_sources``. Documents of which
    nothing is taken have no row.
    """
    (copy,) = free_names(mixed, "copy")
    copies = F.floor(F.col("taken") / F.greatest(F.col("size"), F.lit(1))).cast("int")
    return mixed.filter("taken > 0").withColumn(copy, F.explode(F.sequence(F.lit(1), copies))).drop(copy, *RESULT)
