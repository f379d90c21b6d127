"""Packing tokenized documents into sequences of fixed length: best fit, then a swap-based local search."""

from __future__ import annotations

import zlib
from bisect import insort
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.columns import free_names
from reviewlens.llm.tokens import chunks, encoder
from reviewlens.session import stage

LENGTH, END_ID = 4096, 1
#: Tokens of a shard, which one task packs: about 1000 sequences.
SHARD_TOKENS = 2**22
#: Steps of the local search in a shard, at most; None: until no step is left.
MOVES = None


def pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = END_ID, with_ids: bool = True
) -> DataFrame:
    """Token pieces of every document: id, ``piece``, ``start``, ``length``, ``ids_crc32`` and ``input_ids``.

    The ids of the whole text are followed by ``end_id``; null text is empty. Only documents longer than
    ``length`` are cut, every ``length`` tokens. ``ids_crc32`` is over the ids as little-endian unsigned 32-bit
    numbers. Rows that repeat an id are documents of their own. Other columns are left out.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    key_type = source.schema["id"].dataType.simpleString()
    ids_field = ", input_ids array<int>" if with_ids else ""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for whole in batches:
            for batch in chunks(whole, "text"):
                ids, counts = encode(batch.column("text"))
                rows, starts, ends, crcs, arrays = [], [], [], [], []
                at = 0
                for row, count in enumerate(counts):
                    document = np.append(ids[at : at + count], np.uint32(end_id)).astype("<u4")
                    at += count
                    for start in range(0, len(document), length):
                        part = document[start : start + length]
                        rows.append(row)
                        starts.append(start)
                        ends.append(len(part))
                        crcs.append(zlib.crc32(part.tobytes()))
                        if with_ids:
                            arrays.append(part.astype(np.int32))
                columns = {
                    id_col: batch.column("id").take(pa.array(rows)),
                    "piece": pa.array([s // length for s in starts], pa.int32()),
                    "start": pa.array(starts, pa.int64()),
                    "length": pa.array(ends, pa.int64()),
                    "ids_crc32": pa.array(crcs, pa.int64()),
                }
                if with_ids:
                    columns["input_ids"] = pa.array(arrays, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    return source.mapInArrow(cut, f"`{id_col}` {key_type}, piece int, start long, length long, ids_crc32 long{ids_field}")


class Bins:
    """Bins of documents, with the bins of each amount of room at hand."""

    def __init__(self, lengths: list[int], room: int):
        self.lengths, self.size = lengths, room
        self.members: list[list[tuple[int, int]]] = []  # (length, document), ascending
        self.room: list[int] = []
        self.by_room: list[set[int]] = [set() for _ in range(room + 1)]
        self.mask = 0  # bit r: a bin with room r

    def place(self, b: int, room: int | None) -> None:
        """Files bin ``b`` under its room; None takes it out."""
        old = self.room[b]
        if old is not None:
            self.by_room[old].discard(b)
            if not self.by_room[old]:
                self.mask &= ~(1 << old)
        self.room[b] = room
        if room is not None:
            self.by_room[room].add(b)
            self.mask |= 1 << room

    def tightest(self, length: int) -> int | None:
        """The open bin with the least room that ``length`` fits into."""
        fits = self.mask >> length
        if not fits:
            return None
        return min(self.by_room[length + (fits & -fits).bit_length() - 1])

    def change(self, b: int, out: list[tuple[int, int]], into: list[tuple[int, int]]) -> None:
        for item in out:
            self.members[b].remove(item)
        for item in into:
            insort(self.members[b], item)
        room = self.room[b] + sum(n for n, _ in out) - sum(n for n, _ in into)
        self.place(b, room if self.members[b] else None)

    def fill_best_fit(self) -> None:
        """Longest documents first, each into the tightest bin."""
        for document in sorted(range(len(self.lengths)), key=lambda d: (-self.lengths[d], d)):
            b = self.tightest(self.lengths[document])
            if b is None:
                b = len(self.members)
                self.members.append([])
                self.room.append(None)
                self.place(b, self.size)
            self.change(b, [], [(self.lengths[document], document)])

    def improve(self, moves: int | None = None) -> None:
        """Empties bins by steps between underfull bins that increase the sum of squared fills.

        A step moves a document from one bin to a fuller one, or exchanges one for a shorter one, one for two
        that are shorter together, or two for one that is shorter than both together, where the fuller bin has
        room for the difference. Room gathers in ever fewer bins until these are empty. The search ends when no
        bin can be spared, no step is left from any underfull bin, or ``moves`` are made; as the sum rises with
        every step, it does end.
        """
        least = -(-sum(self.lengths) // self.size)
        used = sum(bool(m) for m in self.members)
        if used <= least:
            return
        n = len(self.members)
        self.rooms = np.zeros(n, np.int64)  # of underfull bins, 0 for others
        self.stuck = np.zeros(n, bool)  # bins that no step is left from
        # For one document (0) and two (1): the lengths a bin holds, and whether it takes each length for others.
        self.wanted = [np.zeros((n, 1), np.int32) for _ in range(2)]
        self.offers = [np.zeros((n, self.size + 1), bool) for _ in range(2)]
        for b in np.flatnonzero([bool(r) for r in self.room]):
            self._index(b)
        while used > least and (moves is None or moves > 0):
            source = self._step()
            if source is None:
                break
            used -= not self.members[source]
            moves = None if moves is None else moves - 1

    def _index(self, b: int) -> None:
        """Files the lengths that bin ``b`` holds and takes, as its members and room are now."""
        room = self.room[b] or 0
        self.rooms[b] = room
        sizes = [n for n, _ in self.members[b]] if room else []
        ones = np.unique(np.array(sizes, np.int64))
        i, j = np.triu_indices(len(ones), 1)
        twice = [2 * n for n, after in zip(sizes, sizes[1:]) if n == after]
        twos = np.unique(np.concatenate([ones[i] + ones[j], np.array(twice, np.int64)]))
        for kind, values in enumerate((ones, twos)):
            wide = max(0, len(values) - self.wanted[kind].shape[1])
            if wide:
                self.wanted[kind] = np.pad(self.wanted[kind], ((0, 0), (0, wide)))
            self.wanted[kind][b] = 0  # a length that no bin takes
            self.wanted[kind][b, : len(values)] = values
        for kind, given in enumerate((np.concatenate([[0], ones, twos]), ones)):
            ends = np.zeros(self.size + 2, np.int32)
            np.add.at(ends, given + 1, 1)
            np.add.at(ends, np.minimum(given + room, self.size) + 1, -1)
            self.offers[kind][b] = (np.cumsum(ends[:-1]) > 0) if room else False

    def _step(self) -> int | None:
        """One step, from the emptiest bin that has one to the emptiest that is as full or fuller; the first bin."""
        while True:
            source = int(np.argmax(np.where(self.stuck, 0, self.rooms)))
            if not self.rooms[source] or self.stuck[source]:
                return None
            fits = (self.rooms > 0) & (self.rooms <= self.rooms[source])
            fits[source] = False
            for kind in range(2):
                wanted = self.wanted[kind][source]
                found = np.flatnonzero(fits & self.offers[kind][:, wanted].any(1))
                if len(found):
                    b = int(found[np.argmax(self.rooms[found])])
                    self._exchange(source, b, kind, int(wanted[self.offers[kind][b, wanted]].max()))
                    return source
            self.stuck[source] = True

    def _exchange(self, source: int, b: int, kind: int, total: int) -> None:
        """Gives bin ``b`` documents of ``total`` tokens, one or (``kind`` 1) two, for what it offers for them."""
        docs, theirs = self.members[source], self.members[b]

        def pairs(items: list) -> Iterator[list]:
            return ([x, y] for i, x in enumerate(items) for y in items[:i])

        mine = next(m for m in ([[x] for x in docs] if kind == 0 else pairs(docs)) if sum(n for n, _ in m) == total)
        backs = [[x] for x in theirs] if kind else chain([[]], ([x] for x in theirs), pairs(theirs))
        back = next(k for k in backs if 0 < total - sum(n for n, _ in k) <= self.room[b])
        self._swap(source, b, mine, back)
        for changed in (source, b):
            self._index(changed)
            self.stuck[changed] = False
        for changed in (source, b):
            for kind in range(2):
                freed = self.offers[kind][changed][self.wanted[kind]].any(1)
                self.stuck &= ~(freed & (self.rooms >= self.rooms[changed]))

    def _swap(self, source: int, b: int, mine: list, theirs: list) -> None:
        self.change(b, theirs, mine)
        self.change(source, mine, theirs)


def pack_lengths(lengths: list[int], room: int = LENGTH, moves: int | None = MOVES) -> list[list[int]]:
    """Documents of each bin; every document is in one bin, and no bin holds more than ``room``."""
    bins = Bins(lengths, room)
    bins.fill_best_fit()
    bins.improve(moves)
    return [[document for _, document in members] for members in bins.members if members]


def pack(table: DataFrame, length: int = LENGTH, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """``table`` (one row per piece, with ``length``) with ``sequence_id`` and ``offset``.

    Pieces are dealt by a hash to shards of about ``shard_tokens`` tokens, and every shard is packed by one
    task. A shard wastes less than one sequence beyond what its pieces need, so the number of sequences hardly
    depends on the number of shards. ``sequence_id`` holds the shard in its upper 32 bits. An empty table gives
    an empty result.
    """
    table = stage(table, "pieces")  # from here on, row numbers are the same in every attempt
    total = table.agg(F.sum("length")).first()[0] or 0
    shards = max(1, round(total / shard_tokens))
    (shard,) = free_names(table, "shard")
    dealt = table.withColumn(shard, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    schema = table.drop("sequence_id", "offset").schema.add("sequence_id", "long").add("offset", "long")
    columns = schema.names[:-2]

    def place(rows: pa.Table) -> pa.Table:
        lengths = rows["length"].to_pylist()
        base = rows[shard][0].as_py() << 32
        sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        for number, members in enumerate(pack_lengths(lengths, length)):
            at = 0
            for document in members:
                sequence[document], offset[document] = base + number, at
                at += lengths[document]
        return rows.select(columns).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return dealt.groupBy(shard).applyInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id``, ``input_ids`` and the ``starts`` of its documents, from pieces packed with their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "input_ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten("parts.input_ids").alias("input_ids"), F.col("parts.offset").alias("starts")
    )
