"""Packing documents into as few fixed-length training sequences as possible.

Every document becomes its token ids and an end id. Only documents longer than a sequence are cut,
so that all pieces but the first are full. Full pieces are sequences of their own. The others are
dealt at random to groups of bounded size; each group is packed best-fit first and improved by
local search: documents of the least filled sequence move to others, one is exchanged for one, or
one for two, whenever this raises the sum of squared fills. The search of a group ends when no
fewer sequences are possible, or when every sequence that is not full was tried since the last one
became empty. A group wastes less than one sequence beyond what its search leaves.

Ids are those of the tokenizer's own library, which reads a marker that stands in a text as its
one id. Null and empty texts are one end id long. Documents that repeat, with or without an id, are
pieces of their own. An empty table gives no rows. Further columns of the input are not used.
"""

from __future__ import annotations

import heapq
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinarium.llm.arrays import block_of
from opinarium.llm.bpe import little_endian, map_encoded
from opinarium.session import stored

CAPACITY = 2048
END_ID = 0
#: Fixed value: the added token of the tokenizer and its id.
MARKERS = {"<|endoftext|>": 50256}
#: Pieces of a group on average; groups are packed independently of each other.
GROUP_PIECES = 16384


def _with_markers(code, text: bytes, markers: dict[str, int]) -> np.ndarray:
    """The ids of a text, with every marker in it as its own id."""
    parts = re.split("(" + "|".join(map(re.escape, markers)) + ")", text.decode())
    ids, bounds = code.encode(block_of(parts[::2]))
    made = [ids[bounds[0]:bounds[1]]]
    for k, marker in enumerate(parts[1::2], 1):
        made += [[markers[marker]], ids[bounds[k]:bounds[k + 1]]]
    return np.concatenate(made)


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, and a number that no other piece has."""

    numbers: dict[int, int] = {}
    signs = [m.encode() for m in MARKERS]

    def each(code, block, ids, bounds):
        task = TaskContext.get()
        number = numbers.setdefault(task.taskAttemptId(), task.partitionId() << 33)
        rows, piece, start, length, crc = [], [], [], [], []
        for i in range(len(block)):
            own = ids[bounds[i]:bounds[i + 1]]
            if any(sign in (text := block.text(i)) for sign in signs):
                own = _with_markers(code, text, MARKERS)
            own = np.append(own, END_ID)
            packed, total = memoryview(little_endian(own)), len(own)
            first = (total - 1) % capacity + 1
            cuts = [0, *range(first, total + 1, capacity)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                rows.append(i)
                piece.append(k)
                start.append(a)
                length.append(b - a)
                crc.append(zlib.crc32(packed[4 * a:4 * b]))
        numbers[task.taskAttemptId()] = number + len(rows)
        return {"row": rows, "piece": pa.array(piece, pa.int32()), "start": start, "length": length,
                "ids_crc32": pa.array(crc, pa.int64()),
                "number": np.arange(number, number + len(rows), dtype=np.int64)}

    schema = T.StructType([docs.schema["doc_id"]]).add("piece", T.IntegerType()) \
        .add("start", T.LongType()).add("length", T.LongType()).add("ids_crc32", T.LongType()) \
        .add("number", T.LongType())
    return map_encoded(docs, path, schema, each, ["doc_id"])


class Packing:
    """Sequences under construction. ``members[s]`` are the pieces of sequence s."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.size = lengths.tolist()
        self.capacity = capacity
        self.members: list[list[int]] = []
        self.fill: list[int] = []

    def best_fit(self) -> None:
        """Longest first, each into the fullest sequence that has room."""
        by_room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        rooms = 0  # bit r is set if some sequence has room r
        for piece in sorted(range(len(self.size)), key=lambda i: (-self.size[i], i)):
            size = self.size[piece]
            fitting = rooms >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                sequence = by_room[room].pop()
                if not by_room[room]:
                    rooms &= ~(1 << room)
            else:
                room, sequence = self.capacity, len(self.members)
                self.members.append([])
                self.fill.append(0)
            self.members[sequence].append(piece)
            self.fill[sequence] += size
            if room > size:
                by_room[room - size].append(sequence)
                rooms |= 1 << (room - size)

    def _exchange(self, a: int, out: list[int], b: int, back: list[int]) -> None:
        """Pieces ``out`` go from sequence a to b, pieces ``back`` from b to a."""
        for source, target, pieces in ((a, b, out), (b, a, back)):
            for piece in pieces:
                self.members[source].remove(piece)
                self.members[target].append(piece)
                self.fill[source] -= self.size[piece]
                self.fill[target] += self.size[piece]

    def _options(self, receivers: list[int]) -> tuple[np.ndarray, ...]:
        """What receivers can give back: nothing, one piece or two. Their sum, room, and which."""
        total, room, who, first, second = [], [], [], [], []
        for s in receivers:
            pieces = self.members[s]
            give = [(-1, -1), *((p, -1) for p in pieces),
                    *((p, q) for i, p in enumerate(pieces) for q in pieces[i + 1:])]
            total += [sum(self.size[x] for x in g if x >= 0) for g in give]
            room += [self.capacity - self.fill[s]] * len(give)
            who += [s] * len(give)
            first += [g[0] for g in give]
            second += [g[1] for g in give]
        return tuple(np.array(x, dtype=np.int64) for x in (total, room, who, first, second))

    def _best(self, donor: int, options: tuple[np.ndarray, ...]):
        """The exchange with the greatest gain in squared fill that takes tokens from the donor."""
        best, chosen = 0, None
        total, room, who, first, second = options
        ahead = self.capacity - room - self.fill[donor]
        own = self.members[donor]
        outs = [[p] for p in own] + [[p, q] for i, p in enumerate(own) for q in own[i + 1:]]
        for given, out in {sum(self.size[p] for p in out): out for out in reversed(outs)}.items():
            moved = given - total
            fits = (moved > 0) & (moved <= room) & (ahead + moved > 0)
            if len(out) == 2:  # two for one at most
                fits &= second < 0
            gain = np.where(fits, moved * (ahead + moved), 0)
            i = int(np.argmax(gain))
            if gain[i] > best:
                best, chosen = int(gain[i]), (out, int(who[i]), [int(x) for x in (first[i], second[i]) if x >= 0])
        return chosen

    def local_search(self) -> None:
        """Empties the least filled sequences while exchanges raise the sum of squared fills.

        Ends when no fewer sequences are possible, or when every sequence that is not full was tried
        in vain since the last one was emptied.
        """
        least = -(-sum(self.size) // self.capacity)
        used = sum(1 for f in self.fill if f)
        if used <= least:
            return
        donors = [(f, s) for s, f in enumerate(self.fill) if 0 < f < self.capacity]
        options = self._options([s for _, s in donors])
        heapq.heapify(donors)
        tried: set[int] = set()
        while used > least and donors:
            fill, donor = heapq.heappop(donors)
            if fill != self.fill[donor] or donor in tried:
                continue  # the fill has changed since, or the sequence stands here twice
            options = _without(options, donor)
            while self.fill[donor] and len(options[0]) and (found := self._best(donor, options)):
                out, receiver, back = found
                self._exchange(donor, out, receiver, back)
                options = _without(options, receiver)
                if self.fill[receiver] < self.capacity:
                    options = _joined(options, self._options([receiver]))
                    heapq.heappush(donors, (self.fill[receiver], receiver))
            tried.add(donor)
            if self.fill[donor]:
                options = _joined(options, self._options([donor]))
                continue
            used -= 1
            for s in tried:
                if 0 < self.fill[s] < self.capacity:
                    heapq.heappush(donors, (self.fill[s], s))
            tried.clear()

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of every piece."""
        sequence, offset = np.zeros(len(self.size), np.int64), np.zeros(len(self.size), np.int64)
        for s, pieces in enumerate(m for m in self.members if m):
            at = 0
            for piece in pieces:
                sequence[piece], offset[piece] = s, at
                at += self.size[piece]
        return sequence, offset


def _without(options: tuple[np.ndarray, ...], sequence: int) -> tuple[np.ndarray, ...]:
    keep = options[2] != sequence
    return tuple(x[keep] for x in options)


def _joined(options: tuple[np.ndarray, ...], more: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    return tuple(np.concatenate(x) for x in zip(options, more))


def pack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece of one group."""
    packing = Packing(lengths, capacity)
    packing.best_fit()
    packing.local_search()
    return packing.places()


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY,
                   group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The pieces are written once to the shared folder, so their numbers stay what they are even if
    executors are lost. Only lengths and numbers are shuffled, never texts or ids.
    """
    pieces = stored(token_pieces(docs, path, capacity), "token-pieces")
    open_ = pieces.filter(F.col("length") < capacity)
    groups = max(1, -(-open_.count() // group_pieces))
    schema = T.StructType([f for f in pieces.schema if f.name != "number"]) \
        .add("sequence_id", T.LongType()).add("offset", T.LongType())
    names = schema.names

    def pack_group(table: pa.Table) -> pa.Table:
        table = table.sort_by("number")
        sequence, offset = pack(table.column("length").to_numpy(), capacity)
        group = table.column("group")[0].as_py()
        return pa.table([*(table.column(n) for n in names[:-2]), pa.array(sequence + (group << 32)),
                         pa.array(offset)], names=names)

    dealt = open_.withColumn("group", F.pmod(F.xxhash64("number"), F.lit(groups)))
    packed = dealt.groupBy("group").applyInArrow(pack_group, schema)
    whole = pieces.filter(F.col("length") == capacity).select(
        *names[:-2], (-1 - F.col("number")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(whole)
