"""Byte-level BPE: encoding whole texts to token ids, and decoding ids to texts.

Splitting a text into the pieces that are merged separately uses no regular expression. Every
character becomes a symbol (letter, number, white space by what follows, start of a contraction,
other), every symbol stands for a function from automaton state to automaton state, and the state
before each character is a running composition of these functions. Composition is associative
and the functions that can occur are few, so a composition is one look-up in a table, and the
scan runs over all rows of a block side by side: first within columns of equal length, then over
the columns.

The pieces are hashed; a piece met before takes its ids from a cache, new ones are merged
together, one merge of each piece per step. Every block is decoded again and compared with its
bytes, so a piece that took another piece's ids is found and its text encoded piece by piece.

Null and empty texts have no ids. Very long texts are one block each. Rows keep their columns and
their order, and rows may repeat. Fixed by the vocabulary: no special tokens.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from opinarium.llm.arrays import (mapped, END, Block, block_of, blocks, kept_in_worker, mixed,
                                  repeated_ranges, span_hashes)

# Symbols of the splitting automaton.
(INSIDE, LETTER, NUMBER, OTHER, SPACE_BEFORE, GAP_BEFORE, GAP, MARK, TAIL, LAST_TAIL,
 CLOSE) = range(11)
_SPACES = ((9, 13), (32, 32), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
           (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
# States: between pieces; in a run of letters, numbers, others; behind a space that joins what
# follows; in white space; in a contraction, whose mark comes before its one or two tail letters.
_FRESH, _LETTERS, _NUMBERS, _OTHERS, _JOINING, _GAPS, _CONTRACTION = _STATES = range(7)

#: Pieces up to this many bytes are merged together with others.
SIDE_BY_SIDE = 48
#: The cache of a worker is emptied beyond so many pieces; this changes speed only.
CACHE_PIECES = 400_000


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a piece begins with this symbol."""
    if symbol == INSIDE:
        return state, False
    if symbol == CLOSE:
        return _FRESH, True
    if state == _CONTRACTION and symbol in (TAIL, LAST_TAIL):
        return (_CONTRACTION if symbol == TAIL else _FRESH), False
    if symbol == SPACE_BEFORE:
        return _JOINING, True
    if symbol == GAP_BEFORE:
        return _FRESH, True
    if symbol == GAP:
        return _GAPS, state != _GAPS
    if symbol == MARK and state not in (_OTHERS, _JOINING):
        return _CONTRACTION, True
    run = {OTHER: _OTHERS, MARK: _OTHERS, NUMBER: _NUMBERS}.get(symbol, _LETTERS)
    return run, state not in (run, _JOINING)


class Scanner:
    """Tables of the splitting automaton, and the scan over a block."""

    COLUMN = 64

    def __init__(self):
        functions = [tuple(_step(q, s)[0] for q in _STATES) for s in range(CLOSE + 1)]
        number = {f: i for i, f in enumerate(dict.fromkeys(functions))}
        self.of_symbol = np.array([number[f] for f in functions], dtype=np.uint8)
        known = list(number)
        for f in known:  # grows until every composition is known
            for g in functions:
                h = tuple(g[q] for q in f)
                if h not in number:
                    number[h] = len(known)
                    known.append(h)
        assert len(known) <= 256
        self.compose = np.zeros((256, 256), dtype=np.uint8)
        for i, f in enumerate(known):
            for j, g in enumerate(known):
                self.compose[i, j] = number[tuple(g[q] for q in f)]
        self.compose = self.compose.ravel()
        self.identity = number[tuple(_STATES)]
        self.apply_fresh = np.array([f[_FRESH] for f in known], dtype=np.uint8)
        self.begins = np.array([_step(q, s)[1] for q in _STATES for s in range(CLOSE + 1)])
        self.classes = self._character_classes()
        self.ascii = np.full(256, INSIDE, dtype=np.uint8)
        self.ascii[:128] = self.classes[:128]
        self.ascii[END] = CLOSE

    @staticmethod
    def _character_classes() -> np.ndarray:
        kinds = {"L": LETTER, "N": NUMBER}
        table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)),
                            dtype=np.uint8, count=0x110000)
        for low, high in _SPACES:
            table[low:high + 1] = GAP
        return table

    def symbols(self, data: np.ndarray) -> np.ndarray:
        """One symbol per byte; bytes after the first of a character are INSIDE."""
        kinds = self.ascii[data]
        width = np.ones(len(data), dtype=np.uint8) if (data >= 0xC0).any() else None
        lead = np.flatnonzero((data >= 0xC0) & (data != END))
        if len(lead):
            first = data[lead].astype(np.int64)
            tail = [data[np.minimum(lead + i, len(data) - 1)].astype(np.int64) & 0x3F for i in (1, 2, 3)]
            two, three = ((first & 0x1F) << 6) | tail[0], ((first & 0xF) << 12) | (tail[0] << 6) | tail[1]
            four = ((first & 7) << 18) | (tail[0] << 12) | (tail[1] << 6) | tail[2]
            size = 2 + (first >= 0xE0) + (first >= 0xF0)
            kinds[lead] = self.classes[np.choose(size - 2, (two, three, four))]
            width[lead] = size
        gaps = np.flatnonzero(kinds == GAP)
        after = gaps + (width[gaps] if width is not None else 1)
        followed = ~np.isin(kinds[after], (GAP, CLOSE))
        kinds_after = np.where(data[gaps] == 32, SPACE_BEFORE, GAP_BEFORE)
        marks = np.flatnonzero(data == 39)
        one, two = data[marks + 1], data[marks + 2]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
        kinds[gaps[followed]] = kinds_after[followed]
        kinds[marks[short | long]] = MARK
        kinds[marks[short] + 1] = LAST_TAIL
        kinds[marks[long] + 1] = TAIL
        kinds[marks[long] + 2] = LAST_TAIL
        return kinds

    def prefixes(self, functions: np.ndarray) -> np.ndarray:
        """Composition of all functions before each one."""
        n = len(functions)
        if n <= self.COLUMN:
            out, value = np.empty(n, np.uint8), self.identity
            for i in range(n):
                out[i] = value
                value = self.compose[int(value) * 256 + int(functions[i])]
            return out
        columns = -(-n // self.COLUMN)
        padded = np.full(columns * self.COLUMN, self.identity, np.uint8)
        padded[:n] = functions
        across = np.ascontiguousarray(padded.reshape(columns, self.COLUMN).T)
        before = np.empty_like(across)
        value = np.full(columns, self.identity, np.uint8)
        for i in range(self.COLUMN):
            before[i] = value
            value = self.compose[(value.astype(np.uint16) << 8) | across[i]]
        ahead = self.prefixes(value)
        joined = self.compose[(ahead.astype(np.uint16) << 8)[None, :] | before]
        return np.ascontiguousarray(joined.T).ravel()[:n]

    def pieces(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pieces of all texts in the block."""
        symbols = self.symbols(data)
        states = self.apply_fresh[self.prefixes(self.of_symbol[symbols])]
        starts = np.flatnonzero(self.begins[states * np.uint8(CLOSE + 1) + symbols])
        ends = np.append(starts[1:], len(data))
        real = data[starts] != END
        return starts[real], ends[real]


class Encoder:
    """Encodes and decodes with the ranks of one file, whose lines are a base64 token and its id."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.bytes = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)
        self.sizes = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        # An open-addressed table: the merged id of a pair of ids, found with few array reads.
        self._bits = max(4, (4 * len(pairs)).bit_length())
        self._keys = np.full(1 << self._bits, -1, dtype=np.int64)
        self._merged = np.zeros(1 << self._bits, dtype=np.int64)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        places = self._place(keys)
        self.reach = 1
        for key, place in zip(keys.tolist(), places.tolist()):
            step = 1
            while self._keys[place] >= 0:
                place, step = (place + 1) & ((1 << self._bits) - 1), step + 1
            self._keys[place], self._merged[place] = key, pairs[key]
            self.reach = max(self.reach, step)
        self.none = len(self.tokens)
        self.scanner = Scanner()
        self._forget()

    def _forget(self) -> None:
        self.cached_hash = np.zeros(0, np.uint64)
        self.cached_at, self.cached_count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.cached_ids = np.zeros(0, np.int64)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys.astype(np.uint64)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that each pair of ids merges to, or ``none``."""
        keys = left << 32 | right
        place = self._place(keys)
        out = np.full(len(keys), self.none, dtype=np.int64)
        rows = np.arange(len(keys))
        for _ in range(self.reach):
            found = self._keys[place]
            hit = found == keys
            out[rows[hit]] = self._merged[place[hit]]
            go = ~hit & (found >= 0)
            if not go.any():
                break
            rows, keys, place = rows[go], keys[go], (place[go] + 1) & ((1 << self._bits) - 1)
        return out

    def merge_one(self, piece: bytes) -> list[int]:
        """The ids of one piece, by a queue of its mergeable pairs."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        part = [piece[i:i + 1] for i in range(len(piece))]
        after = list(range(1, len(piece) + 1))
        before = list(range(-1, len(piece) - 1))
        rank = self.ranks.get
        queue = [(r, i, part[i] + part[i + 1]) for i in range(len(part) - 1)
                 if (r := rank(part[i] + part[i + 1])) is not None]
        heapq.heapify(queue)

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(part):
                token = part[i] + part[after[i]]
                if (r := rank(token)) is not None:
                    heapq.heappush(queue, (r, i, token))

        while queue:
            _, i, token = heapq.heappop(queue)
            if part[i] is None or after[i] >= len(part) or part[i] + part[after[i]] != token:
                continue
            gone = after[i]
            part[i], part[gone], after[i] = token, None, after[gone]
            if after[i] < len(part):
                before[after[i]] = i
            offer(i)
            offer(before[i])
        return [self.ranks[p] for p in part if p is not None]

    def merge_many(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many short pieces and how many each has; in each step every piece does the
        first of its lowest-ranked merges."""
        ids = self.single[data[repeated_ranges(starts, sizes)]]
        owner = np.repeat(np.arange(len(sizes)), sizes)
        done_ids, done_owner = [], []
        rank = np.full(len(ids), self.none, dtype=np.int64)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        rank[inner] = self.merged(ids[inner], ids[inner + 1])
        while len(ids):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            count = np.diff(np.append(first, len(ids)))
            best = np.minimum.reduceat(rank, first)
            live = np.repeat(best < self.none, count)
            if not live.all():
                done_ids.append(ids[~live])
                done_owner.append(owner[~live])
                ids, owner, rank = ids[live], owner[live], rank[live]
                keep = best < self.none
                best, count = best[keep], count[keep]
                if not len(ids):
                    break
            where = np.flatnonzero(rank == np.repeat(best, count))
            where = where[np.append(True, owner[where[1:]] != owner[where[:-1]])]
            ids[where] = best
            stay = np.ones(len(ids), dtype=bool)
            stay[where + 1] = False
            place = where - np.arange(len(where))
            ids, owner, rank = ids[stay], owner[stay], rank[stay]
            last = np.append(owner[1:] != owner[:-1], True)
            for spot in (place, place - 1):
                spot = spot[spot >= 0]
                rank[spot] = self.none
                open_ = spot[~last[spot]]
                rank[open_] = self.merged(ids[open_], ids[open_ + 1])
        if not done_ids:
            return np.zeros(0, np.int64), np.zeros(len(sizes), np.int64)
        all_ids, all_owner = np.concatenate(done_ids), np.concatenate(done_owner)
        order = np.argsort(all_owner, kind="stable")
        return all_ids[order], np.bincount(all_owner, minlength=len(sizes))

    def _learn(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        sizes = ends - starts
        short = sizes <= SIDE_BY_SIDE
        ids, counts = self.merge_many(data, starts[short], sizes[short])
        count = np.zeros(len(sizes), np.int64)
        count[short] = counts
        at = np.zeros(len(sizes), np.int64)
        at[short] = np.cumsum(counts) - counts
        parts, total = [ids], len(ids)
        for i in np.flatnonzero(~short):
            one = self.merge_one(data[starts[i]:ends[i]].tobytes())
            at[i], count[i], total = total, len(one), total + len(one)
            parts.append(np.array(one, np.int64))
        at += len(self.cached_ids)
        self.cached_ids = np.concatenate([self.cached_ids, *parts])
        joined = np.concatenate([self.cached_hash, hashes])
        order = np.argsort(joined, kind="stable")
        self.cached_hash = joined[order]
        self.cached_at = np.concatenate([self.cached_at, at])[order]
        self.cached_count = np.concatenate([self.cached_count, count])[order]

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block, and where the ids of each row begin (one entry more than rows)."""
        data = block.data
        starts, ends = self.scanner.pieces(data)
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(len(block) + 1, np.int64)
        hashes = span_hashes(data, starts, ends)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.cached_hash) > CACHE_PIECES:
            self._forget()
        place = np.searchsorted(self.cached_hash, distinct)
        known = np.zeros(len(distinct), dtype=bool)
        inside = place < len(self.cached_hash)
        known[inside] = self.cached_hash[place[inside]] == distinct[inside]
        if not known.all():
            new = first[~known]
            self._learn(data, distinct[~known], starts[new], ends[new])
            place = np.searchsorted(self.cached_hash, distinct)
        at, count = self.cached_at[place][which], self.cached_count[place][which]
        ids = self.cached_ids[repeated_ranges(at, count)]
        before = np.append(0, np.cumsum(count))
        bounds = before[np.append(np.searchsorted(starts, block.starts, side="left"), len(starts))]
        return self._checked(block, ids, bounds)

    def _checked(self, block: Block, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Decodes and, should a hash have stood for two pieces, encodes the texts one by one."""
        if np.array_equal(self.decode(ids), block.data[block.data != END]):
            return ids, bounds
        rows = []
        for i in range(len(block)):
            one = block_of([block.text(i).decode()])
            cut = zip(*self.scanner.pieces(one.data))
            rows.append([t for a, b in cut for t in self.merge_one(one.data[a:b].tobytes())])
        counts = [len(r) for r in rows]
        return np.array([t for r in rows for t in r], np.int64), np.append(0, np.cumsum(counts)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that the ids stand for, by their offsets in the list of tokens."""
        return self.bytes[repeated_ranges(self.offsets[ids], self.sizes[ids])]


def encoder(path: str) -> Encoder:
    return kept_in_worker(f"encoder {path}", lambda: Encoder(path))


def little_endian(ids: np.ndarray) -> bytes:
    return ids.astype("<u4").tobytes()


def map_encoded(docs: DataFrame, path: str, schema: T.StructType, each, keep: list[str]) -> DataFrame:
    """Applies ``each(encoder, block, ids, bounds) -> columns`` to all texts of ``docs``.

    ``keep`` names the columns of ``docs`` that come first in ``schema``.
    """
    names = [f.name for f in schema][len(keep):]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for batch in batches:
            for block in blocks(batch.column("text")):
                made = each(code, block, *code.encode(block))
                rows = made.pop("row", None)
                kept = batch.slice(block.first, len(block))
                columns = [kept.column(k) if rows is None else kept.column(k).take(pa.array(rows)) for k in keep]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(made[n]) for n in names)], [*keep, *names])

    return mapped(docs.select(*dict.fromkeys([*keep, "text"])), run, schema)


def encode_texts(docs: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """Adds ``ids`` (array of int) and ``offsets`` (where each token begins in the UTF-8 text)."""

    def each(code, block, ids, bounds):
        sizes = code.sizes[ids]
        offsets = np.cumsum(sizes) - sizes
        rows = range(len(block))
        start = [offsets[bounds[i]] if bounds[i] < len(ids) else 0 for i in rows]
        return {"ids": [ids[bounds[i]:bounds[i + 1]].astype(np.int32) for i in rows],
                "offsets": [(offsets[bounds[i]:bounds[i + 1]] - start[i]).astype(np.int64) for i in rows]}

    schema = T.StructType([docs.schema[k] for k in keep]).add("ids", T.ArrayType(T.IntegerType())) \
        .add("offsets", T.ArrayType(T.LongType()))
    return map_encoded(docs, path, schema, each, keep)


def decode_ids(docs: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """Adds ``text`` decoded from ``ids``; null ids give an empty text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for batch in batches:
            texts = [code.decode(np.array(ids or [], np.int64)).tobytes().decode("utf-8", "replace")
                     for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(texts, pa.string())],
                                             [*keep, "text"])

    schema = T.StructType([docs.schema[k] for k in keep]).add("text", T.StringType())
    return mapped(docs.select(*keep, "ids"), run, schema)


def encoding_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the decoded bytes."""

    def each(code, block, ids, bounds):
        packed, text = little_endian(ids), code.decode(ids)
        cut = np.append(0, np.cumsum(code.sizes[ids]))[bounds]
        rows = range(len(block))
        return {
            "n_tokens": np.diff(bounds),
            "ids_sha256": [hashlib.sha256(packed[4 * bounds[i]:4 * bounds[i + 1]]).hexdigest() for i in rows],
            "decoded_sha256": [hashlib.sha256(text[cut[i]:cut[i + 1]]).hexdigest() for i in rows],
        }

    schema = T.StructType([docs.schema["doc_id"]]).add("n_tokens", T.LongType()) \
        .add("ids_sha256", T.StringType()).add("decoded_sha256", T.StringType())
    return map_encoded(docs, path, schema, each, ["doc_id"])
