"""Personal data in texts: four plain patterns, and identifiers that stand where such data stands.

The matches of the plain patterns are seeds. Words around them are lexical patterns: the two words
before, a label before (a word that ends in a colon, an equals sign or a hash), and the word before
with the one behind. Long words with digits or an at sign that stand in the same contexts are
candidates. Patterns and instances form a graph that Spark scores in turns. A pattern's confidence
is the score of its distinct instances over their number and that of the plain words which stand in
its place anywhere in the corpus, so that common words prove nothing; it counts if enough
instances support it. An instance that is no seed scores what its patterns leave of doubt. A
candidate that scores high is reported at all of its places, and lends its other patterns weight.

Which contexts can be patterns at all follows from the first reading of the texts; a second one
counts the plain words in them, led by a Bloom filter of bounded size and decided by a join. Texts
are never shuffled, and a pattern or instance with very many places is counted before it moves.

Null and empty texts have no spans. Whole texts are searched, however long, in time that grows with
their length. Positions are code points. Rows may repeat, with or without an id, and are rows of
their own. An empty table gives no rows. Further columns are not used.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from opinarium.llm.arrays import END, Block, blocks, byte_class, mapped, mixed, span_hashes, spans
from opinarium.llm.bloom import filters
from opinarium.session import removed, stored, stored_at

# Kinds in order; the last is the method's own.
KINDS = ("email", "ip", "card", "phone", "context")
CONTEXT = 4
_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_PART_MOST = 255
_CARD_DIGITS, _PHONE_DIGITS = (16, 19), (8, 15)

#: A candidate has at least so many bytes.
LEAST = 6
#: Words around an identifier are told apart by their length and so many bytes.
WORD_BYTES = 64
#: A pattern needs so many distinct instances that are believed.
SUPPORT = 3
#: The distinct instances that a pattern's denominator gets on top.
DOUBT = 1.0
#: Least confidence of a pattern that counts, least score of a candidate that is reported.
CONFIDENT, ACCEPTED = 0.5, 0.7
#: Turns of scoring; a turn can pass belief one pattern further.
TURNS = 4

_DIGIT = byte_class((0x30, 0x39))
_LOCAL = byte_class((0x41, 0x5A), (0x61, 0x7A), (0x30, 0x39))
_LOCAL[[*b"._%+-"]] = True
_PHONE = byte_class((0x30, 0x39))
_PHONE[[*b" ().-"]] = True
_SPACE = byte_class((0x20, 0x20), (0x09, 0x0D), (END, END))
_LABEL = np.zeros(256, dtype=bool)
_LABEL[[*b":=#"]] = True
_EDGE = np.frombuffer(b"\"'()[]{}<>.,;:!?", np.uint8)
_IN_WORD = ~_SPACE
#: A-Z as a-z, and every digit as 0.
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32
_FOLDED[0x30:0x3A] = 0x30
_PAIR, _LABELLED, _FRAME, _EDGE_WORD = (np.uint64(x) for x in (
    0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xC13FA9A902A6328F, 0x91E10DA5C79E7B1D))


@dataclass
class Found:
    """Base spans of a block in byte positions, by start: kinds, starts, ends."""

    kind: np.ndarray
    start: np.ndarray
    end: np.ndarray


def _chains(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last run of every chain; ``linked[i]`` is true if run i + 1 goes on after run i."""
    first = np.flatnonzero(np.append(True, ~linked))
    return first, np.append(first[1:], len(linked) + 1) - 1


def _emails(data: np.ndarray, text: bytes) -> Iterator[tuple[int, int]]:
    at = np.flatnonzero(data == 0x40)
    low, high = spans(data, _LOCAL)
    before = np.searchsorted(high, at)  # the run of local characters that ends at the sign, if any
    done = 0
    for sign, run in zip(at.tolist(), before.tolist()):
        if run >= len(high) or high[run] != sign:
            continue
        start = max(int(low[run]), done)
        if start < sign and (domain := _DOMAIN.match(text, sign + 1)):
            done = domain.end()
            yield start, done


def _addresses(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    linked = (starts[1:] - ends[:-1] == 1) & (data[ends[:-1]] == 0x2E)
    for a, b in zip(*_chains(linked)):
        for i in range(a, b - 2, 4):
            if all(_part(data, starts[k], ends[k]) <= _PART_MOST for k in range(i, i + 4)):
                yield int(starts[i]), int(ends[i + 3])


def _part(data: np.ndarray, start: int, end: int) -> int:
    digits = data[start:end].tobytes().lstrip(b"0")
    return int(digits or b"0") if len(digits) <= 3 else _PART_MOST + 1


def _cards(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    between = data[ends[:-1]]
    linked = (starts[1:] - ends[:-1] == 1) & ((between == 0x20) | (between == 0x2D))
    first, last = _chains(linked)
    sums = np.append(0, np.cumsum(ends - starts))
    digits = sums[last + 1] - sums[first]
    fits = (digits >= _CARD_DIGITS[0]) & (digits <= _CARD_DIGITS[1])
    for a, b in zip(starts[first[fits]].tolist(), ends[last[fits]].tolist()):
        if _luhn(bytes(c for c in data[a:b].tobytes() if 0x30 <= c <= 0x39)):
            yield a, b


def _luhn(digits: bytes) -> bool:
    values = [c - 0x30 for c in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def _phones(data: np.ndarray) -> Iterator[tuple[int, int]]:
    sign = np.flatnonzero((data[:-1] == 0x2B) & _DIGIT[data[1:]])
    if not len(sign):
        return
    low, high = spans(data, _PHONE)
    run = np.searchsorted(low, sign + 1, side="right") - 1
    digits = np.flatnonzero(_DIGIT[data])
    last = digits[np.searchsorted(digits, high[run]) - 1]  # the last digit of the run
    count = np.searchsorted(digits, last, side="right") - np.searchsorted(digits, sign + 1)
    fits = (last - sign >= 3) & (count >= _PHONE_DIGITS[0]) & (count <= _PHONE_DIGITS[1])
    yield from zip(sign[fits].tolist(), (last[fits] + 1).tolist())


def base_spans(block: Block) -> Found:
    """Matches of the plain patterns, leftmost and not overlapping within a kind."""
    data = block.data
    starts, ends = spans(data, _DIGIT)
    parts = [list(_emails(data, data.tobytes()))]
    parts += [list(_addresses(data, starts, ends)), list(_cards(data, starts, ends))] if len(starts) else [[], []]
    parts.append(list(_phones(data)))
    found = np.array([(s, e, k) for k, own in enumerate(parts) for s, e in own], dtype=np.int64).reshape(-1, 3)
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    return Found(found[:, 2], found[:, 0], found[:, 1])


class Words:
    """The words of a block: runs without space, cut after a label's sign."""

    def __init__(self, block: Block, found: Found):
        data = block.data
        inside = _IN_WORD[data]
        after_label = np.append(False, _LABEL[data[:-1]])
        begins = inside & (np.append(True, ~inside[:-1]) | after_label)
        stops = inside & (np.append(~inside[1:], True) | np.append(begins[1:], False))
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        folded = _FOLDED[data]
        self.hash = mixed(span_hashes(folded, self.start, np.minimum(self.end, self.start + WORD_BYTES))
                          ^ (self.end - self.start).astype(np.uint64))
        self.row = block.rows_of(self.start)
        self.label = _LABEL[data[self.end - 1]] if len(self.start) else np.zeros(0, bool)
        marks = np.append(0, np.cumsum(_DIGIT[data] | (data == 0x40)))
        self.marked = marks[self.end] > marks[self.start]
        self.seeded = np.zeros(len(self.start), dtype=bool)
        for a, b in zip(*self.of(found)):
            self.seeded[a:b + 1] = True

    def of(self, found: Found) -> tuple[np.ndarray, np.ndarray]:
        """The first and the last word of every span."""
        return (np.searchsorted(self.start, found.start, side="right") - 1,
                np.searchsorted(self.start, found.end - 1, side="right") - 1)

    def _near(self, at: np.ndarray, offset: int) -> np.ndarray:
        """The hash of the word so far away, or a fixed one beyond the ends of the text."""
        other = at + offset
        inside = (other >= 0) & (other < len(self.start))
        other = np.clip(other, 0, max(0, len(self.start) - 1))
        return np.where(inside & (self.row[other] == self.row[at]), self.hash[other], _EDGE_WORD)

    def patterns(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Three patterns for the words from ``first`` to ``last``; without a label there, a zero."""
        one, two, behind = self._near(first, -1), self._near(first, -2), self._near(last, 1)
        labelled = (first > 0) & self.label[np.maximum(first - 1, 0)] & (one != _EDGE_WORD)
        return np.stack([mixed(mixed(two ^ _PAIR) * _PAIR + one), np.where(labelled, mixed(one * _LABELLED + _LABELLED), 0),
                         mixed(mixed(one ^ _FRAME) * _FRAME + behind)], axis=1)

    def candidates(self, block: Block) -> list[tuple[int, int, int]]:
        """Word, start and end of every long word with a digit or an at sign that is no seed's, without
        the signs around it."""
        out = []
        for i in np.flatnonzero(self.marked & ~self.seeded & (self.end - self.start >= LEAST)).tolist():
            keep = np.flatnonzero(~np.isin(block.data[self.start[i]:self.end[i]], _EDGE))
            if len(keep) and keep[-1] - keep[0] + 1 >= LEAST:
                out.append((i, int(self.start[i] + keep[0]), int(self.start[i] + keep[-1] + 1)))
        return out


def _instance(block: Block, start: int, end: int) -> int:
    """The name of an identifier: a hash of it in lower case."""
    return int.from_bytes(hashlib.blake2b(block.data[start:end].tobytes().lower(), digest_size=8).digest(), "big", signed=True)


def _code_points(block: Block, places: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Byte positions as code points of their texts."""
    heads = np.append(0, np.cumsum((block.data & 0xC0) != 0x80))
    return heads[places] - heads[block.starts[rows]]


_SPAN = T.ArrayType(T.StructType().add("kind", T.IntegerType()).add("start", T.LongType()).add("end", T.LongType())
                    .add("instance", T.LongType()).add("patterns", T.ArrayType(T.LongType())))


def _places(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, a number that no other row has, and its seeds and candidates with their
    patterns, by start."""
    schema = T.StructType([docs.schema["doc_id"]]).add("row", T.LongType()).add("places", _SPAN)
    kind = to_arrow_type(_SPAN)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for block in blocks(batch.column("text")):
                places: list[list[dict]] = [[] for _ in range(len(block))]
                found = base_spans(block)
                words = Words(block, found)
                others = words.candidates(block)
                first, last = words.of(found)
                own = np.array([i for i, _, _ in others], np.int64)
                first, last = np.append(first, own), np.append(last, own)
                kinds = np.append(found.kind, np.full(len(others), CONTEXT))
                starts = np.append(found.start, np.array([a for _, a, _ in others], np.int64))
                ends = np.append(found.end, np.array([b for _, _, b in others], np.int64))
                rows = block.rows_of(starts)
                patterns = words.patterns(first, last).view(np.int64).tolist() if len(first) else []
                names = [_instance(block, a, b) for a, b in zip(starts.tolist(), ends.tolist())]
                from_, to = (_code_points(block, x, rows).tolist() for x in (starts, ends))
                for i in np.lexsort((kinds, starts)).tolist():
                    places[rows[i]].append({"kind": int(kinds[i]), "start": from_[i], "end": to[i], "instance": names[i],
                                            "patterns": [p for p in patterns[i] if p]})
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(block.first, len(block)),
                    pa.array(np.arange(number, number + len(block), dtype=np.int64)),
                    pa.array(places, kind)], schema.names)
                number += len(block)

    return mapped(docs.select("doc_id", "text"), run, schema)


def _plain_words(docs: DataFrame, wanted) -> DataFrame:
    """``pattern`` and ``n``: the plain words that stand in wanted contexts, as counted by each block."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                words = Words(block, base_spans(block))
                plain = np.flatnonzero(~words.marked & ~words.seeded)
                if not len(plain):
                    continue
                keys = words.patterns(plain, plain).ravel()
                keys, counts = np.unique(keys[(keys != 0) & wanted.value.holds(keys)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["pattern", "n"])

    return mapped(docs.select("text"), run, "pattern long, n long")


def pattern_graph(docs: DataFrame, places: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored edges (pattern, instance), instances (instance, seed) and the plain words of patterns
    (pattern, n), for the contexts of at least ``SUPPORT`` distinct instances."""
    spots = places.select(F.explode("places").alias("p")).select("p.kind", "p.instance", F.explode("p.patterns").alias("pattern"))
    edges = stored(spots.groupBy("pattern", "instance").agg(F.min("kind").alias("kind")), "pii-edges")
    seen = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= SUPPORT).select("pattern")
    seen = stored(seen, "pii-contexts")
    wanted = filters(seen, "pattern", seen.count(), {"seen": F.lit(True)})["seen"]
    plain = _plain_words(docs, wanted).groupBy("pattern").agg(F.sum("n").alias("n"))
    plain = stored(plain.join(seen, "pattern", "left_semi"), "pii-plain-words")
    wanted.destroy()
    kept = stored(edges.join(seen, "pattern", "left_semi"), "pii-graph")
    instances = stored(kept.groupBy("instance").agg((F.min("kind") < CONTEXT).alias("seed")), "pii-instances")
    return kept.select("pattern", "instance"), instances, plain


def scored_instances(edges: DataFrame, instances: DataFrame, plain: DataFrame, turns: int = TURNS) -> DataFrame:
    """``instance`` and ``score`` after some turns; a seed scores one, other instances begin with none."""
    scores, folder = instances.select("instance", "seed", F.col("seed").cast("double").alias("score")), None
    for _ in range(turns):
        believed = edges.join(scores, "instance").groupBy("pattern").agg(
            F.sum("score").alias("score"), F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("score") >= CONFIDENT).alias("support"))
        words = plain.withColumnRenamed("n", "words")
        trust = F.col("score") / (F.col("n") + F.coalesce("words", F.lit(0)) + DOUBT)
        trusted = believed.join(words, "pattern", "left").withColumn("trust", trust).filter(
            (F.col("trust") >= CONFIDENT) & (F.col("support") >= SUPPORT)).select("pattern", "trust")
        doubt = edges.join(trusted, "pattern").groupBy("instance").agg(
            F.exp(F.sum(F.log(1 - F.col("trust")))).alias("doubt"))
        old = folder
        scores, folder = stored_at(instances.join(doubt, "instance", "left").select(
            "instance", "seed", F.when(F.col("seed"), 1.0).otherwise(1 - F.coalesce("doubt", F.lit(1.0))).alias("score")),
            "pii-scores")
        if old:
            removed(edges.sparkSession, old)
    return scores.select("instance", "score")


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, n_context, base_sha256, spans.

    ``spans`` lists every span as kind:start:end, by kind and start; ``base_sha256`` is the digest of
    such a list without the context spans.
    """
    places = stored(_places(docs), "pii-places")
    edges, instances, plain = pattern_graph(docs, places)
    scores = scored_instances(edges, instances, plain)
    seeds = instances.filter("not seed").select("instance")
    accepted = stored(scores.filter(F.col("score") >= ACCEPTED).join(seeds, "instance"), "pii-accepted")
    others = places.select("row", F.explode(F.filter("places", lambda p: p["kind"] == CONTEXT)).alias("p"))
    spots = others.select("row", F.col("p.start").alias("start"), F.col("p.end").alias("end"), F.col("p.instance").alias("instance"))
    more = stored(spots.join(accepted, "instance").groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct(F.lit(CONTEXT).alias("kind"), "start", "end"))).alias("more")), "pii-more")
    base = F.transform(F.filter("places", lambda p: p["kind"] < CONTEXT),
                       lambda p: F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end")))
    rows = places.select("doc_id", "row", F.array_sort(base).alias("base")).join(more, "row", "left").withColumn(
        "more", F.coalesce("more", F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")))
    names = F.array(*[F.lit(k) for k in KINDS])

    def listed(spans_: str):
        return F.array_join(F.transform(spans_, lambda p: F.concat_ws(
            ":", F.element_at(names, p["kind"] + 1), p["start"].cast("string"), p["end"].cast("string"))), ",")

    def count(kind: int):
        return F.size(F.filter("base", lambda p: p["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    base_list, more_list = listed("base"), listed("more")
    return rows.select(
        "doc_id", *[count(k) for k in range(CONTEXT)], F.size("more").cast("long").alias("n_context"),
        F.sha2(base_list, 256).alias("base_sha256"),
        F.array_join(F.filter(F.array(base_list, more_list), lambda x: x != ""), ",").alias("spans"))
