"""Phrases of words that stand together more often than chance, by dynamic itemset counting.

The texts are dealt to shards, which are scanned one after the other, round and round. Words are
counted from the first scan on. A longer phrase is activated once both phrases that it has without
its last and without its first word have reached the threshold so far; from the next scan on it is
counted along with all others, of any length, until it has met every shard once. Scans end when
every activated phrase has completed its cycle, and counts are then exact. No phrase is counted
whose parts are rare, and lengths need no scans of their own.

Which phrases are active follows from the scan at which their parts reached the threshold. Tasks
read that off two Bloom filters of bounded size and pre-aggregate what passes; a join with the
parts themselves then decides, so a filter's errors have no effect. A phrase is named by its two
parts, a word by a hash of its bytes and its language.

A-Z counts as a-z. Phrases do not cross the signs and line ends that split a text into pieces. Null
and empty texts have no words, a null language is ``und``. Rows may repeat, and count as often. An
empty table gives no phrases. Further columns are not used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinarium.llm.arrays import END, Block, blocks, byte_class, mapped, mixed, span_hashes, spans
from opinarium.llm.bloom import filters
from opinarium.operators.numbering import dense_numbers
from opinarium.session import removed, stored, stored_at, working_folder

THRESHOLD = 100
LONGEST = 5
#: Into so many shards the texts are dealt; a cycle is so many scans.
SHARDS = 4
#: Phrases reported for each language.
FIRST = 2000
NO_LANGUAGE = "und"
#: Up to so many frequent phrases, the list of them is broadcast to the join that looks them up.
BROADCAST_ROWS = 1_000_000
#: A task scans and pre-aggregates about so many words or phrases at a time.
CHUNK, HELD = 1 << 20, 1 << 21
#: A task forgets which words it has spelled after so many.
SPELLED = 1 << 19

_SPLIT = byte_class((0x0A, 0x0D), (END, END))
_SPLIT[[*b".,;:!?"]] = True
_IN_WORD = ~(_SPLIT | byte_class((0x20, 0x20), (0x09, 0x09)))
_STEP = np.uint64(0xD6E8FEB86659FD93)
#: The part of shard of the rows that spell words.
_SPELLING = -1
_CODED = "lang string, words long, codes binary, code long, word string, part int"


def _language_hash(lang: str) -> np.uint64:
    return np.frombuffer(hashlib.blake2b(lang.encode(), digest_size=8).digest(), np.uint64)[0]


def joined_ids(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The id of the phrase that has these two parts."""
    return mixed(left * _STEP + right)


def word_codes(block: Block, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code, start and end of every word of a block, and true where a word begins a piece."""
    starts, ends = spans(block.data, _IN_WORD)
    rows = block.rows_of(starts)
    codes = mixed(span_hashes(block.data, starts, ends) ^ seeds[rows])
    codes[codes == 0] = 1
    breaks = np.cumsum(_SPLIT[block.data])[starts] if len(starts) else np.zeros(0, np.int64)
    return codes, starts, ends, np.append(True, np.diff(breaks) > 0)[:len(codes)]


def coded_texts(docs: DataFrame, shards: int) -> DataFrame:
    """The texts as codes, written once, one folder per shard, with the spelling of the codes.

    A row of a shard has the words of one language in one block of texts, a zero before each piece.
    Every task spells a word once, as far as it remembers.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, turn = np.zeros(0, np.uint64), TaskContext.get().partitionId()
        for batch in batches:
            langs = pc.fill_null(batch.column("lang"), NO_LANGUAGE).dictionary_encode()
            names, of_row = langs.dictionary.to_pylist(), langs.indices.to_numpy()
            hashes = np.array([_language_hash(x) for x in names], np.uint64)
            for block in blocks(batch.column("text")):
                block = block.lowered()
                own = of_row[block.first:block.first + len(block)]
                codes, starts, ends, begins = word_codes(block, hashes[own])
                which = own[block.rows_of(starts)]
                for lang in np.unique(which).tolist():
                    mine = which == lang
                    yield _coded_row(names[lang], int(mine.sum()), _with_breaks(codes[mine], begins[mine]), turn % shards)
                    turn += 1
                fresh, at = np.unique(codes, return_index=True)
                new = ~_among(fresh, known)
                known = fresh if len(known) > SPELLED else np.sort(np.append(known, fresh[new]), kind="stable")
                if new.any():
                    at = at[new]
                    yield _spelled(block, fresh[new], [names[i] for i in which[at].tolist()], starts[at], ends[at])

    path = working_folder(docs.sparkSession, "coded-texts")
    mapped(docs.select("lang", "text"), run, _CODED).write.option("compression", "zstd") \
        .partitionBy("part").parquet(path)
    return docs.sparkSession.read.schema(_CODED).parquet(path)


def _with_breaks(codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    out = np.zeros(len(codes) + int(begins.sum()), np.uint64)
    out[np.arange(len(codes)) + np.cumsum(begins)] = codes
    return out


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """True for the values that stand in a sorted array."""
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _coded_row(lang: str, words: int, codes: np.ndarray, part: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([lang], pa.string()), pa.array([words], pa.int64()), pa.array([codes.tobytes()], pa.binary()),
        pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()), pa.array([part], pa.int32())],
        ["lang", "words", "codes", "code", "word", "part"])


def _spelled(block: Block, codes: np.ndarray, langs: list[str], starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
    words = [block.data[a:b].tobytes().decode() for a, b in zip(starts.tolist(), ends.tolist())]
    return pa.RecordBatch.from_arrays([
        pa.array(langs, pa.string()), pa.nulls(len(words), pa.int64()), pa.nulls(len(words), pa.binary()),
        pa.array(codes.view(np.int64)), pa.array(words, pa.string()),
        pa.array(np.full(len(words), _SPELLING, np.int32))], ["lang", "words", "codes", "code", "word", "part"])


@dataclass
class Scan:
    """What a task needs to know in one scan: whether words are still counted, and the filters of
    the phrases that reached the threshold (``known``) and did so within the last cycle (``recent``)."""

    words: bool
    longest: int
    known: Broadcast | None
    recent: Broadcast | None

    def pairs(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Both parts of every active phrase in a sequence, repeats included; a word has a zero as
        its second part."""
        if self.words:
            words = codes[codes != 0]
            yield words, np.zeros(len(words), np.uint64)
        if self.known is None:
            return
        known, recent = self.known.value, self.recent.value
        ids, active = codes, known.holds(codes) & (codes != 0)
        for length in range(2, self.longest + 1):
            at = np.flatnonzero(active[:-1] & active[1:])
            if not len(at):
                return
            left, right = ids[at], ids[at + 1]
            counted = recent.holds(left) | recent.holds(right)
            yield left[counted], right[counted]
            longer = joined_ids(left, right)
            ids, active = np.zeros(len(codes), np.uint64), np.zeros(len(codes), dtype=bool)
            ids[at], active[at] = longer, known.holds(longer)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    left, right = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    order = np.lexsort((right, left))
    left, right = left[order], right[order]
    first = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])))
    return pa.RecordBatch.from_arrays([
        pa.array(left[first].view(np.int64)), pa.array(right[first].view(np.int64)),
        pa.array(np.diff(np.append(first, len(left))))], ["left", "right", "n"])


def _scanned(shard: DataFrame, scan: Scan) -> DataFrame:
    """Active phrases of a shard: left, right, n, summed by each task as far as it holds them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def scanned() -> None:
            parts.extend((a, b) for a, b in scan.pairs(np.concatenate(waiting)) if len(a))
            waiting.clear()

        for batch in batches:
            for value in batch.column("codes"):
                waiting.append(np.frombuffer(value.as_buffer(), np.uint64))
                if sum(map(len, waiting)) >= CHUNK:
                    scanned()
                    if sum(len(a) for a, _ in parts) >= HELD:
                        yield _summed(parts)
                        parts.clear()
        if waiting:
            scanned()
        if parts:
            yield _summed(parts)

    return mapped(shard.select("codes"), run, "left long, right long, n long")


def _with_ids(rows: DataFrame) -> DataFrame:
    """Adds ``id``, which phrases that have the row as a part know it by."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(c).to_numpy().view(np.uint64) for c in ("left", "right"))
            ids = np.where(right == 0, left, joined_ids(left, right))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids.view(np.int64))], [*batch.schema.names, "id"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return mapped(rows, run, f"{fields}, id long")


def _small(rows: DataFrame, count: int) -> DataFrame:
    return F.broadcast(rows) if count <= BROADCAST_ROWS else rows


def frequent_phrases(coded: DataFrame, threshold: int, longest: int, shards: int) -> DataFrame:
    """All words and phrases with at least ``threshold`` places: id, left, right, length, n.

    ``left`` and ``right`` are the ids of a phrase's two parts. One turn of the loop is one scan.
    """
    counting, counts_folder = _no_counts(coded.sparkSession), None
    known, known_folder, n_known, last_hit, scan = None, None, 0, 0, 0
    while scan < last_hit + shards:
        scan += 1
        made = {} if known is None else filters(known, "id", n_known, {
            "known": F.col("length") < longest, "recent": F.col("hit") >= scan - shards})
        task = Scan(scan <= shards, longest, made.get("known"), made.get("recent"))
        found = _scanned(coded.filter(F.col("part") == (scan - 1) % shards), task)
        summed = counting.select("left", "right", "n").unionByName(found).groupBy("left", "right").agg(
            F.sum("n").alias("n"))
        old = counts_folder
        counting, counts_folder = stored_at(_active(summed, known, n_known, scan, shards), "phrase-counts")
        if old:
            removed(coded.sparkSession, old)
        old = known_folder
        frequent = _with_ids(counting.filter(F.col("n") >= threshold))
        known, known_folder = stored_at(_known(frequent, known, n_known, scan, shards), "frequent-phrases")
        if old:
            removed(coded.sparkSession, old)
        new = (F.col("hit") == scan) & (F.col("length") < longest)
        n_new, n_known = known.agg(F.count_if(new), F.count(F.lit(1))).first()
        last_hit = scan if n_new else last_hit
        counting = counting.filter(F.col("start") + shards > scan)
        for filter_ in made.values():
            filter_.destroy()
        # Spark removes the shuffle files of finished scans once the driver's garbage is collected.
        coded.sparkSession.sparkContext._jvm.System.gc()
    return known.select("id", "left", "right", "length", "n")


def _known(frequent: DataFrame, before: DataFrame | None, n_before: int, scan: int, shards: int) -> DataFrame:
    """The frequent phrases of this scan, with the scan in which each reached the threshold, and the
    earlier ones that have completed their cycle."""
    if before is None:
        return frequent.withColumn("hit", F.lit(scan))
    hits = _small(before.select("id", "hit"), n_before)
    counted = frequent.join(hits, "id", "left").withColumn("hit", F.coalesce("hit", F.lit(scan)))
    return counted.unionByName(before.filter(F.col("start") + shards < scan))


def _no_counts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "left long, right long, n long, start int, length int")


def _active(summed: DataFrame, known: DataFrame | None, n_known: int, scan: int, shards: int) -> DataFrame:
    """Adds the scan before a phrase's first one and its length; phrases that are not counted in
    this scan go."""
    words = summed.filter((F.col("right") == 0) & F.lit(scan <= shards)).withColumns({"start": F.lit(0), "length": F.lit(1)})
    if known is None:
        return words
    phrases = summed.filter("right <> 0")
    for side in ("left", "right"):
        part = known.select(F.col("id").alias(side), F.col("hit").alias(f"{side}_hit"), F.col("length").alias(f"{side}_length"))
        phrases = phrases.join(_small(part, n_known), side)
    phrases = phrases.select("left", "right", "n", F.greatest("left_hit", "right_hit").alias("start"),
                             (F.col("left_length") + 1).alias("length"))
    return words.unionByName(phrases.filter((F.col("start") < scan) & (F.col("start") + shards >= scan)))


def spelled(phrases: DataFrame, coded: DataFrame, longest: int) -> DataFrame:
    """Adds ``lang``, ``text`` and ``last``, the last word, to stored phrases."""
    words = phrases.filter("length = 1")
    # The spellings of different tasks are the same, so there is one row for each word before the join.
    spelling = coded.filter(F.col("part") == _SPELLING).select(F.col("code").alias("id"), "lang", "word").distinct()
    spelling = spelling.join(words.select("id"), "id", "left_semi").groupBy("id").agg(
        F.first("lang").alias("lang"), F.first("word").alias("text"))
    named = [stored(words.join(spelling, "id").withColumn("last", F.col("text")), "spelled")]
    for length in range(2, longest + 1):
        parts = named[-1]
        left = parts.select(F.col("id").alias("left"), "lang", F.col("text").alias("before"))
        right = parts.select(F.col("id").alias("right"), "last")
        named.append(stored(phrases.filter(F.col("length") == length).join(left, "left").join(right, "right").select(
            *phrases.columns, "lang", F.concat_ws(" ", "before", "last").alias("text"), "last"), "spelled"))
    return reduce(DataFrame.unionByName, named)


def scored(named: DataFrame, totals: DataFrame) -> DataFrame:
    """Phrases of two words or more that no longer one stands for: lang, phrase, a, l, r, n, score.

    A phrase is cut in two after each of its words; its score is the lowest of the cuts.
    """
    longer = named.filter("length > 2")
    # A phrase that a longer one contains as often is contained as often in one that is one word longer.
    covers = longer.select(F.explode(F.array("left", "right")).alias("id"), "n").groupBy("id").agg(
        F.max("n").alias("cover"))
    kept = named.filter("length > 1").join(covers, "id", "left").filter("cover is null or cover < n")
    words = F.split("text", " ")
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("length") - 1))).select(
        "id", "lang", F.col("text").alias("phrase"), F.col("n").alias("a"), "k",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("length") - F.col("k")), " ").alias("rest"))
    parts = named.select("lang", "text", "n")
    for column, count in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(parts.select("lang", F.col("text").alias(column), F.col("n").alias(count)), ["lang", column])
    cuts = cuts.join(totals, "lang")
    product = "1000 * cast(a as decimal(38,0)) * cast(n as decimal(38,0))"
    cuts = cuts.withColumn("score", F.expr(f"({product}) div (cast(l as decimal(38,0)) * cast(r as decimal(38,0)))"))
    best = cuts.groupBy("id", "lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, first: int = FIRST, longest: int = LONGEST,
                 shards: int = SHARDS) -> DataFrame:
    """The ``first`` phrases of each language by score: lang, rank, phrase, a, l, r, n, score.

    ``a`` counts the places of the phrase, ``l`` and ``r`` those of the two parts of its lowest cut,
    ``n`` the words of the language.
    """
    coded = coded_texts(docs, shards)
    phrases = stored(frequent_phrases(coded, threshold, longest, shards), "phrases")
    named = stored(spelled(phrases, coded, longest), "named-phrases")
    totals = coded.filter(F.col("part") != _SPELLING).groupBy("lang").agg(F.sum("words").alias("n"))
    found = scored(named, stored(totals, "words-of-languages"))
    ordered = stored(found.withColumns({"_score": -F.col("score"), "_a": -F.col("a")}), "scored-phrases")
    ranked = dense_numbers(ordered, ["_score", "_a", "phrase"], "rank", ["lang"], first=1)
    return ranked.filter(F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
