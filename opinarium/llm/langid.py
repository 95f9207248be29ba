"""Language by Bayesian fusion of text, declared language, address suffix and host.

The text's likelihoods come from three-byte sequences inside words, with tables fitted on a bounded
sample of texts of known language. Long texts do not outweigh everything: their evidence counts as
that of ``EFFECTIVE`` sequences at most. The other evidence is counted over all rows by grouped
aggregation, with the language that a row's text alone suggests: how often each language declares
what, and how often it occurs overall, under each address suffix and on each host. Host shares
are smoothed towards those of their suffix, and those towards the overall ones.

A row has no language (``und``) if its text has no sequence at all, or fits its best language worse
than chance. Null and empty texts are such. A null host, suffix or declaration is a value like any
other. Rows may repeat. An empty table gives no rows. Further columns pass through ``keep``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinarium.llm.arrays import mapped, Block, blocks, byte_class
from opinarium.session import stored

#: At most so many distinct texts of each language are fitted, lowest hash first.
SAMPLE_TEXTS = 1500
#: At most so many languages are fitted: those with the most distinct texts, equal ones by name.
#: Rows that declare another one teach nothing, and are scored like all rows.
MOST_LANGUAGES = 256
SLOTS = 1 << 14
#: A text with fewer sequences says too little to be rejected for want of a certain language.
LITTLE = 20
EFFECTIVE = 60
#: Share of sequences that come by chance in any language, so unseen ones cost little.
CHANCE = 0.2
#: How many rows the shares one level up count as.
PRIOR_ROWS = 20.0
#: A row is certain if its best language has at least this probability.
CERTAIN = 0.5
UNKNOWN = "und"
BROADCAST_ROWS = 200_000

_WORD = byte_class((0x61, 0x7A), (0x80, 0xFE))
_BLOCK = re.compile(rb"<(script|style)\b", re.IGNORECASE)
_CLOSINGS = {name: re.compile(rb"</" + name + rb"\s*+>", re.IGNORECASE) for name in (b"script", b"style")}


@dataclass
class Profiles:
    """Log probabilities of sequences: one row per language."""

    languages: list[str]
    table: np.ndarray

    def likelihoods(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Per row the summed log likelihood ratio to chance of each language, and the sequences."""
        places, slots = _sequences(block)
        first = np.searchsorted(places, block.starts)
        bounds = np.append(first, len(places))
        sums = np.zeros((len(block), len(self.languages)))
        for k, row in enumerate(self.table):
            total = np.append(0.0, np.cumsum(row[slots].astype(np.float64)))
            sums[:, k] = total[bounds[1:]] - total[bounds[:-1]]
        count = np.diff(bounds)
        return sums + count[:, None] * math.log(SLOTS), count


def _sequences(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Place and slot of every three bytes in a row that lie in a word or on its edge."""
    data = block.lowered().data
    inside = _WORD[data]
    letters = np.where(inside, data, 32).astype(np.uint32)
    ends = data == 0xFF
    fits = (inside[:-2].astype(np.int8) + inside[1:-1] + inside[2:] >= 2) & inside[1:-1]
    fits &= ~(ends[:-2] | ends[1:-1] | ends[2:])
    places = np.flatnonzero(fits)
    key = (letters[places] << 16) | (letters[places + 1] << 8) | letters[places + 2]
    return places, ((key * np.uint32(2654435761)) >> np.uint32(32 - 14)).astype(np.int64)


def _shown(page: bytes) -> bytes:
    """A page with each script, style, comment and tag as one blank, in one pass.

    A closing mark that is missing once is missing from there on, so it is not looked for again.
    """
    parts, at, missing = [], 0, set()
    while (start := page.find(b"<", at)) >= 0:
        parts.append(page[at:start])
        end = -1
        block = _BLOCK.match(page, start)
        kind = block[1].lower() if block else b"!--" if page.startswith(b"<!--", start) else None
        if kind and kind not in missing:
            if block:
                closing = _CLOSINGS[kind].search(page, block.end())
                end = closing.end() if closing else -1
            else:
                end = page.find(b"-->", start + 4) + 3
                end = end if end > 2 else -1
            if end < 0:
                missing.add(kind)
        if end < 0:  # a tag, or a block that nothing closes
            end = page.find(b">", start) + 1
            if not end:
                return b"".join([*parts, page[start:]])
        parts.append(b" ")
        at = end
    return b"".join([*parts, page[at:]])


def visible(html: pa.Array) -> pa.Array:
    """The texts of pages without tags, scripts, styles and comments."""
    return pa.array([None if h is None else _shown(h.encode()).decode() for h in html.to_pylist()], pa.large_string())


def _first_of_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of every language and hash in a task, so copies are neither sorted nor shuffled."""
    seen: set[tuple[str, int]] = set()
    for batch in batches:
        fresh = []
        for key in zip(batch.column("lang").to_pylist(), batch.column("text_hash").to_pylist()):
            fresh.append(key not in seen)
            seen.add(key)
        yield batch.filter(pa.array(fresh, pa.bool_()))


def train(labelled: DataFrame, sample_texts: int = SAMPLE_TEXTS, most_languages: int = MOST_LANGUAGES) -> Profiles:
    """Profiles from columns ``text`` and ``lang``; rows without either teach nothing, and copies of
    a text teach once."""
    known = labelled.select("lang", "text").filter("lang is not null and length(text) > 0") \
        .withColumn("text_hash", F.xxhash64("text", "lang"))
    distinct = stored(known.select("lang", "text_hash").distinct(), "language-texts")
    most = distinct.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages)
    counts = {r["lang"]: r["count"] for r in most.collect()}
    languages = sorted(counts)
    if not languages:
        return Profiles([], np.zeros((0, SLOTS), np.float32))
    # Only hashes below a bound that about twice as many texts pass as are wanted are ordered.
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, (2 * sample_texts + 100) / counts[k])])
    draw = F.pmod(F.xxhash64("text_hash"), F.lit(1 << 30)) / float(1 << 30)
    lowest = Window.partitionBy("lang").orderBy(draw, "text_hash")
    drawn = distinct.filter(draw < F.try_element_at(share, F.col("lang"))).withColumn("place", F.row_number().over(lowest)) \
        .filter(F.col("place") <= sample_texts)
    drawn = stored(drawn.select("lang", "text_hash"), "language-sample")
    place = {language: i for i, language in enumerate(languages)}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(languages), SLOTS), np.int64)
        for batch in batches:
            own = np.array([place[x] for x in batch.column("lang").to_pylist()])
            for block in blocks(batch.column("text")):
                places, slots = _sequences(block)
                rows = own[block.first + block.rows_of(places)]
                sums += np.bincount(rows * SLOTS + slots, minlength=sums.size).reshape(sums.shape)
        which, slot = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(which.astype(np.int32)), pa.array(slot.astype(np.int32)),
                                          pa.array(sums[which, slot])], ["language", "slot", "n"])

    texts = mapped(known.join(drawn, ["lang", "text_hash"], "left_semi").select("lang", "text_hash", "text"),
                   _first_of_task, "lang string, text_hash long, text string")
    one_each = texts.groupBy("lang", "text_hash").agg(F.first("text").alias("text")).select("lang", "text")
    found = mapped(one_each, run, "language int, slot int, n long")
    table = np.zeros((len(languages), SLOTS))
    # One row per language and slot at most.
    language, slot, n = (c.to_numpy() for c in found.groupBy("language", "slot").agg(F.sum("n").alias("n")).toArrow().columns)
    table[language, slot] = n
    shares = table / np.maximum(1, table.sum(axis=1, keepdims=True))
    return Profiles(languages, np.log((1 - CHANCE) * shares + CHANCE / SLOTS).astype(np.float32))


def evidence(rows: DataFrame, profiles: Profiles, keep: list[str], html: bool = False) -> DataFrame:
    """Adds to the columns of ``keep``: ``sequences``, ``letters`` (whether a text has any), and the
    log likelihoods of all languages as the array ``ll``."""
    schema = T.StructType([rows.schema[k] for k in keep]).add("sequences", T.LongType()) \
        .add("letters", T.BooleanType()).add("ll", T.ArrayType(T.DoubleType()))
    size = len(profiles.languages)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                text = visible(part.column("text")) if html else part.column("text")
                for block in blocks(text):
                    sums, count = profiles.likelihoods(block)
                    letters = np.zeros(len(block), dtype=bool)
                    letters[block.rows_of(np.flatnonzero(_WORD[block.lowered().data]))] = True
                    kept = part.slice(block.first, len(block))
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(block) + 1, dtype=np.int32) * size),
                                                     pa.array(sums.ravel()))
                    yield pa.RecordBatch.from_arrays([*(kept.column(k) for k in keep), pa.array(count),
                                                      pa.array(letters), lists], schema.names)

    return mapped(rows.select(*dict.fromkeys([*keep, "text"])), run, schema)


def _vectors(counts: DataFrame, keys: list[str], size: int) -> DataFrame:
    """One row per key with the array ``n``: the rows of every language."""
    pairs = counts.groupBy(*keys, "which").agg(F.sum("n").alias("n")).groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("which", "n"))).alias("of"))
    every = F.sequence(F.lit(0), F.lit(size - 1))
    return pairs.select(*keys, F.transform(every, lambda i: F.coalesce(F.try_element_at("of", i), F.lit(0).cast("long")))
                        .alias("n"))


def _shares(above: Column) -> Column:
    """Smoothed shares of the languages out of their rows ``n``; ``above`` are those one level up."""
    total = F.aggregate("n", F.lit(0).cast("long"), lambda a, b: a + b)
    return F.zip_with("n", above, lambda n, share: (n + PRIOR_ROWS * share) / (total + PRIOR_ROWS))


def fuse(found: DataFrame, languages: list[str]) -> DataFrame:
    """Adds ``text_lang``, ``lang`` and ``probability`` to stored evidence with columns host, suffix
    and declared. All joins are on counted tables; a host with many rows is counted before them."""
    if not languages:
        return found.withColumns({"text_lang": F.lit(UNKNOWN), "lang": F.lit(UNKNOWN), "probability": F.lit(0.0)})
    size = len(languages)
    names = F.lit(languages)

    def best_of(values: Column) -> Column:
        return F.array_position(values, F.array_max(values)).cast("int")

    damped = F.least(F.lit(1.0), F.lit(float(EFFECTIVE)) / F.greatest(F.col("sequences"), F.lit(1)))
    readable = (F.col("sequences") > 0) & (F.array_max("ll") > 0)
    named = found.withColumn("_which", F.when(readable, best_of(F.col("ll")) - 1))
    counted = stored(named.filter("_which is not null").groupBy("host", "suffix", "declared", F.col("_which").alias("which"))
                     .agg(F.count(F.lit(1)).alias("n")), "language-counts")
    overall = [0] * size
    for row in counted.groupBy("which").agg(F.sum("n").alias("n")).collect():  # one row per language
        overall[row["which"]] = row["n"]
    everywhere = F.lit([(n + 1) / (sum(overall) + size) for n in overall])
    by_suffix = _vectors(counted, ["suffix"], size).select(F.col("suffix").alias("_suffix"), _shares(everywhere).alias("s"))
    by_host = _vectors(counted, ["host", "suffix"], size).join(by_suffix, F.col("suffix").eqNullSafe(F.col("_suffix")))
    by_host = stored(by_host.select(F.col("host").alias("_host"), "_suffix", _shares(F.col("s")).alias("h")), "language-hosts")
    declared = _vectors(counted, ["declared"], size)
    values = declared.count()
    declared = stored(declared.select(F.col("declared").alias("_declared"), F.zip_with(
        "n", F.lit(overall), lambda n, all_: F.log((n + 1.0) / (all_ + values + 1.0))).alias("d")), "language-declared")
    joined = named.join(by_host, F.col("host").eqNullSafe(F.col("_host")) & F.col("suffix").eqNullSafe(F.col("_suffix")), "left") \
        .join(declared, F.col("declared").eqNullSafe(F.col("_declared")), "left")
    prior = F.zip_with(F.coalesce("h", everywhere), F.coalesce("d", F.lit([0.0] * size)), lambda h, d: F.log(h) + d)
    joined = joined.withColumn("_p", F.zip_with(prior, "ll", lambda before, ll: before + ll * damped))
    top = F.array_max("_p")
    return joined.withColumns({
        "text_lang": F.coalesce(F.get(names, F.col("_which")), F.lit(UNKNOWN)),
        "lang": F.when(readable, F.get(names, best_of(F.col("_p")) - 1)).otherwise(UNKNOWN),
        "probability": F.when(readable, 1.0 / F.aggregate("_p", F.lit(0.0), lambda a, p: a + F.exp(p - top))).otherwise(0.0),
    }).select(*found.columns, "text_lang", "lang", "probability")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))


def suffix_of(host: Column) -> Column:
    return F.regexp_extract(host, r"([^.]*)$", 1)


def declared_of(html: Column) -> Column:
    """The primary tag of the language that the markup declares, else an empty text."""
    return F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})\b", 1))


def page_languages(pages: DataFrame, profiles: Profiles) -> DataFrame:
    """Per page: page_id, host, declared, text_lang, lang, probability, kept."""
    host = host_of(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), suffix_of(host).alias("suffix"),
                        declared_of(F.col("html")).alias("declared"), F.col("html").alias("text"))
    found = stored(evidence(rows, profiles, ["page_id", "host", "suffix", "declared"], html=True), "language-evidence")
    return fuse(found, profiles.languages).select(
        "page_id", "host", "declared", "text_lang", "lang", "probability",
        ((F.col("lang") != UNKNOWN) & (F.col("probability") >= CERTAIN)).alias("kept"))


def document_languages(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """Per document: doc_id, text_hash, text_lang, lang, probability, kept. The source stands for
    the host; documents carry no markup and no address. A document is kept unless it has no letters,
    or is long enough to tell and has no certain language."""
    rows = docs.select("doc_id", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"),
                       F.coalesce(F.col("source"), F.lit("")).alias("host"), F.lit("").alias("suffix"),
                       F.lit("").alias("declared"), "text")
    found = stored(evidence(rows, profiles, ["doc_id", "text_hash", "host", "suffix", "declared"]), "language-evidence")
    return fuse(found, profiles.languages).select(
        "doc_id", "text_hash", "text_lang", "lang", "probability",
        (F.col("letters") & ((F.col("sequences") < LITTLE) | (F.col("lang") != UNKNOWN)
                             & (F.col("probability") >= CERTAIN))).alias("kept"))


def readable_documents(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """The documents that are kept by ``document_languages``, all columns as they were.

    Only ids and hashes of the rejected are joined.
    """
    found = document_languages(docs, profiles).filter(~F.col("kept"))
    gone = stored(found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(),
                  "language-rejected")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    text_hash = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(gone, (text_hash == gone["_hash"]) & docs["doc_id"].eqNullSafe(gone["_id"]), "left_anti")
