"""Exact deduplication with a two-pass Bloom filter.

First pass: every text sets two bits, named by its digest, and bits set more than once are kept.
Second pass: a text is possibly repeated if both of its bits are among those. Only possibly
repeated rows are shuffled and compared by their whole digests; the others pass straight through.
To count the bits, each row sends two positions, neither its digest nor its text. Bits set once are
not kept, so the filter is as large as the repeats make it. A small filter is broadcast; Spark checks
its size and joins narrow digests with it if it is large. Whole rows meet only a filter of bounded
size that the repeated digests set.

Texts are equal if they are the same after A-Z became lower case; null counts as empty. Of equal
texts the row with the largest doc_id stays, and a null id is the smallest. Rows may repeat with
their ids. An empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinarium.functions.once import computed_once
from opinarium.llm.arrays import unused
from opinarium.session import stored

#: Bits for each row of the table.
BITS_PER_ROW = 64
#: Texts with a larger share of the rows are joined apart; there are fewer than 1000 of them.
HOT_SHARE = 0.001
#: Most bits of the filter that is sent to the whole rows: 2 ** 20 words of 64 bits.
ROW_FILTER_BITS = 1 << 26
#: Longest list of repeated texts that is sent to all tasks; a longer one meets only the rows that pass the filter.
BROADCAST_TEXTS = 100_000


def normalized(text: Column) -> Column:
    """The text with A-Z in lower case, and no other character changed."""
    text = F.coalesce(text, F.lit(""))
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def digested(docs: DataFrame, text: str = "text", digest: str = "text_sha256") -> DataFrame:
    """Adds the digest of the normalised text."""
    return computed_once(docs, {digest: F.sha2(normalized(F.col(text)).cast("binary"), 256)})


def _bits(digest: str, size: int) -> list[Column]:
    """The positions that a digest sets: its first and its second fifteen hexadecimal digits."""
    return [F.pmod(F.conv(F.substring(F.col(digest), at, 15), 16, 10).cast("long"), F.lit(size).cast("long"))
            for at in (1, 16)]


def repeated_bits(digests: DataFrame, size: int, digest: str = "text_sha256") -> DataFrame:
    """First pass: words of 64 bits in which the bits set more than once are set."""
    set_bits = digests.select(F.explode(F.array(*_bits(digest, size))).alias("bit"))
    twice = set_bits.groupBy("bit").agg(F.count("*").alias("n")).filter("n > 1")
    return twice.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask"))


def possibly_repeated(rows: DataFrame, words: DataFrame, size: int, digest: str = "text_sha256",
                      possible: str = "possible") -> DataFrame:
    """Second pass: adds ``possible``, true if both bits of a row were set more than once."""
    hits, marks = [], []
    for i, place in enumerate(_bits(digest, size)):
        word, mask, bit = unused([*rows.columns, possible], f"_word{i}", f"_mask{i}", f"_bit{i}")
        own = words.select(F.col("word").alias(word), F.col("mask").alias(mask))
        rows = rows.withColumn(bit, place).withColumn(word, F.shiftright(bit, 6)).join(own, word, "left")
        hits.append(F.expr(f"coalesce(shiftright(`{mask}`, cast(`{bit}` & 63 as int)) & 1L, 0L) = 1"))
        marks += [word, mask, bit]
    return rows.withColumn(possible, hits[0] & hits[1]).drop(*marks)


def _size(rows: int) -> int:
    return BITS_PER_ROW * max(1, rows)


def copy_groups(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256.

    Digests are computed once and written to the shared folder; texts are not shuffled.
    """
    rows = stored(digested(docs.select("doc_id", "text")).select("doc_id", "text_sha256"), "digests")
    total = rows.count()
    size = _size(total)
    words = stored(repeated_bits(rows, size), "repeated-bits")
    flagged = possibly_repeated(rows, words, size)
    apart = flagged.filter(~F.col("possible")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "text_sha256")
    possible = flagged.filter("possible").select("doc_id", "text_sha256")
    groups = stored(possible.groupBy("text_sha256").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "copy-groups")
    # Rows of the few most frequent texts are not shuffled for the join.
    least = max(1000, int(total * HOT_SHARE))
    hot = groups.filter(F.col("group_size") > least)
    named = possible.join(F.broadcast(hot), "text_sha256", "left")
    columns = ["doc_id", "keep_id", "group_size", "text_sha256"]
    often = named.filter("group_size is not null").select(*columns)
    seldom = named.filter("group_size is null").select("doc_id", "text_sha256") \
        .join(groups.filter(F.col("group_size") <= least), "text_sha256").select(*columns)
    return apart.unionByName(often).unionByName(seldom).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256")


def _filter_of(digests: DataFrame, size: int, digest: str) -> DataFrame:
    """The words of 64 bits that the digests set; there are at most size / 64 of them."""
    bits = digests.select(F.explode(F.array(*_bits(digest, size))).alias("bit"))
    return bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask"))


def repeated_texts(docs: DataFrame) -> DataFrame:
    """text_sha256, keep_id, n_rows, n_kept of every text that stands in more than one row; ``n_kept``
    of its rows have the id that stays. Only digests and ids are shuffled."""
    rows = stored(digested(docs.select("doc_id", "text")).select("doc_id", "text_sha256"), "digests")
    size = _size(rows.count())
    words = stored(repeated_bits(rows, size), "repeated-bits")
    per_id = possibly_repeated(rows, words, size).filter("possible").groupBy("text_sha256", "doc_id").agg(
        F.count("*").alias("n"))
    last = F.max(F.struct("doc_id", "n"))
    return per_id.groupBy("text_sha256").agg(
        last.getField("doc_id").alias("keep_id"), F.sum("n").alias("n_rows"), last.getField("n").alias("n_kept")
    ).filter("n_rows > 1")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents without copies, all columns as they were; exactly one row per text.

    What goes is decided on digests and ids. Whole rows are shuffled only if they pass a filter of
    the repeated texts and these are too many to broadcast, and then once; hot texts lose their copies
    before. Rows that repeat the id that stays are reduced, before and after a shuffle, to the largest
    by the other columns.
    """
    digest, keep, copies, possible, best = unused(docs.columns, "_digest", "_keep", "_copies", "_possible", "_row")
    rows = digested(docs, digest=digest)
    repeated = stored(repeated_texts(docs), "repeated-texts")
    known = repeated.select(F.col("text_sha256").alias(digest), F.struct("keep_id").alias(keep),
                            F.col("n_kept").alias(copies), "n_rows")
    facts = repeated.agg(F.count("*").alias("texts"), F.sum("n_rows").alias("rows"),
                         F.coalesce(F.max("n_kept"), F.lit(1)).alias("most")).first()

    def left(part: DataFrame, texts: DataFrame) -> DataFrame:
        """Rows whose text is not listed, or that have the id that stays."""
        found = part.join(texts.drop("n_rows"), digest, "left")
        return found.filter(F.col(keep).isNull() | F.col("doc_id").eqNullSafe(F.col(keep).getField("keep_id")))

    if facts["texts"] <= BROADCAST_TEXTS:
        found = left(rows, F.broadcast(known))
    else:
        least = max(1000, int(facts["rows"] * HOT_SHARE))
        hot, seldom = known.filter(F.col("n_rows") > least), known.filter(F.col("n_rows") <= least)
        size = min(ROW_FILTER_BITS, _size(facts["texts"]))
        words = F.broadcast(stored(_filter_of(seldom, size, digest), "row-filter"))
        cold = left(rows, F.broadcast(hot))
        listed = cold.filter(F.col(keep).isNotNull())
        flagged = possibly_repeated(cold.filter(F.col(keep).isNull()).drop(keep, copies), words, size, digest, possible)
        compared = left(flagged.filter(possible), seldom)
        found = compared.select(*listed.columns).unionByName(listed).unionByName(
            flagged.filter(~F.col(possible)).select(*rows.columns), allowMissingColumns=True)
    if facts["most"] == 1:
        return found.select(*docs.columns)
    once = F.coalesce(F.col(copies), F.lit(1)) == 1
    order = ["doc_id", *(c for c in docs.columns if c != "doc_id")]
    single = found.filter(~once).groupBy(digest).agg(F.max(F.struct(*order)).alias(best))
    return found.filter(once).select(*docs.columns).unionByName(single.select(f"{best}.*").select(*docs.columns))
