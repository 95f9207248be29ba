"""Near-duplicate documents by MinHash.

Every text becomes its set of word shingles. Many universal hash functions are applied to the
shingles, their minima form the signature, and equal bands of minima make texts candidates. Texts
with equal sets are one node from then on. Candidates are checked by their signatures, and those
that pass by their whole sets, computed again from the texts. Components of the confirmed links
come from alternating star steps.

No bucket emits all its pairs. First, every member is compared with one leader, the member that
meets most others in its buckets. If all members turn out to be of the leader's component, no further
pair can matter. Otherwise the members outside of it, the strays, are compared with the members of
other components: as pairs where a bucket has few of them, and block by block inside tasks, without a
row per pair, for the families of texts that large buckets connect.

A pair at the threshold shares no band with probability ``(1 - 0.8 ** ROWS) ** BANDS``, 5e-6.

Null and empty texts have no shingles and no links. A text with fewer words than a shingle has one
shingle. Rows may repeat, ids too; a null id is never the smallest. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinarium.llm.arrays import mapped, END, Block, blocks, byte_class, mixed, per_row, span_hashes, spans
from opinarium.llm.components import components
from opinarium.session import stored, stored_at

WORDS = 5
SIMILARITY = 80
BANDS, ROWS = 40, 6
#: Candidates whose signatures agree in a smaller share are not compared. At similarity 0.8 the
#: share is below this for one pair in a billion.
SIGNATURE_SHARE = 0.64
#: Up to so many rows, a list of rows to look up is broadcast.
BROADCAST_ROWS = 200_000
#: Buckets with more pairs of a stray and a member are compared in blocks.
PAIRS_OF_BUCKET = 256
#: Texts of one side of a block on average.
BLOCK_TEXTS = 256

_BETWEEN = np.ones(256, dtype=bool) & ~byte_class((0x20, 0x20), (0x09, 0x0D), (END, END))
_random = np.random.default_rng(20240229)
_A = _random.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _random.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_STEP = np.uint64(0x9FB21C651E98DF25)


def shingle_sets(block: Block, words: int) -> list[np.ndarray]:
    """The sorted distinct shingles of every row, as 64-bit hashes. A-Z counts as a-z."""
    block = block.lowered()
    starts, ends = spans(block.data, _BETWEEN)
    hashes = span_hashes(block.data, starts, ends)
    first = per_row(block, starts)
    run = mixed(hashes ^ np.uint64(words))
    count = max(0, len(hashes) - words + 1)
    shingles = run[:count]
    for i in range(1, words):
        shingles = mixed(shingles * _STEP + hashes[i:i + count])
    sets = []
    for a, b in zip(first, first[1:]):
        if b - a >= words:
            sets.append(np.unique(shingles[a:b - words + 1]))
        elif b > a:
            value = mixed(hashes[a:a + 1] ^ np.uint64((1 << 32) + (b - a)))
            for i in range(a + 1, b):
                value = mixed(value * _STEP + hashes[i:i + 1])
            sets.append(value)
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function a * x + b over the shingles."""
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(_A), 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(values), 1024):
        hashed = np.multiply.outer(_A, values[at:at + 1024])
        hashed += _B[:, None]
        np.minimum(best, hashed.min(axis=1), out=best)
    return best


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, node, bands and signature (null without words).

    ``node`` names the set: two sums over its shingles. ``signature`` has eight bits of each minimum.
    """
    schema = T.StructType([docs.schema["doc_id"]]).add("text_hash", T.LongType()) \
        .add("n_shingles", T.LongType()).add("node", T.BinaryType()) \
        .add("bands", T.ArrayType(T.LongType())).add("signature", T.BinaryType())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                sets = shingle_sets(block, words)
                table = np.stack([minima(s) for s in sets])
                keys = np.zeros((len(sets), BANDS), dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
                for i in range(ROWS):
                    keys = mixed(keys * _STEP + table[:, i::ROWS])
                low = mixed(table.astype(np.uint64)).astype(np.uint8)
                full = [len(s) > 0 for s in sets]
                nodes = [np.array([mixed(s).sum(), mixed(s * _STEP + np.uint64(1)).sum()], dtype=np.uint64).tobytes()
                         if f else None for s, f in zip(sets, full)]
                kept = batch.slice(block.first, len(block))
                yield pa.RecordBatch.from_arrays([
                    kept.column("doc_id"), kept.column("text_hash"),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.binary()),
                    pa.array([k if f else None for k, f in zip(keys.view(np.int64), full)], pa.list_(pa.int64())),
                    pa.array([r.tobytes() if f else None for r, f in zip(low, full)], pa.binary()),
                ], schema.names)

    return mapped(_with_text_hash(docs).select("doc_id", "text_hash", "text"), run, schema)


def _with_text_hash(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text_hash", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))


def _buckets(sets: DataFrame) -> DataFrame:
    """``bucket``, ``leader`` and ``node``, for buckets of several nodes. The leader is the member
    with the most members in all its buckets."""
    nodes = sets.filter("node is not null").groupBy("node").agg(F.first("bands").alias("bands"))
    members = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = stored(members.join(sizes, "bucket"), "near-members")
    met = members.groupBy("node").agg(F.sum("n").alias("met"))
    leaders = members.join(met, "node").groupBy("bucket").agg(F.max(F.struct("met", "node")).alias("most"))
    return members.select("bucket", "node").join(leaders.select("bucket", F.col("most.node").alias("leader")), "bucket")


def _agreeing(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures agree often enough."""
    signatures = sets.filter("node is not null").groupBy("node").agg(F.first("signature").alias("s"))
    both = pairs
    for side in ("a", "b"):
        both = both.join(signatures.select(F.col("node").alias(side), F.col("s").alias(f"s{side}")), side)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(len(batch), -1)
                           for c in ("sa", "sb"))
            share = (left == right).mean(axis=1)
            yield batch.filter(pa.array(share >= SIGNATURE_SHARE)).select(["a", "b"])

    return mapped(both.select("a", "b", "sa", "sb"), run, "a binary, b binary")


def _texts(nodes: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """One text for each of the distinct ``nodes``, written once."""
    rows = sets.filter("node is not null").join(nodes, "node").groupBy("node") \
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("row"))
    rows = stored(rows.select("node", F.col("row.doc_id").alias("_id"), F.col("row.text_hash").alias("_hash")),
                  "near-rows")
    if rows.count() <= BROADCAST_ROWS:
        rows = F.broadcast(rows)
    hashed = _with_text_hash(docs.select("doc_id", "text"))
    found = hashed.join(rows, (F.col("text_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    return stored(found.groupBy("node").agg(F.first("text").alias("text")), "near-texts")


def _confirmed(pairs: DataFrame, sets: DataFrame, docs: DataFrame, words: int, similarity: int) -> DataFrame:
    """The pairs (a, b) of stored ``pairs`` whose whole sets are similar enough."""
    texts = _texts(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), sets, docs)
    both = pairs
    for side in ("a", "b"):
        both = both.join(texts.select(F.col("node").alias(side), F.col("text").alias(f"t{side}")), side)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.slice(at, 64)
                left, right = ([s for block in blocks(part.column(c)) for s in shingle_sets(block, words)]
                               for c in ("ta", "tb"))
                linked = [_similar(x, y, similarity) for x, y in zip(left, right)]
                yield part.filter(pa.array(linked)).select(["a", "b"])

    return mapped(both.select("a", "b", "ta", "tb"), run, "a binary, b binary")


def _similar(x: np.ndarray, y: np.ndarray, similarity: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= similarity * (len(x) + len(y) - common)


def _placed(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """Adds the component of the node (``own``) and of the leader (``main``); only buckets of several
    components stay. ``size`` and ``strays`` count their members, and those outside of ``main``."""
    named = buckets
    for column, component in (("node", "own"), ("leader", "main")):
        root = roots.select(F.col("node").alias(column), F.col("root").alias(component))
        named = named.join(root, column, "left").withColumn(component, F.coalesce(component, column))
    named = stored(named, "near-placed")
    counts = named.groupBy("bucket").agg(F.count("*").alias("size"),
                                         F.sum((F.col("own") != F.col("main")).cast("long")).alias("strays"))
    return stored(named.join(counts.filter("strays > 0"), "bucket"), "near-mixed")


def _stray_pairs(mixed_buckets: DataFrame) -> DataFrame:
    """Pairs of a stray and a member of another component; the leader was compared before."""
    strays = mixed_buckets.filter("own <> main")
    others = mixed_buckets.select("bucket", F.col("node").alias("other"), F.col("own").alias("theirs"),
                                  (F.col("own") != F.col("main")).alias("stray"))
    pairs = strays.join(others, "bucket").filter(
        (F.col("own") != F.col("theirs")) & (F.col("other") != F.col("leader"))
        & (~F.col("stray") | (F.col("node") < F.col("other"))))
    return pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _block_links(large: DataFrame, sets: DataFrame, docs: DataFrame, words: int, similarity: int) -> DataFrame:
    """Links (a, b) of strays and members of other components, for buckets with many of both.

    Buckets that share texts form a family. Its strays and its members are dealt to parts, and every
    part of strays meets every part of members in a group of its own, whose size is bounded. A link
    per stray and component is enough.
    """
    family = components(large.select(F.col("leader").alias("a"), F.col("node").alias("b")))
    nodes = large.groupBy("node").agg(F.first("own").alias("own"), F.max((F.col("own") != F.col("main"))).alias("stray"))
    nodes = nodes.join(family, "node", "left").select("node", "own", "stray", F.coalesce("root", "node").alias("family"))
    nodes = stored(nodes, "near-families")
    parts = nodes.groupBy("family").agg(
        F.ceil(F.count("*") / BLOCK_TEXTS).alias("member_parts"),
        F.ceil(F.sum(F.col("stray").cast("long")) / BLOCK_TEXTS).alias("stray_parts"))
    signatures = sets.filter("node is not null").join(nodes.select("node"), "node", "left_semi") \
        .groupBy("node").agg(F.first("signature").alias("signature"))
    rows = nodes.join(parts.filter("stray_parts > 0"), "family").join(_texts(nodes.select("node"), sets, docs), "node") \
        .join(signatures, "node")
    rows, folder = stored_at(rows, "near-family-texts")
    strays = rows.sparkSession.read.schema(rows.schema).parquet(folder).filter("stray")

    def dealt(frame: DataFrame, own: str, other: str) -> DataFrame:
        whole = F.pmod(F.xxhash64("node"), F.col(f"{own}_parts")).alias(f"{own}_part")
        return frame.select("family", whole, F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}_parts") - 1))
                            .alias(f"{other}_part"), "node", "own", "signature", "text")

    keys = ["family", "member_part", "stray_part"]

    def compare(strays: pa.Table, members: pa.Table) -> pa.Table:
        out: list[tuple[bytes, bytes]] = []
        if len(strays) and len(members):
            (ours, own, sign, sets_a), (theirs, their, signs, sets_b) = (
                (t.column("node").to_pylist(), t.column("own").to_pylist(),
                 np.frombuffer(b"".join(t.column("signature").to_pylist()), np.uint8).reshape(len(t), -1),
                 [s for block in blocks(t.column("text")) for s in shingle_sets(block, words)])
                for t in (strays, members))
            for i, node in enumerate(ours):
                linked = {own[i]}
                for j in np.flatnonzero((signs == sign[i]).mean(axis=1) >= SIGNATURE_SHARE).tolist():
                    if their[j] not in linked and _similar(sets_a[i], sets_b[j], similarity):
                        linked.add(their[j])
                        out.append((node, theirs[j]))
        return pa.table([pa.array([x[k] for x in out], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return stored(dealt(strays, "stray", "member").groupBy(*keys).cogroup(dealt(rows, "member", "stray").groupBy(*keys))
                  .applyInArrow(compare, "a binary, b binary"), "near-links")


def similar_links(docs: DataFrame, sets: DataFrame, words: int, similarity: int) -> DataFrame:
    """``node`` and ``root`` for all nodes that are linked with a smaller one."""
    buckets = stored(_buckets(sets), "near-buckets")

    def link(pairs: DataFrame) -> DataFrame:
        agreeing = stored(_agreeing(pairs, sets), "near-pairs")
        return stored(_confirmed(agreeing, sets, docs, words, similarity), "near-links")

    links = link(buckets.filter("leader <> node").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct())
    roots = components(links)

    def with_more(more: DataFrame) -> DataFrame:
        """Components of all links so far: the known ones are stars already, so few steps are left."""
        return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))

    # Split once: a bucket that the first of the two ways has made smaller stays with the second.
    placed = _placed(buckets, roots)
    pairs_of_bucket = F.col("size") * F.col("strays")
    small = placed.filter(pairs_of_bucket <= PAIRS_OF_BUCKET)
    if not small.isEmpty():
        roots = with_more(link(_stray_pairs(small)))
    large = placed.filter(pairs_of_bucket > PAIRS_OF_BUCKET).select("bucket", "leader", "node")
    if not large.isEmpty():
        large = _placed(large, roots)
    if not large.isEmpty():
        roots = with_more(_block_links(large, sets, docs, words, similarity))
    return roots


def near_groups(docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, node, component_id, kept."""
    sets = stored(_sets(docs, words), "near-sets")
    roots = similar_links(docs, sets, words, similarity)
    least = sets.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = least.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = named.join(smallest, "root").select("node", "component_id")
    return sets.select("doc_id", "text_hash", "n_shingles", "node").join(labels, "node", "left") \
        .withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))) \
        .select("doc_id", "text_hash", "n_shingles", "node", "component_id",
                F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """The documents but those similar to a kept one, all columns as they were.

    Of each component the document with the smallest id stays; if several texts share that id, the
    one with the smallest hash of its text. Rows that repeat both id and text are one document.
    """
    groups = near_groups(docs, words, similarity)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash"))
    linked = stored(groups.filter("node is not null"), "near-groups")
    best = linked.groupBy("component_id").agg(F.min(order).alias("best"))
    gone = linked.join(best, linked["component_id"].eqNullSafe(best["component_id"])).filter(order != F.col("best"))
    gone = stored(gone.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "near-gone")
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    text_hash = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(gone, (text_hash == gone["_hash"]) & docs["doc_id"].eqNullSafe(gone["_id"]), "left_anti")
