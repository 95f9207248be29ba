"""A Merkle manifest of a document table whose versions share all nodes that did not change.

Every row is a leaf. The leaves of a language, by ascending id, are the lowest level of a binary
tree whose top is the language's subroot; the subroots, by language, are the lowest level of the
tree that ends in the root. A level's nodes are hashed two by two, a last one alone.

Trees are built in aligned blocks of 1024 nodes (``BLOCK_BITS``): a block is one row of a table and one small
persistent tree in a task. The tops of the blocks are the nodes of the next table, so a tree of n
leaves takes log n to the base 1024 of them, and a hot language is many blocks like any other.

A changed leaf makes a version. Inside its block it copies the path from the leaf to the block's
top and shares every other node; above the block it goes on as a version of the upper tree, whose
shared nodes are handed down as one path per block, from the root to the leaves. No version is ever
gathered with another one, and nothing but the root reaches the driver.

Null columns count as ``-``, the null language comes first. Rows that repeat an id stand in the
order of their leaves, equal rows next to each other. A table without rows has no root and gives no
rows. Further columns are not part of a leaf and do not clash with any.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from opinarium.llm.arrays import mapped
from opinarium.operators.numbering import dense_numbers
from opinarium.session import stored

#: A block has up to two to the power of so many nodes.
BLOCK_BITS = 10

#: How a sibling on a path stands: before the node, or behind it. A node alone has an empty one.
BEFORE, BEHIND = "<", ">"


def _hashed(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


class PersistentBlock:
    """The nodes of one block, level by level. They never change; a version has copies of its own
    on one path."""

    def __init__(self, digests: list[str], height: int):
        self.levels = [digests]
        for _ in range(height):
            below = self.levels[-1]
            self.levels.append([_hashed(*below[i:i + 2]) for i in range(0, len(below), 2)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def shared(self, place: int) -> list[str]:
        """The siblings on the path from a leaf to the top: what a version of the leaf shares."""
        path = []
        for level in self.levels[:-1]:
            other = place ^ 1
            path.append("" if other >= len(level) else (BEFORE if place & 1 else BEHIND) + level[other])
            place >>= 1
        return path


def copied(digest: str, path: list[str]) -> list[str]:
    """The ancestors that a version with this leaf has copies of, lowest first."""
    copies = []
    for sibling in path:
        other = sibling[1:]
        digest = _hashed(other, digest) if sibling[:1] == BEFORE else _hashed(digest, other)
        copies.append(digest)
    return copies


def _height(total: int, bits: int) -> int:
    """Levels above the lowest one inside a block of a tree with so many nodes."""
    return min(bits, (total - 1).bit_length())


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """The digest of a row: every column as its length in bytes, a colon and its value."""
    return F.sha2(F.concat(*[_field(c) for c in (doc_id, source, lang, n_chars, text)]), 256)


def _group(lang: Column) -> Column:
    """Names a language; the null one sorts first."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit(""))


@dataclass
class Trees:
    """``levels[k]`` has one row per block: group, block, total, leaves; ``tops`` has the top node of
    every group's tree."""

    levels: list[DataFrame]
    tops: DataFrame
    bits: int


def _block_rows(nodes: DataFrame, bits: int) -> DataFrame:
    rest = [c for c in nodes.columns if c not in ("group", "index", "total")]
    return nodes.groupBy("group", F.shiftright("index", bits).alias("block")).agg(
        F.first("total").alias("total"), F.array_sort(F.collect_list(F.struct("index", *rest))).alias("leaves"))


def _tree_of(row: dict, bits: int) -> PersistentBlock:
    return PersistentBlock([leaf["digest"] for leaf in row["leaves"]], _height(row["total"], bits))


def _block_tops(blocks: DataFrame, bits: int) -> DataFrame:
    """The next table's nodes: group, index, total, digest."""
    schema = "group string, index long, total long, digest string"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_arrays([
                pa.array([r["group"] for r in rows], pa.string()), pa.array([r["block"] for r in rows], pa.int64()),
                pa.array([-(-r["total"] >> bits) for r in rows], pa.int64()),
                pa.array([_tree_of(r, bits).top for r in rows], pa.string())], ["group", "index", "total", "digest"])

    narrow = blocks.select("group", "block", "total", F.transform("leaves", lambda x: F.struct(
        x["digest"].alias("digest"))).alias("leaves"))
    return mapped(narrow, run, schema)


def grown(nodes: DataFrame, bits: int = BLOCK_BITS) -> Trees:
    """The trees over ``nodes`` (group, index, total, digest and further columns), one per group."""
    levels, tops = [], None
    while True:
        blocks = stored(_block_rows(nodes, bits), "merkle-blocks")
        made = stored(_block_tops(blocks, bits), "merkle-nodes")
        done = made.filter("total = 1").select("group", "digest")
        levels.append(blocks)
        tops = done if tops is None else tops.unionByName(done)
        nodes = made.filter("total > 1")
        if nodes.isEmpty():
            return Trees(levels, tops, bits)


def _with_paths(trees: Trees, above: DataFrame) -> DataFrame:
    """The lowest blocks with ``path``, the siblings from the block's top to the root, and
    ``subroot``. ``above`` has both for every group's top node."""
    found = None
    for blocks in reversed(trees.levels):
        here = blocks.filter(F.col("total") <= 1 << trees.bits).join(above, "group")
        if found is not None:
            paths = stored(_handed_down(found, trees.bits), "merkle-paths").withColumnRenamed("index", "block")
            here = here.unionByName(blocks.filter(F.col("total") > 1 << trees.bits).join(paths, ["group", "block"]))
        found = here
    return found


def _handed_down(blocks: DataFrame, bits: int) -> DataFrame:
    """For every node of the blocks: group, index, path to the root, subroot."""
    schema = "group string, index long, path array<string>, subroot string"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tree, leaves = _tree_of(row, bits), row["leaves"]
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["group"]] * len(leaves), pa.string()),
                    pa.array([leaf["index"] for leaf in leaves], pa.int64()),
                    pa.array([tree.shared(i) + row["path"] for i in range(len(leaves))], pa.list_(pa.string())),
                    pa.array([row["subroot"]] * len(leaves), pa.string())], ["group", "index", "path", "subroot"])

    return mapped(blocks.select("group", "total", "leaves", "path", "subroot"), run, schema)


@dataclass
class Manifest:
    """The leaves of the languages, the tree over their subroots, and the root (None without rows)."""

    languages: Trees
    upper: Trees
    root: str | None


def manifest(leaves: DataFrame, order: list[str], bits: int = BLOCK_BITS) -> Manifest:
    """The manifest of a stored table with ``group``, ``digest``, the columns of ``order`` and
    further ones, which the leaf blocks keep."""
    languages = grown(dense_numbers(leaves, [*order, "digest"], "index", ["group"], total="total"), bits)
    subroots = stored(languages.tops, "merkle-subroots")
    ranked = dense_numbers(subroots.withColumnRenamed("group", "lang"), ["lang"], "index", total="total")
    upper = grown(ranked.withColumn("group", F.lit("")), bits)
    top = upper.tops.first()
    return Manifest(languages, upper, top["digest"] if top else None)


def versions(made: Manifest, changed: str, key: str, kind: T.DataType) -> DataFrame:
    """Every leaf as a version of the manifest whose digest is that in column ``changed``, or, where
    that is null, the leaf's own.

    Per leaf: ``key``, group, index, leaf, subroot, proof_sha256 (digest of the shared siblings from
    the leaf to the root), folded_root (the version's root) and copied_nodes (the nodes it has of its
    own).
    """
    lang_of = made.upper.levels[0].select(F.explode("leaves").alias("leaf")).select(
        F.col("leaf.index").alias("index"), F.col("leaf.lang").alias("lang"), F.col("leaf.digest").alias("_own"))
    top_path = made.upper.tops.select("group", F.array().cast("array<string>").alias("path"),
                                      F.col("digest").alias("subroot"))
    ways = stored(_handed_down(_with_paths(made.upper, top_path), made.upper.bits), "merkle-subroot-paths")
    above = stored(ways.select("index", "path").join(lang_of, "index").select(
        F.col("lang").alias("group"), "path", F.col("_own").alias("subroot")), "merkle-above")
    blocks = _with_paths(made.languages, above)
    schema = T.StructType([T.StructField(key, kind)]).add("group", T.StringType()).add("index", T.LongType()) \
        .add("leaf", T.StringType()).add("subroot", T.StringType()).add("proof_sha256", T.StringType()) \
        .add("folded_root", T.StringType()).add("copied_nodes", T.LongType())
    kinds, bits = [to_arrow_type(f.dataType) for f in schema], made.languages.bits

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(len(batch)):
                row = batch.slice(start, 1).to_pylist()[0]
                tree, out = _tree_of(row, bits), []
                upper: dict[str, list[str]] = {}  # what versions with this block top have above it
                for place, leaf in enumerate(row["leaves"]):
                    inside = tree.shared(place)
                    proof = _hashed(*(s[1:] for s in inside), *(s[1:] for s in row["path"]))
                    digest = leaf[changed] or leaf["digest"]
                    copies = copied(digest, inside)
                    top = copies[-1] if copies else digest
                    if top not in upper:
                        upper[top] = copied(top, row["path"])
                    copies += upper[top]
                    out.append((leaf[key], row["group"], leaf["index"], leaf["digest"], row["subroot"], proof,
                                copies[-1] if copies else digest, len(copies) + 1 if leaf[changed] else 0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)], schema.names)

    return mapped(blocks.select("group", "total", "leaves", "path", "subroot"), run, schema)


def tampered_chars(doc_id: Column, n_chars: Column, every: int) -> Column:
    """``n_chars`` one higher where ``every`` divides the checksum of the id, else null."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % every == 0
    return F.when(hit, n_chars.cast("decimal(38,0)") + 1)


def verified_manifest(docs: DataFrame, every: int = 7, bits: int = BLOCK_BITS) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, copied_nodes.

    Rows whose id's checksum ``every`` divides are tampered with: one more in n_chars (a null
    stays). Each such row is a version of its own, and its root is checked against the manifest's.
    """
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    plain = [F.col(c) for c in names]
    chars = tampered_chars(F.col("doc_id"), F.col("n_chars"), every)
    other = leaf_digest(plain[0], plain[1], plain[2], chars, plain[4])
    leaves = stored(docs.select(*names).select(
        _group(F.col("lang")).alias("group"), "doc_id", leaf_digest(*plain).alias("digest"),
        F.when(chars.isNotNull(), other).alias("changed")), "merkle-leaves")
    made = manifest(leaves, ["doc_id"], bits)
    found = versions(made, "changed", "doc_id", docs.schema["doc_id"].dataType)
    root = F.lit(made.root).cast("string")
    return found.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
                        (F.col("folded_root") == root).alias("verified"), "copied_nodes")
