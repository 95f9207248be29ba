"""Approximate nearest neighbours by cosine with multi-probe p-stable hashing.

Vectors of length one are projected on normal directions, shifted and cut into cells of width
``WIDTH``; ``HASHES`` cells name a bucket of a table, and there are ``TABLES`` tables. A query visits
its own bucket of each table, then ``PROBES - 1`` neighbouring ones in the order of estimated success,
that is by the summed squared distances to the cell walls crossed. Everything found in any table is
ranked by its exact cosine: matrix products find what can be among the nearest, and the score of each
such pair is summed by itself in one fixed order, so equal vectors get equal scores.

Buckets with many vectors are split, and a query goes to all parts. Parts of many buckets share a
group of bounded size, in which scores are matrix products. Of equal vectors only as many as can be
among the nearest are indexed, those with the smallest ids. A query that finds fewer than it should
is compared with all vectors, block by block.

Vectors that are null, zero, or hold null or non-finite components take no part; vectors of
different lengths are not compared. Equal scores rank by id. Rows that repeat an id and its vector are
one; a null id takes no part. An empty table gives no rows. Further columns are not used.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinarium.llm.arrays import mapped
from opinarium.session import stored

TABLES, HASHES, WIDTH, PROBES = 4, 8, 3.0, 60
#: Vectors of one part of a bucket, and of one group of parts, on average.
PART_ROWS = 4096
GROUP_ROWS = 16384
#: Cosines out of matrix products are off by less than this.
MARGIN = 1e-9
#: Numbers held at once while pairs are scored.
PAIR_NUMBERS = 1 << 22


def usable(vector: Column) -> Column:
    """Whether all components are finite numbers and not all are zero."""
    value = vector.cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & (F.abs(F.coalesce(x, F.lit(0.0))) < float("inf")))
    return F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """The vectors with a largest component between 0.5 and 1, divided by powers of two, so exactly."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -exponent)


def _norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


def _pair_scores(left: np.ndarray, left_norms: np.ndarray, who: np.ndarray,
                 right: np.ndarray, right_norms: np.ndarray, whom: np.ndarray) -> np.ndarray:
    """The cosine of each pair of rows. It depends on the two vectors alone, not on their places."""
    out = np.empty(len(who))
    step = max(1, PAIR_NUMBERS // max(1, left.shape[1]))
    for at in range(0, len(who), step):
        a, b = who[at:at + step], whom[at:at + step]
        out[at:at + step] = (left[a] * right[b]).sum(axis=1) / (left_norms[a] * right_norms[b])
    return out


class Tables:
    """The hash functions for vectors of one length; the same everywhere."""

    def __init__(self, length: int):
        random = np.random.default_rng(length)
        self.directions = random.standard_normal((length, TABLES * HASHES))
        self.shifts = random.random(TABLES * HASHES) * WIDTH
        self.factors = random.integers(1, 1 << 62, (TABLES, HASHES)) * 2 + 1

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """Fractional cell numbers: rows x tables x hashes."""
        return ((unit @ self.directions + self.shifts) / WIDTH).reshape(len(unit), TABLES, HASHES)

    def keys(self, whole: np.ndarray) -> np.ndarray:
        """One number per bucket: rows x tables."""
        with np.errstate(over="ignore"):
            return (whole.astype(np.int64) * self.factors).sum(axis=2) + np.arange(TABLES)

    def probes(self, cells: np.ndarray, count: int) -> np.ndarray:
        """The keys to visit for one query, best estimated first: ``count`` per table."""
        whole = np.floor(cells)
        inside = cells - whole
        base = self.keys(whole[None])[0]
        out = []
        for t in range(TABLES):
            cost = np.concatenate([inside[t] ** 2, (1 - inside[t]) ** 2])
            move = np.concatenate([-self.factors[t], self.factors[t]])
            order = np.argsort(cost, kind="stable")
            cost, move, axis = cost[order].tolist(), move[order].tolist(), (order % HASHES).tolist()
            found, queue = [0], [(cost[0], (0,))]
            while queue and len(found) < count:
                total, chosen = heapq.heappop(queue)
                last = chosen[-1]
                if last + 1 < len(cost):
                    more = total + cost[last + 1]
                    heapq.heappush(queue, (more - cost[last], (*chosen[:-1], last + 1)))
                    heapq.heappush(queue, (more, (*chosen, last + 1)))
                if len({axis[i] for i in chosen}) == len(chosen):
                    found.append(sum(move[i] for i in chosen))
            out += [_wrapped(int(base[t]) + f) for f in found]
        return np.array(out, dtype=np.int64)


def _wrapped(value: int) -> int:
    """The value as a signed 64-bit number."""
    return (int(value) + (1 << 63)) % (1 << 64) - (1 << 63)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    lengths = np.array([len(v) for v in batch.column("vector")])
    for length in np.unique(lengths):
        part = batch.filter(pa.array(lengths == length))
        yield part, _unit(_matrix(part.column("vector")))


def _hashed(vectors: DataFrame, probes: int | None) -> DataFrame:
    """(id, keys): the bucket of each table, or the buckets that a query visits."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, Tables] = {}
        for batch in batches:
            if not len(batch):
                continue
            for part, unit in _by_length(batch):
                own = tables.setdefault(unit.shape[1], Tables(unit.shape[1]))
                cells = own.cells(unit)
                if probes is None:
                    keys = list(own.keys(np.floor(cells)))
                else:
                    keys = [own.probes(c, probes) for c in cells]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("vector"), pa.array(keys, pa.list_(pa.int64()))],
                    ["id", "vector", "keys"])

    return mapped(vectors.select("id", "vector"), run, "id long, vector array<double>, keys array<long>")


def _first(who: np.ndarray, found: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The places of the ``k`` largest scores of each query, ties to smaller ids; an id counts once."""
    order = np.lexsort((found, -scores, who))
    once = np.ones(len(order), dtype=bool)
    once[1:] = (np.diff(who[order]) != 0) | (np.diff(found[order]) != 0)
    order = order[once]
    place = np.arange(len(order)) - np.searchsorted(who[order], who[order])
    return order[place < k]


def _nearest(index: pa.Table, queries: pa.Table, k: int) -> Iterator[pa.Table]:
    """The best ``k`` of each query among the vectors whose bucket it visits, within one group."""
    lengths = pc.list_value_length(index.column("vector")).to_numpy()
    query_lengths = pc.list_value_length(queries.column("vector")).to_numpy()
    for length in np.intersect1d(lengths, query_lengths):
        rows = index.filter(pa.array(lengths == length)).combine_chunks()
        asked = queries.filter(pa.array(query_lengths == length)).combine_chunks()
        exact = _scaled(_matrix(rows.column("vector").combine_chunks()))
        exact_wanted = _scaled(_matrix(asked.column("vector").combine_chunks()))
        ids, query_ids = rows.column("id").to_numpy(), asked.column("id").to_numpy()
        keys = rows.column("key").to_numpy()
        order = np.lexsort((ids, keys))
        ids, keys, exact = ids[order], keys[order], exact[order]
        norms, wanted_norms = _norms(exact), _norms(exact_wanted)
        vectors, wanted = exact / norms[:, None], exact_wanted / wanted_norms[:, None]
        visits = asked.column("keys").combine_chunks()
        visit_key = visits.flatten().to_numpy()
        visit_row = np.repeat(np.arange(len(asked)), np.diff(visits.offsets.to_numpy()))
        order = np.argsort(visit_key, kind="stable")
        visit_key, visit_row = visit_key[order], visit_row[order]
        names, first = np.unique(visit_key, return_index=True)
        low, high = np.searchsorted(keys, names), np.searchsorted(keys, names, side="right")
        out: list[list[np.ndarray]] = [[], [], []]
        for a, b, v, w in zip(low, high, first, np.append(first[1:], len(visit_key))):
            if a == b:
                continue
            who = visit_row[v:w]
            scores = wanted[who] @ vectors[a:b].T
            scores[query_ids[who][:, None] == ids[None, a:b]] = -np.inf
            if b - a > k:
                least = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
                hit, column = np.nonzero((scores >= least - MARGIN) & (scores > -np.inf))
            else:
                hit, column = np.nonzero(scores > -np.inf)
            scores = _pair_scores(exact_wanted, wanted_norms, who[hit], exact, norms, a + column)
            best = _first(who[hit], ids[a + column], scores, k)
            for part, values in zip(out, (who[hit], ids[a + column], scores)):
                part.append(values[best])
        if out[0]:
            who, found, scores = (np.concatenate(x) for x in out)
            best = _first(who, found, scores, k)
            yield pa.table([query_ids[who[best]], found[best], scores[best]], names=["query_id", "vec_id", "score"])


def _compared(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Compares index rows (group, key, id, vector) with queries (group, keys, id, vector)."""
    schema = "query_id long, vec_id long, score double"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = list(_nearest(left, right, k)) if len(left) and len(right) else []
        empty = pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())],
                         names=["query_id", "vec_id", "score"])
        return pa.concat_tables([empty, *found])

    return index.groupBy("group").cogroup(queries.groupBy("group")).applyInArrow(run, schema)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 5, probes: int = PROBES) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row of ``vectors`` (id, vector)
    that ``is_query`` holds for."""
    good = vectors.filter(F.col("id").isNotNull() & usable(F.col("vector"))).select(
        F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asked"))
    # Of equal vectors, one more than can be among the nearest: the query may be one of them.
    # The limit on the window's places works in every task before the shuffle, so a vector that very
    # many rows share sends k + 1 of them per task.
    same = Window.partitionBy("vector").orderBy("id")
    distinct = good.select("id", "vector").distinct()
    indexed = stored(distinct.withColumn("place", F.row_number().over(same)).filter(F.col("place") <= k + 1)
                     .drop("place"), "vectors")
    asked = stored(good.filter("asked").select("id", "vector").distinct(), "queries")
    total = indexed.count()

    keyed = stored(_hashed(indexed, None).select("id", "vector", F.explode("keys").alias("key")), "vector-buckets")
    sizes = keyed.groupBy("key").count()
    parts = stored(sizes.select("key", F.ceil(F.col("count") / PART_ROWS).alias("parts")), "bucket-parts")
    large = parts.filter("parts > 1")
    groups = max(1, -(-total * TABLES // GROUP_ROWS))

    def grouped(key: str, part: Column) -> Column:
        return F.pmod(F.xxhash64(F.col(key), part), F.lit(groups)).alias("group")

    rows = keyed.join(large, "key", "left").withColumn(
        "part", F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1)))).select(
        grouped("key", F.col("part")), "key", "id", "vector")
    visits = _hashed(asked, probes).select("id", F.explode("keys").alias("key")).join(parts, "key")
    visits = visits.select("id", "key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    visits = visits.select("id", "key", grouped("key", F.col("part"))).groupBy("id", "group").agg(
        F.collect_set("key").alias("keys"))
    queries = visits.join(asked.select("id", "vector"), "id").select("group", "keys", "id", "vector")
    found = stored(_ranked(_compared(rows, queries, k), k), "nearest")

    counts = found.groupBy("query_id").count()
    short = asked.join(counts, F.col("id") == F.col("query_id"), "left").filter(
        F.coalesce("count", F.lit(0)) < k).select("id", "vector")
    # Queries that found too few, if there may be more to find, meet all vectors in blocks.
    short = stored(short, "short-queries")
    if short.isEmpty():
        return found.select("query_id", "rank", "vec_id", "score")
    blocks_ = max(1, -(-total // GROUP_ROWS))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks_)).alias("group")
    everywhere = short.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks_ - 1).cast("long"))).alias("group"),
                              F.array(F.lit(0).cast("long")).alias("keys"), "id", "vector")
    all_rows = indexed.select(block.cast("long").alias("group"), F.lit(0).cast("long").alias("key"), "id", "vector")
    rest = _ranked(_compared(all_rows, everywhere, k), k)
    done = found.join(short.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti")
    return done.unionByName(rest).select("query_id", "rank", "vec_id", "score")
