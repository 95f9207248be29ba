"""Exact-size random and stratified samples.

A row's place in the random order is a seeded hash of its key, so a sample does not depend
on how the data is partitioned. The rows that a stratum gives are always the first ones in
this order, so a sample is described by one hash bound per stratum, and drawing it is a
filter. The bounds are found without sorting a stratum: its order is cut into cells by the
leading hex digits of the hash, and rows are counted per cell. A cell that a bound falls into is cut
by its next digits and counted again, until it is small; only then its hashes are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opinarium.functions.measures import pct
from opinarium.functions.text import is_blank
from opinarium.schemas import DEFAULT_SAMPLE_SIZE, DEFAULT_SEED, DEFAULT_STRATA
from opinarium.session import stored

CELL_DIGITS = 3
HASH_DIGITS = 32
# Rows of a cell, over all strata, that one task may order.
CELL_ROWS = 65_536
# Without strata, the first hashes of a sample up to this size are taken in one pass.
SMALL_SAMPLE = 100
_EXPLODE_STEP = 65_536
# Sorts after every hex digit.
AFTER_ALL = "~"


def order_hash(df: DataFrame, seed: int, key: Sequence[str] | None) -> Column:
    """Seeded hash of the key columns, or of the whole row if no key is given."""
    if key:
        parts = [F.col(c).cast("string") for c in key]
    else:
        parts = [F.to_json(F.struct(*df.columns))]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def _clip(value: Column, top: Column) -> Column:
    return F.greatest(F.lit(0), F.least(value, top))


def _before(column: str, spec) -> Column:
    """Sum of a column over all earlier rows."""
    earlier = spec.rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(earlier), F.lit(0))


def _allocate(cells: DataFrame, strata: Sequence[str], n: int) -> DataFrame:
    """How many rows each (stratum, cell) gives to the sample.

    Tier 0 are the rows inside their stratum's quota, tier 1 all others. The sample is the
    first ``n`` rows by tier and hash: quotas that add up to more than ``n`` are trimmed and
    a shortfall is filled from tier 1. Rows with a null stratum are always tier 1.

    ``_take`` is the number of tier 0 rows of the cell in this stratum. ``_size0`` and
    ``_size1`` count the rows of a tier in this cell over all strata, ``_limit0`` and
    ``_limit1`` those of them that are in the sample.
    """
    count, take = F.col("_count"), F.col("_take")
    everything = W.partitionBy(F.lit(0))
    if strata:
        whole = cells.agg(F.sum("_count")).scalar()
        fraction = F.least(F.lit(float(n)) / whole, F.lit(1.0))
        by_stratum = W.partitionBy(*strata)
        named = F.lit(True)
        for name in strata:
            named = named & F.col(name).isNotNull()
        quota = F.bround(fraction * F.sum("_count").over(by_stratum), 0).cast("bigint")
        inside = _clip(quota - _before("_count", by_stratum.orderBy("_cell")), count)
        cells = cells.withColumn("_take", F.when(named, inside).otherwise(F.lit(0)))
    else:
        cells = cells.withColumn("_take", F.lit(0).cast("bigint"))

    # One row per cell, so at most 16 ** CELL_DIGITS rows are ordered and broadcast.
    tiers = cells.groupBy("_cell").agg(
        F.sum("_take").alias("_size0"), F.sum(count - take).alias("_size1"))
    in_order = everything.orderBy("_cell")
    quotas = F.sum("_size0").over(everything)
    tiers = tiers.select(
        "_cell", "_size0", "_size1",
        _clip(n - _before("_size0", in_order), F.col("_size0")).alias("_limit0"),
        _clip(n - quotas - _before("_size1", in_order), F.col("_size1")).alias("_limit1"),
    )
    return cells.join(F.broadcast(tiers), "_cell")


def _same_stratum(strata: Sequence[str], prefix: str) -> Column:
    """Null-safe match: rows without a stratum form a group of their own."""
    match = F.lit(True)
    for i, name in enumerate(strata):
        match = match & F.col(name).eqNullSafe(F.col(f"{prefix}{i}"))
    return match


def _renamed(df: DataFrame, strata: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({name: f"{prefix}{i}" for i, name in enumerate(strata)})


def _all_in() -> Column:
    """Whether the sample has all rows of a (stratum, cell)."""
    return (((F.col("_take") == 0) | (F.col("_limit0") == F.col("_size0")))
            & ((F.col("_take") == F.col("_count")) | (F.col("_limit1") == F.col("_size1"))))


def _all_out() -> Column:
    return (((F.col("_take") == 0) | (F.col("_limit0") == 0))
            & ((F.col("_take") == F.col("_count")) | (F.col("_limit1") == 0)))


NUMBERS = ("_take", "_size0", "_size1", "_limit0", "_limit1")


def _within(rows: DataFrame, plan: DataFrame, strata: Sequence[str], digits: int) -> DataFrame:
    """The rows in cells that a cut runs through, with the cell (``_open``) and its numbers."""
    cells = _renamed(plan.filter(~_all_in() & ~_all_out()), strata, "_o").select(
        *[f"_o{i}" for i in range(len(strata))], F.col("_cell").alias("_open"), *NUMBERS)
    match = _same_stratum(strata, "_o") & (F.substring("_hash", 1, digits) == F.col("_open"))
    return rows.select(*strata, "_hash").join(cells, match).select(*strata, "_hash", "_open", *NUMBERS)


def _divided(inside: DataFrame, strata: Sequence[str], digits: int) -> DataFrame:
    """The cells that ``inside`` is cut into by its first ``digits`` digits, with what each gives.

    What an open cell has of a tier that is cut lies in open cells only, and a tier that is not cut is
    in or out as a whole, so the numbers of the open cells suffice. No window holds more rows than a
    cell has parts, times the strata.
    """
    cells = inside.groupBy(*strata, "_open", *NUMBERS, F.substring("_hash", 1, digits).alias("_cell")).agg(
        F.count(F.lit(1)).alias("_count"))
    in_stratum = W.partitionBy(*strata, "_open").orderBy("_cell")
    cells = cells.withColumn("_part", _clip(F.col("_take") - _before("_count", in_stratum), F.col("_count")))
    tiers = cells.groupBy("_open", "_cell").agg(
        F.sum("_part").alias("_n0"), F.sum(F.col("_count") - F.col("_part")).alias("_n1"),
        F.max("_limit0").alias("_l0"), F.max("_limit1").alias("_l1"))
    in_cell = W.partitionBy("_open").orderBy("_cell")
    tiers = tiers.select("_cell", *[F.col(f"_n{t}").alias(f"_size{t}") for t in (0, 1)], *[
        _clip(F.col(f"_l{t}") - _before(f"_n{t}", in_cell), F.col(f"_n{t}")).alias(f"_limit{t}") for t in (0, 1)])
    return cells.select(*strata, "_cell", "_count", F.col("_part").alias("_take")).join(tiers, "_cell")


def _largest_open(plan: DataFrame) -> int:
    counts = plan.filter(~_all_in() & ~_all_out()).groupBy("_cell").agg(F.sum("_count").alias("_rows"))
    return counts.agg(F.coalesce(F.max("_rows"), F.lit(0)).alias("_most")).first()["_most"]


def _bounds(rows: DataFrame, strata: Sequence[str], n: int) -> DataFrame:
    """One row per stratum: the first hash that is not in the sample as a whole.

    ``_times`` is the number of rows with exactly this hash that are still in. The tables of
    cells are stored: they are small next to the rows, and once their size is known the rows
    meet them in a broadcast join and are not shuffled.
    """
    digits = CELL_DIGITS
    cells = rows.groupBy(*strata, F.substring("_hash", 1, digits).alias("_cell")).agg(F.count(F.lit(1)).alias("_count"))
    plan = stored(_allocate(cells, strata, n), "sample-cells")
    plans, most = [plan], _largest_open(plan)
    while most > CELL_ROWS and digits < HASH_DIGITS:
        inside = _within(rows, plan, strata, digits)
        digits = min(HASH_DIGITS, digits + CELL_DIGITS)
        plan = stored(_divided(inside, strata, digits), "sample-cells")
        plans.append(plan)
        before, most = most, _largest_open(plan)
        # Different hashes part into thousands of cells: what stays together are copies of one row.
        if most > before // 2:
            break

    # Hashes in the cells that a cut runs through. Copies of a row are counted, not listed.
    take = F.col("_take")
    cut = _within(rows, plan, strata, digits).withColumnRenamed("_open", "_cell").groupBy(
        *strata, "_cell", "_hash", *NUMBERS).agg(F.count(F.lit(1)).alias("_rows"))
    in_cell = W.partitionBy(*strata, "_cell").orderBy("_hash")
    cut = cut.withColumn("_first", _clip(take - _before("_rows", in_cell), F.col("_rows")))
    tiers = [F.struct(F.lit(t).alias("_tier"), part.alias("_part"),
                      F.col(f"_size{t}").alias("_size"), F.col(f"_limit{t}").alias("_limit"))
             for t, part in ((0, F.col("_first")), (1, F.col("_rows") - F.col("_first")))]
    cut = cut.select(*strata, "_cell", "_hash", "_rows", F.inline(F.array(*tiers)))
    in_tier = W.partitionBy("_tier", "_cell").orderBy("_hash", *strata)
    inside = _clip(F.col("_limit") - _before("_part", in_tier), F.col("_part"))
    cut = cut.withColumn("_times", F.when(F.col("_limit") == F.col("_size"), F.col("_part"))
                         .otherwise(inside))
    cut = cut.groupBy(*strata, "_hash", "_rows").agg(F.sum("_times").alias("_times"))

    none = F.lit(0).cast("bigint").alias("_times")
    ends = cut.filter(F.col("_times") < F.col("_rows")).select(*strata, F.col("_hash").alias("_bound"), "_times")
    for level in plans:
        ends = ends.unionByName(level.select(
            *strata, F.when(_all_out(), F.col("_cell")).otherwise(F.lit(AFTER_ALL)).alias("_bound"), none))
    return ends.groupBy(*strata).agg(
        F.min("_bound").alias("_bound"), F.min_by("_times", "_bound").alias("_times"))


def _one_bound(rows: DataFrame, n: int) -> tuple[str, int]:
    """The bound of a sample without strata, and how many rows with exactly this hash are still in."""
    if n > SMALL_SAMPLE:
        bound = _bounds(rows, (), n).first()
        return (bound["_bound"], bound["_times"]) if bound else (AFTER_ALL, 0)
    first = [r["_hash"] for r in rows.select("_hash").orderBy("_hash").limit(n + 1).collect()]
    if len(first) <= n:
        return AFTER_ALL, 0
    return first[n], first[:n].count(first[n])


def _repeat(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as its ``times`` column says, in steps that keep arrays short."""
    last = F.floor((F.col(times) - 1) / _EXPLODE_STEP)
    steps = df.filter(F.col(times) > 0).withColumn(
        "_step", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    left = F.col(times) - F.col("_step") * _EXPLODE_STEP
    return steps.withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("bigint"),
                                      F.least(left, F.lit(_EXPLODE_STEP).cast("bigint")))))


def exact_sample(df: DataFrame, n: int, strata: Sequence[str] = (), seed: int = DEFAULT_SEED,
                 key: Sequence[str] | None = None) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, spread over the strata by their share of all rows.

    ``key`` names columns that identify a row. Without it the whole row is hashed; equal
    rows are then interchangeable and are counted before they are moved, so copies never
    pile up in one task. The bounds are computed right away, from the key and the strata
    alone; the result is a filter over the rows.
    """
    columns = df.columns
    rows = df.withColumn("_hash", order_hash(df, seed, key))
    if strata:
        bounds = stored(_bounds(rows, strata, n), "sample-bounds")
        bounded = rows.join(_renamed(bounds, strata, "_b"), _same_stratum(strata, "_b"))
        sure = bounded.filter(F.col("_hash") < F.col("_bound")).select(*columns)
        ties = bounds.filter(F.col("_times") > 0)
        if ties.isEmpty():
            return sure
    else:
        # One bound for all rows is a value in the filter; the copies at it are in the same row.
        bound, times = _one_bound(rows, n)
        sure = rows.filter(F.col("_hash") < bound).select(*columns)
        if not times:
            return sure
        ties = df.sparkSession.range(1).select(F.lit(bound).alias("_bound"),
                                               F.lit(times).cast("bigint").alias("_times"))

    # Where a bound falls between copies of one row, some of the copies are in.
    split = rows.join(_renamed(ties, strata, "_b"),
                      _same_stratum(strata, "_b") & (F.col("_hash") == F.col("_bound")))
    split = split.groupBy(*columns, "_hash", "_times").agg(F.count(F.lit(1)).alias("_rows"))
    in_tie = W.partitionBy(*strata, "_hash").orderBy(F.xxhash64(*columns))
    split = split.withColumn(
        "_copies", _clip(F.col("_times") - _before("_rows", in_tie), F.col("_rows")))
    return sure.unionByName(_repeat(split, "_copies").select(*columns))


def random_sample(df: DataFrame, n: int, seed: int = DEFAULT_SEED,
                  key: Sequence[str] | None = None) -> DataFrame:
    """The first ``min(n, rows)`` rows of a seeded random order."""
    return exact_sample(df, n, (), seed, key)


def stratified_sample(df: DataFrame, n: int = DEFAULT_SAMPLE_SIZE,
                      strata: Sequence[str] = DEFAULT_STRATA, seed: int = DEFAULT_SEED,
                      key: Sequence[str] | None = None,
                      text: str = "review_text") -> DataFrame:
    """Sample of the reviews that have a text, stratified by the strata columns there are."""
    usable = df.filter(~is_blank(F.col(text)))
    present = [c for c in strata if c in df.columns]
    if not present:
        return random_sample(usable, n, seed, key)
    return exact_sample(usable, n, present, seed, key)


def sample_balance(population: DataFrame, sample: DataFrame,
                   strata: Sequence[str] = DEFAULT_STRATA) -> DataFrame:
    """Rows and share of each stratum in the population and in the sample.

    Both tables are counted in one grouping, so a stratum missing from the sample is listed
    with 0 and null strata match.
    """
    both = population.select(*strata, F.lit(1).alias("_pop"), F.lit(0).alias("_smp")).unionByName(
        sample.select(*strata, F.lit(0).alias("_pop"), F.lit(1).alias("_smp")))
    counts = both.groupBy(*strata).agg(
        F.sum("_pop").alias("population_rows"), F.sum("_smp").alias("sample_rows"))
    whole = counts.agg(F.struct(F.sum("population_rows").alias("population"),
                                F.sum("sample_rows").alias("sample")).alias("w")).scalar()
    return counts.select(*strata, "population_rows", "sample_rows", *[
        pct(F.col(f"{side}_rows"), whole.getField(side)).alias(f"{side}_pct")
        for side in ("population", "sample")]).orderBy(*strata)
