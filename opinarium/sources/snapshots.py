"""Related tables published together: readers see all of a version or none of it.

A publication writes its rows to a folder of its own, a part. A small manifest that lists the parts
of every table is written last; the highest manifest is the current version. Until then, and if
anything fails before, readers keep the version before. A version can take over parts of the one
before, so adding rows costs what the rows cost. Two writers cannot both take a number: a manifest
gets its name only if there is none of it. Versions that expire lose their manifest first, then the
parts that no version lists.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Versions that stay readable.
KEPT_VERSIONS = 3
_MANIFESTS = "_manifests"


class NoSnapshot(LookupError):
    """The folder has no published version, or not the one asked for."""


class ConcurrentPublication(RuntimeError):
    """Another writer has published the version that this one was built on."""


@dataclass(frozen=True)
class Snapshot:
    """A published version: its number, and for every table its parts with their rows, and its schema."""

    version: int
    root: str
    parts: dict[str, dict[str, int]]
    schemas: dict[str, str]

    def table(self, spark: SparkSession, name: str, parts: Iterable[str] | None = None) -> DataFrame:
        """A table of this version, or some of its parts."""
        schema = T.StructType.fromJson(json.loads(self.schemas[name]))
        folders = [f"{self.root}/data/{p}/{name}" for p in (self.parts[name] if parts is None else parts)]
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    def rows(self, name: str) -> int:
        return sum(self.parts[name].values())


def _files(spark: SparkSession, path: str):
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    return made.getFileSystem(spark._jsc.hadoopConfiguration()), made


def versions(spark: SparkSession, root: str) -> list[int]:
    """The published versions, ascending."""
    files, folder = _files(spark, f"{root}/{_MANIFESTS}")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def snapshot(spark: SparkSession, root: str, version: int | None = None) -> Snapshot:
    """A version, by default the current one."""
    known = versions(spark, root)
    if not known or version is not None and version not in known:
        raise NoSnapshot(f"{root} has versions {known}")
    number = known[-1] if version is None else version
    found = json.loads(spark.read.text(f"{root}/{_MANIFESTS}/{number:010d}.json", wholetext=True).first()[0])
    return Snapshot(number, root, found["parts"], found["schemas"])


def publish(spark: SparkSession, root: str, tables: Mapping[str, DataFrame | Callable[[dict[str, DataFrame]], DataFrame]],
            carried: Mapping[str, Mapping[str, int]] | None = None,
            check: Callable[[dict[str, DataFrame]], None] | None = None, keep: int = KEPT_VERSIONS,
            based_on: int | None = None) -> Snapshot:
    """Writes the tables as a part of the next version and makes that the current one.

    A table may be given as a function: it gets the new part's tables written before it, in the
    order of the mapping, and what it raises ends the publication. So a table that follows from
    others is computed from what is published, which needs no copy of its own. ``carried`` lists parts of earlier versions that the tables go on with. ``check`` gets the new
    part's tables as written and raises if they must not be published. Rows are counted while they
    are written. ``based_on`` is the version that the tables were computed from (0 for none), by
    default the current one; if another one was published meanwhile, nothing changes.
    """
    known = versions(spark, root)
    current = known[-1] if known else 0
    base = current if based_on is None else based_on
    if base != current:
        raise ConcurrentPublication(f"version {current} of {root} was published after {base}")
    part = f"{base + 1:010d}-{uuid.uuid4().hex}"
    rows, schemas, written = {}, {}, {}
    for name, given in tables.items():
        df = given if isinstance(given, DataFrame) else given(dict(written))
        seen, path = Observation(), f"{root}/data/{part}/{name}"
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
        rows[name], schemas[name] = seen.get["rows"], df.schema.json()
        written[name] = spark.read.schema(df.schema).parquet(path)
    if check:
        check(written)
    made = Snapshot(base + 1, root, {n: {**(carried or {}).get(n, {}), part: r} for n, r in rows.items()}, schemas)
    _commit(spark, made)
    expire(spark, root, keep)
    return made


def _commit(spark: SparkSession, made: Snapshot) -> None:
    root = made.root
    files, path = _files(spark, f"{root}/{_MANIFESTS}/{made.version:010d}.json")
    _, draft = _files(spark, f"{root}/{_MANIFESTS}/_{uuid.uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps({"parts": made.parts, "schemas": made.schemas}).encode()))
    out.close()
    # A name appears only with its whole content, and only once.
    if files.exists(path) or not files.rename(draft, path):
        files.delete(draft, False)
        raise ConcurrentPublication(f"version {made.version} of {root} was published by another writer")


def expire(spark: SparkSession, root: str, keep: int = KEPT_VERSIONS) -> list[int]:
    """Removes all but the last ``keep`` versions and the parts that no version lists, also those of
    one table of a part; returns the versions that went. A part above the current version may be in the making and stays."""
    known = versions(spark, root)
    gone, kept = known[:-keep], known[-keep:]
    for version in gone:
        files, path = _files(spark, f"{root}/{_MANIFESTS}/{version:010d}.json")
        files.delete(path, False)
    if kept:
        named: dict[str, set[str]] = {}
        for version in kept:
            for table, parts in snapshot(spark, root, version).parts.items():
                for part in parts:
                    named.setdefault(part, set()).add(table)
        files, data = _files(spark, f"{root}/data")
        for status in files.listStatus(data):
            part = status.getPath()
            if int(part.getName().split("-")[0]) > kept[-1]:
                continue
            if part.getName() not in named:
                files.delete(part, True)
                continue
            for table in files.listStatus(part):
                if table.getPath().getName() not in named[part.getName()]:
                    files.delete(table.getPath(), True)
    return gone
