"""Stages that know when they are stale.

Beside every finished table lies a manifest: what the table was built from. It names the input files
with size and time of change, the parameters, and the builds of the stages before. A stage whose
manifest differs is built again, into a folder of its own, and so is every stage behind it; readers
of the table before are not disturbed. The manifest is replaced last, so a build that fails leaves
the stage as it was.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Built:
    """A finished stage: its build, whether this run made it, and where its table is."""

    build: str
    ran: bool
    path: str

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


def _path(spark: SparkSession, path: str):
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    return made.getFileSystem(spark._jsc.hadoopConfiguration()), made


def input_files(spark: SparkSession, path: str) -> str:
    """A digest of the names, sizes and times of all files at a path; hidden ones do not count."""
    files, root = _path(spark, path)
    digest, found = hashlib.sha256(), []
    if not files.exists(root):
        return "absent"
    listed = files.listFiles(root, True)
    base = str(files.getFileStatus(root).getPath().toString())
    while listed.hasNext():
        status = listed.next()
        name = status.getPath().toString().removeprefix(base)
        if not any(part.startswith(("_", ".")) for part in name.split("/")):
            found.append((name, status.getLen(), status.getModificationTime()))
    for entry in sorted(found):
        digest.update(json.dumps(entry).encode())
    return digest.hexdigest()


def _read(spark: SparkSession, path: str) -> dict | None:
    files, place = _path(spark, path)
    if not files.exists(place):
        return None
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def _replace(spark: SparkSession, path: str, content: dict) -> None:
    files, place = _path(spark, path)
    out = files.create(place, True)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()


def staged(spark: SparkSession, root: str, name: str, build: Callable[..., DataFrame],
           inputs: Sequence[str] = (), params: Mapping[str, object] | None = None,
           after: Sequence[Built] = ()) -> Built:
    """The stage ``name`` under ``root``, built first if anything it depends on has changed.

    ``build`` gets the tables of the stages in ``after``, in order, and the parameters by name.
    ``params`` are values that JSON can hold. The manifests are small and one job reads them; a
    manifest that was cut off is not JSON and counts as none. The table before the current one
    stays until the build after it, for its readers.
    """
    params = dict(params or {})
    wanted = {"inputs": {p: input_files(spark, p) for p in inputs}, "params": params, "after": [b.build for b in after]}
    place = f"{root}/{name}/current.json"
    try:
        known = _read(spark, place)
    except json.JSONDecodeError:
        known = None
    if known and known["from"] == json.loads(json.dumps(wanted)):
        return Built(known["build"], False, f"{root}/{name}/{known['build']}")
    number = uuid.uuid4().hex
    path = f"{root}/{name}/{number}"
    build(*(b.table(spark) for b in after), **params).write.parquet(path)
    _replace(spark, place, {"build": number, "from": wanted, "before": known and known["build"]})
    if known and known.get("before"):
        files, old = _path(spark, f"{root}/{name}/{known['before']}")
        files.delete(old, True)
    return Built(number, True, path)
