"""Tables that are replaced together, and small JSON files beside tables.

A set of tables lives in one folder. Every attempt to write it goes to a
version folder of its own; the version counts once its manifest, written
last and moved to its place in one step, is in ``_manifest``. Readers follow
the newest manifest, so they see all tables of one version or all of another,
and an attempt that fails midway changes nothing for them. The version
before the newest one stays for readers that already follow it; older ones
are deleted. One writer at a time.

Only listings and files of a few KB pass through the driver."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MANIFESTS = "_manifest"


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(sc._jsc.hadoopConfiguration()), where


def write_json(spark: SparkSession, path: str, content: dict) -> None:
    """Write a new small file; it appears whole."""
    fs, target = _fs(spark, path)
    _, draft = _fs(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(content, ensure_ascii=False, default=str).encode()))
    out.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise FileExistsError(path)


def read_json(spark: SparkSession, path: str) -> dict | None:
    """The content of a file of ``write_json``; None where there is none."""
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, where = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """path, length and modificationTime of the files that readers of ``path``
    see: a listing on executors, no file is opened."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")


def fingerprint(spark: SparkSession, path: str) -> dict:
    """Number of files, their bytes, and a sum over their paths, lengths and
    times, whatever their number. Nothing where nothing is."""
    try:
        files = files_of(spark, path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    marks = F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))
    row = files.agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), marks.cast("string").alias("marks")).first()
    return row.asDict()


@dataclass
class Version:
    """A version that is being written, or was committed."""
    spark: SparkSession
    root: str
    number: int
    folder: str
    facts: dict = field(default_factory=dict)

    def path(self, table: str) -> str:
        return f"{self.root}/{self.folder}/{table}"

    def commit(self, **facts) -> None:
        """From now on, readers see this version."""
        self.facts = facts
        write_json(self.spark, _manifest(self.root, self.number), {"folder": self.folder, "facts": facts})
        _drop_older(self.spark, self.root, self.number - 1)


def _manifest(root: str, number: int) -> str:
    return f"{root}/{_MANIFESTS}/{number:08d}.json"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return [int(n[:-5]) for n in _children(spark, f"{root}/{_MANIFESTS}") if n.endswith(".json") and n[:-5].isdigit()]


def current(spark: SparkSession, root: str) -> Version | None:
    """The newest committed version."""
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    if not numbers:
        return None
    held = read_json(spark, _manifest(root, numbers[-1]))
    return Version(spark, root, numbers[-1], held["folder"], held["facts"])


def begin(spark: SparkSession, root: str) -> Version:
    """A version to write the tables of; nobody reads it before its commit."""
    root = root.rstrip("/")
    number = max(_numbers(spark, root), default=0) + 1
    return Version(spark, root, number, f"v{number:08d}-{uuid.uuid4().hex}")


def _drop_older(spark: SparkSession, root: str, oldest: int) -> None:
    """Delete what belongs to versions before ``oldest``, attempts included."""
    fs, _ = _fs(spark, root)
    for name in _children(spark, root):
        if name[:1] == "v" and name[1:9].isdigit() and int(name[1:9]) < oldest:
            fs.delete(_fs(spark, f"{root}/{name}")[1], True)
    for number in _numbers(spark, root):
        if number < oldest:
            fs.delete(_fs(spark, _manifest(root, number))[1], False)
