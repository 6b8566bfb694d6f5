"""Tables of immutable folders, published by versions.

Data is written once, under a folder of its own, and never changed. A version is
one small file that lists the folders of each partition of each table; it is
created under the next number after the data is stored, so a reader sees the old
list or the new one, whatever a writer was doing when it stopped. Two writers
cannot create the same number. A clone is a copy of a list.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE_ROWS = 500_000
_END = "end"


class ConcurrentCommit(RuntimeError):
    """Another writer published the version that this one was based on the number of."""


@dataclass(frozen=True)
class Version:
    """What one version holds: folders by table and partition, and notes of the writer."""

    number: int = 0
    entries: tuple[dict, ...] = ()
    notes: dict = field(default_factory=dict)

    def of(self, table: str) -> list[dict]:
        return [e for e in self.entries if e["table"] == table]

    def without(self, table: str, parts) -> tuple[dict, ...]:
        gone = set(parts)
        return tuple(e for e in self.entries if e["table"] != table or e["part"] not in gone)


def range_count(df: DataFrame) -> int:
    """Ranges of at most ``RANGE_ROWS`` rows on average; a compressed size would not tell what a task has to sort."""
    return max(1, math.ceil(df.count() / RANGE_ROWS))


class Snapshots:
    """The versions under ``path``; tables are partitioned by the column ``key``, a date unless a type is given."""

    def __init__(self, spark: SparkSession, path: str, key: str = "event_date", key_type: T.DataType = T.DateType()) -> None:
        self.spark, self.path, self.key, self.key_type = spark, path.rstrip("/"), key, key_type

    # files

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _text(self, path: str) -> str:
        fs, p = self._fs(path)
        stream = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _create(self, path: str, text: str) -> None:
        fs, p = self._fs(path)
        stream = fs.create(p, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    # versions

    def _numbers(self) -> list[int]:
        return sorted(int(n[1:-5]) for n in self._names(f"{self.path}/_versions") if n.startswith("v") and n.endswith(".json"))

    def version(self, number: int | None = None) -> Version:
        """A version by number, or the newest that is whole; version 0 is empty."""
        numbers = self._numbers() if number is None else [number] if number else []
        for n in reversed(numbers):
            lines = self._text(f"{self.path}/_versions/v{n:012d}.json").splitlines()
            if lines and lines[-1] == _END:  # one that broke off has no end
                return Version(n, tuple(json.loads(x) for x in lines[1:-1]), json.loads(lines[0]))
            if number is not None:
                raise ValueError(f"version {number} of {self.path} is not whole")
        return Version()

    def commit(self, base: Version, entries, notes: dict | None = None) -> Version:
        """Publish ``entries`` as the version after ``base``; fails if another writer was first."""
        if self.version().number != base.number:
            raise ConcurrentCommit(f"{self.path} is no longer at version {base.number}")
        number = max([0, *self._numbers()]) + 1
        out = Version(number, tuple(entries), dict(base.notes if notes is None else notes))
        lines = [json.dumps(out.notes), *[json.dumps(e) for e in out.entries], _END]
        try:
            self._create(f"{self.path}/_versions/v{number:012d}.json", "\n".join(lines))
        except Exception as e:
            if "exist" in str(e).lower():
                raise ConcurrentCommit(f"version {number} of {self.path} exists") from e
            raise
        return out

    # data

    def stage(self, df: DataFrame, table: str) -> list[dict]:
        """Write a frame under a new folder; returns its entries, which nobody reads before a commit."""
        write = uuid.uuid4().hex
        root = f"{self.path}/{table}"
        df.write.partitionBy(self.key).parquet(f"{root}/write={write}")
        parts = [n.split("=", 1)[1] for n in self._names(f"{root}/write={write}") if n.startswith(f"{self.key}=")]
        return [{"table": table, "part": p, "root": root, "write": write} for p in sorted(parts)]

    def read(self, table: str, schema: T.StructType, version: Version | None = None, parts=None) -> DataFrame:
        """Rows of a table in a version (default: the newest), of all or the named partitions, with that column last."""
        version = self.version() if version is None else version
        whole = T.StructType([f for f in schema.fields if f.name != self.key] + [T.StructField(self.key, self.key_type)])
        roots: dict[str, list[str]] = {}
        for e in version.of(table):
            if parts is not None and e["part"] not in parts:
                continue
            roots.setdefault(e["root"], []).append(f"{e['root']}/write={e['write']}/{self.key}={e['part']}")
        out = None
        stored = T.StructType([*whole.fields[:-1], T.StructField("write", T.StringType()), whole.fields[-1]])
        for root, folders in roots.items():
            rows = self.spark.read.schema(stored).option("basePath", root).parquet(*folders).drop("write")
            out = rows if out is None else out.unionByName(rows)
        return self.spark.createDataFrame([], whole) if out is None else out.select(*whole.fieldNames())

    def expire(self, keep: int) -> None:
        """Forget all but the newest ``keep`` versions, and delete folders of ours that none of those lists.

        Not to be run while a writer is between ``stage`` and ``commit``, nor on
        a table that clones still read.
        """
        numbers = self._numbers()
        kept = [self.version(n) for n in numbers[-keep:]]
        used = {(e["root"], e["write"]) for v in kept for e in v.entries}
        for n in numbers[:-keep]:
            fs, p = self._fs(f"{self.path}/_versions/v{n:012d}.json")
            fs.delete(p, False)
        for table in self._names(self.path):
            root = f"{self.path}/{table}"
            for name in self._names(root):
                if name.startswith("write=") and (root, name[6:]) not in used:
                    fs, p = self._fs(f"{root}/{name}")
                    fs.delete(p, True)


def ranged(df: DataFrame, n: int, *order: str) -> DataFrame:
    """Rows dealt into ``n`` ranges, a file each, sorted inside."""
    return df.repartitionByRange(n, *order).sortWithinPartitions(*[F.col(c) for c in order])
