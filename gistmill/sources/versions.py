"""Tables that grow by batches, each version of which is published at once and stays readable."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "part string, batch string, docs long"


def publish(rows: DataFrame, target: str) -> bool:
    """Write ``rows`` as the folder ``target`` by one rename; False if it is there already, which is then kept.

    The rows are computed in any case.  They are hidden from readers until the
    rename, which a file system makes at once and an object store may not.  One
    writer at a time.
    """
    spark = rows.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    folder, _, name = target.rpartition("/")
    hidden, final = path(f"{folder}/_writing-{name}-{uuid.uuid4().hex}"), path(target)
    rows.write.parquet(hidden.toString())
    files = final.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if files.exists(final):
        files.delete(hidden, True)
        return False
    if not files.rename(hidden, final):
        raise OSError(f"could not publish {target}")
    return True


class VersionedTable:
    """Partial results by batch, and versions that name the parts to be read together.

    A batch is written as a part first and then named by a new version, so a stop
    in between leaves the last version as it was, and the batch can be added again.
    A batch that a version has is not added twice.  ``compact`` replaces the
    parts by one; old versions keep theirs.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str):
        self.spark, self.folder, self.schema = spark, folder, schema

    def versions(self) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/versions")
        files = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        if not files.exists(path):
            return []
        names = [f.getPath().getName() for f in files.listStatus(path)]
        return sorted(int(n[1:]) for n in names if n.startswith("v"))

    def manifest(self, version: int | None = None) -> list[tuple[str, str, int]]:
        """(part, batch, documents) of a version, the last by default; a few rows a batch since the last compaction."""
        known = self.versions()
        if version is None and not known:
            return []
        number = known[-1] if version is None else version
        return [tuple(r) for r in self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/versions/v{number:09d}").collect()]

    def _name(self, entries: list[tuple[str, str, int]]) -> None:
        number = max(self.versions(), default=0) + 1
        rows = self.spark.createDataFrame(entries, MANIFEST).coalesce(1)
        if not publish(rows, f"{self.folder}/versions/v{number:09d}"):
            raise RuntimeError(f"version {number} was written by somebody else")

    def write_part(self, rows: DataFrame) -> str:
        part = f"parts/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.folder}/{part}")
        return part

    def add(self, rows: DataFrame, batch: str, docs: int) -> bool:
        """Add the partial result of a batch of ``docs`` documents; False if the batch was added before."""
        entries = self.manifest()
        if any(b == batch for _, b, _ in entries):
            return False
        self._name([*entries, (self.write_part(rows), batch, docs)])
        return True

    def docs(self, version: int | None = None) -> int:
        return sum(n for _, _, n in self.manifest(version))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of all parts of a version."""
        parts = list(dict.fromkeys(p for p, _, _ in self.manifest(version) if p))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.folder}/{p}" for p in parts])

    def compact(self, combine: Callable[[DataFrame], DataFrame]) -> None:
        """A new version with one part, ``combine`` of all rows; it still knows every batch."""
        entries = self.manifest()
        if entries:
            part = self.write_part(combine(self.read()).select(*[F.col(c) for c in self.read().columns]))
            self._name([(part, batch, docs) for _, batch, docs in entries])
