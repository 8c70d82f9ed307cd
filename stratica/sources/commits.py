"""Finished batches of a table, one small file each.

A batch's rows land in a folder of this attempt alone; the batch exists once its commit file does. Files are numbered, and a number
is taken by creating its file, which the file system grants once. Readers list the commits, never the folders: a batch
half written, given up or written again is not seen before its commit, and then in one step. A commit may fold what came before:
readers then start from it. Only these control records reach the driver, one per batch since the last fold.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

_FOLDER = "_commits"
_TRIES = 100


@dataclass(frozen=True)
class Commit:
    """A finished batch: whose it is, the attempt that holds its rows, and up to which version it folds what was there."""

    version: int
    stream: str
    batch_id: int
    attempt: str
    folds: int = 0


def new_attempt() -> str:
    return uuid.uuid4().hex


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.folder = f"{path.rstrip('/')}/{_FOLDER}"

    def _path(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _every(self) -> list[Commit]:
        folder, system = self._path()
        if not system.exists(folder):
            return []
        schema = "version long, stream string, batch_id long, attempt string, folds long"
        rows = self.spark.read.schema(schema).json(self.folder).where("attempt IS NOT NULL").collect()
        return sorted((Commit(**r.asDict()) for r in rows), key=lambda c: c.version)

    def visible(self) -> list[Commit]:
        """The commits that make up the table, oldest first: what the last fold left, and of each batch its last attempt."""
        every = self._every()
        folded = max((c.folds for c in every), default=0)
        latest = {(c.stream, c.batch_id): c for c in every if c.version > folded}
        return sorted(latest.values(), key=lambda c: c.version)

    def commit(self, stream: str, batch_id: int, attempt: str, folds: int = 0) -> Commit:
        """Make a written batch visible. A version that another writer took meanwhile is passed over."""
        version = max((c.version for c in self._every()), default=0)
        for _ in range(_TRIES):
            version += 1
            entry = Commit(version, stream, int(batch_id), attempt, folds)
            if self._created(f"{version:012d}.json", json.dumps(entry.__dict__)):
                return entry
        raise RuntimeError(f"no free version in {self.folder}")

    def _created(self, name: str, text: str) -> bool:
        from py4j.protocol import Py4JJavaError

        path, system = self._path(name)
        try:
            out = system.create(path, False)
        except Py4JJavaError:
            if system.exists(path):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True
