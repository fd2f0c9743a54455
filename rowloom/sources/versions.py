"""Whose versions are whose: a registry of what loads have made of a table, with leases and a lock for swaps.

The registry is a folder per table in the warehouse, which every session that uses the catalog can reach. It holds an empty
file for each version a load has made ("owned"), one for each load or reader that still needs a version
("leases"), and one while a swap is under way ("lock"). What is not in it is never dropped, whatever its name.

A lease counts while its load or reader goes on; of another session, until it expires, for that session may be gone.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Seconds for which another session's lease or lock is believed.
LEASE_SECONDS = 24 * 3600
LOCK_SECONDS = 600

_GOING_ON: set[str] = set()      # loads and readers of this process


class ConcurrentLoad(RuntimeError):
    """Another load has replaced the table, or is just doing so."""


class Registry:
    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table = spark, table
        self.folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_versions/{table.lower()}"

    def _path(self, *names: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.folder, *names)))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _put(self, *names: str) -> bool:
        """Makes an empty file, unless it is there."""
        path, fs = self._path(*names)
        if fs.exists(path):
            return False
        try:
            fs.create(path, False).close()
        except Exception as e:
            if "AlreadyExists" in str(e):
                return False
            raise
        return True

    def _remove(self, *names: str) -> None:
        path, fs = self._path(*names)
        fs.delete(path, False)

    def _names(self, kind: str) -> list[str]:
        path, fs = self._path(kind)
        return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []

    def own(self, version: str) -> None:
        self._put("owned", version)

    def disown(self, version: str) -> None:
        self._remove("owned", version)
        for name in self._names("leases"):
            if name.split("@")[0] == version:
                self._remove("leases", name)

    def owned(self) -> list[str]:
        return self._names("owned")

    def lease(self, version: str, holder: str) -> None:
        self._put("leases", f"{version}@{holder}@{int(time.time()) + LEASE_SECONDS}")

    def leased(self) -> set[str]:
        """Versions that somebody may still need."""
        app, needed = self.spark.sparkContext.applicationId, set()
        for name in self._names("leases"):
            version, holder, until = name.split("@")
            own = holder.startswith(f"{app}.")
            if holder in _GOING_ON if own else int(until) > time.time():
                needed.add(version)
            else:
                self._remove("leases", name)
        return needed

    @contextmanager
    def holder(self) -> Iterator[str]:
        """A load or reader; its leases end with it."""
        name = f"{self.spark.sparkContext.applicationId}.{uuid.uuid4().hex}"
        _GOING_ON.add(name)
        try:
            yield name
        finally:
            _GOING_ON.discard(name)

    @contextmanager
    def lock(self) -> Iterator[None]:
        """Held by one swap at a time; one that was left behind is broken after LOCK_SECONDS."""
        if not self._put("lock"):
            path, fs = self._path("lock")
            if not fs.exists(path) or fs.getFileStatus(path).getModificationTime() / 1000 > time.time() - LOCK_SECONDS:
                raise ConcurrentLoad(f"{self.table} is just being replaced")
            self._remove("lock")
            if not self._put("lock"):
                raise ConcurrentLoad(f"{self.table} is just being replaced")
        try:
            yield
        finally:
            self._remove("lock")
