"""The stored state: one manifest names the folders of all tables.

A writer puts its tables into folders of their own and then publishes the next
manifest by a rename that fails if that number exists, so a reader sees all
tables of a run or none, and of two writers that started from the same state
one wins.  The loser may go on from the new state if nothing it read or wrote
has changed in between; otherwise it gets a ``Conflict``.  A run that dies
leaves folders that no manifest names.

The rename is atomic where the file system's is (HDFS and the like).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from lodestar.plans import layers


class Conflict(RuntimeError):
    """Another writer has published a table that this run read or writes."""


@dataclass
class Snapshot:
    """One state: its number, and (version, folder) of every table."""
    number: int = 0
    tables: dict[str, tuple[int, str]] = field(default_factory=dict)

    def version(self, table: str) -> int:
        return self.tables.get(table, (0, ""))[0]


class Store:
    """The tables below ``root``, on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _numbers(self) -> list[int]:
        at = self._path("_state")
        fs = at.getFileSystem(self._conf)
        if not fs.exists(at):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return sorted(int(n[2:]) for n in names if n.startswith("s="))

    def snapshot(self, number: int | None = None) -> Snapshot:
        """The newest state, or the one of a number; state 0 is empty."""
        found = self._numbers()
        number = (found[-1] if found else 0) if number is None else number
        if number == 0:
            return Snapshot()
        text = self.spark.read.text(f"{self.root}/_state/s={number:08d}").first()["value"]
        return Snapshot(number, {k: tuple(v) for k, v in json.loads(text).items()})

    def read(self, table: str, at: Snapshot | None = None) -> DataFrame | None:
        """A table of a state (the newest if not given); None if it has none."""
        at = at or self.snapshot()
        if layers.is_layered(self, table, at):
            return layers.read(self, table, at)
        return self.spark.read.parquet(f"{self.root}/{at.tables[table][1]}") if table in at.tables else None

    def versions(self, table: str) -> list[int]:
        """The published versions of a table, the oldest first."""
        return list(range(1, self.snapshot().version(table) + 1))

    def names(self, folder: str) -> list[str]:
        """The names of what lies in a folder of the store."""
        at = self._path(folder)
        return sorted(x.getPath().getName() for x in at.getFileSystem(self._conf).listStatus(at))

    def put(self, tables: dict[str, DataFrame]) -> dict[str, str]:
        """Write tables into new folders; no reader sees them before ``publish``."""
        out = {}
        for name, df in tables.items():
            out[name] = f"{name}/v-{uuid.uuid4().hex}"
            df.write.parquet(f"{self.root}/{out[name]}")
        return out

    def publish(self, base: Snapshot, folders: dict[str, str | None], read: tuple[str, ...] = ()) -> Snapshot:
        """Make the written folders part of the next state (None: the table
        is gone from it).  ``read``: tables of ``base`` whose content the new
        ones rest on."""
        while True:
            now = self.snapshot()
            changed = sorted(t for t in {*folders, *read} if now.version(t) != base.version(t))
            if changed:
                raise Conflict(f"changed since state {base.number}: {', '.join(changed)}")
            tables = now.tables | {t: (now.version(t) + 1, f) for t, f in folders.items() if f is not None}
            tables = {t: x for t, x in tables.items() if folders.get(t, "") is not None}
            if self._rename_new(json.dumps(tables, sort_keys=True), now.number + 1):
                return Snapshot(now.number + 1, tables)

    def commit(self, base: Snapshot, tables: dict[str, DataFrame], read: tuple[str, ...] = ()) -> Snapshot:
        return self.publish(base, self.put(tables), read)

    def _rename_new(self, text: str, number: int) -> bool:
        tmp = self._path("_state", f"_tmp-{uuid.uuid4().hex}")
        fs = tmp.getFileSystem(self._conf)
        out = fs.create(tmp, False)
        out.writeBytes(text + "\n")
        out.close()
        files = self._jvm.org.apache.hadoop.fs
        no_options = self.spark.sparkContext._gateway.new_array(files.Options.Rename, 0)     # never overwrite
        target = self._path("_state", f"s={number:08d}")
        context = files.FileContext.getFileContext(fs.makeQualified(tmp).toUri(), self._conf)
        try:
            context.rename(fs.makeQualified(tmp), fs.makeQualified(target), no_options)
            return True
        except Exception as e:
            if not fs.exists(target):
                raise
            fs.delete(tmp, False)
            if "AlreadyExists" in str(e):
                return False
            raise
