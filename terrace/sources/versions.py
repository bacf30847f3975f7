"""Keyed tables that readers never see half written: every version is a folder, and one file names those that count.

A writer reads the newest version, merges its rows, writes a whole new folder under a name of its own, and publishes it by
creating the file of the next number, which only one writer can. So a writer that fails before that leaves the old rows in
place, and one that was overtaken starts again from what is there. A version remembers the batches that went into the
table, so that a batch that comes again, as those of a stream do, changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.merge import upserted
from terrace.sources.shared import hadoop_path


class Overtaken(RuntimeError):
    """Another writer has published meanwhile, more often than retried."""


class VersionedTable:
    """A table by key below a folder of any store that Hadoop reaches and that creates files atomically."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys
        self._folder, self._fs = hadoop_path(spark, f"{self.path}/log")

    def _entry(self, number: int):
        return hadoop_path(self.spark, f"{self.path}/log/{number:010d}.json")[0]

    def versions(self) -> list[int]:
        if not self._fs.exists(self._folder):
            return []
        return sorted(int(f.getPath().getName()[:10]) for f in self._fs.listStatus(self._folder) if f.getPath().getName().endswith(".json"))

    def state(self, number: int | None = None) -> dict | None:
        """What a version says: version, folder (null for a table without rows), batches; the newest one's by default."""
        known = self.versions()
        if not known:
            return None
        stream = self._fs.open(self._entry(known[-1] if number is None else number))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def read(self, number: int | None = None) -> DataFrame | None:
        """The rows of a version, the newest by default; None before the first one and where no rows are left."""
        state = self.state(number)
        return self.spark.read.parquet(f"{self.path}/{state['folder']}") if state and state["folder"] else None

    def _publish(self, number: int, folder: str | None, batches: dict[str, int]) -> bool:
        """Whether this writer has made the version: its file is written under another name and renamed, never over one."""
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        entry, text = self._entry(number), json.dumps({"version": number, "folder": folder, "batches": batches})
        draft = hadoop_path(self.spark, f"{self.path}/log/.{number:010d}-{uuid.uuid4().hex}")[0]
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        never_over = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(draft, entry, never_over)
        except Py4JJavaError as e:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def change(self, make: Callable[[DataFrame | None], DataFrame], batch: tuple[str, int] | None = None, keep_empty: bool = True, attempts: int = 5, before_publish: Callable[[], None] | None = None) -> int:
        """Writes what make returns for the newest rows as the next version, and returns its number.

        batch: a source and a number; of each source's changes only those count whose number is above the last one's.
        keep_empty: whether a table without rows is kept; otherwise it
        is as if it weren't there. before_publish is called when all is written, for tests.
        """
        for _ in range(attempts):
            now = self.state() or {"version": 0, "folder": None, "batches": {}}
            if batch is not None and batch[1] <= now["batches"].get(batch[0], -1):
                return now["version"]
            folder = f"rows-{now['version'] + 1:010d}-{uuid.uuid4().hex}"
            make(self.read()).write.parquet(f"{self.path}/{folder}")
            written = folder
            if not keep_empty and self.spark.read.parquet(f"{self.path}/{folder}").isEmpty():
                self._fs.delete(hadoop_path(self.spark, f"{self.path}/{folder}")[0], True)
                written = None
            if before_publish:
                before_publish()
            if self._publish(now["version"] + 1, written, now["batches"] | (dict([batch]) if batch else {})):
                return now["version"] + 1
            if written:
                self._fs.delete(hadoop_path(self.spark, f"{self.path}/{written}")[0], True)
        raise Overtaken(self.path)

    def upsert(self, rows: DataFrame, batch: tuple[str, int] | None = None, **options) -> int:
        """New rows replace those of their keys, the rest stays; rows must have each key once."""
        twice = rows.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").take(1)
        if twice:
            raise ValueError(f"key more than once: {twice[0].asDict()}")
        return self.change(lambda old: rows if old is None else upserted(old, rows, self.keys), batch, **options)

    def delete(self, keys: DataFrame, batch: tuple[str, int] | None = None, **options) -> int:
        """Rows without the keys that a table names; with keep_empty=False an emptied table is gone."""

        def rest(old: DataFrame | None) -> DataFrame:
            if old is None:
                raise ValueError(f"no table at {self.path}")
            return old.join(keys.select(*self.keys).distinct(), self.keys, "left_anti")

        return self.change(rest, batch, **options)

    def updated(self, change: Callable[[DataFrame], DataFrame], batch: tuple[str, int] | None = None, **options) -> int:
        """Every row through a function of the table; it must keep the keys and columns."""

        def made(old: DataFrame | None) -> DataFrame:
            if old is None:
                raise ValueError(f"no table at {self.path}")
            new = change(old)
            if new.columns != old.columns:
                raise ValueError(f"columns are {new.columns}, not {old.columns}")
            return new

        return self.change(made, batch, **options)

    def vacuum(self, keep: int = 2) -> int:
        """Deletes folders that neither of the newest versions names, those of writers that failed included; returns how many.

        Nobody may be writing, or reading older versions, meanwhile.
        """
        used = {self.state(v)["folder"] for v in self.versions()[-keep:]}
        root = hadoop_path(self.spark, self.path)[0]
        old = [f.getPath() for f in self._fs.listStatus(root) if f.getPath().getName().startswith("rows-") and f.getPath().getName() not in used]
        for path in old:
            self._fs.delete(path, True)
        return len(old)

    def sink(self, name: str, order: str) -> Callable[[DataFrame, int], None]:
        """A function for foreachBatch: of a key's rows within a micro-batch the last by order counts, a repeated batch nothing."""

        def put(rows: DataFrame, number: int) -> None:
            last = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*(c for c in rows.columns if c not in self.keys)), order).alias("_row"))
            self.upsert(last.select(*self.keys, "_row.*"), (name, number))

        return put
