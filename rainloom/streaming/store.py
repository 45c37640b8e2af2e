"""Tables that are filled key by key and know which of their keys are whole.

A batch of keys is written beside the table, its files are moved into it, and then its manifest is written: which keys it
holds, and its files' names and lengths. A key is done if a manifest says so and the files are there as it says. A run that was
killed at any point leaves files without a manifest, or a manifest without its files: opening the store deletes what such a
batch left, and its keys are made anew, so no row is there twice. Done keys are found from manifests and lists of files; no
value is read.

Keys are numbers, dates or plain words, some thousands of them at most. A store is filled by one run at a time."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "_manifest"


class Store:
    """A table at a path. Reading the path as Parquet gives its rows; partitioned: each key has a partition of its own, to be pruned by."""

    def __init__(self, spark: SparkSession, path: str, key: str, partitioned: bool = False):
        self.spark, self.path, self.key, self.partitioned = spark, path, key, partitioned
        self._at = lambda *more: spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((path, *more)))
        self._system = self._at().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _list(self, *more: str) -> list[tuple[str, int]]:
        """Names and lengths of the files at a place, none if it isn't there."""
        at = self._at(*more)
        return [(s.getPath().getName(), s.getLen()) for s in self._system.listStatus(at) if s.isFile()] if self._system.exists(at) else []

    def _manifests(self) -> dict[str, dict]:
        if not any(name.endswith(".json") for name, _ in self._list(MANIFEST)):
            return {}
        rows = self.spark.read.text(f"{self.path}/{MANIFEST}/*.json", wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("name"), "value").collect()
        return {r.name: json.loads(r.value) for r in rows}

    def _files(self) -> dict[str, int]:
        """Lengths of the table's files, by their names below the path."""
        if not self._system.exists(self._at()):
            return {}
        places = [s.getPath().getName() for s in self._system.listStatus(self._at()) if s.isDirectory() and s.getPath().getName().startswith(f"{self.key}=")]
        found = {name: size for name, size in self._list() if name.endswith(".parquet")}
        return found | {f"{p}/{name}": size for p in places for name, size in self._list(p) if name.endswith(".parquet")}

    def open(self) -> set[str]:
        """Deletes what unfinished batches left, and returns the keys that are done, as text.

        A table that is there without any manifest was made by something else: it counts as whole and gets one."""
        said, there = self._manifests(), self._files()
        if not said and there and not self.partitioned and not self._system.exists(self._at(MANIFEST)):
            keys = [r[0] for r in self.spark.read.parquet(*[f"{self.path}/{name}" for name in there]).select(self.key).distinct().collect()]
            self._say(keys, there)
            return {str(k) for k in keys}
        whole = {name: m for name, m in said.items() if all(there.get(f) == size for f, size in m["files"].items())}
        for name in said.keys() - whole.keys():
            self._system.delete(self._at(MANIFEST, name), False)
        for name in there.keys() - {f for m in whole.values() for f in m["files"]}:
            self._system.delete(self._at(name), False)
        return {str(k) for m in whole.values() for k in m["keys"]}

    def write(self, rows: DataFrame, keys: list) -> None:
        """Stores all rows of some keys: of one key, if the store is partitioned. Keys without rows are done, too."""
        batch = uuid.uuid4().hex
        new, place = f"_new-{batch}", f"{self.key}={keys[0]}" if self.partitioned else ""
        if self.partitioned and len(keys) != 1:
            raise ValueError("a partitioned store takes its keys one by one")
        (rows.drop(self.key) if self.partitioned else rows).write.parquet(f"{self.path}/{new}")
        files = {}
        if place:
            self._system.mkdirs(self._at(place))
        for name, size in self._list(new):
            if name.endswith(".parquet"):
                to = "/".join(x for x in (place, name) if x)
                if not self._system.rename(self._at(new, name), self._at(to)):
                    raise OSError(f"can't move {name} into {self.path}")
                files[to] = size
        self._say(keys, files)
        self._system.delete(self._at(new), True)

    def _say(self, keys: list, files: dict[str, int]) -> None:
        name = f"{uuid.uuid4().hex}.json"
        self._system.mkdirs(self._at(MANIFEST))
        out = self._system.create(self._at(MANIFEST, f"{name}.new"))
        out.write(bytearray(json.dumps({"keys": [k if isinstance(k, int) else str(k) for k in keys], "files": files}).encode()))
        out.close()
        self._system.rename(self._at(MANIFEST, f"{name}.new"), self._at(MANIFEST, name))

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)
