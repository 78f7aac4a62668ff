"""One store surface on any Hadoop file system: small objects by key, and tables of objects for Spark jobs."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.sources.archives import list_files


class ObjectStore:
    """Objects below a root, named by keys such as `a/b.json`.

    `put` is create-only: it stages under a name of its own and publishes by one rename, the same content again is
    accepted, other content is refused with ValueError. Single objects (commits, manifests, cursors) pass through the driver and are
    small; tables of objects are read by `objects` and `contents`, and stored by `put_all`, as Spark jobs.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, key: str):
        if key.startswith("/") or ".." in key.split("/"):
            raise ValueError(f"not a key below the store: {key}")
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{key}" if key else self.root)

    def exists(self, key: str) -> bool:
        return self._fs.exists(self._path(key))

    def keys(self, prefix: str = "") -> list[str]:
        """Keys below a prefix, sorted; staged objects are not listed."""
        top = self._path(prefix)
        if not self._fs.exists(top):
            return []
        base = self._fs.makeQualified(self._path("")).toUri().getPath().rstrip("/") + "/"
        found, it = [], self._fs.listFiles(top, True)
        while it.hasNext():
            name = it.next().getPath().toUri().getPath().removeprefix(base)
            if not name.endswith(".partial") and not name.split("/")[-1].startswith("."):
                found.append(name)
        return sorted(found)

    def read(self, key: str) -> bytes:
        path = self._path(key)
        if not self._fs.exists(path):
            raise FileNotFoundError(key)
        stream = self._fs.open(path)
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def read_json(self, key: str):
        return json.loads(self.read(key))

    def put(self, key: str, data: bytes) -> None:
        target = self._path(key)
        if not self._fs.exists(target):
            self._fs.mkdirs(target.getParent())
            staged = self._path(f"{key}.{uuid.uuid4().hex}.partial")
            out = self._fs.create(staged, False)
            try:
                out.write(bytearray(data))
            finally:
                out.close()
            if self._fs.rename(staged, target):
                return
            self._fs.delete(staged, False)              # someone else was first
        if self.read(key) != data:
            raise ValueError(f"existing object has different content: {key}")

    def put_json(self, key: str, value) -> None:
        self.put(key, json.dumps(value, sort_keys=True, separators=(",", ":")).encode())

    def delete(self, key: str) -> None:
        """An object, or all objects below a key."""
        self._fs.delete(self._path(key), True)

    # --- tables

    def objects(self, prefix: str = "") -> DataFrame:
        """(key, length) of all objects below a prefix, listed by Spark."""
        base = self._fs.makeQualified(self._path("")).toUri().getPath().rstrip("/") + "/"
        path = F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
        return list_files(self.spark, f"{self.root}/{prefix}").select(F.substring(path, len(base) + 1, 1 << 20).alias("key"), "length")

    def contents(self, prefix: str = "") -> DataFrame:
        """(key, length, content) of all objects below a prefix; one row, so one object, is held at a time."""
        base = self._fs.makeQualified(self._path("")).toUri().getPath().rstrip("/") + "/"
        path = F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
        rows = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{self.root}/{prefix}")
        return rows.select(F.substring(path, len(base) + 1, 1 << 20).alias("key"), "length", "content")

    def put_all(self, rows: DataFrame, prefix: str, *, group: str, line: str) -> None:
        """Text objects `prefix/group=<value>/...` of a table's lines, stored by its tasks."""
        rows.select(group, F.col(line).cast("string").alias("value")).write.partitionBy(group).mode("errorifexists").text(f"{self.root}/{prefix}")
