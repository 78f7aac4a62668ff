"""Shards as folders of their own, written and read by tasks.

Spark's writer sends each folder that it made to the driver, and its reader lists them there, so both hold something for every shard. Here a
task writes the shards that it meets, one file each, and a row of a list for each; readers take the list as a table, and open files in tasks.
The folders are named as Spark names them, so single shards are read by any reader.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strideframe.session import make_folder, qualified
from strideframe.sources.archives import dealt

LIST = "_shards"               # the list, beside the shards; names with a leading _ are hidden from readers of folders
PARTS = "_parts"               # files that are not whole yet
PATH, ROWS, BYTES, TEXTS = "_path", "_rows", "_bytes", "_texts"
GROUP_BYTES = 16 << 20         # of rows that are held of a shard, and of a batch that is read
BATCH_ROWS = 10_000
OPEN_BYTES = 256 << 10         # what opening a file costs, as bytes
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = {c: f"%{c:02X}" for c in [*range(1, 32), 127, *b"\"#%'*/:=?\\{[]^"]}


def reachable(root: str) -> bool:
    """Whether tasks can open files there; some stores are known to Spark's file systems only."""
    from pyarrow import fs
    try:
        fs.FileSystem.from_uri(root)
    except (pa.ArrowException, OSError):
        return False
    return True


def _folder(shard: list[str], texts: list[str | None]) -> str:
    """The folder of a shard, named as by Spark's `partitionBy`."""
    return "/".join(f"{c.translate(ESCAPED)}={t.translate(ESCAPED) if t else NO_VALUE}" for c, t in zip(shard, texts))


def _starts(columns: list[pa.Array], rows: int) -> np.ndarray:
    """Rows that differ from the row before them, the first one included."""
    new = np.zeros(rows, dtype=bool)
    new[:1] = True
    for c in columns:
        a, b = c.slice(1), c.slice(0, rows - 1)
        differ = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
        new[1:] |= differ.to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


class _File:
    """The file of one shard, filled beside its target and moved there when it is whole."""

    def __init__(self, system, top: str, folder: str, name: str, schema: pa.Schema):
        self.system, self.top, self.path = system, top, f"{folder}/{name}"
        self.part = f"{top}/{PARTS}/{uuid.uuid4().hex}"
        self.stream = system.open_output_stream(self.part)
        self.writer = pq.ParquetWriter(self.stream, schema, compression="snappy")
        self.held, self.size, self.rows = [], 0, 0
        system.create_dir(f"{top}/{folder}", recursive=True)

    def add(self, rows: pa.RecordBatch) -> None:
        self.held.append(rows)
        self.size += rows.nbytes
        self.rows += rows.num_rows
        if self.size >= GROUP_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.held:
            self.writer.write_table(pa.Table.from_batches(self.held))
        self.held, self.size = [], 0

    def done(self) -> tuple[str, int, int]:
        self._flush()
        self.writer.close()
        written = self.stream.tell()
        self.stream.close()
        target = f"{self.top}/{self.path}"
        try:
            self.system.move(self.part, target)
        except OSError:
            # A task that runs twice writes the same shards under the same names, and a name is there only when its file is whole.
            if not self.system.get_file_info(target).is_file:
                raise
        return self.path, self.rows, written


def _writer(root: str, shard: list[str], names: list[str]):
    def listed(done: list) -> pa.RecordBatch:
        keys = [pa.concat_arrays([row[0][i] for row in done]) for i in range(len(shard))]
        rest = [pa.array([row[1][0] for row in done], pa.string()), *[pa.array([row[1][i] for row in done], pa.int64()) for i in (1, 2)]]
        return pa.RecordBatch.from_arrays(keys + rest, names=[*shard, PATH, ROWS, BYTES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext
        system, top = fs.FileSystem.from_uri(root)
        task, made, key, file, done = TaskContext.get().partitionId(), 0, None, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns, rows = [batch.column(c) for c in shard], batch.select(names)
            starts = _starts(columns, batch.num_rows)
            for at, stop in zip(starts, [*starts[1:], batch.num_rows]):
                # Copied, as a slice would keep its whole batch.
                new = [c.take(pa.array([at])) for c in columns]
                if key is None or not all(a.equals(b) for a, b in zip(key, new)):
                    if file:
                        done.append((key, file.done()))
                    folder = _folder(shard, batch.column(TEXTS)[int(at)].as_py())
                    key, file = new, _File(system, top, folder, f"part-{task:05d}-{made:05d}.parquet", rows.schema)
                    made += 1
                file.add(rows.slice(at, stop - at))
                if len(done) >= BATCH_ROWS:
                    yield listed(done)
                    done = []
        if file:
            done.append((key, file.done()))
        if done:
            yield listed(done)
    return run


def _list_schema(schema: StructType, shard: list[str]) -> StructType:
    return StructType([StructField(c, schema[c].dataType) for c in shard]
                      + [StructField(PATH, StringType()), StructField(ROWS, LongType()), StructField(BYTES, LongType())])


def store(rows: DataFrame, path: str, shard: list[str]) -> None:
    """Write rows, which lie shard by shard in their partitions, to a folder per shard, and the list of them."""
    spark, names = rows.sparkSession, [c for c in rows.columns if c not in shard]
    if not names:
        raise ValueError("a shard has no columns of its own")
    make_folder(spark, f"{path}/{PARTS}")
    texts = F.array(*[F.col(c).cast("string") for c in shard])
    rows.withColumn(TEXTS, texts).mapInArrow(
        _writer(qualified(spark, path), shard, names), _list_schema(rows.schema, shard)).write.parquet(f"{path}/{LIST}")
    parts = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{PARTS}")
    parts.getFileSystem(spark._jsc.hadoopConfiguration()).delete(parts, True)


def _reader(root: str, shard: list[str], names: list[str]):
    def joined(held: list) -> Iterator[pa.RecordBatch]:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        system, top = fs.FileSystem.from_uri(root)
        held, rows, size = [], 0, 0
        for batch in batches:
            for i, path in enumerate(batch.column(PATH).to_pylist()):
                with system.open_input_file(f"{top}/{path}") as stream:
                    for part in pq.ParquetFile(stream).iter_batches(BATCH_ROWS):
                        at = pa.array(np.full(part.num_rows, i))
                        keys = [batch.column(c).take(at) for c in shard]
                        held.append(pa.RecordBatch.from_arrays([part.column(c) for c in names] + keys, names=names + shard))
                        rows, size = rows + part.num_rows, size + part.nbytes
                        if rows >= BATCH_ROWS or size >= GROUP_BYTES:
                            yield from joined(held)
                            held, rows, size = [], 0, 0
        if held:
            yield from joined(held)
    return run


def load(spark: SparkSession, path: str, schema: StructType, shard: list[str]) -> DataFrame:
    """Rows of all stored shards, read by their list; the shard's columns come last."""
    names = [c for c in schema.names if c not in shard]
    listed = spark.read.schema(_list_schema(schema, shard)).parquet(f"{path}/{LIST}")
    files = dealt(listed.withColumn(BYTES, F.col(BYTES) + OPEN_BYTES), [PATH], BYTES).select(*shard, PATH)
    return files.mapInArrow(_reader(qualified(spark, path), shard, names), StructType([schema[c] for c in names + shard]))
