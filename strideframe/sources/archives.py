"""Archive, object and document sources.

Archives are listed with the content column pruned and opened inside the tasks. Of zips and uncompressed tars a first pass
finds where the members are, and tasks then read members at their places, so one archive is read by many tasks; packed tars are
one stream each. An archive of any size needs the memory of one member.
"""

from __future__ import annotations

import hashlib
import io
import itertools
import re
import tarfile
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from strideframe.functions.ids import media_type
from strideframe.operators.checks import duplicates, violation
from strideframe.session import materialise

MEMBER = "archive string, member string, size bigint, sha256 string, problem string"
PROFILE = (MEMBER + ", frames bigint, columns int, rate_hz double, gender string, fields array<string>, "
           "surface string, components int, shapes map<string,array<bigint>>")
BLOCK = 1 << 20
BYTES_PER_TASK = 256 << 20
SHAPED = ["poses", "trans", "betas", "dmpls", "root_orient", "pose_body", "pose_hand"]

# Fixed adapters: required fields and the rate field of each source layout.
ADAPTERS = {
    "amass-smplh-g-v1": (["poses", "trans", "betas", "dmpls", "gender", "mocap_framerate"], "mocap_framerate"),
    "stageii-smplh-v1": (["poses", "trans", "betas", "gender", "mocap_frame_rate", "surface_model_type", "num_betas"],
                         "mocap_frame_rate"),
}


def list_files(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """Path, length and time of files below a prefix; contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", str(recursive).lower()).load(path).select("path", "length", "modificationTime"))


def dealt(rows: DataFrame, name: list[str], size: str) -> DataFrame:
    """Rows dealt to tasks by size: about BYTES_PER_TASK each, a task at least for each free core.

    Rows are laid end to end in order of their names' hash and cut into equal pieces, by sums over 4,096 hash ranges.
    """
    spark = rows.sparkSession
    rows = rows.withColumn("_h", F.xxhash64(*name)).withColumn("_r", F.pmod("_h", F.lit(4096)))
    total = rows.agg(F.coalesce(F.sum(size), F.lit(0)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    tasks = max(1, min(total["n"], max(spark.sparkContext.defaultParallelism, -(-total["b"] // BYTES_PER_TASK))))
    before = rows.groupBy("_r").agg(F.sum(size).alias("s")).select("_r", (F.sum("s").over(W.partitionBy(F.lit(0)).orderBy("_r")) - F.col("s")).alias("_base"))
    inner = F.sum(size).over(W.partitionBy("_r").orderBy("_h", *name)) - F.col(size)
    placed = rows.withColumn("_inner", inner).join(before, "_r")
    piece = F.least(F.lit(tasks - 1), F.floor((F.col("_base") + F.col("_inner")) * tasks / F.lit(max(total["b"], 1)))).cast("int")
    return placed.withColumn("_piece", piece).repartitionByRange(tasks, "_piece").drop("_h", "_r", "_inner", "_base", "_piece")


def balanced_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Paths dealt to tasks by length."""
    return dealt(list_files(spark, path, pattern).select("path", "length"), ["path"], "length").select("path")


def _open(path: str):
    from pyarrow import fs
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def _digest(stream) -> tuple[int, str]:
    sha, size = hashlib.sha256(), 0
    while block := stream.read(BLOCK):
        sha.update(block)
        size += len(block)
    return size, sha.hexdigest()


def _members(path: str) -> Iterator[tuple[str, object, str]]:
    """(name, stream, problem) of every member of a tar or zip archive."""
    with _open(path) as raw:
        if path.endswith(".zip"):
            with zipfile.ZipFile(raw) as z:
                for info in z.infolist():
                    if info.is_dir():
                        continue
                    link = (info.external_attr >> 28) == 0xA
                    with z.open(info) as stream:
                        yield info.filename, stream, "link" if link else ""
        else:
            with tarfile.open(fileobj=raw, mode="r|*") as t:
                for info in t:
                    if info.isdir():
                        continue
                    stream = t.extractfile(info) if info.isfile() else None
                    yield info.name, stream, "" if info.isfile() else "link"


def _scan(suffixes: tuple[str, ...], probe):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                rows = []
                try:
                    for name, stream, problem in _members(path):
                        if problem:
                            rows.append(probe(path, name, None, problem))
                        elif name.endswith(suffixes):
                            rows.append(probe(path, name, stream, ""))
                        if len(rows) >= 1000:
                            yield pd.DataFrame(rows)
                            rows = []
                except (tarfile.TarError, zipfile.BadZipFile, EOFError, OSError) as error:
                    rows.append(probe(path, "", None, f"truncated:{type(error).__name__}"))
                if rows:
                    yield pd.DataFrame(rows)
    return run


def _plain(path, name, stream, problem):
    size, sha = _digest(stream) if stream is not None else (None, None)
    return {"archive": path.rsplit("/", 1)[-1], "member": name, "size": size, "sha256": sha, "problem": problem}


class Window(io.RawIOBase):
    """Bytes at..at + size of a file as a file; `taken` counts the bytes read."""

    def __init__(self, raw, at: int, size: int):
        self.raw, self.at, self.size, self.place, self.taken = raw, at, size, 0, 0

    def readable(self):
        return True

    def seekable(self):
        return True

    def tell(self):
        return self.place

    def seek(self, offset, whence=0):
        self.place = max(0, offset + (0, self.place, self.size)[whence])
        return self.place

    def read(self, n=-1):
        rest = max(0, self.size - self.place)
        n = rest if n is None or n < 0 else min(n, rest)
        self.raw.seek(self.at + self.place)
        data = self.raw.read(n)
        self.place += len(data)
        self.taken += len(data)
        return data

    def readinto(self, buffer):
        data = self.read(len(buffer))
        buffer[:len(data)] = data
        return len(data)


INDEX = "path string, member string, at bigint, stored bigint, size bigint, crc bigint, method int, problem string"
PACKED = (".gz", ".tgz", ".bz2", ".xz")         # one stream from end to end


def _places(path: str) -> Iterator[dict]:
    """Where every member of an archive is: a zip's directory, or the headers of an uncompressed tar; payloads are passed over."""
    row = lambda name, at, stored, size, crc=None, method=None, problem="": dict(
        path=path, member=name, at=at, stored=stored, size=size, crc=crc, method=method, problem=problem)
    try:
        with _open(path) as raw:
            if path.endswith(".zip"):
                with zipfile.ZipFile(raw) as z:
                    for i in z.infolist():
                        if not i.is_dir():
                            yield row(i.filename, i.header_offset, i.compress_size, i.file_size, i.CRC, i.compress_type, "link" if (i.external_attr >> 28) == 0xA else "")
            else:
                length = raw.size()
                with tarfile.open(fileobj=raw, mode="r:") as t:
                    for i in t:
                        if not i.isdir():
                            cut = i.isfile() and i.offset_data + i.size > length
                            yield row(i.name, i.offset_data, i.size, i.size, problem="link" if not i.isfile() else "truncated:EOFError" if cut else "")
                            if cut:
                                return
    except (tarfile.TarError, zipfile.BadZipFile, EOFError, OSError) as error:
        yield row("", 0, 0, 0, problem=f"truncated:{type(error).__name__}")


def _at(raw, row):
    """A member as a stream, read from its place."""
    if row.method != row.method or row.method is None:
        return Window(raw, int(row.at), int(row.size))
    raw.seek(int(row.at))
    head = raw.read(30)
    if head[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile("no header where the directory says")
    start = int(row.at) + 30 + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little")
    info = zipfile.ZipInfo(row.member)
    info.compress_type, info.compress_size, info.file_size, info.CRC = int(row.method), int(row.stored), int(row.size), int(row.crc)
    return zipfile.ZipExtFile(Window(raw, start, info.compress_size), "r", info)


def index(spark: SparkSession, path: str, *, pattern: str) -> DataFrame:
    """Places of all members of the archives that can be read at any place (zip, uncompressed tar), one task an archive."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p in batch["path"]:
                places = _places(p)
                while rows := list(itertools.islice(places, 10_000)):
                    out = pd.DataFrame(rows)
                    yield out.astype({c: "Int64" for c in ("at", "stored", "size", "crc", "method")})

    return balanced_files(spark, path, pattern).where(~_packed(F.col("path"))).mapInPandas(run, INDEX)


def _packed(path: Column) -> Column:
    return F.coalesce(*[F.when(path.endswith(x), F.lit(True)) for x in PACKED], F.lit(False))


def _from_places(suffixes: tuple[str, ...], probe):
    """Rows of `probe` for members at their places; an archive stays open while its members follow each other."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened, raw = None, None
        try:
            for batch in batches:
                rows = []
                for r in batch.itertuples(index=False):
                    if r.problem:
                        rows.append(probe(r.path, r.member, None, r.problem))
                        continue
                    if r.path != opened:
                        if raw is not None:
                            raw.close()
                        opened, raw = r.path, _open(r.path)
                    try:
                        rows.append(probe(r.path, r.member, _at(raw, r), ""))
                    except (zipfile.BadZipFile, EOFError, OSError, zlib.error) as error:
                        rows.append(probe(r.path, r.member, None, f"truncated:{type(error).__name__}"))
                    if len(rows) >= 1000:
                        yield pd.DataFrame(rows)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows)
        finally:
            if raw is not None:
                raw.close()
    return run


def _probed(spark: SparkSession, path: str, pattern: str, suffixes: list[str], probe, schema: str, ranged=None) -> DataFrame:
    """Members of all archives: those of packed ones in one stream each, others dealt to tasks one by one."""
    streamed = balanced_files(spark, path, pattern).where(_packed(F.col("path"))).mapInPandas(_scan(tuple(suffixes), probe), schema)
    ends = F.coalesce(*[F.when(F.col("member").endswith(x), F.lit(True)) for x in suffixes], F.lit(False))
    places = materialise(index(spark, path, pattern=pattern).where((F.col("problem") != "") | ends), "members")
    shared = dealt(places, ["path", "member", "at"], "stored").sortWithinPartitions("path", "at")
    return streamed.unionByName(shared.mapInPandas(_from_places(tuple(suffixes), ranged or probe), schema))


def inventory(spark: SparkSession, path: str, *, pattern: str, suffixes: list[str]) -> DataFrame:
    """One row per wanted member with size and digest; links and damage are reported.

    One archive that is no packed stream is read by many tasks: a first pass finds where its members are.
    """
    return _probed(spark, path, pattern, suffixes, _plain, MEMBER)


def suffix_index(members: DataFrame) -> DataFrame:
    """Member index by the last one and the last two path parts."""
    name = F.col("member")
    keys = F.array_distinct(F.array(F.substring_index(name, "/", -1), F.substring_index(name, "/", -2)))
    return members.select("archive", "member", F.explode(keys).alias("key"))


def inventory_violations(members: DataFrame) -> DataFrame:
    """Links, truncated archives and duplicate members."""
    bad = members.where("problem <> ''").select(*violation("archive-member", F.concat_ws("/", "archive", "member"), F.col("problem")))
    return bad.unionByName(duplicates(members.where("problem = ''"), ["archive", "member"], "duplicate-member"))


class _Arrays:
    """Named arrays of a member: geometry from the first bytes, values only when they are asked for."""

    HEAD = 1 << 12

    def __init__(self, member: zipfile.ZipFile):
        self.member = member
        self.entry = {n.rsplit("/", 1)[-1].removesuffix(".npy"): n for n in member.namelist()}

    def shape(self, name: str) -> list[int] | None:
        """Lengths of an array's axes; null if there is no such array."""
        if name not in self.entry:
            return None
        with self.member.open(self.entry[name]) as f:
            text = f.read(self.HEAD).decode("latin-1")
        found = re.search(r"'shape':\s*\(([\d,\s]*)\)", text)
        if not text.startswith("\x93NUMPY") or found is None:
            raise ValueError(f"no array header in {name}")
        return [int(x) for x in found[1].split(",") if x.strip()]

    def scalar(self, name: str):
        """The only value of an array; null if there is no such array."""
        if name not in self.entry:
            return None
        value = np.load(io.BytesIO(self.member.read(self.entry[name])), allow_pickle=False)
        return value.reshape(-1)[0].item() if value.size == 1 else None


def _profile(path, name, stream, problem):
    """Header facts of a member; its size and digest too where the whole member has to be read anyway."""
    row = {**_plain(path, name, None, problem), "frames": None, "columns": None, "rate_hz": None, "gender": None,
           "fields": [], "surface": None, "components": None, "shapes": {}}
    if stream is None:
        return row
    data = stream.read()
    row.update(size=len(data), sha256=hashlib.sha256(data).hexdigest())
    return _facts(row, io.BytesIO(data))


def _ranged_profile(path, name, stream, problem):
    """Header facts of a member read at its place: its own directory and the first bytes of its arrays, no digest."""
    if isinstance(stream, zipfile.ZipExtFile) and stream._compress_type == zipfile.ZIP_STORED:
        stream = stream._fileobj
    if not isinstance(stream, Window):
        return _profile(path, name, stream, problem)
    row = {**_profile(path, name, None, problem), "size": stream.size}
    return _facts(row, stream)


def _facts(row, file):
    try:
        with zipfile.ZipFile(file) as z:
            arrays = _Arrays(z)
            row["fields"] = sorted(arrays.entry)
            row["shapes"] = {n: arrays.shape(n) for n in SHAPED if n in arrays.entry}
            poses = row["shapes"].get("poses")
            if poses is not None:
                row["frames"], row["columns"] = poses if len(poses) == 2 else (0, 0)
            rates = [x for x in map(arrays.scalar, ("mocap_framerate", "mocap_frame_rate")) if x is not None]
            row["rate_hz"] = float(rates[-1]) if rates else None
            gender, surface, parts = map(arrays.scalar, ("gender", "surface_model_type", "num_betas"))
            row["gender"] = gender.decode("ascii") if isinstance(gender, bytes) else gender if gender is None else str(gender)
            row["surface"] = None if surface is None else str(surface)
            row["components"] = None if parts is None else int(parts)
    except (zipfile.BadZipFile, ValueError, KeyError) as error:
        row["problem"] = f"unreadable:{type(error).__name__}"
    return row


def member_profiles(spark: SparkSession, path: str, *, pattern: str, suffixes: list[str]) -> DataFrame:
    """Header facts of motion members.

    Of members in an uncompressed tar, or stored as they are in a zip, only directories and array heads are read (their digest
    is null); packed members have to be read whole and have their digest.
    """
    return _probed(spark, path, pattern, suffixes, _profile, PROFILE, _ranged_profile)


def classify_members(profiles: DataFrame, *, adapter: Column) -> DataFrame:
    """`ok`, `adapter-required` or `not-motion` for each member under its adapter."""
    from strideframe.operators.labels import normalise_gender
    known, complete = F.lit(False), F.lit(False)
    for name, (required, _) in ADAPTERS.items():
        this = adapter == name
        known = known | this
        complete = complete | (this & (F.size(F.array_except(F.array(*map(F.lit, required)), "fields")) == 0))
    stage = adapter != "stageii-smplh-v1"
    rows = F.col("frames")
    is_shape = lambda name, *want: F.col("shapes")[name] == F.array(*[w if isinstance(w, Column) else F.lit(w).cast("bigint") for w in want])
    # Fixed widths of the arrays of a member.
    shaped = (is_shape("trans", rows, 3) & is_shape("betas", 16) & (~stage | is_shape("dmpls", rows, 8))
              & (stage | (F.coalesce(is_shape("root_orient", rows, 3), F.lit(True)) & F.coalesce(is_shape("pose_body", rows, 63), F.lit(True))
                          & F.coalesce(is_shape("pose_hand", rows, 90), F.lit(True)))))
    sound = (complete & shaped & (F.col("columns") == 156) & normalise_gender(F.col("gender")).isNotNull()
             & (F.col("rate_hz") > 0) & ~F.isnan("rate_hz") & (F.col("rate_hz") < float("inf"))
             & (stage | ((F.col("surface") == "smplh") & (F.col("components") == 16))))
    state = (F.when(~F.coalesce(known & sound, F.lit(False)) | (F.col("problem") != ""), "adapter-required")
             .when(F.col("frames") < 2, "not-motion").otherwise("ok"))
    return profiles.withColumns({"state": state, "gender": normalise_gender(F.col("gender"))})


def file_digests(spark: SparkSession, path: str, *, pattern: str = "*") -> DataFrame:
    """Path, length and SHA-256 of files, read in blocks so that a file may have any size."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for p in batch["path"]:
                with _open(p) as stream:
                    size, sha = _digest(stream)
                rows.append({"path": p, "byte_length": size, "sha256": sha})
            yield pd.DataFrame(rows, columns=["path", "byte_length", "sha256"])
    files = balanced_files(spark, path, pattern)
    return files.mapInPandas(run, "path string, byte_length bigint, sha256 string")


def logical_path(root: str) -> Column:
    """Path of a file below the root of its package."""
    inner = re.escape(re.sub("^[a-z0-9]+:/*", "/", root).rstrip("/") + "/")
    return F.element_at(F.split("path", inner, 2), -1)


def verified_contents(spark: SparkSession, path: str, descriptors: DataFrame, *, pattern: str = "*") -> DataFrame:
    """Descriptors (logical_path, byte_length, sha256) against the bytes on storage."""
    files = file_digests(spark, path, pattern=pattern).select(
        logical_path(path).alias("logical_path"), F.col("byte_length").alias("_n"), F.col("sha256").alias("_h"))
    rows = descriptors.join(files, "logical_path", "left")
    return rows.withColumn("state", F.when(F.col("_n").isNull(), "missing").when(F.col("_n") != F.col("byte_length"), "size-mismatch")
                           .when(F.col("_h") != F.col("sha256"), "hash-mismatch").otherwise("verified")).drop("_n", "_h")


def package_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Logical path, digest, length and media type of every file of a package."""
    logical = logical_path(path)
    return file_digests(spark, path).select(logical.alias("logical_path"), "sha256", "byte_length", media_type(logical).alias("media_type"))
