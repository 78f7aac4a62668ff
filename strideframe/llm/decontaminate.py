"""Benchmark decontamination over a distributed positional inverted index.

The index is Parquet, one row per segment (about a MB of text), numbered by the task that wrote it and its place there: its
documents, their first word positions, and per distinct word the sorted positions of all its occurrences. Positions run through the segment and
skip one between documents, so no phrase crosses a document. All words of all documents are posted.

A search is given to every segment in blocks of at most `BLOCK_WORDS` benchmark words (the stated query
set), so what is broadcast has a fixed bound. In a segment, windows with a word that has no
posting are out at once; for the others the list of the rarest word, moved by its place in the window, is
intersected with those of the other words from rare to frequent. What is left are exact phrases.
`proximity` returns places where all words of a window stand within a distance of its rarest word.

Words are runs of ASCII letters (lower-cased), digits and characters beyond ASCII, held as 64-bit hashes.

Results for special inputs: null or wordless documents have no word and no hit; null or wordless items have
no window; an item shorter than the window is one window; repeated items give the same result once; rows that
repeat a key are documents of their own; empty tables give rows without hits, or no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.llm import blocks as B

WINDOW = 10
SEGMENT_BYTES = 1 << 20
BLOCK_WORDS = 2_000_000
INSIDE = B.byte_set((0, 47), (58, 96), (123, 127))
SEGMENT = ["part", "seq", "keys", "n_words", "terms", "counts", "positions"]


def tokens(data, offsets):
    """(word hashes, words per text)."""
    hashes, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for a, b in B.cut(offsets):
        low = B.lower_table()[data[offsets[a]:offsets[b]]]
        first, stop, count = B.words(low, offsets[a:b + 1] - offsets[a], INSIDE)
        hashes.append(B.mix(B.Rolling(low).pieces(first, stop)))
        counts.append(count)
    return np.concatenate(hashes), np.concatenate(counts)


def write_index(df: DataFrame, path: str, key: str, text: str) -> None:
    source = df.select(key, text)
    kind = source.schema[key].dataType.simpleString()

    def run(batches):
        part, seq = TaskContext.get().partitionId(), -1
        for batch in batches:
            for a, data, offsets in B.blocks(batch, text, SEGMENT_BYTES):
                seq += 1
                words, count = tokens(data, offsets)
                keys = batch.column(0).slice(a, len(count))
                keys = pa.concat_arrays([keys])
                place = B.ranges(B.starts(count + 1)[:-1], count).astype(np.uint32)
                order = np.argsort(words, kind="stable")
                terms, counts = np.unique(words[order], return_counts=True)
                one = pa.array([0, len(count)], pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.ListArray.from_arrays(one, keys), pa.ListArray.from_arrays(one, pa.array(count)),
                    *[pa.array([x.tobytes()], pa.binary()) for x in (terms, counts.astype(np.uint32), place[order])]], names=SEGMENT)

    source.mapInArrow(run, f"part int, seq int, keys array<{kind}>, n_words array<bigint>, terms binary, counts binary, positions binary").write.parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


class Segment:
    """One row of the index, opened."""

    def __init__(self, n_words, terms, counts, positions):
        self.terms = np.frombuffer(terms, np.uint64)
        self.at = B.starts(np.frombuffer(counts, np.uint32))
        self.positions = np.frombuffer(positions, np.uint32).astype(np.int64)
        self.first = B.starts(np.asarray(n_words) + 1)[:-1]

    def slots(self, words):
        """Place of each word in the dictionary, -1 if it has no posting."""
        if not len(self.terms):
            return np.full(words.shape, -1)
        k = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        return np.where(self.terms[k] == words, k, -1)

    def list_of(self, slot):
        return self.positions[self.at[slot]:self.at[slot + 1]]

    def phrases(self, words):
        """Positions where the words stand one after the other."""
        slots = self.slots(words)
        if (slots < 0).any():
            return np.empty(0, np.int64)
        return self._phrase(slots)

    def _phrase(self, slots):
        rare = np.argsort(self.at[slots + 1] - self.at[slots], kind="stable")
        starts = self.list_of(slots[rare[0]]) - rare[0]
        for k in rare[1:].tolist():
            if not len(starts):
                break
            there = self.list_of(slots[k])
            near = np.minimum(np.searchsorted(there, starts + k), len(there) - 1)
            starts = starts[there[near] == starts + k]
        return starts

    def near(self, slots, distance):
        """Positions of the rarest word with every other word at most `distance` words away, in the same document."""
        slots = np.unique(slots)
        slots = slots[np.argsort(self.at[slots + 1] - self.at[slots], kind="stable")]
        found = self.list_of(slots[0])
        doc = lambda p: np.searchsorted(self.first, p, side="right")
        for s in slots[1:].tolist():
            there = self.list_of(s)
            k = np.searchsorted(there, found)
            ok = np.zeros(len(found), bool)
            for side in (np.maximum(k - 1, 0), np.minimum(k, len(there) - 1)):
                p = there[side]
                ok |= (np.abs(p - found) <= distance) & (doc(p) == doc(found))
            found = found[ok]
        return found


class Windows:
    """All windows of a block of benchmark items, found by their rarest words."""

    def __init__(self, names, lengths, owner, terms, words, at, visit):
        self.names, self.lengths, self.owner, self.terms, self.words, self.at, self.visit = names, lengths, owner, terms, words, at, visit

    @classmethod
    def of(cls, items, size):
        rows, lengths, owner = [np.empty((0, size), np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i, (_, raw) in enumerate(items):
            w = np.frombuffer(raw, np.uint64)
            if len(w):
                n = min(size, len(w))
                view = np.lib.stride_tricks.sliding_window_view(w, n)
                rows.append(np.concatenate([view, np.repeat(view[:, -1:], size - n, axis=1)], axis=1))
                lengths.append(np.full(len(view), n))
                owner.append(np.full(len(view), i))
        rows = np.concatenate(rows)
        terms, words, often = np.unique(rows, return_inverse=True, return_counts=True)
        words = words.reshape(rows.shape)
        rarest = words[np.arange(len(words)), often[words].argmin(axis=1)] if len(words) else np.empty(0, np.int64)
        # The windows of term t are visit[at[t]:at[t + 1]].
        return cls([i[0] for i in items], np.concatenate(lengths), np.concatenate(owner), terms, words,
                   B.starts(np.bincount(rarest, minlength=len(terms))), np.argsort(rarest, kind="stable"))

    def present(self, seg):
        """(window, slots of its words in the segment) of each window all of whose words have postings there."""
        slots = seg.slots(self.terms)
        seen = np.flatnonzero(slots >= 0)
        w = np.sort(self.visit[B.ranges(self.at[seen], self.at[seen + 1] - self.at[seen])])
        found = slots[self.words[w]]
        ok = (found >= 0).all(axis=1)
        return w[ok].tolist(), found[ok]


def _blocks(benchmark: DataFrame, item: str, text: str):
    """The benchmark as lists of (item, word hashes), each of about BLOCK_WORDS words at most."""
    source = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            for a, data, offsets in B.blocks(batch, "text"):
                words, count = tokens(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, len(count)), B.as_binary(words.view(np.uint8), count * 8), pa.array(count)], names=["item", "words", "n"])

    items = source.mapInArrow(run, "item string, words binary, n long").where("n > 0")
    total = items.agg(F.sum("n")).first()[0] or 0
    k = -(-total // BLOCK_WORDS)
    for i in range(max(k, 1)):
        part = items.where(F.pmod(F.xxhash64("item"), F.lit(max(k, 1))) == i).distinct()
        yield [(r.item, bytes(r.words)) for r in part.select("item", "words").collect()]


def search(index: DataFrame, benchmark: DataFrame, key: str, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Every indexed document: key, n_words, `spans` (maximal runs of hit words, start and stop) and `items` (ids as text, distinct)."""
    kind = index.schema["keys"].dataType.elementType.simpleString()
    context = index.sparkSession.sparkContext

    def one(shared):
        def run(batches):
            windows = Windows(*shared.value)
            for batch in batches:
                for i in range(batch.num_rows):
                    keys, n_words = batch.column(2)[i].values, batch.column(3)[i].values.to_numpy()
                    seg = Segment(n_words, *(batch.column(k)[i].as_py() for k in (4, 5, 6)))
                    spans, items = _hits(seg, n_words, windows)
                    n = len(n_words)
                    where = [pa.array(np.full(n, batch.column(k)[i].as_py(), np.int32)) for k in (0, 1)]
                    yield pa.RecordBatch.from_arrays([*where, pa.array(np.arange(n), pa.int32()), keys, pa.array(n_words), spans, items],
                                                     names=["part", "seq", "doc", "key", "n_words", "spans", "items"])

        return run

    found = []
    for block in _blocks(benchmark, item, text):
        shared = context.broadcast(tuple(vars(Windows.of(block, window)).values()))
        found.append(index.select(*SEGMENT).mapInArrow(one(shared), f"part int, seq int, doc int, key {kind}, n_words long, spans array<struct<start:bigint,stop:bigint>>, items array<string>"))
    rows = found[0]
    if len(found) > 1:
        for more in found[1:]:
            rows = rows.unionByName(more)
        # A document is named by its place in the index, so rows that repeat a key stay apart.
        rows = rows.groupBy("part", "seq", "doc").agg(
            F.first("key").alias("key"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
        rows = rows.withColumn("spans", _merged("spans"))
    return rows.select(F.col("key").alias(key), "n_words", "spans", "items")


def _merged(spans):
    """Overlapping or touching spans as maximal runs."""
    def step(acc, s):
        last = F.element_at(acc, -1)
        joined = (F.size(acc) > 0) & (s["start"] <= last["stop"])
        return F.when(joined, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop"))))
                      ).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(F.array_sort(spans), F.array().cast("array<struct<start:bigint,stop:bigint>>"), step)


def _hits(seg, n_words, windows):
    n = len(n_words)
    starts, sizes, items = [], [], []
    for w, slots in zip(*windows.present(seg)):
        size = windows.lengths[w]
        at = seg._phrase(slots[:size])
        if len(at):
            starts.append(at)
            sizes.append(np.full(len(at), size))
            items.append(np.full(len(at), windows.owner[w]))
    if not starts:
        none = pa.array(np.zeros(n + 1, np.int32))
        empty = pa.StructArray.from_arrays([pa.array([], pa.int64())] * 2, names=["start", "stop"])
        return pa.ListArray.from_arrays(none, empty), pa.ListArray.from_arrays(none, pa.array([], pa.string()))
    starts, sizes, items = (np.concatenate(x) for x in (starts, sizes, items))
    size = int((n_words + 1).sum()) + 1
    depth = np.cumsum(np.bincount(starts, minlength=size) - np.bincount(starts + sizes, minlength=size)) > 0
    edge = np.diff(depth.astype(np.int8), prepend=0, append=0)
    first, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(seg.first, first, side="right") - 1
    spans = pa.StructArray.from_arrays([pa.array(first - seg.first[doc]), pa.array(stop - seg.first[doc])], names=["start", "stop"])
    pairs = np.unique(np.stack([np.searchsorted(seg.first, starts, side="right") - 1, items], axis=1), axis=0)
    labels = pa.array(names_of(pairs, windows.names), pa.string())
    return (pa.ListArray.from_arrays(pa.array(B.starts(np.bincount(doc, minlength=n)).astype(np.int32)), spans),
            pa.ListArray.from_arrays(pa.array(B.starts(np.bincount(pairs[:, 0], minlength=n)).astype(np.int32)), labels))


def names_of(pairs, names):
    return [names[i] for i in pairs[:, 1].tolist()]


def report(found: DataFrame, key: str) -> DataFrame:
    """Counts and the digest of the items of each document of a search."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    items = F.array_sort(F.array_distinct("items"))
    return found.select(key, "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def proximity(index: DataFrame, benchmark: DataFrame, key: str, distance: int, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(key, item, word): words of documents near which all words of a window of the item stand."""
    kind = index.schema["keys"].dataType.elementType.simpleString()
    context = index.sparkSession.sparkContext

    def one(shared):
        def run(batches):
            windows = Windows(*shared.value)
            for batch in batches:
                for i in range(batch.num_rows):
                    keys, n_words = batch.column(2)[i].values, batch.column(3)[i].values.to_numpy()
                    seg = Segment(n_words, *(batch.column(k)[i].as_py() for k in (4, 5, 6)))
                    got = [np.stack([p, np.full(len(p), windows.owner[w])], axis=1) for w, slots in zip(*windows.present(seg))
                           if len(p := seg.near(slots[:windows.lengths[w]], distance))]
                    if got:
                        both = np.unique(np.concatenate(got), axis=0)
                        doc = np.searchsorted(seg.first, both[:, 0], side="right") - 1
                        yield pa.RecordBatch.from_arrays([keys.take(pa.array(doc)), pa.array(names_of(both, windows.names)), pa.array(both[:, 0] - seg.first[doc])], names=["key", "item", "word"])

        return run

    found = [index.select(*SEGMENT).mapInArrow(one(context.broadcast(tuple(vars(Windows.of(block, window)).values()))), f"key {kind}, item string, word long")
             for block in _blocks(benchmark, item, text)]
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows.withColumnRenamed("key", key)
