"""Token ids in shards compressed by Re-Pair, with random access.

Texts are encoded with a public tokenizer whose path is a parameter, each document gets an end id, and
documents in ascending key order (rows that repeat a key by their texts) fill shards of about `SHARD_TOKENS` ids. In a shard, frequent
pairs of neighbouring symbols are replaced by nonterminals again and again: each round counts all pairs,
takes those at or above a threshold that halves from the highest count on, and replaces them from
the left. Pairs never cross documents. A shard keeps the rules, their expansion lengths and the
remaining symbols, so a document, or any span of its ids, is decoded by itself.

The files are Parquet written by Spark, one row per shard, ordered by (part, seq); a task that is run
again writes the same rows. `payload` is, little-endian: magic `RPG1`, five uint32 (first
nonterminal, rules, symbols, bytes per symbol, rounds), rules per round, then for all rules left and
right symbol and expansion length (uint32 each), then the symbols.

Results for special inputs: null or empty text is the end id alone; rows that repeat a key, and null keys
(first), are documents of their own; an empty table gives no shard; a document longer than a shard is a
shard of its own; other columns are ignored.
"""

from __future__ import annotations

import itertools
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strideframe.llm import blocks as B

SHARD_TOKENS = 1 << 20
TEXT_BYTES = 2 << 20        # of texts whose words are looked up at once
LEAST_COUNT = 8             # a pair seen less often in a shard stays as it is
CACHE_WORDS = 1_500_000     # words whose ids a task remembers; the memory is cleared beyond
BUCKETS = 1 << 20           # of the pair counts: a pair's bucket may be shared, so buckets are counted first, then their pairs
SPACES = (9, 10, 13, 32)
# 1 ASCII letters, 2 other printable ASCII but spaces and apostrophes, 0 the rest: words are cut where 1 meets 2.
PIECE = np.zeros(256, np.uint8)
PIECE[33:127] = 2
PIECE[[*range(65, 91), *range(97, 123)]] = 1
PIECE[39] = 0
PROBE = "  The quick, brown fox's 12 jumps!  Over\tthe_lazy-dog.\n\nNaïve CAFÉ ½ 東京、🙂 x<|y a\u00a0b\u200bc \u2028 d'Arc O'Neil's (3.14%) &amp; "


class WordCache:
    """Ids of texts. Pieces of words are encoded by the tokenizer once and then looked up.

    Valid for tokenizers whose pieces never span white space and that drop it, as the word tokenizer does; a probe text tells, and
    others encode whole texts. Words are cut further
    where an ASCII letter meets ASCII punctuation or a digit (not at apostrophes), and brought to lower case where the tokenizer
    does so; blocks that may hold a special token's text are cut at spaces only. The memory belongs to the worker process and
    serves its later tasks.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        kept = tokenizers.__dict__.setdefault("_word_memory", {})
        self.tokenizer = kept.get(path, {}).get("tokenizer") or tokenizers.Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        # Words are encoded many at once, with a special token between them to tell them apart again.
        marks = [(i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not t.normalized]
        self.mark, self.mark_text = marks[0] if marks else (None, None)
        self.specials = [t.content[:2].encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.inside = np.ones(256, bool)
        self.inside[list(SPACES)] = False
        letters = "abcdefghijklmnopqrstuvwxyz"
        self.lower = self._one_piece(letters) and self._ids(letters.upper()) == self._ids(letters)
        # A word of a-z that is one piece is what the model itself takes.
        self.direct = self._one_piece(letters) and [t.id for t in self.tokenizer.model.tokenize(letters)] == self._ids(letters)
        self.memory = kept.setdefault(path, {"tokenizer": self.tokenizer})
        if "keys" not in self.memory:
            self._clear()
        # The look-up is used only where it gives what the library gives for a text of all kinds of characters.
        self.whole = False
        probe = PROBE.encode()
        self.whole = self.encode(np.frombuffer(probe, np.uint8), np.array([0, len(probe)]))[0].tolist() != self._ids(PROBE)

    def _ids(self, text):
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _one_piece(self, text):
        t = self.tokenizer
        plain = t.normalizer.normalize_str(text) if t.normalizer else text
        return plain == text and [p for p, _ in t.pre_tokenizer.pre_tokenize_str(plain)] == [text] if t.pre_tokenizer else False

    def _clear(self):
        self.memory.update(keys=np.empty(0, np.uint64), slot=np.empty(0, np.int64), ids=np.empty(0, np.uint32), at=np.zeros(1, np.int64))

    def _each(self, pieces):
        """Ids of every word."""
        out = [None] * len(pieces)
        if self.direct:
            model = self.tokenizer.model.tokenize
            for i, p in enumerate(pieces):
                if p.isascii() and p.isalpha() and p.islower():
                    out[i] = [t.id for t in model(p)]
        plain = [i for i, p in enumerate(pieces) if out[i] is None and self.mark is not None and self.mark_text not in p]
        joined = [self.mark_text.join([pieces[i] for i in plain[k:k + 512]]) for k in range(0, len(plain), 512)]
        for k, e in enumerate(self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
            ids = e.ids
            cuts = [-1, *np.flatnonzero(np.array(ids) == self.mark).tolist(), len(ids)]
            for i, a, b in zip(plain[k * 512:(k + 1) * 512], cuts[:-1], cuts[1:], strict=True):
                out[i] = ids[a + 1:b]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, e in zip(rest, self.tokenizer.encode_batch([pieces[i] for i in rest], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def _learn(self, hashes, pieces):
        found, m = self._each(pieces), self.memory
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        slots = len(m["at"]) - 1 + np.arange(len(found))
        m["ids"] = np.concatenate([m["ids"], np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(lengths.sum()))])
        m["at"] = np.concatenate([m["at"], m["at"][-1] + np.cumsum(lengths)])
        keys, slot = np.concatenate([m["keys"], hashes]), np.concatenate([m["slot"], slots])
        order = np.argsort(keys, kind="stable")
        m["keys"], m["slot"] = keys[order], slot[order]

    def _pieces(self, data, offsets):
        """(bytes, first, stop, pieces per text)."""
        raw = data.tobytes()
        first, stop, per_text = B.words(data, offsets, self.inside)
        if not self.direct or any(s in raw for s in self.specials):
            return data, raw, first, stop, per_text
        if self.lower:
            data = B.lower_table()[data]
            raw = data.tobytes()
        kind = PIECE[data]
        cut = np.flatnonzero((kind[1:] ^ kind[:-1]) == 3) + 1
        cut = cut[np.searchsorted(first, cut, side="right") > np.searchsorted(stop, cut, side="right")]      # inside a word
        edges = np.sort(np.concatenate([first, cut]))
        ends = np.sort(np.concatenate([stop, cut]))
        return data, raw, edges, ends, np.diff(np.searchsorted(edges, offsets))

    def encode(self, data, offsets):
        """(ids, ids per text) of a block of texts."""
        if self.whole:
            raw = data.tobytes()
            found = [e.ids for e in self.tokenizer.encode_batch([raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], add_special_tokens=False)]
            return np.fromiter(itertools.chain.from_iterable(found), np.uint32), np.array([len(x) for x in found], np.int64)
        data, raw, first, stop, per_text = self._pieces(data, offsets)
        if not len(first):
            return np.empty(0, np.uint32), np.zeros(len(per_text), np.int64)
        known, index, inverse = np.unique(B.mix(B.Rolling(data).pieces(first, stop)), return_index=True, return_inverse=True)
        m = self.memory
        if len(m["keys"]) + len(known) > CACHE_WORDS:
            self._clear()
        place = np.searchsorted(m["keys"], known)
        new = np.ones(len(known), bool)
        inner = place < len(m["keys"])
        new[inner] = m["keys"][place[inner]] != known[inner]
        if new.any():
            at = index[new]
            self._learn(known[new], [raw[a:b].decode("utf-8", "replace") for a, b in zip(first[at].tolist(), stop[at].tolist())])
            place = np.searchsorted(m["keys"], known)
        slot = m["slot"][place]
        begin, lengths = m["at"][slot][inverse], (m["at"][slot + 1] - m["at"][slot])[inverse]
        return m["ids"][B.ranges(begin, lengths)], np.diff(B.starts(lengths)[B.starts(per_text)])


def _pair_hash(left, right):
    h = left * np.uint32(0x9E3779B1)
    h += right * np.uint32(0x85EBCA77)
    h >>= np.uint32(12)
    return h.astype(np.int64)


def compress(ids, lengths, vocabulary: int) -> tuple[bytes, np.ndarray]:
    """Payload of a shard and the number of symbols of each document."""
    seq = ids.astype(np.uint32)
    last = np.zeros(len(seq), bool)                     # last symbol of its document: never the left of a pair
    last[np.cumsum(lengths)[lengths > 0] - 1] = True
    left_of, right_of, rounds, following, threshold = [], [], [], vocabulary, None
    while len(seq) > 1:
        free = ~last[:-1]
        bucket = _pair_hash(seq[:-1], seq[1:])
        counts = np.bincount(bucket, minlength=BUCKETS)
        counts -= np.bincount(bucket[~free], minlength=BUCKETS)
        top = int(counts.max(initial=0))
        threshold = max(LEAST_COUNT, (top + 1) // 2 if threshold is None else min(threshold, top + 1) // 2)
        if top < LEAST_COUNT:
            break
        at = np.flatnonzero(free & (counts >= threshold)[bucket])
        pair = seq[at].astype(np.int64) << 32 | seq[at + 1]
        kinds, inverse, often = np.unique(pair, return_inverse=True, return_counts=True)
        chosen, before = often >= threshold, following
        at, kind = at[chosen[inverse]], inverse[chosen[inverse]]
        if len(at):
            # Overlapping places form runs; every second one of a run is taken, from the left.
            start = np.ones(len(at), bool)
            start[1:] = np.diff(at) != 1
            take = (at - at[np.flatnonzero(start)][np.cumsum(start) - 1]) % 2 == 0
            used = np.bincount(kind[take], minlength=len(kinds))
            take &= used[kind] >= 2
            names = np.full(len(kinds), -1, np.int64)
            named = np.flatnonzero(used >= 2)
            names[named] = following + np.arange(len(named))
            left_of.append(kinds[named] >> 32)
            right_of.append(kinds[named] & 0xFFFFFFFF)
            rounds.append(len(named))
            following += len(named)
            at, kind = at[take], kind[take]
            seq[at] = names[kind]
            last[at] = last[at + 1]
            keep = np.ones(len(seq), bool)
            keep[at + 1] = False
            seq, last = seq[keep], last[keep]
        # At the last threshold on and on: a round forms new pairs. Only shared buckets or overlaps are left when none is replaced.
        if threshold == LEAST_COUNT and following == before:
            break
    ends = np.flatnonzero(last) + 1
    symbols = np.zeros(len(lengths), np.int64)
    symbols[lengths > 0] = np.diff(ends, prepend=0)
    left = np.concatenate(left_of) if left_of else np.empty(0, np.int64)
    right = np.concatenate(right_of) if right_of else np.empty(0, np.int64)
    length = np.ones(following, np.int64)
    done = vocabulary
    for n in rounds:
        part = slice(done - vocabulary, done - vocabulary + n)
        length[done:done + n] = length[left[part]] + length[right[part]]
        done += n
    width = 2 if following <= 1 << 16 else 4
    head = b"RPG1" + struct.pack("<5I", vocabulary, len(left), len(seq), width, len(rounds)) + np.array(rounds, "<u4").tobytes()
    body = [x.astype("<u4").tobytes() for x in (left, right, length[vocabulary:])]
    return head + b"".join(body) + seq.astype(f"<u{width}").tobytes(), symbols


class Shard:
    """A payload opened for decoding."""

    def __init__(self, payload: bytes):
        if payload[:4] != b"RPG1":
            raise ValueError("not a shard of token ids")
        self.base, n, m, width, k = struct.unpack_from("<5I", payload, 4)
        at = 24
        rounds = np.frombuffer(payload, "<u4", k, at)
        at += 4 * k
        self.left, self.right, self.length = (np.frombuffer(payload, "<u4", n, at + 4 * n * i).astype(np.int64) for i in range(3))
        self.symbols = np.frombuffer(payload, f"<u{width}", m, at + 12 * n).astype(np.int64)
        # Expansions of all rules, one round after the other: a round uses earlier symbols only.
        self.at = B.starts(np.concatenate([np.ones(self.base, np.int64), self.length]))
        self.flat = np.empty(self.at[-1], np.uint32)
        self.flat[:self.base] = np.arange(self.base)
        done = 0
        for r in rounds.tolist():
            both = np.stack([self.left[done:done + r], self.right[done:done + r]], axis=1).ravel()
            self.flat[self.at[self.base + done]:self.at[self.base + done + r]] = self._expand(both)
            done += r

    def _expand(self, symbols):
        return self.flat[B.ranges(self.at[symbols], self.at[symbols + 1] - self.at[symbols])]

    def ids(self, first: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids of the symbols first..stop."""
        return self._expand(self.symbols[first:stop])

    def span(self, first: int, stop: int, a: int, b: int) -> np.ndarray:
        """Ids a..b of the document that the symbols first..stop hold; only the symbols that reach into it are expanded."""
        part = self.symbols[first:stop]
        ends = np.cumsum(self.at[part + 1] - self.at[part])
        i, j = int(np.searchsorted(ends, a, side="right")), int(np.searchsorted(ends, b, side="left")) + 1
        before = int(ends[i - 1]) if i else 0
        return self._expand(part[i:j])[a - before:b - before]


def write(df: DataFrame, path: str, key: str, text: str, tokenizer: str, end_id: int, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode, compress and write all documents in ascending key order below `path`."""
    source = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    # Rows that repeat a key are ordered by their texts, and spread by a hash of them.
    ordered = source.withColumn("nth", F.xxhash64("text")).repartitionByRange("key", "nth").sortWithinPartitions("key", "nth", "text").select("key", "text")
    columns = ["part", "seq", "keys", "lengths", "symbols", "n_tokens", "payload"]

    def run(batches):
        cache, part, seq = WordCache(tokenizer), TaskContext.get().partitionId(), 0
        keys, ids, lengths, size = [], [], [], 0

        def shard():
            nonlocal seq, keys, ids, lengths, size
            n = np.concatenate(lengths)
            payload, symbols = compress(np.concatenate(ids), n, cache.size)
            names = pa.concat_arrays(keys)
            row = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
                *[pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), pa.array(x)) for x in (n, symbols)],
                pa.array([int(n.sum())]), pa.array([payload], pa.binary())], names=columns)
            seq, keys, ids, lengths, size = seq + 1, [], [], [], 0
            return row

        for batch in batches:
            for a, data, offsets in B.blocks(batch, "text", TEXT_BYTES):
                got, count = cache.encode(data, offsets)
                stops = np.cumsum(count)
                got, count = np.insert(got, stops, end_id), count + 1
                at, row = B.starts(count), 0
                while row < len(count):
                    stop = int(np.searchsorted(at, at[row] + shard_tokens - size, side="right")) - 1
                    stop = min(max(stop, row + (size == 0)), len(count))
                    if stop > row:
                        keys.append(batch.column(0).slice(a + row, stop - row))
                        ids.append(got[at[row]:at[stop]])
                        lengths.append(count[row:stop])
                        size += int(at[stop] - at[row])
                    row = stop
                    if row < len(count) or size >= shard_tokens:
                        yield shard()
        if lengths:
            yield shard()

    ordered.mapInArrow(run, f"part int, seq int, keys array<{kind}>, lengths array<bigint>, symbols array<bigint>, n_tokens long, payload binary").write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def offsets(shards: DataFrame) -> DataFrame:
    """(part, seq, base): ids before each shard, by sums of parts and then of the shards of a part."""
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inner = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return shards.select("part", "seq", inner.alias("inner"), "n_tokens").join(parts.select("part", before.alias("before")), "part").select(
        "part", "seq", (F.col("before") + F.col("inner")).alias("base"))


def documents(shards: DataFrame, key: str, with_ids: bool = False) -> DataFrame:
    """One row per document, decoded: key, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked, ids."""
    kind = shards.schema["keys"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.column(5)[i].as_py())
                keys, lengths = batch.column(2)[i].values, batch.column(3)[i].values.to_numpy()
                ids, at = shard.ids().astype("<u4"), B.starts(lengths)
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])]
                n = len(lengths)
                rest = [pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int64)))] if with_ids else []
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, batch.column(0)[i].as_py(), np.int32)), pa.array(np.full(n, batch.column(1)[i].as_py(), np.int32)), keys,
                    pa.array(at[:-1]), pa.array(lengths), pa.array(crc, pa.int64()), *rest], names=names)

    names = ["part", "seq", "key", "inside", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    rows = shards.select("part", "seq", "keys", "lengths", "symbols", "payload").mapInArrow(
        run, f"part int, seq int, key {kind}, inside long, n_tokens long, ids_crc32 long" + ", ids array<bigint>" * with_ids)
    return rows.join(offsets(shards), ["part", "seq"]).select(
        F.col("key").alias(key), (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
