"""Fill-in-middle arrangement by a piece table.

A block of documents is two immutable buffers, its texts and the three sentinels, and a table of descriptors (document,
buffer, start, stop). Cutting splits a document's one descriptor at two token ends into prefix, middle and suffix; an
arrangement permutes them and puts sentinel descriptors between; hashes stream the descriptors' bytes; the output is the
descriptors' bytes one after the other. Restoring cuts an output at its sentinels, which gives descriptors again, and
applies the inverse permutation.

A token is a run of other characters with the white space before it, or white space at the end. Cuts and choices are
numbers of the SHA-256 of `seed:key`.

Forms: `plain` is the text; `psm` is <P>prefix<S>suffix<M>middle; `spm` is <S>suffix<P>prefix<M>middle. Empty texts
and texts that contain a sentinel stay plain, so that every output can be restored.

Results for special inputs: null text is empty; a null key is hashed as an empty string; repeated rows get equal outputs; an
empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.llm import blocks as B

SEED, SHARE, SPM_SHARE = 42, 50, 80
PLAIN, PSM, SPM = "plain", "psm", "spm"
SENTINELS = b"<P><S><M>"
PREFIX, SUFFIX, MIDDLE = 0, 1, 2
# Order of the parts of each arrangement, each after its sentinel; the inverse puts them back as prefix, middle, suffix.
ORDERS = {PSM: (PREFIX, SUFFIX, MIDDLE), SPM: (SUFFIX, PREFIX, MIDDLE)}
INSIDE = B.byte_set((32, 32), (9, 13))


class Pieces:
    """A piece table over a block of texts: descriptors are rows of (document, start, stop), sentinels lie behind the texts."""

    def __init__(self, data: np.ndarray):
        self.buffer = np.concatenate([data, np.frombuffer(SENTINELS, np.uint8)])
        self.view = memoryview(self.buffer)
        self.end = len(data)

    def arranged(self, parts, form) -> tuple[np.ndarray, np.ndarray]:
        """(start, stop) of the six descriptors of each document; parts are its prefix, suffix and middle as (documents, 3, 2)."""
        order = np.array(ORDERS[form])
        table = np.empty((len(parts), 6, 2), np.int64)
        table[:, 0::2, 0] = self.end + 3 * order
        table[:, 0::2, 1] = self.end + 3 * order + 3
        table[:, 1::2] = parts[:, order]
        return table[..., 0], table[..., 1]

    def sha256(self, start, stop) -> str:
        h = hashlib.sha256()
        for a, b in zip(start, stop):
            h.update(self.view[a:b])
        return h.hexdigest()

    def written(self, starts, stops, counts):
        """(bytes, bytes per document) of all documents' descriptors in order."""
        sizes = stops - starts
        return self.buffer[B.ranges(starts, sizes)], np.diff(B.starts(sizes)[B.starts(counts)])


def _sentinels(data, offsets):
    """(place, which, document) of every sentinel inside a text, in order."""
    if len(data) < 3:
        return (np.empty(0, np.int64),) * 3
    at = np.flatnonzero((data[:-2] == 60) & (data[2:] == 62))
    kind = np.full(256, -1)
    kind[list(b"PSM")] = PREFIX, SUFFIX, MIDDLE
    at = at[kind[data[at + 1]] >= 0]
    doc = np.searchsorted(offsets, at, side="right") - 1
    inside = at + 3 <= offsets[doc + 1]
    return at[inside], kind[data[at[inside] + 1]], doc[inside]


def _chars(data, first, stop):
    """Code points of pieces that may overlap."""
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=total[1:])
    return total[stop] - total[first]


def _numbers(digests) -> np.ndarray:
    """The first four 32-bit numbers of hexadecimal digests."""
    raw = np.frombuffer(bytes.fromhex("".join(digests)), ">u4").reshape(-1, 8)
    return raw[:, :4].astype(np.int64)


def _emit(start, stop, counts, table):
    data, sizes = table.written(start, stop, counts)
    return B.as_binary(data, sizes).cast(pa.string())


def arrange(df: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, share: int = SHARE, spm_share: int = SPM_SHARE) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output, output_sha256) of every row; n counts tokens.

    `share` in 100 documents are rearranged, `spm_share` in 100 of those with the suffix first.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    source = df.select(F.col(key).alias("key"), F.col(text).alias("text"), digest.alias("digest"))
    kind = source.schema["key"].dataType.simpleString()

    def block(data, offsets, digests):
        n_docs = len(offsets) - 1
        _, stop, words = B.words(data, offsets, INSIDE)
        filled = np.diff(offsets) > 0
        last = np.where(filled, data[np.maximum(offsets[1:] - 1, 0)] if len(data) else 0, 0)
        tail = filled & ~INSIDE[last]
        n = words + tail
        h = _numbers(digests)
        one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
        first_word = B.starts(words)[:-1]

        def end_of(k):
            """Where the first k tokens of each document end."""
            inner = np.clip(first_word + k - 1, 0, max(len(stop) - 1, 0))
            at = stop[inner] if len(stop) else np.zeros(n_docs, np.int64)
            return np.where(k == 0, offsets[:-1], np.where(k > words, offsets[1:], at))

        a, b = end_of(np.minimum(one, two)), end_of(np.maximum(one, two))
        marked = np.zeros(n_docs, bool)
        marked[_sentinels(data, offsets)[2]] = True
        plain = ~filled | marked | (h[:, 2] % 100 >= share)
        spm = h[:, 3] % 100 < spm_share
        form = np.where(plain, PLAIN, np.where(spm, SPM, PSM))
        table = Pieces(data)
        parts = np.stack([np.stack([offsets[:-1], a], axis=1), np.stack([b, offsets[1:]], axis=1), np.stack([a, b], axis=1)], axis=1)
        counts = np.where(plain, 1, 6)
        at = B.starts(counts)
        start, end = np.empty(at[-1], np.int64), np.empty(at[-1], np.int64)
        start[at[:-1][plain]], end[at[:-1][plain]] = offsets[:-1][plain], offsets[1:][plain]
        for name in ORDERS:
            rows = np.flatnonzero(form == name)
            place = (at[rows][:, None] + np.arange(6)).ravel()
            s, e = table.arranged(parts[rows], name)
            start[place], end[place] = s.ravel(), e.ravel()
        s, e, at = start.tolist(), end.tolist(), at.tolist()
        sha = [table.sha256(s[i:j], e[i:j]) for i, j in zip(at, at[1:])]
        chars = [pa.array(_chars(data, x, y), pa.int64(), mask=plain) for x, y in ((offsets[:-1], a), (a, b))]
        return [pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()), *chars, _emit(start, end, counts, table), pa.array(sha, pa.string())]

    def run(batches):
        for batch in batches:
            for a, data, offsets in B.blocks(batch, "text"):
                m = len(offsets) - 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, m), *block(data, offsets, batch.column(2).slice(a, m).to_pylist())],
                                                 names=["key", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256"])

    out = source.mapInArrow(run, f"key {kind}, n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string")
    return out.withColumnRenamed("key", key)


def restore(df: DataFrame, keep: list[str], output: str = "output", form: str = "form") -> DataFrame:
    """(kept columns, text, restored_sha256) of every row, from the output and its form alone.

    A null output, a null or unknown form, and an output whose sentinels are not those of its form give nulls.
    """
    source = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(output).alias("output"), F.col(form).alias("form"))
    kinds = "".join(f"k{i} {source.schema[i].dataType.simpleString()}, " for i in range(len(keep)))
    names = [*(f"k{i}" for i in range(len(keep))), "text", "restored_sha256"]

    def block(data, offsets, forms, known):
        m = len(forms)
        table = Pieces(data)
        at, which, doc = _sentinels(data, offsets)
        found = np.bincount(doc, minlength=m)
        start = np.repeat(offsets[:-1][:, None], 3, axis=1)
        stop = start.copy()
        start[:, 0], stop[:, 0] = offsets[:-1], offsets[1:]
        good = (forms == PLAIN) & known
        first = B.starts(found)[:-1]
        for name, order in ORDERS.items():
            rows = np.flatnonzero((forms == name) & (found == 3) & known)
            marks = first[rows][:, None] + np.arange(3)
            right = (which[marks] == np.array(order)).all(axis=1) & (at[marks[:, 0]] == offsets[rows]) if len(rows) else np.zeros(0, bool)
            rows, marks = rows[right], marks[right]
            # The descriptors between the sentinels, put back by the inverse permutation.
            begin = at[marks] + 3
            end = np.concatenate([at[marks[:, 1:]], offsets[rows + 1][:, None]], axis=1)
            back = [order.index(k) for k in (PREFIX, MIDDLE, SUFFIX)]
            start[rows], stop[rows] = begin[:, back], end[:, back]
            good[rows] = True
        s, e = start.tolist(), stop.tolist()
        sha = [table.sha256(x, y) if ok else None for x, y, ok in zip(s, e, good.tolist())]
        whole, sizes = table.written(start.ravel(), stop.ravel(), np.full(m, 3))
        texts = B.as_binary(whole, sizes).cast(pa.string())
        return [pc.if_else(pa.array(good), texts, pa.nulls(m, pa.string())), pa.array(sha, pa.string())]

    def run(batches):
        for batch in batches:
            k = len(keep)
            known = np.asarray(batch.column(k).is_valid())
            forms = np.array(batch.column(k + 1).fill_null("").to_pylist(), object)
            for a, data, offsets in B.blocks(batch, "output"):
                m = len(offsets) - 1
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, m) for i in range(k)), *block(data, offsets, forms[a:a + m], known[a:a + m])], names=names)

    out = source.mapInArrow(run, f"{kinds}text string, restored_sha256 string")
    return out.toDF(*keep, "text", "restored_sha256")
