"""SentencePiece encoding that keeps, for every piece, the bytes of the original text it stands for.

Normalisation follows the model's compiled character map (a double array of replacements): at each place the longest
key is replaced, and without one the character stays. For all characters of a block the keys are walked together, one byte at a
time. Every byte of the normalised text records the place of the source that it came from, through replaced characters,
white space that is dropped or written as the space symbol, and the space put before the text. A piece's bounds in the
normalised text give its span of original bytes.

In byte-pair models no piece goes on into white space after another character, so a normalised text falls apart into
words (space symbols and what follows) that are encoded by themselves. The library encodes each word once a worker, with a copy
of the model that normalises nothing; a memory of `WORDS` words gives their ids and bounds after that. Models where this does not
hold (other kinds, pieces that hold a space symbol inside) encode whole normalised texts.

Results for special inputs: null text is empty, and empty texts are the begin and end ids alone; repeated rows get equal
results; an empty table gives no row; other columns are ignored. Models with user-defined symbols, without byte fallback, or that
put the space symbol after words, are refused with a ValueError.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strideframe.llm import blocks as B

# Fixed values of the model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
SPACE = "▁".encode()

WORDS = 400_000             # words that a worker remembers; the memory is cleared beyond
LONGEST = 64                # bytes of a word that is remembered


def _varint(b, i):
    x = shift = 0
    while True:
        c = b[i]
        i += 1
        x |= (c & 127) << shift
        shift += 7
        if c < 128:
            return x, i


def _fields(b):
    """(number, wire type, value, raw bytes) of the fields of a message."""
    i = 0
    while i < len(b):
        begin = i
        tag, i = _varint(b, i)
        wire = tag & 7
        if wire == 0:
            value, i = _varint(b, i)
        else:
            size = {1: 8, 5: 4}.get(wire)
            if size is None:
                size, i = _varint(b, i)
            value = b[i:i + size]
            i += size
        yield tag >> 3, wire, value, b[begin:i]


def _message(number, body):
    out, n = bytearray([number << 3 | 2]), len(body)
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out) + body


class Model:
    """What a model file says: pieces, kinds, settings, character map."""

    def __init__(self, raw: bytes):
        self.pieces, self.kinds, rest, norm, train = [], [], [], b"", b""
        for number, _, value, whole in _fields(raw):
            if number == 1:
                own = {n: v for n, _, v, _ in _fields(value)}
                self.pieces.append(own[1])
                self.kinds.append(own.get(3, NORMAL))
            if number == 3:
                norm = value
            else:
                rest.append(whole)
            if number == 2:
                train = value
        spec, trained = ({n: v for n, _, v, _ in _fields(x)} for x in (norm, train))
        self.charsmap = spec.get(2, b"")
        self.dummy, self.squeeze, self.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
        if USER_DEFINED in self.kinds or trained.get(24, 0) or not trained.get(35, 0):
            raise ValueError("models with user-defined symbols, with the space symbol after words or without byte fallback are not supported")
        self.kind = trained.get(3, 1)
        # Normalises nothing: no map, no space before, none dropped or written otherwise.
        self.bare = b"".join(rest) + _message(3, b"\x0a\x08identity\x18\x00\x20\x00\x28\x00")
        inside = any(b" " in p.replace(SPACE, b" ").lstrip(b" ") for p in self.pieces)
        self.by_words = self.kind == BPE and self.escape and not inside


class Normaliser:
    def __init__(self, model: Model):
        self.dummy, self.squeeze, self.space = model.dummy, model.squeeze, SPACE if model.escape else b" "
        self.units = None
        if model.charsmap:
            size = int.from_bytes(model.charsmap[:4], "little")
            self.units = np.frombuffer(model.charsmap, "<u4", size // 4, 4).astype(np.int64)
            self.strings = np.frombuffer(model.charsmap[4 + size:], np.uint8)
            self.ends = np.flatnonzero(self.strings == 0)
            if b"  " in model.charsmap[4 + size:] and self.squeeze:
                raise ValueError("a character map with double spaces is not supported")

    @staticmethod
    def _offset(unit):
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, data, begin, stop):
        """(bytes of the longest key at each place, 0 for none, and where its replacement starts)."""
        length, value = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
        alive, step = np.arange(len(begin)), 0
        node = np.full(len(begin), self._offset(self.units[0]))
        while True:
            more = begin[alive] + step < stop[alive]
            alive, node = alive[more], node[more]
            if not len(alive):
                return length, value
            byte = data[begin[alive] + step].astype(np.int64)
            node = node ^ byte
            unit = self.units[np.minimum(node, len(self.units) - 1)]
            same = (unit & 0x800000FF) == byte
            alive, node, unit = alive[same], node[same], unit[same]
            node = node ^ self._offset(unit)
            step += 1
            leaf = (unit >> 8) & 1 == 1
            length[alive[leaf]] = step
            value[alive[leaf]] = self.units[node[leaf]] & 0x7FFFFFFF

    def units_of(self, data, offsets):
        """(buffer, start, size, source, document) of what each replaced or kept character becomes."""
        begin = np.flatnonzero((data & 0xC0) != 0x80)
        end = np.append(begin[1:], len(data))
        doc = np.searchsorted(offsets, begin, side="right") - 1
        if self.units is None:
            return data, begin, end - begin, begin, doc
        length, value = self.longest(data, begin, offsets[doc + 1])
        stop = np.where(length > 0, begin + length, end)
        # Characters inside a longer key before them are part of it; keys count from the left.
        keep = np.ones(len(begin), bool)
        reach = 0
        for i in np.flatnonzero(stop > end).tolist():
            if begin[i] >= reach:
                reach = stop[i]
                keep[i + 1:np.searchsorted(begin, reach)] = False
        begin, stop, doc, length, value = (x[keep] for x in (begin, stop, doc, length, value))
        size = np.where(length > 0, self.ends[np.searchsorted(self.ends, value)] - value if len(self.ends) else 0, stop - begin)
        return np.concatenate([data, self.strings]), np.where(length > 0, len(data) + value, begin), size, begin, doc

    def __call__(self, data, offsets):
        """(normalised bytes, their offsets, source place of each byte and of each text's end).

        Places count from the text's first byte; those of text i start at its offset + i.
        """
        m = len(offsets) - 1
        if self.units is None and not self.squeeze:
            return self._plain(data, offsets)
        buffer, start, size, source, doc = self.units_of(data, offsets)
        body = buffer[B.ranges(start, size)]
        unit = np.repeat(np.arange(len(size)), size)
        row, blank = doc[unit], body == 32
        end_place = np.diff(offsets)
        if self.squeeze:
            first = np.append(True, row[1:] != row[:-1]) if len(row) else np.empty(0, bool)
            before = np.append(True, blank[:-1]) if len(row) else np.empty(0, bool)
            keep = ~(blank & (first | before))
            # Of what is left, a space at a text's end goes too; the text then ends where that began.
            at = np.flatnonzero(keep)
            last = at[np.append(row[at][1:] != row[at][:-1], True)] if len(at) else at
            last = last[blank[last]]
            keep[last] = False
            end_place[row[last]] = (source[unit[last]] - offsets[row[last]])
            body, unit, row, blank = body[keep], unit[keep], row[keep], blank[keep]
        width = np.where(blank, len(self.space), 1)
        filled = np.bincount(row, minlength=m) > 0 if self.squeeze else np.diff(offsets) > 0
        if self.squeeze:
            end_place[~filled] = 0
        head = len(self.space) if self.dummy else 0
        lead = np.where(filled, head, 0)
        sizes = np.bincount(row, width, minlength=m).astype(np.int64) + lead
        out_at = B.starts(sizes)
        place = np.cumsum(width) - width
        inner = B.starts(sizes - lead)[:-1]
        where = place - inner[row] + out_at[row] + lead[row]
        out = np.empty(out_at[-1], np.uint8)
        origin = np.empty(out_at[-1] + m, np.int64)
        origin[out_at[1:] + np.arange(m)] = end_place
        local = source[unit] - offsets[row]
        out[where[~blank]] = body[~blank]
        for k, c in enumerate(self.space):
            out[where[blank] + k] = c
            origin[where[blank] + k + row[blank]] = local[blank]
        origin[where[~blank] + row[~blank]] = local[~blank]
        # The space before the text stands where its first character does that is no white space to drop.
        rows = np.flatnonzero(lead > 0)
        if len(rows):
            begin = np.zeros(m, np.int64)
            if self.squeeze:
                solid = np.flatnonzero((size != 1) | (buffer[np.minimum(start, len(buffer) - 1)] != 32))[::-1]
                begin[doc[solid]] = source[solid] - offsets[doc[solid]]
            begin = begin[rows]
            for k in range(head):
                out[out_at[rows] + k] = self.space[k]
                origin[out_at[rows] + k + rows] = begin
        return out, out_at, origin


    def _plain(self, data, offsets):
        """The same where no character is replaced and no space dropped: each byte stands for itself, a space for its symbol."""
        raw, at = data.tobytes(), offsets.tolist()
        head = self.space if self.dummy else b""
        texts = [head + raw[a:b].replace(b" ", self.space) if b > a else b"" for a, b in zip(at, at[1:])]
        sizes = np.diff(offsets)
        # One more place for each text's end.
        often = np.ones(len(data) + len(sizes), np.int32)
        rows = np.arange(len(sizes))
        place = np.arange(len(often), dtype=np.int32) - np.repeat((offsets[:-1] + rows).astype(np.int32), sizes + 1)
        blank = np.flatnonzero(data == 32)
        often[blank + np.searchsorted(offsets, blank, side="right") - 1] = len(self.space)
        filled = sizes > 0
        often[(offsets[:-1] + rows)[filled]] += len(head)
        return np.frombuffer(b"".join(texts), np.uint8), B.starts(np.fromiter(map(len, texts), np.int64, len(texts))), np.repeat(place, often)


class Encoder:
    """Ids and normalised bounds of the pieces of normalised texts."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            self.model = Model(f.read())
        self.normalise = Normaliser(self.model)
        self.library = sentencepiece.SentencePieceProcessor()
        self.library.LoadFromSerializedProto(self.model.bare)
        self.whole = sentencepiece.SentencePieceProcessor(model_file=path)
        self.sizes = np.array([1 if k == BYTE else len(p) for p, k in zip(self.model.pieces, self.model.kinds)], np.int64)
        self.bytes = np.array([int(p[1:-1], 16) if k == BYTE else -1 for p, k in zip(self.model.pieces, self.model.kinds)], np.int64)
        self._clear()

    def _clear(self):
        self.slots, self.ids, self.at = {}, [np.empty(0, np.uint32)], [0]
        self.flat = None

    def _learn(self, words):
        found = self.library.encode(words, num_threads=1)
        for w, ids in zip(words, found):
            self.slots[w] = len(self.slots)
            self.at.append(self.at[-1] + len(ids))
        self.ids.append(np.fromiter(itertools.chain.from_iterable(found), np.uint32))
        self.flat = None

    def _tables(self):
        if self.flat is None:
            self.ids = [np.concatenate(self.ids)]
            self.flat = self.ids[0], np.array(self.at, np.int64)
        return self.flat

    def _words(self, data, offsets):
        """Where the words of normalised texts start: at a text and where space symbols start after something else."""
        space = np.zeros(len(data), bool)
        if len(data) >= 3:
            hit = np.flatnonzero((data[:-2] == SPACE[0]) & (data[1:-1] == SPACE[1]) & (data[2:] == SPACE[2]))
            space[hit] = True
            after = np.zeros(len(data) + 3, bool)
            after[hit + 3] = True
            space &= ~after[:len(data)]
        space[offsets[:-1][np.diff(offsets) > 0]] = True
        return np.flatnonzero(space)

    def encode(self, data, offsets):
        """(ids, begin and end of each in the normalised block, ids of each text)."""
        first = self._words(data, offsets) if self.model.by_words else offsets[:-1][np.diff(offsets) > 0]
        stop = np.append(first[1:], len(data))
        raw = data.tobytes()
        words = [raw[a:b] for a, b in zip(first.tolist(), stop.tolist())]
        if len(self.slots) > WORDS:
            self._clear()
        new = list(set(words).difference(self.slots))
        if new:
            self._learn(new)
        slot = np.fromiter(map(self.slots.__getitem__, words), np.int64, len(words))
        ids, at = self._tables()
        count = at[slot + 1] - at[slot]
        got = ids[B.ranges(at[slot], count)]
        if any(len(w) > LONGEST for w in new):
            self._forget()
        begin, end = self.bounds(got, np.repeat(first, count))
        return got, begin, end, np.diff(B.starts(count)[np.searchsorted(first, offsets)])

    def _forget(self):
        """Long words are not kept."""
        ids, at = self._tables()
        keep = [(w, k) for w, k in self.slots.items() if len(w) <= LONGEST]
        slot = np.array([k for _, k in keep], np.int64)
        count = at[slot + 1] - at[slot]
        self.slots = {w: i for i, (w, _) in enumerate(keep)}
        self.ids, self.at, self.flat = [ids[B.ranges(at[slot], count)]], B.starts(count).tolist(), None

    def bounds(self, ids, word):
        """Begin and end of each piece: pieces follow each other from their word's start, bytes of one character share its bounds.

        As in the library, the last byte of a character stands for all of it, the others for nothing at its start.
        """
        size = self.sizes[ids]
        end = np.cumsum(size)
        new = np.append(True, word[1:] != word[:-1]) if len(word) else np.empty(0, bool)
        base = (end - size)[new][np.cumsum(new) - 1] if len(word) else end
        end = end - base + word
        begin = end - size
        byte = self.bytes[ids]
        lead = (byte >= 0) & ((byte & 0xC0) != 0x80)
        of = np.maximum.accumulate(np.where(lead, np.arange(len(ids)), 0)) if len(ids) else np.empty(0, np.int64)
        part = byte >= 0
        begin = np.where(part, begin[of], begin)
        last = part & ~np.append(part[1:] & ~lead[1:], False) if len(ids) else part
        return begin, np.where(part & ~last, begin, end)


_ENCODERS = B.Kept()


def _encoder(path):
    """The encoder of this worker; its memory serves later batches and tasks where the worker is used again."""
    import sentencepiece

    kept = sentencepiece.__dict__.setdefault("_encoders", _ENCODERS)
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def _encoded(df, columns, model, schema, row):
    """Rows of `row(encoder, data, offsets, ids, begin, end, counts)` beside the kept columns."""
    source = df.select(*columns)
    kinds = ", ".join(f"k{i} {source.schema[i].dataType.simpleString()}" for i in range(len(columns) - 1))
    names = [f"k{i}" for i in range(len(columns) - 1)] + [x.split()[0] for x in schema.split(", ")]
    source = source.toDF(*names[:len(columns) - 1], "text")

    def run(batches):
        own = _encoder(model)
        for batch in batches:
            for a, data, offsets in B.blocks(batch, "text"):
                norm, at, origin = own.normalise(data, offsets)
                ids, begin, end, counts = own.encode(norm, at)
                # Place k of text i is origin[k + i]; an end is the place after the piece, so both are looked up alike.
                doc = np.repeat(np.arange(len(counts)), counts)
                spans = origin[begin + doc], origin[end + doc]
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, len(counts)) for i in range(len(columns) - 1)), *row(own, ids, *spans, counts)], names=names)

    return source.mapInArrow(run, f"{kinds}, {schema}").toDF(*columns[:-1], *names[len(columns) - 1:])


def encode(df: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, begin, end): the pieces of every row and the bytes of its text that each stands for, without begin and end ids."""
    def row(own, ids, begin, end, counts):
        at = pa.array(B.starts(counts).astype(np.int32))
        return [pa.ListArray.from_arrays(at, pa.array(x)) for x in (ids.astype(np.int32), begin.astype(np.int64), end.astype(np.int64))]

    return _encoded(df, [key, text], model, "ids array<int>, begin array<bigint>, end array<bigint>", row)


def digests(df: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256, spans_crc32) of every row, with begin and end ids; spans are those of the pieces."""
    def row(own, ids, begin, end, counts):
        at = B.starts(counts)
        bos, eos = own.whole.bos_id(), own.whole.eos_id()
        # Begin and end ids around each text.
        full = np.insert(ids.astype("<u4"), np.stack([at[:-1], at[1:]], axis=1).ravel(), np.tile(np.array([bos, eos], "<u4"), len(counts)))
        cut = B.starts(counts + 2).tolist()
        spans = np.stack([begin, end], axis=1).astype("<i8")
        lists = [full[a:b].tolist() for a, b in zip(cut, cut[1:])]
        decoded = own.whole.decode(lists, num_threads=1)
        raw = full.tobytes()
        return [pa.array(counts + 2, pa.int64()), pa.array([hashlib.sha256(raw[4 * a:4 * b]).hexdigest() for a, b in zip(cut, cut[1:])], pa.string()),
                pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
                pa.array([zlib.crc32(spans[a:b].tobytes()) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.int64())]

    return _encoded(df, [key, text], model, "n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long", row)
