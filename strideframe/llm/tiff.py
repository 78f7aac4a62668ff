"""TIFF columns: directories walked, strips and tiles decoded, one row per page.

Results for special inputs: a null or empty file has no page; a file that is no TIFF, or whose
directory or data are damaged, gives one row with `error` set and null samples for the page that
fails (the walk stops there); repeated rows give repeated pages; further columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strideframe.llm import blocks as B

# Fixed values of the format.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS = 256, 257, 258, 259, 262, 273, 277, 278, 279
PLANAR, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS, SUB_IFDS, SAMPLE_FORMAT = 284, 317, 322, 323, 324, 325, 330, 339
RAW, LZW, DEFLATE, DEFLATE_OLD, PACKBITS = 1, 5, 8, 32946, 32773
NAMES = {RAW: "none", LZW: "lzw", DEFLATE: "deflate", DEFLATE_OLD: "deflate", PACKBITS: "packbits"}
TYPES = {1: "B", 2: "c", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 18: "Q"}
CLEAR, END, FIRST, FULL = 256, 257, 258, 4094

ROW = 64                      # samples per row of stored payloads
PAGE_ROWS, STRIP_ROWS, TILE = 2048, 256, 64
# How stored payloads are laid out; chosen by the payload's own checksum.
LAYOUTS = ((PACKBITS, False, 1), (LZW, True, 1), (DEFLATE, False, 2), (DEFLATE, True, 1), (PACKBITS, True, 1))
PAGE_SCHEMA = ("page int, sub boolean, width int, height int, samples int, bits int, compression string, predictor int, "
               "tiled boolean, parts int, data binary, error string")


@dataclass
class Page:
    number: int
    sub: bool
    width: int
    height: int
    samples: int
    bits: int
    compression: str
    predictor: int
    tiled: bool
    parts: int
    pixels: np.ndarray = field(repr=False)


# --- LZW: codes of growing width, most significant bit first, width grown one code early

def _widths() -> np.ndarray:
    """Bits of the n-th code after a clear code: the table has 257 + n entries when it is read (258 for the first)."""
    entries = FIRST + np.maximum(np.arange(FULL - FIRST + 2) - 1, 0)
    return 9 + (entries >= 511) + (entries >= 1023) + (entries >= 2047)


_W = _widths()
_AT = np.concatenate([[0], np.cumsum(_W)])


def _pack(codes, widths) -> bytes:
    at = np.concatenate([[0], np.cumsum(widths)])
    shifted = codes << (24 - widths - (at[:-1] & 7))
    place, size = at[:-1] >> 3, int((at[-1] + 7) >> 3)
    out = np.zeros(size + 3)
    for k, shift in enumerate((16, 8, 0)):
        out += np.bincount(place + k, weights=(shifted >> shift) & 255, minlength=size + 3)
    return out[:size].astype(np.uint8).tobytes()


def lzw_encode(data: bytes) -> bytes:
    codes, widths = [np.array([CLEAR])], [np.array([9])]
    table, run, code = {}, [], -1
    entry = FIRST

    def flush(last):
        n = len(run)
        codes.append(np.array(run + [last], np.int64))
        widths.append(np.append(_W[:n], _W[n]))
        run.clear()

    get, emit = table.get, run.append
    for b in data:
        if code < 0:
            code = b
            continue
        key = code << 8 | b
        known = get(key)
        if known is not None:
            code = known
            continue
        emit(code)
        code = b
        table[key] = entry
        entry += 1
        if entry == FULL:
            flush(CLEAR)
            table.clear()
            entry = FIRST
    if code >= 0:
        emit(code)
    flush(END)
    return _pack(np.concatenate(codes), np.concatenate(widths))


def _codes(data: np.ndarray, bit: int) -> tuple[np.ndarray, int, int]:
    """Codes from `bit` to the next clear or end code; that code (END if the data stop) and the bit after it."""
    fit = int(np.searchsorted(_AT, len(data) * 8 - bit, side="right")) - 1
    n = min(fit, len(_W))
    if n <= 0:
        return np.empty(0, np.int64), END, bit
    at = bit + _AT[:n]
    padded = np.concatenate([data[bit >> 3:(bit + int(_AT[n])) // 8 + 1], np.zeros(3, np.uint8)]).astype(np.int64)
    k = (at >> 3) - (bit >> 3)
    got = ((padded[k] << 16 | padded[k + 1] << 8 | padded[k + 2]) >> (24 - _W[:n] - (at & 7))) & ((1 << _W[:n]) - 1)
    stop = np.flatnonzero((got == CLEAR) | (got == END))
    if len(stop) == 0:
        return got, CLEAR if n == len(_W) else END, bit + int(_AT[n])
    s = int(stop[0])
    return got[:s], int(got[s]), bit + int(_AT[s + 1])


def lzw_decode(data: bytes) -> bytes:
    raw, bit, mark, out = np.frombuffer(data, np.uint8), 0, CLEAR, []
    single = [bytes([i]) for i in range(256)] + [b"", b""]
    while mark != END:
        codes, mark, bit = _codes(raw, bit)
        if len(codes) == 0:
            continue
        table = single.copy()
        add, put = table.append, out.append
        codes = codes.tolist()
        last = table[codes[0]]
        put(last)
        for c in codes[1:]:
            if c < len(table):
                now = table[c]
                add(last + now[:1])
            elif c == len(table):
                now = last + last[:1]
                add(now)
            else:
                raise ValueError("LZW code out of range")
            put(now)
            last = now
    return b"".join(out)


# --- PackBits: a row is runs of up to 128 equal bytes and literal stretches of up to 128

def _pack_row(row: bytes) -> bytes:
    out, at, lit, n = bytearray(), 0, 0, len(row)
    while at < n:
        run = 1
        while run < 128 and at + run < n and row[at + run] == row[at]:
            run += 1
        if run < 3 and at + run < n:
            at += run
        else:
            stop = at if run >= 3 else at + run
            for k in range(lit, stop, 128):
                piece = row[k:min(k + 128, stop)]
                out += bytes([len(piece) - 1]) + piece
            if run >= 3:
                out += bytes([257 - run, row[at]])
            at += run
            lit = at
    return bytes(out)


def packbits_encode(rows: np.ndarray) -> bytes:
    """Each row packed by itself; rows without a run of three are written at once."""
    n, width = rows.shape
    if width <= 128:
        runs = ((rows[:, 2:] == rows[:, 1:-1]) & (rows[:, 1:-1] == rows[:, :-2])).any(axis=1)
        plain = np.concatenate([np.full((n, 1), width - 1, np.uint8), rows], axis=1)
    else:
        runs, plain = np.ones(n, bool), rows
    edges = np.flatnonzero(np.diff(runs)) + 1
    parts = []
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), n]):
        parts += [_pack_row(rows[i].tobytes()) for i in range(a, b)] if runs[a] else [plain[a:b].tobytes()]
    return b"".join(parts)


def packbits_decode(data: bytes) -> bytes:
    out, at, n = [], 0, len(data)
    while at < n:
        head = data[at]
        if head < 128:
            out.append(data[at + 1:at + 2 + head])
            at += head + 2
        elif head > 128:
            out.append(data[at + 1:at + 2] * (257 - head))
            at += 2
        else:
            at += 1
    return b"".join(out)


def _inflate(kind: int, data: bytes) -> bytes:
    if kind == RAW:
        return data
    if kind == LZW:
        return lzw_decode(data)
    if kind in (DEFLATE, DEFLATE_OLD):
        return zlib.decompress(data)
    if kind == PACKBITS:
        return packbits_decode(data)
    raise ValueError(f"compression {kind} is not supported")


# --- reading

def _directory(data: bytes, end: str, at: int, big: bool) -> tuple[dict, int]:
    """Tags of the directory at `at` and the place of the next one."""
    head, size, word = ("Q", 20, "Q") if big else ("H", 12, "I")
    (n,) = struct.unpack_from(end + head, data, at)
    at += struct.calcsize("=" + head)
    tags, room = {}, struct.calcsize("=" + word)
    for k in range(n):
        tag, kind, count = struct.unpack_from(end + "HH" + word, data, at + k * size)
        if kind not in TYPES:
            continue
        fmt = f"{end}{count}{TYPES[kind]}"
        need = struct.calcsize(fmt)
        place = at + k * size + 4 + room
        if need > room:
            (place,) = struct.unpack_from(end + word, data, place)
        tags[tag] = struct.unpack_from(fmt, data, place)
    (following,) = struct.unpack_from(end + word, data, at + n * size)
    return tags, following


def _samples(raw: bytes, rows: int, cols: int, per: int, bits: int, kind: int, end: str, predictor: int) -> np.ndarray:
    """Samples of one strip or tile as (rows, cols, per), predictor undone."""
    if bits < 8:
        width = -(-cols * per * bits // 8)
        ones = np.unpackbits(np.frombuffer(raw, np.uint8, rows * width).reshape(rows, width), axis=1)[:, :cols * per * bits]
        weights = 1 << np.arange(bits - 1, -1, -1)
        return (ones.reshape(rows, cols, per, bits) * weights).sum(axis=3).astype(np.uint8)
    if predictor == 3:
        planes = np.frombuffer(raw, np.uint8, rows * cols * per * bits // 8).reshape(rows, -1)
        planes = np.cumsum(planes.reshape(rows, -1, per), axis=1, dtype=np.uint8).reshape(rows, bits // 8, cols * per)
        return planes.transpose(0, 2, 1).copy().view(f">f{bits // 8}").reshape(rows, cols, per)
    dtype = np.dtype(f"{end}{'f' if kind == 3 else 'i' if kind == 2 else 'u'}{bits // 8}")
    out = np.frombuffer(raw, dtype, rows * cols * per).reshape(rows, cols, per)
    if predictor == 2:
        whole = out.astype(f"u{bits // 8}")
        out = np.cumsum(whole, axis=1, dtype=whole.dtype).astype(dtype.newbyteorder("="))
    return out


def _page(data: bytes, end: str, tags: dict, number: int, sub: bool) -> Page:
    one = lambda tag, default=None: tags.get(tag, (default,))[0]
    width, height, per = one(WIDTH), one(HEIGHT), one(SAMPLES, 1)
    bits, kind, pred, planar, form = one(BITS, 1), one(COMPRESSION, RAW), one(PREDICTOR, 1), one(PLANAR, 1), one(SAMPLE_FORMAT, 1)
    if not width or not height or bits not in (1, 2, 4, 8, 16, 32, 64):
        raise ValueError("no image size, or sample bits not supported")
    tiled = TILE_OFFSETS in tags
    if tiled:
        pw, ph, places, counts = one(TILE_WIDTH), one(TILE_HEIGHT), tags[TILE_OFFSETS], tags[TILE_COUNTS]
    else:
        pw, ph, places, counts = width, min(one(ROWS_PER_STRIP, height), height), tags[STRIP_OFFSETS], tags[STRIP_COUNTS]
    across, down = -(-width // pw), -(-height // ph)
    planes, inner = (per, 1) if planar == 2 else (1, per)
    if len(places) < across * down * planes:
        raise ValueError("strips or tiles are missing")
    pixels = None
    for k in range(across * down * planes):
        plane, cell = divmod(k, across * down)
        y, x = cell // across * ph, cell % across * pw
        rows = ph if tiled else min(ph, height - y)
        if places[k] + counts[k] > len(data):
            raise ValueError("data end early")
        got = _samples(_inflate(kind, data[places[k]:places[k] + counts[k]]), rows, pw, inner, bits, form, end, pred)
        if pixels is None:
            pixels = np.zeros((height, width, per), got.dtype.newbyteorder("="))
        h, w = min(ph, height - y), min(pw, width - x)
        pixels[y:y + h, x:x + w, plane:plane + inner] = got[:h, :w]
    return Page(number, sub, width, height, per, bits, NAMES.get(kind, str(kind)), pred, tiled, across * down * planes, pixels)


def pages(data: bytes):
    """Pages in the order of the directories; the sub-directories of a page follow it."""
    end = {b"II": "<", b"MM": ">"}.get(bytes(data[:2]))
    if end is None or len(data) < 8:
        raise ValueError("not a TIFF file")
    (magic,) = struct.unpack_from(end + "H", data, 2)
    if magic not in (42, 43):
        raise ValueError("not a TIFF file")
    big = magic == 43
    (first,) = struct.unpack_from(end + ("Q" if big else "I"), data, 8 if big else 4)
    todo, seen, number = [(first, False)], set(), 0
    while todo:
        at, sub = todo.pop()
        if not at or at in seen:
            continue
        seen.add(at)
        tags, following = _directory(data, end, at, big)
        todo.append((following, sub))
        todo += [(p, True) for p in reversed(tags.get(SUB_IFDS, ()))]
        yield _page(data, end, tags, number, sub)
        number += 1


# --- writing payloads as 8-bit grey pages

def _deflated(kind: int, part: np.ndarray) -> bytes:
    if kind == PACKBITS:
        return packbits_encode(part)
    raw = part.tobytes()
    return lzw_encode(raw) if kind == LZW else zlib.compress(raw, 6) if kind == DEFLATE else raw


def store(payload: bytes) -> bytes:
    """A payload of a multiple of 64 bytes as a TIFF of 64 samples a row, PAGE_ROWS rows a page."""
    kind, tiled, predictor = LAYOUTS[zlib.crc32(payload) % len(LAYOUTS)]
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    out, link = bytearray(b"II" + struct.pack("<HI", 42, 0)), 4
    for a in range(0, len(rows), PAGE_ROWS):
        page = rows[a:a + PAGE_ROWS]
        step = TILE if tiled else STRIP_ROWS
        places, counts = [], []
        for y in range(0, len(page), step):
            part = page[y:y + step]
            if tiled and len(part) < TILE:
                part = np.concatenate([part, np.zeros((TILE - len(part), ROW), np.uint8)])
            if predictor == 2:
                part = np.concatenate([part[:, :1], part[:, 1:] - part[:, :-1]], axis=1)
            stored = _deflated(kind, part)
            places.append(len(out))
            counts.append(len(stored))
            out += stored
        tags = [(WIDTH, "I", [ROW]), (HEIGHT, "I", [len(page)]), (BITS, "H", [8]), (COMPRESSION, "H", [kind]), (PHOTOMETRIC, "H", [1]), (SAMPLES, "H", [1])]
        tags += [(PREDICTOR, "H", [predictor])]
        tags += ([(TILE_WIDTH, "I", [TILE]), (TILE_HEIGHT, "I", [TILE]), (TILE_OFFSETS, "I", places), (TILE_COUNTS, "I", counts)] if tiled
                 else [(STRIP_OFFSETS, "I", places), (ROWS_PER_STRIP, "I", [STRIP_ROWS]), (STRIP_COUNTS, "I", counts)])
        entries = b""
        for tag, code, values in sorted(tags):
            body = struct.pack(f"<{len(values)}{code}", *values)
            if len(body) > 4:
                out += b"\0" * (len(out) % 2)
                body, place = struct.pack("<I", len(out)), body
                out += place
            entries += struct.pack("<HHI", tag, 3 if code == "H" else 4, len(values)) + body.ljust(4, b"\0")
        out += b"\0" * (len(out) % 2)
        out[link:link + 4] = struct.pack("<I", len(out))
        out += struct.pack("<H", len(tags)) + entries + struct.pack("<I", 0)
        link = len(out) - 4
    return bytes(out)


def padded(text: bytes) -> bytes:
    """The text and zero bytes up to a positive multiple of 64."""
    return text + b"\0" * ((-len(text)) % ROW if text else ROW)


# --- tables

DAMAGE = (ValueError, struct.error, zlib.error, KeyError, IndexError, OverflowError, TypeError, MemoryError)      # what reading a damaged file may raise


STORE_BYTES = 4 << 20         # texts stored, or samples decoded, before a batch of rows is sent on


def store_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """Every text as a TIFF: `key`, `n_bytes` (UTF-8, unpadded) and `media`. Null texts count as empty."""
    source = df.select(key, text)
    kind = source.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for a, data, offsets in B.blocks(batch, text, STORE_BYTES):
                media = [store(padded(data[i:j].tobytes())) for i, j in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, len(media)), pa.array(np.diff(offsets)), pa.array(media, pa.binary())],
                    names=[key, "n_bytes", "media"])

    return source.mapInArrow(run, f"`{key}` {kind}, n_bytes long, media binary")


def decode_pages(df: DataFrame, key: str, media: str) -> DataFrame:
    """One row per page of every file: geometry, coding and the samples as bytes, in row order."""
    source = df.select(key, media)
    kind = source.schema[key].dataType.simpleString()
    names = [x.split()[0] for x in PAGE_SCHEMA.split(", ")]

    def rows(value):
        if not value:
            return
        number = 0
        try:
            for p in pages(value):
                number = p.number + 1
                yield (p.number, p.sub, p.width, p.height, p.samples, p.bits, p.compression, p.predictor, p.tiled, p.parts, p.pixels.tobytes(), None)
        except DAMAGE as e:
            yield (number, None, None, None, None, None, None, None, None, None, None, f"{type(e).__name__}: {e}")

    types = [pa.int32(), pa.bool_(), *[pa.int32()] * 4, pa.string(), pa.int32(), pa.bool_(), pa.int32(), pa.binary(), pa.string()]

    def run(batches):
        for batch in batches:
            at, got, size = [], [], 0
            for i, value in enumerate(batch.column(1)):
                for row in rows(value.as_py()):
                    at.append(i)
                    got.append(row)
                    size += len(row[10] or b"")
                    if size > STORE_BYTES:
                        yield emit(batch, at, got)
                        at, got, size = [], [], 0
            if got:
                yield emit(batch, at, got)

    def emit(batch, at, got):
        columns = [pa.array(c, t) for c, t in zip(zip(*got), types)]
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *columns], names=[key, *names])

    return source.mapInArrow(run, f"`{key}` {kind}, {PAGE_SCHEMA}")


def picture_hash(pixels: np.ndarray) -> str:
    """Which of 8 x 8 cells are brighter than the whole picture, as 16 hex digits."""
    flat = pixels.reshape(len(pixels), -1)
    sums = np.add.reduceat(flat.astype(np.int64), np.arange(8) * flat.shape[1] // 8, axis=1)
    rows = np.arange(8) * len(flat) // 8
    cells = np.add.reduceat(sums, rows, axis=0) / np.maximum(np.diff([*rows, len(flat)]), 1)[:, None]
    return np.packbits(cells > cells.mean()).tobytes().hex()


def read_payloads(df: DataFrame, key: str, media: str, keep: list[str]) -> DataFrame:
    """The samples of all pages of a file, read back and joined, as digests and features, one row per file.

    A null or damaged file, or one without a page, has nulls there and 0 pages.
    """
    import hashlib

    source = df.select(key, media, *keep)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields if f.name != media)

    def one(value):
        parts, codes = [], []
        try:
            for p in pages(value or b""):
                parts.append(p.pixels)
                codes.append((p.compression, "tiles" if p.tiled else "strips", p.predictor))
        except DAMAGE:
            parts = []
        if not parts:
            return (None,) * 6 + (0, None)
        whole = np.concatenate(parts)
        body = whole.tobytes()
        code = codes[0]
        return (len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-64:]), len(value), hashlib.sha256(value).hexdigest(),
                f"{picture_hash(whole)}-{whole.mean():.3f}", len(codes), f"{code[0]} {code[1]} {code[2]}")

    names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_pages", "coding"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string()]

    def run(batches):
        for batch in batches:
            got = [one(v.as_py()) for v in batch.column(1)]
            if got:
                rest = [c for i, c in enumerate(batch.columns) if i != 1]
                yield pa.RecordBatch.from_arrays([*rest, *[pa.array(c, t) for c, t in zip(zip(*got), types)]],
                                                 names=[n for i, n in enumerate(batch.schema.names) if i != 1] + names)

    return source.mapInArrow(run, f"{kinds}, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_pages int, coding string")
