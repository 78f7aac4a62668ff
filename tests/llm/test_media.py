"""TIFF storage and decoding against exact round trips and files built by hand."""

import hashlib
import os
import struct
import zlib

import numpy as np
import pytest

from strideframe.llm import tiff as T

SAMPLES = [b"", b"x", b"a" * 64, b"ab" * 5000, b"The cat sat on the mat with a hat. " * 4000, os.urandom(9000), bytes(range(256)) * 300]


@pytest.mark.parametrize("data", SAMPLES)
def test_codecs_and_layouts_round_trip(data, monkeypatch):
    payload = T.padded(data)
    assert len(payload) % 64 == 0 and len(payload) > 0
    assert T.lzw_decode(T.lzw_encode(payload)) == payload
    assert T.packbits_decode(T.packbits_encode(np.frombuffer(payload, np.uint8).reshape(-1, 64))) == payload
    for layout in T.LAYOUTS:
        monkeypatch.setattr(T, "LAYOUTS", (layout,))
        got = list(T.pages(T.store(payload)))
        assert b"".join(p.pixels.tobytes() for p in got) == payload
        assert len(got) == -(-len(payload) // (64 * T.PAGE_ROWS)) and [p.number for p in got] == list(range(len(got)))


def build(pixels, end=">", predictor=1, planar=1, sub=False, compress=zlib.compress, kind=T.DEFLATE, bits=16):
    """A big-endian one-strip file, written independently of the module's writer."""
    h, w, n = pixels.shape
    parts = [pixels[:, :, k:k + 1] for k in range(n)] if planar == 2 else [pixels]
    strips = []
    for part in parts:
        x = part.astype(f"u{bits // 8}")
        if predictor == 2:
            x = np.concatenate([x[:, :1], x[:, 1:] - x[:, :-1]], axis=1)
        strips.append(compress(x.astype(f"{end}u{bits // 8}").tobytes()))
    out, at = bytearray(b"MM" if end == ">" else b"II") + struct.pack(end + "HI", 42, 8), 8
    tags = [(256, "H", [w]), (257, "H", [h]), (258, "H", [bits]), (259, "H", [kind]), (277, "H", [n]), (284, "H", [planar]), (317, "H", [predictor]),
            (273, "I", [0] * len(strips)), (279, "I", [len(s) for s in strips])]
    size = 2 + 12 * len(tags) + 4 + 8 * len(strips)
    first = at + size
    tags[7] = (273, "I", [first + sum(len(s) for s in strips[:k]) for k in range(len(strips))])
    body, extra, room = b"", b"", at + 2 + 12 * len(tags) + 4
    for tag, code, values in sorted(tags):
        raw = struct.pack(f"{end}{len(values)}{code}", *values)
        if len(raw) > 4:
            raw, extra, room = struct.pack(end + "I", room), extra + raw, room + len(raw)
        body += struct.pack(end + "HHI", tag, 3 if code == "H" else 4, len(values)) + raw.ljust(4, b"\0")
    out += struct.pack(end + "H", len(tags)) + body + struct.pack(end + "I", 0) + extra.ljust(8 * len(strips), b"\0") + b"".join(strips)
    return bytes(out)


@pytest.mark.parametrize("end", ["<", ">"])
@pytest.mark.parametrize("predictor,planar,bits", [(1, 1, 16), (2, 1, 16), (2, 2, 8), (1, 2, 32)])
def test_foreign_files(end, predictor, planar, bits):
    pixels = np.random.default_rng(1).integers(0, 250, (7, 5, 3))
    (page,) = T.pages(build(pixels, end, predictor, planar, bits=bits))
    assert (page.pixels == pixels).all() and (page.width, page.height, page.samples) == (5, 7, 3)


def test_tables_with_special_rows(spark):
    rows = [(1, "a text", 5), (2, None, 6), (3, "", 7), (1, "a text", 5), (None, "é" * 200_000, 8), (4, "x", None)]
    df = spark.createDataFrame(rows, "doc_id int, text string, media int")
    got = T.read_payloads(T.store_texts(df, "doc_id", "text"), "doc_id", "media", ["n_bytes"]).collect()
    want = sorted(T.padded((t or "").encode()) for _, t, _ in rows)
    assert sorted((r.payload_bytes, r.payload_sha256) for r in got) == sorted((len(p), hashlib.sha256(p).hexdigest()) for p in want)
    assert {r.tail_crc32 for r in got} == {zlib.crc32(p[-64:]) for p in want}
    same = [r for r in got if r.doc_id == 1]
    assert len(same) == 2 and same[0] == same[1]
    assert T.read_payloads(T.store_texts(df.limit(0), "doc_id", "text"), "doc_id", "media", []).count() == 0


def test_pages_of_damaged_files(spark):
    whole = T.store(T.padded(b"page " * 60_000))
    df = spark.createDataFrame([(1, whole), (2, None), (3, b""), (4, b"no tiff"), (5, whole[:len(whole) // 2])], "id int, file binary")
    got = T.decode_pages(df, "id", "file").collect()
    by = {k: [r for r in got if r.id == k] for k in range(1, 6)}
    assert [r.page for r in by[1]] == list(range(len(by[1]))) and len(by[1]) > 1 and b"".join(bytes(r.data) for r in by[1]) == T.padded(b"page " * 60_000)
    assert by[2] == by[3] == [] and by[4][0].error and by[5][-1].error and by[5][-1].data is None


def test_payloads_of_null_and_damaged_files(spark):
    whole = T.store(T.padded(b"some text"))
    rows = [(1, whole), (2, None), (3, b""), (4, b"no image"), (5, whole[:40]), (6, b"II*\0\0\0\0\0"), (1, whole)]
    got = sorted((tuple(r) for r in T.read_payloads(spark.createDataFrame(rows, "id int, media binary"), "id", "media", []).collect()), key=str)
    assert [r[0] for r in got] == [1, 1, 2, 3, 4, 5, 6] and got[0] == got[1]
    assert got[0][1] == 64 and got[0][2] == hashlib.sha256(T.padded(b"some text")).hexdigest()
    for r in got[2:]:
        assert r[1:] == (None,) * 6 + (0, None)


def test_texts_and_pages_leave_in_small_frames():
    """F16: at most some four MB of texts, or of samples, are held before rows are sent on."""
    import pyarrow as pa
    from pyspark.sql.types import BinaryType, LongType, StructField, StructType
    from strideframe.llm import tiff

    class Frame:
        schema = StructType([StructField("doc_id", LongType()), StructField("media", BinaryType())])

        def select(self, *names):
            return self

        def mapInArrow(self, run, schema):
            return run

    texts = pa.RecordBatch.from_arrays([pa.array(range(12)), pa.array(["a" * (1 << 20)] * 12)], names=["doc_id", "text"])
    stored = list(tiff.store_texts(Frame(), "doc_id", "text")([texts]))
    assert sum(b.num_rows for b in stored) == 12 and max(b.num_rows for b in stored) <= 4
    media = pa.RecordBatch.from_arrays([pa.array(range(12)), pa.concat_arrays([b.column(2) for b in stored])], names=["doc_id", "media"])
    decoded = list(tiff.decode_pages(Frame(), "doc_id", "media")([media]))
    assert len(decoded) >= 3 and max(b.nbytes for b in decoded) < 6 << 20
