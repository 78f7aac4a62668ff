"""Source divergence, fill-in-middle and offset-preserving pieces against plain restatements and the library."""

import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from strideframe.llm import divergence, piece_table, span_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WHITE = "[\x20\x09-\x0d]"
ODD = ["", None, "   ", "\t", "a", " a", "a ", "  a  b \n\t c ﬁ ½ 　 x​\x00y <s> ퟿🙂", "▁x▁▁ y", "é" * 50, "\x00", " <unk></s>", "z" * 3000, "日本語テキスト" * 50,
       "one two <P> three", "<M>", "< P> <S", "x\r\ny\x0b\x0cz\x85w v", "Word " * 2000, "AbC.dEf,ghI-ÄÖ ÄÖ äö 12 x1y"]


def texts(seed=5, n=150):
    rnd = random.Random(seed)
    alphabet = "abC éÄ🙂\n\t<P>SM 中.,7"
    return ODD + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 80))) for _ in range(n)]


# --- how sources differ

def audited(rows, least, top):
    """Every group with every kept term, in exact whole numbers."""
    docs = [((lang or ""), (source or ""), re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        seen = collections.Counter(t for la, _, w in docs if la == lang for t in set(w))
        kept = [t for t, k in seen.items() if k >= least]
        often = {s: collections.Counter(t for la, so, w in docs if (la, so) == (lang, s) for t in w) for s in {d[1] for d in docs if d[0] == lang}}
        every = sum(often.values(), collections.Counter())

        def shares(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10 ** 9 * (count[t] + 5) // (n + 5 * len(kept)) for t in kept}

        own, q = {s: shares(c) for s, c in often.items()}, shares(every)
        for s in own:
            both = {"pair": [(o, sum(abs(own[s][t] - own[o][t]) for t in kept)) for o in own if o != s],
                    "term": [(t, own[s][t] - q[t]) for t in kept if often[s][t] and own[s][t] > q[t]]}
            for part, items in both.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(items) if part == "pair" or k < top]
    return sorted(out)


@pytest.mark.parametrize("held,terms,tile", [(200_000, 1024, 256), (50, 7, 3)])
def test_divergence(spark, monkeypatch, held, terms, tile):
    """Also with Counters sent often, and with many blocks and tiles."""
    for name, value in (("HELD", held), ("TERMS", terms), ("TILE", tile)):
        monkeypatch.setattr(divergence, name, value)
    rnd = random.Random(2)
    vocabulary = [f"{rnd.choice('aAbÄé')}{rnd.choice('xyzQ')}{k % 9 * 'o'}" for k in range(60)]
    rows = [(" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 25))), "en", f"s{rnd.randint(0, 9)}") for _ in range(250)]
    rows += [(t, "de", f"s{k % 2}") for k, t in enumerate(texts())] + [("only one source", None, None)] * 8 + [(None, "xx", "a"), ("", "xx", "b"), ("rare", "xx", None), ("w1 2 3", "en", "hot")] + [("hot words here", "en", "hot")] * 60
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "text string, lang string, source string, n int, term string, idx int").repartition(5)
    got = sorted(tuple(r) for r in divergence.audit(df, least=6, top=4).collect())
    assert got == audited(rows, 6, 4)
    assert divergence.audit(df.limit(0)).count() == 0


def test_terms_of_long_texts_are_counted_piece_by_piece(monkeypatch):
    whole = divergence.count_terms(("ab Cd, é" * 999).encode())
    monkeypatch.setattr(divergence, "PIECE_BYTES", 5)
    assert divergence.count_terms(("ab Cd, é" * 999).encode()) == whole
    assert divergence.count_terms(b"abcdefghijkl mn" + b" " * 20) == {b"abcdefghijkl": 1, b"mn": 1}


# --- filling in the middle

def arranged(key, text, seed=42, share=50, spm_share=80):
    text = text or ""
    w = re.findall(f"{WHITE}*[^\x20\x09-\x0d]+|{WHITE}+", text)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(w) + 1), h[1] % (len(w) + 1)))
    p, m, s = ("".join(x) for x in (w[:a], w[a:b], w[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= share:
        return (key, len(w), "plain", None, None, text)
    if h[3] % 100 < spm_share:
        return (key, len(w), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (key, len(w), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("share", [50, 100, 0])
def test_fill_in_middle(spark, monkeypatch, share):
    monkeypatch.setattr(piece_table.B, "BLOCK_BYTES", 700)
    rows = [(k, t) for k, t in enumerate(texts())] + [(None, "a null key"), (3, "a b c"), (3, "a b c")]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, output string, form int").repartition(3)
    out = piece_table.arrange(df, share=share)
    got = out.collect()
    key = lambda r: (str(r[0]), str(r[5]))
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted((arranged(k, t, share=share) for k, t in rows), key=key)
    assert all(r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest() for r in got)
    assert len({r.form for r in got}) == (1 if not share else 3)
    back = piece_table.restore(out, ["doc_id"]).collect()
    assert sorted((str(r.doc_id), r.text, r.restored_sha256) for r in back) == sorted((str(k), t or "", hashlib.sha256((t or "").encode()).hexdigest()) for k, t in rows)
    assert piece_table.restore(piece_table.arrange(df.limit(0)), ["doc_id"]).count() == 0


def test_restoring_what_is_no_arrangement(spark):
    rows = [(1, "<P>a<S>b<M>c", "psm"), (2, "<P>a<S>b<M>c", "spm"), (3, "<P>a<S>b", "psm"), (4, "x<P>a<S>b<M>c", "psm"), (5, None, "plain"), (6, "t", None), (7, "t", "other"),
            (8, "<P>a<S>b<M>c<M>", "psm"), (9, "<S>b<P>a<M>c", "spm"), (10, "", "plain"), (11, "<P><S><M>", "psm")]
    got = {r.id: r.text for r in piece_table.restore(spark.createDataFrame(rows, "id int, output string, form string"), ["id"]).collect()}
    assert got == {1: "acb", 2: None, 3: None, 4: None, 5: None, 6: None, 7: None, 8: None, 9: "acb", 10: "", 11: ""}


# --- pieces with spans

def test_pieces_equal_the_library(spark, monkeypatch):
    monkeypatch.setattr(span_pieces.B, "BLOCK_BYTES", 900)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = list(enumerate(texts())) + [(None, "no key"), (7, "again"), (7, "again")]
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, ids int, k0 string").repartition(3)
    want = sorted((str(k), t or "") for k, t in rows)
    got = sorted(span_pieces.encode(df, MODEL).collect(), key=lambda r: str(r.doc_id))
    by = collections.defaultdict(list)
    for r in got:
        by[str(r.doc_id)].append((r.ids, list(zip(r.begin, r.end))))
    for k, t in want:
        pieces = library.encode(t, return_type="proto").pieces
        assert ([p.id for p in pieces], [(p.begin, p.end) for p in pieces]) in by[k]
    digests = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in span_pieces.digests(df, MODEL).collect())
    expect = []
    for k, t in want:
        ids = library.encode(t, add_bos=True, add_eos=True)
        expect.append((k, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert digests == sorted(expect)
    assert span_pieces.digests(df.limit(0), MODEL).count() == 0


@pytest.mark.parametrize("words,longest", [(0, 64), (400_000, 2)])
def test_pieces_with_a_small_memory(monkeypatch, words, longest):
    monkeypatch.setattr(span_pieces, "WORDS", words)
    monkeypatch.setattr(span_pieces, "LONGEST", longest)
    own = span_pieces.Encoder(MODEL)
    for t in texts():
        raw = np.frombuffer((t or "").encode(), np.uint8)
        norm, at, _ = own.normalise(raw, np.array([0, len(raw)]))
        assert own.encode(norm, at)[0].tolist() == own.whole.encode(t or "")


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nfkc_cf", "nmt_nfkc_cf"])
@pytest.mark.parametrize("squeeze", [True, False])
@pytest.mark.parametrize("dummy", [True, False])
def test_character_maps_and_source_places(rule, squeeze, dummy):
    """The library's own compiled maps: normalised texts and the place of every character."""
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=dummy, escape_whitespaces=True, remove_extra_whitespaces=squeeze)
    spec = {n: v for n, _, v, _ in span_pieces._fields({n: v for n, _, v, _ in span_pieces._fields(library.serialized_model_proto())}[3])}

    class Settings:
        charsmap, dummy, squeeze, escape = spec.get(2, b""), bool(spec.get(3, 1)), bool(spec.get(4, 1)), bool(spec.get(5, 1))

    own = span_pieces.Normaliser(Settings)
    rnd = random.Random(1)
    pool = "aA éＡﬁ½㎏ 　\t\n\x00​ー゛カガ﷼ß①™ ̈´Å𝔘≠é"
    rows = [t or "" for t in ODD] + ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 25))) for _ in range(300)]
    raw = [t.encode() for t in rows]
    norm, at, origin = own(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    for i, t in enumerate(rows):
        mine, places = norm[at[i]:at[i + 1]], origin[at[i] + i:at[i + 1] + i + 1]
        text, offsets = library.normalize(t, with_offsets=True)
        assert mine.tobytes().decode() == text
        starts = [k for k in range(len(mine)) if mine[k] & 0xC0 != 0x80] + [len(mine)]
        assert [len(raw[i][:places[k]].decode()) for k in starts] == list(offsets)


def test_models_that_are_refused():
    spec = span_pieces._message(2, b"\x18\x02\x98\x02\x00")
    with pytest.raises(ValueError):
        span_pieces.Model(spec + span_pieces._message(1, b"\x0a\x01a"))
