"""Operators on texts against brute force on small fixtures with nulls, ties, repeats and long rows."""

import collections
import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strideframe.llm import components, decontaminate, grammar, mixing, ngram_join, suffix_merge
from strideframe.llm import queries as Q

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def corpus(seed=4, n=60):
    """Copies, near copies, chains, short and long texts, nulls and repeated ids."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6))) for _ in range(400)]
    say = lambda k: " ".join(rnd.choice(vocabulary) for _ in range(k))
    base = say(120)
    shared = say(90)
    rows = [(i, say(rnd.randint(0, 200))) for i in range(n)]
    words = base.split()
    for i in range(40):
        w = list(words)
        for _ in range(i % 5):
            w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        rows.append((100 + i, " ".join(w)))
    rows += [(200 + i, f"{say(20)} {shared} {say(20)}") for i in range(12)]
    rows += [(300, None), (301, ""), (302, "  \t "), (303, "One"), (304, "one"), (305, "ONE two"), (306, f"{shared}\n{shared}"), (307, base), (307, base), (None, base), (None, None)]
    rows.append((308, say(9000)))
    rows.append((309, "z" * 3000))
    rnd.shuffle(rows)
    return rows


def frame(spark, rows):
    """With extra columns whose names the operators use inside."""
    return spark.createDataFrame([(k, t, "x", 1, 2.0) for k, t in rows], "doc_id long, text string, n string, salt int, follow double").repartition(5)


def shingles(text, size):
    w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(LOWER))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def by_links(rows, size, num, den):
    sets = [(k, shingles(t, size)) for k, t in rows]
    parent = {k: k for k, _ in sets if k is not None}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t and den * len(s & t) >= num * len(s | t):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return sorted((k is None, k or 0, len(s), None if k is None else find(k)) for k, s in sets)


@pytest.mark.parametrize("size,num,block,salt", [(3, 90, 1024, 1 << 16), (5, 80, 4, 3), (2, 60, 3, 2)])
def test_jaccard_components(spark, monkeypatch, size, num, block, salt):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "SALT_ROWS", salt)
    monkeypatch.setattr(ngram_join, "MEMBERS", 3)
    rows = corpus()
    got = ngram_join.components(frame(spark, rows), size=size, num=num, den=100).collect()
    want = by_links(rows, size, num, 100)
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in got)) == want
    assert ngram_join.components(frame(spark, rows).limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000 + rnd.randrange(60), 5000 + rnd.randrange(60)) for _ in range(40)] + [(None, 4), (7, 7)]
    parent = {x: x for e in edges if None not in e for x in e}
    for _ in range(100):
        for a, b in edges:
            if a is not None and b is not None:
                m = min(parent[a], parent[b])
                parent[a] = parent[b] = m
    got = {r.node: r.component for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    touched = {x for a, b in edges if None not in (a, b) and a != b for x in (a, b)}
    assert got == {x: parent[x] for x in touched}


@pytest.mark.parametrize("ranges,run", [(24 << 20, 1 << 14), (20_000, 40)])
def test_suffix_merge_equals_brute_force(spark, monkeypatch, ranges, run):
    monkeypatch.setattr(suffix_merge, "RANGE_BYTES", ranges)
    monkeypatch.setattr(suffix_merge, "RUN_ROWS", run)
    rows = corpus(9) + [(400, "q" * 399), (401, "q" * 400), (402, "q" * 900), (403, "pad " + "q" * 450)]
    bodies = [(k, (t or "").encode()) for k, t in rows]
    seen = collections.Counter(b[p:p + 400] for _, b in bodies for p in range(len(b) - 399))
    want = []
    for k, b in bodies:
        gone = bytearray(len(b))
        for p in range(len(b) - 399):
            if seen[b[p:p + 400]] > 1:
                gone[p:p + 400] = b"\1" * 400
        kept = bytes(c for c, g in zip(b, gone) if not g)
        want.append((k is None, k or 0, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    got = suffix_merge.remove(frame(spark, rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)
    assert all(sum(b - a for a, b in zip(r.first, r.stop)) == r.n_removed for r in got)
    assert suffix_merge.remove(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("run", [1, 64])
def test_suffix_merge_cuts_equal_keys(spark, monkeypatch, run):
    """A passage of every text does not stay in one range, and its equal suffixes count."""
    monkeypatch.setattr(suffix_merge, "RANGE_BYTES", suffix_merge.WIDE * 4)
    monkeypatch.setattr(suffix_merge, "RUN_ROWS", run)
    rnd = random.Random(3)
    text = lambda n: "".join(rnd.choices("abcdefgh ", k=n))
    passage = text(1500)
    rows = [(k, text(300) + passage + text(300)) for k in range(60)]
    found = []
    kept = suffix_merge.materialise
    monkeypatch.setattr(suffix_merge, "materialise", lambda df, name: found.append(kept(df, name)) or found[-1])
    got = suffix_merge.remove(frame(spark, rows)).collect()
    seen = collections.Counter(t[p:p + 400] for _, t in rows for p in range(len(t) - 399))
    for r in got:
        starts = [p for p in range(len(rows[r.doc_id][1]) - 399) if seen[rows[r.doc_id][1][p:p + 400]] > 1]
        assert (r.first, r.stop) == ([starts[0]], [starts[-1] + 400]) and r.n_removed >= 1500
    sorts = [df for df in found if "edge" in df.columns]
    assert len(sorts) == 2
    for df in sorts:
        edges = df.where("edge is not null").select("edge", "key").collect()
        keys = collections.Counter(bytes(r.key) for r in edges if r.edge % 2 == 0)
        assert max(keys.values()) > 3
        copies = df.where(f"edge is null and greatest(r1, r2) = {suffix_merge.LENGTH} and greatest(l1, l2) = {suffix_merge.REACH - 1}").select("t1", "at").distinct().count()
        assert copies > 60


def test_suffix_runs_hold_each_key_once():
    keys = np.repeat(np.arange(4, dtype=np.uint8), [1, 3, 1, 2])[:, None] * np.ones(suffix_merge.WIDE, np.uint8)
    items = np.arange(21).reshape(7, 3)
    kept, at, same, settled = suffix_merge._collapse(keys, items)
    assert kept[:, 0].tolist() == [0, 1, 2, 3] and at[:, 0].tolist() == [0, 3, 12, 15] and same.tolist() == [0] * 4
    assert settled[:, 0].tolist() == [3, 6, 9, 15, 18]
    key = keys[1].tobytes()
    assert suffix_merge._split(keys, items, [(key, (4, 0, 0)), (key, (9, 0, 0))]).tolist() == [0, 0, 1, 2, 2, 2, 2]


def test_loser_tree_merges_and_keeps_prefixes():
    rnd = random.Random(1)
    runs, all_ = [], []
    for _ in range(7):
        strings = sorted(bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 12))) for _ in range(rnd.randint(0, 30)))
        all_ += strings
        before, run = b"", []
        for s in strings:
            run.append((suffix_merge._prefix(before, s, 0) if run else 0, s, None))
            before = s
        runs.append(run)
    out = list(suffix_merge.merge(runs))
    assert [s for _, s, _ in out] == sorted(all_)
    assert all(h == suffix_merge._prefix(a, b, 0) for (_, a, _), (h, b, _) in zip(out, out[1:]))


@pytest.mark.parametrize("copies", [15, 40])
def test_grammar_leaves_no_pair_at_the_least_count(copies):
    rng = np.random.default_rng(copies)
    passage = rng.integers(2, 40_000, 1000)
    docs = [np.append(np.concatenate([rng.integers(2, 40_000, 30), passage]), 1) for _ in range(copies)]
    ids, lengths = np.concatenate(docs), np.array([len(d) for d in docs])
    payload, symbols = grammar.compress(ids, lengths, 49_152)
    shard = grammar.Shard(payload)
    assert shard.ids().tolist() == ids.tolist()
    parts = np.split(shard.symbols, np.cumsum(symbols)[:-1])
    left = collections.Counter(pair for p in parts for pair in zip(p[:-1].tolist(), p[1:].tolist()))
    assert max(left.values()) < grammar.LEAST_COUNT


def test_token_shards(spark, tmp_path):
    from tokenizers import Tokenizer

    rows = corpus(5) + [(500, "a<|endoftext|>b DON'T x ý İ ΣΑΣ"), (501, "<|startoftext|>")]
    path = str(tmp_path / "shards")
    grammar.write(frame(spark, rows), path, "doc_id", "text", Q.tokenizer_path(), end_id=1, shard_tokens=700)
    shards = grammar.read(spark, path)
    got = grammar.documents(shards, "doc_id", with_ids=True).collect()
    tokenizer = Tokenizer.from_file(Q.tokenizer_path())
    ids = sorted((k is not None, k or 0, e.ids + [1]) for (k, _), e in zip(rows, tokenizer.encode_batch([t or "" for _, t in rows], add_special_tokens=False)))
    out = sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in got)
    assert out == ids and shards.count() > 3
    ordered = sorted(got, key=lambda r: r.start)
    assert [(r.doc_id is not None, r.doc_id or 0) for r in ordered] == sorted((k is not None, k or 0) for k, _ in rows)
    at = 0
    for r in ordered:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids))
        at += r.n_tokens
    empty = str(tmp_path / "none")
    grammar.write(frame(spark, rows).limit(0), empty, "doc_id", "text", Q.tokenizer_path(), end_id=1)
    assert grammar.documents(grammar.read(spark, empty), "doc_id").count() == 0


def test_grammar_access_and_size():
    rng = np.random.default_rng(3)
    lengths = np.array([0, 5000, 1, 0, 3000, 700])
    ids = np.tile(rng.integers(0, 50, 40), 400)[:lengths.sum()].astype(np.uint32)
    payload, symbols = grammar.compress(ids, lengths, 100)
    shard = grammar.Shard(payload)
    assert (shard.ids() == ids).all() and len(shard.symbols) < len(ids) / 4 and len(shard.left) > 3
    at, start = np.cumsum([0, *symbols]), np.cumsum([0, *lengths])
    for d, n in enumerate(lengths):
        assert (shard.ids(at[d], at[d + 1]) == ids[start[d]:start[d + 1]]).all()
        if n:
            a, b = int(n) // 3, 2 * int(n) // 3 + 1
            assert (shard.span(at[d], at[d + 1], a, b) == ids[start[d] + a:start[d] + b]).all()
    assert list(shard.length[:1]) == [2]


@pytest.mark.parametrize("block", [2_000_000, 40])
def test_decontamination(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    rows = corpus(6)
    texts = dict(rows)
    some = [t for t in texts.values() if t and len(t.split()) > 30]
    items = [("i1", " ".join(some[0].split()[5:25]).upper()), ("i2", " ".join(some[1].split()[3:13])), ("i3", "one"), ("i4", None), ("i5", " .. "), (None, " ".join(some[2].split()[:11])),
             ("i1b", " ".join(some[0].split()[9:21])), ("i6", "never seen words at all in any of these documents here")]
    bench = spark.createDataFrame([(a, b, "x") for a, b in items], "item_id string, text string, doc_id string")
    path = str(tmp_path / "index")
    decontaminate.write_index(frame(spark, rows), path, "doc_id", "text")
    index = decontaminate.read_index(spark, path)
    got = decontaminate.report(decontaminate.search(index, bench, "doc_id"), "doc_id").collect()
    words = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().translate(LOWER))
    windows = collections.defaultdict(set)
    for name, t in items:
        w = words(t)
        for i in range(max(len(w) - 9, 1 if w else 0)):
            windows[tuple(w[i:i + 10])].add(name or "")
    want = []
    for k, t in rows:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (names := windows.get(tuple(w[i:i + n]))):
                    found |= names
                    hit |= set(range(i, i + n))
        want.append((k is None, k or 0, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == sorted(want)
    assert sum(r.contaminated for r in got) >= 3
    near = {(r.doc_id, r.item) for r in decontaminate.proximity(index, bench, "doc_id", 40).collect()}
    assert any(item == "i1b" for _, item in near)
    assert decontaminate.search(index, bench.limit(0), "doc_id").where("size(spans) > 0").count() == 0
    assert decontaminate.search(index.limit(0), bench, "doc_id").count() == 0


def fill(total, children):
    """Whole-number water-filling by hand: {name: (weight, supply)}."""
    out, left, open_ = {}, total, dict(children)
    while open_:
        mass = sum(w for w, _ in open_.values())
        full = [n for n, (w, s) in open_.items() if s * mass <= w * left and s <= left]
        if not full:
            run = 0
            for n in sorted(open_, key=lambda n: (open_[n][1] / open_[n][0], n)):
                w = open_[n][0]
                out[n] = left * (run + w) // mass - left * run // mass
                run += w
            return out
        n = min(full, key=lambda n: (open_[n][1] / open_[n][0], n))
        out[n] = open_[n][1]
        left -= out[n]
        del open_[n]
    return out


@pytest.mark.parametrize("share,epochs", [((1, 2), 1), ((3, 2), 2), ((9, 1), 3)])
def test_mixing_by_hand(spark, share, epochs):
    rnd = random.Random(8)
    rows = [(i, rnd.choice(["a", "b", None]), rnd.choice(["en", "fr"]), rnd.choice(["s1", "s2", "s3"]) if i % 3 else "s1", " ".join("w" for _ in range(rnd.randint(0, 30)))) for i in range(200)]
    rows += [(7, "a", "en", "s1", "w w w"), (None, "b", "fr", "s2", "w"), (900, "b", "fr", "s3", None)]
    df = spark.createDataFrame(rows, "doc_id int, domain string, lang string, source string, text string").withColumn("n", mixing.words(F.col("text")))
    weights = [{"a": 3}, {"en": 2, "fr": 1}, {"s1": 1, "s2": 5}]
    levels = ["domain", "lang", "source"]
    got = mixing.choose(df, "doc_id", levels, weights, share, epochs, 5, tokens="n").collect()
    tokens = collections.Counter()
    for _, a, b, c, t in rows:
        tokens[a or "", b, c] += len((t or "").split())
    tokens = {k: v for k, v in tokens.items() if v}
    supply = lambda path: epochs * sum(v for k, v in tokens.items() if k[:len(path)] == path)
    budgets = {(): min(sum(tokens.values()) * share[0] // share[1], epochs * sum(tokens.values()))}
    for k in range(3):
        for path in [p for p in list(budgets) if len(p) == k]:
            names = {t[k] for t in tokens if t[:k] == path}
            for n, b in fill(budgets[path], {n: (weights[k].get(n, 1), supply((*path, n))) for n in names}).items():
                budgets[(*path, n)] = b
    taken = collections.Counter()
    for r in got:
        assert 0 < r.n_taken <= r.n_tokens and 0 <= r.epoch <= epochs
        taken[r.domain, r.lang, r.source] += r.n_taken
    assert dict(taken) == {k: v for k, v in budgets.items() if len(k) == 3 and v}
    assert sum(taken.values()) == budgets[()]
    assert mixing.choose(df.limit(0), "doc_id", levels, weights, share, epochs, 5, tokens="n").count() == 0


def test_index_keeps_rows_that_repeat_a_key(spark, tmp_path, monkeypatch):
    """The same rows in one block of the benchmark and in many, over partitions whose segments are equal."""
    text = "one two three four five six seven eight nine ten eleven"
    rows = [(1, text), (1, text), (2, text), (None, text), (None, None), (3, "none of it")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    benchmark = spark.createDataFrame([("a", text), ("b", "nine ten eleven"), ("b", "nine ten eleven"), ("c", "absent words"), ("d", None)], "item_id string, text string")
    decontaminate.write_index(df, str(tmp_path / "i"), "doc_id", "text")
    index = decontaminate.read_index(spark, str(tmp_path / "i"))
    seen = []
    for words in (2_000_000, 5):
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", words)
        found = decontaminate.report(decontaminate.search(index, benchmark, "doc_id"), "doc_id")
        seen.append(sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items) for r in found.collect()))
    assert seen[0] == seen[1] == sorted([("1", 11, 11, 2)] * 2 + [("2", 11, 11, 2), ("None", 11, 11, 2), ("None", 0, 0, 0), ("3", 3, 0, 0)])


def test_token_shards_order_rows_that_repeat_a_key_by_their_texts(spark, tmp_path):
    rows = [(k, f"text {i} of key {k}") for k in (None, 3, 7) for i in range(60)]
    got = []
    for n, parts in enumerate((1, 7)):
        random.Random(n).shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        grammar.write(df, str(tmp_path / str(n)), "doc_id", "text", Q.tokenizer_path(), end_id=1, shard_tokens=50)
        got.append(sorted((str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in grammar.documents(grammar.read(spark, str(tmp_path / str(n))), "doc_id").collect()))
    assert got[0] == got[1] and len(got[0]) == 180


def test_words_are_looked_up_only_where_the_library_agrees():
    import public_tokenizers

    texts = ["Two  words, and\tmore.", "", " leading", "trailing "]
    data = "".join(texts).encode()
    at = np.cumsum([0] + [len(t.encode()) for t in texts])
    for name, whole in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        cache = grammar.WordCache(public_tokenizers.path(name))
        ids, counts = cache.encode(np.frombuffer(data, np.uint8), at)
        assert cache.whole is whole
        assert ids.tolist() == [i for t in texts for i in cache._ids(t)] and counts.tolist() == [len(cache._ids(t)) for t in texts]
