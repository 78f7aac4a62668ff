"""Learnt operators, page extraction, chat windows and the pipeline."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strideframe.llm import chat, fm, string_kernel, tag_paths
from strideframe.llm import queries as Q
from tests.llm.test_text import by_links

SF = "/root/testdata/sf0.01"


def test_factorisation_identity():
    """The sum-of-squares form equals the sum over all pairs."""
    rng = np.random.default_rng(5)
    m = fm.Model(0.5)
    m.w, m.v = rng.normal(size=m.w.shape), rng.normal(size=m.v.shape)
    columns, values, dense = np.array([3, 9, 77, 3]), np.array([0.5, 1.0, 2.0, 1.5]), rng.normal(size=(2, m.extra))
    z, _ = m.parts(columns, values, np.array([0, 0, 0, 1]), dense)
    for r, (c, x) in enumerate([(columns[:3], values[:3]), (columns[3:], values[3:])]):
        i, full = np.concatenate([c, fm.WORDS + np.arange(m.extra)]), np.concatenate([x, dense[r]])
        pairs = sum(m.v[i[a]] @ m.v[i[b]] * full[a] * full[b] for a in range(len(i)) for b in range(a))
        assert z[r] == pytest.approx(m.bias + m.w[i] @ full + pairs)


def quality_rows(n=400):
    rnd = random.Random(1)
    good = lambda: " ".join(rnd.choice("the a tree river stone of and walks under bright sky".split()) for _ in range(rnd.randint(5, 60))) + "."
    bad = lambda: " ".join(rnd.choice(["BUY!!", "$$$", "NOW!!", "CLICK", "###"]) for _ in range(rnd.randint(5, 60)))
    return [(i, good() if i % 3 else bad(), i, i % 3 > 0) for i in range(n)]


def test_quality_on_held_out_rows(spark):
    rows = quality_rows()
    df = spark.createDataFrame([(k, t, n, "clash") for k, t, n, _ in rows] + [(None, None, None, "x"), (1000, "", 3, "x"), (0, rows[0][1], 0, "x")], "doc_id long, text string, n_chars int, score string")
    labels = spark.createDataFrame([(k, int(y)) for k, _, _, y in rows if k % 2] + [(4, None), (None, 1), (9999, 0), (3, 7)], "doc_id long, quality int")
    model = fm.fit(df, labels, metadata=("n_chars",))
    got = collections.defaultdict(list)
    for r in fm.score(df, model, metadata=("n_chars",)).collect():
        assert 0 <= r.score <= 1
        got[r.doc_id].append(r.score)
    assert np.mean([(got[k][0] > 0.5) == y for k, _, _, y in rows if k % 2 == 0]) > 0.98
    assert got[0][0] == got[0][1] and len(got[None]) == 1 and len(got[1000]) == 1
    one = fm.fit(df, labels.where("quality = 1"))
    assert len({r.score for r in fm.score(df, one).collect()}) == 1
    assert fm.score(df.limit(0), fm.fit(df.limit(0), labels)).count() == 0 and fm.fit(df, labels.limit(0)).bias == 0


def test_presence_kernel_by_hand():
    texts = [b"Abcab", b"bca, B", b"", b"x"]
    data, at = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    rows = string_kernel.presence(data, at)
    plain = [bytes(string_kernel.PLAIN[np.frombuffer(t, np.uint8)]) for t in texts]
    grams = [{t[i:i + k] for k in string_kernel.GRAMS for i in range(len(t) - k + 1)} for t in plain]
    assert rows.sum(axis=1).tolist() == [len(g) for g in grams]
    assert (rows @ rows.T).tolist() == [[len(a & b) for b in grams] for a in grams]


def test_language_on_held_out_rows(spark):
    rnd = random.Random(2)
    sets = {"en": "the of and tion ing th er re".split(), "fr": "le la que eau ou é è ç des".split(), "de": "der und ung keit sch ö ü ß".split()}
    say = lambda lang: " ".join("".join(rnd.choice(sets[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(rnd.randint(3, 80)))
    rows = [(i, say(lang), lang) for i, lang in enumerate(list(sets) * 80)]
    extra = [(1000, None, "en"), (1001, " 12 - ! ", "fr"), (1002, "", None), (None, say("fr"), None), (1003, say("de") * 300, None), (0, rows[0][1], "en")]
    df = spark.createDataFrame([(*r, 1) for r in rows + extra], "doc_id long, text string, lang string, score int")
    model = string_kernel.fit(df.where("doc_id % 2 = 0"))
    got = collections.defaultdict(list)
    for r in string_kernel.predict(df, model).collect():
        assert 0 <= r.score <= 1
        got[r.doc_id].append((r.lang_pred, r.score))
    assert np.mean([got[k][0][0] == lang for k, _, lang in rows if k % 2]) > 0.97
    assert {got[k][0][0] for k in (1000, 1001, 1002)} == {"und"} and got[1003][0][0] == "de" and got[0][0] == got[0][1]
    assert {r.lang_pred for r in string_kernel.predict(df, string_kernel.fit(df.limit(0))).collect()} == {"und"}
    assert string_kernel.predict(df.limit(0), model).count() == 0


def test_page_content():
    body = "".join(f"<p>Paragraph {i} has some <b>bold</b> words, and more &amp; more; it goes on.\n So it is.</p>" for i in range(6))
    page = ("<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a>Home</a><li><a>About</a></ul></nav><div class='cookie-notice'>We use cookies.</div>"
            f"<div id=content><h1>Title</h1>{body}<ul><li>one<li>two</ul><div class='ad'>Buy.</div><form>Mail <input> <button>Go</button></form><script>var a = '<p>';</script></div>"
            "<aside>More here, and there.</aside><section class=comments><p>I think so, too. Really, yes; a long comment, of a reader, who writes, on and on.</p></section><footer>&copy; x</footer></body>")
    paragraphs = " ".join(f"Paragraph {i} has some bold words, and more & more; it goes on. So it is." for i in range(6))
    assert tag_paths.content(page) == f"Title {paragraphs} one two"
    assert tag_paths.content(None) == tag_paths.content("") == tag_paths.content("<nav>x</nav><!-- c -->") == ""
    assert tag_paths.content("plain &lt;text&gt;\n here") == "plain <text> here"
    assert tag_paths.content("<article><h1>A<p><b>x.<br><p>y</p> <p>z" + " <p cl") == "A x. y z"


def test_page_content_node_holds_all_of_the_text():
    long = "Some words of a long paragraph, with more of them; and it goes on, as it should. "
    ps = "".join(f"<p>{long * 3}</p>" for _ in range(12))
    body = " ".join([" ".join([long.strip()] * 3)] * 12)
    menu = "<div><a href=a>Home</a> | <a href=b>About</a></div>"
    assert tag_paths.content(f"<body>{menu}<article><h1>Title</h1><p>Lead</p><div>{ps}</div></article></body>") == f"Title Lead {body}"
    assert tag_paths.content(f"<body>{menu}<div><h1>Title</h1><p>Lead</p><div><div>{ps}</div></div></div></body>") == f"Title Lead {body}"
    assert tag_paths.content(f"<body>{menu}<article><section>{ps}</section><section><p>Short end.</p></section></article></body>") == f"{body} Short end."
    assert tag_paths.content(f"<body>{menu}<section>{ps}</section><div><h2>More</h2><ul><li>one<li>two</ul></div></body>").endswith(f"{body} More one two")
    assert tag_paths.content(f"<body><article><div>First, short.</div><div>{long * 40}</div><div>Last</div></article></body>") == f"First, short. {' '.join([long.strip()] * 40)} Last"
    assert tag_paths.content(f"<table><tr><td>First, short.<td>{long * 40}<td>Last</table>") == f"First, short. {' '.join([long.strip()] * 40)} Last"
    assert tag_paths.content(f"<body>{menu}<div><div>{ps}</div><div>By a writer</div></div></body>") == f"{body} By a writer"
    assert tag_paths.content(f"<body>{menu}<div><div>{ps}</div></div></body>") == body


PARAGRAPHS = "".join(f"<p>Paragraph {i} has some words, and more of them; it goes on and on, as ever. So it is.</p>" for i in range(6))
PLAIN = " ".join(f"Paragraph {i} has some words, and more of them; it goes on and on, as ever. So it is." for i in range(6))
# Pages of plain elements: no name, marker or link says what is furniture.
BARE = [
    (f"<body><div><div>Home</div><div>News</div><div>Sport</div></div><div><h1>Title</h1>{PARAGRAPHS}</div><div>All rights reserved 2024</div></body>", f"Title {PLAIN}"),
    (f"<body><div><div><a href=x>Home</a></div><div><a>News</a></div></div><div><h1>Title</h1>{PARAGRAPHS}</div><div>All rights reserved 2024</div></body>", f"Title {PLAIN}"),
    (f"<body><div><div><span>Home</span><span>News</span></div><div><div><h1>Title</h1>{PARAGRAPHS}</div></div><div>All rights reserved 2024</div></div></body>", f"Title {PLAIN}"),
    (f"<body><div><ul><li>Home<li>News</ul><div>{PARAGRAPHS.replace('p>', 'div>')}</div><div>All rights reserved 2024</div></div></body>", PLAIN),
    (f"<body><table><tr><td>Home<td>News<td>Sport<td>Art<td>A teaser, that is as long as a paragraph of the text; but one. So it is.<td>Travel<td>Shop<td>Help</table><div>{PARAGRAPHS}</div><ul><li>Tags<li>More, of the same; and so on, and on, as it goes.<li>x<li>y</ul></body>", PLAIN),
]


@pytest.mark.parametrize("k", range(len(BARE)))
def test_pages_without_names_or_markers(k):
    page, text = BARE[k]
    assert tag_paths.content(page) == text


def test_page_score_decides(monkeypatch):
    """With one score for every path the teasers beside the text count as text."""
    page, text = BARE[4]
    monkeypatch.setattr(tag_paths, "_scores", lambda size, marks, which: np.ones(which.max() + 1))
    assert tag_paths.content(page) != text


def restated_scores(found):
    """The score of each path, said plainly: ratios by path, Gaussian over blocks, fused, weighted by text length."""
    paths = sorted({f[1] for f in found})
    blocks = {p: [f[2] for f in found if f[1] == p] for p in paths}
    text = {p: sum(map(len, b)) / len(b) for p, b in blocks.items()}
    marks = {p: sum(len(tag_paths.PUNCTUATION.findall(x)) for x in b) / len(b) for p, b in blocks.items()}

    def smoothed(ratio):
        out = []
        for i in range(len(found)):
            near = [j for j in range(i - tag_paths.RADIUS, i + tag_paths.RADIUS + 1) if 0 <= j < len(found)]
            w = [np.exp(-0.5 * ((i - j) / tag_paths.SIGMA) ** 2) for j in near]
            out.append(sum(x * np.log1p(ratio[found[j][1]]) for x, j in zip(w, near)) / sum(w))
        return out

    a, b = smoothed(text), smoothed(marks)
    score = [x / max(a) * (0.5 + 0.5 * y / max(max(b), 1e-9)) for x, y in zip(a, b)]
    return [sum(s * len(f[2]) for s, f in zip(score, found) if f[1] == p) / sum(len(f[2]) for f in found if f[1] == p) for p in paths]


def test_page_scores_equal_a_plain_restatement():
    for page, _ in BARE:
        found = tag_paths.blocks(page)
        paths, which = np.unique([f[1] for f in found], return_inverse=True)
        size = np.array([len(f[2]) for f in found], float)
        marks = np.array([len(tag_paths.PUNCTUATION.findall(f[2])) for f in found], float)
        assert np.allclose(tag_paths._scores(size, marks, which), restated_scores(found))


def test_page_names_of_furniture():
    ps = "".join(f"<p>Paragraph {i} has some words, and more; it goes on.</p>" for i in range(6))
    body = " ".join(f"Paragraph {i} has some words, and more; it goes on." for i in range(6))
    for name in ("container has-sidebar", "no-sidebar", "page-with-sidebar", "header-fixed", "side-effects", "related-work", "market-share", "right-sidebar", "sidebar"):
        for kind in ("class", "id"):
            assert tag_paths.content(f"<body><div {kind}='{name}'><article><h1>Title</h1>{ps}</article></div></body>") == f"Title {body}", name
            assert tag_paths.content(f"<body><div {kind}='{name}'>{ps}</div><div class=ad>Buy this.</div></body>") == body, name
    for name in ("side-effects", "related-work", "market-share"):
        assert tag_paths.content(f"<body><article>{ps}<section id={name}><h2 id=comments>Part</h2><p>Short, but text.</p></section></article></body>") == f"{body} Part Short, but text."
    for name in ("sidebar", "left-sidebar", "sidebar-left", "ad", "ad-300x250", "google-ads", "related-posts", "page-footer", "nyt-footer", "box comments", "share_buttons", "cookie-notice"):
        assert tag_paths.content(f"<body><article>{ps}</article><div class='{name}'><p>One, two.</p><p>Three.</p></div></body>") == body, name
    many = "<p>I think so, too; and so on, and on, as ever.</p>" * 20
    assert tag_paths.content(f"<body><article>{ps}</article><div class=comments>{many}</div></body>") == body
    assert tag_paths.content("<body><div class=ad>Buy, now.</div></body>") == ""


def test_page_table(spark):
    df = spark.createDataFrame([(1, "u", "<p>a b</p>", 3), (1, "u", "<p>a b</p>", 3), (2, None, None, 4), (None, "v", "", 5)], "page_id int, url string, html string, n_chars int")
    got = tag_paths.extract(df, ["page_id", "url"]).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "", 0), (1, "a b", 3), (1, "a b", 3), (2, "", 0)]
    assert tag_paths.extract(df.limit(0), ["page_id"]).count() == 0


@pytest.mark.parametrize("budget,history", [(40, 15), (10, 0), (5000, 100)])
def test_chat_windows(spark, budget, history):
    rnd = random.Random(4)
    talks = collections.defaultdict(list)
    for c in range(25):
        for t in range(rnd.randint(1, 9) if c else 300):
            role = "system" if t == 0 and c % 2 else ("user", "assistant")[t % 2] if c % 5 else rnd.choice(["user", "assistant", None, "to\nol <|x"])
            talks[c].append((t, role, rnd.choice([None, "", "\\ <|im_end|>\n<\\|", " ".join("wö" for _ in range(rnd.randint(0, 30)))])))
    talks[None] = [(0, "user", "a"), (0, "assistant", "b"), (0, "assistant", "b")]
    df = spark.createDataFrame([(c, *r, "x") for c, rows in talks.items() for r in rows], "conv_id int, turn int, role string, text string, w string")
    windows = chat.windows(df, budget=budget, history=history)
    rows = windows.collect()
    for c, turns in talks.items():
        own = sorted((r for r in rows if r.conv_id == c), key=lambda r: r.window_no)
        clean = sorted(((t, r or "", x or "") for t, r, x in turns))
        assert [r.window_no for r in own] == list(range(len(own)))
        edges = [r.first_turn for r in own] + [len(clean)]
        for r, a, b in zip(own, edges, edges[1:]):
            parts = r.formatted.split(chat.START)[1:]
            assert len(parts) == r.n_repeated + b - a
            assert b - a == 1 or sum(len(p.replace("\n", " ").split()) for p in [chat.START + q for q in parts[r.n_repeated:]]) <= budget
            if clean[0][1] == "system" and c is not None:
                assert parts[0].startswith("system\n")
            assert len(r.loss) == sum(x[1] == "assistant" for x in clean[a:b])
    got = {r.conv_id: r for r in chat.read_back(windows).collect()}
    for c, turns in talks.items():
        clean = sorted(((t, r or "", x or "") for t, r, x in turns))
        loss = "".join(x for _, r, x in clean if r == "assistant")
        assert got[c].n_turns == len(clean) and got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in clean).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].formatted_chars == sum(len(r.formatted) for r in rows if r.conv_id == c)
    assert chat.read_back(chat.windows(df.limit(0))).count() == 0


def test_pipeline_stages(spark):
    """Each stage against a plain version of its decision, on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        out = stage(spark, docs, SF)
        docs = spark.createDataFrame(out.collect(), out.schema)
        seen[name] = (before, docs.collect())
    names = [n for n, _ in corpus_pipeline.STAGES]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    before, after = seen[names[0]]
    scores = {r.doc_id: r.score for r in Q.op8_factor_quality(spark, SF).collect()}
    assert {r.doc_id for r in after} == {k for k, s in scores.items() if s >= 0.7} and after[0].__fields__ == columns
    before, after = seen[names[1]]
    groups = by_links([(r.doc_id, r.text) for r in before], 5, 80, 100)
    assert sorted(r.doc_id for r in after) == sorted({g[3] for g in groups})
    before, after = seen[names[2]]
    dirty = {r.doc_id for r in Q.op10_positional_index(spark, SF).collect() if r.contaminated}
    assert {r.doc_id for r in after} == {r.doc_id for r in before} - dirty and len(before) > len(after)
    before, after = seen[names[3]]
    words = lambda rows: sum(len(r.text.split()) for r in rows)
    assert set(after) <= set(before) and words(before) * 3 // 4 <= words(after) <= words(before) * 9 // 10
    before, after = seen[names[4]]
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before) and sum(r.n_tokens for r in after) > 0


def test_near_duplicates_keep_different_texts_that_share_an_id(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, "other words here", "en"), (1, f"{long} end", "en"), (2, long, "en"), (None, long, "de"), (None, "alone and without an id", "fr"), (4, "twice the same row", "en"),
            (4, "twice the same row", "en"), (5, "", "en"), (6, None, "en"), (None, "alone and without an id, but more", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").repartition(4)
    got = sorted(map(str, (tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())))
    assert got == sorted(map(str, [r for i, r in enumerate(rows) if i not in (2, 3, 6)]))


def test_queries_run_where_executors_have_no_copy(tmp_path):
    """The package is on the driver's path only, as in a session started from another folder."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
import __spark_entry__ as entry
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
for name, query in entry.queries().items():
    if name.startswith("op") or name == "pipeline":
        print(name, query(spark, {SF!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_ENV_LOADED")}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert "pipeline" in done.stdout


def test_pipeline_takes_null_and_clashing_columns(spark, tmp_path):
    rows = [(k, t, "en", "src1", n) for k, t, n, _ in quality_rows(60)] + [(None, None, None, None, None), (500, "", None, "", 0), (1, "dup", None, "x9", 3), (1, "dup", None, "x9", 3)]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score string, nth int")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    for table in (docs, docs.limit(0)):
        out = table
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, str(tmp_path))
        assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() <= table.count()


def test_pipeline_batches_are_bounded_by_bytes(spark):
    """Long texts reach a stage's Python a few at a time; a smaller bound of the session stays."""
    import pyarrow as pa

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    docs = spark.range(40).repartition(1).selectExpr("id AS doc_id", "repeat('word ', 100000) AS text", "'en' AS lang", "'s1' AS source", "500000L AS n_chars")
    sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in batches)
    try:
        spark.conf.set(name, "64m")
        corpus_pipeline.near_duplicates(spark, docs.limit(2), "")
        got = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
        assert sum(got) > 40 * 500_000 and max(got) < 6 << 20
        spark.conf.set(name, "1000000")
        corpus_pipeline.near_duplicates(spark, docs.limit(2), "")
        assert spark.conf.get(name) == "1000000"
    finally:
        spark.conf.set(name, before)
