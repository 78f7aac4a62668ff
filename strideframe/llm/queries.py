"""Registered queries of the training-data operators over the driver tables, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from strideframe.llm import chat, decontaminate, divergence, fm, grammar, mixing, ngram_join, piece_table, span_pieces, string_kernel, suffix_merge, tag_paths, tiff
from strideframe.session import work_dir

TOKENIZER, PIECES = "word_bpe_49k.json", "piece_bpe_32k.model"


def _read(spark, sf_dir, name, *columns):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_tiff_pages(spark, sf_dir):
    """Every text stored as a TIFF of 8-bit samples, its pages decoded, and digests of what came back."""
    stored = tiff.store_texts(_read(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")
    return tiff.read_payloads(stored, "doc_id", "media", keep=["n_bytes"])


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op2_repair_tokens(spark, sf_dir):
    """All texts as token ids, each document ended by id 1, in Re-Pair shards; what is read back from the files."""
    path = work_dir(spark, "tokens")
    grammar.write(_read(spark, sf_dir, "documents", "doc_id", "text"), path, "doc_id", "text", tokenizer_path(), end_id=1)
    return grammar.documents(grammar.read(spark, path), "doc_id")


def op3_suffix_merge(spark, sf_dir):
    """Bytes of all texts that lie in a 400-byte string which starts anywhere else too, removed."""
    return suffix_merge.remove(_read(spark, sf_dir, "documents", "doc_id", "text")).drop("first", "stop")


MIX_LEVELS = ["domain", "lang", "source"]
MIX_WEIGHTS = [{"d0": 3, "d1": 2, "d2": 1}, {"en": 4, "fr": 2, "de": 2, "es": 1}, {}]
MIX_SHARE, MIX_EPOCHS, MIX_SEED = (3, 4), 2, 20240501


def with_domain(docs):
    """Documents with their word count and a domain, named by the number of the source."""
    number = F.coalesce(F.regexp_extract("source", r"(\d+)", 1).try_cast("long"), F.lit(0))
    return docs.withColumns({"domain": F.concat(F.lit("d"), (number % 3).cast("string")), "n_words": mixing.words(F.col("text"))})


def op4_tree_mixing(spark, sf_dir):
    """What a three-level tree of domains, languages and sources takes of each document, for three quarters of all tokens."""
    docs = with_domain(_read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))
    return mixing.choose(docs, "doc_id", MIX_LEVELS, MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED, tokens="n_words")


def op5_ngram_jaccard(spark, sf_dir):
    """Documents whose sets of three-word shingles agree by 0.9, as components."""
    return ngram_join.components(_read(spark, sf_dir, "documents", "doc_id", "text"), size=3, num=90, den=100)


def op6_tag_paths(spark, sf_dir):
    """Main text of every page."""
    return tag_paths.extract(_read(spark, sf_dir, "pages", "page_id", "url", "html"), ["page_id", "url"])


def op7_string_kernel(spark, sf_dir):
    """Language of every text, learnt from the rows that are not held out."""
    docs = _read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = string_kernel.fit(docs.where(~held_out))
    return string_kernel.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_factor_quality(spark, sf_dir):
    """Quality of every document by a factorisation machine fitted on the rows that are not held out."""
    crc = F.crc32(F.col("doc_id").cast("string"))
    labels = _read(spark, sf_dir, "labels", "doc_id", "quality").where(crc % 4 != 2)
    docs = _read(spark, sf_dir, "documents", "doc_id", "text", "n_chars")
    model = fm.fit(docs, labels, metadata=("n_chars",))
    scored = fm.score(docs, model, metadata=("n_chars",))
    return scored.select("doc_id", F.coalesce(crc % 4 == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_positional_index(spark, sf_dir):
    """Words of all documents inside ten-word windows of the benchmark, through a stored positional index."""
    path = work_dir(spark, "index")
    decontaminate.write_index(_read(spark, sf_dir, "documents", "doc_id", "text"), path, "doc_id", "text")
    found = decontaminate.search(decontaminate.read_index(spark, path), _read(spark, sf_dir, "benchmark", "item_id", "text"), "doc_id")
    return decontaminate.report(found, "doc_id")


def op9_chat_windows(spark, sf_dir):
    """All conversations, and one made of control strings, formatted in windows and read back."""
    talk = _read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    said = chat.END + chat.START + "assistant ok"
    kinds = {f.name: f.dataType for f in talk.schema.fields}
    extra = spark.range(2).select(F.lit(-1).cast(kinds["conv_id"]).alias("conv_id"), F.col("id").cast(kinds["turn"]).alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.read_back(chat.windows(talk.unionByName(extra)))


def op11_translate_divergence(spark, sf_dir):
    """How the sources of each language differ in their words: all pairs, and the terms each source uses more than its language."""
    return divergence.audit(_read(spark, sf_dir, "documents", "text", "lang", "source"))


def op12_piece_table_fim(spark, sf_dir):
    """Every text arranged for filling in the middle, and restored from the output and its form."""
    arranged = piece_table.arrange(_read(spark, sf_dir, "documents", "doc_id", "text"))
    keep = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256"]
    return piece_table.restore(arranged, keep).drop("text")


def op13_offset_pieces(spark, sf_dir):
    """Every text in pieces that know their bytes of the text, with begin and end ids, and decoded again."""
    import public_tokenizers

    return span_pieces.digests(_read(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path(PIECES))


def tiff_pages(spark, sf_dir):
    """One row for each page of the stored texts, decoded: its geometry, coding and a digest of its samples."""
    stored = tiff.store_texts(_read(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")
    return tiff.decode_pages(stored, "doc_id", "media").withColumn("data_sha256", F.sha2("data", 256)).drop("data")


QUERIES = {
    "op1_tiff_pages": op1_tiff_pages,
    "op2_repair_tokens": op2_repair_tokens,
    "op3_suffix_merge": op3_suffix_merge,
    "op4_tree_mixing": op4_tree_mixing,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_tag_paths": op6_tag_paths,
    "op7_string_kernel": op7_string_kernel,
    "op8_factor_quality": op8_factor_quality,
    "op9_chat_windows": op9_chat_windows,
    "op10_positional_index": op10_positional_index,
    "op11_translate_divergence": op11_translate_divergence,
    "op12_piece_table_fim": op12_piece_table_fim,
    "op13_offset_pieces": op13_offset_pieces,
    "tiff_pages": tiff_pages,
}

def _mix_sql():
    """The tree level by level; `part` is what is left for the first child that is not full and those after it."""
    def weight(k):
        cases = " ".join(f"WHEN {MIX_LEVELS[k]} = '{v}' THEN {w}" for v, w in sorted(MIX_WEIGHTS[k].items()))
        return f"CASE {cases} ELSE 1 END" if cases else "1"

    parts = ["""
rows0 AS (SELECT doc_id, 'd' || CAST(coalesce(TRY_CAST(regexp_extract(source, '(\\d+)', 1) AS BIGINT), 0) % 3 AS VARCHAR) AS domain,
  coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS n_tokens FROM documents),
docs AS (SELECT * FROM rows0 WHERE n_tokens > 0),
leaves AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS HUGEINT) AS tokens FROM docs GROUP BY ALL)"""]
    for k, level in enumerate(MIX_LEVELS):
        path, up = ", ".join(MIX_LEVELS[:k + 1]), MIX_LEVELS[:k]
        by = f"PARTITION BY {', '.join(up)} " if up else ""
        total = (f"(SELECT least(sum(tokens) * {MIX_SHARE[0]} // {MIX_SHARE[1]}, sum(tokens) * {MIX_EPOCHS}) FROM leaves)" if not up else
                 f"(SELECT budget FROM b{k - 1} WHERE {' AND '.join(f'b{k - 1}.{c} = n.{c}' for c in up)})")
        order = f"{by}ORDER BY supply / weight, {level}"
        parts.append(f"""
n{k} AS (SELECT n.*, {total} AS total FROM (SELECT {path}, sum(tokens) * {MIX_EPOCHS} AS supply, {weight(k)} AS weight FROM leaves GROUP BY {path}) n),
o{k} AS (SELECT *, total - coalesce(sum(supply) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
  sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS mass, row_number() OVER ({order}) AS i FROM n{k}),
f{k} AS (SELECT *, min(CASE WHEN supply * mass > weight * rest OR rest < supply THEN i END) OVER ({by}) AS lead_at FROM o{k}),
g{k} AS (SELECT *, max(CASE WHEN i = lead_at THEN rest END) OVER ({by}) AS lrest, max(CASE WHEN i = lead_at THEN mass END) OVER ({by}) AS lmass,
  sum(CASE WHEN i >= lead_at THEN weight ELSE 0 END) OVER ({by}ORDER BY i) AS upto FROM f{k}),
b{k} AS (SELECT {path}, CASE WHEN lead_at IS NULL OR i < lead_at THEN supply ELSE lrest * upto // lmass - lrest * (upto - weight) // lmass END AS budget FROM g{k})""")
    last = f"b{len(MIX_LEVELS) - 1}"
    parts.append(f"""
plan AS (SELECT l.*, b.budget // l.tokens AS whole, b.budget % l.tokens AS rest FROM leaves l JOIN {last} b USING (domain, lang, source)),
joined AS (SELECT d.*, p.whole, p.rest FROM docs d JOIN plan p USING (domain, lang, source)),
placed AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('{MIX_SEED}:' || CAST(whole AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR))
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM joined)
SELECT doc_id, domain, lang, source, CAST(unnest(range(CAST(whole AS BIGINT))) AS BIGINT) AS epoch, n_tokens, n_tokens AS n_taken FROM joined
UNION ALL
SELECT doc_id, domain, lang, source, CAST(whole AS BIGINT), n_tokens, CAST(least(n_tokens, rest - before) AS BIGINT) FROM placed WHERE rest > before""")
    return "WITH " + ",".join(parts)


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_JACCARD_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 90 * (x.n + y.n - common)),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.c = l.a)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id"""

_PHRASE_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw))),
m AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, win)),
h AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS at FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id"""

_CHAT_SQL = rf"""
WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{chat.END}{chat.START}assistant ok' UNION ALL SELECT -1, 1, 'assistant', '{chat.END}{chat.START}assistant ok'),
p AS (SELECT conv_id, r, x, row_number() OVER (PARTITION BY conv_id ORDER BY turn, r, x) AS i,
  '{chat.START}' || url_encode(r) || chr(10) || replace(replace(x, '\', '\\'), '<|', '<\|') || '{chat.END}' || chr(10) AS p FROM c),
k AS (SELECT *, len(regexp_extract_all(p, '[^ \t\n\x0B\f\r]+')) AS k, length(p) AS n FROM p),
s AS (SELECT *, sum(k) OVER (PARTITION BY conv_id ORDER BY i) AS e FROM k),
w AS (SELECT conv_id, i, CAST(0 AS HUGEINT) AS opened, i AS first FROM s WHERE i = 1 UNION ALL
  SELECT s.conv_id, s.i, CASE WHEN s.e - w.opened > {chat.BUDGET} AND s.e - s.k > w.opened THEN s.e - s.k ELSE w.opened END,
  CASE WHEN s.e - w.opened > {chat.BUDGET} AND s.e - s.k > w.opened THEN s.i ELSE w.first END FROM w JOIN s ON s.conv_id = w.conv_id AND s.i = w.i + 1),
v AS (SELECT conv_id, first, max(i) AS last, any_value(opened) AS opened FROM w GROUP BY conv_id, first),
y AS (SELECT conv_id, r = '{chat.SYSTEM}' AS sys FROM s WHERE i = 1),
f AS (SELECT v.conv_id, sum(s.n) AS formatted_chars FROM v JOIN y ON y.conv_id = v.conv_id JOIN s ON s.conv_id = v.conv_id
  AND (s.i BETWEEN first AND last OR (s.i < first AND (CASE WHEN sys AND s.i = 1 THEN true ELSE v.opened - (s.e - s.k) <= {chat.HISTORY} END))) GROUP BY v.conv_id)
SELECT s.conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY i)) AS turns_sha256,
 CAST(coalesce(sum(length(x)) FILTER (WHERE r = '{chat.TARGET}'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(x, '' ORDER BY i) FILTER (WHERE r = '{chat.TARGET}'), '')) AS loss_sha256,
 CAST(any_value(formatted_chars) AS BIGINT) AS formatted_chars FROM s JOIN f ON f.conv_id = s.conv_id GROUP BY s.conv_id"""

_DIVERGENCE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS nl FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {divergence.LEAST}),
l AS (SELECT lang, count(*) AS v, sum(nl) AS total FROM k GROUP BY lang),
c AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN k ON k.lang = t.lang AND k.term = t.term GROUP BY ALL),
g AS (SELECT x.lang, x.source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN c ON c.lang = x.lang AND c.source = x.source GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, 1 + (CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 5)) // (CAST(g.total AS HUGEINT) + 5 * l.v) AS p,
  1 + (CAST(1000000000 AS HUGEINT) * (k.nl + 5)) // (CAST(l.total AS HUGEINT) + 5 * l.v) AS q
  FROM g JOIN l ON l.lang = g.lang JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
a AS (SELECT x.lang, x.source, y.source AS item, coalesce(v, 0) AS value FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN (SELECT m.lang, m.source AS s, o.source AS i, sum(abs(m.p - o.p)) AS v FROM p m JOIN p o ON m.lang = o.lang AND m.term = o.term AND m.source <> o.source GROUP BY ALL) z
  ON z.lang = x.lang AND z.s = x.source AND z.i = y.source),
f AS (SELECT lang, source, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
u AS (SELECT *, 'pair' AS part FROM a UNION ALL SELECT *, 'term' AS part FROM f),
o AS (SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM u)
SELECT lang, source, part, item, value, rank FROM o WHERE part = 'pair' OR rank <= {divergence.TOP}"""

_FIM_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS x, sha256('{piece_table.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
  regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM documents),
n AS (SELECT *, len(w) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3,
  CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= {piece_table.SHARE} THEN 'plain' WHEN h4 % 100 < {piece_table.SPM_SHARE} THEN 'spm' ELSE 'psm' END AS form FROM n),
p AS (SELECT *, array_to_string(w[1:a], '') AS p, array_to_string(w[a + 1:b], '') AS m, array_to_string(w[b + 1:], '') AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(x) AS restored_sha256 FROM p"""

ORACLES: dict[str, str] = {
    "op4_tree_mixing": _mix_sql(),
    "op5_ngram_jaccard": _JACCARD_SQL,
    "op9_chat_windows": _CHAT_SQL,
    "op10_positional_index": _PHRASE_SQL,
    "op11_translate_divergence": _DIVERGENCE_SQL,
    "op12_piece_table_fim": _FIM_SQL,
}
