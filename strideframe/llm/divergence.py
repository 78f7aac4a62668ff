"""Audit of how sources differ in their words, by a translate-table tokenizer and sparse counts.

One `bytes.translate` lowers A-Z and blanks every separator, `bytes.split` gives the terms (runs of ASCII letters and of
bytes beyond ASCII), and a Counter for each document their frequencies. A task adds the Counters of a (language, source)
up to `HELD` entries before it sends them: rows of (language, source, term, occurrences, documents), which Spark adds up.

A language keeps the terms of at least `least` of its documents. With V kept terms and N of their occurrences, a group's
share of a term is, in units of 1 / SCALE and exactly,

    p = 1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V))

`terms` ranks for each (language, source) the kept terms that it uses more than its language does, `pairs` the other
sources of its language by the sum of |p - q| over all kept terms. Pairs are summed in blocks of `TERMS` terms by `TILE` x
`TILE` sources, each a dense matrix made in its task from the sparse counts; a term that neither tile has is counted, not stored.

Results for special inputs: null text, language and source are empty strings; a group without terms has N = 0; a language
without kept terms has pairs of value 0 and no terms; one source alone has no pairs; repeated rows are documents of their
own; equal values are ranked by item in byte order; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strideframe.llm import blocks as B
from strideframe.session import materialise

LEAST, TOP = 30, 50
SMOOTH, SCALE = 5, 1_000_000_000
HELD = 200_000              # entries of Counters that a task adds up before it sends them
PIECE_BYTES = 1 << 20       # bytes that are split at once; longer texts are cut at a separator
TERMS, TILE = 1024, 256
# Byte to byte: A-Z to a-z; other letters and bytes beyond ASCII stay; the rest is blank.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _pieces(text: bytes):
    """The translated text in pieces that end between terms."""
    at = 0
    while len(text) - at > PIECE_BYTES:
        stop = text.rfind(b" ", at, at + PIECE_BYTES)
        stop = stop if stop > at else text.find(b" ", at + PIECE_BYTES)
        if stop < 0:
            break
        yield text[at:stop]
        at = stop
    yield text[at:] if at else text


def count_terms(text: bytes) -> Counter:
    """Occurrences of each term of a text."""
    text = text.translate(TABLE)
    if len(text) <= PIECE_BYTES:
        return Counter(text.split())
    found = Counter()
    for piece in _pieces(text):
        found.update(piece.split())
    return found


def frequencies(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each group and documents with it.

    Each group also has one row with a null term, so that groups without terms are known.
    """
    clean = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))], F.col(text).alias("text"))

    def run(batches):
        held, size = {}, 0

        def send():
            for (a, b), (often, docs) in held.items():
                terms = list(often)
                k = len(terms)
                yield pa.RecordBatch.from_arrays([
                    pa.array([a] * (k + 1), pa.string()), pa.array([b] * (k + 1), pa.string()), pa.array([*terms, None], pa.binary()).cast(pa.string()),
                    pa.array([*often.values(), 0], pa.int64()), pa.array([*(docs[t] for t in terms), 0], pa.int64())], names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            groups = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for first, data, offsets in B.blocks(batch, "text"):
                raw, at = data.tobytes(), offsets.tolist()
                for i, (a, b) in enumerate(zip(at, at[1:])):
                    often, docs = held.setdefault(groups[first + i], (Counter(), Counter()))
                    size -= len(often)
                    one = count_terms(raw[a:b])
                    often.update(one)
                    docs.update(one.keys())
                    size += len(often)
                if size > HELD:
                    yield from send()
                    held, size = {}, 0
        yield from send()

    sent = clean.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return sent.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: str, total: str, kept: str) -> Column:
    """The smoothed share of columns or numbers, exact for counts of any size."""
    over = f"cast({count} + {SMOOTH} as decimal(20,0)) * cast({SCALE} as decimal(10,0))"
    return F.expr(f"1 + ({over} div cast({total} + {SMOOTH} * {kept} as decimal(20,0)))")


class Audit:
    """The tables of an audit: `groups` (lang, source, total, kept, p0, idx), `cells` (kept terms that a group has, with p) and `langs`."""

    def __init__(self, df: DataFrame, least: int = LEAST, text: str = "text", lang: str = "lang", source: str = "source"):
        counts = materialise(frequencies(df, text, lang, source), "terms")
        said = counts.where("term is not null")
        kept = materialise(said.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs")).where(F.col("docs") >= least).select("lang", "term", "n_lang"), "kept")
        self.kept = kept
        langs = kept.groupBy("lang").agg(F.sum("n_lang").alias("total_lang"), F.count("*").alias("kept"))
        used = materialise(said.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "cells")
        totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
        groups = counts.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        groups = groups.select("lang", "source", zero("total"), zero("kept"), zero("total_lang"))
        # The share of a term that the group does not have; there is none without kept terms.
        groups = groups.withColumn("p0", F.when(F.col("kept") > 0, _share("0", "total", "kept")).otherwise(0))
        self.groups = materialise(groups.withColumn("idx", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1), "groups")
        cells = used.join(self.groups, ["lang", "source"]).withColumn("p", _share("n", "total", "kept"))
        self.cells = cells.select("lang", "source", "term", "idx", "n_lang", "total_lang", "kept", "p")


def terms(audit: Audit, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): the `top` kept terms that a group has and whose share there most exceeds its language's."""
    over = audit.cells.withColumn("value", F.col("p") - _share("n_lang", "total_lang", "kept")).where("value > 0")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return over.select("lang", "source", F.col("term").alias("item"), "value").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def pairs(audit: Audit) -> DataFrame:
    """(lang, source, item, value, rank): all other sources of the language by how far their shares lie apart."""
    blocks = F.greatest(F.ceil(F.col("kept") / TERMS), F.lit(1)).cast("int")
    tiles = audit.groups.groupBy("lang").agg((F.floor(F.max("idx") / TILE) + 1).cast("int").alias("tiles"))
    tile = F.floor(F.col("idx") / TILE).cast("int")
    # Each tile of sources meets each tile, once: (x, y) with x <= y.
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    x, y = F.least("tile", "other").alias("x"), F.greatest("tile", "other").alias("y")
    cells = audit.cells.withColumns({"blk": F.pmod(F.xxhash64("term"), blocks).cast("int"), "tile": tile}).join(tiles, "lang")
    cells = cells.select("lang", "blk", "term", "idx", "p", "tile", other).select("lang", "blk", x, y, "term", "idx", "p")
    sources = audit.groups.withColumn("tile", tile).join(tiles, "lang").select("lang", "idx", "p0", "tile", blocks.alias("k"), other)
    sources = sources.select("lang", "idx", "p0", "tile", x, y, F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("blk"))
    sources = sources.toDF(*sources.columns)            # columns of its own: the cells come from the same groups

    def apart(key, many: pa.Table, own: pa.Table) -> pa.Table:
        """Sums of |p - q| over the terms of a block less what absent terms would give, for the source pairs of two tiles."""
        name, _, left, right = (k.as_py() for k in key)
        idx, p0 = own.column("idx").to_numpy(), own.column("p0").to_numpy()
        by = np.argsort(idx)
        idx, p0, of_tile = idx[by], p0[by], own.column("tile").to_numpy()[by]
        word = many.column("term").combine_chunks().dictionary_encode()
        shares = np.repeat(p0[:, None], len(word.dictionary), axis=1)
        shares[np.searchsorted(idx, many.column("idx").to_numpy()), word.indices.to_numpy()] = many.column("p").to_numpy()
        first, second, value = [], [], []
        for i in np.flatnonzero(of_tile == left).tolist():
            b = np.flatnonzero((of_tile == right) & (idx > idx[i]))
            if len(b):
                first.append(np.full(len(b), idx[i]))
                second.append(idx[b])
                value.append(np.abs(shares[b] - shares[i]).sum(axis=1) - shares.shape[1] * np.abs(p0[b] - p0[i]))
        cat = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
        first, second, value = cat(first), cat(second), cat(value)
        return pa.table({"lang": pa.array([name] * len(first), pa.string()), "a": pa.array(first, pa.int32()), "b": pa.array(second, pa.int32()), "part": pa.array(value, pa.int64())})

    keys = ["lang", "blk", "x", "y"]
    sums = cells.groupBy(*keys).cogroup(sources.groupBy(*keys)).applyInArrow(apart, "lang string, a int, b int, part long").groupBy("lang", "a", "b").agg(F.sum("part").alias("part"))
    named = lambda i, p, n: audit.groups.select("lang", F.col("idx").alias(i), F.col("p0").alias(p), F.col("source").alias(n), *(["kept"] if i == "a" else []))
    both = sums.join(named("a", "pa", "sa"), ["lang", "a"]).join(named("b", "pb", "sb"), ["lang", "b"])
    both = both.withColumn("value", F.col("part") + F.col("kept") * F.abs(F.col("pa") - F.col("pb")))
    side = F.explode(F.array(F.struct(F.col("sa").alias("source"), F.col("sb").alias("item")), F.struct(F.col("sb").alias("source"), F.col("sa").alias("item")))).alias("side")
    rows = both.select("lang", side, "value").select("lang", "side.source", "side.item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def audit(df: DataFrame, least: int = LEAST, top: int = TOP, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): `pair` rows of all other sources and `term` rows to rank `top`."""
    found = Audit(df, least, text, lang, source)
    rows = [pairs(found).withColumn("part", F.lit("pair")), terms(found, top).withColumn("part", F.lit("term"))]
    return rows[0].unionByName(rows[1]).select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
