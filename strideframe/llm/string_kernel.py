"""Language identification by a string kernel.

The kernel of two texts is the number of byte n-grams (all lengths in `GRAMS`, so a blended spectrum) that both
contain, over the geometric mean of their numbers. Presence, not frequency, counts. N-grams are hashed to `COLUMNS` columns.
`LANDMARKS` texts of the fitting sample span a Nyström map, and one ridge regression for
each language against the rest is solved in its space. Scoring multiplies a block of presence rows with the
landmarks and the result with one matrix; scores are the softmax of the regressions.

The sample holds at most `SAMPLE` rows of each language, chosen by hash of the key; every row and whole text is scored.

Results for special inputs: a text that is null or has no letter is `und` with score 1; rows without a language or key do not
teach; one language alone gets every text; without any language all texts are `und`; repeated rows get equal results; an empty table
gives no row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strideframe.llm import blocks as B

GRAMS = (2, 3, 4)
COLUMNS = 1 << 13
LANDMARKS = 160
SAMPLE = 300                # texts of each language
RIDGE = 1e-3
SHARP = 12.0                # of the softmax
ROWS = 512                  # rows of one matrix product
UNKNOWN = "und"


def _plain() -> np.ndarray:
    """Byte to byte: ASCII letters in lower case, other ASCII to space, the rest as it is."""
    t = np.arange(256, dtype=np.uint8)
    t[:128] = 32
    t[97:123] = np.arange(97, 123)
    t[65:91] = np.arange(97, 123)
    return t


PLAIN = _plain()


def presence(data, offsets) -> np.ndarray:
    """0/1 rows of the n-grams of each text."""
    n = len(offsets) - 1
    out = np.zeros(n * COLUMNS, np.float32)
    x = PLAIN[data].astype(np.uint32)
    row = np.repeat(np.arange(n, dtype=np.int64) * COLUMNS, np.diff(offsets))
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))          # bytes to the end of the text
    code = x.copy()
    for k in range(2, max(GRAMS) + 1):
        if len(x) < k:
            break
        code = code[:-1] * np.uint32(0x01000193) ^ x[k - 1:] * np.uint32(0x9E3779B1)
        if k in GRAMS:
            column = ((code * np.uint32(0x85EBCA6B) + np.uint32(k)) >> np.uint32(32 - 13)).astype(np.int64)
            inside = left[:len(code)] >= k
            out[(row[:len(code)] + column)[inside]] = 1
    return out.reshape(n, COLUMNS)


class Model:
    """Landmarks, their map and the languages; callable on presence rows."""

    def __init__(self, names, landmarks=None, weights=None):
        self.names, self.landmarks, self.weights = names, landmarks, weights

    @staticmethod
    def _kernel(rows, landmarks):
        sizes = np.sqrt(np.maximum(rows.sum(axis=1), 1))[:, None] * np.sqrt(np.maximum(landmarks.sum(axis=1), 1))[None, :]
        return rows @ landmarks.T / sizes

    def scores(self, rows):
        f = self._kernel(rows, self.landmarks) @ self.weights
        f = SHARP * (f - f.max(axis=1, keepdims=True))
        e = np.exp(f)
        return e / e.sum(axis=1, keepdims=True)

    @classmethod
    def fit(cls, rows, labels, seed=11):
        names = sorted(set(labels))
        if len(names) < 2:
            return cls(names)
        y = np.array([names.index(v) for v in labels])
        rng = np.random.default_rng(seed)
        share = max(LANDMARKS // len(names), 1)
        picked = np.concatenate([rng.permutation(np.flatnonzero(y == k))[:share] for k in range(len(names))])
        landmarks = rows[picked]
        own = cls._kernel(landmarks, landmarks).astype(np.float64)
        values, vectors = np.linalg.eigh(own)
        keep = values > 1e-6 * values.max()
        root = vectors[:, keep] / np.sqrt(values[keep])
        phi = cls._kernel(rows, landmarks) @ root
        target = np.where(y[:, None] == np.arange(len(names))[None, :], 1.0, -1.0)
        weigh = (1.0 / np.bincount(y))[y][:, None]
        solved = np.linalg.solve(phi.T @ (phi * weigh) + RIDGE * np.eye(phi.shape[1]), phi.T @ (target * weigh))
        return cls(names, landmarks, (root @ solved).astype(np.float32))


def fit(df: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> Model:
    known = df.where(F.col(key).isNotNull() & F.col(label).isNotNull() & F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    order = Window.partitionBy("label").orderBy(F.xxhash64("k"), "k")
    picked = known.select(F.col(key).alias("k"), F.col(label).cast("string").alias("label")).withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= SAMPLE)
    # SAMPLE keys of each language at most, so they can be sent to every task.
    rows = df.select(F.col(key).alias("k"), F.col(text).alias("text")).join(F.broadcast(picked.select("k", "label")), "k").select(F.col("k").cast("string").alias("k"), "label", "text")

    def run(batches):
        for batch in batches:
            for a, data, offsets in B.blocks(batch, "text"):
                for i in range(0, len(offsets) - 1, ROWS):
                    at = offsets[i:i + ROWS + 1]
                    bits = np.packbits(presence(data[at[0]:at[-1]], at - at[0]).astype(bool), axis=1)
                    m = len(bits)
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a + i, m), batch.column(1).slice(a + i, m), B.as_binary(bits.ravel(), np.full(m, COLUMNS // 8))], names=["k", "label", "bits"])

    got = sorted((r["k"], r["label"], bytes(r["bits"])) for r in rows.mapInArrow(run, "k string, label string, bits binary").collect())
    if not got:
        return Model([])
    rows = np.unpackbits(np.frombuffer(b"".join(g[2] for g in got), np.uint8).reshape(len(got), -1), axis=1).astype(np.float32)
    return Model.fit(rows, [g[1] for g in got])


def predict(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) of every row."""
    source = df.select(key, text, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    kind = source.schema[key].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches):
        m = Model(**shared.value)
        names = np.array([*m.names, UNKNOWN], object)
        for batch in batches:
            letter = np.asarray(batch.column(2))
            for a, data, offsets in B.blocks(batch, text):
                for i in range(0, len(offsets) - 1, ROWS):
                    at = offsets[i:i + ROWS + 1]
                    n = len(at) - 1
                    best, score = np.zeros(n, np.int64), np.ones(n)
                    if m.weights is not None:
                        p = m.scores(presence(data[at[0]:at[-1]], at - at[0]))
                        best = p.argmax(axis=1)
                        score = p[np.arange(n), best].astype(float)
                    best = np.where(letter[a + i:a + i + n], best, len(m.names)) if m.names else np.zeros(n, np.int64)
                    score = np.where(best == len(m.names), 1.0, score)
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a + i, n), pa.array(names[best].tolist(), pa.string()), pa.array(score)], names=[key, "lang_pred", "score"])

    return source.mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double")
