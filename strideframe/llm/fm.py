"""Quality scores by a factorisation machine over hashed words, structure statistics and metadata.

A document's inputs are its words (lower-cased, hashed to `WORDS` columns, each weighing
1 / sqrt(number of different columns)), `len(STATS)` statistics of its whole text and the given numeric
metadata columns (log-scaled), both standardised over the fitting sample. With
weights w and low-rank factors V the score is

    sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i V_if x_i)^2 - sum_i V_if^2 x_i^2])

so all pairwise interactions cost time linear in the inputs. It is fitted on the driver on a bounded,
deterministic sample of labelled rows (`SAMPLE` for each label, by hash of the key), weighted back to the labels' shares;
scoring covers every row and text.

Results for special inputs: null and empty texts have no word and zero statistics and get the score of that; null metadata
counts as 0; labels other than 0 and 1, null labels and labels of unknown keys are ignored; without rows of both labels every score is the
share of label 1 (0.5 without any label); repeated rows get equal scores; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.llm import blocks as B

WORDS = 1 << 14
FACTORS = 8
SAMPLE = 2000               # labelled rows of each label that the model is fitted on
EPOCHS, BATCH, RATE, DECAY = 12, 128, 0.08, 1e-5
GREATEST = 4.0              # standardised statistics are clipped to +-this
STATS = ["log_bytes", "log_words", "mean_word", "upper", "digit", "space", "line", "sentence", "mark", "symbol", "pipe", "high", "control",
         "distinct", "upper_words", "repeated_lines", "longest_line", "no_end"]
INSIDE = B.byte_set((0, 47), (58, 64), (91, 96), (123, 127))


# Classes of bytes whose shares are statistics; every other byte is in class 0.
CLASSES = [("upper", range(65, 91)), ("digit", range(48, 58)), ("space", b" \t"), ("line", b"\n\r"), ("sentence", b".,;:?"), ("mark", b"!"),
           ("symbol", b"#$%&*+-/<=>@\\^_`~()[]{}\"'"), ("pipe", b"|"), ("high", range(128, 256)), ("control", bytes([*range(0, 9), 11, 12, *range(14, 32), 127]))]


def _class_table():
    out = np.zeros(256, np.uint8)
    for k, (_, members) in enumerate(CLASSES):
        out[list(members)] = k + 1
    return out


CLASS_OF = _class_table()


def _counts(flags, first, stop):
    """How many of the flags first..stop are set, for ascending pieces that do not overlap."""
    out = np.zeros(len(first), np.int64)
    some = np.flatnonzero(stop > first)
    if len(some):
        edges = np.stack([first[some], stop[some]], axis=1).ravel()
        # The piece after the last edge is not asked for; an edge at the end of the flags can not be given.
        edges = edges[:-1] if edges[-1] == len(flags) else edges
        out[some] = np.add.reduceat(flags, edges, dtype=np.int64)[::2]
    return out


def inputs(data, offsets):
    """(columns, values, row offsets) of hashed words and the statistics of a block of texts."""
    n = len(offsets) - 1
    low = B.lower_table()[data]
    first, stop, count = B.words(low, offsets, INSIDE)
    h = B.mix(B.Rolling(low).pieces(first, stop))
    row = np.repeat(np.arange(n), count)
    key = np.unique(row * WORDS + (h >> np.uint64(20)).astype(np.int64) % WORDS)
    columns, rows = key % WORDS, key // WORDS
    different = np.bincount(rows, minlength=n)
    values = 1 / np.sqrt(np.maximum(different, 1))[rows]
    size = np.diff(offsets)
    stats = {"log_bytes": np.log1p(size), "log_words": np.log1p(count),
             "mean_word": np.bincount(row, stop - first, minlength=n) / np.maximum(count, 1)}
    kind = CLASS_OF[data]
    for k, (name, _) in enumerate(CLASSES):
        stats[name] = _counts((kind == k + 1).view(np.uint8), offsets[:-1], offsets[1:]) / np.maximum(size, 1)
    stats["distinct"] = different / np.maximum(count, 1)
    upper = _counts((kind == 1).view(np.uint8), first, stop)
    stats["upper_words"] = np.bincount(row, (upper == stop - first) & (stop - first > 1), minlength=n) / np.maximum(count, 1)
    inside = np.ones(256, bool)
    inside[[10, 13]] = False
    a, b, lines = B.words(data, offsets, inside)
    at = B.starts(lines)
    lh = B.mix(B.Rolling(data).pieces(a, b))
    owner = np.repeat(np.arange(n), lines)
    order = np.lexsort((lh, owner))
    again = np.zeros(len(lh), bool)
    again[1:] = (lh[order][1:] == lh[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    stats["repeated_lines"] = np.bincount(owner[order], again, minlength=n) / np.maximum(lines, 1)
    longest = np.zeros(n)
    np.maximum.at(longest, owner, b - a)
    stats["longest_line"] = np.log1p(longest)
    ends = np.zeros(n)
    full = lines > 0
    ends[full] = ~np.isin(data[b[at[1:][full] - 1] - 1], list(b".!?\"'"))
    stats["no_end"] = ends
    return columns, values, B.starts(different), np.stack([stats[s] for s in STATS], axis=1)


class Model:
    def __init__(self, share: float, metadata: int = 0):
        self.extra = len(STATS) + metadata
        self.bias = float(np.log(share / (1 - share)))
        self.w = np.zeros(WORDS + self.extra)
        self.v = np.zeros((WORDS + self.extra, FACTORS))
        self.mean, self.scale = np.zeros(self.extra), np.ones(self.extra)

    @classmethod
    def of(cls, state: dict) -> Model:
        """The model with the plain state that `vars` gives; models are sent to tasks so."""
        out = cls.__new__(cls)
        vars(out).update(state)
        return out

    def scaled(self, dense):
        return np.clip((dense - self.mean) / self.scale, -GREATEST, GREATEST)

    def parts(self, columns, values, row, dense):
        """Linear score and the factor sums of each row; dense inputs are scaled already."""
        n = len(dense)
        linear = self.bias + np.bincount(row, self.w[columns] * values, minlength=n) + dense @ self.w[WORDS:]
        vd = self.v[WORDS:]
        sums = np.stack([np.bincount(row, self.v[columns, f] * values, minlength=n) for f in range(FACTORS)], axis=1) + dense @ vd
        norm = np.einsum("ij,ij->i", self.v, self.v)[columns] * values ** 2
        squares = np.bincount(row, norm, minlength=n) + dense ** 2 @ (vd ** 2).sum(axis=1)
        return linear + 0.5 * ((sums ** 2).sum(axis=1) - squares), sums

    def score(self, columns, values, at, dense):
        row = np.repeat(np.arange(len(dense)), np.diff(at))
        z, _ = self.parts(columns, values, row, self.scaled(dense))
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))

    def fit(self, columns, values, at, dense, label, weight, seed=7):
        """Adagrad on the weighted logistic loss."""
        rng = np.random.default_rng(seed)
        self.mean, self.scale = dense.mean(axis=0), np.maximum(dense.std(axis=0), 1e-6)
        dense = self.scaled(dense)
        self.v = rng.normal(0, 0.02, self.v.shape)
        gw, gv, gb = np.full(len(self.w), 1e-6), np.full(self.v.shape, 1e-6), 1e-6
        size = WORDS + self.extra
        for _ in range(EPOCHS):
            order = rng.permutation(len(dense))
            for k in range(0, len(order), BATCH):
                rows = order[k:k + BATCH]
                lengths = at[rows + 1] - at[rows]
                pick = B.ranges(at[rows], lengths)
                c, x, r, d = columns[pick], values[pick], np.repeat(np.arange(len(rows)), lengths), dense[rows]
                z, sums = self.parts(c, x, r, d)
                err = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - label[rows]) * weight[rows] / len(rows)
                ex = err[r] * x
                w = np.bincount(c, ex, minlength=size)
                w[WORDS:] += err @ d
                square = np.bincount(c, ex * x, minlength=size)
                square[WORDS:] += err @ d ** 2
                v = np.stack([np.bincount(c, ex * sums[r, f], minlength=size) for f in range(FACTORS)], axis=1)
                v[WORDS:] += d.T @ (err[:, None] * sums)
                v -= square[:, None] * self.v
                w += DECAY * self.w
                v += DECAY * self.v
                gw += w ** 2
                gv += v ** 2
                self.w -= RATE * w / np.sqrt(gw)
                self.v -= RATE * 0.25 * v / np.sqrt(gv)
                gb += err.sum() ** 2
                self.bias -= RATE * err.sum() / np.sqrt(gb)
        return self


def _dense(batch, metadata, a, n):
    cols = []
    for name in metadata:
        x = B.column(batch, name).slice(a, n).cast(pa.float64()).fill_null(0).to_numpy(zero_copy_only=False)
        cols.append(np.sign(x) * np.log1p(np.abs(np.nan_to_num(x))))
    return np.stack(cols, axis=1) if cols else np.empty((n, 0))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", metadata: tuple = (), sample: int = SAMPLE) -> Model:
    """A model of `label` from at most `sample` labelled documents of each value."""
    known = labels.select(key, F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.col(key).isNotNull())
    shares = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    total = sum(shares.values())
    if len(shares) < 2:
        return Model(min(max(shares.get(1, 0) / total, 0.001), 0.999) if total else 0.5, len(metadata))
    picked = known.where("label = 0").orderBy(F.xxhash64(key), key).limit(sample).unionByName(known.where("label = 1").orderBy(F.xxhash64(key), key).limit(sample))
    # Two times `sample` keys at most, so they can be sent to every task.
    rows = docs.select(key, text, *metadata).join(F.broadcast(picked), key)

    def run(batches):
        for batch in batches:
            for a, data, offsets in B.blocks(batch, text):
                columns, values, at, stats = inputs(data, offsets)
                n = len(stats)
                dense = np.concatenate([stats, _dense(batch, metadata, a, n)], axis=1)
                yield pa.RecordBatch.from_arrays([
                    B.column(batch, "label").slice(a, n), pa.array(B.column(batch, key).slice(a, n)).cast(pa.string()), B.as_binary(columns.astype(np.int32).view(np.uint8), np.diff(at) * 4),
                    B.as_binary(values.view(np.uint8), np.diff(at) * 8), B.as_binary(dense.view(np.uint8).ravel(), np.full(n, dense.shape[1] * 8))], names=["label", "id", "columns", "values", "dense"])

    got = sorted(rows.mapInArrow(run, "label int, id string, columns binary, values binary, dense binary").collect(), key=lambda r: (r["id"], r["label"], r["columns"], r["values"], r["dense"]))
    y = np.array([r["label"] for r in got], float)
    if len(got) == 0 or y.min() == y.max():
        return Model(min(max(shares[1] / total, 0.001), 0.999), len(metadata))
    seen = np.array([(y == 0).sum(), (y == 1).sum()])
    weight = np.array([shares[0] / seen[0], shares[1] / seen[1]])[y.astype(int)]
    columns = np.concatenate([np.frombuffer(r["columns"], np.int32) for r in got])
    values = np.concatenate([np.frombuffer(r["values"]) for r in got])
    at = B.starts([len(r["columns"]) // 4 for r in got])
    dense = np.stack([np.frombuffer(r["dense"]) for r in got])
    return Model(shares[1] / total, len(metadata)).fit(columns, values, at, dense, y, weight / weight.mean())


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", metadata: tuple = (), keep: tuple = (), name: str = "score") -> DataFrame:
    """(key, kept columns, score) of every row; the score's column is called `name`."""
    source = docs.select(*dict.fromkeys([key, text, *metadata, *keep]))
    out = list(dict.fromkeys([key, *keep]))
    kinds = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in out)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches):
        m = Model.of(shared.value)
        for batch in batches:
            for a, data, offsets in B.blocks(batch, text):
                columns, values, at, stats = inputs(data, offsets)
                n = len(stats)
                s = m.score(columns, values, at, np.concatenate([stats, _dense(batch, metadata, a, n)], axis=1))
                yield pa.RecordBatch.from_arrays([*[B.column(batch, c).slice(a, n) for c in out], pa.array(s)], names=[*out, name])

    return source.mapInArrow(run, f"{kinds}, `{name}` double")
