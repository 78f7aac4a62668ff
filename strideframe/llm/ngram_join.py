"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

1. One pass over the texts gives each document its set's key (128 bits), size and profile (how many of
   its n-grams fall in each of 64 hash ranges), and counts all n-grams of all documents in a sketch of
   `WIDTH` counters. Documents with equal sets become one node, named by the smallest id.
2. A second pass orders each set rare-first (by sketch count, then hash) and posts its prefix: sets that
   reach the threshold share an n-gram of their prefixes. An n-gram that the sketch shows as
   frequent is salted. Lists of one set are dropped.
3. Stars: the members of a list are compared with the list's first set (most central by mean count).
   Length, positional and suffix filters drop pairs before they are verified, once per pair,
   on whole sets. Links give components.
4. The rest, exactly: in lists that still hold several components, all pairs of different components
   pass the same filters inside blocks of at most about `BLOCK` rows, and survivors are verified. Pairs that
   are linked already need no check, so a list of copies or near copies costs no pairs.

The suffix filter is a lower bound of the symmetric difference: the sum over hash ranges of the
differences of the profiles.

Results for special inputs: null or blank text is an empty set, linked with nothing; a text with fewer words than
the n-gram is one n-gram; equal sets are linked; rows with a null
id are returned with a null component and link nothing; an empty table gives no row; other columns are ignored.
Rows that repeat an id are one document of several texts: each of them links it.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strideframe.llm import blocks as B
from strideframe.llm.components import connected
from strideframe.session import materialise

WIDTH = 1 << 20             # counters of the frequency sketch; it is all that is sent to every task (4 MB)
COUNTERS = 1 << 12          # counters in one row of the sketch
PARTS = 64                  # hash ranges of a profile
SALT_ROWS = 1 << 16         # rows of one list in one task, before a frequent n-gram is salted
BLOCK = 1024                # rows of one block of a list whose pairs are filtered together
MEMBERS = 4096              # members verified with one copy of their list's first set
INSIDE = B.byte_set((32, 32), (9, 13))


def _sets(data, offsets, size):
    """Distinct n-gram hashes of each text as (hashes, offsets), ascending within a text."""
    low = B.lower_table()[data]
    first, stop, count = B.words(low, offsets, INSIDE)
    h = B.mix(B.Rolling(low).pieces(first, stop))
    at = B.starts(count)
    n = len(h)
    gram = np.zeros(n, np.uint64)
    for k in range(size):
        gram[:n - k] += h[k:] * np.uint64((2 * k + 3) * 0x9E3779B1 | 1)
    gram = B.mix(gram)
    grams = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    short = np.flatnonzero((count > 0) & (count < size))
    for i in short:                                       # the whole sequence as one, in a hash space of its own length
        whole = h[at[i]:at[i + 1]] * np.arange(3, 3 + 2 * count[i], 2, dtype=np.uint64)
        gram[at[i]] = B.mix(B.mix(np.array([whole.sum()], np.uint64)) + np.uint64(count[i]))[0]
    picked = gram[B.ranges(at[:-1], grams)]
    row = np.repeat(np.arange(len(grams)), grams)
    order = np.lexsort((picked, row))
    picked, row = picked[order], row[order]
    keep = np.ones(len(picked), bool)
    keep[1:] = (picked[1:] != picked[:-1]) | (row[1:] != row[:-1])
    picked, row = picked[keep], row[keep]
    return picked, B.starts(np.bincount(row, minlength=len(grams)))


def _sums(values, at):
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def _keys(grams, at):
    """128-bit key of each set."""
    n = np.diff(at).astype(np.uint64)
    s1 = B.mix(_sums(B.mix(grams), at) + n)
    s2 = B.mix(_sums(B.mix(grams ^ np.uint64(0x5851F42D4C957F2D)), at) * np.uint64(3) + n)
    return s1.view(np.int64), s2.view(np.int64)


def _profiles(grams, at):
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    part = (grams >> np.uint64(58)).astype(np.int64)
    counts = np.bincount(row * PARTS + part, minlength=(len(at) - 1) * PARTS)
    return np.minimum(counts, 255).astype(np.uint8).reshape(-1, PARTS)          # cut counts still bound a difference from below


def _bucket(grams):
    return (grams >> np.uint64(17)).astype(np.int64) & (WIDTH - 1)


def _facts(df, key, text, size):
    """Per document its set; per task the sketch in rows of COUNTERS deflated counters (rows with `block`)."""
    kind = df.schema[key].dataType.simpleString()
    names = ["id", "n", "s1", "s2", "profile", "block"]

    def run(batches):
        counts, id_type = np.zeros(WIDTH, np.int64), None
        for batch in batches:
            id_type = batch.schema.types[0]
            for a, data, offsets in B.blocks(batch, text):
                grams, at = _sets(data, offsets, size)
                counts += np.bincount(_bucket(grams), minlength=WIDTH)
                s1, s2 = _keys(grams, at)
                m = len(s1)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, m), pa.array(np.diff(at)), pa.array(s1), pa.array(s2),
                    B.as_binary(_profiles(grams, at).ravel(), np.full(m, PARTS)), pa.nulls(m, pa.int32())], names=names)
        if id_type is not None:
            m = WIDTH // COUNTERS
            yield pa.RecordBatch.from_arrays([
                pa.nulls(m, id_type), *[pa.nulls(m, pa.int64())] * 3,
                pa.array([zlib.compress(x.tobytes(), 1) for x in counts.reshape(m, COUNTERS)], pa.binary()), pa.array(np.arange(m, dtype=np.int32))], names=names)

    return df.mapInArrow(run, f"id {kind}, n long, s1 long, s2 long, profile binary, block int")


def _sketch(facts) -> np.ndarray:
    """The counters of all tasks, added up; WIDTH numbers whatever the input."""
    def run(batches):
        block, total = None, np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for b, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                if b != block and block is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["block", "profile"])
                    total[:] = 0
                block = b
                total += np.frombuffer(zlib.decompress(raw.as_py()), np.int64)
        if block is not None:
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["block", "profile"])

    rows = facts.where("block is not null").select("block", "profile").repartition("block").sortWithinPartitions("block").mapInArrow(run, "block int, profile binary")
    out = np.zeros(WIDTH, np.uint32)
    for r in rows.collect():
        out[r["block"] * COUNTERS:(r["block"] + 1) * COUNTERS] = np.minimum(np.frombuffer(r["profile"], np.int64), 2 ** 32 - 1)
    return out


def _postings(df, text, size, num, den, counts):
    """Prefix n-grams of each distinct set: (g, salt, s1, s2, nj, pri); copies inside a task post once."""
    limit = max(SALT_ROWS, 4 * int(counts.mean(dtype=np.float64)) + 1)
    shared = df.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        counts, seen = shared.value, set()
        for batch in batches:
            for _, data, offsets in B.blocks(batch, text):
                grams, at = _sets(data, offsets, size)
                s1, s2 = _keys(grams, at)
                fresh = np.zeros(len(s1), bool)
                for i, k in enumerate(zip(s1.tolist(), s2.tolist())):
                    if k not in seen:
                        seen.add(k)
                        fresh[i] = True
                n = np.diff(at)
                seen_count = counts[_bucket(grams)].astype(np.int64)
                order = np.lexsort((grams, seen_count, np.repeat(np.arange(len(n)), n)))
                prefix = np.where(fresh & (n > 0), n + (-(num * n) // den) + 1, 0)
                picked = order[B.ranges(at[:-1], prefix)]
                row = np.repeat(np.arange(len(n)), prefix)
                j = B.ranges(np.zeros(len(n), np.int64), prefix)
                pri = _sums(np.minimum(seen_count, 1 << 30).astype(np.uint64), at).astype(np.int64) // np.maximum(n, 1)
                salts = -(-seen_count[picked] // limit)
                yield pa.RecordBatch.from_arrays([
                    pa.array(grams[picked].view(np.int64)), pa.array((s1[row].view(np.uint64) % np.maximum(salts, 1).astype(np.uint64)).astype(np.int32)),
                    pa.array(salts.astype(np.int32)), pa.array(s1[row]), pa.array(s2[row]), pa.array(n[row] << 32 | j), pa.array(-pri[row])],
                    names=["g", "salt", "salts", "s1", "s2", "nj", "pri"])

    return df.mapInArrow(run, "g long, salt int, salts int, s1 long, s2 long, nj long, pri long")


def _fits(na, ja, nb, jb, pa_, pb, num, den):
    """Length, positional and suffix filters; all arguments are arrays that broadcast."""
    total = na + nb
    need = -(-(num * total) // (num + den))
    ok = (den * np.minimum(na, nb) >= num * np.maximum(na, nb)) & (1 + np.minimum(na - ja - 1, nb - jb - 1) >= need)
    if pa_ is not None and ok.any():
        gap = np.abs(pa_.astype(np.int64) - pb.astype(np.int64)).sum(axis=-1)
        ok = ok & (gap <= total - 2 * need)
    return ok


def _star_pairs(shared, nodes, num, den):
    """(hub, member) node pairs of each salted list and between the lists of one n-gram, filters passed."""
    first = F.first(F.struct("pri", "s1", "s2", "nj"))
    order = ["pri", "s1", "s2", "nj"]
    run = Window.partitionBy("g", "salt").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = shared.withColumn("hub", first.over(run))
    heads = rows.where("hub.s1 = s1 and hub.s2 = s2 and salts > 1").drop("hub").distinct()
    over = Window.partitionBy("g").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    heads = heads.withColumn("hub", first.over(over))
    pairs = rows.unionByName(heads).where("not (hub.s1 = s1 and hub.s2 = s2)").select(
        F.col("hub.s1").alias("a1"), F.col("hub.s2").alias("a2"), F.col("hub.nj").alias("anj"), F.col("s1").alias("b1"), F.col("s2").alias("b2"), F.col("nj").alias("bnj"))
    pairs = pairs.where(_plain_filter("anj", "bnj", num, den))
    pairs = pairs.groupBy("a1", "a2", "b1", "b2").agg(F.min(F.struct("anj", "bnj")).alias("x")).select("a1", "a2", "b1", "b2", "x.*")
    left = nodes.select(F.col("s1").alias("a1"), F.col("s2").alias("a2"), F.col("node").alias("a"), F.col("profile").alias("pa"))
    right = nodes.select(F.col("s1").alias("b1"), F.col("s2").alias("b2"), F.col("node").alias("b"), F.col("profile").alias("pb"))
    full = pairs.join(left, ["a1", "a2"]).join(right, ["b1", "b2"]).select("a", "b", "anj", "bnj", "pa", "pb")

    def run_filter(batches):
        for batch in batches:
            m = batch.num_rows
            if m:
                pa_, pb = (B.flat(batch.column(k))[0].reshape(m, PARTS) for k in (4, 5))
                anj, bnj = (batch.column(k).to_numpy() for k in (2, 3))
                ok = _fits(anj >> 32, anj & 0xFFFFFFFF, bnj >> 32, bnj & 0xFFFFFFFF, pa_, pb, num, den)
                yield batch.select([0, 1]).filter(pa.array(ok))

    kind = full.schema["a"].dataType.simpleString()
    return full.mapInArrow(run_filter, f"a {kind}, b {kind}").distinct()


def _plain_filter(anj, bnj, num, den):
    na, nb = F.shiftright(anj, 32), F.shiftright(bnj, 32)
    ja, jb = F.col(anj).bitwiseAND(F.lit(0xFFFFFFFF)), F.col(bnj).bitwiseAND(F.lit(0xFFFFFFFF))
    left = F.least(na - ja, nb - jb)
    return (den * F.least(na, nb) >= num * F.greatest(na, nb)) & (left * (num + den) >= num * (na + nb))


def _verify(df, key, text, pairs, size, num, den):
    """Pairs (a, b) of nodes whose whole sets reach the threshold; each set is computed once and sent once per hub."""
    pairs = materialise(pairs, "pairs")
    kind = pairs.schema["a"].dataType.simpleString()
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    texts = df.select(F.col(key).alias("node"), F.col(text).alias("text")).join(wanted, "node", "left_semi")

    def sets(batches):
        for batch in batches:
            for a, data, offsets in B.blocks(batch, "text"):
                grams, at = _sets(data, offsets, size)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, len(at) - 1), B.as_binary(grams.view(np.uint8), np.diff(at) * 8)], names=["node", "grams"])

    have = materialise(texts.mapInArrow(sets, f"node {kind}, grams binary"), "sets")
    per_hub = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("salts"))
    hubs = per_hub.join(have.withColumnRenamed("node", "a"), "a").select(
        "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast(kind).alias("b"), "grams")
    members = pairs.join(per_hub, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int")).join(
        have.withColumnRenamed("node", "b"), "b").select("a", "salt", "b", "grams")
    both = hubs.unionByName(members).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())

    def compare(batches):
        hub, sets_of_hub = None, []
        for batch in batches:
            a, salt, b = (batch.column(k).to_pylist() for k in (0, 1, 2))
            data, at = B.flat(batch.column(3))
            got = []
            for i in range(batch.num_rows):
                mine = data[at[i]:at[i + 1]].copy().view(np.uint64)
                if b[i] is None:
                    if hub != (a[i], salt[i]):
                        hub, sets_of_hub = (a[i], salt[i]), []
                    sets_of_hub.append(mine)
                elif hub == (a[i], salt[i]) and any(_reaches(grams, mine, num, den) for grams in sets_of_hub):
                    got.append(i)
            if got:
                yield batch.select([0, 2]).take(pa.array(got))

    return both.mapInArrow(compare, f"a {kind}, b {kind}").distinct()


def _reaches(x, y, num, den):
    """Whether two ascending sets reach the threshold."""
    if not len(x) or not len(y):
        return False
    both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
    return den * both >= num * (len(x) + len(y) - both)


def _rest_pairs(shared, nodes, labels, num, den):
    """Filtered pairs of different components in lists that hold several, by blocks."""
    kind = nodes.schema["node"].dataType.simpleString()
    lab = nodes.join(labels, "node", "left").select("s1", "s2", "node", "profile", F.coalesce("component", "node").alias("comp"))
    rows = shared.select("g", "s1", "s2", "nj").distinct().join(lab.select("s1", "s2", "comp"), ["s1", "s2"])
    lists = rows.groupBy("g").agg(F.count("*").alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("g", F.ceil(F.col("m") / BLOCK).cast("int").alias("k"))
    rows = rows.drop("comp").join(lists, "g").withColumn("blk", F.pmod(F.xxhash64("s1", "s2"), F.col("k")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    rows = rows.select("g", F.least("blk", "other").alias("x"), F.greatest("blk", "other").alias("y"), "blk", "nj", "s1", "s2")
    rows = rows.join(lab, ["s1", "s2"]).select("g", "x", "y", "blk", "nj", "node", "comp", "profile")
    rows = rows.repartition("g", "x", "y").sortWithinPartitions("g", "x", "y", "blk", "node")

    def filtered(nj, node, comp, prof, blk):
        n, j = nj >> 32, nj & 0xFFFFFFFF
        out = []
        cross = blk[0] != blk[-1]
        for i in range(len(n) - 1):
            o = slice(int(np.searchsorted(blk, blk[i], side="right")), None) if cross else slice(i + 1, None)
            if cross and blk[i] == blk[-1]:
                break
            near = np.flatnonzero(comp[o] != comp[i]) + o.start
            if len(near):
                near = near[_fits(n[i], j[i], n[near], j[near], None, None, num, den)]
            if len(near):
                near = near[_fits(n[i], j[i], n[near], j[near], prof[i], prof[near], num, den)]
            out += [(node[i], node[k]) for k in near.tolist()]
        return out

    def run(batches):
        held = None
        seen = set()

        def flush(t):
            if t is None or t.num_rows < 2:
                return None
            blk, nj, comp = (t.column(c).to_numpy() for c in ("blk", "nj", "code"))
            prof = B.flat(t.column("profile"))[0].reshape(-1, PARTS)
            got = [p for p in filtered(nj, t.column("node").to_pylist(), comp, prof, blk) if p not in seen]
            if len(seen) < 1_000_000:
                seen.update(got)
            return got

        def emit(got):
            return pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], node_type), pa.array([g[1] for g in got], node_type)], names=["a", "b"])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            node_type = batch.schema.field("node").type
            t = t.append_column("code", pa.array(_codes(t.column("comp"))))
            held = t if held is None else pa.concat_tables([held, t])
            key = [held.column(c).to_numpy() for c in ("g", "x", "y")]
            edge = np.flatnonzero((np.diff(key[0]) != 0) | (np.diff(key[1]) != 0) | (np.diff(key[2]) != 0)) + 1
            if len(edge) == 0:
                continue
            for a, b in zip([0, *edge[:-1].tolist()], edge.tolist()):
                if got := flush(held.slice(a, b - a)):
                    yield emit(got)
            held = held.slice(int(edge[-1]))
        if got := flush(held):
            yield emit(got)

    return rows.mapInArrow(run, f"a {kind}, b {kind}").distinct()


def _codes(column):
    """Equal component names, equal integers (the names themselves where they are integers)."""
    if pa.types.is_integer(column.type):
        return column.to_numpy().astype(np.int64)
    return np.array([hash(v) for v in column.to_pylist()], np.int64)


def _solve(df, key, text, size, num, den):
    source = df.select(key, text)
    facts = materialise(_facts(source, key, text, size), "facts")
    counts = _sketch(facts)
    docs = facts.where("block is null").select("id", "n", "s1", "s2", "profile")
    nodes = materialise(docs.where("n > 0 and id is not null").groupBy("s1", "s2").agg(
        F.min("id").alias("node"), F.first("profile").alias("profile"), F.first("n").alias("n")), "nodes")
    posts = _postings(source, text, size, num, den, counts)
    order = Window.partitionBy("g", "salt").orderBy("pri", "s1", "s2", "nj")
    shared = posts.withColumn("before", F.lag("s1").over(order)).withColumn("after", F.lead("s1").over(order)).where(
        "salts > 1 or before is not null or after is not null").drop("before", "after")
    shared = materialise(shared, "postings")
    links = materialise(_verify(source, key, text, _star_pairs(shared, nodes, num, den), size, num, den), "links")
    labels = materialise(connected(links), "labels")
    rest = materialise(_rest_pairs(shared, nodes, labels, num, den), "rest")
    if rest.limit(1).count():
        more = materialise(_verify(source, key, text, rest, size, num, den), "links")
        links = links.unionByName(more)
        labels = materialise(connected(links), "labels")
    return docs, nodes, links, labels


def components(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """(key, n_shingles, component_id) of every row; sets with den * intersection >= num * union are linked."""
    docs, nodes, _, labels = _solve(df, key, text, size, num, den)
    named = nodes.join(labels, "node", "left").select("s1", "s2", F.coalesce("component", "node").alias("component"))
    out = docs.select("id", "n", "s1", "s2").join(named, ["s1", "s2"], "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"),
                      F.when(F.col("id").isNull(), None).otherwise(F.coalesce("component", "id")).alias("component_id"))


def links(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, num: int = 90, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """(links between nodes that span every component, membership of rows in nodes)."""
    docs, nodes, found, _ = _solve(df, key, text, size, num, den)
    return found, docs.join(nodes.select("s1", "s2", "node"), ["s1", "s2"], "left").select(F.col("id").alias(key), F.col("node"))
