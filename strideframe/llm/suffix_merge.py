"""Removal of long byte strings that occur more than once, by a distributed merge sort of suffixes.

Every byte inside a `LENGTH`-byte string that also starts anywhere else goes. Suffixes are sorted at
anchors: a string's anchor is the place in its first `REACH` bytes with the least hash of `GRAM` bytes, so equal
strings have equal anchors, at about two places in `REACH`.

1. One pass over the texts writes the anchors with a hash of the `LENGTH - REACH` bytes that follow (which
   lie inside each of its strings). Anchors whose hash occurs once are known to be unique and are
   not exchanged (duplicate detection by distinguishing prefixes). Equal texts count as one text;
   as all of their strings occur in a copy, they go whole.
2. Suffixes of the other anchors are sorted twice with the bytes before the anchor, reversed, as further
   characters: once after all bytes to the right (neighbours agree furthest to the right), once right after the
   shared bytes (neighbours agree furthest to the left). Each task sorts its suffixes, settles those with equal keys in place
   and keeps one of them, cuts the run at splitters (keys with their place, so that one key can lie in many ranges) and sends
   front-coded pieces (common prefix with the one before, and the rest). A loser tree merges the pieces of a range;
   its players carry their common prefix with the last output, so known prefixes are never compared again.
   Two neighbours that agree on R bytes to the right and L to the left prove all strings between them.
3. Strings that start further left than the furthest L or end beyond the furthest R of an anchor are unique. What
   neither neighbour settles in between (different best partners to the left and right) is settled
   by 128-bit hashes of those strings among anchors with the same following bytes.

Hashes of 64 bits choose what is compared; proofs of step 2 are byte comparisons.

Results for special inputs: null text is empty; texts shorter than LENGTH lose nothing; repeated rows are copies
of each other and lose everything from LENGTH bytes on; null keys are returned; an empty table gives no row; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.llm import blocks as B
from strideframe.session import materialise

LENGTH, REACH, GRAM = 400, 256, 16
SHARED = LENGTH - REACH     # bytes after an anchor that lie in all its strings
RANGE_BYTES = 24 << 20      # suffix bytes that one range is cut for
TEXT_BYTES = 1 << 19        # of texts that one numpy pass works on
RUN_ROWS = 1 << 14          # suffixes of one sorted run
SAMPLE = 20_000             # suffixes that splitters are taken from
FILTER_BITS = 1 << 24       # bits of the filter of texts to read again, sent to every task (2 MB)
PAD = 255                   # never a byte of UTF-8; ends suffixes and prefixes that are cut by their text
WIDE = LENGTH + REACH - 1
EMPTY = hashlib.sha256(b"").hexdigest()


def text_key(data, offsets):
    """128-bit key of each text."""
    n = np.diff(offsets)
    one = B.mix(B.Rolling(data).pieces(offsets[:-1], offsets[1:]) + n.astype(np.uint64))
    two = B.mix(B.Rolling(data, B.LANE).pieces(offsets[:-1], offsets[1:]) ^ n.astype(np.uint64))
    return one.view(np.int64), two.view(np.int64)


def _slide_min(x, width):
    n = len(x)
    grid = np.concatenate([x, np.full((-n) % width, np.uint64(2 ** 64 - 1))]).reshape(-1, width)
    head = np.minimum.accumulate(grid, axis=1).ravel()[:n]
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()[:n]
    m = n - width + 1
    return np.minimum(tail[:m], head[width - 1:width - 1 + m])


def anchors(data, offsets):
    """(text number, anchor, first and last string start, hash of the following bytes); places are in the block."""
    none = [np.empty(0, np.int64)] * 4 + [np.empty(0, np.uint64)]
    if len(data) < LENGTH or int(np.diff(offsets).max(initial=0)) < LENGTH:
        return none
    roll = B.Rolling(data)
    gram = B.mix(roll.windows(GRAM)) >> np.uint64(32) << np.uint64(32) | np.arange(len(data) - GRAM + 1, dtype=np.uint64)
    least = _slide_min(gram, REACH)
    valid = np.zeros(len(data) + 1, np.int32)
    long = np.diff(offsets) >= LENGTH
    np.add.at(valid, offsets[:-1][long], 1)
    np.add.at(valid, offsets[1:][long] - LENGTH + 1, -1)
    valid = np.cumsum(valid)[:len(least)] > 0
    place = np.where(valid, (least & np.uint64(0xFFFFFFFF)).astype(np.int64), -1)
    change = np.flatnonzero(np.diff(place, prepend=-2) != 0)
    stop = np.append(change[1:], len(place)) - 1
    keep = place[change] >= 0
    first, last = change[keep], stop[keep]
    at = place[first]
    return np.searchsorted(offsets, first, side="right") - 1, at, first, last, B.mix(roll.pieces(at, at + SHARED))


def _facts(df, key, text):
    """Per document its text's key, size and digest; per anchor (rows with `at`) its text's key and hash."""
    kind = df.schema[key].dataType.simpleString()
    names = ["id", "t1", "t2", "n", "sha", "at", "follow", "mark"]

    def run(batches):
        seen = set()
        for batch in batches:
            for a, data, offsets in B.blocks(batch, text, TEXT_BYTES):
                t1, t2 = text_key(data, offsets)
                m = len(t1)
                raw = data.tobytes()
                sha = [hashlib.sha256(raw[i:j]).hexdigest() for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, m), pa.array(t1), pa.array(t2), pa.array(np.diff(offsets)), pa.array(sha),
                                                  pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())], names=names)
                row, at, _, _, follow = anchors(data, offsets)
                fresh = np.zeros(m, bool)
                for i, k in enumerate(zip(t1.tolist(), t2.tolist())):
                    if k not in seen:
                        seen.add(k)
                        fresh[i] = True
                pick = fresh[row]
                row, at, follow = row[pick], at[pick] - offsets[row[pick]], follow[pick]
                m = len(row)
                # The mark tells places apart: equal for the same place of equal texts.
                mark = B.mix(t1[row].view(np.uint64) + B.mix(t2[row].view(np.uint64) ^ (at.astype(np.uint64) * B.LANE)))
                yield pa.RecordBatch.from_arrays([
                    pa.nulls(m, batch.schema.types[0]), pa.array(t1[row]), pa.array(t2[row]), pa.nulls(m, pa.int64()), pa.nulls(m, pa.string()),
                    pa.array(at), pa.array(follow.view(np.int64)), pa.array(mark.view(np.int64))], names=names)

    return df.mapInArrow(run, f"id {kind}, t1 long, t2 long, n long, sha string, at long, follow long, mark long")


def _filter_bits(keys):
    """Bits of the keys' filter; FILTER_BITS / 64 words whatever the input."""
    bit = F.pmod(F.col("t1"), F.lit(FILTER_BITS))
    rows = keys.select(F.shiftright(bit, 6).alias("w"), F.expr(f"shiftleft(1L, cast(pmod(t1, {FILTER_BITS}) % 64 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    out = np.zeros(FILTER_BITS // 64, np.int64)
    got = rows.toPandas()
    out[got["w"].to_numpy(np.int64)] = got["b"].to_numpy(np.int64)
    return out


def _texts(df, text, wanted):
    """(t1, t2, text, ats) of the texts with wanted anchors, each once."""
    shared = df.sparkSession.sparkContext.broadcast(_filter_bits(wanted))

    def run(batches):
        seen, bits = set(), shared.value
        for batch in batches:
            for _, data, offsets in B.blocks(batch, text, TEXT_BYTES):
                t1, t2 = text_key(data, offsets)
                bit = t1 % FILTER_BITS
                on = np.flatnonzero((bits[bit >> 6] >> (bit & 63)) & 1)
                pick = []
                for i in on.tolist():
                    if (t1[i], t2[i]) not in seen:
                        seen.add((t1[i], t2[i]))
                        pick.append(i)
                if pick:
                    raw = data.tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array(t1[pick]), pa.array(t2[pick]), pa.array([raw[offsets[i]:offsets[i + 1]] for i in pick], pa.binary())], names=["t1", "t2", "body"])

    found = df.select(text).mapInArrow(run, "t1 long, t2 long, body binary").groupBy("t1", "t2").agg(F.first("body").alias("body"))
    ats = wanted.groupBy("t1", "t2").agg(F.sort_array(F.collect_set("at")).alias("ats"))
    return found.join(ats, ["t1", "t2"])


def _around(data, offsets, doc, at):
    """Right (LENGTH) and reversed left (REACH - 1) bytes of places in texts of a block, padded; one row per place."""
    # Texts lie LENGTH apart, so that what is beyond a text's ends is padding.
    sizes = np.diff(offsets)
    start = LENGTH + B.starts(sizes + LENGTH)[:-1]
    padded = np.full(int(len(data) + LENGTH * (len(sizes) + 1)), PAD, np.uint8)
    padded[B.ranges(start, sizes)] = data
    view = np.lib.stride_tricks.sliding_window_view(padded, WIDE)
    both = view[start[doc] + at - (REACH - 1)]
    return both[:, REACH - 1:], both[:, :REACH - 1][:, ::-1]


def _keys(right, left, order):
    return np.concatenate([right, left] if order == 1 else [right[:, :SHARED], left, right[:, SHARED:]], axis=1)


def _common(a, b):
    """Common prefix lengths of the rows of two byte matrices."""
    differ = a != b
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def _prefix(a: bytes, b: bytes, h: int) -> int:
    """Common prefix of two strings that agree on h bytes; looks at what follows only."""
    n, step = min(len(a), len(b)), 16
    while h < n:
        if a[h:h + step] == b[h:h + step]:
            h = min(h + step, n)
            step *= 2
        elif step == 1:
            return h
        else:
            step = max(1, step // 4)
    return n


def merge(runs):
    """Merge sorted runs of (common prefix with the one before in the run, string, item).

    Yields (common prefix with the last output, string, item) in order. A loser tree: the player
    with the longer common prefix with the last output is the smaller; only equal ones are compared, from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    feeds = [iter(r) for r in runs] + [iter(())] * (k - len(runs))
    held, common = [next(f, None) for f in feeds], [0] * k

    def winner(i, j):
        """(winner, loser) of two players; the loser's common prefix becomes the one with the winner."""
        a, b = held[i], held[j]
        if b is None:
            return i, j
        if a is None:
            return j, i
        x, y = common[i], common[j]
        if x != y:
            return (i, j) if x > y else (j, i)
        s, t = a[1], b[1]
        h = _prefix(s, t, x)
        if s[h:h + 1] <= t[h:h + 1]:
            common[j] = h
            return i, j
        common[i] = h
        return j, i

    losers, level = [0] * k, list(range(k))
    base = k // 2
    while len(level) > 1:
        up = []
        for n in range(0, len(level), 2):
            w, lost = winner(level[n], level[n + 1])
            losers[base + n // 2] = lost
            up.append(w)
        level, base = up, base // 2
    top = level[0]
    while held[top] is not None:
        yield common[top], held[top][1], held[top][2]
        held[top] = next(feeds[top], None)
        common[top] = held[top][0] if held[top] is not None else 0
        node = (top + k) // 2
        while node:
            top, losers[node] = winner(top, losers[node])
            node //= 2


def _front_code(rows, same):
    """Rest bytes of sorted byte rows, given their common prefixes with the row before."""
    return rows[np.arange(WIDE)[None, :] >= same[:, None]]


def _pieces(same, rest):
    """Strings of a front-coded piece, one after the other."""
    before, at = b"", 0
    for h in memoryview(same).cast("H"):
        stop = at + WIDE - h
        before = before[:h] + rest[at:stop]
        at = stop
        yield h, before


def _feed(same, rest, *items):
    """Rows of a piece for `merge`, made as they are asked for."""
    for (h, s), item in zip(_pieces(same, rest), zip(*(memoryview(x).cast("q") for x in items))):
        yield h, s, item


def _collapse(keys, items):
    """(keys, items, common prefixes with the key before) of a sorted run with each key once, and the items of keys that were there more than once."""
    same = np.concatenate([[0], _common(keys[1:], keys[:-1])])
    equal = same == WIDE
    settled = equal | np.append(equal[1:], False)
    return keys[~equal], items[~equal], same[~equal], items[settled]


def _split(keys, items, splitters):
    """Range of each sorted key row; splitters are (key bytes, item), so equal keys are cut by their item."""
    names = np.ascontiguousarray(keys).view(f"V{WIDE}").ravel()
    cuts, at = np.zeros(len(names), np.int64), 0
    for s in splitters:
        lo, hi = at, len(names)
        while lo < hi:
            mid = (lo + hi) // 2
            if (names[mid].tobytes(), tuple(items[mid].tolist())) < s:
                lo = mid + 1
            else:
                hi = mid
        at = lo
        cuts[at:] += 1
    return cuts


def _sorted_keys(keys):
    """Order of the rows of a byte matrix."""
    names = np.ascontiguousarray(np.concatenate([keys, np.ones((len(keys), 1), np.uint8)], axis=1)).view(f"S{WIDE + 1}").ravel()
    return np.argsort(names, kind="stable")


def _listed(column, a, m):
    """(row, value) of the lists in rows a..a + m of a column; null lists are empty."""
    column = column.slice(a, m)
    offsets = column.offsets.to_numpy()
    sizes = np.where(np.asarray(column.is_valid()), np.diff(offsets), 0)
    at = B.ranges(offsets[:-1], sizes)
    return np.repeat(np.arange(m), sizes), at


def _blocks_of(batch, lists="ats"):
    """Blocks of a batch of texts: (first row, bytes, offsets, text of each listed place, place in its text)."""
    column = B.column(batch, lists)
    for a, data, offsets in B.blocks(batch, "body", TEXT_BYTES):
        doc, at = _listed(column, a, len(offsets) - 1)
        yield a, data, offsets, doc, column.values.to_numpy()[at]


def _neighbours(texts, order, splitters):
    """(t1, t2, at, r1, l1, r2, l2): bytes that the sorted neighbours before and after agree on, right and left.

    Rows with `edge` are the first and last suffix of a range, for the comparison between ranges. Suffixes with equal keys
    in a run have a row that says so, dealt to ranges of negative number, and one of them goes on to its range.
    """
    sent = ["range", "same", "rest", "t1", "t2", "at"]

    def runs(batches):
        keys, items, size = [], [], 0
        for batch in batches:
            t1, t2 = (B.column(batch, c).to_numpy() for c in ("t1", "t2"))
            for a, data, offsets, doc, at in _blocks_of(batch):
                for k in range(0, len(at), RUN_ROWS):
                    row, part = doc[k:k + RUN_ROWS], at[k:k + RUN_ROWS]
                    keys.append(_keys(*_around(data, offsets, row, part), order))
                    items.append(np.stack([t1[a + row], t2[a + row], part], axis=1))
                    size += len(part)
                    if size >= RUN_ROWS:
                        yield from run(np.concatenate(keys), np.concatenate(items))
                        keys, items, size = [], [], 0
        if size:
            yield from run(np.concatenate(keys), np.concatenate(items))

    def run(keys, items):
        by = _sorted_keys(keys)
        keys, items, same, settled = _collapse(keys[by], items[by])
        if len(settled):
            p = -1 - int(settled[0, 0] & 0x3FFFFFFF)
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), *[pa.nulls(1, pa.binary())] * 2, *[pa.array([x.tobytes()], pa.binary()) for x in settled.T.copy()]], names=sent)
        part = _split(keys, items, splitters)
        for p in np.unique(part).tolist():
            a, b = np.searchsorted(part, [p, p + 1])
            common = same[a:b].copy()
            common[0] = 0
            rest = _front_code(keys[a:b], common)
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in (common.astype(np.uint16), rest, *(items[a:b].T.copy()))]], names=sent)

    def emit(rows):
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:7]], pa.array(cols[7], pa.int32()), pa.array(cols[8], pa.binary())],
                                          names=["t1", "t2", "at", "r1", "l1", "r2", "l2", "edge", "key"])

    def alike(t1, t2, at):
        """Rows of suffixes whose keys some other has too: all bytes of the key agree."""
        cols = [np.frombuffer(x, np.int64) for x in (t1, t2, at)]
        m = len(cols[0])
        far = [np.full(m, x) for x in (LENGTH, REACH - 1, LENGTH, REACH - 1)]
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in (*cols, *far)], pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())],
                                          names=["t1", "t2", "at", "r1", "l1", "r2", "l2", "edge", "key"])

    def ranges(batches):
        part, pieces = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                p = batch.column(0)[i].as_py()
                if p < 0:
                    yield alike(*(batch.column(c)[i].as_py() for c in range(3, 6)))
                    continue
                if p != part and pieces:
                    yield from merged(part, pieces)
                    pieces = []
                part = p
                pieces.append([batch.column(c)[i].as_py() for c in range(1, 6)])
        if pieces:
            yield from merged(part, pieces)

    def merged(part, pieces):
        # The furthest of each neighbour pair, block by block to keep the matrices small.
        held, row = None, []
        first = True
        for h, s, item in merge([_feed(*x) for x in pieces]):
            now = [*item, 0, 0, 0, 0, None, None]
            if held is not None:
                if h >= SHARED:
                    right, left = agree(h, held[1], s, order)
                    now[3:5] = right, left
                    held[0][5:7] = right, left
                row.append(tuple(held[0]))
            if first:
                row.append((*item, 0, 0, 0, 0, 2 * part, s))
                first = False
            held = (now, s)
            if len(row) >= 4096:
                yield emit(row)
                row = []
        row.append(tuple(held[0]))
        row.append((*held[0][:3], 0, 0, 0, 0, 2 * part + 1, held[1]))
        yield emit(row)

    blocks = texts.mapInArrow(runs, "range int, same binary, rest binary, t1 binary, t2 binary, at binary")
    blocks = blocks.repartition("range").sortWithinPartitions("range")
    return blocks.mapInArrow(ranges, "t1 long, t2 long, at long, r1 long, l1 long, r2 long, l2 long, edge int, key binary")


def agree(h, a: bytes, b: bytes, order: int):
    """(right, left) bytes on which two suffix strings agree, given their common prefix h >= SHARED."""
    if order == 1:
        if h >= LENGTH:
            return LENGTH, h - LENGTH
        return h, _prefix(a[LENGTH:], b[LENGTH:], 0)
    left = min(h - SHARED, REACH - 1)
    if left < REACH - 1:
        return SHARED + _prefix(a[SHARED + REACH - 1:], b[SHARED + REACH - 1:], 0), left
    return SHARED + h - SHARED - (REACH - 1), left


def _sort(texts, order, total):
    """Neighbours of every suffix, also across ranges."""
    share = min(1.0, SAMPLE / max(total, 1))
    limit = np.uint64(min(int(share * 2 ** 64), 2 ** 64 - 1))

    def sample(batches):
        for batch in batches:
            t1, t2 = (B.column(batch, c).to_numpy() for c in ("t1", "t2"))
            for a, data, offsets, doc, at in _blocks_of(batch):
                # By text and place, so that equal keys are sampled one by one.
                on = B.mix(t1[a + doc].view(np.uint64) + B.mix(at.astype(np.uint64))) <= limit
                if on.any():
                    doc, at = doc[on], at[on]
                    got = [k.tobytes() for k in _keys(*_around(data, offsets, doc, at), order)]
                    yield pa.RecordBatch.from_arrays([pa.array(got, pa.binary()), pa.array(t1[a + doc]), pa.array(t2[a + doc]), pa.array(at)], names=["key", "t1", "t2", "at"])

    ranges = max(1, -(-total * WIDE // RANGE_BYTES))
    splitters = []
    if ranges > 1:
        some = sorted((bytes(r["key"]), (r["t1"], r["t2"], r["at"])) for r in texts.mapInArrow(sample, "key binary, t1 long, t2 long, at long").collect())
        splitters = sorted({some[len(some) * k // ranges] for k in range(1, ranges)}) if some else []
    found = materialise(_neighbours(texts, order, splitters), "neighbours")
    rows = found.where("edge is null").select("t1", "t2", "at", "r1", "l1", "r2", "l2")
    # Two rows a range: the last of one and the first of the next.
    edges = sorted(((r["edge"], r) for r in found.where("edge is not null").collect()), key=lambda x: x[0])
    more = []
    for (ea, a), (eb, b) in zip(edges[1::2], edges[2::2]):
        ka, kb = bytes(a["key"]), bytes(b["key"])
        h = _prefix(ka, kb, 0)
        if h >= SHARED:
            right, left = agree(h, ka, kb, order)
            more += [(a["t1"], a["t2"], a["at"], 0, 0, right, left), (b["t1"], b["t2"], b["at"], right, left, 0, 0)]
    if more:
        rows = rows.unionByName(texts.sparkSession.createDataFrame(more, rows.schema))
    return rows


def _settled(data, offsets, found):
    """What the sorted neighbours of a block's anchors prove: (covered string starts, open ones, anchors).

    found: arrays (text, order, at, r1, l1, r2, l2). Open strings lie inside the furthest agreements of their anchor and are
    proved by neither neighbour. Both are flags of places in the block; anchors hold disjoint ranges of string starts.
    """
    row, place, first, last, follow = anchors(data, offsets)
    doc, order, at, r1, l1, r2, l2 = found
    spot = offsets[doc] + at
    i = np.searchsorted(place, spot)
    i, order, spot = (np.concatenate([x, x]) for x in (i, order, spot))
    doc, right, left = np.concatenate([doc, doc]), np.concatenate([r1, r2]), np.concatenate([l1, l2])
    on = right >= SHARED
    i, order, spot, doc, right, left = (x[on] for x in (i, order, spot, doc, right, left))
    right, left = np.minimum(right, offsets[doc + 1] - spot), np.minimum(left, spot - offsets[doc])
    covered = _flags(len(data), np.maximum(spot - left, first[i]), np.minimum(spot + right - LENGTH, last[i]))
    far_right, far_left = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    np.maximum.at(far_right, i[order == 1], right[order == 1])
    np.maximum.at(far_left, i[order == 2], left[order == 2])
    known = np.unique(i)
    near = _flags(len(data), np.maximum(place - far_left, first)[known], np.minimum(place + far_right - LENGTH, last)[known])
    return covered, near & ~covered, (row, place, first, last, follow)


def _flags(n, first, last):
    """Which of n places lie in one of the closed ranges; empty ranges are ignored."""
    some = first <= last
    depth = np.bincount(first[some], minlength=n + 1) - np.bincount(last[some] + 1, minlength=n + 1)
    return np.cumsum(depth)[:n] > 0


def removals(df: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(facts of documents, per text what is removed): see `remove`."""
    source = df.select(key, text)
    facts = materialise(_facts(source, key, text), "facts")
    docs = facts.where("at is null").select("id", "t1", "t2", "n", "sha")
    marks = facts.where("at is not null").select("t1", "t2", "at", "follow", "mark")
    # Written before it is joined, so that a hash with a large share of all anchors is split by the join.
    twice = materialise(marks.groupBy("follow").agg(F.min("mark").alias("lo"), F.max("mark").alias("hi")).where("lo <> hi").select("follow"), "twice")
    wanted = materialise(marks.join(twice, "follow").select("t1", "t2", "at", "follow").distinct(), "wanted")
    total = wanted.count()
    texts = materialise(_texts(source, text, wanted), "texts")
    pairs = [_sort(texts, order, total).withColumn("o", F.lit(order)) for order in (1, 2)]
    found = pairs[0].unionByName(pairs[1]).groupBy("t1", "t2").agg(F.collect_list(F.struct("o", "at", "r1", "l1", "r2", "l2")).alias("found"))
    joined = materialise(texts.join(found, ["t1", "t2"]), "joined")

    def settle(batch):
        column = B.column(batch, "found")
        fields = [column.values.field(c).to_numpy() for c in ("o", "at", "r1", "l1", "r2", "l2")]
        for a, data, offsets in B.blocks(batch, "body", TEXT_BYTES):
            doc, at = _listed(column, a, len(offsets) - 1)
            yield a, data, offsets, *_settled(data, offsets, (doc, *(f[at] for f in fields)))

    def open_marks(batches):
        for batch in batches:
            for _, _, _, _, unsettled, (_, _, first, _, follow) in settle(batch):
                got = np.unique(follow[np.searchsorted(first, np.flatnonzero(unsettled), side="right") - 1])
                if len(got):
                    yield pa.RecordBatch.from_arrays([pa.array(got.view(np.int64))], names=["follow"])

    unsettled = materialise(joined.mapInArrow(open_marks, "follow long").distinct(), "open")
    near = wanted.join(unsettled, "follow", "left_semi").groupBy("t1", "t2").agg(F.sort_array(F.collect_set("at")).alias("open"))
    strings = joined.select("t1", "t2", "body", "ats").join(near, ["t1", "t2"])

    def windows(batches):
        for batch in batches:
            t1, t2 = (B.column(batch, c).to_numpy() for c in ("t1", "t2"))
            for a, data, offsets, doc, at in _blocks_of(batch, "open"):
                row, place, first, last, _ = anchors(data, offsets)
                on = np.searchsorted(place, offsets[doc] + at)
                size = (last - first + 1)[on]
                p, doc = B.ranges(first[on], size), np.repeat(doc, size)
                rolls = [B.Rolling(data, b) for b in (B.BASE, B.LANE)]
                for k in range(0, len(p), 4 * RUN_ROWS):
                    q, d = p[k:k + 4 * RUN_ROWS], doc[k:k + 4 * RUN_ROWS]
                    h = [B.mix(r.pieces(q, q + LENGTH)).view(np.int64) for r in rolls]
                    yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in (t1[a + d], t2[a + d], q - offsets[d], *h))], names=["t1", "t2", "p", "h1", "h2"])

    hashed = materialise(strings.mapInArrow(windows, "t1 long, t2 long, p long, h1 long, h2 long"), "strings")
    again = materialise(hashed.groupBy("h1", "h2").agg(F.count("*").alias("c")).where("c > 1").select("h1", "h2"), "again")
    starts = hashed.join(again, ["h1", "h2"]).groupBy("t1", "t2").agg(F.collect_list("p").alias("more"))
    last = joined.join(starts, ["t1", "t2"], "left")

    def cut(batches):
        names = ["t1", "t2", "first", "stop", "n_removed", "n_spans", "kept_sha"]
        for batch in batches:
            more = B.column(batch, "more")
            for a, data, offsets, covered, _, _ in settle(batch):
                m = len(offsets) - 1
                doc, at = _listed(more, a, m)
                begin = np.concatenate([np.flatnonzero(covered), offsets[doc] + more.values.to_numpy()[at]])
                gone = _flags(len(data), begin, begin + LENGTH - 1)
                # Runs end with their text.
                edge = np.zeros(len(data) + 1, bool)
                edge[offsets] = True
                opens, ends = gone.copy(), gone.copy()
                opens[1:] &= ~gone[:-1] | edge[1:-1]
                ends[:-1] &= ~gone[1:] | edge[1:-1]
                x, y = np.flatnonzero(opens), np.flatnonzero(ends) + 1
                of = np.searchsorted(offsets, x, side="right") - 1
                spans = np.bincount(of, minlength=m)
                lists = [pa.ListArray.from_arrays(pa.array(B.starts(spans).astype(np.int32)), pa.array(v - offsets[of])) for v in (x, y)]
                removed = np.bincount(of, y - x, minlength=m).astype(np.int64)
                kept, cuts = data[~gone].tobytes(), B.starts(np.diff(offsets) - removed).tolist()
                sha = [hashlib.sha256(kept[i:j]).hexdigest() for i, j in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays([B.column(batch, "t1").slice(a, m), B.column(batch, "t2").slice(a, m), *lists, pa.array(removed), pa.array(spans, pa.int64()), pa.array(sha, pa.string())],
                                                 names=names)

    return docs, last.mapInArrow(cut, "t1 long, t2 long, first array<bigint>, stop array<bigint>, n_removed long, n_spans long, kept_sha string")


def remove(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, first, stop) of every row; first and stop bound the removed runs in bytes."""
    docs, cuts = removals(df, key, text)
    copies = docs.groupBy("t1", "t2").agg(F.count("*").alias("copies")).where("copies > 1")
    rows = docs.join(copies, ["t1", "t2"], "left").join(cuts, ["t1", "t2"], "left")
    whole = F.col("copies").isNotNull() & (F.col("n") >= LENGTH)
    none = F.array().cast("array<bigint>")
    pick = lambda all_, some, rest: F.when(whole, all_).otherwise(F.coalesce(some, rest))
    zero = F.lit(0).cast("long")
    return rows.select(
        F.col("id").alias(key), F.col("n").alias("n_bytes"), pick(F.col("n"), F.col("n_removed"), zero).alias("n_removed"), pick(zero + 1, F.col("n_spans"), zero).alias("n_spans"),
        pick(F.lit(EMPTY), F.col("kept_sha"), F.col("sha")).alias("kept_sha256"),
        pick(F.array(zero), F.col("first"), none).alias("first"), pick(F.array("n"), F.col("stop"), none).alias("stop"))
