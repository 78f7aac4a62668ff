import random
import re

import pytest
from pyspark.sql import functions as F

from strideframe.operators import checks as C
from strideframe.operators import corpus as P
from strideframe.operators import joins as J
from strideframe.operators import ledger as L
from strideframe.plans.digests import ordered_digest
from strideframe.plans import graphs, pages
from strideframe.plans.packing import greedy_shards
from strideframe.plans.ranges import containing_counts, points_in_intervals


def fold(rows, target):
    """The sequential rule."""
    shard, total, held, out = 0, 0, {}, {}
    for k, body, blobs in rows:
        want = {**held, **blobs}
        if out and total + body + sum(want.values()) > target or not out:
            shard, total, held = shard + 1, 0, {}
        out[k] = shard
        total += body
        held.update(blobs)
    return out


@pytest.mark.parametrize("seed,rows_per_task", [(1, 10), (2, 40), (3, 100000)])
def test_packing_equals_the_sequential_fold(spark, split_keys, seed, rows_per_task):
    rnd = random.Random(seed)
    sizes = {f"b{i}": rnd.randint(1, 400) for i in range(6)}
    data, rows = {"hot": [], "cold": []}, []
    for ds, n in (("hot", 400), ("cold", 9)):
        for i in range(n):
            blobs = {b: sizes[b] for b in rnd.sample(sorted(sizes), rnd.randint(0, 2))}
            body = rnd.choice([1, 5, 60, 130, 2500 if rnd.random() < 0.05 else 20])
            data[ds].append((i, body, blobs))
            rows.append((ds, i, body, [{"sha256": b, "size": s} for b, s in blobs.items()]))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "ds string, k bigint, body bigint, blobs array<struct<sha256:string,size:bigint>>")
    out = greedy_shards(df, keys=["ds"], order=["k"], body="body", blobs="blobs", max_bytes=1000, rows_per_task=rows_per_task).collect()
    for ds in data:
        assert {r.k: r.shard for r in out if r.ds == ds} == fold(data[ds], 850)


def test_digest_sees_order_not_layout(spark):
    rows = [("a", i, f"x{i}") for i in range(50)] + [("b", 0, "y")]
    df = spark.createDataFrame(rows, "k string, p bigint, v string")
    one = {r.k: r.digest for r in ordered_digest(df, ["k"], "p", F.col("v"), fan=4).collect()}
    two = {r.k: r.digest for r in ordered_digest(df.repartition(7), ["k"], "p", F.col("v"), fan=4).collect()}
    moved = {r.k: r.digest for r in ordered_digest(df.withColumn("p", F.when(F.col("p") == 3, 4).when(F.col("p") == 4, 3).otherwise(F.col("p"))),
                                                   ["k"], "p", F.col("v"), fan=4).collect()}
    assert one == two and moved["a"] != one["a"] and moved["b"] == one["b"]


def test_merge_keeps_shared_objects_once_and_reports_conflicts(spark):
    obj = lambda *r: spark.createDataFrame(list(r), "sha256 string, role string, byte_length bigint, object_key string")
    ids = lambda *r: spark.createDataFrame([(x,) for x in r], "candidate_id string")
    a, b = obj(("s1", "motion", 1, "k1"), ("s2", "sensors", 2, "k2")), obj(("s1", "motion", 1, "k1"), ("s3", "motion", 3, "k3"))
    objects, cand, exc, clash = P.merge_corpora([a, b], [ids("c1", "c2"), ids("c3")], [ids("x1"), ids("x2")])
    assert objects.count() == 3 and clash.count() == 0
    r = P.merged_statistics(cand, exc).first()
    assert (r.total_clips, r.published_candidates, r.candidate_rate) == (5, 3, 0.6)
    bad = obj(("s1", "motion", 9, "k1"))
    clash = P.merge_corpora([a, bad], [ids("c1"), ids("x1")], [ids("x1"), ids("x2")])[3].collect()
    assert sorted(r.rule for r in clash) == ["candidate-conflict", "identity-conflict"]


def strongly_connected(edges):
    """Mutual reach by plain search from every node."""
    out = {}
    for a, b in edges:
        out.setdefault(a, set()).add(b)
    reach = {}
    for n in {x for e in edges for x in e}:
        seen, todo = set(), list(out.get(n, ()))
        while todo:
            v = todo.pop()
            if v not in seen:
                seen.add(v)
                todo += out.get(v, ())
        reach[n] = seen
    groups = {n: {m for m in s if n in reach[m]} for n, s in reach.items() if n in s}
    return sorted((n, min(g), len(g)) for n, g in groups.items())


@pytest.mark.parametrize("seed", range(3))
def test_cycle_groups_equal_mutual_reach(spark, seed):
    rnd = random.Random(seed)
    n = 45
    edges = [(rnd.randrange(n), rnd.randrange(n)) for _ in range((30, 50, 80)[seed])]
    # Two rings joined by a path, a long chain, a self edge, repeats and null ends.
    edges += [(100 + i, 100 + (i + 1) % 7) for i in range(7)] + [(120 + i, 120 + (i + 1) % 3) for i in range(3)] + [(103, 110), (110, 121)]
    edges += [(200 + i, 201 + i) for i in range(12)] + [(300, 300), (120, 120)] + edges[:5]
    df = spark.createDataFrame(edges + [(None, 1), (1, None)], "s int, t int")
    got = sorted(tuple(r) for r in graphs.cycle_groups(df, source="s", target="t").collect())
    assert got == strongly_connected(edges)


def test_no_cycle_gives_no_row(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(9)], "s int, t int")
    assert graphs.cycle_groups(df, source="s", target="t").count() == 0
    assert graphs.cycle_groups(df.limit(0), source="s", target="t").count() == 0


def test_closure_finds_cycles(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a")], "s string, t string")
    out = {(r.s, r.t): (r.steps, r.cycle) for r in J.dependency_closure(e, source="s", target="t").collect()}
    assert out["a", "a"] == (3, True) and out["d", "c"] == (3, False) and len(out) == 12


def test_interval_join_and_sweep_agree_with_brute_force(spark, split_keys):
    rnd = random.Random(4)
    pts = [("k", i, rnd.randint(0, 60)) for i in range(120)]
    ivs = [("k", a, a + rnd.randint(0, 25)) for a in (rnd.randint(0, 50) for _ in range(40))]
    p = spark.createDataFrame(pts, "k string, id bigint, at bigint")
    v = spark.createDataFrame(ivs, "k string, a bigint, b bigint")
    want = {i: sum(a < t < b for _, a, b in ivs) for _, i, t in pts}
    got = {r.id: r.n_containing for r in containing_counts(p, v, ["k"], point="at", start="a", stop="b").collect()}
    assert got == want
    pairs = points_in_intervals(p, v, ["k"], point="at", start="a", stop="b", width=7)
    assert pairs.count() == sum(want.values())


# --- golden core: two sequences, one fall -------------------------------------------------------

SEQ = "sequence_index int, sample_start bigint, sample_stop bigint, is_fall boolean, length bigint"
ANN = "sequence_index int, kind string, start_sample bigint, stop_sample bigint, code string, line bigint"
GOLD_SEQ = [(0, 0, 4, False, 4), (1, 4, 10, True, 6)]
GOLD_ANN = [(0, "activity", 0, 4, "standing", 0), (1, "activity", 0, 6, "fall", 1), (1, "onset", 0, 0, "fall", 2), (1, "impact", 2, 2, "fall", 3)]


def all_checks(spark, seq, ann, rows=10):
    s, a = spark.createDataFrame(seq, SEQ), spark.createDataFrame(ann, ANN)
    n = spark.createDataFrame([(rows,)], "rows bigint")
    out = (C.sequence_contiguity(s, index="sequence_index", start="sample_start", stop="sample_stop", rows=n)
           .unionByName(C.annotation_order(a, file_order="line")).unionByName(C.interval_cover(a, s)).unionByName(C.event_pairing(a, s)))
    return sorted(r.rule for r in out.collect())


def test_golden_core_is_clean(spark):
    assert all_checks(spark, GOLD_SEQ, GOLD_ANN) == []


@pytest.mark.parametrize("change,rules", [
    (lambda s, a: (s, a, 11), ["incomplete-cover"]),
    (lambda s, a: ([s[0], (1, 5, 10, True, 6)], a, 10), ["noncontiguous"]),
    (lambda s, a: (s, [a[0], a[1], a[3][:5] + (2,), a[2][:5] + (3,)], 10), ["annotation-order"]),
    (lambda s, a: (s, [(0, "activity", 0, 3, "standing", 0)] + a[1:], 10), ["incomplete-cover"]),
    (lambda s, a: (s, [(0, "activity", 1, 4, "standing", 0)] + a[1:], 10), ["coverage-gap-overlap"]),
    (lambda s, a: (s, a[:3] + [(1, "impact", 6, 6, "fall", 3)], 10), ["impact-in-fall", "orphan-impact"]),
    (lambda s, a: (s, a[:2] + [(1, "onset", 0, 0, "other", 2)] + a[3:], 10), ["onset-activity", "orphan-impact"]),
    (lambda s, a: ([s[0], (1, 4, 10, False, 6)], a, 10), ["fall-flag"]),
])
def test_every_mutation_of_the_core_is_found(spark, change, rules):
    assert all_checks(spark, *change(list(GOLD_SEQ), list(GOLD_ANN))) == rules


def test_audit_finds_missing_damaged_and_misbound(spark):
    art = "struct<key:string,sha256:string,byte_length:bigint>"
    commits = spark.createDataFrame([("c1", [("k1", "s1", 5), ("k2", "s2", 6)], "d1")], f"commit_key string, artifacts array<{art}>, commit_sha256 string")
    listing = lambda *r: spark.createDataFrame(list(r), "key string, size bigint, sha256 string")
    feed = lambda d: spark.createDataFrame([("f1", "c1", d)], "feed_key string, commit_key string, commit_sha256 string")
    full = listing(("k1", 5, "s1"), ("k2", 6, "s2"))
    run = lambda l, f: sorted(r.rule for r in J.reference_audit(commits, l, f).collect())
    assert run(full, feed("d1")) == []
    assert run(listing(("k1", 5, "s1")), feed("d1")) == ["artifact-missing"]
    assert run(listing(("k1", 5, "bad"), ("k2", 7, "s2")), feed("d1")) == ["artifact-digest", "artifact-size"]
    assert run(full, feed("other")) == ["feed-digest"]


def test_status_log_keeps_the_first_terminal_status(spark, split_keys):
    rows = [("a", 1, "pending-publish"), ("a", 2, "failed"), ("a", 3, "published"), ("a", 4, "published"), ("a", 5, "excluded"), ("b", 1, "failed")]
    rows += [("hot", i, "pending-publish" if i < 20 else "excluded") for i in range(40)]
    df = spark.createDataFrame(rows, "clip string, seq bigint, status string").withColumn("error", F.lit("e" * 1200))
    got = {(r.clip, r.seq): r.outcome for r in L.status_transitions(df, key="clip", order=["seq"], status="status").collect()}
    assert [got["a", i] for i in range(1, 6)] == ["accepted", "accepted", "accepted", "repeat", "illegal"]
    assert got["hot", 20] == "accepted" and got["hot", 21] == "repeat"
    now = {r.clip: (r.status, len(r.error)) for r in L.current_status(df, key="clip", order=["seq"], status="status", error="error").collect()}
    assert now == {"a": ("published", 1200), "b": ("failed", 1200), "hot": ("excluded", 1200)}


def test_pressure_edges(spark, split_keys):
    df = spark.createDataFrame([(i, 1 if i < 30 else -1) for i in range(60)], "us bigint, d bigint")
    out = L.pressure_edges(df, time_us="us", order=["us"], delta="d", limit=20).orderBy("us").collect()
    assert [(r.us, r.edge) for r in out] == [(19, "upload-backpressure"), (40, "upload-capacity-restored")]


def test_text_ids_are_order_keys_everywhere(spark, split_keys):
    """Offsets, shards and exports in the order of text ids."""
    from strideframe.operators import delivery as K

    rnd = random.Random(6)
    ids = [f"clip-{rnd.randrange(10 ** 9):09d}" for _ in range(60)]
    rows = [(k, rnd.randint(1, 40)) for k in ids]
    df = spark.createDataFrame(rows, "k string, n bigint")
    at, want = 0, {}
    for i, (k, n) in enumerate(sorted(rows)):
        want[k] = (i, at, at + n)
        at += n
    assert {r.k: (r.ordinal, r.start, r.stop) for r in P.running_offsets(df, order=["k"], length="n").collect()} == want
    packed = greedy_shards(df.withColumn("ds", F.lit("d")), keys=["ds"], order=["k"], body="n", max_bytes=100, fill=0.9)
    assert {r.k: r.shard for r in packed.collect()} == fold([(k, n, {}) for k, n in sorted(rows)], 90)
    signals = spark.createDataFrame([(k, m, t, float(t)) for k, n in rows for m in ("chest", "wrist") for t in range(n)], "k string, mount string, t bigint, v double")
    seq, samples = K.export_mounts(signals, clip="k", mount="mount", order=["t"], values=["v"])
    ranges = {(r.k, r.mount): (r.sequence_index, r.sample_start, r.sample_stop) for r in seq.collect()}
    at = 0
    for i, (k, m) in enumerate(sorted(ranges)):
        n = dict(rows)[k]
        assert ranges[k, m] == (i, at, at + n)
        at += n
    assert sorted(r["sample"] for r in samples.collect()) == list(range(at))
    labelled = df.select("k", F.lit("weak").alias("state"), F.lit("walk").alias("code"), F.lit("r").alias("rule_id"), "n")
    core = K.weak_core(labelled, df.select("k", F.lit(True).alias("passed")), key="k", samples="n", mounts=["a", "b"]).collect()
    assert [r.k for r in sorted(core, key=lambda r: r.sequence_index)] == [k for k, _ in sorted(rows) for _ in range(2)]


def test_long_and_short_intervals_meet_their_points(spark):
    rnd = random.Random(9)
    points = [("k", i, rnd.randint(-50, 3_000_000)) for i in range(300)]
    spans = [("k", j, a, a + n) for j, (a, n) in enumerate([(0, 5), (10, 0), (-40, 3_000_000), (7, 448), (7, 449), (1000, 30_000), (5, 2_000_000), (100, 1)])]
    p = spark.createDataFrame(points, "k string, id bigint, at bigint")
    v = spark.createDataFrame(spans, "k string, iv bigint, a bigint, b bigint")
    got = {(r.id, r.iv) for r in points_in_intervals(p, v, ["k"], point="at", start="a", stop="b", width=7).collect()}
    assert got == {(i, j) for _, i, t in points for _, j, a, b in spans if a < t < b}


def test_left_join_keeps_points_in_no_interval(spark):
    p = spark.createDataFrame([("k", 1, 3), ("k", 2, 2_000_000), ("k", 3, -5), ("k", 3, -5), ("j", 4, 3), (None, 5, 3)], "k string, id bigint, at bigint")
    v = spark.createDataFrame([("k", 0, 0, 5), ("k", 1, 0, 3_000_000), ("k", 2, None, 9)], "k string, iv bigint, a bigint, b bigint")
    join = lambda how, v=v: sorted(((r.id, r.iv) for r in points_in_intervals(p, v, ["k"], point="at", start="a", stop="b", width=7, how=how).collect()), key=str)
    assert join("inner") == [(1, 0), (1, 1), (2, 1)]
    assert join("left") == [(1, 0), (1, 1), (2, 1), (3, None), (3, None), (4, None), (5, None)]
    with pytest.raises(ValueError):
        join("full")


@pytest.mark.parametrize("limit", [1, 30, 95, 400])
def test_a_page_opens_the_files_it_needs(spark, tmp_path, limit):
    rows = [(i // 7, i) for i in range(400)]
    random.Random(1).shuffle(rows)
    path = str(tmp_path / "t")
    pages.write_clustered(spark.createDataFrame(rows, "u int, i bigint"), path, order=["u", "i"], rows_per_file=40)
    seen, after = [], None
    while True:
        files = pages.page_files(spark, path, order=["u", "i"], after=after, limit=limit)
        assert len(files) <= 2 + limit // 20
        page = [tuple(r) for r in pages.clustered_page(spark, path, order=["u", "i"], after=after, limit=limit).collect()]
        seen += page
        if len(page) < limit or len(seen) > 3 * limit:
            break
        after = page[-1]
    assert seen == sorted(rows)[:len(seen)] and seen
    assert pages.clustered_page(spark, path, order=["u", "i"], after=(9999, 0), limit=limit).count() == 0


def test_checks_and_reasons_are_worked_out_once(spark):
    """a clip's map of checks and its reasons are not written out again in each expression that reads them."""
    from strideframe.operators import qa
    rows = spark.createDataFrame([(1, "a", True, True, 0.0, 0.0), (2, "b", False, True, 0.0, 0.0)],
                                 "id int, src string, ok boolean, guard_complete boolean, acceleration_rms_m_s2 double, angular_velocity_rms_rad_s double")
    checks = F.map_from_arrays(F.array(*map(F.lit, qa.POLICY["required_checks"])), F.array(*[F.col("ok")] * 4))
    out = qa.exclusion(qa.gate(rows.withColumn("checks", checks)), source="src", policy={**qa.POLICY, "paused_sources": ["b"]})
    plan = out.where("excluded").select("id", "passed", "reasons")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("map_from_arrays(") == 1 and plan.count("array_remove(") == 1
    got = {r.id: (r.passed, r.excluded, r.reasons) for r in out.collect()}
    assert got[1] == (True, False, []) and got[2][:2] == (False, True) and "source-quarantined" in got[2][2]


@pytest.mark.parametrize("seed", range(4))
def test_closure_checks_only_walks_that_may_repeat(spark, seed):
    """forks, cycles, loops on cycles and tails into them give each pair once, at its fewest steps."""
    rng = random.Random(seed)
    n = 9
    pairs = {(a, a // 2) for a in range(n)} if seed == 0 else {(0, 0), (0, 1), (1, 0), (2, 0), (3, 2), (4, 5), (5, 6), (6, 5)} if seed == 1 else {
        (a, rng.randrange(n)) for a in range(n) for _ in range(seed - 1)}
    want = {}
    for a in range(n):
        at, k = {b for x, b in pairs if x == a}, 1
        while at:
            want.update({(a, b): k for b in at})
            at, k = {y for b in at for x, y in pairs if x == b and (a, y) not in want}, k + 1
    edges = spark.createDataFrame(sorted(pairs), "s long, t long")
    got = [((r.s, r.t), r.steps) for r in J.dependency_closure(edges, source="s", target="t").collect()]
    assert len(got) == len(want) and dict(got) == want
    some = J.dependency_closure(edges, source="s", target="t", roots=edges.where("s in (3, 4)")).collect()
    assert sorted(((r.s, r.t), r.steps) for r in some) == sorted(x for x in want.items() if x[0][0] in (3, 4))


def test_closure_without_forks_joins_the_frontier_only(spark, monkeypatch):
    """the closure so far is not joined again in each round when no walk can repeat a pair."""
    seen, real = [], J.materialise
    monkeypatch.setattr(J, "materialise", lambda df, name: seen.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, name))
    edges = spark.range(64).selectExpr("id as s", "floor(id / 2) as t")
    assert J.dependency_closure(edges, source="s", target="t").count() == sum(max(1, i.bit_length()) for i in range(64))
    assert not any("LeftAnti" in plan for plan in seen)


def test_cycle_rounds_send_no_table_to_the_driver(spark, monkeypatch):
    """joins of a round are dealt by key."""
    seen, real = [], graphs.materialise
    monkeypatch.setattr(graphs, "materialise", lambda df, name: seen.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, name))
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4)], "s long, t long")
    got = {(r.node, r.component, r.size) for r in graphs.cycle_groups(edges, source="s", target="t").collect()}
    assert got == {(1, 1, 3), (2, 1, 3), (3, 1, 3)}
    # The last table joins the groups once; all others are made in rounds.
    assert not any("BroadcastHashJoin" in plan for plan in seen[:-1])


def test_plans_of_the_same_clips_are_placed_once(spark):
    """several identities come from one pass and equal those of one plan each."""
    plan = spark.range(40).selectExpr("id % 3 as source", "id as k", "id % 7 as x", "id % 5 as y")
    both = P.plan_identity(plan, source="source", order=["k"], fields={"one": ["k", "x"], "two": ["k", "y"]})
    alone = {n: {r.source: r.identity for r in P.plan_identity(plan, source="source", order=["k"], fields=f).collect()} for n, f in (("one", ["k", "x"]), ("two", ["k", "y"]))}
    got = both.collect()
    assert {r.source: r.one for r in got} == alone["one"] and {r.source: r.two for r in got} == alone["two"]
    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 40")
    assert scans(both) == scans(P.plan_identity(plan, source="source", order=["k"], fields=["k", "x"]))


def test_samples_are_numbered_in_even_ranges(spark, tmp_path, monkeypatch):
    """No task takes the whole order, or several of its segments, and equal and null values keep every position."""
    from strideframe.bindings.joins import samples
    from strideframe.plans import ordered
    rows = [(i // 4 % 900 if i % 50 else None, i % 3, 7, 1, 1.0, 2.0) for i in range(6000)]
    spark.createDataFrame(rows, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_extendedprice double, l_quantity double").coalesce(1).write.parquet(
        str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(ordered, "segment_rows", lambda _: 4000)
    out = samples(spark, str(tmp_path))
    sizes = [spark.read.parquet(f).count() for f in out.inputFiles()]
    assert sum(sizes) == 6000 and max(sizes) <= 2000
    got = sorted((r.sample, r.sequence_index, r.l_linenumber) for r in out.collect())
    want = sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r))
    assert got == [(i, *r) for i, r in enumerate(want)]


def test_starts_of_shards_are_not_joined(spark):
    """Starts mark records as rows between them, so a growing table of them is not broadcast through the driver."""
    df = spark.range(300).selectExpr("id % 3 AS ds", "id AS k", "cast(id * 37 % 90 + 10 AS bigint) AS body")
    out = greedy_shards(df, keys=["ds"], order=["k"], body="body", max_bytes=1000)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Join .*_pos#\d+L? = _pos#", plan)
    assert out.columns == ["ds", "k", "body", "shard"] and dict(out.dtypes)["shard"] == "bigint" and out.count() == 300


def test_a_last_shard_may_hold_a_whole_group(spark):
    """The last shard of a dataset begins in one group of buckets and takes all records of the next, the last."""
    df = spark.range(300).selectExpr("id % 3 AS ds", "id AS k", "cast(id * 37 % 90 + 10 AS bigint) AS body")
    out = greedy_shards(df, keys=["ds"], order=["k"], body="body", max_bytes=1000, rows_per_task=20).collect()
    for ds in range(3):
        rows = sorted((r.k, r.body, {}) for r in out if r.ds == ds)
        assert len(rows) == 100 and {r.k: r.shard for r in out if r.ds == ds} == fold(rows, 850)
