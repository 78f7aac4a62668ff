"""Joins of plans, objects, commits, skeletons and dependencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideframe.functions import rotations as R
from strideframe.functions.arrays import present
from strideframe.plans.barrier import evaluate_once
from strideframe.session import materialise


def object_descriptors(candidates: DataFrame, objects: DataFrame, *, key: str) -> DataFrame:
    """Candidate objects (role -> digest map) with their descriptor.

    Digests are shuffled and sorted as bytes, half as long as their hexadecimal text.
    """
    refs = candidates.select(key, F.explode("objects").alias("role", "sha256"))
    packed = lambda df: df.withColumn("_sha", _packed(F.col("sha256"))).drop("sha256")
    rows = packed(refs).join(packed(objects), "_sha")
    return rows.select(_unpacked(F.col("_sha")).alias("sha256"), *[c for c in rows.columns if c != "_sha"])


def _packed(text: Column) -> Column:
    """Lower-case hexadecimal text as a byte 1 and its bytes, any other text as a byte 0 and itself."""
    raw = F.unhex(text)
    return F.when(F.lower(F.hex(raw)) == text, F.concat(F.unhex(F.lit("01")), raw)).otherwise(
        F.concat(F.unhex(F.lit("00")), text.cast("binary")))


def _unpacked(packed: Column) -> Column:
    body = F.substring(packed, 2, 2 ** 31 - 1)
    return F.when(F.substring(packed, 1, 1) == F.unhex(F.lit("01")), F.lower(F.hex(body))).otherwise(body.cast("string"))


def plan_with_report(plan: DataFrame, reports: DataFrame, *, key: str) -> DataFrame:
    """Every planned clip; a missing report becomes a reason."""
    r = reports.withColumn("_r", F.lit(True))
    out = plan.join(r, key, "left")
    return out.withColumn("lineage_reasons", F.when(F.col("_r").isNull(), F.array(F.lit("clip-report-missing")))
                          .otherwise(F.array().cast("array<string>"))).drop("_r")


def path_aliases(member: Column, dataset: Column) -> Column:
    """Bounded spellings of a member path, in order of preference."""
    parts = F.split(member, "/")
    first, rest = F.get(parts, F.lit(0)), F.array_join(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), "/")
    many = F.size(parts) > 1
    return F.array_distinct(F.array_compact(F.array(
        member,
        F.when(dataset.isNotNull(), F.concat(dataset, F.lit("/"), member)),
        F.when(dataset.isNotNull() & (first == dataset) & many, rest),
        F.when(many, F.concat(first, F.lit("/"), member)),
        F.when(many & (first == F.get(parts, F.lit(1))), rest))))


def alias_join(probes: DataFrame, index: DataFrame, *, key: str, member: str, dataset: str,
               name: str, identity: str) -> DataFrame:
    """First alias that is in the index; several identities are marked ambiguous."""
    spelled = probes.select(key, F.posexplode(path_aliases(F.col(member), F.col(dataset))).alias("_pos", name))
    hits = spelled.join(index.select(name, identity), name).groupBy(key).agg(
        F.min_by(identity, "_pos").alias(identity),
        (F.min(identity) != F.max(identity)).alias("ambiguous"))
    return probes.join(hits, key, "left")


def prefix_join(records: DataFrame, motions: DataFrame, *, feature: str, prefix: str, path: str) -> DataFrame:
    """Match records under a doubled root prefix; misses stay with a null difference."""
    doubled = F.col(feature).startswith(prefix + prefix)
    keyed = records.where(doubled).withColumn(path, F.substr(F.col(feature), F.lit(len(prefix) + 1)))
    out = keyed.join(motions, path, "left")
    delta = F.abs(F.col("duration_s") - F.col("frames") / F.col("rate_hz"))
    return out.withColumns({"duration_difference_s": delta, "matched": F.col("frames").isNotNull()})


def sequence_annotations(annotations: DataFrame, sequences: DataFrame, *, sequence: str, zero: str) -> DataFrame:
    """Annotations made local to their sequence and numbered in canonical order.

    `sequences` has one row a sequence with the sample that counts as zero.
    """
    from strideframe.operators.checks import kind_rank
    from strideframe.plans.ordered import Ordered
    ranked = annotations.withColumn("rank", kind_rank(F.col("kind")))
    o = Ordered(ranked, [sequence], ["start_sample", "rank", "stop_sample", "code"]).position("ordinal").done()
    return o.join(sequences.select(sequence, F.col(zero).alias("_zero")), sequence).select(
        sequence, "kind", (F.col("start_sample") - F.col("_zero")).alias("start_sample"),
        (F.col("stop_sample") - F.col("_zero")).alias("stop_sample"), "code", "ordinal")


def envelope(rows: DataFrame, record_rows: DataFrame, *, record: str, time: str, zero: str,
             length: str, period: int) -> DataFrame:
    """Sample range [zero, zero + (length-1) * period] inside the record's time range."""
    span = record_rows.groupBy(record).agg(F.min(time).alias("_t0"), F.max(time).alias("_t1"))
    end = F.col(zero) + (F.col(length) - 1) * period
    return rows.join(span, record).withColumn(
        "enveloped", F.col(zero).between(F.col("_t0"), F.col("_t1")) & (end <= F.col("_t1"))).drop("_t0", "_t1")


def requested(requests: DataFrame, existing: DataFrame, *, key: str) -> DataFrame:
    """Requested ids with `found` or `missing`."""
    have = existing.select(key).distinct()
    r = requests.select(key).distinct()
    return (r.join(have, key, "left_semi").withColumn("status", F.lit("found"))
            .unionByName(r.join(have, key, "left_anti").withColumn("status", F.lit("missing"))))


def pending(requests: DataFrame, completed: DataFrame, failed: DataFrame, *, key: str) -> DataFrame:
    """Requests without a result and without a failure."""
    return (requests.join(completed.select(key), key, "left_anti")
            .join(failed.select(key), key, "left_anti"))


def lineage_join(motion: DataFrame, sensors: DataFrame, selection: DataFrame, review: DataFrame,
                 *, key: str) -> DataFrame:
    """Artifacts of one clip that agree on their ids; every mismatch is named."""
    joined = (motion.join(sensors, key, "left").join(selection, key, "left").join(review, key, "left"))
    eq = lambda a, b: F.col(a).eqNullSafe(F.col(b)) & F.col(a).isNotNull()
    reasons = present(
        F.when(~eq("motion_id", "sensor_motion_id"), "sensor-motion"),
        F.when(~eq("motion_id", "selection_motion_id"), "selection-motion"),
        F.when(~eq("selection_id", "sensor_selection_id"), "sensor-selection"),
        F.when(~eq("sensor_id", "review_sensor_id"), "review-sensor"),
        F.when(~eq("layout_id", "review_layout_id"), "layout"))
    return joined.withColumn("lineage_reasons", reasons)


def reconcile_keys(ledger: DataFrame, listed: DataFrame, *, key: str) -> DataFrame:
    """One row per key that is on one side only, `missing` or `extra`."""
    a = ledger.select(key).distinct().withColumn("_a", F.lit(True))
    b = listed.select(key).distinct().withColumn("_b", F.lit(True))
    both = a.join(b, key, "full_outer")
    return both.where(F.col("_a").isNull() | F.col("_b").isNull()).select(
        key, F.when(F.col("_b").isNull(), "missing").otherwise("extra").alias("state"))


def reference_audit(commits: DataFrame, listing: DataFrame, feed: DataFrame) -> DataFrame:
    """Artifacts of commits against the listing, and feed digests against commits."""
    art = commits.select("commit_key", F.explode("artifacts").alias("a")).select("commit_key", "a.*")
    seen = listing.select("key", F.col("size").alias("_size"), F.col("sha256").alias("_sha"))
    a = art.join(seen, "key", "left")
    reason = (F.when(F.col("_size").isNull(), "artifact-missing")
              .when(F.col("_size") != F.col("byte_length"), "artifact-size")
              .when(F.col("_sha") != F.col("sha256"), "artifact-digest"))
    bad = a.where(reason.isNotNull()).select(reason.alias("rule"), F.col("commit_key").alias("key"), F.col("key").alias("detail"))
    f = feed.join(commits.select("commit_key", F.col("commit_sha256").alias("_c")), "commit_key", "left")
    off = f.where(~F.col("commit_sha256").eqNullSafe(F.col("_c"))).select(
        F.lit("feed-digest").alias("rule"), F.col("commit_key").alias("key"), F.col("feed_key").alias("detail"))
    return bad.unionByName(off)


def map_joints(rows: DataFrame, mapping: DataFrame, *, joint: str) -> DataFrame:
    """Source joint names to target names; unmapped names are kept with `mapped` false."""
    m = mapping.select(F.col("source_joint").alias(joint), "target_joint")
    return rows.join(m, joint, "left").withColumn("mapped", F.col("target_joint").isNotNull())


# Fixed device placement: (dominant hand, focus or any, device, joint index).
DEVICE_JOINTS = [
    ("right", None, "wrist", 19), ("right", None, "pocket", 0), ("right", None, "ear", 15),
    ("right", "Upper", "a1", 17), ("right", "Upper", "a2", 17), ("right", "Upper", "a3", 17),
    ("right", "Upper", "a4", 19), ("right", "Upper", "a5", 21),
    ("right", "Lower", "a1", 1), ("right", "Lower", "a2", 1), ("right", "Lower", "a3", 4),
    ("right", "Lower", "a4", 4), ("right", "Lower", "a5", 7),
    ("right", "Torso", "a1", 12), ("right", "Torso", "a2", 9), ("right", "Torso", "a3", 6),
    ("right", "Torso", "a4", 3), ("right", "Torso", "a5", 0),
    ("left", None, "wrist", 18), ("left", None, "pocket", 0), ("left", None, "ear", 15),
    ("left", "Upper", "a1", 16), ("left", "Upper", "a2", 16), ("left", "Upper", "a3", 16),
    ("left", "Upper", "a4", 18), ("left", "Upper", "a5", 20),
    ("left", "Lower", "a1", 2), ("left", "Lower", "a2", 2), ("left", "Lower", "a3", 5),
    ("left", "Lower", "a4", 5), ("left", "Lower", "a5", 8),
    ("left", "Torso", "a1", 12), ("left", "Torso", "a2", 9), ("left", "Torso", "a3", 6),
    ("left", "Torso", "a4", 3), ("left", "Torso", "a5", 0),
]


def device_joint(rows: DataFrame, devices: DataFrame) -> DataFrame:
    """Joint of a device by dominant hand and, for the numbered devices, focus."""
    d = devices.select("dominant", F.coalesce("focus", F.lit("*")).alias("_focus"), "device", "joint")
    fixed = F.col("device").isin("wrist", "pocket", "ear")
    r = rows.withColumn("_focus", F.when(fixed, "*").otherwise(F.col("focus")))
    return r.join(d, ["dominant", "_focus", "device"], "left").drop("_focus")


def world_transforms(frames: DataFrame, parents: list[int], *, rotations: str, offsets: str) -> DataFrame:
    """World rotation and position of every joint of a frame, parents first.

    A frame holds a fixed number of joints, so the tree is walked level by level inside
    the row and no rows move; a joint only reads the finished transform of its parent.
    """
    depth = []
    for j, p in enumerate(parents):
        if p >= j:
            raise ValueError("a parent must come before its child")
        depth.append(0 if p < 0 else depth[p] + 1)
    keep = frames.columns
    quat = lambda q, v: F.struct(*[c.alias(f"q{n}") for c, n in zip(q, "wxyz")], *[c.alias(f"p{n}") for c, n in zip(v, "xyz")])
    df = evaluate_once(frames.select("*", *[
        quat(R.unit(R.parts(F.get(rotations, F.lit(j)), 0, 4)), R.parts(F.get(offsets, F.lit(j)), 0, 3)).alias(f"_w{j}")
        for j in range(len(parents))]), *keep)
    fields = lambda j: ([F.col(f"_w{j}.q{n}") for n in "wxyz"], [F.col(f"_w{j}.p{n}") for n in "xyz"])
    for level in range(1, max(depth) + 1):
        new = {}
        for j, p in enumerate(parents):
            if depth[j] == level:
                (q, off), (up, at) = fields(j), fields(p)
                new[f"_w{j}"] = quat(R.multiply(up, q), [a + t for a, t in zip(at, R.rotate_by_unit(up, off))])
        df = evaluate_once(df.withColumns(new), *keep)
    names = [f"_w{j}" for j in range(len(parents))]
    return df.withColumn("world", F.array(*names)).drop(*names)


def dependency_closure(edges: DataFrame, *, source: str, target: str, roots: DataFrame | None = None) -> DataFrame:
    """(source, target, steps) pairs reachable over dependency edges, from all sources or from the asked `roots` only.

    Each round joins the new frontier only and is written out, so lineage stays short;
    the number of rounds is the depth of the graph.  A node that reaches itself is on a cycle.

    From all sources, a pair can only have been found before if its walk has passed a node of several edges, or ends on a cycle. Only
    such pairs are held against all that is known; where no walk branches, a round costs its frontier, not the closure so far.
    """
    e = edges.select(F.col(source).alias("a"), F.col(target).alias("b")).distinct()
    # An edge from a node to itself, and a walk on from its own start, lead to known pairs only.
    away = F.expr("not (a <=> b)")
    several = e.where(away).groupBy("a").count().where("count > 1").select("a", F.lit(True).alias("forks"))
    step = materialise(e.where(away).join(several, "a", "left").select(F.col("a").alias("b"), F.col("b").alias("c"), F.coalesce("forks", F.lit(False)).alias("forks")), "closure")
    asked = e if roots is None else e.join(roots.select(F.col(source).alias("a")).distinct(), "a", "left_semi")
    # From some roots only, the pairs that tell of cycles may be missing, so every pair is checked.
    first = asked.join(several, "a", "left").select("a", "b", F.lit(1).alias("steps"), (F.col("forks").isNotNull() | F.lit(roots is not None)).alias("forked"))
    frontier = materialise(first, "closure")
    looped = materialise(e.where("a = b").select("b").join(step.select("b"), "b", "left_semi"), "closure")
    steps, parts = 1, [frontier]
    while not frontier.isEmpty():
        steps += 1
        known = parts[0]
        for p in parts[1:]:
            known = known.unionByName(p)
        on = frontier.where(away).join(step, "b").select("a", F.col("c").alias("b"), (F.col("forked") | F.col("forks")).alias("forked"))
        cycles = known.where("a = b and steps > 1").select("b").union(looped).distinct().withColumn("_cycle", F.lit(True))
        on = materialise(on.join(cycles, "b", "left").withColumn("_check", F.col("forked") | F.col("_cycle").isNotNull()).drop("_cycle"), "closure")
        nxt, doubtful = on.where("not _check").drop("_check"), on.where("_check")
        if not doubtful.isEmpty():
            once = doubtful.groupBy("a", "b").agg(F.bool_or("forked").alias("forked"))
            nxt = nxt.unionByName(once.join(known.select("a", "b"), ["a", "b"], "left_anti"))
        frontier = materialise(nxt.select("a", "b", F.lit(steps).alias("steps"), "forked"), "closure")
        parts.append(frontier)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.col("a").alias(source), F.col("b").alias(target), "steps",
                      (F.col("a") == F.col("b")).alias("cycle"))


def observation_rows(observations: DataFrame, candidates: DataFrame, *, key: str, ids: str) -> DataFrame:
    """One row per observed id, marked known / unknown and duplicate."""
    rows = observations.select("observation", F.explode(ids).alias(key)).groupBy("observation", key).agg(
        F.count(F.lit(1)).alias("times"))
    have = candidates.select(key).distinct().withColumn("_k", F.lit(True))
    return rows.join(have, key, "left").select(
        "observation", key, F.col("_k").isNotNull().alias("known"), (F.col("times") > 1).alias("duplicate"))


def override_labels(base: DataFrame, overrides: DataFrame, *, key: str) -> DataFrame:
    """A later label record replaces the review's code when bound to the same commit."""
    o = overrides.select(key, F.col("code").alias("_code"), F.col("commit_sha256").alias("_sha"))
    rows = base.join(o, key, "left")
    bound = F.col("_sha").isNull() | (F.col("_sha") == F.col("commit_sha256"))
    codes = F.when(F.col("_code").isNotNull(), F.array("_code")).otherwise(F.col("codes"))
    single = (F.size(codes) == 1) & (F.coalesce(F.length(F.get(codes, F.lit(0))), F.lit(0)) > 0)
    state = F.when(~bound, "unbound").when(~single, "unresolved").otherwise("resolved")
    return rows.select(key, state.alias("state"),
                       F.when(state == "resolved", F.get(codes, F.lit(0))).alias("code"))


def sequence_rows(samples: DataFrame, sequences: DataFrame, *, start: int, stop: int) -> DataFrame:
    """Rows [start, stop) of each wanted sequence, relative to its first sample."""
    s = sequences.select("sequence_index", "sample_start", "sample_stop")
    at = F.col("sample") - F.col("sample_start")
    return samples.join(s, "sequence_index").where(
        (at >= start) & (at < stop) & (F.col("sample") < F.col("sample_stop"))).withColumn("row", at)
