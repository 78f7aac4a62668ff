"""Contract checks.  Each returns a violations frame (rule, key, detail); valid means no rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.plans.ordered import Ordered
from strideframe.plans.ranges import containing_counts

# Fixed identifier patterns.
SHA256 = r"^[0-9a-f]{64}$"
UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
IDENTIFIER = r"^[A-Za-z0-9][A-Za-z0-9._-]*$"
CODE = r"^[a-z][a-z0-9_]*$"
KIND_RANK = {"activity": 0, "onset": 1, "impact": 2, "exclude": 3}
RISK_WORDS = ["fall", "stumble", "trip", "collapse"]
RECEIPT_STATES = ("size_mismatch", "hash_mismatch", "verified", "unreceipted_final", "partial", "missing")


def violation(rule, key: Column, detail: Column):
    rule = F.lit(rule) if isinstance(rule, str) else rule
    return [rule.alias("rule"), key.cast("string").alias("key"), detail.cast("string").alias("detail")]


def record_rules(df: DataFrame, key: Column, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One pass over the rows; every rule is (condition that must hold, detail)."""
    broken = {name: ~F.coalesce(ok, F.lit(False)) for name, (ok, _) in rules.items()}
    # Most rows are clean: drop them with one boolean before any list is built.
    dirty = df.where(reduce(lambda x, y: x | y, broken.values()))
    notes = F.array(*[F.struct(F.when(broken[name], name).alias("rule"), F.coalesce(detail.cast("string"), F.lit("")).alias("detail"))
                      for name, (_, detail) in rules.items()])
    return (dirty.select(key.cast("string").alias("key"), F.explode(notes).alias("_v"))
            .select("_v.rule", "key", "_v.detail").where(F.col("rule").isNotNull()))


def implies(condition: Column, requirement: Column) -> Column:
    return ~F.coalesce(condition, F.lit(False)) | F.coalesce(requirement, F.lit(False))


def filled(c: Column) -> Column:
    """Empty text counts as missing."""
    return F.coalesce(F.length(c), F.lit(0)) > 0


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


# --- C01-C04 --------------------------------------------------------------------------

def select_frames(frames: DataFrame, selections: DataFrame, *, motion: str, frame: str) -> DataFrame:
    """Frames inside the half-open range of a selection bound to the same parent digest."""
    s = selections.select(F.col(motion), "start_frame", "stop_frame", "parent_sha256", "selection_id")
    return frames.join(s, motion).where(
        (F.col("motion_sha256") == F.col("parent_sha256")) & (F.col("start_frame") >= 0)
        & (F.col(frame) >= F.col("start_frame")) & (F.col(frame) < F.col("stop_frame")))


def wanted_members(df: DataFrame, *, member: str, suffixes: list[str], adapter_suffix: str) -> DataFrame:
    """Members with a wanted suffix, marked by whether the adapter reads them."""
    wanted = F.lit(False)
    for s in suffixes:
        wanted = wanted | F.col(member).endswith(s)
    return df.where(wanted).withColumn("adapter_match", F.col(member).endswith(adapter_suffix))


def source_disposition(df: DataFrame, *, source: str, known: list[str], paused: list[str]) -> DataFrame:
    """Each row runs, is paused, or belongs to an unknown source."""
    return df.withColumn("disposition", F.when(~F.col(source).isin(known), "unknown")
                         .when(F.col(source).isin(paused), "paused").otherwise("run"))


def labels_of_kind(labels: Column, kind: str) -> Column:
    """Labels of one kind that carry a code."""
    return F.filter(labels, lambda x: (x["kind"] == kind) & (F.coalesce(F.length(x["code"]), F.lit(0)) > 0))


# --- C05, C06, C07, C08 --------------------------------------------------------------------

def schema_conformance(df: DataFrame, expected: T.StructType, shapes: dict[str, int], key: Column) -> DataFrame:
    """Names, order and types against a closed schema, then array lengths and nulls row by row."""
    actual = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    wanted = [(f.name, f.dataType.simpleString()) for f in expected.fields]
    notes = []
    for i in range(max(len(actual), len(wanted))):
        a = actual[i] if i < len(actual) else ("", "")
        w = wanted[i] if i < len(wanted) else ("", "")
        if a[0] != w[0]:
            notes.append(("field", w[0] or a[0], a[0]))
        elif a[1] != w[1]:
            notes.append(("type", w[0], a[1]))
    schema_rows = df.sparkSession.createDataFrame(notes, "rule string, key string, detail string")
    rules = {}
    for f in expected.fields:
        if f.name not in df.columns:
            continue
        if not f.nullable:
            rules[f"null:{f.name}"] = (F.col(f.name).isNotNull(), F.lit(f.name))
    for name, size in shapes.items():
        rules[f"shape:{name}"] = (F.size(name) == size, F.size(name))
    return schema_rows.unionByName(record_rules(df, key, rules)) if rules else schema_rows


def nonfinite_arrays(df: DataFrame, *, key: str, array: str) -> DataFrame:
    bad = F.filter(array, lambda x: ~finite(x.cast("double")))
    return df.where(F.size(bad) > 0).select(*violation("nonfinite", F.col(key), F.size(bad)))


def unit_norm(df: DataFrame, *, key: str, array: str, tolerance: float) -> DataFrame:
    norm = F.sqrt(F.aggregate(array, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    off = F.abs(norm - 1)
    return df.where(~F.coalesce(off <= tolerance, F.lit(False))).select(
        *violation("norm", F.col(key), F.round(norm, 6).cast("decimal(18,6)")))


def is_relative_path(c: Column) -> Column:
    """Canonical logical path: no root, parent or current parts, drive, backslash or double slash."""
    return (filled(c) & ~c.rlike(r"[\\:\x00]") & ~c.startswith("/") & ~c.endswith("/")
            & ~c.contains("//") & ~c.rlike(r"(^|/)\.{1,2}(/|$)"))


def is_object_key(c: Column) -> Column:
    return filled(c) & ~c.startswith("/") & ~c.rlike(r"(^|/)\.\.(/|$)")


# --- C10 ------------------------------------------------------------------------------------

def duplicates(df: DataFrame, keys: list[str], rule: str = "duplicate") -> DataFrame:
    n = df.groupBy(*keys).count().where("count > 1")
    return n.select(*violation(rule, F.concat_ws("/", *keys), F.col("count")))


# --- C12 -----------------------------------------------------------------------------------

def utc_timestamps(df: DataFrame, *, key: str, text: str) -> DataFrame:
    c = F.col(text)
    ok = F.try_to_timestamp(c).isNotNull() & c.rlike(r"(Z|\+00:00)$")
    return df.where(~F.coalesce(ok, F.lit(False))).select(*violation("not-utc", F.col(key), c))


# --- C15, C16, C17, C18 ----------------------------------------------------------------------

def sequence_contiguity(df: DataFrame, *, index: str, start: str, stop: str, rows: DataFrame) -> DataFrame:
    """First start 0, each start equals the previous stop, length >= 2, last stop = row count.

    `rows` is a one-row frame with column `rows`.
    """
    o = Ordered(df, [], [index]).neighbours(prev={"_before": stop}).done()
    chain = record_rules(o, F.col(index), {
        "noncontiguous": (F.col(start) == F.coalesce(F.col("_before"), F.lit(0)), F.col(start)),
        "too-short": (F.col(stop) - F.col(start) >= 2, F.col(stop) - F.col(start))})
    last = df.agg(F.max_by(stop, index).alias("_last"))
    cover = last.withColumn("_one", F.lit(1)).join(rows.withColumn("_one", F.lit(1)), "_one").where(
        "_last <> rows").select(
        *violation("incomplete-cover", F.lit("samples"), F.col("_last")))
    return chain.unionByName(cover)


def kind_rank(c: Column) -> Column:
    rank = F.lit(None).cast("int")
    for k, v in KIND_RANK.items():
        rank = F.when(c == k, v).otherwise(rank)
    return rank


def annotation_order(df: DataFrame, *, file_order: str) -> DataFrame:
    """Rows that sort before the row above them by (sequence, start, kind, stop, code)."""
    keyed = df.withColumn("_k", F.struct("sequence_index", "start_sample",
                                         kind_rank(F.col("kind")).alias("rank"), "stop_sample", "code"))
    o = Ordered(keyed, [], [file_order]).neighbours(prev={"_above": "_k"}).done()
    return o.where(F.col("_above") > F.col("_k")).select(
        *violation("annotation-order", F.col(file_order), F.col("sequence_index")))


def interval_cover(annotations: DataFrame, sequences: DataFrame) -> DataFrame:
    """Activity and exclude intervals must tile [0, length) of their sequence."""
    rows = annotations.where(F.col("kind").isin("activity", "exclude"))
    o = Ordered(rows, ["sequence_index"], ["start_sample", "stop_sample"]).neighbours(
        prev={"_cursor": "stop_sample"}).done()
    gaps = o.where(F.col("start_sample") != F.coalesce(F.col("_cursor"), F.lit(0))).select(
        *violation("coverage-gap-overlap", F.col("sequence_index"), F.col("start_sample")))
    ends = rows.groupBy("sequence_index").agg(
        F.max(F.struct("start_sample", "stop_sample"))["stop_sample"].alias("_end"))
    short = sequences.join(ends, "sequence_index", "left").where(
        F.coalesce(F.col("_end"), F.lit(0)) != F.col("length")).select(
        *violation("incomplete-cover", F.col("sequence_index"), F.coalesce(F.col("_end"), F.lit(0))))
    return gaps.unionByName(short)


def event_pairing(annotations: DataFrame, sequences: DataFrame) -> DataFrame:
    """Onsets match one activity, which holds exactly one impact; no impact is left over."""
    ids = ["sequence_index", "code"]
    act = annotations.where("kind = 'activity'").select(*ids, "start_sample", "stop_sample")
    onset = annotations.where("kind = 'onset'").select(*ids, "start_sample")
    impact = annotations.where("kind = 'impact'").select(*ids, F.col("start_sample").alias("at"))
    place = F.concat_ws("/", "sequence_index", "code", "start_sample")

    per_start = act.groupBy(*ids, "start_sample").agg(
        F.count(F.lit(1)).alias("n"), F.max("stop_sample").alias("stop_sample"))
    onsets = onset.groupBy(*ids, "start_sample").agg(F.count(F.lit(1)).alias("n_onset"))
    matched = onsets.join(per_start, [*ids, "start_sample"], "left")
    unmatched = matched.where((F.coalesce(F.col("n"), F.lit(0)) != 1) | (F.col("n_onset") != 1)).select(
        *violation("onset-activity", place, F.coalesce(F.col("n"), F.lit(0))))
    falls = matched.where((F.col("n") == 1) & (F.col("n_onset") == 1)).select(*ids, "start_sample", "stop_sample")

    # Impacts inside a fall: points before its stop minus points up to its start.
    blank = F.lit(None).cast("bigint")
    points = impact.select(*ids, F.col("at").alias("_at"), F.lit(1).alias("_step"), F.lit(1).alias("_d"), blank.alias("start_sample"))
    opens = falls.select(*ids, F.col("start_sample").alias("_at"), F.lit(2).alias("_step"), F.lit(0).alias("_d"), F.col("start_sample"))
    closes = falls.select(*ids, F.col("stop_sample").alias("_at"), F.lit(0).alias("_step"), F.lit(0).alias("_d"), F.col("start_sample"))
    swept = Ordered(points.unionByName(opens).unionByName(closes), ids, ["_at", "_step"]).running(
        {"_seen": F.col("_d")}).done().where("_step <> 1")
    inside = swept.groupBy(*ids, "start_sample").agg(
        (F.max(F.when(F.col("_step") == 0, F.col("_seen"))) - F.max(F.when(F.col("_step") == 2, F.col("_seen")))).alias("n"))
    wrong = inside.where("n <> 1").select(*violation("impact-in-fall", place, F.col("n")))

    counted = containing_counts(impact, falls, ids, point="at", start="start_sample", stop="stop_sample")
    orphan = counted.where("n_containing <> 1").select(
        *violation("orphan-impact", F.concat_ws("/", *ids, "at"), F.col("n_containing")))

    has = onset.select("sequence_index").distinct().withColumn("_has", F.lit(True))
    flags = sequences.join(has, "sequence_index", "left").where(
        F.col("is_fall") != F.coalesce(F.col("_has"), F.lit(False))).select(
        *violation("fall-flag", F.col("sequence_index"), F.col("is_fall")))
    return unmatched.unionByName(wrong).unionByName(orphan).unionByName(flags)


# --- C19, C20, C21 ------------------------------------------------------------------------------

def taxonomy_lookup(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalog entry by (taxonomy, version, code); missing entries keep their row."""
    c = catalog.select("taxonomy_id", "taxonomy_version", "code",
                       F.col("is_fall").alias("code_is_fall"), F.lit(True).alias("resolved"))
    return rows.join(c, ["taxonomy_id", "taxonomy_version", "code"], "left").withColumn(
        "resolved", F.coalesce(F.col("resolved"), F.lit(False)))


def taxonomy_rules(sequences: DataFrame, catalog: DataFrame, *, key: str) -> DataFrame:
    """Codes resolve; fall events use fall codes; a recording label agrees with its flag."""
    rows = taxonomy_lookup(sequences, catalog)
    event = F.col("kind").isin("onset", "impact")
    return record_rules(rows, F.col(key), {
        "unresolved-code": (F.col("resolved"), F.col("code")),
        "fall-kind": (implies(event & F.col("resolved"), F.col("code_is_fall")), F.col("kind")),
        "recording-flag": (implies(F.col("resolved") & (F.col("kind") == "recording"),
                                   F.col("code_is_fall") == F.col("is_fall")), F.col("code"))})


def sparse_index(index: DataFrame, payload: DataFrame, *, key: str, limit: int) -> DataFrame:
    """Index keys: unique, in range and equal to the payload keys."""
    counts = index.groupBy(key).count()
    out = record_rules(counts, F.col(key), {
        "duplicate-index": (F.col("count") == 1, F.col("count")),
        "index-range": (F.col(key).between(0, limit - 1), F.col(key))})
    p = payload.select(key).distinct().withColumn("_p", F.lit(True))
    both = counts.join(p, key, "full_outer")
    miss = both.where(F.col("_p").isNull() | F.col("count").isNull()).select(
        *violation(F.when(F.col("_p").isNull(), "payload-missing").otherwise("payload-extra"),
                   F.col(key), F.lit("")))
    return out.unionByName(miss)


def overlapping_ranges(df: DataFrame, *, key: str, start: str, stop: str) -> DataFrame:
    o = Ordered(df, [], [start, stop, key]).neighbours(following={"_next": start}).done()
    return o.where(F.col("_next") < F.col(stop)).select(*violation("overlap", F.col(key), F.col("_next")))


# --- C23, C24 --------------------------------------------------------------------------------------

def provenance_rules(sequences: DataFrame, sources: DataFrame, *, key: str) -> DataFrame:
    """Every sequence has a source row; synthetic rows are training-only and carry group keys."""
    rows = sequences.join(sources.withColumn("_s", F.lit(True)), key, "left")
    synthetic = F.col("source_kind") == "synthetic"
    return record_rules(rows, F.col(key), {
        "provenance-missing": (F.col("_s").isNotNull(), F.lit("")),
        "synthetic-leakage": (implies(synthetic, F.col("evaluation_role") == "training_only"), F.col("evaluation_role")),
        "group-keys": (implies(synthetic, F.size("group_keys") > 0), F.lit("0"))})


def snapshot_rules(included: DataFrame, excluded: DataFrame, shards: DataFrame, *, key: str,
                   prefix: str, max_bytes: int) -> DataFrame:
    """Included and excluded ids are disjoint; shards keep the prefix and the size bound."""
    both = included.select(key).intersect(excluded.select(key)).select(
        *violation("included-and-excluded", F.col(key), F.lit("")))
    return both.unionByName(record_rules(shards, F.col("object_key"), {
        "shard-size": (F.col("byte_length").between(1, max_bytes), F.col("byte_length")),
        "shard-prefix": (F.col("object_key").startswith(prefix), F.lit(prefix)),
        "shard-digest": (F.col("sha256").rlike(SHA256), F.lit(""))}))


# --- C25, C26 ----------------------------------------------------------------------------------------

def rule_set(rules: DataFrame) -> DataFrame:
    """Weak-label rules: lower-case values, sorted category sets, no fall target, unique identity."""
    v, origin = F.col("source_value"), F.col("origin")
    catset = F.split(F.regexp_extract(v, r"^catset:([^;]*)", 1), r"\|")
    temporal = F.split(F.regexp_extract(v, r";temporal:(.*)$", 1), r"\|")
    proper = lambda a: (F.sort_array(F.array_distinct(a)) == a) & ~F.array_contains(a, "")
    is_set = (origin == "babel-1.0") & v.startswith("catset:")
    out = record_rules(rules, F.col("rule_id"), {
        "rule-id": (filled(F.col("rule_id")), F.lit("")),
        "origin": (origin.isin("babel-1.0", "stageii-source-member")
                   | ((origin == "source-member-token") & (F.col("revision") >= 2)), origin),
        "value": (filled(v) & (v == F.lower(F.trim(v))), v),
        "target": (F.col("target_code").rlike(CODE) & ~F.col("is_fall"), F.col("target_code")),
        "token": (implies(origin == "source-member-token",
                          v.rlike("^[a-z]+$") & F.col("source_dataset").isNotNull()), v),
        "category-set": (implies(is_set, proper(catset) & (~v.contains(";temporal:") | proper(temporal))), v),
        "code-value": (implies((origin == "babel-1.0") & v.startswith("code:"), F.length(v) > 5), v)})
    blank = rules.withColumn("source_dataset", F.coalesce("source_dataset", F.lit("*")))
    return (out.unionByName(duplicates(rules, ["rule_id"], "duplicate-id"))
               .unionByName(duplicates(blank, ["origin", "source_value", "source_dataset"], "duplicate-identity")))


def preset_rules(families: DataFrame) -> DataFrame:
    """Preset families (code, aliases, modifiers): safe codes, aliases in one family only."""
    code = F.col("code")
    risky = F.lit(False)
    for w in RISK_WORDS:
        risky = risky | code.contains(w)
    out = record_rules(families, code, {
        "code": (code.rlike(CODE) & ~risky, code),
        "aliases": ((F.size("aliases") > 0) & (F.size(F.array_distinct("aliases")) == F.size("aliases")), code),
        "own-modifier": (~F.arrays_overlap("aliases", "modifiers"), code)})
    alias = families.select("code", F.explode(F.array_distinct("aliases")).alias("alias"))
    return out.unionByName(duplicates(alias, ["alias"], "alias-overlap")).unionByName(
        duplicates(families, ["code"], "duplicate-code"))


# --- C27, C28, C29, C30, C31 ---------------------------------------------------------------------------

def lineage_closure(references: DataFrame, objects: DataFrame, *, digest: str) -> DataFrame:
    """References resolve with the right role; every object is referenced."""
    r = references.select(digest, F.col("role").alias("_want")).distinct()
    both = r.join(objects.select(digest, "role"), digest, "full_outer")
    rule = (F.when(F.col("role").isNull(), "unresolved-reference")
            .when(F.col("_want").isNull(), "unreferenced-object")
            .when(F.col("role") != F.col("_want"), "object-role"))
    return both.where(rule.isNotNull()).select(*violation(rule, F.col(digest), F.coalesce("_want", F.lit(""))))


def receipt_states(manifest: DataFrame, listing: DataFrame, receipts: DataFrame, *, key: str) -> DataFrame:
    """State of every expected file from the listing and its receipt."""
    seen = listing.select(key, F.col("bytes").alias("_bytes"), F.col("sha256").alias("_sha"), F.col("is_partial"))
    paper = receipts.select(key, F.lit(True).alias("_receipt"), F.col("bytes").alias("_rb"), F.col("sha256").alias("_rs"))
    rows = manifest.join(seen, key, "left").join(paper, key, "left")
    final = F.col("_bytes").isNotNull() & ~F.col("is_partial")
    size_ok = F.col("_bytes") == F.coalesce("bytes", "_rb")
    hash_ok = F.col("_sha") == F.coalesce("sha256", "_rs")
    state = (F.when(final & F.col("_receipt").isNotNull(),
                    F.when(~size_ok, "size_mismatch").when(~hash_ok, "hash_mismatch").otherwise("verified"))
             .when(final, "unreceipted_final").when(F.col("is_partial"), "partial").otherwise("missing"))
    return rows.select(key, state.alias("state"))


def state_histogram(receipts: DataFrame, *, state: str = "state") -> DataFrame:
    """Files per receipt state."""
    return receipts.groupBy(state).agg(F.count(F.lit(1)).alias("files"))


def quality_flags(flags: DataFrame, *, key: str, joints: list[str]) -> DataFrame:
    """Advisory flags: fixed code, scope and disposition, range inside the reviewed range, known joints."""
    out = record_rules(flags, F.col(key), {
        "flag-code": (F.col("code") == "source-fit-temporal-discontinuity", F.col("code")),
        "flag-disposition": (F.col("disposition") == "advisory", F.col("disposition")),
        "flag-range": ((F.col("reviewed_start") <= F.col("range_start")) & (F.col("range_start") < F.col("range_stop"))
                       & (F.col("range_stop") <= F.col("reviewed_stop")), F.col("range_start")),
        "flag-joints": ((F.size("joints") > 0) & (F.size(F.array_except("joints", F.array(*map(F.lit, joints)))) == 0),
                        F.array_join("joints", ","))})
    return out.unionByName(duplicates(flags, ["clip_id", "code", "range_start", "range_stop"], "flag-duplicate"))


def checkpoint_chain(checkpoints: DataFrame, entries: DataFrame) -> DataFrame:
    """Shard ordinals from 1 without gap, starts follow stops, frozen entries of the range agree.

    Entries are compared as (first, last, count) per shard, so no list is collected.
    """
    o = (Ordered(checkpoints, [], ["ordinal"]).neighbours(prev={"_stop": "stop_ordinal"})
         .position("_pos").done())
    chain = record_rules(o, F.col("ordinal"), {
        "ordinal": (F.col("ordinal") == F.col("_pos") + 1, F.col("ordinal")),
        "start": (F.col("start_ordinal") == F.coalesce(F.col("_stop"), F.lit(0)) + 1, F.col("start_ordinal")),
        "range": (F.col("stop_ordinal") >= F.col("start_ordinal"), F.col("stop_ordinal"))})
    span = entries.groupBy("shard").agg(
        F.min("entry").alias("_lo"), F.max("entry").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    diff = checkpoints.join(span, checkpoints.ordinal == span.shard, "left").where(
        ~((F.col("_lo") == F.col("start_ordinal")) & (F.col("_hi") == F.col("stop_ordinal"))
          & (F.col("_n") == F.col("stop_ordinal") - F.col("start_ordinal") + 1))
        | F.col("_n").isNull()).select(*violation("entries", F.col("ordinal"), F.coalesce("_n", F.lit(0))))
    return chain.unionByName(diff)


def accepted_gate(latest: DataFrame, *, key: str) -> DataFrame:
    """Latest revision is accepted with reviewer and reason, QA passed and one distinct label code."""
    codes = F.array_distinct(F.filter(F.col("codes"), lambda c: F.length(c) > 0))
    return record_rules(latest, F.col(key), {
        "not-accepted": (F.col("decision") == "accepted", F.col("decision")),
        "qa-not-passed": (F.col("qa_passed"), F.lit("")),
        "reviewer": (filled(F.col("reviewer")), F.lit("")),
        "reason": (filled(F.col("reason")), F.lit("")),
        "single-label": (F.size(codes) == 1, F.size(codes))})
