"""Source and sink queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strideframe.bindings import derived
from strideframe.bindings.common import E, signal
from strideframe.bindings.corpus import _PACK, _packing_rows
from strideframe.bindings.corpus import packed as P_packed
from strideframe.bindings.joins import _SAMPLES, samples
from strideframe.bindings.labels import COMMITS, RULES, commits, decide, labelled, sql_rules
from strideframe.bindings.qa import _LI, LI_POLICY, document_clips, line_clips
from strideframe.bindings.registry import query
from strideframe.operators import checks as C
from strideframe.operators import corpus as P
from strideframe.operators import delivery as K
from strideframe.operators import metrics as M
from strideframe.plans.packing import greedy_shards
from strideframe.session import materialise, work_dir
from strideframe.sources import archives as A
from strideframe.sources import documents as D
from strideframe.sources.objects import ObjectStore
from strideframe.sources.tables import DRIVER, events, read

_MEM = """SELECT source || '/' || lang || '/doc' || doc_id || '.txt' AS member, CAST(strlen(text) AS BIGINT) AS size, sha256(text) AS sha256 FROM documents WHERE doc_id % 3 <> 0"""


@query("s01_tar_inventory", _MEM)
def s01(spark, d):
    out = A.inventory(spark, derived.archives(spark, d, "tar"), pattern="*.tar.gz", suffixes=[".txt"])
    return out.where("problem = ''").select("member", "size", "sha256")


@query("s02_zip_inventory", f"WITH m AS ({_MEM}) SELECT member, size, sha256, k AS key FROM m, LATERAL (SELECT unnest([regexp_extract(member, '[^/]*$'), regexp_extract(member, '[^/]*/[^/]*$')]) AS k)")
def s02(spark, d):
    out = A.inventory(spark, derived.archives(spark, d, "zip"), pattern="*.zip", suffixes=[".txt"])
    return A.suffix_index(out).join(out, ["archive", "member"]).select("member", "size", "sha256", "key")


_PROFILES = """
SELECT 'doc' || doc_id AS name, CAST(doc_id % 5 + 1 AS BIGINT) AS frames, CASE WHEN doc_id % 2 = 1 THEN 'male' ELSE 'female' END AS gender,
 CASE WHEN doc_id % 7 = 0 OR doc_id % 11 = 0 OR doc_id % 13 = 0 OR doc_id % 17 = 0 OR doc_id % 19 = 0 OR doc_id % 23 = 0 THEN 'adapter-required' WHEN doc_id % 5 = 0 THEN 'not-motion' ELSE 'ok' END AS state FROM documents"""


def _profiles(prof):
    out = A.classify_members(prof, adapter=F.lit(derived.NATIVE))
    return out.select(F.regexp_extract("member", r"(doc\d+)_poses", 1).alias("name"), "frames", "gender", "state")


@query("s03_member_profiles", _PROFILES)
def s03(spark, d):
    return _profiles(A.member_profiles(spark, derived.archives(spark, d, "npz"), pattern="*.tar.gz", suffixes=["_poses.npz"]))


@query("s03_profiles_by_range", _PROFILES)
def s03_range(spark, d):
    """The same of uncompressed archives, of which only directories and array heads are read."""
    return _profiles(A.member_profiles(spark, derived.archives(spark, d, "npz-tar"), pattern="*.tar", suffixes=["_poses.npz"]))


@query("x01_adapters", """
SELECT a.adapter, CASE WHEN a.adapter <> 'amass-smplh-g-v1' OR doc_id % 7 = 0 OR doc_id % 11 = 0 OR doc_id % 13 = 0 OR doc_id % 17 = 0 OR doc_id % 19 = 0 OR doc_id % 23 = 0 THEN 'adapter-required' WHEN doc_id % 5 = 0 THEN 'not-motion' ELSE 'ok' END AS state, count(*) AS members
FROM documents, (VALUES ('amass-smplh-g-v1'), ('stageii-smplh-v1'), ('none')) a(adapter) GROUP BY ALL""")
def x01(spark, d):
    """Members judged under every adapter of their source."""
    prof = A.member_profiles(spark, derived.archives(spark, d, "npz-tar"), pattern="*.tar", suffixes=["_poses.npz"])
    wide = prof.withColumn("adapter", F.explode(F.array(*[F.lit(a) for a in (*A.ADAPTERS, "none")])))
    return A.classify_members(wide, adapter=F.col("adapter")).groupBy("adapter", "state").agg(F.count("*").alias("members"))


@query("s04_motion_text", """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS frame FROM documents)
SELECT doc_id, CAST(frame AS INTEGER) AS frame, unnest([0, 1, 2]) AS "column", unnest([CAST(frame AS DOUBLE), CAST(length(t) AS DOUBLE), length(t) / 4.0]) AS value FROM l""")
def s04(spark, d):
    return D.motion_text(_motion_files(spark, d), key="doc_id", text="raw")


def _motion_files(spark, d):
    """Each document as a motion file: one frame per line, channels from the line."""
    lines = F.transform(F.split("text", "\n"), lambda t, i: F.concat_ws(
        " ", i.cast("string"), F.length(t).cast("string"), (F.length(t) / 4.0).cast("string")))
    head = "HIERARCHY\nROOT r\n{\nOFFSET 0 0 0\nCHANNELS 3 Xposition Yposition Zposition\n}\nMOTION\nFrames: "
    declared = F.size(lines) + F.when(F.col("doc_id") % 10 == 0, 1).otherwise(0)
    return read(spark, d, "documents").select("doc_id", F.concat(
        F.lit(head), declared.cast("string"), F.lit("\nFrame Time: 0.04\n"), F.array_join(lines, "\n")).alias("raw"))


@query("s04_motion_text_rules", """
SELECT 'frame-count' AS rule, CAST(doc_id AS VARCHAR) AS key, CAST(len(string_split(text, chr(10))) AS VARCHAR) AS detail FROM documents WHERE doc_id % 10 = 0""")
def s04_rules(spark, d):
    raw = _motion_files(spark, d)
    return D.motion_text_rules(raw, D.motion_text(raw, key="doc_id", text="raw"), key="doc_id", text="raw")


@query("s05_strict_json", """
SELECT event_id, CASE event_id % 6 WHEN 1 THEN 'duplicate-key' WHEN 2 THEN 'nonfinite' WHEN 3 THEN 'nonfinite' WHEN 4 THEN 'malformed' ELSE 'ok' END AS state,
 CASE WHEN event_id % 6 IN (0, 5) THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k FROM events""")
def s05(spark, d):
    m, p = F.col("event_id") % 6, F.col("props")
    text = (F.when(m == 1, F.lit('{"k": 1, "k": 2}')).when(m == 2, F.lit('{"k": NaN}')).when(m == 3, F.lit('{"k": 1e999}'))
            .when(m == 4, F.substring(p, 1, 5)).otherwise(p))
    out = D.strict_json(read(spark, d, "events").select("event_id", text.alias("t")), text="t", schema="k double", numbers=["k"])
    return out.select("event_id", "state", F.when(F.col("state") == "ok", F.col("record.k")).alias("k"))


@query("s06_document_directory", "SELECT doc_id, source FROM documents WHERE doc_id % 5 > 0")
def s06(spark, d):
    folder = work_dir(spark, "documents")
    docs = read(spark, d, "documents").select("doc_id", "source", F.when(F.col("doc_id") % 5 > 0, "commit.v1").otherwise("other").alias("schema"))
    docs.write.json(f"{folder}/commits")
    docs.write.json(f"{folder}/all.feed.json")
    found = D.document_directory(spark, folder, "doc_id bigint, source string, schema string", tag="schema", keep="commit.v1")
    return D.unique_documents(found, key="doc_id").select("doc_id", "source")


@query("s07_participant_csv", """
SELECT c_name AS participant, CASE c_mktsegment WHEN 'BUILDING' THEN 'right' WHEN 'MACHINERY' THEN 'left' ELSE lower(c_mktsegment) END AS dominant_hand,
 c_mktsegment IN ('BUILDING', 'MACHINERY') AS in_domain FROM customer""")
def s07(spark, d):
    folder = work_dir(spark, "participants")
    s = F.col("c_mktsegment")
    read(spark, d, "customer").select(
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("Participant "),
        F.when(s == "BUILDING", " Right").when(s == "MACHINERY", "LEFT ").otherwise(s).alias("Dominant_Hand")).write.option(
        "header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    return D.participant_csv(spark, folder, key="participant", domain_column="dominant_hand", domain=["left", "right"])


@query("s08_resumable_append", """
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'append' WHEN doc_id % 20 = 1 THEN 'conflict' ELSE 'skip' END AS action FROM documents""")
def s08(spark, d):
    i = F.col("doc_id")
    rows = read(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("inputs"))
    folder = work_dir(spark, "diagnostics")
    rows.where(i % 3 != 0).select("doc_id", F.when(i % 20 == 1, "x").otherwise(F.col("inputs")).alias("inputs")).write.json(folder)
    old = spark.read.schema("doc_id bigint, inputs string").json(folder)
    return D.resumable_append(old, rows, key="doc_id", inputs="inputs").select("doc_id", "action")


@query("s09_validated_read", "SELECT event_id, user_id, event_type, value FROM events")
def s09(spark, d):
    ev = events(spark, d).select("event_id", "user_id", "event_type", "value")
    bad = C.record_rules(ev, F.col("event_id"), {"finite": (C.finite(F.col("value")), F.col("value")), "id": (F.col("event_id").isNotNull(), F.lit(""))})
    return D.validated(ev, bad)


@query("s12_published_clips", """
SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey % 4 = 0""")
def s12(spark, d):
    o = read(spark, d, "orders")
    ledger = o.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "published").otherwise("failed").alias("status"),
                      F.sha2((F.col("o_custkey") % 4).cast("string"), 256).alias("config_sha256"))
    path = work_dir(spark, "ledger")
    ledger.write.parquet(path)
    import hashlib
    frozen = hashlib.sha256(b"0").hexdigest()
    return D.published_clips(spark.read.schema(ledger.schema).parquet(path), config_sha256=frozen).select("o_orderkey")


@query("s13_list_files", """
SELECT 'page' || page_id || '.' || ['html', 'json', 'bin', 'xyz'][page_id % 4 + 1] AS name, CAST(strlen(html) AS BIGINT) AS length FROM pages WHERE page_id % 4 <> 2""")
def s13(spark, d):
    """Files made from the pages, listed without their contents."""
    out = A.list_files(spark, derived.page_objects(spark, d), "*.{html,json,xyz}")
    return out.select(F.element_at(F.split("path", "/"), -1).alias("name"), "length")


@query("s14_verified_contents", """
SELECT page_id, CASE WHEN page_id % 9 = 0 THEN 'missing' WHEN page_id % 5 = 0 THEN 'size-mismatch' WHEN page_id % 7 = 0 THEN 'hash-mismatch' ELSE 'verified' END AS state FROM pages""")
def s14(spark, d):
    i = F.col("page_id")
    ext = F.get(F.array(*map(F.lit, ["html", "json", "bin", "xyz"])), (i % 4).cast("int"))
    name = F.concat(F.lit("page"), i.cast("string"), F.lit("."), F.when(i % 9 == 0, "gone").otherwise(ext))
    want = read(spark, d, "pages").select(
        "page_id", name.alias("logical_path"), (F.octet_length("html") + F.when(i % 5 == 0, 1).otherwise(0)).cast("bigint").alias("byte_length"),
        F.when(i % 7 == 0, "x").otherwise(F.sha2("html", 256)).alias("sha256"))
    return A.verified_contents(spark, derived.page_objects(spark, d), want).select("page_id", "state")


@query("s16_package_inventory", """
SELECT 'page' || page_id || '.' || ['html', 'json', 'bin', 'xyz'][page_id % 4 + 1] AS logical_path, sha256(html) AS sha256, CAST(strlen(html) AS BIGINT) AS byte_length,
 ['text/html', 'application/json', 'application/octet-stream', 'application/octet-stream'][page_id % 4 + 1] AS media_type FROM pages""")
def s16(spark, d):
    return A.package_inventory(spark, derived.page_objects(spark, d))


# A fixed layout in the published format, written to a file and read back.
LAYOUT = [("imu_layout.v1", "three", "stand-in layout", "provisional", [
    ("click", "left_wrist", [0.0, 0.0, 0.0], [1.0, 0.0, 0.0, 0.0]), ("view", "head", [0.0, 0.0, 0.08], [1.0, 0.0, 0.0, 0.0]),
    ("error", "spine3", [-0.08, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0])])]


@query("s15_layout_mounts", """
WITH m(mount, joint, ox, oz) AS (VALUES ('click', 'left_wrist', 0.0, 0.0), ('view', 'head', 0.0, 0.08), ('error', 'spine3', -0.08, 0.0))
SELECT event_id, mount, joint, CAST(ox AS DOUBLE) AS offset_x, CAST(oz AS DOUBLE) AS offset_z FROM events JOIN m ON mount = event_type""")
def s15(spark, d):
    path = work_dir(spark, "layout")
    spark.createDataFrame(LAYOUT, D.LAYOUT).coalesce(1).write.json(path)
    mounts = F.broadcast(D.layout_mounts(spark, path))
    out = read(spark, d, "events").join(mounts, F.col("event_type") == F.col("mount"))
    return out.select("event_id", "mount", "joint", F.get("offset", F.lit(0)).alias("offset_x"), F.get("offset", F.lit(2)).alias("offset_z"))


# One profile for each part, with defects by its number.
@query("x03_profile_rules", """
WITH p AS (SELECT CAST(p_partkey AS VARCHAR) AS key, CASE WHEN p_partkey % 11 = 0 THEN 99 ELSE 200 END AS work, CASE WHEN p_partkey % 3 = 0 THEN 12.5 ELSE 10.0 END AS low,
 CASE WHEN p_partkey % 5 = 0 THEN 10.5 ELSE 9.81 END AS g, CASE WHEN p_partkey % 7 = 0 THEN 0.03 ELSE 1.0 END AS guard FROM part)
SELECT 'profile-rates' AS rule, key, CAST(work AS VARCHAR) AS detail FROM p WHERE work < 100 UNION ALL SELECT 'profile-lowpass', key, '12.5' FROM p WHERE low >= 12.5
UNION ALL SELECT 'profile-gravity', key, '10.5' FROM p WHERE g > 10 UNION ALL SELECT 'profile-guard', key, '0.03' FROM p WHERE guard < 1""")
def x03(spark, d):
    k = F.col("p_partkey")
    rows = read(spark, d, "part").select(
        F.lit("profile.v1").alias("schema"), k.cast("string").alias("profile_id"), F.lit(25).alias("output_hz"), F.when(k % 11 == 0, 99).otherwise(200).alias("work_hz"),
        F.when(k % 3 == 0, 12.5).otherwise(10.0).alias("lowpass_hz"), F.when(k % 5 == 0, 10.5).otherwise(9.81).alias("gravity_m_s2"), F.when(k % 7 == 0, 0.03).otherwise(1.0).alias("boundary_guard_s"))
    path = work_dir(spark, "profiles")
    rows.write.json(path)
    return D.profile_rules(spark.read.schema(D.PROFILE).json(path)).select("rule", "key", "detail")


@query("x06_object_store", """
SELECT 'page' || page_id || '.' || ['html', 'json', 'bin', 'xyz'][page_id % 4 + 1] AS key, CAST(strlen(html) AS BIGINT) AS length, sha256(html) AS sha256 FROM pages""")
def x06(spark, d):
    """All objects below a store, listed and read by Spark."""
    store = ObjectStore(spark, derived.page_objects(spark, d))
    return store.objects().join(store.contents().select("key", F.sha2("content", 256).alias("sha256")), "key").select("key", "length", "sha256")


# --- sinks ---------------------------------------------------------------------------------

@query("k01_create_only_write", "SELECT event_id, user_id, event_type, value FROM events")
def k01(spark, d):
    ev = events(spark, d).select("event_id", "user_id", "event_type", "value")
    check = lambda t: C.record_rules(t, F.col("event_id"), {"finite": (C.finite(F.col("value")), F.col("value"))})
    return K.create_only_write(ev, work_dir(spark, "artifact"), check=check)


def _sequences(spark, d):
    s = samples(spark, d)
    q = s.groupBy("sequence_index").agg(F.min("sample").alias("sample_start"), (F.max("sample") + 1).alias("sample_stop"),
                                        F.max("l_partkey").cast("string").alias("recording_id"))
    return s, q


def payload():
    return F.concat_ws(",", (F.col("l_quantity") * 100).cast("bigint").cast("string"), F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"))


@query("k02_write_delivery", """
SELECT 'lineitems' AS dataset_id, 'samples' AS "table", count(*) AS rows, true AS same_hash FROM lineitem UNION ALL
SELECT 'lineitems', 'sequences', count(DISTINCT l_orderkey), true FROM lineitem""")
def k02(spark, d):
    s, q = _sequences(spark, d)
    man = K.write_delivery({"samples": s, "sequences": q}, work_dir(spark, "delivery"), dataset_id="lineitems",
                           sequences=q.select("sequence_index", "recording_id"), samples=s, payload=payload())
    # The hash of the stored tables, laid out and numbered in another way, is the one in the manifest.
    again = P.dataset_digest(P.logical_content(s.withColumn("sample", F.col("sample") + 1_000_003), q.select("recording_id", "sequence_index"), sequence="sequence_index", pos="sample", payload=payload()),
                             sequence="sequence_index")
    return man.join(again.withColumnRenamed("dataset_sha256", "again")).select("dataset_id", "table", "rows", (F.col("again") == F.col("dataset_sha256")).alias("same_hash"))


@query("k03_export_mounts", E + """
, l AS (SELECT user_id, event_type, count(*) AS n FROM e GROUP BY ALL),
q AS (SELECT *, row_number() OVER w - 1 AS sequence_index, sum(n) OVER w - n AS a FROM l WINDOW w AS (ORDER BY user_id, event_type))
SELECT event_id, CAST(sequence_index AS INTEGER) AS sequence_index, CAST(a + row_number() OVER (PARTITION BY e.user_id, e.event_type ORDER BY us, event_id) - 1 AS BIGINT) AS sample,
 round(CAST(CAST(value AS FLOAT) AS DOUBLE), 4) AS value FROM e JOIN q ON e.user_id = q.user_id AND e.event_type = q.event_type""")
def k03(spark, d):
    ev = signal(spark, d).select("user_id", "event_type", "us", "event_id", "value")
    _, s = K.export_mounts(ev, clip="user_id", mount="event_type", order=["us", "event_id"], values=["value"])
    return s.select("event_id", "sequence_index", "sample", F.round(F.col("value").cast("double"), 4).alias("value"))


_CORE = """, p AS (SELECT w.*, d.n_chars FROM w JOIN documents d USING (doc_id) JOIN labels l ON l.doc_id = w.doc_id WHERE quality = 1),
m AS (SELECT doc_id, state, code, rule_id, n_chars, unnest(['back', 'chest', 'wrist']) AS body_location FROM p)
SELECT CAST(row_number() OVER o - 1 AS INTEGER) AS sequence_index, CAST(sum(n_chars) OVER o - n_chars AS BIGINT) AS sample_start, CAST(sum(n_chars) OVER o AS BIGINT) AS sample_stop,
 doc_id, body_location, state, code, rule_id FROM m WINDOW o AS (ORDER BY doc_id, body_location)"""


def core(spark, d):
    rows = labelled(spark, d).join(read(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return K.weak_core(rows, document_clips(spark, d), key="doc_id", samples="n_chars", mounts=["back", "chest", "wrist"])


@query("k04_weak_core", COMMITS + ", " + sql_rules(RULES) + ", " + decide(2) + _CORE)
def k04(spark, d):
    return core(spark, d).select("sequence_index", "sample_start", "sample_stop", "doc_id", "body_location", "state", "code", "rule_id")


@query("k05_relabel", COMMITS + ", " + sql_rules(RULES) + ", " + decide(1) + _CORE)
def k05(spark, d):
    """The core of k04 relabelled with revision 1 decisions; sample ranges are carried."""
    out, moved = K.relabel(materialise(core(spark, d), "core"), labelled(spark, d, 1), key="doc_id")
    return D.validated(out, moved).select("sequence_index", "sample_start", "sample_stop", "doc_id", "body_location", "state", "code", "rule_id")


@query("k06_migrate", "SELECT count(DISTINCT l_orderkey) AS sequences, true AS hash_unchanged FROM lineitem")
def k06(spark, d):
    s, q = _sequences(spark, d)
    old = q.select("sequence_index", "recording_id")
    new = K.migrate(old.withColumnRenamed("recording_id", "recording"), {"recording": "recording_id"}, {"taxonomy_version": F.lit("v1")})
    a = P.logical_content(s, old, sequence="sequence_index", pos="sample", payload=payload())
    b = P.logical_content(s, new.select("sequence_index", "recording_id"), sequence="sequence_index", pos="sample", payload=payload())
    both = a.join(b.withColumnRenamed("digest", "other"), "sequence_index", "full_outer")
    return both.agg(F.count(F.lit(1)).alias("sequences"), F.bool_and(F.col("digest").eqNullSafe(F.col("other"))).alias("hash_unchanged"))


@query("k06_migration_violations", """
WITH k AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)
SELECT 'hash-changed' AS rule, CAST(k AS VARCHAR) AS key FROM k WHERE k % 50 = 0 AND k % 70 > 0 UNION ALL SELECT 'row-lost', CAST(k AS VARCHAR) FROM k WHERE k % 70 = 0
UNION ALL SELECT 'missing-taxonomy_id', CAST(k AS VARCHAR) FROM k WHERE k % 30 = 0 AND k % 70 > 0""")
def k06_violations(spark, d):
    """A migrated copy made from the lines anew, with rows lost, changed and without their taxonomy."""
    s, q = _sequences(spark, d)
    k = F.col("sequence_index")
    old = P.logical_content(s, q.select("sequence_index", "recording_id"), sequence="sequence_index", pos="sample", payload=payload())
    parts = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("sequence_index")).agg(F.max("l_partkey").alias("p"))
    changed = parts.select(k, F.when(k % 50 == 0, F.lit("x")).otherwise(F.col("p").cast("string")).alias("recording_id"))
    new = P.logical_content(s, changed, sequence="sequence_index", pos="sample", payload=payload()).where(k % 70 > 0)
    new = new.withColumn("taxonomy_id", F.when(k % 30 > 0, "t"))
    return K.migrated(old, new, key="sequence_index", required=["taxonomy_id"]).select("rule", "key")


@query("k07_write_shards", _PACK.replace("2550000", "25500000") + " SELECT ds AS dataset, CAST(shard AS BIGINT) AS shard, count(*) AS records, CAST(sum(body) AS BIGINT) AS body FROM f GROUP BY ALL")
def k07(spark, d):
    packed = greedy_shards(_packing_rows(spark, d), keys=["dataset"], order=["o_orderkey"], body="body", blobs="blobs", max_bytes=30_000_000)
    stored = K.write_shards(packed.select("dataset", "shard", "o_orderkey", "body"), work_dir(spark, "shards"), shard=["dataset", "shard"], order=["o_orderkey"])
    return stored.groupBy("dataset", "shard").agg(F.count(F.lit(1)).alias("records"), F.sum("body").alias("body"))


@query("k07_rebased_records", _PACK + """
SELECT ds AS dataset, CAST(shard AS BIGINT) AS shard, k AS o_orderkey, CAST(sum(body) OVER w - body AS BIGINT) AS start, CAST(sum(body) OVER w AS BIGINT) AS stop FROM f WINDOW w AS (PARTITION BY ds, shard ORDER BY k)""")
def k07_records(spark, d):
    """Offsets of the records inside their shards."""
    rows = K.packed_records(P_packed(spark, d), shard=["dataset", "shard"], order=["o_orderkey"], body="body")
    return rows.select("dataset", "shard", "o_orderkey", "start", "stop")


@query("k07_shared_blobs", _PACK + """
, b AS (SELECT ds, shard, sha, min(CASE WHEN k % 997 = 0 THEN bs + 1 ELSE bs END) AS lo, max(CASE WHEN k % 997 = 0 THEN bs + 1 ELSE bs END) AS hi FROM f GROUP BY ALL)
SELECT 'blob' AS kind, ds || '/' || shard || '/' || sha AS key, CAST(lo AS VARCHAR) AS detail FROM b
UNION ALL SELECT 'content-conflict', ds || '/' || shard || '/' || sha, '{"size":' || hi || '}' FROM b WHERE lo <> hi""")
def k07_blobs(spark, d):
    """Each blob of a shard once; a blob of two sizes is a conflict."""
    rows = P_packed(spark, d).select("dataset", "shard", "o_orderkey", F.explode("blobs").alias("b"))
    size = F.col("b.size") + F.when(F.col("o_orderkey") % 997 == 0, 1).otherwise(0)
    once, clash = K.shared_rows(rows.select("dataset", "shard", F.col("b.sha256").alias("sha256"), size.alias("size")), shard=["dataset", "shard"], identity="sha256")
    blob = once.select(F.lit("blob").alias("kind"), F.concat_ws("/", "dataset", F.col("shard").cast("string"), "sha256").alias("key"), F.col("size").cast("string").alias("detail"))
    return blob.unionByName(clash.withColumnRenamed("rule", "kind"))


@query("k08_publish", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def k08(spark, d):
    """Publish half, then all: the second run only adds what is new."""
    rows = read(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))
    path = work_dir(spark, "store")
    K.publish(rows.where("doc_id % 2 = 0").union(rows.where("doc_id % 6 = 0")), path, key="doc_id")
    return K.publish(rows, path, key="doc_id")


@query("k09_reposts", """
WITH f AS (SELECT l_orderkey AS candidate_id, count(*) AS posts FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1)
SELECT o_orderkey AS candidate_id, o_orderkey || '-' || (coalesce(posts, 0) + 1) AS feed_key FROM orders LEFT JOIN f ON candidate_id = o_orderkey
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')""")
def k09_reposts(spark, d):
    """Orders as commits; their returned lines as feed rows, of which some are not stored any more."""
    from strideframe.streaming.feeds import reposts
    lines = read(spark, d, "lineitem").where("l_returnflag <> 'N'")
    key = F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), "l_returnflag")
    feed = lines.select(F.col("l_orderkey").alias("candidate_id"), key.alias("feed_key"))
    stored = lines.where("l_returnflag = 'A'").select(key.alias("feed_key"))
    commits = read(spark, d, "orders").select(F.col("o_orderkey").alias("candidate_id"))
    return reposts(feed, commits, keys=["candidate_id"], feed_key="feed_key", stored=stored)


@query("k10_write_corpus", _LI + """
SELECT 'candidates' AS "table", count(*) FILTER (WHERE len(why) = 0) AS rows FROM g UNION ALL SELECT 'excluded', count(*) FILTER (WHERE len(why) > 0) FROM g
UNION ALL SELECT 'sources', count(DISTINCT src) FROM g UNION ALL SELECT 'statistics', 1 FROM (SELECT 1)""")
def k10_written(spark, d):
    """The corpus and audit documents as stored."""
    stored = K.write_corpus(line_clips(spark, d), work_dir(spark, "corpus"), source="src", key=["l_orderkey", "l_linenumber", "l_partkey"], policy=LI_POLICY)
    rows = [t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows") for n, t in stored.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


@query("k04_export_identity", "SELECT true AS same_rows_same_id, true AS other_rules_other_id, true AS other_audit_other_id FROM (SELECT count(*) FROM documents)")
def k04_identity(spark, d):
    """The identity follows rows, rules and audit, not the layout of the rows."""
    from strideframe.bindings.labels import rules
    rows = materialise(core(spark, d), "core")
    r, audit = rules(spark), read(spark, d, "labels").select("doc_id", "quality")
    ids_ = [K.export_identity(a, b, c, order=["sequence_index"]).withColumnRenamed("export_id", f"i{k}").withColumn("_one", F.lit(1)) for k, (a, b, c) in enumerate([
        (rows, r, audit), (rows.repartition(7), r, audit.repartition(3)), (rows, r.where("rule_id is not null").limit(3), audit), (rows, r, audit.where("doc_id % 9 > 0"))])]
    one = ids_[0].join(ids_[1], "_one").join(ids_[2], "_one").join(ids_[3], "_one")
    return one.select((F.col("i0") == F.col("i1")).alias("same_rows_same_id"), (F.col("i0") != F.col("i2")).alias("other_rules_other_id"), (F.col("i0") != F.col("i3")).alias("other_audit_other_id"))


@query("k11_write_catalog", "SELECT l_returnflag AS source, count(*) AS clips, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS frames FROM lineitem GROUP BY 1")
def k11(spark, d):
    plans = read(spark, d, "lineitem").select("l_orderkey", F.col("l_quantity").cast("bigint").alias("frames"), F.col("l_returnflag").alias("source"))
    path = work_dir(spark, "catalog")
    K.write_catalog(plans.where("source = 'A'"), path, source="source")
    stored = K.write_catalog(plans, path, source="source")
    return stored.groupBy("source").agg(F.count(F.lit(1)).alias("clips"), F.sum("frames").alias("frames"))


@query("k12_snapshot_manifest", """
WITH d AS (SELECT o_orderkey, o_orderstatus, o_custkey % 3 + 1 AS revision FROM orders WHERE o_custkey % 5 > 0)
SELECT o.o_orderkey, coalesce(d.o_orderstatus <> 'P', false) AS included, CASE WHEN d.o_orderkey IS NULL THEN 'unreviewed' WHEN d.o_orderstatus = 'P' THEN 'human-reject' END AS reason,
 revision, CASE WHEN d.o_orderstatus <> 'P' THEN o.o_orderkey // 1000 END AS shard FROM orders o LEFT JOIN d USING (o_orderkey)""")
def k12(spark, d):
    o = read(spark, d, "orders")
    dec = o.where("o_custkey % 5 > 0").select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "reject").otherwise("pass").alias("decision"),
                                              (F.col("o_custkey") % 3 + 1).alias("revision"))
    shards = o.select("o_orderkey", F.floor(F.col("o_orderkey") / 1000).alias("shard"))
    return K.create_only_write(K.snapshot_manifest(o.select("o_orderkey"), dec, shards, key="o_orderkey"), work_dir(spark, "snapshot"))


@query("k13_source_report", COMMITS + """
SELECT source, count(*) AS members, CAST(sum(n_chars) AS BIGINT) AS frames, round(sum(n_chars) / 25.0, 6) AS seconds, count(*) FILTER (WHERE list_contains(cats, 'sit')) + count(*) FILTER (WHERE list_contains(tmp, 'sit')) AS category_rows
FROM f JOIN documents USING (doc_id, source) GROUP BY source""")
def k13(spark, d):
    docs = read(spark, d, "documents").select("source", "n_chars")
    audit = M.corpus_audit(docs, source="source", frames="n_chars", rate=F.lit(25.0)).where("source is not null")
    lab = M.label_audit(commits(spark, d), split="source_dataset", key="doc_id", category="sit").select(F.col("split").alias("source"), "category_rows")
    inv = docs.select("source").distinct()
    out = K.source_report(inv, audit, lab, source="source")
    return out.select("source", "members", "frames", F.round("seconds", 6).alias("seconds"), "category_rows")
