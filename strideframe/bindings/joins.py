"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strideframe.bindings.common import E, signal
from strideframe.bindings.registry import query
from strideframe.operators import joins as J
from strideframe.plans import graphs
from strideframe.plans.ordered import Ordered, numbered
from strideframe.session import literal_rows, work_dir
from strideframe.sources import config
from strideframe.sources.tables import read

sha = lambda *cols: F.sha2(F.concat_ws("/", *[F.col(c).cast("string") if isinstance(c, str) else c for c in cols]), 256)


@query("j01_object_descriptors", """
WITH o AS (SELECT sha256(l_orderkey || '/' || l_linenumber) AS sha256, CAST(sum(l_quantity) AS BIGINT) AS byte_length FROM lineitem GROUP BY ALL),
c AS (SELECT o_orderkey, unnest(['motion', 'sensors', 'selection']) AS role, unnest([1, 2, 3]) AS n FROM orders)
SELECT o_orderkey, role, sha256, byte_length FROM (SELECT o_orderkey, role, sha256(o_orderkey || '/' || n) AS sha256 FROM c) JOIN o USING (sha256)""")
def j01(spark, d):
    roles = {"motion": "1", "sensors": "2", "selection": "3"}
    pairs = [x for r, n in roles.items() for x in (F.lit(r), sha("o_orderkey", F.lit(n)))]
    cand = read(spark, d, "orders").select("o_orderkey", F.create_map(*pairs).alias("objects"))
    objs = (read(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").cast("bigint").alias("byte_length"))
            .select(sha("l_orderkey", "l_linenumber").alias("sha256"), "byte_length"))
    return J.object_descriptors(cand, objs, key="o_orderkey").select("o_orderkey", "role", "sha256", "byte_length")


@query("j02_plan_with_report", """
SELECT o_orderkey, c_acctbal, CASE WHEN c_custkey IS NULL THEN 'clip-report-missing' ELSE '' END AS lineage_reasons
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 9 <> 0) ON o_custkey = c_custkey""")
def j02(spark, d):
    rep = read(spark, d, "customer").where("c_custkey % 9 <> 0").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    out = J.plan_with_report(read(spark, d, "orders"), rep, key="o_custkey")
    return out.select("o_orderkey", "c_acctbal", F.array_join("lineage_reasons", ",").alias("lineage_reasons"))


_PATHS = r"""WITH p AS (SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_extract(url, '^https?://[^/]+/([a-z]+/[0-9]+)', 1) AS tail FROM pages),
ix AS (SELECT host || '/' || tail AS name, min(page_id) AS sid FROM p WHERE page_id % 3 <> 0 GROUP BY 1 UNION ALL
 SELECT tail, min(page_id) FROM p WHERE page_id % 5 = 0 GROUP BY 1),
pr AS (SELECT page_id, host AS ds, CASE page_id % 4 WHEN 0 THEN tail WHEN 1 THEN host || '/' || tail WHEN 2 THEN host || '/' || host || '/' || tail ELSE tail END AS m FROM p),
sp AS (SELECT page_id, string_split(m, '/') AS a, m, ds FROM pr),
al AS (SELECT page_id, unnest(list_distinct([0])) AS z, [m, ds || '/' || m, CASE WHEN a[1] = ds AND len(a) > 1 THEN array_to_string(a[2:], '/') END,
 CASE WHEN len(a) > 1 THEN a[1] || '/' || m END, CASE WHEN len(a) > 1 AND a[1] = a[2] THEN array_to_string(a[2:], '/') END] AS l FROM sp),
ex AS (SELECT page_id, unnest(l) AS name, unnest([0,1,2,3,4]) AS pos FROM al),
h AS (SELECT page_id, arg_min(sid, pos) AS sid, min(sid) <> max(sid) AS ambiguous FROM ex JOIN ix USING (name) GROUP BY page_id)"""


def _paths(spark, d):
    p = read(spark, d, "pages").select(
        "page_id", F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host"),
        F.regexp_extract("url", r"^https?://[^/]+/([a-z]+/[0-9]+)", 1).alias("tail"))
    full = F.concat_ws("/", "host", "tail")
    index = (p.where("page_id % 3 <> 0").groupBy(full.alias("name")).agg(F.min("page_id").alias("sid"))
             .unionByName(p.where("page_id % 5 = 0").groupBy(F.col("tail").alias("name")).agg(F.min("page_id").alias("sid"))))
    m = F.col("page_id") % 4
    probes = p.select("page_id", F.col("host").alias("dataset"), F.when(m == 1, full).when(
        m == 2, F.concat_ws("/", "host", "host", "tail")).otherwise(F.col("tail")).alias("member"))
    return probes, index


@query("j03_alias_join", _PATHS + " SELECT page_id, m AS member, sid, ambiguous FROM pr LEFT JOIN h USING (page_id)")
def j03(spark, d):
    probes, index = _paths(spark, d)
    out = J.alias_join(probes, index, key="page_id", member="member", dataset="dataset", name="name", identity="sid")
    return out.select("page_id", "member", "sid", "ambiguous")


@query("j04_prefix_join", E + """
, r AS (SELECT user_id, event_type, (max(us)-min(us))/1e6 AS dur, count(*) AS n FROM e GROUP BY ALL),
k AS (SELECT user_id, event_type, dur FROM r WHERE user_id % 3 <> 0), m AS (SELECT * FROM r WHERE user_id % 5 <> 0)
SELECT 'R/' || k.user_id || '/' || k.event_type AS path, m.n IS NOT NULL AS matched, round(abs(k.dur - m.n/0.00001), 6) AS duration_difference_s
FROM k LEFT JOIN m ON k.user_id = m.user_id AND k.event_type = m.event_type""")
def j04(spark, d):
    r = signal(spark, d).groupBy("user_id", "event_type").agg(
        ((F.max("us") - F.min("us")) / F.lit(1e6)).alias("duration_s"), F.count(F.lit(1)).alias("frames"))
    name = F.concat_ws("/", F.col("user_id").cast("string"), "event_type")
    root = F.when(F.col("user_id") % 3 == 0, "R/x/").otherwise("R/R/")
    rec = r.select(F.concat(root, name).alias("feature"), "duration_s")
    mot = r.where("user_id % 5 <> 0").select(F.concat(F.lit("R/"), name).alias("path"), "frames", F.lit(0.00001).alias("rate_hz"))
    out = J.prefix_join(rec, mot, feature="feature", prefix="R/", path="path")
    return out.select("path", "matched", F.round("duration_difference_s", 6).alias("duration_difference_s"))


@query("j10_requested_ids", """
SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'found' ELSE 'missing' END AS status FROM documents""")
def j10(spark, d):
    return J.requested(read(spark, d, "documents").select("doc_id"), read(spark, d, "labels"), key="doc_id")


@query("j11_pending_requests", """
SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND NOT (o_orderpriority = '1-URGENT' AND o_custkey % 2 = 0)""")
def j11(spark, d):
    o = read(spark, d, "orders")
    return J.pending(o.select("o_orderkey"), o.where("o_orderstatus = 'F'"),
                     o.where("o_orderpriority = '1-URGENT' and o_custkey % 2 = 0"), key="o_orderkey")


@query("j14_lineage_join", """
SELECT o_orderkey, array_to_string(list_filter([CASE WHEN o_orderkey % 7 = 0 THEN 'sensor-motion' END, CASE WHEN o_orderkey % 11 = 0 THEN 'selection-motion' END,
 CASE WHEN o_custkey % 13 = 0 OR o_orderkey % 11 = 0 THEN 'sensor-selection' END, CASE WHEN o_orderkey % 17 = 0 THEN 'review-sensor' END,
 CASE WHEN o_orderkey % 17 = 0 OR o_custkey % 19 = 0 THEN 'layout' END], lambda x: x IS NOT NULL), ',') AS reasons FROM orders""")
def j14(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    motion = o.select("o_orderkey", k.alias("motion_id"))
    sensors = o.select("o_orderkey", F.when(k % 7 == 0, -1).otherwise(k).alias("sensor_motion_id"), (k + 1).alias("sensor_id"),
                       (k % 5).alias("layout_id"), F.when(c % 13 == 0, -1).otherwise(k + 2).alias("sensor_selection_id"))
    selection = o.where(k % 11 != 0).select("o_orderkey", k.alias("selection_motion_id"), (k + 2).alias("selection_id"))
    review = o.where(k % 17 != 0).select("o_orderkey", (k + 1).alias("review_sensor_id"),
                                         F.when(c % 19 == 0, -1).otherwise(k % 5).alias("review_layout_id"))
    out = J.lineage_join(motion, sensors, selection, review, key="o_orderkey")
    return out.select("o_orderkey", F.array_join("lineage_reasons", ",").alias("reasons"))


@query("j15_reconcile_keys", """
WITH a AS (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderstatus <> 'P'), b AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_linenumber < 4)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'missing' ELSE 'extra' END AS state FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL""")
def j15(spark, d):
    a = read(spark, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k"))
    b = read(spark, d, "lineitem").where("l_linenumber < 4").select(F.col("l_orderkey").alias("k"))
    return J.reconcile_keys(a, b, key="k")


@query("j16_reference_audit", """
WITH li AS (SELECT l_orderkey || '/' || l_linenumber AS k, CAST(sum(l_quantity) AS BIGINT) AS size, sha256(l_orderkey || '/' || l_linenumber) AS sha FROM lineitem GROUP BY l_orderkey, l_linenumber),
ar AS (SELECT o_orderkey, o_orderkey || '/' || n AS k, n, o_custkey FROM (SELECT *, unnest([1, 2]) AS n FROM orders)),
j AS (SELECT ar.*, li.size, CASE WHEN ar.o_orderkey % 10 = 0 THEN coalesce(size, 1) + 1 ELSE coalesce(size, 1) END AS want,
 li.sha, CASE WHEN ar.o_orderkey % 23 = 0 THEN 'x' ELSE sha256(ar.k) END AS wsha FROM ar LEFT JOIN li USING (k))
SELECT CASE WHEN size IS NULL THEN 'artifact-missing' WHEN size <> want THEN 'artifact-size' ELSE 'artifact-digest' END AS rule,
 'c/' || o_orderkey AS key, k AS detail FROM j WHERE size IS NULL OR size <> want OR sha <> wsha
UNION ALL SELECT 'feed-digest', 'c/' || o_orderkey, 'f/' || o_orderkey FROM orders WHERE o_custkey % 31 = 0""")
def j16(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    listing = (read(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").cast("bigint").alias("size"))
               .select(F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("key"),
                       "size", sha("l_orderkey", "l_linenumber").alias("sha256")))
    orders = read(spark, d, "orders").select("o_orderkey", "o_custkey")
    art = orders.select("o_orderkey", "o_custkey", F.explode(F.array(F.lit(1), F.lit(2))).alias("n"))
    art = art.withColumn("key", F.concat_ws("/", k.cast("string"), F.col("n").cast("string")))
    size = F.coalesce("size", F.lit(1)) + F.when(k % 10 == 0, 1).otherwise(0)
    art = art.join(listing.select("key", "size"), "key", "left").select(
        "o_orderkey", "o_custkey", F.struct("key", F.when(k % 23 == 0, "x").otherwise(F.sha2("key", 256)).alias("sha256"), size.alias("byte_length")).alias("a"))
    commits = art.groupBy("o_orderkey", "o_custkey").agg(F.collect_list("a").alias("artifacts")).select(
        F.concat(F.lit("c/"), k.cast("string")).alias("commit_key"), "artifacts", F.sha2(k.cast("string"), 256).alias("commit_sha256"))
    feed = orders.select(F.concat(F.lit("f/"), k.cast("string")).alias("feed_key"), F.concat(F.lit("c/"), k.cast("string")).alias("commit_key"),
                         F.when(c % 31 == 0, "x").otherwise(F.sha2(k.cast("string"), 256)).alias("commit_sha256"))
    return J.reference_audit(commits, listing, feed)


JOINT_MAP = [("ECONOMY", "pelvis"), ("SMALL", "left_hip"), ("MEDIUM", "right_hip"), ("LARGE", "neck")]


@query("j17_map_joints", """
WITH m(s, t) AS (VALUES ('ECONOMY', 'pelvis'), ('SMALL', 'left_hip'), ('MEDIUM', 'right_hip'), ('LARGE', 'neck'))
SELECT p_partkey, p_type, t AS target_joint, t IS NOT NULL AS mapped FROM part LEFT JOIN m ON s = p_type""")
def j17(spark, d):
    m = literal_rows(spark, JOINT_MAP, "source_joint string, target_joint string")
    return J.map_joints(read(spark, d, "part").select("p_partkey", "p_type"), m, joint="p_type")


@query("x02_mapping_from_file", """
WITH m(s, t) AS (VALUES ('ECONOMY', 'pelvis'), ('SMALL', 'left_hip'), ('MEDIUM', 'right_hip'), ('LARGE', 'neck'))
SELECT p_partkey, p_type, t AS target_joint, t IS NOT NULL AS mapped FROM part LEFT JOIN m ON s = p_type""")
def x02(spark, d):
    """The same mapping, written to and loaded from a document."""
    folder = work_dir(spark, "mapping")
    row = {"schema": "mapping.v1", "adapter_id": "parts", "description": "", "position_scale_m": 0.01, "world_from_source_matrix": [[1.0]], "joint_map": dict(JOINT_MAP)}
    spark.createDataFrame([row], config.MAPPING).coalesce(1).write.json(folder)
    m = config.load_mapping(spark, folder).select("source_joint", "target_joint")
    return J.map_joints(read(spark, d, "part").select("p_partkey", "p_type"), m, joint="p_type")


_DEV = ", ".join(f"('{a}', {'NULL' if b is None else repr(b)}, '{c}', {j})" for a, b, c, j in J.DEVICE_JOINTS)


@query("j18_device_joint", f"""
WITH m(dominant, focus, device, joint) AS (VALUES {_DEV}),
r AS (SELECT event_id, CASE WHEN user_id % 4 = 0 THEN 'left' ELSE 'right' END AS dominant, CASE user_id % 3 WHEN 0 THEN 'Upper' WHEN 1 THEN 'Lower' ELSE 'Torso' END AS focus,
 CASE event_type WHEN 'click' THEN 'wrist' WHEN 'view' THEN 'ear' WHEN 'error' THEN 'a1' WHEN 'signup' THEN 'a4' ELSE 'b9' END AS device FROM events)
SELECT event_id, r.device, joint FROM r LEFT JOIN m ON m.dominant = r.dominant AND m.device = r.device AND (m.focus IS NULL OR m.focus = r.focus)""")
def j18(spark, d):
    u, t = F.col("user_id"), F.col("event_type")
    rows = read(spark, d, "events").select(
        "event_id", F.when(u % 4 == 0, "left").otherwise("right").alias("dominant"),
        F.when(u % 3 == 0, "Upper").when(u % 3 == 1, "Lower").otherwise("Torso").alias("focus"),
        F.when(t == "click", "wrist").when(t == "view", "ear").when(t == "error", "a1").when(t == "signup", "a4").otherwise("b9").alias("device"))
    dev = literal_rows(spark, J.DEVICE_JOINTS, "dominant string, focus string, device string, joint int")
    return J.device_joint(rows, dev).select("event_id", "device", "joint")


PARENTS = [-1, 0, 0, 1, 2, 3, 4, 0]          # fixed skeleton of the stand-in


@query("j21_world_transforms", f"""
WITH RECURSIVE b AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e, unnest(range(0, 8)) AS j FROM embeddings),
c AS (SELECT vec_id, j, {PARENTS}[j+1] AS p, e[4*j+1] AS w, e[4*j+2] AS x, e[4*j+3] AS y, e[4*j+4] AS z, e[33+3*j] AS ox, e[34+3*j] AS oy, e[35+3*j] AS oz FROM b),
l AS (SELECT vec_id, j, p, w/n AS w, x/n AS x, y/n AS y, z/n AS z, ox, oy, oz FROM (SELECT *, sqrt(w*w+x*x+y*y+z*z) AS n FROM c)),
r AS (SELECT vec_id, j, w, x, y, z, ox AS px, oy AS py, oz AS pz FROM l WHERE p = -1 UNION ALL
 SELECT l.vec_id, l.j, r.w*l.w-r.x*l.x-r.y*l.y-r.z*l.z, r.w*l.x+r.x*l.w+r.y*l.z-r.z*l.y, r.w*l.y-r.x*l.z+r.y*l.w+r.z*l.x, r.w*l.z+r.x*l.y-r.y*l.x+r.z*l.w,
 r.px+(1-2*(r.y*r.y+r.z*r.z))*ox+2*(r.x*r.y-r.z*r.w)*oy+2*(r.x*r.z+r.y*r.w)*oz,
 r.py+2*(r.x*r.y+r.z*r.w)*ox+(1-2*(r.x*r.x+r.z*r.z))*oy+2*(r.y*r.z-r.x*r.w)*oz,
 r.pz+2*(r.x*r.z-r.y*r.w)*ox+2*(r.y*r.z+r.x*r.w)*oy+(1-2*(r.x*r.x+r.y*r.y))*oz FROM r JOIN l ON l.vec_id = r.vec_id AND l.p = r.j)
SELECT vec_id, CAST(j AS INTEGER) AS joint, round(w, 6) AS w, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z, round(px, 6) AS px, round(py, 6) AS py, round(pz, 6) AS pz FROM r""")
def j21(spark, d):
    rot = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda j: F.slice("embedding", 4 * j + 1, F.lit(4)))
    off = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda j: F.slice("embedding", 33 + 3 * j, F.lit(3)))
    frames = read(spark, d, "embeddings").select("vec_id", rot.alias("rot"), off.alias("off"))
    out = J.world_transforms(frames, PARENTS, rotations="rot", offsets="off")
    out = out.select("vec_id", F.posexplode("world").alias("joint", "t"))
    return out.select("vec_id", "joint", *[F.round(f"t.q{c}", 6).alias(c) for c in "wxyz"], *[F.round(f"t.p{c}", 6).alias(f"p{c}") for c in "xyz"])


@query("j22_dependency_closure", """
WITH RECURSIVE e AS (SELECT DISTINCT p_partkey AS a, p_partkey // 2 AS b FROM part),
r AS (SELECT a, b, 1 AS steps FROM e UNION ALL SELECT r.a, e.b, steps + 1 FROM r JOIN e ON e.a = r.b WHERE r.b <> e.b)
SELECT a AS asset, b AS dependency, CAST(min(steps) AS INTEGER) AS steps, a = b AS cycle FROM r GROUP BY a, b""")
def j22(spark, d):
    e = read(spark, d, "part").select(F.col("p_partkey").alias("asset"), F.floor(F.col("p_partkey") / 2).alias("dependency"))
    return J.dependency_closure(e, source="asset", target="dependency")


@query("j22_closure_of_roots", """
WITH RECURSIVE e AS (SELECT DISTINCT p_partkey AS a, p_partkey // 2 AS b FROM part),
r AS (SELECT a, b, 1 AS steps FROM e WHERE a % 100 = 7 UNION ALL SELECT r.a, e.b, steps + 1 FROM r JOIN e ON e.a = r.b WHERE r.b <> e.b)
SELECT a AS asset, b AS dependency, CAST(min(steps) AS INTEGER) AS steps FROM r GROUP BY a, b""")
def j22_roots(spark, d):
    e = read(spark, d, "part").select(F.col("p_partkey").alias("asset"), F.floor(F.col("p_partkey") / 2).alias("dependency"))
    return J.dependency_closure(e, source="asset", target="dependency", roots=e.where("asset % 100 = 7")).drop("cycle")


# Each part depends on the part of half its number, some on the part of twice it: cycles that share parts.
@query("j22_cycle_groups", """
WITH RECURSIVE e AS (SELECT DISTINCT p_partkey AS a, p_partkey // 2 AS b FROM part UNION SELECT p_partkey, p_partkey * 2 FROM part WHERE p_size % 5 = 0
 UNION SELECT p_partkey, p_partkey FROM part WHERE p_size = 7),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
m AS (SELECT x.a AS node, min(x.b) AS component FROM r x JOIN r y ON y.a = x.b AND y.b = x.a GROUP BY x.a)
SELECT node, component, count(*) OVER (PARTITION BY component) AS size FROM m""")
def j22_cycles(spark, d):
    part, k = read(spark, d, "part"), F.col("p_partkey")
    e = part.select(k.alias("asset"), F.floor(k / 2).alias("dependency"))
    e = e.union(part.where("p_size % 5 = 0").select(k, k * 2)).union(part.where("p_size = 7").select(k, k))
    return graphs.cycle_groups(e, source="asset", target="dependency")


@query("j23_observation_rows", """
WITH o AS (SELECT doc_id AS observation, unnest([doc_id, doc_id * 2, doc_id + 7]) AS cand FROM documents)
SELECT observation, cand, cand IN (SELECT doc_id FROM documents) AS known, count(*) > 1 AS duplicate FROM o GROUP BY ALL""")
def j23(spark, d):
    i = F.col("doc_id")
    docs = read(spark, d, "documents").select("doc_id")
    obs = docs.select(i.alias("observation"), F.array(i, i * 2, i + 7).alias("ids"))
    return J.observation_rows(obs, docs.select(i.alias("cand")), key="cand", ids="ids")


@query("j25_override_labels", """
WITH x AS (SELECT d.doc_id, CASE d.doc_id % 3 WHEN 0 THEN [] WHEN 1 THEN [lang] ELSE [lang, source] END AS codes, l.doc_id IS NOT NULL AS has, l.toxic = 1 AS off,
 CASE WHEN quality = 1 THEN 'good' ELSE '' END AS code FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
s AS (SELECT *, CASE WHEN has AND off THEN 'unbound' WHEN NOT (len(CASE WHEN has THEN [code] ELSE codes END) = 1 AND (CASE WHEN has THEN [code] ELSE codes END)[1] <> '') THEN 'unresolved' ELSE 'resolved' END AS state FROM x)
SELECT doc_id, state, CASE WHEN state = 'resolved' THEN (CASE WHEN has THEN [code] ELSE codes END)[1] END AS code FROM s""")
def j25(spark, d):
    i = F.col("doc_id")
    none = F.array().cast("array<string>")
    base = read(spark, d, "documents").select(
        "doc_id", F.when(i % 3 == 0, none).when(i % 3 == 1, F.array("lang")).otherwise(F.array("lang", "source")).alias("codes"),
        F.sha2(i.cast("string"), 256).alias("commit_sha256"))
    over = read(spark, d, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "good").otherwise("").alias("code"),
        F.when(F.col("toxic") == 1, "x").otherwise(F.sha2(i.cast("string"), 256)).alias("commit_sha256"))
    return J.override_labels(base, over, key="doc_id")


_SAMPLES = """WITH s AS (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1 AS sample FROM lineitem),
q AS (SELECT l_orderkey, min(sample) AS a, max(sample) + 1 AS b FROM s GROUP BY l_orderkey)"""


def samples(spark, d):
    """Line items as samples of sequence `l_orderkey`, globally numbered."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    s = numbered(read(spark, d, "lineitem").select(*order), order, "sample")
    return s.withColumnRenamed("l_orderkey", "sequence_index")


@query("s10_sequence_rows", _SAMPLES + """
SELECT sample, l_orderkey AS sequence_index, sample - a AS row, l_quantity FROM s JOIN q USING (l_orderkey)
WHERE l_orderkey % 3 = 0 AND sample - a >= 1 AND sample - a < 4""")
def s10(spark, d):
    s = samples(spark, d)
    q = s.groupBy("sequence_index").agg(F.min("sample").alias("sample_start"), (F.max("sample") + 1).alias("sample_stop"))
    out = J.sequence_rows(s, q.where("sequence_index % 3 = 0"), start=1, stop=4)
    return out.select("sample", "sequence_index", "row", "l_quantity")
