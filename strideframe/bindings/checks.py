"""Contract-check queries: every one returns (rule, key, detail) unless noted."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.bindings.common import CLIP, E, ORDER, signal
from strideframe.bindings.registry import query
from strideframe.operators import checks as C
from strideframe.operators import joins as J
from strideframe.plans.ordered import Ordered
from strideframe.plans.ranges import containing_counts, points_in_intervals
from strideframe.session import literal_rows
from strideframe.sources.tables import read

_POS = E + """, p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) - 1 AS pos,
 count(*) OVER (PARTITION BY user_id) AS n FROM e)"""


def _placed(spark, d):
    return Ordered(signal(spark, d), CLIP, ORDER).position("pos", "n").done()


def _rules_sql(table, key, rules):
    """One UNION ALL branch per rule: (name, condition that must hold, detail)."""
    return " UNION ALL ".join(
        f"SELECT '{n}' AS rule, CAST({key} AS VARCHAR) AS key, coalesce(CAST({d} AS VARCHAR), '') AS detail "
        f"FROM {table} WHERE NOT coalesce({c}, false)" for n, c, d in rules)


@query("c01_select_frames", _POS + """
SELECT event_id, sha256(CAST(user_id AS VARCHAR)) AS motion_sha256, pos FROM p
WHERE user_id % 3 <> 0 AND pos >= user_id % 10 AND pos < user_id % 10 + 20""")
def c01(spark, d):
    frames = _placed(spark, d).withColumn("motion_sha256", F.sha2(F.col("user_id").cast("string"), 256))
    who = F.col("user_id")
    sel = read(spark, d, "events").select("user_id").distinct().select(
        "user_id", (who % 10).alias("start_frame"), (who % 10 + 20).alias("stop_frame"),
        F.sha2(F.when(who % 3 == 0, F.lit("other")).otherwise(who.cast("string")), 256).alias("parent_sha256"),
        F.sha2(F.concat(F.lit("s"), who.cast("string")), 256).alias("selection_id"))
    out = C.select_frames(frames, sel, motion="user_id", frame="pos")
    return out.select("event_id", "motion_sha256", "pos")


def member(lang="lang"):
    return F.concat_ws("/", "source", lang, F.concat(
        F.lit("doc"), F.col("doc_id").cast("string"),
        F.when(F.col("doc_id") % 4 == 0, "_stageii.npz").when(F.col("doc_id") % 7 == 0, ".txt").otherwise("_poses.npz")))


MEMBER_SQL = ("source || '/' || lang || '/doc' || doc_id || CASE WHEN doc_id % 4 = 0 THEN '_stageii.npz' "
              "WHEN doc_id % 7 = 0 THEN '.txt' ELSE '_poses.npz' END")


@query("c02_wanted_members", f"""
SELECT doc_id, m AS member, ends_with(m, '_stageii.npz') AS adapter_match
FROM (SELECT doc_id, {MEMBER_SQL} AS m FROM documents) WHERE ends_with(m, '.npz')""")
def c02(spark, d):
    docs = read(spark, d, "documents").select("doc_id", member().alias("member"))
    return C.wanted_members(docs, member="member", suffixes=["_poses.npz", "_stageii.npz"],
                            adapter_suffix="_stageii.npz")


@query("c03_source_disposition", """
SELECT doc_id, source, CASE WHEN source IN ('src18', 'src19') THEN 'unknown' WHEN source = 'src3' THEN 'paused'
 ELSE 'run' END AS disposition FROM documents""")
def c03(spark, d):
    known = [f"src{i}" for i in range(18)]
    return C.source_disposition(read(spark, d, "documents").select("doc_id", "source"), source="source",
                                known=known, paused=["src3"])


@query("c05_schema_conformance", """
SELECT 'type' AS rule, 'l_linenumber' AS key, 'int' AS detail UNION ALL SELECT 'field', 'ship_date', 'l_shipdate'
UNION ALL SELECT 'null:l_tax', CAST(l_orderkey AS VARCHAR), 'l_tax' FROM (SELECT l_orderkey, nullif(l_tax, 0.08) AS x FROM lineitem) WHERE x IS NULL""")
def c05(spark, d):
    li = read(spark, d, "lineitem").withColumn("l_tax", F.nullif(F.col("l_tax"), F.lit(0.08)))
    fields = [T.StructField(f.name, f.dataType, f.name != "l_tax") for f in li.schema.fields]
    fields[3] = T.StructField("l_linenumber", T.LongType(), True)
    fields[10] = T.StructField("ship_date", fields[10].dataType, True)
    return C.schema_conformance(li, T.StructType(fields), {}, F.col("l_orderkey"))


@query("c06_nonfinite", """
SELECT 'nonfinite' AS rule, CAST(vec_id AS VARCHAR) AS key, CAST(n AS VARCHAR) AS detail FROM (
 SELECT vec_id, count(*) FILTER (WHERE round(CAST(x AS DOUBLE)*20) = 0) AS n
 FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings) GROUP BY vec_id) WHERE n > 0""")
def c06(spark, d):
    e = read(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: (
        x.cast("double") / F.nullif(F.round(x.cast("double") * 20), F.lit(0.0)))).alias("a"))
    return C.nonfinite_arrays(e, key="vec_id", array="a")


@query("c07_unit_norm", """
WITH q AS (SELECT vec_id, list_transform(embedding[1:4], lambda x: CAST(x AS DOUBLE)) AS q FROM embeddings),
n AS (SELECT vec_id, q, round(sqrt(q[1]**2+q[2]**2+q[3]**2+q[4]**2), 2) AS r FROM q),
m AS (SELECT vec_id, sqrt((q[1]/r)**2+(q[2]/r)**2+(q[3]/r)**2+(q[4]/r)**2) AS n FROM n)
SELECT 'norm' AS rule, CAST(vec_id AS VARCHAR) AS key, CAST(CAST(round(n, 6) AS DECIMAL(18,6)) AS VARCHAR) AS detail
FROM m WHERE NOT abs(n-1) <= 0.005""")
def c07(spark, d):
    q = F.transform(F.slice("embedding", 1, 4), lambda x: x.cast("double"))
    r = F.round(F.sqrt(F.aggregate("q", F.lit(0.0), lambda a, x: a + x * x)), 2)
    e = (read(spark, d, "embeddings").select("vec_id", q.alias("q")).withColumn("r", r)
         .select("vec_id", F.transform("q", lambda x: x / F.col("r")).alias("q")))
    return C.unit_norm(e, key="vec_id", array="q", tolerance=5e-3)


@query("c08_identifiers", "WITH k AS (SELECT page_id, regexp_replace(url, '^https?://', '') AS u, "
       "regexp_extract(url, '([^/]*)/?$', 1) AS t, "
       "CASE WHEN page_id % 5 = 0 THEN upper(sha256(url)) ELSE sha256(url) END AS h FROM pages) " + _rules_sql(
           "k", "page_id", [
               ("relative-path", r"length(u) > 0 AND NOT regexp_matches(u, '[\\:]') AND NOT starts_with(u, '/') AND NOT ends_with(u, '/') AND NOT contains(u, '//') AND NOT regexp_matches(u, '(^|/)\.{1,2}(/|$)')", "u"),
               ("object-key", r"length(u) > 0 AND NOT starts_with(u, '/') AND NOT regexp_matches(u, '(^|/)\.\.(/|$)')", "u"),
               ("identifier", r"regexp_matches(t, '^[A-Za-z0-9][A-Za-z0-9._-]*$')", "t"),
               ("code", r"regexp_matches(t, '^[a-z][a-z0-9_]*$')", "t"),
               ("sha256", r"regexp_matches(h, '^[0-9a-f]{64}$')", "h")]))
def c08(spark, d):
    k = read(spark, d, "pages").select(
        "page_id", F.regexp_replace("url", "^https?://", "").alias("u"),
        F.regexp_extract("url", "([^/]*)/?$", 1).alias("t"), F.sha2("url", 256).alias("h"))
    k = k.withColumn("h", F.when(F.col("page_id") % 5 == 0, F.upper("h")).otherwise(F.col("h")))
    u, t, h = F.col("u"), F.col("t"), F.col("h")
    return C.record_rules(k, F.col("page_id"), {
        "relative-path": (C.is_relative_path(u), u), "object-key": (C.is_object_key(u), u),
        "identifier": (t.rlike(C.IDENTIFIER), t), "code": (t.rlike(C.CODE), t), "sha256": (h.rlike(C.SHA256), h)})


@query("c09_record_rules", _rules_sql("orders", "o_orderkey", [
    ("status", "o_orderstatus IN ('F', 'O')", "o_orderstatus"),
    ("frames", "o_custkey >= 2", "o_custkey"),
    ("frame-range", "0 <= o_orderkey % 50 AND o_orderkey % 50 < o_custkey % 400 AND o_custkey % 400 <= o_custkey", "o_orderkey % 50"),
    ("positive", "o_totalprice > 5000", "CAST(floor(o_totalprice) AS BIGINT)"),
    ("member", "length(o_orderpriority) > 5", "o_orderpriority")]))
def c09(spark, d):
    o = read(spark, d, "orders")
    start, stop, frames = F.col("o_orderkey") % 50, F.col("o_custkey") % 400, F.col("o_custkey")
    return C.record_rules(o, F.col("o_orderkey"), {
        "status": (F.col("o_orderstatus").isin("F", "O"), F.col("o_orderstatus")),
        "frames": (frames >= 2, frames),
        "frame-range": ((start >= 0) & (start < stop) & (stop <= frames), start),
        "positive": (F.col("o_totalprice") > 5000, F.floor("o_totalprice")),
        "member": (F.length("o_orderpriority") > 5, F.col("o_orderpriority"))})


@query("c10_duplicates", """
SELECT 'duplicate' AS rule, l_orderkey || '/' || l_linenumber AS key, CAST(count(*) AS VARCHAR) AS detail
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def c10(spark, d):
    return C.duplicates(read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("c11_conditional_rules", _rules_sql("labels", "doc_id", [
    ("pass-needs-labels", "NOT (quality = 1) OR doc_id % 6 <> 0", "quality"),
    ("reject-needs-reason", "NOT (quality = 0) OR toxic = 1", "toxic"),
    ("disabled-zero", "NOT (doc_id % 5 = 0) OR (quality = 0 AND toxic = 0)", "quality + toxic")]))
def c11(spark, d):
    q, t, i = F.col("quality"), F.col("toxic"), F.col("doc_id")
    return C.record_rules(read(spark, d, "labels"), i, {
        "pass-needs-labels": (C.implies(q == 1, i % 6 != 0), q),
        "reject-needs-reason": (C.implies(q == 0, t == 1), t),
        "disabled-zero": (C.implies(i % 5 == 0, (q == 0) & (t == 0)), q + t)})


_STAMP = """CASE event_id % 5 WHEN 0 THEN s || 'Z' WHEN 1 THEN s || '+00:00' WHEN 2 THEN s || '+01:00' WHEN 3 THEN s
 ELSE replace(s, '2024-01', '2024-13') || 'Z' END"""


@query("c12_utc_timestamps", f"""
WITH t AS (SELECT event_id, {_STAMP} AS c FROM (SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS s FROM events))
SELECT 'not-utc' AS rule, CAST(event_id AS VARCHAR) AS key, c AS detail FROM t
WHERE NOT (regexp_matches(c, '(Z|\\+00:00)$') AND try_cast(replace(c, 'Z', '+00:00') AS TIMESTAMPTZ) IS NOT NULL)""")
def c12(spark, d):
    s = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    m = F.col("event_id") % 5
    c = (F.when(m == 0, F.concat(s, F.lit("Z"))).when(m == 1, F.concat(s, F.lit("+00:00")))
         .when(m == 2, F.concat(s, F.lit("+01:00"))).when(m == 3, s)
         .otherwise(F.concat(F.replace(s, F.lit("2024-01"), F.lit("2024-13")), F.lit("Z"))))
    return C.utc_timestamps(signal(spark, d).select("event_id", c.alias("c")), key="event_id", text="c")


# Orders as sequences: length from the price, every 97th start shifted by one.
_SEQ = """WITH l AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) % 7 AS len FROM orders),
r AS (SELECT *, sum(len) OVER (ORDER BY o_orderkey) AS hi FROM l),
s AS (SELECT o_orderkey, CAST(hi - len + CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 0 END AS BIGINT) AS start, CAST(hi AS BIGINT) AS stop FROM r)"""


def _sequences(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", (F.floor("o_totalprice") % 7).alias("len"))
    r = Ordered(o, [], ["o_orderkey"]).running({"stop": F.col("len")}).done()
    shift = F.when(F.col("o_orderkey") % 97 == 0, 1).otherwise(0)
    return r.withColumn("start", F.col("stop") - F.col("len") + shift)


@query("c15_sequence_contiguity", _SEQ + """, b AS (SELECT *, lag(stop, 1, 0) OVER (ORDER BY o_orderkey) AS p FROM s)
SELECT 'noncontiguous' AS rule, CAST(o_orderkey AS VARCHAR) AS key, CAST(start AS VARCHAR) AS detail FROM b WHERE start <> p
UNION ALL SELECT 'too-short', CAST(o_orderkey AS VARCHAR), CAST(stop-start AS VARCHAR) FROM b WHERE stop-start < 2
UNION ALL SELECT 'incomplete-cover', 'samples', CAST(arg_max(stop, o_orderkey) AS VARCHAR) FROM b
HAVING arg_max(stop, o_orderkey) <> (SELECT count(*) FROM lineitem)""")
def c15(spark, d):
    rows = read(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("rows"))
    return C.sequence_contiguity(_sequences(spark, d), index="o_orderkey", start="start", stop="stop", rows=rows)


_ANN = """, a AS (SELECT event_id, user_id AS sequence_index, us // 3600000000 AS start_sample, us // 3600000000 + event_id % 3 AS stop_sample,
 CASE event_type WHEN 'view' THEN 'activity' WHEN 'click' THEN 'onset' WHEN 'purchase' THEN 'impact' ELSE 'exclude' END AS kind,
 CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 ELSE 3 END AS rank,
 'c' || event_id % 4 AS code FROM e)"""


@query("c16_annotation_order", E + _ANN + """
SELECT 'annotation-order' AS rule, CAST(event_id AS VARCHAR) AS key, CAST(sequence_index AS VARCHAR) AS detail FROM (
 SELECT *, lag((sequence_index, start_sample, rank, stop_sample, code)) OVER (ORDER BY event_id) AS p FROM a)
WHERE p > (sequence_index, start_sample, rank, stop_sample, code)""")
def c16(spark, d):
    kind = F.col("event_type")
    hour = F.floor(F.col("us") / 3_600_000_000)
    a = signal(spark, d).select(
        "event_id", F.col("user_id").alias("sequence_index"), hour.alias("start_sample"),
        (hour + F.col("event_id") % 3).alias("stop_sample"),
        F.when(kind == "view", "activity").when(kind == "click", "onset").when(kind == "purchase", "impact")
        .otherwise("exclude").alias("kind"), F.concat(F.lit("c"), (F.col("event_id") % 4).cast("string")).alias("code"))
    return C.annotation_order(a, file_order="event_id")


@query("c17_interval_cover", _POS + """
, a AS (SELECT user_id, n, pos*10 AS s, pos*10 + CASE WHEN event_id % 50 = 0 THEN 9 ELSE 10 END AS t FROM p WHERE event_type <> 'error' OR event_id % 9 > 0),
b AS (SELECT *, lag(t, 1, 0) OVER (PARTITION BY user_id ORDER BY s, t) AS c FROM a),
m AS (SELECT user_id, arg_max(t, s) AS t FROM a GROUP BY user_id), l AS (SELECT DISTINCT user_id, n*10 AS len FROM p)
SELECT 'coverage-gap-overlap' AS rule, CAST(user_id AS VARCHAR) AS key, CAST(s AS VARCHAR) AS detail FROM b WHERE s <> c
UNION ALL SELECT 'incomplete-cover', CAST(l.user_id AS VARCHAR), CAST(coalesce(t, 0) AS VARCHAR) FROM l LEFT JOIN m USING (user_id) WHERE coalesce(t, 0) <> len""")
def c17(spark, d):
    p = _placed(spark, d)
    a = p.where((F.col("event_type") != "error") | (F.col("event_id") % 9 > 0)).select(
        F.col("user_id").alias("sequence_index"), F.lit("activity").alias("kind"), (F.col("pos") * 10).alias("start_sample"),
        (F.col("pos") * 10 + F.when(F.col("event_id") % 50 == 0, 9).otherwise(10)).alias("stop_sample"), F.lit("x").alias("code"))
    seq = read(spark, d, "events").groupBy(F.col("user_id").alias("sequence_index")).agg(
        (F.count(F.lit(1)) * 10).alias("length"))
    return C.interval_cover(a, seq)


# Events as annotations: views are activities, even views have onsets, purchases are impacts.
_PAIR = E + """, k AS (SELECT *, us // 1000000 AS s, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM e),
act AS (SELECT user_id, k % 3 AS code, s, s + 60000 AS t FROM k WHERE event_type = 'view'),
ons AS (SELECT user_id, k % 3 AS code, s FROM k WHERE event_type = 'view' AND k % 2 = 0 UNION ALL
 SELECT user_id, k % 3, s FROM k WHERE event_type = 'click' AND k % 20 = 0),
imp AS (SELECT user_id, k % 3 AS code, s AS pt FROM k WHERE event_type = 'purchase')"""


def _annotations(spark, d):
    k = signal(spark, d).select(
        F.col("user_id").alias("sequence_index"), F.floor(F.col("us") / 1_000_000).alias("start_sample"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"), "event_type")
    code = (F.col("k") % 3).cast("string").alias("code")
    def part(cond, kind, stop):
        return k.where(cond).select("sequence_index", F.lit(kind).alias("kind"), "start_sample", stop.alias("stop_sample"), code)
    s = F.col("start_sample")
    return (part("event_type = 'view'", "activity", s + 60000)
            .unionByName(part("(event_type = 'view' and k % 2 = 0) or (event_type = 'click' and k % 20 = 0)", "onset", s))
            .unionByName(part("event_type = 'purchase'", "impact", s)))


@query("c18_event_pairing", _PAIR + """
, o AS (SELECT user_id, code, s, count(*) AS n_onset FROM ons GROUP BY ALL),
a AS (SELECT user_id, code, s, count(*) AS n, max(t) AS t FROM act GROUP BY ALL),
m AS (SELECT o.*, a.n, a.t FROM o LEFT JOIN a ON o.user_id=a.user_id AND o.code=a.code AND o.s=a.s),
f AS (SELECT * FROM m WHERE n = 1 AND n_onset = 1),
c AS (SELECT f.user_id, f.code, f.s, count(imp.pt) AS n FROM f LEFT JOIN imp ON f.user_id=imp.user_id AND f.code=imp.code AND pt > s AND pt < t GROUP BY ALL),
i AS (SELECT imp.user_id, imp.code, imp.pt, imp.id, count(f.s) AS n FROM (SELECT *, row_number() OVER () AS id FROM imp) imp
 LEFT JOIN f ON f.user_id=imp.user_id AND f.code=imp.code AND pt > s AND pt < t GROUP BY ALL)
SELECT 'onset-activity' AS rule, user_id || '/' || code || '/' || s AS key, CAST(coalesce(n, 0) AS VARCHAR) AS detail FROM m WHERE coalesce(n, 0) <> 1 OR n_onset <> 1
UNION ALL SELECT 'impact-in-fall', user_id || '/' || code || '/' || s, CAST(n AS VARCHAR) FROM c WHERE n <> 1
UNION ALL SELECT 'orphan-impact', user_id || '/' || code || '/' || pt, CAST(n AS VARCHAR) FROM i WHERE n <> 1
UNION ALL SELECT 'fall-flag', CAST(u AS VARCHAR), CAST(u % 5 <> 0 AS VARCHAR) FROM (SELECT DISTINCT user_id AS u FROM e)
 WHERE (u % 5 <> 0) <> (u IN (SELECT user_id FROM ons))""")
def c18(spark, d):
    seq = read(spark, d, "events").select(F.col("user_id").alias("sequence_index")).distinct().withColumn(
        "is_fall", F.col("sequence_index") % 5 != 0)
    return C.event_pairing(_annotations(spark, d), seq)


@query("j05_annotation_sequences", _PAIR + """, x AS (
 SELECT user_id AS sequence_index, 'activity' AS kind, s AS start_sample, t AS stop_sample, CAST(code AS VARCHAR) AS code, 0 AS rank FROM act
 UNION ALL SELECT user_id, 'onset', s, s, CAST(code AS VARCHAR), 1 FROM ons UNION ALL SELECT user_id, 'impact', pt, pt, CAST(code AS VARCHAR), 2 FROM imp),
q AS (SELECT user_id AS sequence_index, min(us)//1000000 AS zero FROM e GROUP BY user_id)
SELECT sequence_index, kind, start_sample - zero AS start_sample, stop_sample - zero AS stop_sample, code,
 row_number() OVER (PARTITION BY sequence_index ORDER BY start_sample, rank, stop_sample, code) - 1 AS ordinal FROM x JOIN q USING (sequence_index)""")
def j05(spark, d):
    """Annotations made local to their sequence, numbered in canonical order."""
    zero = signal(spark, d).groupBy(F.col("user_id").alias("sequence_index")).agg(
        F.floor(F.min("us") / 1_000_000).alias("zero"))
    return J.sequence_annotations(_annotations(spark, d), zero, sequence="sequence_index", zero="zero")


@query("j06_impacts_in_activities", _PAIR + """
SELECT imp.user_id, imp.code, pt, s AS start_sample, t AS stop_sample FROM imp JOIN act
 ON imp.user_id = act.user_id AND imp.code = act.code AND pt > s AND pt < t""")
def j06(spark, d):
    ann = _annotations(spark, d).withColumnRenamed("sequence_index", "user_id").withColumn("code", F.col("code").cast("bigint"))
    acts = ann.where("kind = 'activity'").select("user_id", "code", "start_sample", "stop_sample")
    imps = ann.where("kind = 'impact'").select("user_id", "code", F.col("start_sample").alias("pt"))
    return points_in_intervals(imps, acts, ["user_id", "code"], point="pt", start="start_sample",
                               stop="stop_sample", width=60_000)


@query("j06_containing_counts", _PAIR + """
SELECT user_id, code, pt, CAST(count(s) AS BIGINT) AS n_containing FROM (
 SELECT imp.*, act.s FROM (SELECT *, row_number() OVER () AS id FROM imp) imp LEFT JOIN act
 ON imp.user_id = act.user_id AND imp.code = act.code AND pt > s AND pt < t) GROUP BY user_id, code, pt, id""")
def j06_counts(spark, d):
    ann = _annotations(spark, d).withColumnRenamed("sequence_index", "user_id").withColumn("code", F.col("code").cast("bigint"))
    acts = ann.where("kind = 'activity'").select("user_id", "code", "start_sample", "stop_sample")
    imps = ann.where("kind = 'impact'").select("user_id", "code", F.col("start_sample").alias("pt"))
    return containing_counts(imps, acts, ["user_id", "code"], point="pt", start="start_sample", stop="stop_sample")


@query("j07_containment", """
WITH r AS (SELECT o_custkey, min(epoch_us(o_orderdate)) AS t0, max(epoch_us(o_orderdate)) AS t1 FROM orders GROUP BY o_custkey)
SELECT o_orderkey, z BETWEEN t0 AND t1 AND z + (n-1)*40000000000 <= t1 AS enveloped FROM (
 SELECT o_orderkey, o_custkey, epoch_us(o_orderdate) AS z, CAST(floor(o_totalprice) AS BIGINT) % 900 + 1 AS n FROM orders) JOIN r USING (o_custkey)""")
def j07(spark, d):
    """Sample range [zero, zero + (length-1) * period] inside its record."""
    from strideframe.operators.joins import envelope
    from strideframe.sources.tables import micros
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", micros(F.col("o_orderdate")).alias("zero"),
                                        (F.floor("o_totalprice") % 900 + 1).alias("length"))
    out = envelope(o, o, record="o_custkey", time="zero", zero="zero", length="length", period=40_000_000_000)
    return out.select("o_orderkey", "enveloped")


# Fixed taxonomy.
CATALOG = [("tax0", "v1", "en", "english", False), ("tax0", "v1", "de", "german", False), ("tax0", "v1", "fr", "french", True),
           ("tax1", "v1", "en", "english", False), ("tax1", "v1", "es", "spanish", True), ("tax2", "v1", "fr", "french", False),
           ("tax2", "v1", "en", "english", True)]
_CAT = ("cat(taxonomy_id, taxonomy_version, code, name, is_fall) AS (VALUES "
        + ", ".join(f"('{a}', '{b}', '{c}', '{n}', {str(f).lower()})" for a, b, c, n, f in CATALOG) + ")")


def _catalog(spark):
    return literal_rows(spark, CATALOG, "taxonomy_id string, taxonomy_version string, code string, name string, is_fall boolean")


_TAX = "WITH " + _CAT + """, s AS (SELECT d.doc_id, 'tax' || d.doc_id % 3 AS taxonomy_id, CASE WHEN d.doc_id % 11 = 0 THEN 'v2' ELSE 'v1' END AS taxonomy_version,
 lang AS code, CASE d.doc_id % 4 WHEN 0 THEN 'recording' WHEN 1 THEN 'activity' WHEN 2 THEN 'onset' ELSE 'impact' END AS kind,
 coalesce(toxic, 0) = 1 AS is_fall FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
x AS (SELECT s.*, c.is_fall AS code_is_fall, c.name IS NOT NULL AS resolved FROM s LEFT JOIN cat c USING (taxonomy_id, taxonomy_version, code))"""


def _taxonomy_rows(spark, d):
    i = F.col("doc_id")
    return read(spark, d, "documents").join(read(spark, d, "labels"), "doc_id", "left").select(
        "doc_id", F.concat(F.lit("tax"), (i % 3).cast("string")).alias("taxonomy_id"),
        F.when(i % 11 == 0, "v2").otherwise("v1").alias("taxonomy_version"), F.col("lang").alias("code"),
        F.when(i % 4 == 0, "recording").when(i % 4 == 1, "activity").when(i % 4 == 2, "onset").otherwise("impact").alias("kind"),
        (F.coalesce("toxic", F.lit(0)) == 1).alias("is_fall"))


@query("c19_taxonomy_rules", _TAX + """
SELECT 'unresolved-code' AS rule, CAST(doc_id AS VARCHAR) AS key, code AS detail FROM x WHERE NOT resolved
UNION ALL SELECT 'fall-kind', CAST(doc_id AS VARCHAR), kind FROM x WHERE kind IN ('onset', 'impact') AND resolved AND NOT code_is_fall
UNION ALL SELECT 'recording-flag', CAST(doc_id AS VARCHAR), code FROM x WHERE kind = 'recording' AND resolved AND code_is_fall <> is_fall""")
def c19(spark, d):
    return C.taxonomy_rules(_taxonomy_rows(spark, d), _catalog(spark), key="doc_id")


@query("j09_taxonomy_lookup", _TAX + " SELECT doc_id, taxonomy_id, code, resolved, code_is_fall FROM x")
def j09(spark, d):
    out = C.taxonomy_lookup(_taxonomy_rows(spark, d), _catalog(spark))
    return out.select("doc_id", "taxonomy_id", "code", "resolved", "code_is_fall")


@query("c20_sparse_index", """
WITH c AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem WHERE l_linenumber = 3 GROUP BY 1),
p AS (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus <> 'P')
SELECT 'duplicate-index' AS rule, CAST(k AS VARCHAR) AS key, CAST(n AS VARCHAR) AS detail FROM c WHERE n > 1
UNION ALL SELECT 'index-range', CAST(k AS VARCHAR), CAST(k AS VARCHAR) FROM c, (SELECT max(o_orderkey) * 93 // 100 AS top FROM orders) WHERE k >= top
UNION ALL SELECT 'payload-missing', CAST(k AS VARCHAR), '' FROM c WHERE k NOT IN (SELECT k FROM p)
UNION ALL SELECT 'payload-extra', CAST(k AS VARCHAR), '' FROM p WHERE k NOT IN (SELECT k FROM c)""")
def c20(spark, d):
    index = read(spark, d, "lineitem").where("l_linenumber = 3").select(F.col("l_orderkey").alias("k"))
    payload = read(spark, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k"))
    limit = read(spark, d, "orders").agg(F.floor(F.max("o_orderkey") * 93 / 100)).first()[0]
    return C.sparse_index(index, payload, key="k", limit=limit)


@query("c21_overlapping_ranges", """
WITH r AS (SELECT o_orderkey, o_orderkey*800 AS a, o_orderkey*800 + CAST(floor(o_totalprice) AS BIGINT)//500 AS b FROM orders)
SELECT 'overlap' AS rule, CAST(o_orderkey AS VARCHAR) AS key, CAST(n AS VARCHAR) AS detail FROM (
 SELECT *, lead(a) OVER (ORDER BY a, b, o_orderkey) AS n FROM r) WHERE n < b""")
def c21(spark, d):
    k = F.col("o_orderkey") * 800
    r = read(spark, d, "orders").select(
        "o_orderkey", k.alias("a"), (k + F.floor(F.floor("o_totalprice") / 500)).alias("b"))
    return C.overlapping_ranges(r, key="o_orderkey", start="a", stop="b")


@query("c23_provenance_rules", """
WITH s AS (SELECT doc_id, CASE WHEN quality = 0 THEN 'synthetic' ELSE 'real' END AS source_kind, toxic FROM labels),
x AS (SELECT d.doc_id, s.source_kind, s.toxic, CASE WHEN lang = 'en' THEN 'training_only' ELSE 'cross_validation' END AS role
 FROM documents d LEFT JOIN s USING (doc_id))
SELECT 'provenance-missing' AS rule, CAST(doc_id AS VARCHAR) AS key, '' AS detail FROM x WHERE source_kind IS NULL
UNION ALL SELECT 'synthetic-leakage', CAST(doc_id AS VARCHAR), role FROM x WHERE source_kind = 'synthetic' AND role <> 'training_only'
UNION ALL SELECT 'group-keys', CAST(doc_id AS VARCHAR), '0' FROM x WHERE source_kind = 'synthetic' AND toxic = 1""")
def c23(spark, d):
    seq = read(spark, d, "documents").select("doc_id", F.when(F.col("lang") == "en", "training_only").otherwise(
        "cross_validation").alias("evaluation_role"))
    src = read(spark, d, "labels").select(
        "doc_id", F.when(F.col("quality") == 0, "synthetic").otherwise("real").alias("source_kind"),
        F.when(F.col("toxic") == 1, F.array().cast("array<string>")).otherwise(F.array(F.lit("subject"))).alias("group_keys"))
    return C.provenance_rules(seq, src, key="doc_id")


@query("c24_snapshot_rules", """
WITH s AS (SELECT CASE WHEN o_orderkey % 40 = 0 THEN 'other/' ELSE 'snapshots/' END || o_orderkey AS k,
 CAST(floor(o_totalprice) AS BIGINT) AS b, CASE WHEN o_orderkey % 60 = 0 THEN '' ELSE sha256(CAST(o_orderkey AS VARCHAR)) END AS h FROM orders)
SELECT 'included-and-excluded' AS rule, CAST(o_orderkey AS VARCHAR) AS key, '' AS detail FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 10 = 0
UNION ALL SELECT 'shard-size', k, CAST(b AS VARCHAR) FROM s WHERE b > 400000
UNION ALL SELECT 'shard-prefix', k, 'snapshots/' FROM s WHERE NOT starts_with(k, 'snapshots/')
UNION ALL SELECT 'shard-digest', k, '' FROM s WHERE h = ''""")
def c24(spark, d):
    o = read(spark, d, "orders")
    k = F.col("o_orderkey")
    shards = o.select(
        F.concat(F.when(k % 40 == 0, "other/").otherwise("snapshots/"), k.cast("string")).alias("object_key"),
        F.floor("o_totalprice").alias("byte_length"),
        F.when(k % 60 == 0, "").otherwise(F.sha2(k.cast("string"), 256)).alias("sha256"))
    return C.snapshot_rules(o.where("o_orderstatus = 'F'"), o.where("o_orderkey % 10 = 0"), shards, key="o_orderkey",
                            prefix="snapshots/", max_bytes=400_000)


_RULES = """WITH r AS (SELECT p_partkey, CASE WHEN p_partkey % 50 = 0 THEN '' ELSE 'rule-' || p_partkey // 2 END AS rule_id,
 CASE p_size % 4 WHEN 0 THEN 'babel-1.0' WHEN 1 THEN 'source-member-token' WHEN 2 THEN 'stageii-source-member' ELSE 'manual' END AS origin,
 CASE p_size % 4 WHEN 0 THEN 'catset:' || replace(p_name, ' ', '|') WHEN 1 THEN split_part(p_name, ' ', 1) ELSE p_name END AS v,
 CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_brand END AS ds, CASE WHEN p_size > 45 THEN p_type ELSE replace(p_name, ' ', '_') END AS target,
 p_size = 7 AS is_fall FROM part)"""


@query("c25_rule_set", _RULES + """
, k AS (SELECT *, split(substr(v, 8), '|') AS c FROM r)
SELECT 'rule-id' AS rule, rule_id AS key, '' AS detail FROM r WHERE rule_id = ''
UNION ALL SELECT 'origin', rule_id, origin FROM r WHERE origin = 'manual'
UNION ALL SELECT 'target', rule_id, target FROM r WHERE is_fall OR NOT regexp_matches(target, '^[a-z][a-z0-9_]*$')
UNION ALL SELECT 'token', rule_id, v FROM r WHERE origin = 'source-member-token' AND (ds IS NULL OR NOT regexp_matches(v, '^[a-z]+$'))
UNION ALL SELECT 'category-set', rule_id, v FROM k WHERE origin = 'babel-1.0' AND list_sort(list_distinct(c)) <> c
UNION ALL SELECT 'duplicate-id', rule_id, CAST(count(*) AS VARCHAR) FROM r GROUP BY rule_id HAVING count(*) > 1
UNION ALL SELECT 'duplicate-identity', origin || '/' || v || '/' || coalesce(ds, '*'), CAST(count(*) AS VARCHAR) FROM r
 GROUP BY origin, v, coalesce(ds, '*') HAVING count(*) > 1""")
def c25(spark, d):
    p = read(spark, d, "part")
    size, name = F.col("p_size") % 4, F.col("p_name")
    rules = p.select(
        F.when(F.col("p_partkey") % 50 == 0, "").otherwise(F.concat(F.lit("rule-"), F.floor(F.col("p_partkey") / 2).cast("string"))).alias("rule_id"),
        F.when(size == 0, "babel-1.0").when(size == 1, "source-member-token").when(size == 2, "stageii-source-member").otherwise("manual").alias("origin"),
        F.when(size == 0, F.concat(F.lit("catset:"), F.replace(name, F.lit(" "), F.lit("|")))).when(size == 1, F.split_part(name, F.lit(" "), F.lit(1))).otherwise(name).alias("source_value"),
        F.when(F.col("p_size") % 3 != 0, F.col("p_brand")).alias("source_dataset"),
        F.when(F.col("p_size") > 45, F.col("p_type")).otherwise(F.replace(name, F.lit(" "), F.lit("_"))).alias("target_code"),
        (F.col("p_size") == 7).alias("is_fall"), F.lit(2).alias("revision"))
    return C.rule_set(rules)


@query("c26_preset_rules", """
WITH f AS (SELECT p_partkey, CASE WHEN p_size = 5 THEN 'trip_' || p_partkey WHEN p_size = 6 THEN p_type ELSE lower(p_type) || '_' || p_size END AS code,
 CASE WHEN p_partkey % 90 = 0 THEN [] WHEN p_partkey % 30 = 0 THEN [p_name, p_name] ELSE [p_name || ' ' || p_partkey // 3] END AS a,
 CASE WHEN p_partkey % 45 = 0 THEN [p_name] ELSE ['none'] END AS m FROM part)
SELECT 'code' AS rule, code AS key, code AS detail FROM f WHERE NOT regexp_matches(code, '^[a-z][a-z0-9_]*$') OR contains(code, 'trip')
UNION ALL SELECT 'aliases', code, code FROM f WHERE len(a) = 0 OR len(list_distinct(a)) <> len(a)
UNION ALL SELECT 'own-modifier', code, code FROM f WHERE list_has_any(a, m)
UNION ALL SELECT 'alias-overlap', x, CAST(count(*) AS VARCHAR) FROM (SELECT unnest(list_distinct(a)) AS x FROM f) GROUP BY x HAVING count(*) > 1
UNION ALL SELECT 'duplicate-code', code, CAST(count(*) AS VARCHAR) FROM f GROUP BY code HAVING count(*) > 1""")
def c26(spark, d):
    k, size, name, kind = F.col("p_partkey"), F.col("p_size"), F.col("p_name"), F.col("p_type")
    empty = F.array().cast("array<string>")
    fam = read(spark, d, "part").select(
        F.when(size == 5, F.concat(F.lit("trip_"), k.cast("string"))).when(size == 6, kind).otherwise(
            F.concat(F.lower(kind), F.lit("_"), size.cast("string"))).alias("code"),
        F.when(k % 90 == 0, empty).when(k % 30 == 0, F.array(name, name)).otherwise(
            F.array(F.concat(name, F.lit(" "), F.floor(k / 3).cast("string")))).alias("aliases"),
        F.when(k % 45 == 0, F.array(name)).otherwise(F.array(F.lit("none"))).alias("modifiers"))
    return C.preset_rules(fam)


@query("c27_lineage_closure", """
WITH r AS (SELECT DISTINCT sha256(CAST(l_orderkey AS VARCHAR)) AS h, CAST(l_linenumber % 3 AS VARCHAR) AS want FROM lineitem WHERE l_linenumber IN (1, 4)),
o AS (SELECT sha256(CAST(o_orderkey AS VARCHAR)) AS h, CAST(o_custkey % 3 AS VARCHAR) AS role FROM orders WHERE o_orderkey % 8 > 0),
j AS (SELECT coalesce(r.h, o.h) AS h, want, role FROM r FULL JOIN o ON r.h = o.h)
SELECT CASE WHEN role IS NULL THEN 'unresolved-reference' WHEN want IS NULL THEN 'unreferenced-object' ELSE 'object-role' END AS rule,
 h AS key, coalesce(want, '') AS detail FROM j WHERE role IS NULL OR want IS NULL OR role <> want""")
def c27(spark, d):
    refs = read(spark, d, "lineitem").where(F.col("l_linenumber").isin(1, 4)).select(
        F.sha2(F.col("l_orderkey").cast("string"), 256).alias("sha256"), (F.col("l_linenumber") % 3).cast("string").alias("role"))
    objs = read(spark, d, "orders").where("o_orderkey % 8 > 0").select(
        F.sha2(F.col("o_orderkey").cast("string"), 256).alias("sha256"), (F.col("o_custkey") % 3).cast("string").alias("role"))
    return C.lineage_closure(refs, objs, digest="sha256")


_STATES = """WITH m AS (SELECT page_id, strlen(html) AS b, sha256(html) AS h FROM pages),
s AS (SELECT m.page_id, CASE WHEN page_id % 7 = 0 THEN 'missing' WHEN page_id % 13 = 0 THEN 'partial' WHEN page_id % 17 = 0 THEN 'unreceipted_final'
 WHEN page_id % 5 = 0 THEN 'size_mismatch' WHEN page_id % 11 = 0 THEN 'hash_mismatch' ELSE 'verified' END AS state FROM m)"""


def _receipts(spark, d):
    i = F.col("page_id")
    m = read(spark, d, "pages").select("page_id", F.octet_length("html").cast("bigint").alias("bytes"), F.sha2("html", 256).alias("sha256"))
    listing = m.where(i % 7 != 0).select(
        "page_id", F.when(i % 5 == 0, F.col("bytes") + 1).otherwise(F.col("bytes")).alias("bytes"),
        F.when(i % 11 == 0, F.sha2("sha256", 256)).otherwise(F.col("sha256")).alias("sha256"), (i % 13 == 0).alias("is_partial"))
    return C.receipt_states(m, listing, m.where(i % 17 != 0), key="page_id")


@query("c28_receipt_states", _STATES + " SELECT page_id, state FROM s")
def c28(spark, d):
    return _receipts(spark, d)


@query("a24_state_histogram", _STATES + " SELECT state, count(*) AS files FROM s GROUP BY state")
def a24(spark, d):
    return C.state_histogram(_receipts(spark, d))


@query("c29_quality_flags", E + """
, f AS (SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN 'other' ELSE 'source-fit-temporal-discontinuity' END AS code,
 CASE WHEN event_id % 20 = 0 THEN 'blocking' ELSE 'advisory' END AS disposition, event_id % 100 AS a, event_id % 100 + event_id % 7 AS b,
 CASE event_id % 6 WHEN 0 THEN 'tail' WHEN 1 THEN '' ELSE 'left_knee,head' END AS j FROM e)
SELECT 'flag-code' AS rule, CAST(event_id AS VARCHAR) AS key, code AS detail FROM f WHERE code = 'other'
UNION ALL SELECT 'flag-disposition', CAST(event_id AS VARCHAR), disposition FROM f WHERE disposition = 'blocking'
UNION ALL SELECT 'flag-range', CAST(event_id AS VARCHAR), CAST(a AS VARCHAR) FROM f WHERE NOT (10 <= a AND a < b AND b <= 95)
UNION ALL SELECT 'flag-joints', CAST(event_id AS VARCHAR), j FROM f WHERE j IN ('tail', '')
UNION ALL SELECT 'flag-duplicate', user_id || '/' || code || '/' || a || '/' || b, CAST(count(*) AS VARCHAR) FROM f GROUP BY user_id, code, a, b HAVING count(*) > 1""")
def c29(spark, d):
    i = F.col("event_id")
    joints = (F.when(i % 6 == 0, F.array(F.lit("tail"))).when(i % 6 == 1, F.array().cast("array<string>"))
              .otherwise(F.array(F.lit("left_knee"), F.lit("head"))))
    flags = signal(spark, d).select(
        "event_id", F.col("user_id").alias("clip_id"),
        F.when(F.col("event_type") == "error", "other").otherwise("source-fit-temporal-discontinuity").alias("code"),
        F.when(i % 20 == 0, "blocking").otherwise("advisory").alias("disposition"), (i % 100).alias("range_start"),
        (i % 100 + i % 7).alias("range_stop"), F.lit(10).alias("reviewed_start"), F.lit(95).alias("reviewed_stop"), joints.alias("joints"))
    return C.quality_flags(flags, key="event_id", joints=["pelvis", "left_knee", "right_knee", "head"])


@query("c30_checkpoint_chain", """
WITH e AS (SELECT o_orderkey + 1 AS entry, o_orderkey // 100 + 1 AS shard FROM orders WHERE o_orderkey % 777 <> 0),
c AS (SELECT shard AS ordinal, CASE WHEN shard % 20 = 0 THEN max(entry) - 1 ELSE max(entry) END AS b,
 CASE WHEN shard % 30 = 0 THEN min(entry) + 1 ELSE min(entry) END AS a FROM e WHERE shard <> 44 GROUP BY shard),
n AS (SELECT *, lag(b, 1, 0) OVER (ORDER BY ordinal) AS p, row_number() OVER (ORDER BY ordinal) AS r FROM c),
s AS (SELECT shard, min(entry) AS lo, max(entry) AS hi, count(*) AS n FROM e GROUP BY shard)
SELECT 'ordinal' AS rule, CAST(ordinal AS VARCHAR) AS key, CAST(ordinal AS VARCHAR) AS detail FROM n WHERE ordinal <> r
UNION ALL SELECT 'start', CAST(ordinal AS VARCHAR), CAST(a AS VARCHAR) FROM n WHERE a <> p + 1
UNION ALL SELECT 'range', CAST(ordinal AS VARCHAR), CAST(b AS VARCHAR) FROM n WHERE b < a
UNION ALL SELECT 'entries', CAST(ordinal AS VARCHAR), CAST(coalesce(n, 0) AS VARCHAR) FROM c LEFT JOIN s ON ordinal = shard
 WHERE n IS NULL OR NOT (lo = a AND hi = b AND n = b - a + 1)""")
def c30(spark, d):
    k = F.col("o_orderkey")
    e = read(spark, d, "orders").where(k % 777 != 0).select((k + 1).alias("entry"), (F.floor(k / 100) + 1).alias("shard"))
    s = F.col("shard")
    c = e.where(s != 44).groupBy("shard").agg(F.min("entry").alias("lo"), F.max("entry").alias("hi")).select(
        s.alias("ordinal"), F.when(s % 20 == 0, F.col("hi") - 1).otherwise(F.col("hi")).alias("stop_ordinal"),
        F.when(s % 30 == 0, F.col("lo") + 1).otherwise(F.col("lo")).alias("start_ordinal"))
    return C.checkpoint_chain(c, e)


@query("c31_accepted_gate", """
WITH l AS (SELECT conv_id, arg_max(role, turn) AS role, arg_max(text, turn) AS text, max(turn) AS turn FROM conversations GROUP BY conv_id),
x AS (SELECT conv_id, CASE WHEN role = 'assistant' THEN 'accepted' ELSE 'rejected' END AS decision, conv_id % 9 <> 0 AS qa, role,
 regexp_extract(text, '^\\S+\\.', 0) AS reason,
 list_distinct(list_filter([CASE WHEN contains(text, 'the') THEN 'walk' ELSE '' END, CASE WHEN contains(text, 'qu') THEN 'run' ELSE '' END], lambda y: length(y) > 0)) AS codes FROM l)
SELECT 'not-accepted' AS rule, CAST(conv_id AS VARCHAR) AS key, decision AS detail FROM x WHERE decision <> 'accepted'
UNION ALL SELECT 'qa-not-passed', CAST(conv_id AS VARCHAR), '' FROM x WHERE NOT qa
UNION ALL SELECT 'reason', CAST(conv_id AS VARCHAR), '' FROM x WHERE reason = ''
UNION ALL SELECT 'single-label', CAST(conv_id AS VARCHAR), CAST(len(codes) AS VARCHAR) FROM x WHERE len(codes) <> 1""")
def c31(spark, d):
    from strideframe.operators.review import latest_revision
    last = latest_revision(read(spark, d, "conversations"), keys=["conv_id"], revision="turn")
    word = lambda needle, code: F.when(F.contains(F.col("text"), F.lit(needle)), code).otherwise("")
    x = last.select(
        "conv_id", F.when(F.col("role") == "assistant", "accepted").otherwise("rejected").alias("decision"),
        (F.col("conv_id") % 9 != 0).alias("qa_passed"), F.col("role").alias("reviewer"),
        F.regexp_extract("text", r"^\S+\.", 0).alias("reason"), F.array(word("the", "walk"), word("qu", "run")).alias("codes"))
    return C.accepted_gate(x, key="conv_id")
