"""Weak-label queries: documents stand in for commits, their words for label evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from strideframe.bindings.registry import query
from strideframe.functions.arrays import present
from strideframe.operators import labels as L
from strideframe.plans.barrier import evaluate_once
from strideframe.session import literal_rows, materialise, work_dir
from strideframe.sources.config import load_rules
from strideframe.sources.tables import read

# Fixed words of the stand-in text and the source category each one stands for.
RECORDED = {"thes": "walk", "thed": "run", "thha": "jump", "thhe": "dance", "des": "sit", "que": "wave",
            "ch": "turn", "thre": "forward movement", "thnt": "stumble"}
TEMPORAL = {"thes": "walk", "thble": "run", "wh": "turn"}
STAGEII_SOURCES = ["src1", "src2"]

_pick = lambda words: ("list_filter([" + ", ".join(
    f"CASE WHEN list_contains(t, '{w}') THEN '{c}' END" for w, c in words.items()) + "], lambda x: x IS NOT NULL)")
COMMITS = f"""WITH tk AS (SELECT *, list_distinct(string_split_regex(lower(text), '[^a-z]+')) AS t,
 coalesce(list_filter(string_split_regex(lower(text), '[^a-z]+'), lambda x: x <> '')[1], 'x') AS first FROM documents),
cm AS (SELECT doc_id, source, lang, first, {_pick(RECORDED)} AS rc, {_pick(TEMPORAL)} AS tc,
 source IN ('src1', 'src2') AS s2, source || '/' || lang || '/' || first || '_' || doc_id || '_poses.npz' AS member FROM tk),
c AS (SELECT *, CASE WHEN doc_id % 5 = 0 THEN NULL WHEN len(rc) > 0 THEN rc[1] WHEN doc_id % 3 = 0 THEN 'none' WHEN doc_id % 3 = 1 THEN 'Sneak' ELSE 'wander' END AS rcode FROM cm),
f AS (SELECT doc_id, source, lang, member, rc, tc, s2, rcode, first,
 list_sort(CASE WHEN rcode IS NULL OR s2 THEN [] ELSE rc END) AS cats, list_sort(tc) AS tmp,
 CASE WHEN rcode IS NULL OR s2 THEN [] ELSE [lower(rcode)] END AS codes, CASE WHEN s2 AND rcode IS NOT NULL THEN lower(rcode) END AS s2code,
 (list_contains(rc, 'stumble') AND NOT s2) OR coalesce(regexp_matches(lower(rcode), 'fall|stumble|trip|collapse'), false) AS risk,
 regexp_matches(first || '_' || doc_id, 'fall|stumble|trip|collapse|recovery|push|accident') AS stem_risk,
 list_distinct(regexp_extract_all(first || '_' || doc_id, '[a-z]+')) AS toks FROM c)"""

# Fixed rules of the stand-in: the base mapping and one rule of every other form.
EXTRA = [
    ("set-walk-run", L.BABEL, "catset:run|walk", None, "running", False),
    ("set-walk-turn", L.BABEL, "catset:turn|walk;temporal:turn|walk", None, "contains_walking", False),
    ("set-walk-temporal", L.BABEL, "catset:jump|walk;temporal:walk", None, "contains_walking", False),
    ("set-single", L.BABEL, "catset:walk", "src5", "strolling", False),
    ("code-sneak", L.BABEL, "code:sneak", None, "sneaking", False),
    ("s2-walk", L.STAGEII, "walk", "src1", "walking", False),
    ("s2-run", L.STAGEII, "run", None, "running", False),
    ("token-is", L.TOKEN, "is", "src7", "standing", False),
    ("token-and", L.TOKEN, "and", "src8", "walking", False),
    ("token-la", L.TOKEN, "la", "src9", "walking", False),
]
RULES = L.default_rules() + EXTRA


def sql_rules(rows, name="r"):
    lit = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else f"'{v}'"
    return (f"{name}(rule_id, origin, v, ds, target, is_fall) AS (VALUES "
            + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows) + ")")


def decide(rev, rules="r", out="w"):
    """The decision over commits x rules, written as a theta join."""
    veto = "NOT risk AND" if rev >= 2 else ""
    token = ("OR (r.origin = 'source-member-token' AND len(cats) = 0 AND (codes = [] OR codes = ['none']) AND NOT stem_risk AND list_contains(toks, r.v))"
             if rev >= 2 else "")
    agree = "OR (n > 0 AND lo = hi)" if rev >= 2 else ""
    return f"""m{out} AS (SELECT f.doc_id, r.rule_id, r.target, r.ds IS NOT NULL AS spec FROM f JOIN {rules} r ON {veto}
 (r.ds IS NULL OR r.ds = f.source) AND (
 (r.origin = 'babel-1.0' AND starts_with(r.v, 'catset:') AND len(cats) > 0 AND ('catset:' || array_to_string(cats, '|') = r.v AND (len(tmp) = 0 OR tmp = cats)
   OR len(tmp) > 0 AND 'catset:' || array_to_string(cats, '|') || ';temporal:' || array_to_string(tmp, '|') = r.v))
 OR (r.origin = 'babel-1.0' AND starts_with(r.v, 'code:') AND len(cats) = 0 AND len(tmp) = 0 AND len(codes) = 1 AND 'code:' || codes[1] = r.v)
 OR (r.origin = 'babel-1.0' AND NOT starts_with(r.v, 'catset:') AND NOT starts_with(r.v, 'code:') AND cats = [r.v] AND (len(tmp) = 0 OR tmp = cats))
 OR (r.origin = 'stageii-source-member' AND s2code = r.v) {token})),
k{out} AS (SELECT * FROM (SELECT *, max(spec) OVER (PARTITION BY doc_id) AS ms FROM m{out}) WHERE spec = ms),
a{out} AS (SELECT doc_id, count(*) AS n, min(target) AS lo, max(target) AS hi, min(rule_id) AS rid, arg_min(target, rule_id) AS code FROM k{out} GROUP BY doc_id),
{out} AS (SELECT f.doc_id, f.source, CASE WHEN n = 1 {agree} THEN 'weak' ELSE 'unresolved' END AS state,
 CASE WHEN n = 1 {agree} THEN a.code ELSE '' END AS code, CASE WHEN n = 1 {agree} THEN rid ELSE '' END AS rule_id FROM f LEFT JOIN a{out} a USING (doc_id))"""


def commits(spark, d):
    """Documents as commits with one recording and at most one temporal label."""
    words = F.trim(F.regexp_replace(F.lower("text"), "[^a-z]+", " "))
    spaced = F.concat(F.lit(" "), words, F.lit(" "))
    base = evaluate_once(read(spark, d, "documents").select("doc_id", "source", "lang", spaced.alias("t")), "doc_id", "source", "lang")
    pick = lambda vocabulary: present(*[F.when(F.contains(F.col("t"), F.lit(f" {w} ")), c) for w, c in vocabulary.items()])
    first = F.coalesce(F.nullif(F.substring_index(F.ltrim("t"), " ", 1), F.lit("")), F.lit("x"))
    base = base.select("doc_id", "source", "lang", first.alias("first"), pick(RECORDED).alias("rc"), pick(TEMPORAL).alias("tc"))
    i, s2 = F.col("doc_id"), F.col("source").isin(STAGEII_SOURCES)
    code = (F.when(i % 5 == 0, None).when(F.size("rc") > 0, F.get("rc", F.lit(0)))
            .when(i % 3 == 0, "none").when(i % 3 == 1, "Sneak").otherwise("wander"))
    none = F.array().cast("array<string>")
    label = lambda kind, c, origin, cats: F.struct(F.lit(kind).alias("kind"), c.alias("code"), origin.alias("origin"), cats.alias("categories"))
    rec = label("recording-candidate", code, F.when(s2, L.STAGEII).otherwise(L.BABEL), F.when(s2, none).otherwise(F.col("rc")))
    tmp = label("temporal-candidate", F.get("tc", F.lit(0)), F.lit(L.BABEL), F.col("tc"))
    member = F.concat_ws("/", "source", "lang", F.concat("first", F.lit("_"), i.cast("string"), F.lit("_poses.npz")))
    rows = base.select("doc_id", F.col("source").alias("source_dataset"), "lang", "first", member.alias("source_member"),
                       F.when(F.size("tc") > 0, F.array(rec, tmp)).otherwise(F.array(rec)).alias("label_candidates"))
    return evaluate_once(rows, "doc_id", "source_dataset", "lang")


def rules(spark, rows=None):
    return literal_rows(spark, RULES if rows is None else rows, L.RULE_SCHEMA)


def labelled(spark, d, revision=2, rows=None):
    return L.weak_labels(commits(spark, d), rules(spark, rows), key="doc_id", revision=revision)


@query("c04_label_kinds", COMMITS + """
SELECT doc_id, CASE WHEN rcode IS NULL THEN 0 ELSE 1 END AS recording, CASE WHEN len(tc) > 0 THEN 1 ELSE 0 END AS temporal FROM f""")
def c04(spark, d):
    from strideframe.operators.checks import labels_of_kind
    lab = F.col("label_candidates")
    return commits(spark, d).select("doc_id", F.size(labels_of_kind(lab, "recording-candidate")).alias("recording"),
                                    F.size(labels_of_kind(lab, "temporal-candidate")).alias("temporal"))


@query("u06_evidence_sets", COMMITS + """
SELECT doc_id, array_to_string(cats, ',') AS categories, array_to_string(tmp, ',') AS temporal, risk AS has_risk, cats = tmp AS sets_equal,
 len(list_filter(cats, lambda x: x NOT IN ('walk', 'turn', 'forward movement'))) = 0 AS allowed, list_has_any(cats, tmp) AS overlap FROM f""")
def u06(spark, d):
    e = L.evidence(commits(spark, d))
    allowed = F.array(*map(F.lit, ["walk", "turn", "forward movement"]))
    return e.select("doc_id", F.array_join("categories", ",").alias("categories"), F.array_join("temporal", ",").alias("temporal"),
                    "has_risk", (F.col("categories") == F.col("temporal")).alias("sets_equal"),
                    (F.size(F.array_except("categories", allowed)) == 0).alias("allowed"),
                    F.arrays_overlap("categories", "temporal").alias("overlap"))


@query("f12_weak_labels", COMMITS + ", " + sql_rules(RULES) + ", " + decide(2) + " SELECT doc_id, state, code, rule_id FROM w")
def f12(spark, d):
    return labelled(spark, d).select("doc_id", "state", "code", "rule_id")


@query("x04_rules_from_file", COMMITS + ", " + sql_rules(RULES) + ", " + decide(2) + " SELECT doc_id, state, code, rule_id FROM w")
def x04(spark, d):
    """The same labels under rules that were written to and loaded from a versioned document."""
    names = ["rule_id", "origin", "source_value", "source_dataset", "target_code", "is_fall"]
    folder = work_dir(spark, "rules")
    table = rules(spark)
    doc = table.agg(F.lit("weak-rules.v1").alias("schema"), F.lit(2).alias("revision"), F.collect_list(F.struct(*names)).alias("rules"))
    doc.coalesce(1).write.json(folder)
    loaded = load_rules(spark, folder).select(*table.columns)
    return L.weak_labels(commits(spark, d), loaded, key="doc_id", revision=2).select("doc_id", "state", "code", "rule_id")


@query("f12_weak_labels_revision_1", COMMITS + ", " + sql_rules(RULES) + ", " + decide(1) + " SELECT doc_id, state, code, rule_id FROM w")
def f12_one(spark, d):
    return labelled(spark, d, revision=1).select("doc_id", "state", "code", "rule_id")


@query("j12_rule_matches", COMMITS + ", " + sql_rules(RULES) + ", " + decide(2) + " SELECT doc_id, rule_id, target AS target_code, spec AS specific FROM mw")
def j12(spark, d):
    return L.matching_rules(L.evidence(commits(spark, d)), rules(spark), key="doc_id", revision=2)


@query("j13_specific_rules", COMMITS + ", " + sql_rules(RULES) + ", " + decide(2) + " SELECT doc_id, rule_id FROM kw")
def j13(spark, d):
    m = L.matching_rules(L.evidence(commits(spark, d)), rules(spark), key="doc_id", revision=2)
    top = m.groupBy("doc_id").agg(F.max("specific").alias("_top"))
    return m.join(top, "doc_id").where("specific = _top").select("doc_id", "rule_id")


# Fixed preset vocabulary of the stand-in (a subset in the published format).
FAMILIES = [("walking", ["walk"], ["forward movement", "turn"]), ("running", ["run", "jog"], ["forward movement", "turn"]),
            ("jumping", ["jump", "hop"], ["exercise/training"]), ("dancing", ["dance"], ["turn", "circular movement"]),
            ("sitting", ["sit"], []), ("waving", ["wave"], ["gesture"]), ("turning", ["turn"], ["forward movement"])]
CODES = [("sneak", "sneaking"), ("wander", "walking")]
STAGEII = [("src1", "jump", "jumping"), ("src1", "dance", "dancing"), ("src1", "none", "idle")]
TOKENS = [("standing", "is"), ("walking", "and"), ("walking", "la"), ("sitting", "die")]

_arr = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]::VARCHAR[]"
_PRE = (f"fam(code, al, mo) AS (VALUES {', '.join(f'({chr(39)}{c}{chr(39)}, {_arr(a)}, {_arr(m)})' for c, a, m in FAMILIES)}), "
        f"cod(s, t) AS (VALUES {', '.join(str(x) for x in CODES)}), s2(ds, s, t) AS (VALUES {', '.join(str(x) for x in STAGEII)}), "
        f"tok(t, w) AS (VALUES {', '.join(str(x) for x in TOKENS)})")
_COMPILE = COMMITS + ", " + sql_rules(L.default_rules()) + ", " + decide(2) + ", " + _PRE + """,
o AS (SELECT f.*, f.source IN (SELECT ds FROM s2) AS mapped FROM f JOIN w USING (doc_id) WHERE w.state = 'unresolved' AND NOT risk),
g1 AS (SELECT DISTINCT 'stageii-source-member' AS origin, s2code AS v, source AS ds, s2.t AS target FROM o JOIN s2 ON s2.ds = source AND s2.s = s2code),
oc AS (SELECT doc_id, codes[1] AS s, cod.t FROM o JOIN cod ON cod.s = codes[1] WHERE NOT mapped AND len(cats) = 0 AND len(tmp) = 0 AND len(codes) = 1),
g2 AS (SELECT DISTINCT 'babel-1.0' AS origin, 'code:' || s AS v, NULL AS ds, t AS target FROM oc),
g3 AS (SELECT DISTINCT 'source-member-token' AS origin, w AS v, source AS ds, t AS target FROM (
 SELECT source, min(tok.t) AS t, max(tok.t) AS hi, min(tok.w) AS w FROM o, tok WHERE NOT mapped AND len(cats) = 0 AND NOT stem_risk
 AND (codes = [] OR codes = ['none']) AND doc_id NOT IN (SELECT doc_id FROM oc) AND list_contains(toks, tok.w) GROUP BY doc_id, source) WHERE t = hi),
st AS (SELECT DISTINCT cats, tmp FROM o WHERE NOT mapped AND len(cats) > 0),
fit AS (SELECT cats, tmp, count(*) AS n, min(code) AS code, any_value(al) AS al FROM st, fam WHERE list_has_any(cats, al)
 AND list_has_all(list_concat(al, mo), cats) GROUP BY cats, tmp HAVING count(*) = 1),
g4 AS (SELECT 'babel-1.0' AS origin, 'catset:' || array_to_string(cats, '|') || CASE WHEN len(tmp) = 0 OR tmp = cats THEN '' ELSE ';temporal:' || array_to_string(tmp, '|') END AS v,
 NULL AS ds, CASE WHEN len(tmp) = 0 OR tmp = cats THEN code ELSE 'contains_' || code END AS target FROM fit WHERE len(tmp) = 0 OR tmp = cats OR list_has_any(tmp, al)),
g AS (SELECT DISTINCT * FROM (FROM g1 UNION ALL FROM g2 UNION ALL FROM g3 UNION ALL FROM g4)),
cr AS (SELECT rule_id, origin, v, ds, target, is_fall FROM r UNION ALL
 SELECT 'local-preset-' || substr(sha256('["' || origin || '","' || v || '",' || coalesce('"' || ds || '"', 'null') || ']' || chr(10)), 1, 12),
 origin, v, ds, target, false FROM g)"""


def _compiled(spark, d, stored=None):
    """Commits are read several times, so they are a stored table here."""
    stored = materialise(commits(spark, d), "commits") if stored is None else stored
    return L.compile_rules(
        stored, base=rules(spark, L.default_rules()), key="doc_id",
        families=literal_rows(spark, FAMILIES, "code string, aliases array<string>, modifiers array<string>"),
        codes=literal_rows(spark, CODES, "source string, target string"),
        stageii=literal_rows(spark, STAGEII, "dataset string, source string, target string"),
        tokens=literal_rows(spark, TOKENS, "target string, token string"))


@query("f13_compile_rules", _COMPILE + """
SELECT rule_id, origin, v AS source_value, coalesce(ds, '*') AS source_dataset, target AS target_code FROM cr""")
def f13(spark, d):
    return _compiled(spark, d).select("rule_id", "origin", "source_value", F.coalesce("source_dataset", F.lit("*")).alias("source_dataset"), "target_code")


@query("a21_coverage_report", _COMPILE + ", " + decide(2, "cr", "x") + ", " + decide(1, "r", "y") + """,
l AS (SELECT 'compiled' AS rules, source, state, code FROM x UNION ALL SELECT 'base', source, state, code FROM y)
SELECT rules, coalesce(source, '*') AS source_dataset, coalesce(state, '*') AS state, coalesce(code, '*') AS code, count(*) AS commits,
 count(*) FILTER (WHERE l.state = 'weak') AS weak FROM l GROUP BY GROUPING SETS ((rules), (rules, source), (rules, source, state), (rules, state, code))""")
def a21(spark, d):
    stored = materialise(commits(spark, d), "commits")
    compiled = materialise(_compiled(spark, d, stored), "rules")
    x = L.weak_labels(stored, compiled, key="doc_id", revision=2)
    base = L.weak_labels(stored, rules(spark, L.default_rules()), key="doc_id", revision=1)
    out = L.coverage_report(x, base, source="source_dataset")
    star = [F.coalesce(c, F.lit("*")).alias(c) for c in ("source_dataset", "state", "code")]
    return out.select("rules", *star, "commits", "weak")


@query("a12_export_counts", COMMITS + ", " + sql_rules(RULES) + ", " + decide(2) + """
SELECT count(*) AS candidates, count(*) * 3 AS sequences, CAST(sum(n_chars) AS BIGINT) AS samples, round(sum(n_chars) / (25.0 * 3), 6) AS seconds,
 count(*) FILTER (WHERE state = 'weak') AS weak, count(*) FILTER (WHERE state = 'unresolved') AS unresolved FROM w JOIN documents USING (doc_id)""")
def a12(spark, d):
    from strideframe.operators.delivery import export_counts
    rows = labelled(spark, d).join(read(spark, d, "documents").select("doc_id", F.col("n_chars").alias("samples")), "doc_id")
    return export_counts(rows, samples="samples", rate_hz=25.0, mounts=3)


@query("j24_frozen_rule_check", COMMITS + ", " + sql_rules(RULES) + ", " + decide(2) + """
SELECT 'rule-target' AS rule, CAST(doc_id AS VARCHAR) AS key, rule_id AS detail FROM w WHERE state = 'weak' AND doc_id % 6 = 0""")
def j24(spark, d):
    w = labelled(spark, d).withColumn("code", F.when(F.col("doc_id") % 6 == 0, F.lit("other")).otherwise(F.col("code")))
    return L.frozen_rule_check(w, rules(spark), key="doc_id")


@query("c22_provisional_rules", COMMITS + ", " + sql_rules(RULES) + ", " + decide(2) + """
SELECT 'label-state' AS rule, CAST(doc_id AS VARCHAR) AS key, 'unresolved' AS detail FROM w WHERE doc_id % 10 = 0 AND state = 'weak'
UNION ALL SELECT 'core-code', CAST(doc_id AS VARCHAR), 'walking' FROM w WHERE doc_id % 15 = 0
UNION ALL SELECT 'core-fall', CAST(w.doc_id AS VARCHAR), 'true' FROM w JOIN labels ON w.doc_id = labels.doc_id WHERE toxic = 1
UNION ALL SELECT 'annotation', CAST(doc_id AS VARCHAR), 'x' FROM labels WHERE quality = 0
UNION ALL SELECT 'raw-label', CAST(doc_id AS VARCHAR), '0' FROM w WHERE doc_id % 25 = 0""")
def c22(spark, d):
    i = F.col("doc_id")
    toxic = read(spark, d, "labels").select("doc_id", "toxic")
    w = labelled(spark, d).join(toxic, "doc_id", "left").select(
        "doc_id", F.when(i % 10 == 0, "unresolved").otherwise(F.col("state")).alias("state"), "code", "rule_id",
        F.when(i % 15 == 0, "walking").otherwise("unverified").alias("activity_code"), (F.coalesce("toxic", F.lit(0)) == 1).alias("is_fall"))
    ann = read(spark, d, "labels").where("quality = 0").select("doc_id", F.lit("x").alias("code"))
    raw = read(spark, d, "documents").where("doc_id % 25 <> 0").select("doc_id")
    return L.provisional_rules(w, rules(spark), ann, raw, key="doc_id")


@query("a27_recording_codes", COMMITS + """
SELECT doc_id, coalesce(rcode, '') AS codes FROM f""")
def a27(spark, d):
    return commits(spark, d).select("doc_id", F.array_join(L.recording_codes(F.col("label_candidates")), ",").alias("codes"))


@query("f04_source_names", """
WITH n AS (SELECT p_partkey, string_split(p_name, ' ')[1] || '_' || lower(p_type) || '-' || p_size || '_' || p_partkey % 7 AS s, p_brand AS b FROM part),
k AS (SELECT *, string_split(s, '_') AS a, b IN ('Brand#1', 'Brand#2', 'Brand#3') AS one, b IN ('Brand#4', 'Brand#5', 'Brand#6', 'Brand#7') AS two FROM n)
SELECT p_partkey, CASE WHEN one THEN lower(a[1]) WHEN two THEN lower(a[2]) END AS code,
 CASE WHEN one THEN upper(a[1][1]) || a[1][2:] WHEN two THEN upper(a[2][1]) || replace(a[2][2:], '-', ' ') END AS name,
 CASE WHEN two THEN a[1] END AS object, CASE WHEN one THEN a[2] || '_' || a[3] WHEN two THEN a[3] END AS take FROM k""")
def f04(spark, d):
    word = F.split_part("p_name", F.lit(" "), F.lit(1))
    rows = read(spark, d, "part").select("p_partkey", "p_brand", F.concat(
        F.lit("subject/"), word, F.lit("_"), F.lower("p_type"), F.lit("-"), F.col("p_size").cast("string"), F.lit("_"),
        (F.col("p_partkey") % 7).cast("string"), F.lit("_stageii.npz")).alias("member"))
    out = L.source_name_candidate(rows, member="member", dataset="p_brand", action_first=["Brand#1", "Brand#2", "Brand#3"],
                                  action_second_last=["Brand#4", "Brand#5", "Brand#6", "Brand#7"])
    return out.select("p_partkey", "code", "name", "object", "take")


@query("f05_normalise_gender", """
SELECT c_custkey, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'female' WHEN 'BUILDING' THEN 'male' WHEN 'MACHINERY' THEN 'neutral' END AS gender FROM customer""")
def f05(spark, d):
    s = F.col("c_mktsegment")
    raw = (F.when(s == "HOUSEHOLD", F.lit(" Female ").cast("binary")).when(s == "BUILDING", F.lit("MALE").cast("binary"))
           .when(s == "MACHINERY", F.lit("neutral\t").cast("binary")).otherwise(s.cast("binary")))
    return read(spark, d, "customer").select("c_custkey", L.normalise_gender(F.trim(F.translate(raw.cast("string"), "\t", " "))).alias("gender"))


@query("f06_stem_tokens", r"""
WITH n AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_extract(lower(url), '[^/]*$'), '(.)\.[^.]*$', '\1'), '_poses$', ''), '_poses$', '') AS s FROM pages)
SELECT page_id, array_to_string(list_sort(list_distinct(regexp_extract_all(s, '[a-z]+'))), ',') AS tokens FROM n""")
def f06(spark, d):
    return read(spark, d, "pages").select("page_id", F.array_join(F.sort_array(L.stem_tokens(F.col("url"))), ",").alias("tokens"))


@query("f19_upgrade_records", """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'click' THEN 'done,guard,k' ELSE 'guard,k' END AS fields FROM events""")
def f19(spark, d):
    from strideframe.sources.tables import events
    m = F.from_json("props", "map<string,string>")
    rec = F.when(F.col("event_type") == "error", F.map_from_arrays(F.array(F.lit("x")), F.array(F.lit("1")))).when(
        F.col("event_type") == "click", F.map_concat(m, F.create_map(F.lit("done"), F.lit("1")))).otherwise(m)
    up = L.upgrade_record(rec, ["k"], "guard")
    return events(spark, d).select("event_id", F.array_join(F.sort_array(F.map_keys(up)), ",").alias("fields"))


_MERGE = """WITH r AS (SELECT source || '/' || doc_id % 20 AS member, CAST(CASE WHEN source = 'src4' THEN doc_id // 20 % 2 ELSE 1 END AS VARCHAR) AS sid,
 CASE WHEN doc_id % 3 = 0 THEN 'extra_train' WHEN doc_id % 3 = 1 THEN 'train' ELSE 'val' END AS split, doc_id, 2.0 + CASE WHEN lang = 'es' THEN 0.01 ELSE 0 END AS dur FROM documents),
m AS (SELECT member, sid, array_to_string(list_sort(list(lpad(CAST(doc_id AS VARCHAR), 12, '0') || ':' || split)), ',') AS label_rows, count(*) AS labels, array_to_string(list_sort(list(DISTINCT split)), ',') AS splits, CAST(min(dur) AS DOUBLE) AS duration_s,
 max(dur)-min(dur) <= 1e-6 AS duration_agrees FROM r GROUP BY ALL)"""


def _annotation_sets(spark, d):
    i = F.col("doc_id")
    r = read(spark, d, "documents").select(
        "doc_id", F.concat_ws("/", "source", (i % 20).cast("string")).alias("member"),
        F.when(F.col("source") == "src4", F.floor(i / 20) % 2).otherwise(1).cast("string").alias("sid"),
        F.when(i % 3 == 0, "extra_train").when(i % 3 == 1, "train").otherwise("val").alias("split"),
        F.when(F.col("lang") == "es", 2.01).otherwise(2.0).alias("dur"))
    return L.merge_annotation_sets(r.where("doc_id % 3 <> 0"), r.where("doc_id % 3 = 0"), keys=["member", "sid"], split="split", duration="dur", label=["doc_id", "split"])


@query("u08_merge_annotation_sets", _MERGE + " SELECT * FROM m")
def u08(spark, d):
    text = F.transform("label_rows", lambda r: F.concat(F.lpad(r["doc_id"].cast("string"), 12, "0"), F.lit(":"), r["split"]))
    return _annotation_sets(spark, d).withColumn("label_rows", F.array_join(text, ","))


@query("u08_member_identities", _MERGE + " SELECT 'member-identity' AS rule, member AS key, CAST(count(DISTINCT sid) AS VARCHAR) AS detail FROM m GROUP BY member HAVING count(DISTINCT sid) > 1")
def u08_ids(spark, d):
    return L.member_identities(_annotation_sets(spark, d), member="member", identity="sid")


@query("a23_label_audit", COMMITS + """
SELECT lang AS split, count(*) AS sequences, count(*) FILTER (WHERE list_contains(cats, 'sit')) + count(*) FILTER (WHERE list_contains(tmp, 'sit')) AS category_rows,
 count(*) FILTER (WHERE list_contains(cats, 'sit') OR list_contains(tmp, 'sit')) AS category_sequences, max(abs(doc_id % 17 / 4.0 - doc_id % 13 / 4.0)) AS max_duration_difference_s FROM f GROUP BY lang""")
def a23(spark, d):
    from strideframe.operators.metrics import label_audit
    i = F.col("doc_id")
    rows = commits(spark, d).withColumns({"annotated_s": i % 17 / 4.0, "motion_s": i % 13 / 4.0})
    return label_audit(rows, split="lang", key="doc_id", category="sit", durations=("annotated_s", "motion_s"))
