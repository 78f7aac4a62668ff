"""Weak activity labels: evidence, rule matching, preset compilation, label records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideframe.plans.barrier import evaluate_once
from strideframe.operators.checks import RISK_WORDS, record_rules, violation
from strideframe.session import materialise

BABEL, STAGEII, TOKEN = "babel-1.0", "stageii-source-member", "source-member-token"
STEM_RISK = RISK_WORDS + ["recovery", "push", "accident"]

# Fixed base mapping from a source category to an activity code.
DEFAULT_CODES = {
    "walk": "walking", "run": "running", "jog": "jogging", "stand": "standing", "sit": "sitting",
    "jump": "jumping", "turn": "turning", "dance": "dancing", "throw": "throwing",
    "kick": "kicking", "wave": "waving", "stretch": "stretching",
}
RULE_SCHEMA = ("rule_id string, origin string, source_value string, source_dataset string, "
               "target_code string, is_fall boolean")


def default_rules() -> list[tuple]:
    """Exact mappings; every other source label stays unresolved."""
    return [(f"babel-{s}-v1", BABEL, s, None, t, False) for s, t in sorted(DEFAULT_CODES.items())]


def any_word(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


def text_present(c: Column) -> Column:
    return F.coalesce(F.length(c), F.lit(0)) > 0


# --- F04, F05, F06 --------------------------------------------------------------------

def file_stem(path: Column, *suffixes: str) -> Column:
    """Last path part without its extension and without the given endings."""
    name = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(.)\.[^.]*$", "$1")
    for s in suffixes:
        name = F.regexp_replace(name, f"{s}$", "")
    return name


def stem_tokens(path: Column) -> Column:
    """distinct letter runs of the lower-cased stem."""
    return F.array_distinct(F.regexp_extract_all(file_stem(F.lower(path), "_poses"), F.lit("[a-z]+"), F.lit(0)))


def source_name_candidate(df: DataFrame, *, member: str, dataset: str, action_first: list[str],
                          action_second_last: list[str]) -> DataFrame:
    """action, object and take from the underscore parts of a name, by dataset."""
    parts = F.split(F.regexp_replace(F.element_at(F.split(F.col(member), "/"), -1), r"_stageii\.npz$", ""), "_")
    n = F.size(parts)
    first = F.col(dataset).isin(action_first)
    second = F.col(dataset).isin(action_second_last) & (n >= 2)
    action = F.when(first, F.get(parts, F.lit(0))).when(second, F.get(parts, n - 2))
    take = F.when(first, F.nullif(F.array_join(F.slice(parts, F.lit(2), n), "_"), F.lit(""))).when(
        second, F.get(parts, n - 1))
    obj = F.when(second, F.array_join(F.slice(parts, F.lit(1), F.greatest(n - 2, F.lit(0))), "_"))
    name = F.initcap(F.trim(F.translate(action, "-_", "  ")))
    return df.withColumns({"code": F.lower(action), "name": name, "object": obj, "take": take})


def normalise_gender(c: Column) -> Column:
    """trimmed lower-case text; anything outside the domain becomes null."""
    g = F.lower(F.trim(c.cast("string")))
    return F.when(g.isin("male", "female", "neutral"), g)


# --- U06, F12 -----------------------------------------------------------------------------

def _lower_set(arrays: Column) -> Column:
    return F.sort_array(F.array_distinct(F.transform(arrays, lambda x: F.lower(x))))


def evidence(commits: DataFrame) -> DataFrame:
    """Feature columns of the label candidates of each commit."""
    labels = F.coalesce(F.col("label_candidates"), F.expr("cast(array() as array<struct<kind:string,code:string,origin:string,categories:array<string>>>)"))
    cats = lambda x: F.coalesce(x["categories"], F.array().cast("array<string>"))
    coded = lambda kind: F.filter(labels, lambda x: (x["kind"] == kind) & text_present(x["code"]))
    words = F.flatten(F.transform(labels, lambda x: F.concat(
        F.array(F.coalesce(F.lower(x["code"]), F.lit(""))), F.transform(cats(x), lambda c: F.lower(c)))))
    df = evaluate_once(commits.withColumns({
        "_rec": coded("recording-candidate"), "_tmp": coded("temporal-candidate"), "_words": words}), *commits.columns)
    own = lambda origin: F.filter("_rec", lambda x: x["origin"] == origin)
    babel = own(BABEL)
    stem = F.lower(file_stem(F.lower(F.col("source_member")), "_poses"))
    out = df.withColumns({
        "has_risk": F.exists("_words", lambda w: any_word(w, RISK_WORDS)),
        "categories": _lower_set(F.flatten(F.transform(babel, cats))),
        "temporal": _lower_set(F.flatten(F.transform(F.filter("_tmp", lambda x: x["origin"] == BABEL), cats))),
        "codes": _lower_set(F.transform(babel, lambda x: x["code"])),
        "stageii_codes": F.transform(own(STAGEII), lambda x: F.lower(x["code"])),
        "token_codes": F.transform(own(TOKEN), lambda x: F.lower(x["code"])),
        "stem_risk": any_word(stem, STEM_RISK),
        "tokens": stem_tokens(F.coalesce("source_member", F.lit(""))),
    }).drop("_rec", "_tmp", "_words")
    return evaluate_once(out, *commits.columns)


def evidence_keys(features: DataFrame, *, keep: list[str], revision: int) -> DataFrame:
    """Every (origin, source_value) a commit can match; rules then join by equality.

    A commit without any keeps one row of nulls.
    """
    cats, temporal, codes = F.col("categories"), F.col("temporal"), F.col("codes")
    calm = (F.size(temporal) == 0) | (temporal == cats)
    catset = F.concat(F.lit("catset:"), F.array_join(cats, "|"))
    item = lambda origin, value: F.struct(F.lit(origin).alias("origin"), value.alias("source_value"))
    single = F.get(cats, F.lit(0))
    plain = ~(single.startswith("catset:") | single.startswith("code:"))
    exact = F.array_compact(F.array(
        F.when((F.size(cats) == 1) & calm & plain, item(BABEL, single)),
        F.when((F.size(cats) > 0) & calm, item(BABEL, catset)),
        F.when((F.size(cats) > 0) & (F.size(temporal) > 0),
               item(BABEL, F.concat(catset, F.lit(";temporal:"), F.array_join(temporal, "|")))),
        F.when((F.size(cats) == 0) & (F.size(temporal) == 0) & (F.size(codes) == 1),
               item(BABEL, F.concat(F.lit("code:"), F.get(codes, F.lit(0))))),
        F.when(F.size("stageii_codes") == 1, item(STAGEII, F.get("stageii_codes", F.lit(0)))),
        F.when(F.size("token_codes") == 1, item(TOKEN, F.get("token_codes", F.lit(0))))))
    keys = exact
    if revision >= 2:
        open_ = (F.size(cats) == 0) & (F.size(F.array_except(codes, F.array(F.lit("none")))) == 0) & ~F.col("stem_risk")
        keys = F.concat(exact, F.when(open_, F.transform("tokens", lambda t: item(TOKEN, t))).otherwise(
            F.filter(exact, lambda x: F.lit(False))))
        keys = F.when(F.col("has_risk"), F.filter(exact, lambda x: F.lit(False))).otherwise(keys)
    return features.select(*keep, F.explode_outer(F.array_distinct(keys)).alias("_k")).select(*keep, "_k.*")


def _hits(features: DataFrame, rules: DataFrame, *, keep: list[str], revision: int, how: str) -> DataFrame:
    r = rules.select("rule_id", "origin", "source_value", F.col("source_dataset").alias("_ds"), "target_code")
    hits = evidence_keys(features, keep=keep, revision=revision).join(r, ["origin", "source_value"], how)
    own = F.col("rule_id").isNotNull() & (F.col("_ds").isNull() | (F.col("_ds") == F.col("source_dataset")))
    return hits.withColumns({"_own": own, "specific": F.col("_ds").isNotNull()})


def matching_rules(features: DataFrame, rules: DataFrame, *, key: str, revision: int) -> DataFrame:
    """Rules that match each commit.  A commit's keys are distinct, so each rule appears once."""
    return _hits(features, rules, keep=[key, "source_dataset"], revision=revision, how="inner").where("_own").select(
        key, "rule_id", "target_code", "specific")


def weak_labels(commits: DataFrame, rules: DataFrame, *, key: str, revision: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """F12 + J13: (state, code, rule_id) per commit, with its source and the `carry` columns.

    One pass: every commit stays in the key rows, and matches are reduced to a few numbers
    per commit before the decision.  Dataset rules replace global ones when any matches.
    """
    keep = [key, "source_dataset", *carry]
    hits = _hits(evidence(commits), rules, keep=keep, revision=revision, how="left")
    aggs = []
    for name, mine in (("s", F.col("_own") & F.col("specific")), ("g", F.col("_own") & ~F.col("specific"))):
        pick = lambda c: F.when(mine, c)
        aggs += [F.count_if(mine).alias(f"{name}_n"), F.min(pick(F.col("target_code"))).alias(f"{name}_lo"),
                 F.max(pick(F.col("target_code"))).alias(f"{name}_hi"), F.min(pick(F.col("rule_id"))).alias(f"{name}_rule")]
    per = hits.groupBy(*keep).agg(*aggs)
    best = lambda c: F.when(F.col("s_n") > 0, F.col(f"s_{c}")).otherwise(F.col(f"g_{c}"))
    # A decided commit has one target, so the smallest target and the smallest rule belong together.
    decided = (best("n") == 1) | ((best("n") > 1) & (best("lo") == best("hi")) & F.lit(revision >= 2))
    weak = F.coalesce(decided, F.lit(False))
    return per.select(*keep, F.when(weak, "weak").otherwise("unresolved").alias("state"),
                      F.when(weak, best("lo")).otherwise("").alias("code"), F.when(weak, best("rule")).otherwise("").alias("rule_id"))


# --- F13 -----------------------------------------------------------------------------------

def compile_rules(commits: DataFrame, *, base: DataFrame, families: DataFrame, codes: DataFrame,
                  stageii: DataFrame, tokens: DataFrame, key: str) -> DataFrame:
    """Exact rules for the evidence the base rules leave open.

    families(code, aliases, modifiers), codes(source, target), stageii(dataset, source, target),
    tokens(target, token).  Category sets are matched once per distinct set, not per commit.
    """
    decided = weak_labels(commits, base, key=key, revision=2).where("state = 'weak'").select(key)
    f = evidence(commits).where(~F.col("has_risk")).join(decided, key, "left_anti")
    cats, temporal = F.col("categories"), F.col("temporal")
    mapped = stageii.select("dataset").distinct().withColumn("_mapped", F.lit(True))
    f = f.join(mapped, F.col("source_dataset") == F.col("dataset"), "left").drop("dataset")
    # Five branches read the evidence: write the narrow table once instead of re-reading the text.
    f = materialise(f.select(key, "source_dataset", "categories", "temporal", "codes", "stageii_codes",
                             "tokens", "stem_risk", "_mapped"), "evidence")

    s2 = (f.where("_mapped and size(stageii_codes) = 1")
          .select(F.col("source_dataset").alias("dataset"), F.get("stageii_codes", F.lit(0)).alias("source")).distinct()
          .join(stageii, ["dataset", "source"]))
    out = s2.select(F.lit(STAGEII).alias("origin"), F.col("source").alias("source_value"),
                    F.col("dataset").alias("source_dataset"), F.col("target").alias("target_code"))

    rest = f.where("_mapped is null")
    coded = (rest.where("size(categories) = 0 and size(codes) = 1 and size(temporal) = 0")
             .select(key, F.get("codes", F.lit(0)).alias("source")).join(codes, "source"))
    out = out.unionByName(coded.select(
        F.lit(BABEL).alias("origin"), F.concat(F.lit("code:"), F.col("source")).alias("source_value"),
        F.lit(None).cast("string").alias("source_dataset"), F.col("target").alias("target_code")).distinct())

    open_names = rest.where("size(categories) = 0 and not stem_risk and size(array_except(codes, array('none'))) = 0")
    open_names = open_names.join(coded.select(key), key, "left_anti")
    hits = open_names.select(key, "source_dataset", F.explode("tokens").alias("token")).join(tokens, "token")
    one = hits.groupBy(key, "source_dataset").agg(
        F.min("target").alias("lo"), F.max("target").alias("hi"), F.min("token").alias("token")).where("lo = hi")
    out = out.unionByName(one.select(F.lit(TOKEN).alias("origin"), F.col("token").alias("source_value"),
                                     "source_dataset", F.col("lo").alias("target_code")).distinct())

    sets = rest.where("size(categories) > 0").select("categories", "temporal").distinct()
    words = families.select("code", F.explode("aliases").alias("c"), F.lit(1).alias("is_alias")).unionByName(
        families.select("code", F.explode("modifiers").alias("c"), F.lit(0).alias("is_alias")))
    words = words.groupBy("code", "c").agg(F.max("is_alias").alias("is_alias"))
    fit = (sets.select("categories").distinct().select("categories", F.explode("categories").alias("c")).join(words, "c")
           .groupBy("categories", "code").agg(F.count(F.lit(1)).alias("n"), F.sum("is_alias").alias("a"))
           .where("n = size(categories) and a > 0"))
    only = fit.groupBy("categories").agg(F.count(F.lit(1)).alias("n"), F.min("code").alias("code")).where("n = 1")
    fam = sets.join(only, "categories").join(families.select("code", "aliases"), "code")
    whole = (F.size(temporal) == 0) | (temporal == cats)
    contains = ~whole & F.arrays_overlap("temporal", "aliases")
    enc = F.concat(F.lit("catset:"), F.array_join(cats, "|"))
    out = out.unionByName(fam.where(whole | contains).select(
        F.lit(BABEL).alias("origin"),
        F.when(whole, enc).otherwise(F.concat(enc, F.lit(";temporal:"), F.array_join(temporal, "|"))).alias("source_value"),
        F.lit(None).cast("string").alias("source_dataset"),
        F.when(whole, F.col("code")).otherwise(F.concat(F.lit("contains_"), F.col("code"))).alias("target_code")).distinct())

    identity = F.to_json(F.array("origin", "source_value", "source_dataset"))
    digest = F.substr(F.sha2(F.concat(identity, F.lit("\n")), 256), F.lit(1), F.lit(12))
    made = out.distinct().withColumn("rule_id", F.concat(F.lit("local-preset-"), digest)).withColumn("is_fall", F.lit(False))
    names = [c.split()[0] for c in RULE_SCHEMA.split(", ")]
    return base.select(*names).unionByName(made.select(*names))


def rule_conflicts(rules: DataFrame) -> DataFrame:
    """Identities that were compiled to more than one target."""
    n = rules.groupBy("rule_id").agg(F.count_distinct("target_code").alias("n")).where("n > 1")
    return n.select(*violation("conflicting-preset", F.col("rule_id"), F.col("n")))


# --- C22, J24, F19, U08, A21 ---------------------------------------------------------------------

def frozen_rule_check(weak_index: DataFrame, rules: DataFrame, *, key: str) -> DataFrame:
    """Weak rows whose code is not the target of their rule."""
    r = rules.select("rule_id", "target_code")
    return weak_index.where("state = 'weak'").join(r, "rule_id", "left").where(
        ~F.col("code").eqNullSafe(F.col("target_code"))).select(
        *violation("rule-target", F.col(key), F.col("rule_id")))


def provisional_rules(weak_index: DataFrame, rules: DataFrame, annotations: DataFrame, raw: DataFrame,
                      *, key: str) -> DataFrame:
    """No annotations, well-formed states, codes unverified, one raw row per identity, frozen targets."""
    weak = (F.col("state") == "weak") & text_present(F.col("code")) & text_present(F.col("rule_id"))
    open_ = (F.col("state") == "unresolved") & ~text_present(F.col("code")) & ~text_present(F.col("rule_id"))
    rows = record_rules(weak_index, F.col(key), {
        "label-state": (weak | open_, F.col("state")),
        "core-code": (F.col("activity_code") == "unverified", F.col("activity_code")),
        "core-fall": (~F.col("is_fall"), F.lit("true"))})
    ann = annotations.select(*violation("annotation", F.col(key), F.col("code")))
    have = raw.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    cover = weak_index.select(key).distinct().join(have, key, "full_outer").where(
        F.coalesce("n", F.lit(0)) != 1).select(*violation("raw-label", F.col(key), F.coalesce("n", F.lit(0))))
    return rows.unionByName(ann).unionByName(cover).unionByName(frozen_rule_check(weak_index, rules, key=key))


def upgrade_record(record: Column, required: list[str], flag: str) -> Column:
    """set the missing flag of a map record only when every required key exists."""
    missing = F.size(F.array_except(F.array(*map(F.lit, required)), F.map_keys(record))) > 0
    done = F.array_contains(F.map_keys(record), flag)
    return F.when(record.isNull() | missing, F.lit(None)).when(done, record).otherwise(
        F.map_concat(record, F.create_map(F.lit(flag), F.lit("true"))))


def merge_annotation_sets(primary: DataFrame, extra: DataFrame, *, keys: list[str], split: str,
                          duration: str, label: list[str], tolerance: float = 1e-6) -> DataFrame:
    """One record per key with the label rows of both sets, sorted, and the sorted distinct splits."""
    both = primary.unionByName(extra)
    return both.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(*label))).alias("label_rows"), F.count(F.lit(1)).alias("labels"),
        F.array_join(F.sort_array(F.collect_set(split)), ",").alias("splits"),
        F.min(duration).alias("duration_s"),
        ((F.max(duration) - F.min(duration)) <= tolerance).alias("duration_agrees"))


def recording_codes(labels: Column) -> Column:
    """Distinct sorted codes of the labels that are not temporal."""
    kept = F.filter(labels, lambda x: (x["kind"] != "temporal-candidate") & text_present(x["code"]))
    return F.sort_array(F.array_distinct(F.transform(kept, lambda x: x["code"])))


def member_identities(merged: DataFrame, *, member: str, identity: str) -> DataFrame:
    """Members claimed by several identities."""
    n = merged.groupBy(member).agg(F.count_distinct(identity).alias("n")).where("n > 1")
    return n.select(*violation("member-identity", F.col(member), F.col("n")))


def coverage_report(labelled: DataFrame, base_weak: DataFrame, *, source: str) -> DataFrame:
    """Counts overall, by source, by source and state and by code, next to the base rules."""
    long = labelled.select(F.lit("compiled").alias("rules"), source, "state", "code").unionByName(
        base_weak.select(F.lit("base").alias("rules"), source, "state", "code"))
    return (long.groupingSets([["rules"], ["rules", source], ["rules", source, "state"], ["rules", "state", "code"]],
                              "rules", source, "state", "code")
            .agg(F.count(F.lit(1)).alias("commits"), F.count_if(F.col("state") == "weak").alias("weak")))
