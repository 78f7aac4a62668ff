import json

import pytest
from pyspark.sql import functions as F

from strideframe.operators import checks as C
from strideframe.operators import labels as L
from strideframe.operators import qa as Q
from strideframe.operators import review as V
from strideframe.sources import config

COMMIT = ("id string, source_dataset string, source_member string, "
          "label_candidates array<struct<kind:string,code:string,origin:string,categories:array<string>>>")
REC, TMP, BABEL = "recording-candidate", "temporal-candidate", "babel-1.0"


def commits(spark, rows):
    return spark.createDataFrame(rows, COMMIT)


def decide(spark, rows, rules, revision):
    r = spark.createDataFrame(rules, L.RULE_SCHEMA)
    out = L.weak_labels(commits(spark, rows), r, key="id", revision=revision).collect()
    return {x.id: (x.state, x.code, x.rule_id) for x in out}


def test_conflicting_temporal_evidence_stays_unresolved(spark):
    rows = [("a", "ACCAD", "m", [(REC, "walk", BABEL, ["walk"]), (TMP, "t", BABEL, ["transition"])]),
            ("b", "ACCAD", "m", [(REC, "walk", BABEL, ["walk"]), (TMP, "t", BABEL, ["walk"])]),
            ("c", "ACCAD", "m", [(REC, None, BABEL, ["walk"])]), ("d", "ACCAD", None, [])]
    got = decide(spark, rows, L.default_rules(), 1)
    assert got["a"] == got["c"] == got["d"] == ("unresolved", "", "")
    assert got["b"] == ("weak", "walking", "babel-walk-v1")


def test_dataset_rule_replaces_the_global_one(spark):
    rules = L.default_rules() + [("accad-walk-v1", BABEL, "walk", "ACCAD", "walking_special", False)]
    rows = [(s, s, "m", [(REC, "walk", BABEL, ["walk"])]) for s in ("ACCAD", "EKUT")]
    assert decide(spark, rows, rules, 1) == {"ACCAD": ("weak", "walking_special", "accad-walk-v1"),
                                             "EKUT": ("weak", "walking", "babel-walk-v1")}


def test_agreeing_matches_count_from_revision_two_on(spark):
    rules = [("r2", BABEL, "walk", None, "walking", False), ("r1", BABEL, "catset:walk", None, "walking", False)]
    rows = [("a", "K", "m", [(REC, "walk", BABEL, ["walk"])])]
    assert decide(spark, rows, rules, 1)["a"] == ("unresolved", "", "")
    assert decide(spark, rows, rules, 2)["a"] == ("weak", "walking", "r1")


PRESETS = {
    "schema": "presets.v1", "revision": 1,
    "babel_families": [{"code": "walking", "aliases": ["walk"], "modifiers": ["turn", "step"]},
                       {"code": "running", "aliases": ["run", "jog"], "modifiers": ["turn"]}],
    "babel_codes": {"stroll": "walking"}, "stageii_codes": {"GRAB": {"pass": "passing_object"}},
    "member_tokens": {"walking": ["walk"], "sitting": ["sit"]},
}


def preset_tables(spark, tmp_path):
    path = tmp_path / "presets.json"
    path.write_text(json.dumps(PRESETS))
    return config.load_presets(spark, str(path))


SEVEN = [
    ("turn", "KIT", "KIT/a_poses.npz", [(REC, "walk", BABEL, ["turn", "walk"]), (TMP, "t", BABEL, ["stand", "transition", "turn", "walk"])]),
    ("jog", "ACCAD", "m", [(REC, "jog", BABEL, ["jog", "run"])]),
    ("pass", "GRAB", "m", [(REC, "pass", "stageii-source-member", [])]),
    ("danger", "KIT", "m", [(REC, "stumble while walking", BABEL, ["walk"])]),
    ("nothing", "KIT", "m", []),
    ("name", "BMLrub", "BMLrub/0006_normal_walk_poses.npz", []),
    ("unsafe", "KIT", "KIT/200/push_recovery_walk02_poses.npz", []),
]


def test_seven_commits_give_four_weak_labels(spark, tmp_path):
    df = commits(spark, SEVEN)
    rules = L.compile_rules(df, base=spark.createDataFrame(L.default_rules(), L.RULE_SCHEMA), key="id", **preset_tables(spark, tmp_path))
    assert C.rule_set(rules.withColumn("revision", F.lit(2))).count() == 0 and L.rule_conflicts(rules).count() == 0
    got = {r.id: r.code for r in L.weak_labels(df, rules, key="id", revision=2).collect()}
    assert got == {"turn": "contains_walking", "jog": "running", "pass": "passing_object", "danger": "", "nothing": "",
                   "name": "walking", "unsafe": ""}


def test_rule_and_preset_checks_find_each_mutation(spark, tmp_path):
    t = preset_tables(spark, tmp_path)
    assert C.preset_rules(t["families"]).count() == 0 and config.token_rules(t["tokens"]).count() == 0
    bad = t["families"].unionByName(spark.createDataFrame([("trip_walk", ["jog"], [])], "code string, aliases array<string>, modifiers array<string>"))
    assert sorted(r.rule for r in C.preset_rules(bad).collect()) == ["alias-overlap", "code"]
    rule = lambda *r: spark.createDataFrame([r], L.RULE_SCHEMA + ", revision int")
    cases = {"target": ("a", BABEL, "walk", None, "fall", True, 2), "value": ("a", BABEL, " Walk", None, "walking", False, 2),
             "category-set": ("a", BABEL, "catset:walk|turn", None, "walking", False, 2), "token": ("a", L.TOKEN, "w1", "K", "walking", False, 2),
             "origin": ("a", L.TOKEN, "walk", "K", "walking", False, 1)}
    for name, row in cases.items():
        assert [r.rule for r in C.rule_set(rule(*row)).collect()] == [name]


def test_policy_file_and_checks(spark, tmp_path):
    doc = {"schema": "p", "policy_id": "p1", "minimum_corpus_pass_rate": 0.8, "minimum_source_pass_rate": 0.8, "paused_sources": [],
           "required_checks": ["structure"], "convergence": {"require_boundary_guard_complete": True, "acceleration_rms_max_m_s2": 0.1,
                                                             "angular_velocity_rms_max_rad_s": 0.02}}
    path = tmp_path / "policy.json"
    path.write_text(json.dumps(doc))
    policy = config.load_policy(spark, str(path))
    assert policy["acceleration_rms_m_s2"] == 0.1 and policy["required_checks"] == ["structure"]
    assert config.policy_rules(spark.read.schema(config.POLICY).option("multiLine", True).json(str(path))).count() == 0


CLIP = "clip_id string, checks map<string,boolean>, guard_complete boolean, acceleration_rms_m_s2 double, angular_velocity_rms_rad_s double"
GOOD = {"structure": True, "trajectory": True, "sensor": True, "work_grid_convergence": False}


def test_gate_compares_raw_values_and_lets_the_limit_pass(spark):
    rows = [("limit", GOOD, True, 0.1, 0.02), ("over", GOOD, True, 0.1000001, 0.02), ("null", GOOD, True, None, 0.0),
            ("guard", GOOD, None, 0.0, 0.0), ("missing", {"structure": True, "trajectory": True, "sensor": False}, True, 0.0, 0.0), ("none", None, None, None, None)]
    got = {r.clip_id: r.reasons for r in Q.gate(spark.createDataFrame(rows, CLIP)).collect()}
    assert got == {"limit": [], "over": ["convergence-limit:acceleration_rms_m_s2"], "null": ["convergence-limit:acceleration_rms_m_s2"],
                   "guard": ["boundary-guard-incomplete"], "missing": ["hard-check-failed:sensor", "hard-check-missing:work_grid_convergence"],
                   "none": ["qa-missing"]}


def corpus(spark, failing, paused=()):
    rows = [(f"c{i}", "S", GOOD if i >= failing else None, True, 0.0, 0.0) for i in range(5)]
    df = spark.createDataFrame(rows, "clip_id string, source string, checks map<string,boolean>, guard_complete boolean, acceleration_rms_m_s2 double, angular_velocity_rms_rad_s double")
    policy = {**Q.POLICY, "paused_sources": list(paused)}
    return Q.exclusion(Q.gate(df, policy=policy), source="source", policy=policy), policy


@pytest.mark.parametrize("failing,rate", [(1, 0.8), (2, 0.6)])
def test_corpus_rate_never_blocks(spark, failing, rate):
    clips, policy = corpus(spark, failing)
    r = Q.corpus_statistics(clips).first()
    assert (r.candidate_rate, r.published_candidates, r.publishable) == (rate, 5 - failing, True)
    planned = clips.select("source")
    settled = clips.select("source", F.when(F.size("reasons") == 0, "published").otherwise("excluded").alias("status"))
    assert Q.rate_alerts(planned, settled, source="source").count() == (0 if rate == 0.8 else 2)
    # Nothing is judged while a clip is pending or absent.
    assert Q.rate_alerts(planned.unionByName(planned.limit(1)), settled, source="source").count() == 0


def test_only_decisions_count_as_reviewed(spark):
    rows = spark.createDataFrame([(True, None, "unreviewed"), (None, True, None)], "complete boolean, passed boolean, decision string")
    r = Q.study_report(rows).first()
    assert (r.all_complete, r.all_passed, r.reviewed, r.review_status) == (False, False, 0, "unreviewed")


def test_paused_source_is_excluded_whole(spark):
    clips, policy = corpus(spark, 0, ["S"])
    assert [r.reasons for r in clips.collect()] == [["source-quarantined"]] * 5
    assert Q.corpus_statistics(clips).first().published_candidates == 0
    assert Q.source_rates(clips, source="source", policy=policy).first().quarantined


QUEUE = ("clip_id string, source_dataset string, subject string, codes array<string>, qa_passed boolean, warnings array<string>, "
         "risk_score double, decision string")


def test_queue_puts_exceptions_before_one_sample_per_stratum(spark):
    rows = [("unlabeled", "E", "S1", [], True, [], 0.1, None), ("walk-low", "E", "S1", ["walk"], True, [], 0.2, None),
            ("walk-high", "E", "S1", ["walk"], True, [], 0.7, None), ("done", "E", "S1", [], False, [], 0.9, "accepted")]
    out = V.review_queue(spark.createDataFrame(rows, QUEUE), key="clip_id").collect()
    assert [(r.clip_id, r.reasons) for r in out] == [("unlabeled", ["label-unresolved"]), ("walk-high", ["stratified-sample"])]


def test_pilot_forces_the_required_group_in(spark):
    rows = [(f"{c}-{i}", c, "GRAB" if (c, i) == ("high-risk", 7) else "KIT") for c in V.CATEGORIES for i in range(8)]
    df = spark.createDataFrame(rows, "id string, category string, source string")
    out = V.choose_pilot(df, key="id", category="category", source="source", per_category=3, required=["GRAB"]).collect()
    assert len(out) == 12 and sum(r.source == "GRAB" for r in out) >= 1
    assert {c: sum(r.category == c for r in out) for c in V.CATEGORIES} == dict.fromkeys(V.CATEGORIES, 3)


def test_upgrade_only_with_all_required_keys(spark):
    df = spark.createDataFrame([(1, {"a": "1", "b": "2"}), (2, {"a": "1"}), (3, {"a": "1", "b": "2", "f": "x"}), (4, None)], "i int, m map<string,string>")
    got = {r.i: r.u for r in df.select("i", L.upgrade_record(F.col("m"), ["a", "b"], "f").alias("u")).collect()}
    assert got == {1: {"a": "1", "b": "2", "f": "true"}, 2: None, 3: {"a": "1", "b": "2", "f": "x"}, 4: None}
