import datetime
import glob
import hashlib
import io
import json
import os
import tarfile
import zipfile
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strideframe.operators import checks as C
from strideframe.operators import delivery as K
from strideframe.sources import archives as A
from strideframe.sources import config
from strideframe.sources import documents as D
from strideframe.sources import shards
from strideframe.sources.objects import ObjectStore
from strideframe.streaming import feeds as S
from strideframe.streaming.runs import Runs
from strideframe.functions import ids


def npz(frames=5, gender=b"male", rate="mocap_framerate", hz=60.0, extra=None, drop=()):
    arrays = {"poses": np.zeros((frames, 156)), "trans": np.zeros((frames, 3)), "betas": np.zeros(16), "dmpls": np.zeros((frames, 8)),
              "gender": np.array(gender), rate: np.array(hz), **(extra or {})}
    for d in drop:
        arrays.pop(d)
    buf = io.BytesIO()
    np.savez(buf, **arrays)
    return buf.getvalue()


def tar(path, members, mode="w:bz2", link=None):
    with tarfile.open(path, mode) as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
        if link:
            info = tarfile.TarInfo(link)
            info.type, info.linkname = tarfile.SYMTYPE, "elsewhere"
            t.addfile(info)


def test_tar_inventory_reports_links_duplicates_and_damage(spark, tmp_path):
    tar(tmp_path / "a.tar.bz2", [("S/x_poses.npz", b"1"), ("S/x_poses.npz", b"2"), ("S/readme.txt", b"t")], link="S/l_poses.npz")
    whole = tmp_path / "whole"
    tar(whole, [("S/y_poses.npz", bytes(200_000))], mode="w")
    (tmp_path / "b.tar").write_bytes(whole.read_bytes()[:100_000])
    whole.unlink()
    inv = A.inventory(spark, str(tmp_path), pattern="*.tar*", suffixes=["_poses.npz"])
    assert inv.where("problem = ''").count() == 2
    rules = sorted((r.rule, r.detail.split(":")[0]) for r in A.inventory_violations(inv).collect())
    assert rules == [("archive-member", "link"), ("archive-member", "truncated"), ("duplicate-member", "2")]


@pytest.mark.parametrize("kind", ["zip", "stored", "tar"])
def test_one_archive_is_read_by_many_tasks(spark, tmp_path, kind):
    members = [(f"S/m{i}.txt", bytes([i % 251]) * (i * 7 % 900)) for i in range(400)]
    if kind == "tar":
        tar(tmp_path / "a.tar", members, mode="w")
    else:
        with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED if kind == "zip" else zipfile.ZIP_STORED) as z:
            for name, data in members:
                z.writestr(name, data)
    inv = A.inventory(spark, str(tmp_path), pattern="a.*", suffixes=[".txt"])
    assert sorted((r.member, r.size, r.sha256, r.problem) for r in inv.collect()) == sorted((n, len(b), hashlib.sha256(b).hexdigest(), "") for n, b in members)
    parts = [r["count"] for r in inv.groupBy(F.spark_partition_id()).count().collect()]
    assert len(parts) >= 6 and max(parts) < 150


def test_profiles_read_a_small_share_of_the_bytes(tmp_path):
    """A member of a megabyte costs its directory and array heads."""
    big = npz(1000)
    tar(tmp_path / "a.tar", [("x_poses.npz", big), ("y_poses.npz", big)], mode="w")
    places = list(A._places(f"file://{tmp_path}/a.tar"))
    with open(tmp_path / "a.tar", "rb") as raw:
        window = A.Window(raw, places[1]["at"], places[1]["size"])
        row = A._ranged_profile("a.tar", "y_poses.npz", window, "")
        assert row["frames"] == 1000 and row["size"] == len(big) and row["sha256"] is None
        assert window.taken < 0.05 * len(big)


def test_zip_inventory_checks_the_crc(spark, tmp_path):
    good = io.BytesIO()
    with zipfile.ZipFile(good, "w") as z:
        z.writestr("P01/Upper_Walking.npz", b"hello world")
    (tmp_path / "good.zip").write_bytes(good.getvalue())
    (tmp_path / "bad.zip").write_bytes(good.getvalue().replace(b"hello", b"hullo", 1))
    inv = A.inventory(spark, str(tmp_path), pattern="*.zip", suffixes=[".npz"])
    got = {r.archive: r.problem for r in inv.collect()}
    assert got["good.zip"] == "" and got["bad.zip"].startswith("truncated:BadZipFile")
    keys = {r.key for r in A.suffix_index(inv.where("problem = ''")).collect()}
    assert keys == {"Upper_Walking.npz", "P01/Upper_Walking.npz"}


def test_members_are_classified_from_their_headers(spark, tmp_path):
    stage = {"surface_model_type": np.array("smplh"), "num_betas": np.array(16)}
    tar(tmp_path / "native.tar.bz2", [("ok_poses.npz", npz(121)), ("one_poses.npz", npz(1)), ("bad_poses.npz", npz(5, drop=["dmpls"])),
                                      ("odd_poses.npz", npz(5, gender=b"robot"))])
    tar(tmp_path / "stage.tar.bz2", [("ok_stageii.npz", npz(7, rate="mocap_frame_rate", extra=stage, drop=["dmpls"])),
                                     ("smplx_stageii.npz", npz(7, rate="mocap_frame_rate", extra={**stage, "surface_model_type": np.array("smplx")}))])
    prof = A.member_profiles(spark, str(tmp_path), pattern="*.tar.bz2", suffixes=["_poses.npz", "_stageii.npz"])
    adapter = F.when(F.col("archive").startswith("stage"), "stageii-smplh-v1").otherwise("amass-smplh-g-v1")
    got = {r.member: (r.state, r.frames) for r in A.classify_members(prof, adapter=adapter).collect()}
    assert got == {"ok_poses.npz": ("ok", 121), "one_poses.npz": ("not-motion", 1), "bad_poses.npz": ("adapter-required", 5),
                   "odd_poses.npz": ("adapter-required", 5), "ok_stageii.npz": ("ok", 7), "smplx_stageii.npz": ("adapter-required", 7)}


BVH = """HIERARCHY
ROOT Hips
{
  OFFSET 0 1 2
  CHANNELS 6 Xposition Yposition Zposition Zrotation Xrotation Yrotation
  JOINT Spine
  {
    OFFSET 0 3 0
    CHANNELS 3 Zrotation Xrotation Yrotation
    End Site
    {
      OFFSET 0 1 0
    }
  }
}
MOTION
Frames: 2
Frame Time: 0.033333
0 0 0 1 2 3 4 5 6
1 1 1 0 0 0 0 0 nan
"""


def test_motion_text(spark):
    df = spark.createDataFrame([("f", BVH)], "file string, raw string")
    long = D.motion_text(df, key="file", text="raw")
    assert long.count() == 18 and long.where("frame = 0 and column = 8").first().value == 6.0
    assert [r.rule for r in D.motion_text_rules(df, long, key="file", text="raw").collect()] == ["nonfinite"]
    joints = D.hierarchy(df, key="file", text="raw").orderBy("joint").collect()
    assert [(j.name, j.offset, len(j.channels)) for j in joints] == [("Hips", [0.0, 1.0, 2.0], 6), ("Spine", [0.0, 3.0, 0.0], 3)]
    ragged = spark.createDataFrame([("f", BVH.replace("1 1 1 0 0 0 0 0 nan", "1 1"))], "file string, raw string")
    assert [r.rule for r in D.motion_text_rules(ragged, D.motion_text(ragged, key="file", text="raw"), key="file", text="raw").collect()] == ["frame-width"]


def test_strict_json(spark):
    texts = {'{"k": 1}': "ok", '{"k": 1, "k": 2}': "duplicate-key", '{"a": {"b": 1, "b": 1}}': "duplicate-key", '{"k": NaN}': "nonfinite",
             '{"k": 1e999}': "nonfinite", '{"k": ': "malformed"}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = D.strict_json(df, text="t", schema="k double", numbers=["k"]).collect()
    assert {r.t: r.state for r in out} == texts


def test_csv_with_byte_order_mark(spark, tmp_path):
    (tmp_path / "p.csv").write_bytes("﻿Participant ,Dominant_Hand\n P01 , Right\nP02,both\n".encode())
    out = D.participant_csv(spark, str(tmp_path / "p.csv"), key="participant", domain_column="dominant_hand", domain=["left", "right"]).collect()
    assert [(r.participant, r.dominant_hand, r.in_domain) for r in out] == [("P01", "right", True), ("P02", "both", False)]


def test_create_only_write(spark, tmp_path):
    df, path = spark.range(5), str(tmp_path / "t")
    bad = lambda t: C.record_rules(t, F.col("id"), {"small": (F.col("id") < 3, F.col("id"))})
    with pytest.raises(ValueError, match="small"):
        K.create_only_write(df, path, check=bad)
    assert not (tmp_path / "t").exists() and not (tmp_path / "t.partial").exists()
    assert K.create_only_write(df, path).count() == 5
    with pytest.raises(FileExistsError):
        K.create_only_write(df, path)


def test_sinks_survive_what_a_crash_left(spark, tmp_path):
    df = spark.range(5)
    df.write.parquet(str(tmp_path / "t.partial"))
    df.write.parquet(str(tmp_path / ".t-1"))
    assert K.create_only_write(df, str(tmp_path / "t")).count() == 5
    samples = spark.createDataFrame([(0, 0, "a"), (0, 1, "b"), (1, 2, "c")], "sequence_index int, sample long, v string")
    seq = samples.select("sequence_index").distinct()
    marks = spark.createDataFrame([(0, "activity", 0, 2, "walk"), (1, "onset", 0, 0, "")], "sequence_index int, kind string, start long, stop long, code string")
    write = lambda name, s=samples, a=marks: K.write_delivery({"samples": s}, str(tmp_path / name), dataset_id="d", sequences=seq, samples=s, payload=F.col("v"), annotations=a)
    bad = samples.withColumn("v", F.when(F.col("sample") < 2, F.col("v")).otherwise(F.raise_error(F.lit("lost")).cast("string")))
    with pytest.raises(Exception, match="lost"):
        write("delivery", bad)
    assert not (tmp_path / "delivery").exists()
    first = write("delivery").first().dataset_sha256
    with pytest.raises(FileExistsError):
        write("delivery")
    shifted = samples.withColumn("sample", F.col("sample") + 500_000)
    assert write("moved", shifted, marks.orderBy(F.desc("sequence_index"))).first().dataset_sha256 == first
    other = marks.withColumn("code", F.when(F.col("kind") == "activity", "run").otherwise(F.col("code")))
    assert write("relabelled", samples, other).first().dataset_sha256 != first


def test_migration_refuses_changes(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, digest string")
    new = spark.createDataFrame([(1, "a", "t"), (2, "x", None), (4, "d", "t")], "k int, digest string, taxonomy_id string")
    got = {(r.rule, r.key) for r in K.migrated(old, new, key="k", required=["taxonomy_id", "revision"]).collect()}
    assert got == {("hash-changed", "2"), ("row-lost", "3"), ("row-added", "4"), ("missing-taxonomy_id", "2"), *(("missing-revision", k) for k in "124")}


def test_catalog_refuses_changed_plans(spark, tmp_path):
    path = str(tmp_path / "catalog")
    plans = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "source string, n int")
    K.write_catalog(plans.where("source = 'a'"), path, source="source")
    assert K.write_catalog(plans, path, source="source").count() == 3
    with pytest.raises(ValueError, match="changed"):
        K.write_catalog(plans.where("n > 1"), path, source="source")
    # What a crash leaves staged is not part of the catalog.
    plans.write.parquet(f"{path}/_staged-lost/source=c")
    assert K.write_catalog(plans, path, source="source").count() == 3
    assert sorted(p.name for p in (tmp_path / "catalog").iterdir() if p.name.startswith("source")) == ["source=a", "source=b"]


def test_catalog_is_not_dealt_by_source(spark, tmp_path):
    """Each task writes its own rows of a new source: few sources do not gather the plans in as few tasks."""
    path, plans = str(tmp_path / "catalog"), spark.range(0, 80_000, 1, 4).select((F.col("id") % 2).alias("source"), (F.col("id") * 7).alias("n"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")     # less than the stored plans, more than their sources
    try:
        K.write_catalog(plans.where("source = 0"), path, source="source")
        assert K.write_catalog(plans, path, source="source").count() == 80_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(list((tmp_path / "catalog" / "source=1").glob("*.parquet"))) == 4


def test_publish_refuses_two_contents_in_a_batch(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), "k string, sha256 string")
    path = str(tmp_path / "store")
    assert K.publish(rows(("a", "1"), ("a", "1")), path, key="k").count() == 1
    with pytest.raises(ValueError, match="two contents"):
        K.publish(rows(("b", "1"), ("b", "2")), path, key="k")
    assert K.publish(rows(("b", "1")), path, key="k").count() == 2


def test_publish_twice_is_a_no_op_and_a_change_is_refused(spark, tmp_path):
    rows = spark.createDataFrame([("a", "s1"), ("b", "s2")], "k string, sha256 string")
    path = str(tmp_path / "store")
    assert K.publish(rows.limit(1), path, key="k").count() == 1
    assert K.publish(rows, path, key="k").count() == 2 and K.publish(rows, path, key="k").count() == 2
    with pytest.raises(ValueError, match="changed"):
        K.publish(spark.createDataFrame([("a", "other")], "k string, sha256 string"), path, key="k")


def test_relabel_carries_everything_else(spark):
    core = spark.createDataFrame([(0, 0, 5, "c1", "weak", "walking", "r1"), (1, 5, 9, "c2", "unresolved", "", "")],
                                 "sequence_index int, sample_start bigint, sample_stop bigint, cid string, state string, code string, rule_id string")
    new = spark.createDataFrame([("c2", "weak", "running", "r2")], "cid string, state string, code string, rule_id string")
    out, moved = K.relabel(core, new, key="cid")
    assert moved.count() == 0 and {r.cid: r.code for r in out.collect()} == {"c1": "", "c2": "running"}


def test_layout_and_mapping_files(spark, tmp_path):
    mount = lambda i, j, q: {"id": i, "joint": j, "position_joint_m": [0.0, 0.0, 0.1], "quaternion_joint_from_sensor_wxyz": q}
    doc = {"schema": "l", "layout_id": "two", "description": "d", "status": "provisional",
           "mounts": [mount("a", "head", [1.0, 0, 0, 0]), mount("a", "tail", [1.0, 1.0, 0, 0])]}
    (tmp_path / "l.json").write_text(json.dumps(doc, indent=1))
    mounts = D.layout_mounts(spark, str(tmp_path / "l.json"))
    assert sorted(r.rule for r in D.layout_rules(mounts, ["head"]).collect()) == ["duplicate-mount", "mount-joint", "mount-rotation"]
    m = {"schema": "m", "adapter_id": "x", "description": "d", "position_scale_m": 0.01, "world_from_source_matrix": [[1.0]], "joint_map": {"Hips": "pelvis", "Head": "head"}}
    (tmp_path / "m.json").write_text(json.dumps(m))
    assert config.mapping_rules(config.load_mapping(spark, str(tmp_path / "m.json")), ["pelvis"]).collect()[0].key == "Head"


# --- streams -----------------------------------------------------------------------------------

FEED = "feed_key string, candidate_id string, version_id string, posted_at timestamp"


def put(folder, name, rows):
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def test_feed_is_read_once_and_a_repost_is_found_once(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    row = lambda k, c, t: {"feed_key": k, "candidate_id": c, "version_id": "v", "posted_at": t}
    put(feed, "1.json", [row("k1", "a", "2024-01-01T00:00:00Z"), row("k2", "b", "2024-01-01T00:01:00Z")])
    out = str(tmp_path / "out")
    run = lambda: S.deduplicated_feed(S.tail(spark, str(feed), FEED, fmt="json"), time="posted_at", keys=["candidate_id", "version_id"], out=out)
    assert sorted(r.candidate_id for r in run().collect()) == ["a", "b"]
    put(feed, "2.json", [row("k9", "a", "2024-01-03T00:00:00Z"), row("k3", "c", "2024-01-03T00:00:00Z")])
    got = {r.candidate_id: r.feed_key for r in run().collect()}
    assert got == {"a": "k1", "b": "k2", "c": "k3"}


def test_late_rows_and_the_newest_window_come_out(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    row = lambda k, c, t: {"feed_key": k, "candidate_id": c, "version_id": "v", "posted_at": t}
    stream = lambda: S.tail(spark, str(feed), FEED, fmt="json", files=1)
    first = lambda: S.deduplicated_feed(stream(), time="posted_at", keys=["candidate_id", "version_id"], out=str(tmp_path / "first"))
    count = lambda: S.rolling_counts(stream(), time="posted_at", out=str(tmp_path / "count"))
    assert first().columns == ["feed_key", "candidate_id", "version_id", "posted_at"] and first().count() == 0 and count().count() == 0
    put(feed, "1.json", [row("k1", "a", "2024-01-01T00:00:00Z"), row("k1", "a", "2024-01-01T00:00:00Z")])
    put(feed, "2.json", [row("k2", "b", "2024-01-09T00:00:30Z")])
    first()
    put(feed, "3.json", [row("k3", "late", "2023-12-01T00:00:00Z"), row("k0", "a", "2023-12-31T00:00:00Z")])
    assert {r.candidate_id: r.feed_key for r in first().collect()} == {"a": "k0", "b": "k2", "late": "k3"}
    got = {r.window_start.strftime("%Y-%m-%d %H:%M"): r.published for r in count().collect()}
    assert len(got) == 40 and got["2024-01-09 00:00"] == 1 and got["2024-01-01 00:00"] == 2 and got["2023-12-01 00:00"] == 1


def test_reposts_of_lost_feed_rows(spark):
    commits = spark.createDataFrame([("a", "1", 10), ("b", "1", 11), ("c", "2", 12)], "candidate_id string, version_id string, size int")
    feed = spark.createDataFrame([("a-1-1", "a", "1"), ("b-1-1", "b", "1")], "feed_key string, candidate_id string, version_id string")
    keys = ["candidate_id", "version_id"]
    assert sorted(r.feed_key for r in S.reposts(feed, commits, keys=keys, feed_key="feed_key").collect()) == ["c-2-1"]
    stored = feed.where("candidate_id = 'a'")
    assert sorted(r.feed_key for r in S.reposts(feed, commits, keys=keys, feed_key="feed_key", stored=stored).collect()) == ["b-1-2", "c-2-1"]


def test_status_stream_equals_the_batch_fold_over_several_batches(spark, tmp_path):
    from strideframe.operators import ledger as L
    log = tmp_path / "log"
    log.mkdir()
    kinds = ["pending-publish", "failed", "published", "excluded"]
    rows = [{"clip": f"c{i % 7}", "seq": i, "status": kinds[(i * i) % 4], "error": None} for i in range(60)]
    for b in range(4):
        put(log, f"{b}.json", rows[b * 15:(b + 1) * 15])
    schema = "clip string, seq bigint, status string, error string"
    stream = S.tail(spark, str(log), schema, fmt="json", files=1)
    got = S.standing_status(stream, key="clip", order=["seq"], status="status", error="error", out=str(tmp_path / "out"))
    want = L.current_status(spark.read.schema(schema).json(str(log)), key="clip", order=["seq"], status="status", error="error")
    assert sorted(map(tuple, got.select("clip", "status").collect())) == sorted(map(tuple, want.select("clip", "status").collect()))


def test_runs_fold_and_stay_few(spark, tmp_path):
    """Many batches: few runs to open, the same totals, and batches that run again change nothing."""
    merge = lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n"))
    runs = Runs(spark, str(tmp_path / "t"), "k string, n bigint", merge, fan=3)
    assert runs.rows().count() == 0
    one = lambda i: spark.createDataFrame([("all", 1), (f"k{i % 5}", i)], "k string, n bigint").coalesce(1)
    total = 31
    for i in range(total):
        runs.add(one(i), i)
        if i % 7 == 0:
            runs.add(one(i), i)
    live = runs._runs()
    assert len(live) <= 2 * 4 and [r[1] for r in live] == [0, *[r[2] + 1 for r in live[:-1]]] and live[-1][2] == total - 1
    want = {"all": total} | {f"k{k}": sum(i for i in range(total) if i % 5 == k) for k in range(5)}
    assert {r.k: r.n for r in merge(runs.rows()).collect()} == want
    assert len(list((tmp_path / "t" / "runs").iterdir())) <= len(live) + 6 and len(list((tmp_path / "t" / "manifests").glob("*.json"))) == 2


def test_a_crash_before_the_manifest_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    merge = lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n"))
    runs = Runs(spark, str(tmp_path / "t"), "k string, n bigint", merge, fan=2)
    one = spark.createDataFrame([("a", 1)], "k string, n bigint")
    runs.add(one, 0)
    held = runs.store.put_json

    def crash(key, value):
        raise RuntimeError("lost")

    monkeypatch.setattr(runs.store, "put_json", crash)
    with pytest.raises(RuntimeError):
        runs.add(one, 1)
    assert [r.n for r in merge(runs.rows()).collect()] == [1]
    monkeypatch.setattr(runs.store, "put_json", held)
    runs.add(one, 1)
    runs.add(one, 2)
    assert [r.n for r in merge(runs.rows()).collect()] == [3]


def test_object_store(spark, tmp_path):
    store = ObjectStore(spark, str(tmp_path / "store"))
    assert store.keys() == [] and not store.exists("a/b.json")
    store.put_json("a/b.json", {"y": 1, "x": "é"})
    store.put_json("a/b.json", {"x": "é", "y": 1})
    store.put("a/c.bin", b"\x00\xff")
    store.put("z", b"")
    assert store.keys() == ["a/b.json", "a/c.bin", "z"] and store.keys("a") == ["a/b.json", "a/c.bin"] and store.keys("none") == []
    assert store.read_json("a/b.json") == {"x": "é", "y": 1} and store.read("a/c.bin") == b"\x00\xff"
    with pytest.raises(ValueError):
        store.put("a/c.bin", b"other")
    with pytest.raises(FileNotFoundError):
        store.read("none")
    for key in ("/etc/x", "../x", "a/../../x"):
        with pytest.raises(ValueError):
            store.put(key, b"")
    assert sorted(map(tuple, store.objects("a").collect())) == [(k, len(store.read(k))) for k in ("a/b.json", "a/c.bin")]
    assert {r.key: bytes(r.content) for r in store.contents("a").collect()} == {k: store.read(k) for k in ("a/b.json", "a/c.bin")}
    store.delete("a")
    assert store.keys() == ["z"]


def test_commit_rows_follow_their_objects(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    put(log, "0.json", [{"id": 1, "body": "x"}])
    run = lambda: S.commit_last(S.tail(spark, str(log), "id bigint, body string", fmt="json"), key="id", digest=F.sha2("body", 256), out=str(tmp_path / "o"))
    assert run().count() == 1 and run().count() == 1
    put(log, "1.json", [{"id": 2, "body": "y"}])
    assert run().count() == 2


def test_feed_names_round_trip(spark):
    df = spark.createDataFrame([("2024-05-06 07:08:09.000123", "c-1")], "t string, c string").withColumn("t", F.to_timestamp("t"))
    key = ids.feed_key(F.lit("p"), F.col("t"), F.col("c"), F.sha2("c", 256))
    cand, version = ids.feed_pair(key)
    r = df.select(key.alias("k"), cand.alias("a"), version.alias("v")).first()
    assert r.k.startswith("p/index-feed/2024050607/20240506T070809000123Z-c-1-") and r.a == "c-1" and len(r.v) == 64
    bad = ids.feed_pair(F.lit("p/index-feed/x.json"))
    assert df.select(bad[0].alias("a")).first().a is None


def test_slug_and_prefix(spark):
    df = spark.createDataFrame([("KIT/3/Walk (Fast)_poses.npz",)], "m string")
    r = df.select(ids.slug_id(F.col("m")).alias("s"), ids.publication_prefix(F.lit("prod"), F.lit(None).cast("string")).alias("p"),
                  ids.publication_prefix(F.lit("prod"), F.lit("r1")).alias("n"), ids.publication_prefix(F.lit("dev"), F.lit("r.1")).alias("d")).first()
    assert r.s.startswith("kit-3-walk-fast-") and len(r.s.rsplit("-", 1)[1]) == 8
    assert (r.p, r.n, r.d) == ("synthetic-motion/prod/v1", None, "synthetic-motion/dev/r.1/v1")


@pytest.mark.parametrize("pack,mode", [("_tar", "w|"), ("_tar", "w|gz"), ("_zip", None)])
def test_archives_are_written_member_by_member(pack, mode):
    """what is held is a member, not the archive."""
    import io
    import os
    from strideframe.bindings import derived
    sent, data = [0], os.urandom(40_000)

    class Stream(io.BytesIO):
        def write(self, b):
            sent[0] += len(b)
            return super().write(b)

    def members():
        for i in range(20):
            assert sent[0] >= (i - 1) * len(data) - 20_000
            yield f"m{i}", data

    out = Stream()
    getattr(derived, pack)(*[out, members(), mode][:3 if mode else 2])
    assert sent[0] >= 20 * len(data)


def test_members_at_places_are_sent_on_in_small_frames(tmp_path):
    """rows of many members are not held together."""
    import io
    import tarfile
    import pandas as pd
    from strideframe.sources import archives as A
    path = f"{tmp_path}/a.tar"
    with tarfile.open(path, "w") as t:
        info = tarfile.TarInfo("m.txt")
        info.size = 5
        t.addfile(info, io.BytesIO(b"hello"))
    row = dict(path=f"file://{path}", member="m.txt", at=512, stored=5, size=5, crc=None, method=None, problem="")
    frames = list(A._from_places((".txt",), A._plain)([pd.DataFrame([row] * 2500)]))
    assert [len(f) for f in frames] == [1000, 1000, 500] and set(frames[0]["size"]) == {5}


def test_shards_are_written_by_many_tasks(spark, tmp_path):
    """Small shards are not left to one task, and each is whole in one file in its order."""
    df = spark.range(400).selectExpr("id AS k", "id % 2 AS dataset", "cast(id DIV 10 AS bigint) AS shard").repartition(5)
    out = K.write_shards(df, str(tmp_path / "shards"), shard=["dataset", "shard"], order=["k"])
    files = glob.glob(str(tmp_path / "shards/*/*/part-*.parquet"))
    assert len(files) == 80 and len({os.path.basename(f).split("-")[1] for f in files}) > 1
    assert len({os.path.dirname(f) for f in files}) == 80
    assert sorted((r.k, r.dataset, r.shard) for r in out.collect()) == [(k, k % 2, k // 10) for k in range(400)]
    assert [r.k for r in spark.read.parquet(str(tmp_path / "shards/dataset=1/shard=3")).collect()] == [31, 33, 35, 37, 39]


def test_stored_shards_are_not_listed_by_the_driver(spark, tmp_path):
    """Files of shards are read by a stored list of them, which is one row a shard, by tasks."""
    df = spark.range(400).selectExpr("id AS k", "id % 2 AS dataset", "cast(id DIV 10 AS bigint) AS shard").repartition(5)
    path = str(tmp_path / "shards")
    out = K.write_shards(df, path, shard=["dataset", "shard"], order=["k"])
    assert not [f for f in out.inputFiles() if "shard=" in f]
    listed = spark.read.parquet(f"{path}/_shards").collect()
    assert len(listed) == 80 and {r._rows for r in listed} == {5}
    assert all(os.path.getsize(f"{path}/{r._path}") == r._bytes for r in listed)
    assert sorted(os.listdir(path)) == ["_shards", "dataset=0", "dataset=1"] and os.listdir(tmp_path) == ["shards"]
    assert sorted(spark.read.parquet(path).select("k", "dataset", "shard").collect()) == sorted(out.select("k", "dataset", "shard").collect())
    with pytest.raises(FileExistsError):
        K.write_shards(df, path, shard=["dataset", "shard"], order=["k"])


def test_shards_of_odd_names_and_values(spark, tmp_path):
    """Folders are named as by Spark, and rows come back as they were: null and empty names, nested values, times."""
    names = [None, "", "1-URGENT/5", "a b%=c", "é'\"{}[]^:?*#\\", "tab\there", "x\x7f"]
    rows = [(i, names[i % len(names)], datetime.date(2024, 1, 1 + i % 2), None if i % 5 == 0 else [(f"s{i}", i)], Decimal(i) / 4, i % 3 == 0,
             datetime.datetime(2024, 5, 1, 12, 0, i % 60), None if i % 4 == 0 else {"a": float(i)}) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, name string, day date, blobs array<struct<sha256:string,size:bigint>>, d decimal(12,2), flag boolean, at timestamp, m map<string,double>")
    path = str(tmp_path / "shards")
    out = K.write_shards(df, path, shard=["name", "day", "flag"], order=["k"])
    assert sorted(map(str, out.select(df.columns).collect())) == sorted(map(str, df.collect()))
    df.write.partitionBy("name", "day", "flag").parquet(str(tmp_path / "spark"))
    folders = lambda top: {os.path.relpath(os.path.dirname(f), top) for f in glob.glob(f"{top}/*/*/*/part-*.parquet")}
    assert folders(path) == folders(str(tmp_path / "spark"))
    none = K.write_shards(df.where("k < 0"), str(tmp_path / "none"), shard=["name"], order=["k"])
    assert none.count() == 0 and set(none.columns) == set(df.columns)


def test_a_shard_leaves_in_pieces(spark, tmp_path, monkeypatch):
    """A shard of many batches is one file of several row groups, in its order."""
    monkeypatch.setattr(shards, "GROUP_BYTES", 100_000)
    df = spark.range(60_000).selectExpr("(id * 7919) % 60000 AS k", "cast(id % 2 AS int) AS shard")
    out = K.write_shards(df, str(tmp_path / "shards"), shard=["shard"], order=["k"])
    files = glob.glob(str(tmp_path / "shards/shard=*/*.parquet"))
    assert len(files) == 2 and all(pq.ParquetFile(f).num_row_groups > 1 for f in files)
    assert all((ks := pq.ParquetFile(f).read(["k"])["k"].to_pylist()) == sorted(ks) and len(ks) == 30_000 for f in files)
    assert out.count() == 60_000 and out.select("k").distinct().count() == 60_000


def test_a_shard_task_that_runs_twice_is_harmless(spark, tmp_path):
    """The second run of a task puts its whole files in the place of the first's."""
    root, twice = f"file://{tmp_path}", [pa.RecordBatch.from_pydict({"s": [1, 1, 2], "k": [5, 6, 7], "_texts": [["1"], ["1"], ["2"]]})]
    os.makedirs(tmp_path / shards.PARTS)
    monkey = type("Task", (), {"partitionId": lambda self: 3})
    import pyspark
    kept, pyspark.TaskContext.get = pyspark.TaskContext.get, staticmethod(lambda: monkey())
    try:
        got = [list(shards._writer(root, ["s"], ["k"])(iter(twice)))[0].to_pydict() for _ in range(2)]
    finally:
        pyspark.TaskContext.get = kept
    assert got[0] == got[1] and got[0]["_rows"] == [2, 1] and not os.listdir(tmp_path / shards.PARTS)
    assert len(glob.glob(str(tmp_path / "s=*/*"))) == 2


def test_stores_that_tasks_can_not_open_are_left_to_spark():
    assert shards.reachable("file:///tmp") and not shards.reachable("s3a://bucket/x")
