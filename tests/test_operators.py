"""Golden vectors of the operators."""

import json
import math
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewright import schema
from tracewright.functions import names as N
from tracewright.functions import quaternion as Q
from tracewright.operators import align, asof, assemble, motion, parts, planning, quality
from tracewright.plans import pipelines
from tracewright.sources import listing, metadata, readers, writers
from tracewright.streaming import sync as live


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "name,strict,lenient",
    [
        ("frame1756826516968031906_left.jpg", 1756826516968031906, 1756826516968031906),
        ("frame1234_right.jpg", 1234, 1234),
        ("frame000000_psm1_10_500.jpg", 10000000500, 10000000500),
        ("frame999_left_0_100.jpg", 100, 100),
        ("frame_missing.jpg", None, None),
        ("left_12345.jpg", None, None),
        ("1234_left.jpg", None, None),
        ("frame1234center.jpg", None, 1234),
        ("frame1234_left.png", None, 1234),
    ],
)
def test_frame_timestamp(spark, name, strict, lenient):
    assert one(spark, N.frame_timestamp(F.lit(name))) == strict
    assert one(spark, N.frame_timestamp(F.lit(name), lenient=True)) == lenient


def test_timestamp_column_and_plain_names():
    assert schema.timestamp_column(["x", "TimeStamp", "time"]) == "TimeStamp"
    assert schema.timestamp_column(["x"]) is None
    assert schema.plain("psm1_pose.position.x") == "psm1_pose_position_x" and schema.plain("psm1_js[0]") == "psm1_js_0"
    assert len(schema.MOTION_COLUMNS) == 22 and len(schema.STATE_COLUMNS) == len(schema.ACTION_COLUMNS) == 16


def streams(spark, images, samples):
    left = spark.createDataFrame([("e", t) for t in images], "episode_id string, ts_ns long")
    kin = spark.createDataFrame([("e", i, t) for i, t in enumerate(samples)], "episode_id string, kin_idx long, ts_ns long")
    return left, kin


def test_nearest(spark):
    left, kin = streams(spark, [10, 20, 30], [8, 18, 35])
    got = asof.synchronized(left, kin, ["episode_id"], tolerance_ms=None).orderBy("ts_ns").collect()
    assert [r.kinematics_idx for r in got] == [0, 1, 2] and [r.time_diff_ns for r in got] == [2, 2, -5]


@pytest.mark.parametrize("images,samples", [([], [1, 2]), ([1, 2], [])])
def test_nearest_of_nothing(spark, images, samples):
    left, kin = streams(spark, images, samples)
    assert asof.synchronized(left, kin, ["episode_id"]).count() == 0


def test_nearest_against_searchsorted(spark):
    rng = np.random.default_rng(5)
    images, samples = sorted(rng.integers(0, 200, 120).tolist()), sorted(rng.integers(0, 200, 60).tolist())
    left, kin = streams(spark, images, samples)
    k = np.array(samples)
    at = np.clip(np.searchsorted(k, images), 0, len(k) - 1)
    before = np.clip(at - 1, 0, len(k) - 1)
    want = np.where(np.abs(np.array(images) - k[before]) < np.abs(np.array(images) - k[at]), before, at)
    got = asof.synchronized(left, kin, ["episode_id"], tolerance_ms=None).orderBy("ts_ns").collect()
    assert sorted((r.ts_ns, r.kinematics_idx) for r in got) == sorted(zip(images, want.tolist(), strict=True))


def test_all_matching_is_inclusive(spark):
    left, other = streams(spark, [1000, 2000, 3000], [900, 2005, 3050, 4000])
    got = asof.all_matching(left, {"right": other}, ["episode_id"], "ts_ns", "kin_idx", 50).orderBy("ts_ns").collect()
    assert [(r.ts_ns, r.right.kin_idx) for r in got] == [(2000, 1), (3000, 2)]
    assert asof.all_matching(left, {"right": other.limit(0)}, ["episode_id"], "ts_ns", "kin_idx", 50).count() == 0


def test_outliers(spark):
    df = spark.createDataFrame([(x,) for x in (10.0, -15.0, 35.0, -45.0, 0.0)], "time_diff_ms double")
    assert sorted(r[0] for r in asof.without_outliers(df, 30).collect()) == [-15.0, 0.0, 10.0]


def test_gather_keeps_repeats(spark):
    kin = spark.createDataFrame([("e", i, (i + 1) * 1000, i + 1) for i in range(5)], "episode_id string, kin_idx long, ts_ns long, x long")
    sync = spark.createDataFrame([("e", 1), ("e", 3), ("e", 3)], "episode_id string, kinematics_idx long")
    assert sorted(r.x for r in asof.gathered(sync, kin, ["episode_id"]).collect()) == [2, 4, 4]


def rows_of(spark, rows, names):
    return spark.createDataFrame([("e", i, *map(float, r)) for i, r in enumerate(rows)], "e string, i long, " + ", ".join(f"`{n}` double" for n in names))


def test_deltas(spark):
    got = motion.deltas(rows_of(spark, [(1, 2), (2, 4), (5, 8)], ["a", "b"]), ["e"], ["i"], ["a", "b"]).orderBy("i").collect()
    assert got[0].delta is None and got[0].t == -1 and [r.delta for r in got[1:]] == pytest.approx([5**0.5, 5.0])


def test_quaternion_flips_are_not_motion(spark):
    s = [1, -1, 1, 1, -1]
    df = rows_of(spark, [(0, 0, 0.707 * k, 0.707 * k) for k in s], list("xyzw"))
    got = motion.deltas(df, ["e"], ["i"], list("xyzw"), [list("xyzw")]).where("delta IS NOT NULL").collect()
    assert max(r.delta for r in got) < 1e-3


def test_quaternion_signs_follow_the_loop(spark):
    rng = np.random.default_rng(2)
    q = rng.normal(size=(60, 4))
    q[20], q[40] = (1, 0, 0, 0), (0, 0, 0, 0)
    q[21] = (0, 1, 0, 0)
    want, last = [], q[0]
    for i, v in enumerate(q):
        s = -1 if i and np.dot(last, v) < 0 else 1
        last = s * v
        want.append(s)
    df = spark.createDataFrame([("e", i, v.tolist()) for i, v in enumerate(q)], "e string, i long, q array<double>")
    assert [r.sign for r in motion.quaternion_signs(df, ["e"], ["i"], "q").orderBy("i").collect()] == want


@pytest.mark.parametrize("d,n,want", [([0, 0, 0.5, 0.8, 0, 0], 7, (2, 4)), ([0, 0.01, 0, 0.01], 5, (0, 4)), ([float("nan"), 0, 0.5], 4, (2, 3))])
def test_trim_range(spark, d, n, want):
    df = spark.createDataFrame([("e", -1, None)] + [("e", t, float(x)) for t, x in enumerate(d)], "e string, t long, delta double")
    r = motion.trim_ranges(df, ["e"], 0.1).first()
    assert (r.n_rows, r.start, r.end) == (n, *want)


@pytest.mark.parametrize("js,min_length,reason", [([0, 0, 5, 10, 10], 2, "trimmed"), ([0, 0, 5, 0, 0], 10, "trimmed length 3 < min 10"), ([1], 2, "too few rows"), ([0, 5, 10], 2, "no stationary frames detected")])
def test_trim_report(spark, js, min_length, reason):
    df = rows_of(spark, [(x,) for x in js], ["a"])
    m = motion.deltas(df, ["e"], ["i"], ["a"])
    report = motion.trim_report(motion.trim_ranges(m, ["e"], 1.0), min_length)
    assert report.first().reason == reason
    if reason == "trimmed":
        assert [r.i for r in motion.trimmed(df, report, ["e"], "i").orderBy("i").collect()] == [1, 2, 3]


@pytest.mark.parametrize("values", [[], [2.0], [1.0, 1.0, 2.0], [1e-300, 5.0, 7.5, float("nan"), 0.0, None], [round(float(x), 2) for x in np.random.default_rng(3).exponential(1, 3000)]])
def test_percentiles(spark, values):
    got = motion.delta_percentiles(spark.createDataFrame([(x,) for x in values], "delta double")).collect()
    held = [x for x in values if x is not None and x > 0]
    want = np.percentile(held, [5, 25, 50]).tolist() if held else [None] * 3
    assert len(got) == 1 and list(got[0]) == pytest.approx(want)


def test_roll_up(spark):
    rows = [(i, "ERROR" if i % 5 == 0 else "WARNING" if i % 3 == 0 else "INFO", None if i % 7 == 0 else f"c{i % 2}", None if i == 5 else f"m{i}") for i in range(30)]
    found = quality.roll_up(spark.createDataFrame(rows, "seq long, level string, category string, message string"))
    want = {(None, 1, 1, False, "m0|m21|m7"), ("c0", 2, 4, False, "m10|m20|m6"), ("c1", 3, 3, False, "m15|m25")}
    assert {tuple(r) for r in found.collect()} == want
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()


def test_quaternions(spark):
    a = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    assert one(spark, Q.normalize(a(2, 0, 0, 0))) == [1, 0, 0, 0]
    assert one(spark, Q.normalize(a(1, 1, 1, 1))) == [0.5] * 4
    assert one(spark, Q.normalize(a(0, 0, 1e-10, 0))) == [0, 0, 0, 1]
    assert one(spark, Q.inverse(a(0.5, 0.5, 0.5, 0.5))) == [-0.5, -0.5, -0.5, 0.5]
    assert one(spark, Q.multiply(a(0, 0, 0, 1), a(0, 0, 0, 1))) == [0, 0, 0, 1]
    assert one(spark, Q.multiply(a(1, 0, 0, 0), a(0, 1, 0, 0))) == [0, 0, 1, 0]
    assert one(spark, Q.continued(a(0, 0, 0, 1), a(0, 0, 0, -1))) == [0, 0, 0, 1]
    now = [0.0] * 3 + [0, 0, 0, 1, 1] + [0.0] * 3 + [0, 0, 0, 1, 0]
    later = [1, -1, 0.5, 0, 0, 0, 1, 2, 0, 0.5, 0, 0, 1, 0, 0, 1]
    assert one(spark, Q.hybrid_relative(a(*now), a(*later))) == pytest.approx([1, -1, 0.5, 0, 0, 0, 1, 1, 0, 0.5, 0, 0, 1, 0, 0, 0])


def test_align_trim_and_back(spark):
    ref = spark.createDataFrame([("e", i, i * 1000) for i in range(30)], "episode_id string, idx long, ts_ns long")
    src = spark.createDataFrame([("e", i, (i + 2) * 1000) for i in range(28)], "episode_id string, idx long, ts_ns long")
    js = [0.0] * 10 + [10.0] * 10 + [20.0] * 8
    kin = spark.createDataFrame([("e", i, x) for i, x in enumerate(js)], "episode_id string, i long, a double")
    plan = spark.createDataFrame([("e", 0, 1, 28)], "episode_id string, plan_id long, start long, end long")
    out = pipelines.trimmed_plan(plan, ref, src, motion.deltas(kin, ["episode_id"], ["i"], ["a"]), 1.0).collect()
    assert [(r.start, r.end) for r in out] == [(11, 22)]
    empty = align.align_ranges(spark.createDataFrame([("e", 0, 40, 50)], plan.schema), ref, src, ["episode_id"], ["plan_id"], ts="ts_ns").first()
    assert (empty.src_start, empty.src_end) == (27, 27)


def test_sessions_and_annotations(spark):
    names = ["cautery_tissue1_recordingABC_left_video", "john_tissue5_20261111", "some_random_bad_format_session"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(N.session_parts(F.col("n")).alias("s")).collect()
    assert [r.s and tuple(r.s) for r in got] == [(1, "recordingABC", None), (5, "20261111", "john"), None]
    paths = ["a/action_1.json", "a/action_2.JSON", "a/nested/action_3.json", "a/bad_prompt.json", "a/not_json.txt"]
    assert planning.annotation_files(spark.createDataFrame([(p,) for p in paths], "path string")).count() == 3
    raw = [{"action": " Grasp ", "affordance_range": {"start": 50, "end": 100}}, {"action": "dissect", "affordance_range": {"start": 200, "end": 450}}, {"action": "x", "affordance_range": {}}, {"action": "y"}]
    df = spark.createDataFrame([("c", i, json.dumps(x)) for i, x in enumerate(raw)] + [("c", 9, "{broken")], "who string, i long, value string")
    plan = pipelines.planned_episodes(df, ["who"], ["i"]).orderBy("i").collect()
    assert [(r.dst, r.start, r.end) for r in plan] == [("c/1_grasp/episode_001", 50, 100), ("c/2_dissect/episode_001", 200, 450)]


def test_listing(spark, tmp_path):
    for e in ("Tissue#2/jo/p1/3_cut/s1", "Tissue#1/s2", "other/s3"):
        (tmp_path / e / "left_img_dir").mkdir(parents=True)
        (tmp_path / e / "ee_csv.csv").write_text("t\n1\n")
        (tmp_path / e / "left_img_dir" / "frame5_left.jpg").write_bytes(b"")
    (tmp_path / "Tissue#1/empty/left_img_dir").mkdir(parents=True)
    (tmp_path / "Tissue#1/empty/ee_csv.csv").write_text("")
    (tmp_path / "no_csv/left_img_dir").mkdir(parents=True)
    entries = listing.listed(spark, str(tmp_path))
    assert [r.episode_id for r in listing.episodes(entries).collect()] == ["Tissue#1/empty", "Tissue#1/s2", "Tissue#2/jo/p1/3_cut/s1", "other/s3"]
    d = listing.direct_episodes(entries).collect()
    assert [(r.tissue_num, r.collector, r.phase, r.action) for r in d] == [(1, "", "", "s2"), (2, "jo", "p1", "3_cut")]
    frames = listing.frames(entries, {"left": ("left_img_dir", "_left.jpg")})
    assert frames.count() == 3 and {r.ts_ns for r in frames.collect()} == {5}
    with pytest.raises(FileNotFoundError):
        listing.listed(spark, str(tmp_path / "nowhere"))


def test_kinematics_reader(spark, tmp_path):
    (tmp_path / "e1").mkdir()
    (tmp_path / "e1" / "ee_csv.csv").write_text("x,psm1_js[0],psm1_pose.position.x\n1,2,3\n4,5,6\n7,8,9\n")
    got = readers.kinematics(spark, str(tmp_path / "e1" / "ee_csv.csv")).orderBy("kin_idx").collect()
    assert [r.ts_ns for r in got] == [0, 33333333, 66666666] and got[1].psm1_js_0 == 5 and got[1].episode_id == "e1"


def test_dataset_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(e, i, i / 30, [float(i)] * 16) for e in range(3) for i in range(5)], "episode_index long, frame_index long, timestamp double, action array<float>")
    writers.write_dataset(rows, str(tmp_path))
    back = readers.dataset(spark, str(tmp_path), 1)
    assert [r.frame_index for r in back.orderBy("frame_index").collect()] == list(range(5))
    names = sorted(str(f.relative_to(tmp_path)) for f in tmp_path.rglob("*.parquet"))
    assert names == [f"data/chunk-000/episode_{e:06d}.parquet" for e in range(3)] == sorted(r.path for r in writers.file_manifest(rows).collect())
    assert len(readers.dataset(spark, str(tmp_path), 1).inputFiles()) == 1 and readers.dataset(spark, str(tmp_path)).count() == 15
    with pytest.raises(FileExistsError):
        writers.write_dataset(rows, str(tmp_path))
    ordered = readers.in_file_order(spark, f"{tmp_path}/data/chunk-*/*.parquet")
    assert quality.index_integrity(ordered, ["_file"], "frame_index", ["_row"], "episode_index").where("NOT ok").count() == 0
    assert writers.file_manifest(rows).orderBy("path").first().path == "data/chunk-000/episode_000000.parquet"
    out = writers.write_splits(spark.createDataFrame([(10, 7, 3)], "n long, perfect long, recovery long"), str(tmp_path))
    assert out == {"train": "0:8", "val": "8:9", "test": "9:10", "perfect": "0:7", "recovery": "7:10"}
    assert json.load(open(tmp_path / "meta" / "info.json"))["splits"] == out


def test_index_is_checked_in_file_order(spark, tmp_path):
    spark.createDataFrame([(2, 0), (0, 0), (1, 0)], "frame_index int, episode_index int").coalesce(1).write.parquet(str(tmp_path / "mixed"))
    spark.createDataFrame([(0, 0), (1, 0), (2, 7)], "frame_index int, episode_index int").coalesce(1).write.parquet(str(tmp_path / "two"))
    for name in ("mixed", "two"):
        rows = readers.in_file_order(spark, str(tmp_path / name))
        assert not quality.index_integrity(rows, ["_file"], "frame_index", ["_row"], "episode_index").first().ok


def test_tree_to_dataset(spark, tmp_path):
    """Folders with equal leaf names stay apart from the listing to the dataset's files."""
    root = tmp_path / "in put"
    for k, e in enumerate(("t1/ep1", "t2/ep1", "t2/no_csv")):
        for folder, camera in (("left_img_dir", "left"), ("right_img_dir", "right")):
            (root / e / folder).mkdir(parents=True)
            for i in range(20):
                (root / e / folder / f"frame{1000 + 100 * i + k}_{camera}.jpg").write_bytes(b"")
        if e != "t2/no_csv":
            names = ["timestamp", *schema.STATE_COLUMNS, *schema.ACTION_COLUMNS]
            lines = [",".join(names)] + [",".join([str(1000 + 50 * i + k), *[str(k + i + j / 100) for j in range(len(names) - 1)]]) for i in range(50)]
            (root / e / "ee_csv.csv").write_text("\n".join(lines) + "\n")
    entries = listing.listed(spark, str(root))
    frames = listing.frames(entries, {"left": ("left_img_dir", "_left.jpg"), "right": ("right_img_dir", "_right.jpg")})
    kin = readers.kinematics(spark, [str(root / e / "ee_csv.csv") for e in ("t1/ep1", "t2/ep1")], str(root))
    assert sorted(r.episode_id for r in kin.select("episode_id").distinct().collect()) == ["t1/ep1", "t2/ep1"]
    wanted = listing.episodes(entries)
    left, right = (frames.where(f"camera = '{c}'").join(wanted, "episode_id").select("episode_id", "frame_name", "ts_ns") for c in ("left", "right"))
    out = pipelines.filter_episodes(left, {"right": right}, kin, tolerance_ms=0.001)
    assert sorted((r.episode_id, r.n_kept) for r in out.report.collect()) == [("t1/ep1", 20), ("t2/ep1", 20)]
    rows = assemble.with_state_and_action(out.kinematics)
    rows = planning.numbered_episodes(rows.select("episode_id").distinct().withColumn("all", F.lit(0)), ["all"], ["episode_id"], "episode_index", 0).join(rows, "episode_id")
    done = pipelines.converted(rows, "episode_index", ["frame_idx"], "state", "action", ["episode_id"])
    writers.write_dataset(done, str(tmp_path / "out"))
    back = readers.dataset(spark, str(tmp_path / "out"), 1).orderBy("frame_index").collect()
    assert len(back) == 20 and [r.frame_index for r in back] == list(range(20))
    assert back[3].observation_state == pytest.approx([1 + 6 + j / 100 for j in range(16)]) and back[3].action == pytest.approx([1 + 6 + j / 100 for j in range(16, 32)])
    with pytest.raises(ValueError):
        assemble.with_state_and_action(out.kinematics.select("episode_id"))


def test_motion_samples_read_motion_columns_only(spark, tmp_path):
    (tmp_path / "e1").mkdir()
    (tmp_path / "e1" / "ee_csv.csv").write_text("time,note,psm1_js[0],psm2_jaw\n1,a,2,3\n4,b,5,x\n")
    got = readers.motion_samples(spark, str(tmp_path / "e1" / "ee_csv.csv"), str(tmp_path))
    assert got.columns == ["time", "psm1_js_0", "psm2_jaw", "episode_id", "kin_idx", "ts_ns"]
    assert [(r.ts_ns, r.psm1_js_0, r.psm2_jaw) for r in got.orderBy("kin_idx").collect()] == [(1, 2.0, 3.0), (4, 5.0, None)]
    assert readers.raw_rows(spark, str(tmp_path / "e1" / "ee_csv.csv")).first().cells == ["time", "note", "psm1_js[0]", "psm2_jaw"]


def test_natural_keys_of_long_numbers(spark):
    texts = ["f" + "9" * 30, "f1" + "0" * 30, "f02", "f10", "F3", "g1", "f"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").orderBy(N.natural_key(F.col("t"))).collect()
    assert [r.t for r in rows] == ["f", "f02", "F3", "f10", "f" + "9" * 30, "f1" + "0" * 30, "g1"]


def parts_of(name):
    out = []
    for p in re.split(r"([0-9]+)", name.lower()):
        out.append(int(p) if p.isdigit() else p)
    return out


def test_natural_keys_sort_as_lists_of_parts(spark):
    rng = random.Random(4)
    marks = [chr(c) for c in range(1, 128)] + ["é", "中"]
    names = ["a1.jpg", "a-1.jpg", "a.jpg", "frame 2.png", "frame.png", "frame2.png", "", "1", "01", "a", "a1", "a1b", "a 1", "10", "9z"]
    names += ["".join(rng.choice(["a", "B", str(rng.randrange(12)), "00", rng.choice(marks)]) for _ in range(rng.randrange(1, 8))) for _ in range(3000)]
    rows = spark.createDataFrame([(n,) for n in dict.fromkeys(names)], "n string").select("n", N.natural_key(F.col("n")).alias("k")).orderBy("k").collect()
    assert [parts_of(r.n) for r in rows] == sorted(parts_of(r.n) for r in rows)
    same = {}
    for r in rows:
        same.setdefault(r.k, []).append(parts_of(r.n))
    assert all(p == ps[0] for ps in same.values() for p in ps) and len(same) == len({str(parts_of(n)) for n in names})


def test_positions_with_one_hot_group(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 4500, "hot").otherwise("cold").alias("g"), F.col("id"))
    for bucket in (None, F.floor(F.col("id") / 100)):
        got = planning.positions(rows, ["g"], ["id"], bucket, "k", "n").collect()
        assert all((r.k, r.n) == ((r.id, 4500) if r.g == "hot" else (r.id - 4500, 500)) for r in got) and len(got) == 5000


def test_looked_up_must_exist(spark):
    index = spark.createDataFrame([("a", 1)], "name string, idx int")
    assert planning.looked_up(spark.createDataFrame([("a",)], "name string"), index, "name", "idx").first().idx == 1
    with pytest.raises(Exception, match="not in the index"):
        planning.looked_up(spark.createDataFrame([("b",)], "name string"), index, "name", "idx").collect()


def test_one_session_with_many_plans(spark):
    """Aligned ranges of many plans in one hot session, against searchsorted."""
    rng = np.random.default_rng(2)
    ref, src = np.sort(rng.integers(0, 5000, 800)), np.sort(rng.integers(500, 4500, 700))
    plans = [(0, i, int(a), int(a + b)) for i, (a, b) in enumerate(zip(rng.integers(-5, 800, 300), rng.integers(0, 60, 300), strict=True))]
    table = lambda t: spark.createDataFrame([(0, i, int(x)) for i, x in enumerate(t)], "e long, idx long, ts long")
    got = align.align_ranges(spark.createDataFrame(plans, "e long, p long, start long, end long"), table(ref), table(src), ["e"], ["p"])
    for r in got.collect():
        a, b = (ref[min(max(k, 0), len(ref) - 1)] for k in (r.start, r.end))
        clamp = lambda k: min(max(int(k), 0), len(src) - 1)
        assert (r.src_start, r.src_end) == (clamp(np.searchsorted(src, a, "left")), clamp(np.searchsorted(src, b, "right") - 1))
    rows = align.planned_rows(spark.createDataFrame(plans, "e long, p long, start long, end long"), table(ref).withColumnRenamed("idx", "t"), ["e"])
    want = sum(max(0, min(e, 800) - max(s, 0)) for _, _, s, e in plans)
    assert rows.count() == want and got.count() == 300


def test_manifest(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.jpg").write_bytes(b"a")
    m = spark.createDataFrame([("a.jpg", "x/b.jpg", "link"), ("a.jpg", "y/c.jpg", "copy")], "src string, dst string, op string")
    assert writers.execute_manifest(m, str(tmp_path / "src"), str(tmp_path / "dst"), dry_run=True) == 2 and not os.path.exists(tmp_path / "dst")
    for _ in range(2):
        assert writers.execute_manifest(m, str(tmp_path / "src"), str(tmp_path / "dst")) == 2
    assert (tmp_path / "dst/x/b.jpg").read_bytes() == (tmp_path / "dst/y/c.jpg").read_bytes() == b"a"


def test_metadata(spark):
    info = json.dumps({"fps": 25, "features": {"b": {"dtype": "video", "shape": [4, 5, 3]}, "a": {"dtype": "video", "shape": [1]}, "s": {"dtype": "float32", "shape": [16]}}})
    r = metadata.video_features(spark.createDataFrame([(info,), ("{}",)], "value string")).collect()
    assert (r[0].fps, r[0].chunk_size, r[0].video_keys) == (25.0, 1000, ["a", "b"]) and r[1].fps == 30.0


def test_filter_episodes_end_to_end(spark):
    n = 30
    left = spark.createDataFrame([("e", f"frame{i}_left.jpg", i * 33_000_000) for i in range(n)] + [("short", f"frame{i}_left.jpg", i) for i in range(3)], "episode_id string, frame_name string, ts_ns long")
    cams = {c: spark.createDataFrame([("e", f"frame{i}_{c}.jpg", i * 33_000_000 + 1_000_000 * (k + 1)) for i in range(n) if i != 7 or c != "psm1"] + [("short", f"frame{i}_{c}.jpg", i) for i in range(3)], left.schema) for k, c in enumerate(("right", "psm1", "psm2"))}
    kin = spark.createDataFrame([("e", i, i * 1_000_000, float(i)) for i in range(1000)] + [("short", 0, 0, 0.0)], "episode_id string, kin_idx long, ts_ns long, x double")
    out = pipelines.filter_episodes(left, cams, kin, tolerance_ms=5, min_images=10)
    frames = out.frames.orderBy("frame_idx").collect()
    assert [r.frame_name for r in frames] == [f"frame{i}_left.jpg" for i in range(n) if i != 7]
    assert frames[3].psm1_name == "frame3_psm1.jpg" and frames[3].kinematics_idx == 99
    assert out.kinematics.count() == 29
    assert {r.episode_id: r.reason for r in out.report.collect()} == {"e": None, "short": "fewer than 10 frames: 3"}


def test_live_pairs(spark):
    left = spark.createDataFrame([("e", 1, 100.0)], "episode_id string, frame_id long, t double").select("episode_id", "frame_id", F.timestamp_millis(F.col("t").cast("long")).alias("frame_time"))
    kin = spark.createDataFrame([("e", 0, 90), ("e", 1, 110), ("e", 2, 900)], "episode_id string, kin_idx long, t long").select("episode_id", "kin_idx", F.timestamp_millis("t").alias("kin_time"))
    pairs = live.candidate_pairs(left, kin, 50)
    assert pairs.count() == 2 and live.nearest_of_pairs(pairs).first().kin_idx == 1


def recordings(spark, seed=7):
    """One episode with 90 % of all rows, a short one and one without a name; times repeat, some are null."""
    rng = np.random.default_rng(seed)
    rows = [("long" if i % 10 else ("short" if i % 20 else None), i, None if i % 97 == 0 else int(rng.integers(0, 2000)), *map(float, rng.integers(-2, 3, 4))) for i in range(3000)]
    return spark.createDataFrame(rows, "e string, i long, t long, a double, b double, c double, d double").repartition(6)


def listed_rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("span", [1, 50, 700, 10_000])
def test_long_recordings_in_parts_are_equal(spark, span):
    rows = recordings(spark)
    probe, one, two = (rows.where(f"i % 3 = {k}").select("e", "i", "t") for k in range(3))
    for tie in ("later", "earlier"):
        whole, cut = (asof.nearest_streams(probe, {"one": one, "two": two.where("t > 900")}, ["e"], "t", "i", tie, s) for s in (None, span))
        assert listed_rows(whole) == listed_rows(cut)
    numbered = rows.withColumnRenamed("t", "at")
    whole, cut = (motion.deltas(numbered, ["e"], ["at", "i"], ["a"], [["b", "c", "d"]], s) for s in (None, span))
    assert listed_rows(whole) == listed_rows(cut)
    signs = numbered.select("e", "i", "at", F.array("a", "b", "c", "d").alias("q"))
    whole, cut = (motion.quaternion_signs(signs, ["e"], ["at", "i"], "q", s) for s in (None, span))
    assert listed_rows(whole) == listed_rows(cut)
    known = rows.where("t IS NOT NULL AND e IS NOT NULL").select("e", "i", "t")
    ref = align.indexed(known.where("i % 2 = 0"), ["e"], ["t", "i"])
    plan = ref.select("e", F.col("idx").alias("p"), (F.col("idx") - 3).alias("start"), (F.col("idx") + 11).alias("end"))
    whole, cut = (align.align_ranges(plan, ref, known.where("i % 5 = 1"), ["e"], ["p"], "t", span=s) for s in (None, span))
    assert listed_rows(whole) == listed_rows(cut)


def test_parts_are_even(spark):
    """An episode with 90 % of the rows: no part holds more than twice the median."""
    rows = spark.range(20_000).select(F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(99).alias("e"), F.col("id").alias("i"), (F.col("id") * 1000).alias("t"), F.rand(1).alias("x"))
    span = parts.span_for(rows, ["e"], "t", 1000)
    assert 900 <= span / 1000 <= 1300 and parts.span_for(rows, ["e"], "t", 100_000) is None
    sizes = sorted(r["count"] for r in rows.where("e = 99").groupBy(parts.part_of(F.col("t"), span).alias("p")).count().collect())
    assert len(sizes) > 15 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    plan = motion.deltas(rows, ["e"], ["t", "i"], ["x"], span=span)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(e#" in plan and "_part#" in plan


def test_sweep_of_many_thresholds(spark):
    rng = np.random.default_rng(1)
    moved = motion.deltas(spark.createDataFrame([(e, i, None if i == 7 else float("nan") if i == 9 else float(x)) for e in range(12) for i, x in enumerate(np.cumsum(rng.integers(0, 4, 5 + 9 * e) * rng.random(5 + 9 * e)))], "e long, i long, x double"), ["e"], ["i"], ["x"])
    thresholds = [float(x) for x in rng.permutation(np.concatenate([np.linspace(0, 3, 400), [0.5, 0.5, 99.0, -1.0]]))]
    got = {r.i: r for r in motion.threshold_sweep(moved, ["e"], thresholds, 6).collect()}
    data = {}
    for r in moved.collect():
        data.setdefault(r.e, []).append((r.t, r.delta))
    assert sorted(got) == list(range(len(thresholds)))
    for i, x in enumerate(thresholds):
        lengths = []
        for rows in data.values():
            n, hits = len(rows), [t for t, d in rows if d is not None and not math.isnan(d) and d > x]
            lengths.append((n, min(max(hits) + 1, n - 1) - min(hits) + 1 if hits else n))
        kept = [k for _, k in lengths if k >= 6]
        want = (x, sum(n - k if k >= 6 else n for n, k in lengths), len(lengths) - len(kept), np.mean(kept) if kept else 0, np.median(kept) if kept else 0)
        assert tuple(got[i])[1:] == pytest.approx(want)


def test_files_of_other_layouts(spark, tmp_path):
    texts = {"a": "time,p,psm1_jaw\n10,1,0.5\n20,2,0.25\n", "b": "p,time\n3,30\n4,40\n", "c": 'p,"time",extra,psm1_jaw\n5.5,50,"x, ""y""",\n', "d": "p,q\n7,8\n", "e": "", "f": "time,p\n"}
    for k, text in texts.items():
        (tmp_path / "in put" / k).mkdir(parents=True)
        (tmp_path / "in put" / k / "ee_csv.csv").write_text(text)
    paths = [str(tmp_path / "in put" / k / "ee_csv.csv") for k in texts]
    got = readers.kinematics(spark, paths, str(tmp_path / "in put"))
    rows = {(r.episode_id, r.kin_idx): (r.ts_ns, r.time, r.p, r.psm1_jaw, r.extra) for r in got.collect()}
    assert rows == {("a", 0): (10, 10, 1.0, 0.5, None), ("a", 1): (20, 20, 2.0, 0.25, None), ("b", 0): (30, 30, 3.0, None, None), ("b", 1): (40, 40, 4.0, None, None), ("c", 0): (50, 50, 5.5, None, 'x, "y"'), ("d", 0): (0, None, 7.0, None, None)}
    assert dict(got.dtypes)["p"] == "double" and got.columns[-3:] == ["episode_id", "kin_idx", "ts_ns"]
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "ee_csv.csv").write_text("p,time\nword,1\n")
    with pytest.raises(ValueError, match="column p"):
        readers.kinematics(spark, [*paths, str(tmp_path / "g" / "ee_csv.csv")])
    samples = readers.motion_samples(spark, paths, str(tmp_path / "in put"))
    assert {(r.episode_id, r.ts_ns): r.psm1_jaw for r in samples.collect()} == {("a", 10): 0.5, ("a", 20): 0.25, ("b", 30): None, ("b", 40): None, ("c", 50): None, ("d", 0): None}
    with pytest.raises(ValueError, match="header"):
        readers.kinematics(spark, paths[4:5])


def test_raw_rows_keep_every_cell(spark, tmp_path):
    text = 'a,b\n1,2,3,4\n\n5\n"x,1","say ""hi""",\n,\n"open,6\n'
    (tmp_path / "r.csv").write_text(text)
    got = [r.cells for r in readers.raw_rows(spark, str(tmp_path / "r.csv")).orderBy("line").collect()]
    assert got == [["a", "b"], ["1", "2", "3", "4"], [], ["5"], ["x,1", 'say "hi"', ""], ["", ""], ['"open', "6"]]


def test_lines_are_numbered_over_blocks(spark, tmp_path):
    for name, n in (("one.jsonl", 3000), ("two.jsonl", 700)):
        (tmp_path / name).write_text("".join("{broken\n" if i == 2345 else "\n" if i == 10 else json.dumps({"episode_index": i, "tasks": ["cut"] * (i % 5)}) + "\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = readers.numbered_lines(spark, str(tmp_path))
        assert lines.select(F.spark_partition_id()).distinct().count() > 8
        rows = lines.collect()
        want = {(n.name, i + 1, line) for n in tmp_path.iterdir() for i, line in enumerate(n.read_text().split("\n")[:-1])}
        assert {(r.path.rsplit("/", 1)[1], r.line, r.value) for r in rows} == want and len(rows) == 3700
        found = metadata.line_findings(lines).collect()
        assert [(r.path.rsplit("/", 1)[1], r.line, r.level) for r in found] == [("one.jsonl", 2346, "ERROR")] and "line 2346" in found[0].message
        (tmp_path / "k").mkdir()
        (tmp_path / "k" / "ee_csv.csv").write_text("time,x\n" + "".join(f"{i},{i * 2}\n" for i in range(4000)))
        kin = readers.kinematics(spark, str(tmp_path / "k" / "ee_csv.csv"))
        assert kin.where("kin_idx <> ts_ns OR x <> 2 * kin_idx").count() == 0 and kin.count() == 4000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_sampled_files_only_are_opened(spark, tmp_path):
    rows = spark.createDataFrame([(e, i) for e in range(25) for i in range(3)], "episode_index long, frame_index long")
    writers.write_dataset(rows, str(tmp_path))
    got = readers.sampled_dataset(spark, str(tmp_path))
    assert sorted(os.path.basename(f) for f in got.inputFiles()) == [f"episode_{e:06d}.parquet" for e in range(0, 25, 2)]
    assert len(readers.episodes_of(spark, str(tmp_path), [3, 24]).inputFiles()) == 2
    (tmp_path / "none" / "data").mkdir(parents=True)
    with pytest.raises(ValueError):
        readers.sampled_dataset(spark, str(tmp_path / "none"))
