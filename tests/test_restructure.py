"""Restructured datasets, whole and after a stop."""

import os

import pytest
from pyspark.sql import functions as F

from tracewright.sources import files, listing, readers, restructure, writers

CAMERAS = {"left": ("left_img_dir", "_left"), "right": ("right_img_dir", "_right")}


@pytest.fixture
def source(tmp_path):
    root = tmp_path / "source"
    for k, e in enumerate(("Tissue#1/jo/s1", "Tissue#1/jo/s2", "Tissue#2/s3")):
        for folder, suffix in CAMERAS.values():
            (root / e / folder).mkdir(parents=True)
            for i in range(12):
                (root / e / folder / f"frame{(5 if i < 6 else 10) * 100 + i}{suffix}.jpg").write_text(f"{e} {suffix} {i}")
        rows = [f'{1000 + i},{i + k / 10},"a, ""{i}"""' for i in range(12)]
        (root / e / "ee_csv.csv").write_text("time [ns],x.y,note\n" + "\n".join(rows) + "\n")
    return root


def planned(spark, source):
    plan = spark.createDataFrame([("Tissue#1/jo/s1", 1, "grasp", 2, 5), ("Tissue#1/jo/s1", 1, "dissect", 4, 11), ("Tissue#1/jo/s2", 1, "grasp", -1, 1), ("Tissue#2/s3", 2, "grasp", 10, 30)], "episode_id string, tissue long, action string, start long, end long")
    plan = restructure.numbered_plan(plan, "tissue", "action", ["episode_id", "start"])
    entries = listing.listed(spark, str(source))
    frames = listing.frames(entries, {c: (folder, suffix + ".jpg") for c, (folder, suffix) in CAMERAS.items()})
    raw = readers.raw_rows(spark, [str(source / e / "ee_csv.csv") for e in ("Tissue#1/jo/s1", "Tissue#1/jo/s2", "Tissue#2/s3")])
    raw = raw.withColumn("episode_id", readers.relative_folder(F.col("path"), str(source)))
    return plan, frames, raw


def tree(root):
    return {os.path.relpath(os.path.join(d, f), root): open(os.path.join(d, f)).read() for d, _, fs in os.walk(root) for f in fs}


def expected():
    out = {}
    for dst, e, k, first, last in (("tissue_1/2_grasp/episode_001", "Tissue#1/jo/s1", 0, 2, 5), ("tissue_1/1_dissect/episode_001", "Tissue#1/jo/s1", 0, 4, 11), ("tissue_1/2_grasp/episode_002", "Tissue#1/jo/s2", 1, 0, 1), ("tissue_2/2_grasp/episode_001", "Tissue#2/s3", 2, 10, 11)):
        for folder, suffix in CAMERAS.values():
            for i in range(first, last + 1):
                out[f"{dst}/{folder}/frame{i - first:06d}{suffix}.jpg"] = f"{e} {suffix} {i}"
        rows = [f'{(i - first) / 30:.4f},{i + k / 10},"a, ""{i}"""' for i in range(first, last + 1)]
        out[f"{dst}/ee_csv.csv"] = "time [ns],x.y,note\n" + "\n".join(rows) + "\n"
    return out


def test_whole_run(spark, source, tmp_path):
    plan, frames, raw = planned(spark, source)
    out = str(tmp_path / "out" / "dataset")
    assert restructure.restructured(plan, frames, raw, CAMERAS, str(source), out, "link") == 4
    assert tree(out) == expected()
    with pytest.raises(FileExistsError):
        restructure.restructured(plan, frames, raw, CAMERAS, str(source), out)
    assert tree(out) == expected() and restructure.state(out) is None


def test_stopped_runs(spark, source, tmp_path):
    plan, frames, raw = planned(spark, source)
    out = str(tmp_path / "out")
    lines = restructure.csv_lines(plan, raw)
    # stopped while staging: undone by the next run
    files.place_all(restructure.frame_files(plan, frames, CAMERAS), str(source), f"{out}/_transaction/files").count()
    assert restructure.state(out) == "open"
    assert restructure.recover(spark, out) == "undone" and tree(out) == {}
    # stopped while moving: finished by the next run
    staged = restructure.stage(restructure.frame_files(plan, frames, CAMERAS), lines, str(source), out)
    assert {(r.dst, r.frames, r.rows) for r in staged.collect()} == {("tissue_1/2_grasp/episode_001", 8, 4), ("tissue_1/1_dissect/episode_001", 16, 8), ("tissue_1/2_grasp/episode_002", 4, 2), ("tissue_2/2_grasp/episode_001", 4, 2)}
    files.move(f"{out}/_transaction/files/tissue_1/2_grasp/episode_002", f"{out}/tissue_1/2_grasp/episode_002")
    assert restructure.state(out) == "staged" and restructure.recover(spark, out) == "finished"
    assert tree(out) == expected() and restructure.recover(spark, out) is None


def test_trim_in_place(spark, source, tmp_path):
    plan, frames, raw = planned(spark, source)
    out = str(tmp_path / "out")
    restructure.restructured(plan, frames, raw, CAMERAS, str(source), out)
    shorter = plan.where("action = 'dissect'").withColumn("start", F.lit(9))
    assert restructure.restructured(shorter, frames, raw, CAMERAS, str(source), out, replace=True) == 1
    now = tree(out)
    assert sorted(f for f in now if "1_dissect" in f and "left" in f) == [f"tissue_1/1_dissect/episode_001/left_img_dir/frame{i:06d}_left.jpg" for i in range(3)]
    assert now["tissue_1/1_dissect/episode_001/left_img_dir/frame000000_left.jpg"] == "Tissue#1/jo/s1 _left 9"
    assert {k: v for k, v in now.items() if "1_dissect" not in k} == {k: v for k, v in expected().items() if "1_dissect" not in k}


def test_kinematics_of_each_episode(spark, tmp_path):
    rows = spark.createDataFrame([("t/e1", 1, 2.5, "b"), ("t/e1", 0, 1.5, 'a,"q"'), ("t/e2", 0, None, "c")], "episode_id string, frame_idx long, x_y double, note string")
    done = writers.write_kinematics(rows, str(tmp_path), names={"x_y": "x.y"})
    assert {tuple(r) for r in done.collect()} == {("t/e1/ee_csv.csv", 3), ("t/e2/ee_csv.csv", 2)}
    assert sorted(tree(tmp_path)) == ["t/e1/ee_csv.csv", "t/e2/ee_csv.csv"]
    back = readers.kinematics(spark, [str(tmp_path / "t" / e / "ee_csv.csv") for e in ("e1", "e2")], str(tmp_path))
    assert {(r.episode_id, r.kin_idx, r.x_y) for r in back.collect()} == {("t/e1", 0, 1.5), ("t/e1", 1, 2.5), ("t/e2", 0, None)}
    assert tree(tmp_path)["t/e1/ee_csv.csv"].startswith("x.y,note\n1.5,")
