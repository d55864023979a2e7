"""Tree walks, the dataset index, reconciliation and all rules together."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tracewright.operators import quality, validators
from tracewright.sources import index, listing, writers


def test_tree_is_walked_by_levels(spark, tmp_path):
    made = {"b.txt": False, "t/1/x.jpg": False, "t/1/deep/er/y.PNG": False, "t/2": True, "empty": True}
    for path, folder in made.items():
        (tmp_path / path if folder else (tmp_path / path).parent).mkdir(parents=True, exist_ok=True)
        if not folder:
            (tmp_path / path).write_text("")
    os.symlink(tmp_path / "t", tmp_path / "link")
    got = {(r.path, r.parent, r.name, r.is_dir, r.depth) for r in listing.listed(spark, str(tmp_path)).collect()}
    want = set()
    for folder, folders, names in os.walk(tmp_path):
        at = os.path.relpath(folder, tmp_path)
        at = "" if at == "." else at
        for n, d in [*((f, True) for f in folders), *((f, False) for f in names)]:
            want.add((f"{at}/{n}" if at else n, at, n, d, at.count("/") + 2 if at else 1))
    assert got == want and len(got) == 10
    assert listing.listed(spark, f"file://{tmp_path}").count() == 10
    assert listing.listed(spark, str(tmp_path / "empty")).count() == 0
    with pytest.raises(FileNotFoundError):
        listing.listed(spark, str(tmp_path / "b.txt"))


def entries(spark, paths):
    rows = []
    for p in paths:
        folder = p.endswith("/")
        p = p.rstrip("/")
        rows.append((p, p.rpartition("/")[0], p.rpartition("/")[2], folder, p.count("/") + 1))
    return spark.createDataFrame(rows, listing.SCHEMA)


def test_walks_and_folders(spark):
    e = entries(spark, ["tissue_10/", "tissue_2/", "tissue_x/", "tissue_2/s_1/", "tissue_10/s_3/", "tissue_2/s_1/ep_12/", "tissue_2/s_1/ep_3/", "tissue_10/s_3/ep_1/", "tissue_x/s/", "tissue_x/s/ep_1/", "notes.txt"])
    assert [r.path for r in listing.numbered_walk(e).collect()] == ["tissue_2/s_1/ep_3", "tissue_2/s_1/ep_12", "tissue_10/s_3/ep_1", "tissue_x/s/ep_1"]
    assert [r.name for r in listing.flat_folders(e).collect()] == ["tissue_10", "tissue_2", "tissue_x"]
    runs = entries(spark, [f"{t}/{r}/{m}/" for t, r, ms in (("cautery_tissue1", "r1", "lr"), ("cautery_tissue1", "r2", "l"), ("other", "r1", "lr"), ("cautery_tissue0", "r9", "lrx")) for m in ms] + ["cautery_tissue1/r1/l/b.PNG", "cautery_tissue1/r1/l/a.jpg", "cautery_tissue1/r1/l/c.txt"])
    assert [tuple(r) for r in listing.tissue_runs(runs, ["l", "r"]).collect()] == [("cautery_tissue0", "r9"), ("cautery_tissue1", "r1")]
    assert [tuple(r) for r in listing.run_frames(runs, "l").collect()] == [("cautery_tissue1/r1", "cautery_tissue1/r1/l/a.jpg"), ("cautery_tissue1/r1", "cautery_tissue1/r1/l/b.PNG")]
    frames = entries(spark, ["e/left/frame9_any.jpg", "e/left/frame1_left_0_5.jpg", "e/left/none.jpg", "e/right/frame1_x.jpg"])
    assert [(r.frame_name, r.ts_ns) for r in listing.camera_frames(frames, "left").collect()] == [("frame1_left_0_5.jpg", 5), ("frame9_any.jpg", 9)]
    assert [r.frame_name for r in listing.camera_frames(frames, "left", old_names=True).collect()] == ["frame9_any.jpg"]


def test_structure_of_folders(spark):
    e = entries(spark, ["a/left/", "a/left/1.jpg", "a/right/", "a/right/x", "a/ee_csv.csv", "b/left/", "b/left/1.png", "b/right/", "c/ee_csv.csv"])
    got = {r.episode_id: (r.valid, r.message) for r in listing.checked_structure(e, ["left", "right"]).collect()}
    assert got == {"a": (True, ""), "b": (False, "no .jpg in left; right is empty or missing; ee_csv.csv is missing"), "c": (False, "no .jpg in left; right is empty or missing")}


def test_index_and_ranges(spark, tmp_path):
    rows = spark.range(3000).select((F.col("id") / 1000).cast("long").alias("episode_index"), (F.col("id") % 1000).alias("frame_index"), (F.col("id") % 1000 / 10.0).alias("timestamp"), F.rand(1).alias("x"))
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "2048")
    try:
        writers.write_dataset(rows, str(tmp_path))
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    found = index.dataset_index(spark, str(tmp_path))
    table = found.collect()
    assert {r.episode_index for r in table} == {0, 1, 2} and sum(r.rows for r in table) == 3000 and len(table) > 3
    assert all(r.first is not None and r.first <= r.last for r in table)
    wanted = spark.createDataFrame([(1, 10.0, 12.0), (1, 11.0, 13.5), (2, 99.0, 200.0), (7, 0.0, 1.0)], "episode_index long, start double, end double")
    got = {(r.episode_index, r.frame_index) for r in index.rows_between(found, str(tmp_path), wanted).collect()}
    assert got == {(1, i) for i in range(100, 136)} | {(2, i) for i in range(990, 1000)}
    # other row groups may be broken: they are not read
    for r in table:
        if r.episode_index == 0:
            path = tmp_path / r.file
            path.write_bytes(b"PAR1" + b"x" * (path.stat().st_size - 4))
    cached = spark.createDataFrame(table, index.INDEX)
    assert index.rows_between(cached.where("episode_index > 0").unionByName(cached.where("episode_index = 0")), str(tmp_path), wanted).count() == 46


def test_loaded_dataset(spark, tmp_path):
    writers.write_dataset(spark.createDataFrame([(e, i) for e in range(3) for i in range(2)], "episode_index long, frame_index long"), str(tmp_path))
    (tmp_path / "meta").mkdir()
    (tmp_path / "meta" / "info.json").write_text(json.dumps({"features": {"b": {"dtype": "video", "shape": [1]}, "a": {"dtype": "video", "shape": [1]}}}))
    (tmp_path / "meta" / "episodes.jsonl").write_text('{"episode_index": 0, "tasks": ["cut"], "length": 2}\n\n{"episode_index": 2, "tasks": "lift"}\n')
    d = index.loaded(spark, str(tmp_path))
    assert (d.fps, d.chunk_size, d.video_keys, d.episodes.count()) == (30.0, 1000, ["a", "b"], 2)
    assert {(r.episode_index, str(r.tasks)) for r in d.rows.collect()} == {(0, "['cut']"), (1, "None"), (2, "['lift']")}


def test_reconciliation_names_each_mismatch(spark):
    lines = spark.createDataFrame([(0, 2), (1, 5), (2, 2), (2, 2), (4, None)], "episode_index int, length int")
    rows = spark.createDataFrame([(e,) for e in (0, 0, 1, 1, 3, 2, 2)], "episode_index int")
    videos = spark.createDataFrame([(0, "left", 2), (0, "right", None), (1, "left", 5), (1, "left", 5), (2, "left", 3), (2, "right", 2), (2, "top", 2)], "episode_index int, camera string, frames int")
    got = {(r.episode_index, r.level, r.message) for r in quality.reconciled_episodes(lines, rows, videos, ["left", "right"]).collect()}
    assert got == {
        (1, "ERROR", "2 rows instead of 5"), (1, "WARNING", "2 videos of left"), (1, "WARNING", "no video of right"), (2, "ERROR", "2 metadata lines"), (2, "WARNING", "video of left has 3 frames instead of 2"),
        (2, "WARNING", "video top is not expected"), (3, "ERROR", "no metadata line"), (3, "WARNING", "no video of left"), (3, "WARNING", "no video of right"), (4, "ERROR", "no data file"), (4, "WARNING", "no video of left"), (4, "WARNING", "no video of right"),
    }


def test_every_rule_at_once(spark):
    e = entries(spark, ["meta/", "data/", "data/chunk-000/", "data/chunk-000/episode_000000.parquet", "meta/info.json"])
    info = spark.createDataFrame([(json.dumps({"fps": 30, "robot_type": "dvrk", "splits": {}, "features": {"action": {"dtype": "float32", "shape": [16]}}}),)], "value string")
    lines = spark.createDataFrame([('{"episode_index": 0, "tasks": ["cut"], "length": 12}',)], "value string")
    readme = spark.createDataFrame([("synchronised streams",)], "value string")
    v = [0.0] * 3 + [0.0, 0.0, 0.0, 1.0] + [0.0] + [0.0] * 3 + [0.0, 0.0, 0.0, 2.0] + [9.0]
    rows = spark.createDataFrame([(0, i, i / 30, v) for i in range(12)] + [(1, 0, 0.0, v), (1, 2, 0.0, v)], "episode_index int, frame_index int, timestamp double, action array<double>")
    videos = spark.createDataFrame([(0, "left", 12)], "episode_index int, camera string, frames int")
    expected = spark.createDataFrame([("action", "float64", 16), ("state", "float32", 16)], "name string, dtype string, dim int")
    found = validators.every_finding(e, info, lines, readme, rows, videos, expected, ["left"], ["action"])
    bad = {(r.category, r.level, r.message) for r in found.where("level IN ('ERROR', 'WARNING')").collect()}
    assert bad >= {
        ("structure", "ERROR", "videos is missing"), ("splits", "WARNING", "no splits"), ("info", "WARNING", "split test missing; split train missing; split val missing"), ("schema", "ERROR", "action: dtype float32 instead of float64"),
        ("schema", "ERROR", "state: missing"), ("variation", "WARNING", "action hardly varies at all"), ("values", "WARNING", "14 rows of action with an orientation of arm 2 that is not of length 1"), ("values", "WARNING", "14 rows of action with a jaw of arm 2 out of bounds"),
        ("times", "ERROR", "1 episodes whose time does not rise"), ("times", "ERROR", "1 episodes whose index does not count from 0"), ("times", "WARNING", "1 episodes of fewer than 10 rows"), ("episodes", "ERROR", "episode 1: no metadata line"), ("episodes", "WARNING", "episode 1: no video of left"),
    }
    assert {r.category for r in found.collect()} == {"structure", "metadata", "info", "splits", "features", "schema", "tasks", "synchronization", "columns", "variation", "values", "times", "episodes"}
