"""Names, thresholds and column sets of two-arm robot recordings."""

from __future__ import annotations

import re

# Streams and columns of a recording.
CAMERAS = ("left", "right", "psm1", "psm2")
POSITION, ORIENTATION = ("x", "y", "z"), ("x", "y", "z", "w")
ARMS = ("psm1", "psm2")
MOTION_COLUMNS = tuple(c for a in ARMS for c in (*(f"{a}_js[{i}]" for i in range(6)), f"{a}_jaw", *(f"{a}_pose.orientation.{k}" for k in ORIENTATION)))
STATE_COLUMNS = tuple(c for a in ARMS for c in (*(f"{a}_pose.position.{k}" for k in POSITION), *(f"{a}_pose.orientation.{k}" for k in ORIENTATION), f"{a}_jaw"))
ACTION_COLUMNS = tuple(c for a in ARMS for c in (*(f"{a}_sp.position.{k}" for k in POSITION), *(f"{a}_sp.orientation.{k}" for k in ORIENTATION), f"{a}_jaw_sp"))
#: Arm cameras are crossed in the output.
CAMERA_FEATURES = {"left": "observation.images.endoscope.left", "right": "observation.images.endoscope.right", "psm1": "observation.images.wrist.right", "psm2": "observation.images.wrist.left"}
ACTION_SUBDIRS = {"grasp": "1_grasp", "dissect": "2_dissect"}
TOLERANCE_MS, MIN_IMAGES, TRIM_THRESHOLD, MIN_LENGTH, FPS = 30.0, 10, 1e-4, 10, 30
SYNTHETIC_STEP_NS = 33_333_333
NORM_TOLERANCE, JAW_LOW, JAW_HIGH = 0.05, -0.7, 1.5


def plain(name: str) -> str:
    """A column name without dots and brackets, which Spark would read as field and element access."""
    return re.sub(r"_+$", "", re.sub(r"[.\[\]]+", "_", name))


def timestamp_column(columns: list[str]) -> str | None:
    """The first column whose name holds ``time`` or ``stamp`` in any case."""
    return next((c for c in columns if re.search("time|stamp", c.lower())), None)
