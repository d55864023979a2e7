"""Assembly of output rows from aligned streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.functions import quaternion as Q
from tracewright.operators.align import indexed
from tracewright.schema import ACTION_COLUMNS, FPS, STATE_COLUMNS, plain


def vector(df: DataFrame, name: str, columns: tuple[str, ...]) -> Column | None:
    """A float vector: the list column ``name`` if there is one, else its flat ``columns`` that are there, in their order
    (by their own or their plain names); null where neither is there."""
    if name in df.columns:
        return F.col(f"`{name}`").cast("array<float>")
    named = [c if c in df.columns else plain(c) for c in columns]
    found = [F.col(f"`{c}`").cast("float") for c in named if c in df.columns]
    return F.array(*found) if found else None


def with_state_and_action(df: DataFrame, state: str = "state", action: str = "action") -> DataFrame:
    """``df`` plus state and action vectors of the arms' named columns; a missing side raises ValueError."""
    vectors = {n: vector(df, n, c) for n, c in ((state, STATE_COLUMNS), (action, ACTION_COLUMNS))}
    lost = [n for n, v in vectors.items() if v is None]
    if lost:
        raise ValueError(f"no columns of {', '.join(lost)}")
    return df.withColumns(vectors)


def bounds(df: DataFrame, by: list[str], vector: str) -> DataFrame:
    """(by, x, y, z, span): mean position of the first three elements, and the longest side of the box around them."""
    v = df.select(*by, *[F.get(vector, F.lit(i)).alias(c) for i, c in enumerate("xyz")])
    span = F.greatest(*[F.max(c) - F.min(c) for c in "xyz"]).cast("double")
    return v.groupBy(*by).agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in "xyz"], span.alias("span"))


def zipped(parts: list[DataFrame], by: list[str], index: str = "frame_index") -> DataFrame:
    """Streams combined by equal position within a group; rows beyond the shortest go."""
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, [*by, index])
    return out


def with_relative_actions(df: DataFrame, by: list[str], order: list[str], action: str, name: str = "action_hybrid_relative") -> DataFrame:
    """``df`` plus the relative action to the next row within ``by``; the last row of a group is its own next.

    ``by`` is the session where slices are cut later, so that a slice's last row looks beyond it, or the episode.
    """
    later = F.coalesce(F.lead(action).over(Window.partitionBy(*by).orderBy(*order)), F.col(action))
    return df.withColumn("_later", later).withColumn(name, Q.hybrid_relative(F.col(action), F.col("_later"))).drop("_later")


def assembled(df: DataFrame, episode: str, order: list[str], state: str, action: str, relative: str, fps: int = FPS, carry: tuple[str, ...] = ()) -> DataFrame:
    """Output rows: episode_index, frame_index, timestamp (frame_index / fps), the three vectors as floats, and ``carry``."""
    rows = indexed(df, [episode], order, "frame_index")
    vector = lambda c, n: F.col(c).cast("array<float>").alias(n)
    return rows.select(F.col(episode).alias("episode_index"), "frame_index", (F.col("frame_index") * F.lit(1.0 / fps)).alias("timestamp"), vector(state, "observation_state"), vector(action, "action"), vector(relative, "action_hybrid_relative"), *carry)


def remaining_time(df: DataFrame, by: list[str], order: list[str], duration: str, last: int = 5) -> DataFrame:
    """``df`` plus eta: the mean of the last few durations times the rows that are still to come."""
    w = Window.partitionBy(*by).orderBy(*order)
    mean = F.avg(duration).over(w.rowsBetween(1 - last, Window.currentRow))
    left = F.count("*").over(Window.partitionBy(*by)) - F.row_number().over(w)
    return df.withColumn("eta", mean * left)
