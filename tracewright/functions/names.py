"""Parsing and making of frame names, session names, paths and task texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of names.
NEW_FRAME = r"frame\d+_(?:left|right|psm1|psm2)_(\d+)_(\d+)\.jpg"
OLD_FRAME = r"frame(\d+)_\w+\.jpg"
ANY_FRAME = r"frame(\d+)"
OLD_SESSION = r"cautery_tissue(\d+)_(.+)_left_video$"
NEW_SESSION = r"(\w+)_tissue(\d+)_(.+)$"


def _long(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(text, pattern, group).try_cast("bigint")


def frame_timestamp(name: Column, lenient: bool = False) -> Column:
    """Nanoseconds of a frame name: seconds and nanoseconds of the new form, else the number of the old one, else null.

    ``lenient`` takes any number after ``frame``, whatever follows.
    """
    new = _long(name, NEW_FRAME, 1) * F.lit(1_000_000_000) + _long(name, NEW_FRAME, 2)
    # the new form's pattern runs only where its last two numbers may stand
    return F.coalesce(F.when(name.rlike(r"_\d+_\d+\.jpg"), new), _long(name, ANY_FRAME if lenient else OLD_FRAME))


def frame_number(name: Column) -> Column:
    """Number after ``frame``: in the new form the sequence number; null sorts last, by name."""
    return _long(name, ANY_FRAME)


def natural_key(text: Column) -> Column:
    """Text that sorts as the list of ``text``'s parts would: runs of other characters, without case, and runs of digits by
    value in turn, a run of other characters (perhaps empty) first.

    A text part ends with a mark below all characters, so that a part sorts before those it begins. A number stands as
    the count of its digits without leading zeros (ten digits, so numbers may be of any length) and these digits.
    """

    def key(part: Column) -> Column:
        digits = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return F.when(part.rlike("^[0-9]"), F.concat(F.lpad(F.length(digits).cast("string"), 10, "0"), digits)).otherwise(F.concat(part, F.lit("\0")))

    parts = F.array_join(F.transform(F.regexp_extract_all(F.lower(text), F.lit("([0-9]+|[^0-9]+)"), F.lit(0)), key), "")
    return F.when(text.rlike("^[0-9]"), F.concat(F.lit("\0"), parts)).otherwise(parts)


def trailing_number(name: Column) -> Column:
    """Integer at the end of a name, null without one."""
    return _long(name, r"(\d+)$")


def short_label(path: Column) -> Column:
    """Parent and name of a path."""
    return F.regexp_extract(path, r"([^/]*/)?[^/]*$", 0)


def frame_name(index: Column, suffix: Column | str = "", extension: str = ".jpg") -> Column:
    suffix = F.lit(suffix) if isinstance(suffix, str) else suffix
    return F.concat(F.format_string("frame%06d", index), suffix, F.lit(extension.lower()))


def renamed_secondary(left: Column, camera: Column, ts_ns: Column) -> Column:
    """Name of a secondary frame after its left frame: the sequence number of the new form, else the old base name."""
    new = F.concat(F.regexp_extract(left, r"^(frame\d+)_", 1), F.lit("_"), camera, F.lit("_"), F.floor(ts_ns / 1_000_000_000).cast("string"), F.lit("_"), (ts_ns % 1_000_000_000).cast("string"), F.lit(".jpg"))
    old = F.concat(F.regexp_replace(left, r"_left\.jpg$", ""), F.lit("_"), camera, F.lit(".jpg"))
    return F.when(left.rlike("^" + NEW_FRAME), new).otherwise(old)


def session_parts(name: Column) -> Column:
    """Struct (tissue, session, collector): the old form first, whose collector is null, then the new; else null."""
    old, new = name.rlike("^" + OLD_SESSION), name.rlike("^" + NEW_SESSION)
    part = lambda t, s, c: F.struct(t.alias("tissue"), s.alias("session"), c.alias("collector"))
    return F.when(old, part(_long(name, OLD_SESSION, 1), F.regexp_extract(name, OLD_SESSION, 2), F.lit(None).cast("string"))).when(
        new, part(_long(name, "^" + NEW_SESSION, 2), F.regexp_extract(name, "^" + NEW_SESSION, 3), F.regexp_extract(name, "^" + NEW_SESSION, 1))
    )


def direct_parts(path: Column) -> Column:
    """Struct (tissue_num, collector, phase, action) of a path: the first component that starts as ``Tissue#N`` in any
    case, and the three, two, one or no components after it; with none the action is the last component. Null without one."""
    parts = F.split(path, "/")
    mark = r"(?i)^tissue#?(\d+)"
    at = F.array_position(F.transform(parts, lambda p: p.rlike(mark)), True).cast("int")
    rest = F.slice(parts, at + 1, F.size(parts))
    n = F.size(rest)
    get = lambda i: F.get(rest, F.lit(i))
    empty = F.lit("")
    return F.when(
        at > 0,
        F.struct(
            F.regexp_extract(F.get(parts, at - 1), mark, 1).try_cast("bigint").alias("tissue_num"),
            F.when(n >= 3, get(0)).otherwise(empty).alias("collector"),
            F.when(n >= 3, get(1)).when(n == 2, get(0)).otherwise(empty).alias("phase"),
            F.when(n >= 3, get(2)).when(n == 2, get(1)).when(n == 1, get(0)).otherwise(F.element_at(parts, -1)).alias("action"),
        ),
    )


def tissue_number(label: Column) -> Column:
    return F.coalesce(_long(label, r"(?i)tissue_?(\d+)"), F.lit(0).cast("bigint"))


def unnumbered(action: Column) -> Column:
    """An action directory without its leading number, lower-cased and trimmed; a number alone stays."""
    return F.lower(F.trim(F.regexp_replace(action, r"^\d+_(?=.)", "")))


def planned_task(text: Column) -> Column:
    """Without the first ``_`` token, spaces for the others."""
    parts = F.split(text, "_")
    return F.array_join(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), " ")


def direct_task(text: Column) -> Column:
    """Spaces for ``_``; a first token goes only if it is a number and others follow."""
    return F.regexp_replace(F.replace(text, F.lit("_"), F.lit(" ")), "^[0-9]+ ", "")


def old_task(text: Column) -> Column:
    """As planned_task, and a text that ends with ``recovery`` loses its last nine characters."""
    task = planned_task(text)
    return F.when(task.endswith("recovery"), F.substring(task, F.lit(1), F.greatest(F.length(task) - 9, F.lit(0)))).otherwise(task)


def flat_task(text: Column) -> Column:
    return F.replace(text, F.lit("_"), F.lit(" "))


def is_recovery(task: Column) -> Column:
    return F.lower(task).contains("recovery")


def without_recovery(task: Column) -> Column:
    stripped = F.trim(F.replace(F.replace(task, F.lit(" recovery"), F.lit("")), F.lit("recovery"), F.lit("")))
    return F.when(is_recovery(task), stripped).otherwise(task)


def duration_text(seconds: Column) -> Column:
    """``5s``, ``2m 05s`` or ``1h 02m 05s`` of whole seconds."""
    s = seconds.cast("bigint")
    minutes, hours = F.floor(s / 60), F.floor(s / 3600)
    return F.when(s < 60, F.concat(s.cast("string"), F.lit("s"))).when(minutes < 60, F.format_string("%dm %02ds", minutes, s % 60)).otherwise(F.format_string("%dh %02dm %02ds", hours, minutes % 60, s % 60))


def normalized_time(index: Column, fps: int = 30) -> Column:
    return F.format_string("%.4f", index * F.lit(1.0 / fps))


def chunk_path(index: Column, chunk: int = 1000) -> Column:
    return F.format_string("data/chunk-%03d/episode_%06d.parquet", F.floor(index / chunk), index)
