"""Files moved, copied and written by executors, on local disks and any file system that Arrow opens by its URI (HDFS, S3)."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 20


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), os.path.abspath(path)


def kind(path: str) -> str | None:
    """``file``, ``folder`` or None."""
    fs, at = opened(path)
    return {pafs.FileType.File: "file", pafs.FileType.Directory: "folder"}.get(fs.get_file_info(at).type)


def make_folder(path: str) -> None:
    fs, at = opened(path)
    fs.create_dir(at, recursive=True)


def remove_folder(path: str) -> None:
    fs, at = opened(path)
    if fs.get_file_info(at).type == pafs.FileType.Directory:
        fs.delete_dir(at)


def move(src: str, dst: str) -> None:
    make_folder(os.path.dirname(dst))
    fs, at = opened(src)
    fs.move(at, opened(dst)[1])


def write_text(path: str, text: str) -> None:
    """The whole file or none: written under another name, then moved."""
    make_folder(os.path.dirname(path))
    part = f"{path}.{uuid.uuid4().hex}.part"
    fs, at = opened(part)
    with fs.open_output_stream(at) as out:
        out.write(text.encode())
    fs.move(at, opened(path)[1])


def read_text(path: str) -> str | None:
    if kind(path) != "file":
        return None
    fs, at = opened(path)
    with fs.open_input_stream(at) as f:
        return f.read().decode()


def place(src: str, dst: str, link: bool) -> None:
    """``dst`` as a copy of ``src`` (or a hard link where both are local and it can be made); again is no harm."""
    (a, src_at), (b, dst_at) = opened(src), opened(dst)
    b.create_dir(os.path.dirname(dst_at), recursive=True)
    part = f"{dst_at}.{uuid.uuid4().hex}.part"
    local = isinstance(a, pafs.LocalFileSystem) and isinstance(b, pafs.LocalFileSystem)
    linked = False
    if link and local:
        try:
            os.link(src_at, part)
            linked = True
        except OSError:  # another disk, or no links there
            linked = False
    if not linked:
        with a.open_input_stream(src_at) as f, b.open_output_stream(part) as out:
            while data := f.read(CHUNK):
                out.write(data)
    b.move(part, dst_at)


def place_all(manifest: DataFrame, source: str, target: str) -> DataFrame:
    """(src, dst) of ``manifest`` (src, dst, op) after its files are placed below ``target``; runs when it is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("src", "dst", "op")), strict=True))
            for src, dst, op in rows:
                place(f"{source}/{src}", f"{target}/{dst}", op == "link")
            yield pa.RecordBatch.from_arrays([batch.column("src"), batch.column("dst")], ["src", "dst"])

    return manifest.select("src", "dst", "op").mapInArrow(run, "src string, dst string")


def write_lines(lines: DataFrame, target: str, by: str = "file", order: tuple[str, ...] = ("line",), text: str = "text") -> DataFrame:
    """(file, lines) of text files below ``target``, one for each value of ``by``, its lines in ``order``.

    One task writes one file as it reads its lines, under another name until the file is whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, part, n, closed = None, None, None, 0, []

        def finish() -> None:
            out.close()
            fs.move(part, at)
            closed.append((name, n))

        for batch in batches:
            for file, value in zip(batch.column(by).to_pylist(), batch.column(text).to_pylist(), strict=True):
                if file != name:
                    if out is not None:
                        finish()
                    name, n = file, 0
                    fs, at = opened(f"{target}/{file}")
                    part = f"{at}.{uuid.uuid4().hex}.part"
                    fs.create_dir(os.path.dirname(at), recursive=True)
                    out = fs.open_output_stream(part)
                out.write(value.encode() + b"\n")
                n += 1
        if out is not None:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array([c[0] for c in closed], pa.string()), pa.array([c[1] for c in closed], pa.int64())], ["file", "lines"])

    laid = lines.select(F.col(by).cast("string").alias(by), text, *[c for c in order if c not in (by, text)]).repartition(by).sortWithinPartitions(by, *order)
    return laid.select(by, text).mapInArrow(run, "file string, lines bigint")
