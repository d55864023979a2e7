"""Media columns: Netpbm and BMP decoded to numpy arrays, area-resized, written as NPY tiles with difference hashes."""

from __future__ import annotations

import hashlib
import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import prepare

#: Samples in a row of an image made from bytes: the unit that payloads are padded to.
ROW = 64
#: Size of the difference hash: HASH rows of HASH + 1 samples are compared.
HASH = 8


def encode_pgm(samples: np.ndarray) -> bytes:
    """Binary greymap (P5) of a two-dimensional array of 8-bit samples."""
    height, width = samples.shape
    return b"P5\n%d %d\n255\n" % (width, height) + samples.tobytes()


def encode_bmp(samples: np.ndarray) -> bytes:
    """Uncompressed BMP: 8-bit grey palette for two dimensions, 24-bit for (height, width, 3); rows run bottom up."""
    grey = samples.ndim == 2
    height, width = samples.shape[:2]
    row = samples if grey else samples[:, :, ::-1]
    line = width * (1 if grey else 3)
    body = np.zeros((height, -(-line // 4) * 4), np.uint8)
    body[:, :line] = row.reshape(height, line)[::-1]
    palette = b"".join(bytes((i, i, i, 0)) for i in range(256)) if grey else b""
    offset = 54 + len(palette)
    head = struct.pack("<2sIHHI", b"BM", offset + body.size, 0, 0, offset)
    return head + struct.pack("<IiiHHIIiiII", 40, width, height, 1, 8 if grey else 24, 0, body.size, 2835, 2835, 256 if grey else 0, 0) + palette + body.tobytes()


def _netpbm_header(data: bytes, fields: int) -> tuple[list[int], int]:
    values, at = [], 2
    while len(values) < fields:
        while at < len(data) and (data[at : at + 1].isspace() or data[at] == 0x23):
            at = at if data[at] != 0x23 else data.find(b"\n", at) if b"\n" in data[at:] else len(data)
            at += 1
        start = at
        while at < len(data) and data[at : at + 1].isdigit():
            at += 1
        if at == start:
            raise ValueError("bad Netpbm header")
        values.append(int(data[start:at]))
    return values, at + 1


def decode_netpbm(data: bytes) -> np.ndarray:
    """P1 to P6 as uint8 (16-bit samples as uint16): (height, width), or (height, width, 3) for pixmaps.

    Bitmaps come as 0 for black and 255 for white. Truncated data and bad headers raise ValueError.
    """
    kind = data[:2]
    if kind not in (b"P1", b"P2", b"P3", b"P4", b"P5", b"P6"):
        raise ValueError("not Netpbm")
    number = kind[1] - 0x30
    values, at = _netpbm_header(data, 2 if number in (1, 4) else 3)
    width, height, most = values[0], values[1], values[2] if len(values) > 2 else 1
    if not (width and height) or not 0 < most < 65536:
        raise ValueError("bad Netpbm header")
    planes = 3 if number in (3, 6) else 1
    count = width * height * planes
    if number == 4:
        line = -(-width // 8)
        raw = np.frombuffer(data, np.uint8, line * height, at).reshape(height, line)
        return (1 - np.unpackbits(raw, axis=1)[:, :width]) * np.uint8(255)
    if number == 1:
        bits = bytes(b for b in data[at - 1 :] if b in b"01")[:count]
        flat = np.frombuffer(bits, np.uint8) - 0x30
        flat = (1 - flat) * np.uint8(255)
    elif number in (2, 3):
        flat = np.array(data[at - 1 :].split()[:count], dtype=np.uint16)
    else:
        flat = np.frombuffer(data, ">u2" if most > 255 else np.uint8, count, at)
    if len(flat) < count:
        raise ValueError("truncated Netpbm data")
    flat = flat.astype(np.uint16 if most > 255 else np.uint8)
    return flat.reshape((height, width, 3) if planes == 3 else (height, width))


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP of 8 bits (through its palette; a grey palette gives two dimensions), 24 or 32 bits, as uint8 RGB."""
    if data[:2] != b"BM" or len(data) < 54:
        raise ValueError("not BMP")
    offset, header, width, height, _, bits, packed = struct.unpack_from("<I I i i H H I", data, 10)
    if packed or bits not in (8, 24, 32) or width <= 0 or height == 0:
        raise ValueError("unsupported BMP")
    line = -(-width * bits // 32) * 4
    raw = np.frombuffer(data, np.uint8, line * abs(height), offset).reshape(abs(height), line)
    raw = raw[::-1] if height > 0 else raw
    if bits == 8:
        used = struct.unpack_from("<I", data, 46)[0] or 256
        palette = np.frombuffer(data, np.uint8, 4 * used, 14 + header).reshape(used, 4)[:, 2::-1]
        out = palette[raw[:, :width]]
        return np.ascontiguousarray(out[:, :, 0]) if (palette == palette[:, :1]).all() else out
    step = bits // 8
    return np.ascontiguousarray(raw[:, : width * step].reshape(abs(height), width, step)[:, :, 2::-1])


def decode(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean over each target cell's area, in float64, by an integral image; cells may cut samples."""
    grid = np.zeros((image.shape[0] + 1, image.shape[1] + 1, *image.shape[2:]))
    np.cumsum(np.cumsum(image, axis=0, dtype=float), axis=1, out=grid[1:, 1:])

    def along(table: np.ndarray, edges: np.ndarray) -> np.ndarray:
        low = np.minimum(edges.astype(int), table.shape[0] - 2)
        part = (edges - low).reshape(-1, *[1] * (table.ndim - 1))
        return table[low] * (1 - part) + table[low + 1] * part

    rows = along(grid, np.linspace(0, image.shape[0], height + 1))
    both = along(rows.swapaxes(0, 1), np.linspace(0, image.shape[1], width + 1)).swapaxes(0, 1)
    area = image.shape[0] / height * (image.shape[1] / width)
    return (both[1:, 1:] - both[:-1, 1:] - both[1:, :-1] + both[:-1, :-1]) / area


def difference_hash(image: np.ndarray) -> str:
    """16 hex digits: 64 bits, set where a sample of the 8 x 9 image is darker than its right neighbour."""
    grey = image if image.ndim == 2 else image @ np.array([0.299, 0.587, 0.114])
    small = area_resize(grey, HASH, HASH + 1)
    # differences beneath rounding count as none
    return np.packbits(small[:, 1:] - small[:, :-1] > 1e-6).tobytes().hex()


def write_npy(tile: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, np.ascontiguousarray(tile), version=(1, 0), allow_pickle=False)
    return out.getvalue()


def read_npy(data: bytes) -> np.ndarray:
    return np.lib.format.read_array(io.BytesIO(data), allow_pickle=False)


def text_image(text: str | None) -> tuple[np.ndarray, int]:
    """(samples in rows of ROW, bytes before padding) of a text's UTF-8 form; null and empty texts give one row of zeros."""
    raw = (text or "").encode("utf-8")
    padded = raw + bytes(max(ROW, -(-len(raw) // ROW) * ROW) - len(raw))
    return np.frombuffer(padded, np.uint8).reshape(-1, ROW), len(raw)


def media_tile(data: bytes, height: int | None = None, width: int | None = None) -> bytes:
    """NPY tile of an encoded image: its own samples, or area-resized and rounded to the size given."""
    image = decode(data)
    if height and width:
        image = np.clip(np.rint(area_resize(image, height, width)), 0, np.iinfo(image.dtype).max).astype(image.dtype)
    return write_npy(image)


def decoded_images(rows: DataFrame, content: str, height: int | None = None, width: int | None = None) -> DataFrame:
    """``rows`` plus tile (NPY bytes), rows, columns and dhash of the images in the binary column ``content``.

    Null and unreadable images give nulls; the reason is in ``error``. Repeated rows each come back; columns of the new
    names are replaced; an empty table gives an empty result.
    """
    prepare(rows.sparkSession)
    rows = rows.drop("tile", "tile_rows", "tile_columns", "dhash", "error")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for data in batch[content]:
                try:
                    tile = media_tile(bytes(data), height, width)
                    image = read_npy(tile)
                    out.append((tile, image.shape[0], image.shape[1], difference_hash(image), None))
                except (ValueError, TypeError, IndexError, struct.error) as e:
                    out.append((None, None, None, None, str(e)[:200]))
            names = ("tile", "tile_rows", "tile_columns", "dhash", "error")
            yield pd.concat([batch.reset_index(drop=True), pd.DataFrame(out, columns=names, dtype=object)], axis=1)

    added = {"tile": "binary", "tile_rows": "int", "tile_columns": "int", "dhash": "string", "error": "string"}
    return rows.mapInPandas(run, rows.withColumns({k: F.lit(None).cast(v) for k, v in added.items()}).schema)


def text_media(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature) for each row.

    Each whole text becomes a greymap, is decoded, stored as an NPY tile and read back; the payload columns are taken
    from what was read back, and feature is its difference hash. Null texts are empty texts; repeated rows and equal
    texts have equal values; an empty table gives an empty result; other columns are not looked at.
    """
    prepare(docs.sparkSession)

    def row(text: str | None) -> tuple:
        samples, n = text_image(text)
        stored = media_tile(encode_pgm(samples))
        image = read_npy(stored)
        payload = image.tobytes()
        return n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-ROW:]), len(stored), hashlib.sha256(stored).hexdigest(), difference_hash(image)

    names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame([row(t) for t in batch["text"]], columns=names)
            yield pd.concat([batch[["doc_id"]].reset_index(drop=True), out], axis=1)

    rows = docs.select("doc_id", "text")
    kinds = ["long", "long", "string", "long", "long", "string", "string"]
    schema = rows.drop("text").withColumns({k: F.lit(None).cast(v) for k, v in zip(names, kinds, strict=True)}).schema
    return rows.mapInPandas(run, schema)
