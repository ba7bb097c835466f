"""Frames as images: portable pixmaps read, hashed by what they show, and written as PNG, with numpy and zlib alone."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HEADER = re.compile(rb"P6(?:\s+|\s*#[^\n]*\n\s*)+(\d+)(?:\s+|\s*#[^\n]*\n\s*)+(\d+)(?:\s+|\s*#[^\n]*\n\s*)+(\d+)\s")


def pixels(ppm: bytes) -> np.ndarray | None:
    """Height x width x 3 bytes of a binary pixmap; None for anything else."""
    m = _HEADER.match(ppm or b"")
    if not m or int(m[3]) != 255:
        return None
    width, height = int(m[1]), int(m[2])
    body = np.frombuffer(ppm, np.uint8, offset=m.end())
    if not width or not height or len(body) < width * height * 3:
        return None
    return body[: width * height * 3].reshape(height, width, 3)


def average_hash(image: np.ndarray, side: int = 8) -> str:
    """A bit for each of side x side cells, in hex: whether the cell is brighter than the image; like frames have like hashes."""
    gray = image.astype(np.float64) @ [0.299, 0.587, 0.114]
    rows, columns = (np.minimum(np.arange(side + 1) * n // side, n) for n in gray.shape)
    cells = np.array([[gray[a : max(b, a + 1), c : max(d, c + 1)].mean() for c, d in zip(np.minimum(columns, gray.shape[1] - 1), columns[1:])] for a, b in zip(np.minimum(rows, gray.shape[0] - 1), rows[1:])])
    bits = "".join("1" if x else "0" for x in (cells > cells.mean()).ravel())
    return f"{int(bits, 2):0{side * side // 4}x}"


def frame_hash(ppm: bytes) -> str:
    """The hash of what a frame shows; the SHA-256 of its bytes where it is no pixmap."""
    image = pixels(ppm)
    return hashlib.sha256(ppm or b"").hexdigest() if image is None else average_hash(image)


def png(image: np.ndarray) -> bytes:
    height, width, _ = image.shape
    raw = np.concatenate([np.zeros((height, 1), np.uint8), image.reshape(height, width * 3)], 1).tobytes()
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def hashed(frames: DataFrame, content: str = "content", out: str = "frame_hash") -> DataFrame:
    from orefold.sources.landing import ship

    ship(frames.sparkSession)

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            yield x.map(frame_hash)

    return frames.withColumn(out, _udf(of, "string")(F.col(content)))


def as_png(frames: DataFrame, content: str = "content", out: str = "png") -> DataFrame:
    """frames with their pixmaps as PNG; null where there is none."""
    from orefold.sources.landing import ship

    ship(frames.sparkSession)

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            yield x.map(lambda b: None if (image := pixels(b)) is None else png(image))

    return frames.withColumn(out, _udf(of, "binary")(F.col(content)))


def _udf(of, kind: str):
    return F.pandas_udf(of, kind)


def pixmap(gray: Column, width: int, height: int) -> Column:
    """A pixmap of gray cells, given as an array of numbers below 256."""
    cell = lambda x: F.unhex(F.concat(*([F.lpad(F.hex(x.cast("long")), 2, "0")] * 3)))
    return F.concat(F.encode(F.lit(f"P6\n{width} {height}\n255\n"), "UTF-8"), F.aggregate(F.transform(gray, cell), F.lit(b""), lambda a, x: F.concat(a, x)))
