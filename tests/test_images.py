"""Pixmaps, their hashes, and PNG round trips."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
from orefold.functions import images


def _ppm(a: np.ndarray) -> bytes:
    return b"P6\n# made here\n%d %d\n255\n" % (a.shape[1], a.shape[0]) + a.tobytes()


def _unpng(data: bytes) -> np.ndarray:
    at, size, body = 8, None, b""
    while at < len(data):
        n, kind = int.from_bytes(data[at : at + 4], "big"), data[at + 4 : at + 8]
        part = data[at + 8 : at + 8 + n]
        assert zlib.crc32(kind + part) == int.from_bytes(data[at + 8 + n : at + 12 + n], "big")
        if kind == b"IHDR":
            size = int.from_bytes(part[:4], "big"), int.from_bytes(part[4:8], "big")
        elif kind == b"IDAT":
            body += part
        at += 12 + n
    rows = np.frombuffer(zlib.decompress(body), np.uint8).reshape(size[1], 1 + 3 * size[0])
    assert (rows[:, 0] == 0).all()
    return rows[:, 1:].reshape(size[1], size[0], 3)


def test_hashes_follow_what_is_shown_and_png_keeps_every_pixel(spark):
    rng = np.random.default_rng(2)
    frame = np.kron(rng.integers(0, 2, (8, 8)), np.ones((12, 15)))[..., None].repeat(3, 2) * 200
    near = np.clip(frame + rng.integers(0, 20, frame.shape), 0, 255).astype(np.uint8)
    frame = frame.astype(np.uint8)
    assert images.average_hash(frame) == images.average_hash(near) != images.average_hash(255 - frame)
    assert (images.pixels(_ppm(near)) == near).all() and (_unpng(images.png(near)) == near).all()
    odd = [(1, bytearray(_ppm(near))), (2, bytearray(b"no image")), (3, None), (4, bytearray(_ppm(near)[:50])), (5, bytearray(_ppm(near[:3, :2])))]
    df = spark.createDataFrame(odd, "id int, content binary")
    out = {r.id: r for r in images.as_png(images.hashed(df)).collect()}
    assert out[1].frame_hash == images.average_hash(near) and (_unpng(bytes(out[1].png)) == near).all()
    assert out[2].frame_hash == hashlib.sha256(b"no image").hexdigest() and out[2].png is None and out[4].png is None
    assert out[3].png is None and len(out[5].frame_hash) == 16
