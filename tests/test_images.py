import struct
import zlib

import numpy as np
from pyspark.sql import functions as F

from sievework.functions import images


def png(pixels: np.ndarray, kind: int) -> bytes:
    h, w = pixels.shape[:2]
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    raw = b"".join(b"\x00" + pixels[y].astype(np.uint8).tobytes() for y in range(h))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def pictures():
    rng = np.random.default_rng(3)
    y, x = np.mgrid[0:80, 0:100]
    g = (127 + 60 * np.sin(x / 9) + 60 * np.cos(y / 5 + x / 30)).astype(np.uint8)
    color = np.stack([g, 255 - g, rng.integers(0, 255, g.shape)], axis=-1)
    return {"gray": png(g[..., None], 0), "copy": png(np.clip(g.astype(int) + 2, 0, 255)[..., None], 0), "mirror": png(g[:, ::-1, None], 0), "color": png(color, 2), "flat": png(np.full((60, 60, 3), 9), 2), "bad": b"\x89PNG\r\n\x1a\nrest", "none": b"", "jpeg": b"\xff\xd8\xff\xe0abc"}


def test_facts(spark):
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in pictures().items()], "k string, content binary")
    got = {r["k"]: r for r in df.select("k", images.image_format(F.col("content")).alias("format"), images.facts("content").alias("f")).collect()}
    f = {k: r["f"] for k, r in got.items()}
    assert (f["gray"]["width"], f["gray"]["height"], f["gray"]["mode"]) == (100, 80, "L")
    d = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
    assert d(f["gray"]["phash"], f["copy"]["phash"]) <= 4
    assert d(f["gray"]["phash_flipped"], f["mirror"]["phash"]) <= 4
    assert d(f["gray"]["phash"], f["color"]["phash"]) > 8
    assert f["flat"]["sharpness"] == 0 and f["gray"]["sharpness"] > 0
    assert f["flat"]["channel_diff"] == 0 and f["color"]["channel_diff"] > images.CHANNEL_DIFF
    assert f["bad"]["width"] is None and f["none"]["phash"] is None and f["bad"]["sharpness"] == 0
    assert got["jpeg"]["format"] == "JPEG" and got["none"]["format"] is None


def test_hashes_keep_their_last_bits_beside_damaged_images(spark):
    rng = np.random.default_rng(4)
    planes = [rng.integers(0, 256, (64, 64)) for _ in range(8)]
    rows = [(k, bytearray(images.encode_png(p[..., None]))) for k, p in enumerate(planes)] + [(8, bytearray(b"bad")), (9, None)]
    df = spark.createDataFrame(rows, "k int, content binary").coalesce(1)
    got = {r["k"]: r["f"] for r in df.select("k", images.facts("content").alias("f")).collect()}
    assert all(got[k]["phash"] == images.phash(p.astype(float)) for k, p in enumerate(planes))
    assert got[8]["phash"] is None and got[9]["phash"] is None


def test_similarity_and_parameters(spark):
    p = pictures()
    df = spark.createDataFrame([(bytearray(p["gray"]), bytearray(p[k])) for k in ("gray", "copy", "color", "bad")], "a binary, b binary")
    same, copy, other, bad = [r[0] for r in df.select(images.structural_similarity("a", "b")).collect()]
    assert abs(same - 1) < 1e-9 and copy > 0.95 and other < 0.9 and bad is None
    a = spark.range(200).select(images.augmentation(F.col("id")).alias("p")).select("p.*").collect()
    assert all(-15 <= r["angle"] <= 15 and 0.85 <= r["brightness"] <= 1.15 and 0.85 <= r["zoom"] <= 0.95 for r in a)
    assert 60 < sum(r["flip"] for r in a) < 140
    low = spark.createDataFrame([(".png", "JPEG", 60, 40), (".jpg", "JPEG", 60, 50), (".gif", "PNG", 9, 9)], "s string, f string, w int, h int")
    got = [tuple(r) for r in low.select(images.wrong_format(F.col("s"), F.col("f")), images.too_small(F.col("w"), F.col("h"))).collect()]
    assert got == [(True, True), (False, False), (False, True)]


def test_filters_of_png_lines():
    rng = np.random.default_rng(5)
    px = rng.integers(0, 256, (6, 7, 3)).astype(np.int64)
    lines = []
    for y in range(6):
        kind, line = y % 5, []
        for i in range(21):
            cur, left = px[y].ravel()[i], px[y].ravel()[i - 3] if i >= 3 else 0
            up = px[y - 1].ravel()[i] if y else 0
            corner = px[y - 1].ravel()[i - 3] if y and i >= 3 else 0
            p = left + up - corner
            paeth = min(((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner)))[2]
            line.append((cur - [0, left, up, (left + up) // 2, paeth][kind]) % 256)
        lines.append(bytes([kind, *map(int, line)]))
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + b"0000"
    data = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 7, 6, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(lines)))
    assert (images.decode_png(data)[0] == px).all()
