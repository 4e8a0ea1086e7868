"""Image attributes and similarity kernels as Arrow-batched UDFs over ``binaryFile`` contents.

Formats are told by their first bytes in SQL. Pixels are decoded for PNG (8 bits, not interlaced)
with zlib; another format's pixels need a decoder that isn't installed here and come back null, as
those of a damaged file do. A file that can't be decoded never fails the job.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: First bytes in hex and format (fixed values).
MAGIC = (("89504E470D0A1A0A", "PNG"), ("FFD8FF", "JPEG"), ("424D", "BMP"), ("49492A00", "TIFF"), ("4D4D002A", "TIFF"))
#: Suffix and format, least side, and the mean channel difference below which an image counts as gray (fixed values).
EXPECTED = {".jpg": "JPEG", ".jpeg": "JPEG", ".png": "PNG", ".bmp": "BMP", ".tif": "TIFF", ".tiff": "TIFF", ".webp": "WEBP"}
MIN_SIDE = 50
CHANNEL_DIFF = 8.0
MODES = {0: "L", 2: "RGB", 3: "P", 4: "LA", 6: "RGBA"}
FACTS = T.StructType(
    [T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()), T.StructField("mode", T.StringType())]
    + [T.StructField(k, T.LongType()) for k in ("phash", "phash_flipped")]
    + [T.StructField(k, T.DoubleType()) for k in ("sharpness", "channel_diff")]
)


def image_format(content: Column) -> Column:
    """Format by first bytes; null if unknown."""
    head = F.hex(F.substring(content, 1, 12))
    out = F.when(head.startswith("52494646") & head.endswith("57454250"), "WEBP")
    for magic, name in MAGIC:
        out = out.when(head.startswith(magic), name)
    return out


def wrong_format(suffix: Column, found: Column) -> Column:
    """Whether a suffix promises another format than the bytes have."""
    promised = F.lit(None).cast("string")
    for k, v in EXPECTED.items():
        promised = F.when(suffix == k, v).otherwise(promised)
    return F.coalesce(promised != found, F.lit(False))


def too_small(width: Column, height: Column) -> Column:
    return F.least(width, height) < MIN_SIDE


def decode_png(data: bytes) -> tuple[np.ndarray, str] | None:
    """Pixels as height x width x channels and the mode; None if this isn't a PNG of a kind handled here."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        return None
    at, body, palette, head = 8, [], None, None
    while at + 8 <= len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        chunk = data[at + 8 : at + 8 + n]
        at += 12 + n
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", chunk)
        elif kind == b"PLTE":
            palette = np.frombuffer(chunk, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body.append(chunk)
    if head is None or head[2] != 8 or head[6] or head[3] not in MODES:
        return None
    width, height, channels = head[0], head[1], {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[head[3]]
    raw = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, 1 + width * channels)
    out, above = np.zeros((height, width * channels), np.uint8), np.zeros(width * channels, np.uint8)
    for y in range(height):
        above = out[y] = _unfilter(int(raw[y, 0]), raw[y, 1:], above, channels)
    pixels = out.reshape(height, width, channels)
    return (palette[pixels[..., 0]] if head[3] == 3 and palette is not None else pixels), MODES[head[3]]


def _unfilter(kind: int, line: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    if kind == 0:
        return line
    if kind == 2:
        return line + above
    if kind == 1:
        return np.cumsum(line.reshape(-1, step), axis=0, dtype=np.uint8).ravel()
    out = line.astype(np.int64)
    up = above.astype(np.int64)
    for i in range(len(out)):
        left = out[i - step] if i >= step else 0
        if kind == 3:
            out[i] = (out[i] + (left + up[i]) // 2) & 255
        else:
            corner = up[i - step] if i >= step else 0
            p = left + up[i] - corner
            near = min((abs(p - left), 0, left), (abs(p - up[i]), 1, up[i]), (abs(p - corner), 2, corner))
            out[i] = (out[i] + near[2]) & 255
    return out.astype(np.uint8)


def encode_png(pixels: np.ndarray) -> bytes:
    """Height x width x channels (1 or 3) as a PNG of unfiltered lines."""
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    h, w, channels = pixels.shape
    lines = np.pad(pixels.reshape(h, w * channels).astype(np.uint8), ((0, 0), (1, 0)))
    head = struct.pack(">IIBBBBB", w, h, 8, {1: 0, 3: 2}[channels], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes())) + chunk(b"IEND", b"")


def gray(pixels: np.ndarray) -> np.ndarray:
    p = pixels.astype(np.float64)
    return p[..., 0] if p.shape[2] < 3 else p[..., :3] @ np.array([0.299, 0.587, 0.114])


def shrink(plane: np.ndarray, side: int) -> np.ndarray:
    """A ``side`` x ``side`` image of area means (nearest cells where the plane is smaller)."""
    h, w = plane.shape[:2]
    y, x = np.linspace(0, h, side + 1), np.linspace(0, w, side + 1)
    lo, hi = y[:-1].astype(int), np.maximum(np.ceil(y[1:]).astype(int), y[:-1].astype(int) + 1)
    rows = np.stack([plane[a:b].mean(axis=0) for a, b in zip(lo, hi, strict=True)])
    lo, hi = x[:-1].astype(int), np.maximum(np.ceil(x[1:]).astype(int), x[:-1].astype(int) + 1)
    return np.stack([rows[:, a:b].mean(axis=1) for a, b in zip(lo, hi, strict=True)], axis=1)


_K = np.arange(32)
_DCT = np.cos(np.pi / 64 * (2 * _K[None, :] + 1) * _K[:, None])


def phash(plane: np.ndarray) -> int:
    """Signs against the median of the 8 x 8 lowest frequencies of the 32 x 32 image."""
    low = (_DCT @ shrink(plane, 32) @ _DCT.T)[:8, :8].ravel()
    return int(np.packbits(low > np.median(low)).view(">i8")[0])


def sharpness(plane: np.ndarray) -> float:
    """Variance of the Laplacian."""
    if min(plane.shape) < 3:
        return 0.0
    lap = plane[:-2, 1:-1] + plane[2:, 1:-1] + plane[1:-1, :-2] + plane[1:-1, 2:] - 4 * plane[1:-1, 1:-1]
    return float(lap.var())


def channel_diff(pixels: np.ndarray) -> float:
    """Mean of the mean absolute differences between the channels of the 64 x 64 image; 0 for one channel."""
    if pixels.shape[2] < 3:
        return 0.0
    r, g, b = (shrink(pixels[..., i].astype(np.float64), 64) for i in range(3))
    return float((np.abs(r - g).mean() + np.abs(r - b).mean() + np.abs(g - b).mean()) / 3)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Mean structural similarity of two 256 x 256 planes over 8 x 8 blocks."""
    blocks = lambda p: shrink(p, 256).reshape(32, 8, 32, 8).swapaxes(1, 2).reshape(1024, 64)
    x, y = blocks(a), blocks(b)
    mx, my = x.mean(axis=1), y.mean(axis=1)
    cov = ((x - mx[:, None]) * (y - my[:, None])).mean(axis=1)
    c1, c2 = (0.01 * 255) ** 2, (0.03 * 255) ** 2
    return float((((2 * mx * my + c1) * (2 * cov + c2)) / ((mx**2 + my**2 + c1) * (x.var(axis=1) + y.var(axis=1) + c2))).mean())


def _decoded(data: bytes | None) -> tuple[np.ndarray, str] | None:
    try:
        return decode_png(bytes(data)) if data is not None else None
    except (ValueError, IndexError, struct.error, zlib.error):
        return None


@F.pandas_udf(FACTS)
def facts(contents: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Size, mode, hashes of the plane and its mirror image, sharpness (0 on failure) and channel difference."""
    for batch in contents:
        rows = []
        for data in batch:
            got = _decoded(data)
            if got is None:
                rows.append((None, None, None, None, None, 0.0, None))
            else:
                p = gray(got[0])
                rows.append((p.shape[1], p.shape[0], got[1], phash(p), phash(p[:, ::-1]), sharpness(p), channel_diff(got[0])))
        # as objects first: beside a null, hashes would be held as doubles and lose their last bits
        frame = pd.DataFrame(rows, columns=FACTS.names, dtype=object)
        yield frame.astype({"width": "Int32", "height": "Int32", "phash": "Int64", "phash_flipped": "Int64", "sharpness": "Float64", "channel_diff": "Float64"})


@F.pandas_udf(T.DoubleType())
def structural_similarity(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Null if one of the two can't be decoded. Give it only candidate pairs whose bytes differ."""
    for left, right in pairs:
        out = []
        for a, b in zip(left, right, strict=True):
            x, y = _decoded(a), _decoded(b)
            out.append(None if x is None or y is None else similarity(gray(x[0]), gray(y[0])))
        yield pd.Series(out, dtype="Float64")


def is_gray(mode: Column, diff: Column) -> Column:
    """By mode, else by how little the channels differ; null if unknown."""
    return F.when(mode.isin("L", "LA", "1"), F.lit(True)).otherwise(diff < CHANNEL_DIFF)


def augmentation(key: Column, seed: int = 42) -> Column:
    """Parameters of an augmented image, drawn from a hash of its key: the same in any order of rows."""
    u = lambda i: F.pmod(F.xxhash64(F.lit(seed), F.lit(i), key), F.lit(1 << 30)) / float(1 << 30)
    return F.struct((u(0) < 0.5).alias("flip"), (u(1) * 30 - 15).alias("angle"), (0.85 + u(2) * 0.3).alias("brightness"), (0.85 + u(3) * 0.1).alias("zoom"), F.lit(95).alias("quality"))
