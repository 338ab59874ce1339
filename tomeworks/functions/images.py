"""Page images: sizes and encodings as Column expressions, pixel work in Arrow batches.

An image is a struct of width, height, channels (1 or 3) and pixels (8 bits each, row by row); null stays null."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

IMAGE = "struct<width:int,height:int,channels:int,pixels:binary>"
#: What counts as white, and the long edge of an image that is sent on.
WHITE, LONG_EDGE = 250, 1600


def long_edge(width: Column, height: Column, most: int = LONG_EDGE) -> Column:
    """width and height scaled down, never up, to a longer edge of `most`; each cut to whole pixels, and one at least."""
    longest = F.greatest(width, height)
    cut = lambda x: F.greatest(F.floor(x * most / longest), F.lit(1)).cast("int")
    return F.struct(F.when(longest > most, cut(width)).otherwise(width).alias("width"), F.when(longest > most, cut(height)).otherwise(height).alias("height"))


def digest(image: Column) -> Column:
    """The identity of what a page shows: SHA-256 over its size and pixels."""
    size = F.encode(F.concat_ws("x", image["width"].cast("string"), image["height"].cast("string"), image["channels"].cast("string")), "utf-8")
    return F.sha2(F.concat(size, image["pixels"]), 256)


def data_url(png: Column) -> Column:
    return F.concat(F.lit("data:image/png;base64,"), F.regexp_replace(F.base64(png), r"\s", ""))


def _array(x) -> np.ndarray:
    return np.frombuffer(x["pixels"], np.uint8).reshape(x["height"], x["width"], x["channels"])


def _row(a: np.ndarray) -> dict:
    h, w, c = a.shape
    return {"width": w, "height": h, "channels": c, "pixels": np.ascontiguousarray(a).tobytes()}


def dark_pixels(a: np.ndarray, white: int = WHITE) -> int:
    """Pixels of which any channel is darker than white."""
    return int((a < white).any(axis=2).sum())


def resized(a: np.ndarray, width: int, height: int) -> np.ndarray:
    """Means over the areas that the new pixels cover."""
    if a.shape[:2] == (height, width):
        return a

    def shrink(x: np.ndarray, n: int) -> np.ndarray:
        edge = np.linspace(0, len(x), n + 1)
        whole = np.concatenate((np.zeros((1, *x.shape[1:])), np.cumsum(x, axis=0, dtype=np.float64)))
        at = np.minimum(edge.astype(int), len(x) - 1)
        upto = whole[at] + x[at] * (edge - at)[:, None, None]
        return (upto[1:] - upto[:-1]) / (len(x) / n)

    return np.clip(np.rint(shrink(shrink(a, height).swapaxes(0, 1), width).swapaxes(0, 1)), 0, 255).astype(np.uint8)


def grey(a: np.ndarray) -> np.ndarray:
    """One channel of luma, stretched so that its darkest is 0 and its lightest 255."""
    y = a[..., :1].astype(np.float64) if a.shape[2] == 1 else (a[..., :3] @ np.array([0.299, 0.587, 0.114]))[..., None]
    y = np.rint(y)
    low, high = (y.min(), y.max()) if y.size else (0, 0)
    return (np.rint((y - low) * 255 / (high - low)) if high > low else y).astype(np.uint8)


def png_bytes(a: np.ndarray) -> bytes:
    h, w, c = a.shape
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    rows = np.concatenate((np.zeros((h, 1), np.uint8), a.reshape(h, w * c)), axis=1).tobytes()
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0 if c == 1 else 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def _structs(f):
    """A column function that makes images of images."""

    @F.pandas_udf(IMAGE)
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            rows = [None if x["pixels"] is None else _row(f(_array(x))) for x in df.to_dict("records")]
            yield pd.DataFrame([r or dict.fromkeys(("width", "height", "channels", "pixels")) for r in rows], columns=["width", "height", "channels", "pixels"]).astype({c: "Int32" for c in ("width", "height", "channels")})

    return run


def nonwhite(image: Column, white: int = WHITE) -> Column:
    """How many pixels show something; null for no image."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for df in batches:
            yield pd.Series([None if x["pixels"] is None else dark_pixels(_array(x), white) for x in df.to_dict("records")], dtype="Int64")

    return run(image)


def preprocessed(image: Column) -> Column:
    """Grey and stretched, as text recognition likes it."""
    return F.when(image.isNotNull(), _structs(grey)(image))


def scaled(image: Column, most: int = LONG_EDGE) -> Column:
    """Scaled down to a longer edge of `most`, as long_edge says."""

    def f(a: np.ndarray) -> np.ndarray:
        h, w = a.shape[:2]
        longest = max(h, w)
        return a if longest <= most else resized(a, max(1, w * most // longest), max(1, h * most // longest))

    return F.when(image.isNotNull(), _structs(f)(image))


def png(image: Column) -> Column:
    """The image as a PNG file."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for df in batches:
            yield pd.Series([None if x["pixels"] is None else png_bytes(_array(x)) for x in df.to_dict("records")], dtype=object)

    return run(image)
