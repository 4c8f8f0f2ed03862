"""Images, as structs of height, width and gray bytes: hashes, differences, preprocessing."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterable
from functools import cache
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import file_stamp
from ..scratch import small_batches

IMAGE = "height int, width int, data binary"


def _array(height: int, width: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint8).reshape(height, width)


def _struct(images: Iterable[np.ndarray]) -> pd.DataFrame:
    """Images as rows; each is turned to bytes before the next one is made."""
    return pd.DataFrame([(*x.shape, x.astype(np.uint8).tobytes()) for x in images], columns=["height", "width", "data"])


def gray_of_source(image: Column) -> Column:
    """The struct of Spark's image source (BGR, BGRA or gray bytes) as a gray image."""

    @F.pandas_udf(IMAGE)
    def convert(x: pd.DataFrame) -> pd.DataFrame:
        def gray(row) -> np.ndarray:
            pixels = np.frombuffer(row.data, dtype=np.uint8).reshape(row.height, row.width, row.nChannels).astype(np.float32)
            return np.rint(pixels[..., 0] if row.nChannels == 1 else pixels[..., :3] @ np.array([0.114, 0.587, 0.299], np.float32))

        return _struct(map(gray, x.itertuples()))

    return convert(image)


#: Height and width of drawn images.
DRAWN = (48, 64)


def drawn(frames: DataFrame) -> DataFrame:
    """frames (vec_id, seq) with an image each, drawn by a rule in whole numbers: a texture by vec_id, a white block by seq."""

    small_batches(frames.sparkSession)

    @F.pandas_udf(IMAGE)
    def draw(vec: pd.Series, seq: pd.Series) -> pd.DataFrame:
        y, x = np.mgrid[0 : DRAWN[0], 0 : DRAWN[1]]
        # Bytes wrap around at 256, which is what the rule asks for.
        still, slope = (7 * x * x + 13 * y * y).astype(np.uint8), (x * y).astype(np.uint8)

        def image(v: int, s: int) -> np.ndarray:
            out = still + slope * np.uint8(v % 17 + 3) + np.uint8(31 * v % 256)
            top, left = s % 5 * 8, s % 7 * 8
            out[top : top + 6, left : left + 6] = 255
            return out

        return _struct(map(image, vec.tolist(), seq.tolist()))

    return frames.withColumn("image", draw("vec_id", "seq"))


@cache
def _weights(size: int, n: int) -> np.ndarray:
    """What each of size pixels adds to each of n: means over boxes where they get fewer, linear in between where more."""
    out = np.zeros((n, size))
    if n < size:
        edges = np.linspace(0, size, n + 1)
        for i in range(n):
            for j in range(int(edges[i]), min(size, int(np.ceil(edges[i + 1])))):
                out[i, j] = max(0.0, min(edges[i + 1], j + 1) - max(edges[i], j)) * n / size
        return out
    places = np.clip((np.arange(n) + 0.5) * size / n - 0.5, 0, size - 1)
    low = np.minimum(places.astype(int), max(0, size - 2))
    out[np.arange(n), low] += 1 - (places - low)
    out[np.arange(n), np.minimum(low + 1, size - 1)] += places - low
    return out


def _resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    return _weights(image.shape[0], height) @ image.astype(np.float64) @ _weights(image.shape[1], width).T


@cache
def _cosines(n: int) -> np.ndarray:
    k, i = np.mgrid[0:n, 0:n]
    return np.cos(np.pi * k * (2 * i + 1) / (2 * n))


def perceptual_hash(image: np.ndarray) -> tuple[int, int]:
    """64 bits, as two halves: which of the 8 by 8 lowest frequencies of the 32 by 32 image are over their median."""
    c = _cosines(32)
    low = (c @ _resize(image, 32, 32) @ c.T)[:8, :8]
    bits = (low > np.median(low)).ravel()
    halves = [int("".join("1" if x else "0" for x in half), 2) for half in (bits[:32], bits[32:])]
    return halves[0], halves[1]


def with_phash(frames: DataFrame, column: str = "image") -> DataFrame:
    """frames with hash_hi, hash_lo, phash_hex and phash_error; an image that can't be read has an error and no hash."""

    @F.pandas_udf("hash_hi long, hash_lo long, error string")
    def hashed(x: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for row in x.itertuples():
            try:
                rows.append((*perceptual_hash(_array(int(row.height), int(row.width), row.data)), None))
            except (ValueError, TypeError) as e:
                rows.append((None, None, str(e)))
        return pd.DataFrame(rows, columns=["hash_hi", "hash_lo", "error"]).astype({"hash_hi": "Int64", "hash_lo": "Int64"})

    out = frames.withColumn("__h", hashed(F.col(column)))
    half = lambda x: F.lower(F.lpad(F.hex(F.col(f"__h.{x}")), 8, "0"))
    return out.withColumns({"hash_hi": F.col("__h.hash_hi"), "hash_lo": F.col("__h.hash_lo"), "phash_hex": F.concat(half("hash_hi"), half("hash_lo")), "phash_error": F.col("__h.error")}).drop("__h")


def difference(a: dict | None, b: dict | None) -> tuple[int, int]:
    """The sum of the differences of two images' pixels over their common size, and how many pixels that has; 0 if one is null or empty."""
    if not a or not b or not a["data"] or not b["data"]:
        return 0, 0
    u, v = (_array(int(x["height"]), int(x["width"]), x["data"]) for x in (a, b))
    h, w = min(u.shape[0], v.shape[0]), min(u.shape[1], v.shape[1])
    u, v = u[:h, :w], v[:h, :w]
    return int((np.maximum(u, v) - np.minimum(u, v)).sum(dtype=np.int64)), h * w


def ratio(a: dict | None, b: dict | None) -> float:
    """The mean difference of two images' pixels over their common size, 0 to 1; 0 if one is null or empty."""
    total, n = difference(a, b)
    return total / (n * 255.0) if n else 0.0


def delta_ratio(a: Column, b: Column) -> Column:
    """The mean difference of two images' pixels over their common size, 0 to 1; 0 if one is null or empty."""

    @F.pandas_udf("double")
    def differ(x: pd.DataFrame, y: pd.DataFrame) -> pd.Series:
        return pd.Series([ratio(p, q) for p, q in zip(x.to_dict("records"), y.to_dict("records"))], dtype="float64")

    return differ(a, b)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """The image files of a folder: path, image (gray). Files that are no images are left out."""
    found = spark.read.format("image").option("dropInvalid", True).load(path)
    return found.select(F.col("image.origin").alias("path"), gray_of_source(F.col("image")).alias("image"))


def png_bytes(image: np.ndarray) -> bytes:
    """A gray image as a PNG file."""
    height, width = image.shape
    rows = np.zeros((height, width + 1), dtype=np.uint8)
    rows[:, 1:] = image
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(rows.tobytes())) + part(b"IEND", b"")


def write_images(frames: DataFrame, folder: str) -> DataFrame:
    """Writes each image of frames (video_id, timestamp, image) as folder/video_id/frame_SSSSSS.mmm.png; adds processed_path.

    Of frames of one recording and millisecond the one that is written last stays. A file is written beside its place
    and then moved there, so a task that is run again leaves whole files only. folder: where all executors can write.
    """
    placed = frames.withColumn("processed_path", F.concat(F.lit(folder.rstrip("/") + "/"), F.col("video_id").cast("string"), F.lit("/frame_"), file_stamp(F.col("timestamp")), F.lit(".png")))

    @F.pandas_udf("string")
    def write(paths: pd.Series, images: pd.DataFrame) -> pd.Series:
        for path, row in zip(paths, images.itertuples()):
            system, place = FileSystem.from_uri(path)
            parent, _, name = place.rpartition("/")
            system.create_dir(parent, recursive=True)
            beside = f"{parent}/.{uuid.uuid4().hex}-{name}"
            with system.open_output_stream(beside) as out:
                out.write(png_bytes(_array(int(row.height), int(row.width), row.data)))
            system.move(beside, place)
        return paths

    return placed.withColumn("processed_path", write("processed_path", "image"))


def stretch(image: np.ndarray, cutoff: float = 0.0) -> np.ndarray:
    """Contrast stretched to 0 to 255, without cutoff percent of the pixels at either end."""
    low, high = np.percentile(image, [cutoff, 100 - cutoff], method="nearest") if cutoff else (image.min(), image.max())
    return image.astype(np.float64) if high <= low else np.clip((image - low) * 255.0 / (high - low), 0, 255)


def _around(image: np.ndarray) -> np.ndarray:
    """The nine values around each pixel, the edge repeated: 9 by height by width."""
    padded = np.pad(image, 1, mode="edge")
    h, w = image.shape
    return np.stack([padded[y : y + h, x : x + w] for y in range(3) for x in range(3)])


#: Comparisons that leave the median of nine values in the fifth place (Paeth 1990).
_MEDIAN = ((1, 2), (4, 5), (7, 8), (0, 1), (3, 4), (6, 7), (1, 2), (4, 5), (7, 8), (0, 3), (5, 8), (4, 7), (3, 6), (1, 4), (2, 5), (4, 7), (4, 2), (6, 4), (4, 2))


def _middle(image: np.ndarray) -> np.ndarray:
    """The median of the nine values around each pixel."""
    around = list(_around(image))
    for a, b in _MEDIAN:
        around[a], around[b] = np.minimum(around[a], around[b]), np.maximum(around[a], around[b])
    return around[4]


def _weighed(shifted: Iterable[np.ndarray], weights: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    out, one = np.zeros(shape), np.empty(shape)
    for x, k in zip(shifted, weights):
        np.multiply(x, k, out=one)
        out += one
    return out


def blur(image: np.ndarray, radius: float) -> np.ndarray:
    reach = max(1, int(3 * radius))
    weights = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2 * radius**2))
    weights /= weights.sum()
    h, w = image.shape
    rows = np.pad(image, ((0, 0), (reach, reach)), mode="edge")
    across = _weighed((rows[:, i : i + w] for i in range(len(weights))), weights, (h, w))
    columns = np.pad(across, ((reach, reach), (0, 0)), mode="edge")
    return _weighed((columns[i : i + h] for i in range(len(weights))), weights, (h, w))


def sharpen(image: np.ndarray, radius: float, percent: float, threshold: float) -> np.ndarray:
    apart = image - blur(image, radius)
    return np.clip(np.where(np.abs(apart) >= threshold, image + apart * percent / 100.0, image), 0, 255)


def otsu(image: np.ndarray) -> float:
    """The threshold that parts a gray image's values best."""
    counts = np.bincount(image.astype(np.uint8).ravel(), minlength=256).astype(np.float64)
    below, sums = np.cumsum(counts), np.cumsum(counts * np.arange(256))
    above = below[-1] - below
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = below * above * (sums / below - (sums[-1] - sums) / above) ** 2
    return float(np.nanargmax(spread)) if np.isfinite(spread).any() else 127.0


def threshold(image: np.ndarray, mode: str, block: int = 35, c: float = 11) -> np.ndarray:
    if mode == "none":
        return image
    if mode == "otsu":
        return np.where(image > otsu(image), 255, 0)
    if mode == "adaptive":
        return np.where(image > blur(image, block / 6) - c, 255, 0)
    raise ValueError(f"unknown threshold mode: {mode}")


class Results:
    """Results of a Python worker by digests of what they were made from. The last ones stay, most bytes of them at most."""

    def __init__(self, most: int):
        self.most, self.held, self.known = most, 0, {}

    def of(self, image: np.ndarray, settings: tuple, make: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        key = (blake2b(image, digest_size=16).digest(), image.shape, settings)
        if key not in self.known:
            out = self.known[key] = make(image)
            self.held += out.nbytes
            while self.held > self.most:
                self.held -= self.known.pop(next(iter(self.known))).nbytes
            return out
        return self.known[key]


#: Equal images, as those of a still recording, are preprocessed once by a worker while they are among the last 64 MB.
_PREPROCESSED = Results(1 << 26)


def preprocessed(image: Column, scale: float = 2.0, mode: str = "adaptive", denoise: bool = True, sharp: bool = True) -> Column:
    """Scaled, stretched, sharpened, freed of specks and thresholded. Close to what image libraries give, not the same."""

    def process(own: np.ndarray) -> np.ndarray:
        own = stretch(_resize(own, max(1, int(own.shape[0] * scale)), max(1, int(own.shape[1] * scale))))
        own = sharpen(own, 2, 175, 3) if sharp else own
        own = _middle(own) if denoise else own
        return np.rint(threshold(own, mode)).astype(np.uint8)

    @F.pandas_udf(IMAGE)
    def run(x: pd.DataFrame) -> pd.DataFrame:
        from cuesheet.operators.images import _PREPROCESSED as results  # the worker's own, not one sent along

        return _struct(results.of(_array(int(row.height), int(row.width), row.data), (scale, mode, denoise, sharp), process) for row in x.itertuples())

    return run(image)


def variants(image: Column) -> Column:
    """Two forms of a crop for a second try: a stretched and lightly sharpened, b strongly sharpened and thresholded."""

    @F.pandas_udf("a binary, b binary")
    def run(x: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for row in x.itertuples():
            own = _array(int(row.height), int(row.width), row.data).astype(np.float64)
            a = sharpen(stretch(own, 1), 1.8, 150, 2)
            around = _around(own).sum(axis=0) - own
            b = _middle(np.clip(own * 5.2 - around * 0.525, 0, 255))
            rows.append((np.rint(a).astype(np.uint8).tobytes(), threshold(b, "adaptive", 31, 9).astype(np.uint8).tobytes()))
        return pd.DataFrame(rows, columns=["a", "b"])

    return run(image)
