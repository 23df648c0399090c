"""Pixel arrays: scaling, area resize, channel standardisation, whole-image preprocessing.

Short arrays are scaled with built-in array functions. Resizing is a product
with two dense weight matrices, which array functions can only interpret cell
by cell, so it runs in numpy on Arrow batches; rows never leave their partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from roentra import schemas
from roentra.operators import parsing

PROCESSED_SCHEMA = (
    "image_id string, file_path string, height int, width int, pixels array<int>, "
    "content_hash string, error string"
)
PROCESSED_COLUMNS = [part.split()[0] for part in PROCESSED_SCHEMA.split(", ")]


def scale_to_byte(pixels: Column) -> Column:
    """Min-max scaling to 0..255, truncated; a flat image keeps its values (mod 256).

    Single precision throughout, as image arrays are float32: each step is
    rounded to float. The bounds are bound to a lambda variable so that they
    are computed once per image, not once per pixel.
    """
    full_range = F.lit(255.0).cast("float")

    def scaled(image: Column) -> Column:
        low, high = image["low"], image["high"]

        def one(v: Column) -> Column:
            share = ((v - low) / (high - low)).cast("float")
            byte = F.floor(share * full_range).cast("int")
            return F.when(high > low, byte).otherwise(F.pmod(v.cast("int"), F.lit(256)))

        return F.transform(image["px"], one)

    px = pixels.cast("array<float>")
    image = F.struct(px.alias("px"), F.array_min(px).alias("low"), F.array_max(px).alias("high"))
    return F.when(pixels.isNotNull(), F.transform(F.array(image), scaled)[0])


def standardize_channels(
    pixels: Column,
    mean: tuple[float, ...] = schemas.CHANNEL_MEAN,
    std: tuple[float, ...] = schemas.CHANNEL_STD,
) -> Column:
    """Grey bytes -> one standardised array per channel: (v / 255 - mean) / std."""

    def channel(px: Column, m: float, s: float) -> Column:
        return F.transform(px, lambda v: (v / F.lit(255.0) - F.lit(m)) / F.lit(s))

    # Bound to a lambda variable, so that a computed ``pixels`` is computed once, not per channel.

    channels = F.transform(
        F.array(pixels),
        lambda px: F.array(*[channel(px, m, s) for m, s in zip(mean, std)]),
    )
    return F.when(pixels.isNotNull(), channels[0])


def area_weights(source: int, target: int) -> np.ndarray:
    """target x source matrix: the share of each target cell covered by each source cell.

    Works in both directions: a target cell smaller than the source cells takes the value
    of the one it lies in, or the mean of those it touches by overlap.
    """
    cell = np.arange(source)[None, :]
    out = np.arange(target)[:, None]
    # Overlap in units of 1/target, so whole-number arithmetic until the division.
    upper = np.minimum((cell + 1) * target, (out + 1) * source)
    lower = np.maximum(cell * target, out * source)
    return np.maximum(upper - lower, 0) / source


def bilinear_weights(source: int, target: int) -> np.ndarray:
    """target x source matrix of a tent filter, widened when shrinking (antialiased bilinear)."""
    ratio = source / target
    reach = max(ratio, 1.0)
    centre = (np.arange(target)[:, None] + 0.5) * ratio
    distance = np.abs(np.arange(source)[None, :] + 0.5 - centre)
    weights = np.maximum(0.0, 1.0 - distance / reach)
    return weights / weights.sum(axis=1, keepdims=True)


WEIGHTS = {"area": area_weights, "bilinear": bilinear_weights}


# Source sizes whose weights a task keeps at a time.
KEPT_WEIGHTS = 64


def axis_weights(method: str) -> Callable[[int, int], np.ndarray]:
    """The weight matrices of a method, each built once while a task keeps seeing its size."""
    known: dict[tuple[int, int], np.ndarray] = {}

    def weights(source: int, target: int) -> np.ndarray:
        if (source, target) not in known:
            if len(known) >= KEPT_WEIGHTS:
                known.clear()
            known[source, target] = WEIGHTS[method](source, target)
        return known[source, target]

    return weights


def resampler(target: tuple[int, int], method: str = "area") -> Callable[[np.ndarray], np.ndarray]:
    """Resizes one or a stack of images (..., height, width) by two weight products."""
    weights = axis_weights(method)

    def resize(image: np.ndarray) -> np.ndarray:
        by_row = weights(image.shape[-2], target[0])
        return by_row @ image @ weights(image.shape[-1], target[1]).T

    return resize


def resample(image: np.ndarray, target: tuple[int, int], method: str = "area") -> np.ndarray:
    return resampler(target, method)(image)


def resize_pixels(
    images: DataFrame, target: tuple[int, int], method: str = "area"
) -> DataFrame:
    """(image_id, height, width, pixels) -> same columns at the target size, row-major doubles.

    An image without a size, without pixels or with another number of them keeps
    its row, with all three NULL.
    """

    def whole(height, width, values) -> bool:
        known = values is not None and not pd.isna(height) and not pd.isna(width)
        return known and len(values) == height * width > 0

    def resize_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resize = resampler(target, method)
        for batch in batches:
            sizes = zip(batch["height"], batch["width"], batch["pixels"])
            good = np.array([whole(*size) for size in sizes], dtype=bool)
            if not good.all():
                yield batch.loc[~good, ["image_id"]].assign(height=None, width=None, pixels=None)
            # Images of one shape go through the product as one stack.
            for (height, width), group in batch[good].groupby(["height", "width"], sort=False):
                stack = np.stack(group["pixels"].to_numpy()).astype(np.float64)
                out = resize(stack.reshape(-1, int(height), int(width)))
                yield pd.DataFrame(
                    {
                        "image_id": group["image_id"].to_numpy(),
                        "height": target[0],
                        "width": target[1],
                        "pixels": list(out.reshape(len(group), -1)),
                    }
                )

    narrow = images.select("image_id", "height", "width", "pixels")
    id_type = narrow.schema["image_id"].dataType.simpleString()
    return narrow.mapInPandas(
        resize_batches, f"image_id {id_type}, height int, width int, pixels array<double>"
    )


def preprocess_array(
    pixels: np.ndarray,
    target: tuple[int, int],
    resize: Callable[[np.ndarray], np.ndarray] | None = None,
) -> np.ndarray:
    """One decoded image -> bytes at the target size: scale, truncate, area-average, round.

    The image is (height, width) or (height, width, channels), and so is the result.
    """
    image = np.asarray(pixels, dtype=np.float32)
    low, high = image.min(), image.max()
    if high > low:
        truncated = ((image - low) / (high - low) * np.float32(255.0)).astype(np.uint8)
    else:
        truncated = image.astype(np.int64) & 255
    if truncated.ndim not in (2, 3):
        raise ValueError(f"not an image: {truncated.ndim} dimensions")
    planes = np.moveaxis(truncated.astype(np.float64), -1, 0) if truncated.ndim == 3 else truncated
    out = np.rint((resize or resampler(target))(planes)).astype(np.int32)
    return np.moveaxis(out, 0, -1) if truncated.ndim == 3 else out


def dicom_pixels(content: bytes) -> np.ndarray:
    """Pixel matrix of one DICOM file; needs the pydicom package on the executors."""
    import io

    import pydicom

    return pydicom.dcmread(io.BytesIO(content)).pixel_array


def rgb_pixels(content: bytes) -> np.ndarray:
    """(height, width, 3) bytes of a PNG, JPEG, ... image; needs Pillow on the executors."""
    import io

    from PIL import Image

    return np.asarray(Image.open(io.BytesIO(content)).convert("RGB"))


def image_row(
    path: str,
    content: bytes,
    decode: Callable[[bytes], np.ndarray],
    target: tuple[int, int],
    resize: Callable[[np.ndarray], np.ndarray],
    suffix: str,
) -> tuple:
    """Values of ``PROCESSED_COLUMNS`` of one file: its pixels, or the error text."""
    image_id = path.rsplit("/", 1)[-1].replace(suffix, "")
    try:
        out = preprocess_array(decode(content), target, resize)
        digest = hashlib.md5(out.astype(np.uint8).tobytes()).hexdigest()
        return (image_id, path, *target, out.ravel(), digest, None)
    except Exception as problem:  # quarantined, see ``error``
        text = str(problem) or type(problem).__name__
        return (image_id, path, None, None, None, None, text)


def preprocess_images(
    files: DataFrame,
    decode: Callable[[bytes], np.ndarray] = dicom_pixels,
    target: tuple[int, int] = schemas.TARGET_SIZE,
    suffix: str = ".dcm",
) -> DataFrame:
    """Binary files (path, content) -> one row per file: processed pixels, or the error text.

    ``decode`` turns the bytes of one file into an array, with or without channels. A file that fails
    becomes a row with ``error`` set; the job goes on. ``content_hash`` is the
    MD5 of the processed bytes, for duplicate detection; ``image_id`` is the same
    key the headers carry as original_filename.
    """

    def process(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resize = resampler(target)
        for batch in batches:
            rows = [
                image_row(path, content, decode, target, resize, suffix)
                for path, content in zip(batch["path"], batch["content"])
            ]
            yield pd.DataFrame(rows, columns=PROCESSED_COLUMNS, dtype=object)

    return files.select("path", "content").mapInPandas(process, PROCESSED_SCHEMA)


def read_files_once(
    files: DataFrame,
    parse: Callable[[bytes], Mapping[str, object]] = parsing.dicom_header,
    decode: Callable[[bytes], np.ndarray] = dicom_pixels,
    target: tuple[int, int] = schemas.TARGET_SIZE,
    suffix: str = ".dcm",
) -> DataFrame:
    """Binary files (path, content) -> the columns of ``preprocess_images``, the raw header fields
    and ``header_error``: bytes are read and shipped once for both.

    A file may fail as an image and have a header, or the other way round.
    """
    fields = [*PROCESSED_COLUMNS, *parsing.FIELDS, "header_error"]
    header = parsing.PARSED_SCHEMA.partition(", ")[2].replace(", error string", "")

    def process(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resize = resampler(target)
        for batch in batches:
            rows = [
                (
                    *image_row(path, content, decode, target, resize, suffix),
                    *parsing.header_row(content, parse),
                )
                for path, content in zip(batch["path"], batch["content"])
            ]
            yield pd.DataFrame(rows, columns=fields, dtype=object)

    kind = f"{PROCESSED_SCHEMA}, {header}, header_error string"
    return files.select("path", "content").mapInPandas(process, kind)


def bilinear_bytes(
    planes: np.ndarray, target: tuple[int, int], weights: Callable = bilinear_weights
) -> np.ndarray:
    """Bilinear resize of byte planes, rounded half up after the width and after the height pass."""
    by_row = weights(planes.shape[-2], target[0])
    by_col = weights(planes.shape[-1], target[1])
    wide = np.floor(planes @ by_col.T + 0.5)
    return np.floor(by_row @ wide + 0.5)


def upload_features(
    uploads: DataFrame,
    decode: Callable[[bytes], np.ndarray] = rgb_pixels,
    target: tuple[int, int] = schemas.TARGET_SIZE,
) -> DataFrame:
    """Uploaded images (filename, content) -> model input, or the error text.

    Each colour plane is resized and standardised; ``features`` is their
    concatenation, channel by channel. A file that fails keeps its row, with ``error`` set.
    """
    mean = np.array(schemas.CHANNEL_MEAN)[:, None, None]
    std = np.array(schemas.CHANNEL_STD)[:, None, None]

    def prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = axis_weights("bilinear")
        for batch in batches:
            rows = []
            for name, content in zip(batch["filename"], batch["content"]):
                try:
                    planes = np.moveaxis(decode(content).astype(np.float64), -1, 0)
                    features = (bilinear_bytes(planes, target, weights) / 255.0 - mean) / std
                    rows.append((name, features.ravel(), None))
                except Exception as problem:  # rejected, see ``error``
                    rows.append((name, None, str(problem) or type(problem).__name__))
            yield pd.DataFrame(rows, columns=["filename", "features", "error"], dtype=object)

    return uploads.select("filename", "content").mapInPandas(
        prepare, "filename string, features array<double>, error string"
    )


def preprocess_pixel_table(images: DataFrame, target: tuple[int, int]) -> DataFrame:
    """Decoded images (image_id, height, width, pixels) -> rounded bytes at the target size."""
    scaled = images.withColumn("pixels", scale_to_byte(F.col("pixels")))
    resized = resize_pixels(scaled, target)
    return resized.withColumn(
        "pixels", F.transform("pixels", lambda v: F.rint(v).cast("int"))
    )


def pixels_long(images: DataFrame, alias: str = "v") -> DataFrame:
    """(image_id, pos, v): one row per pixel, for inspection."""
    return images.select("image_id", F.posexplode("pixels").alias("pos", alias))
