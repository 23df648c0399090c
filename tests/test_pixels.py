import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from roentra.operators import pixels


def brute_force_area(image, target):
    """Average over the exact overlap of every target cell, in fractions of a cell."""
    h, w = image.shape
    out = np.zeros(target)
    for r in range(target[0]):
        for c in range(target[1]):
            top, bottom = r * h / target[0], (r + 1) * h / target[0]
            left, right = c * w / target[1], (c + 1) * w / target[1]
            total = 0.0
            for i in range(h):
                for j in range(w):
                    dy = max(0.0, min(i + 1, bottom) - max(i, top))
                    dx = max(0.0, min(j + 1, right) - max(j, left))
                    total += image[i, j] * dy * dx
            out[r, c] = total / ((bottom - top) * (right - left))
    return out


@pytest.mark.parametrize("source,target", [(8, 3), (8, 8), (1024, 224), (5, 1), (3, 8), (200, 224)])
def test_area_weights_cover_everything_once(source, target):
    weights = pixels.area_weights(source, target)
    assert weights.shape == (target, source)
    assert np.allclose(weights.sum(axis=1), 1)
    assert np.allclose(weights.sum(axis=0), target / source)


def test_area_resize_equals_brute_force():
    image = np.random.default_rng(1).random((9, 7))
    for target in [(4, 3), (12, 10), (4, 20), (9, 7)]:
        assert np.allclose(pixels.resample(image, target), brute_force_area(image, target))


def test_bilinear_weights():
    for source, target in [(8, 3), (3, 8), (5, 5)]:
        weights = pixels.bilinear_weights(source, target)
        assert np.allclose(weights.sum(axis=1), 1)
    assert np.allclose(pixels.bilinear_weights(5, 5), np.eye(5))
    # Doubling a two-pixel edge blends only between the two centres.
    assert np.allclose(pixels.bilinear_weights(2, 4) @ [0.0, 1.0], [0, 0.25, 0.75, 1])


def test_channels_are_resized_apart():
    image = np.random.default_rng(7).integers(0, 256, (9, 7, 3))
    image[0, 0], image[0, 1] = 0, 255  # the scaling is over all channels
    out = pixels.preprocess_array(image, (12, 3))
    assert out.shape == (12, 3, 3)
    for c in range(3):
        plane = pixels.resample(image[..., c].astype(float), (12, 3))
        assert np.array_equal(out[..., c], np.rint(plane))


def test_images_without_a_size_keep_their_row(spark):
    rows = [(1, 2, 2, [1.0, 2.0, 3.0, 4.0]), (2, None, 2, [1.0]), (3, 2, 2, None), (4, 3, 3, [1.0]), (5, None, None, None)]
    df = spark.createDataFrame(rows, "image_id int, height int, width int, pixels array<double>")
    out = {r["image_id"]: r for r in pixels.resize_pixels(df, (4, 4)).collect()}
    assert set(out) == {1, 2, 3, 4, 5} and len(out[1]["pixels"]) == 16
    assert all(out[i]["pixels"] is None and out[i]["height"] is None for i in (2, 3, 4, 5))


def image_frame(spark, images):
    rows = [(i, m.shape[0], m.shape[1], [float(v) for v in m.ravel()]) for i, m in enumerate(images)]
    return spark.createDataFrame(rows, "image_id int, height int, width int, pixels array<double>")


def test_resize_of_mixed_shapes(spark):
    rng = np.random.default_rng(2)
    images = [rng.random((8, 6)), rng.random((5, 9)), rng.random((8, 6))]
    out = pixels.resize_pixels(image_frame(spark, images), (3, 2)).collect()
    assert len(out) == 3
    for row in out:
        expected = pixels.resample(images[row["image_id"]], (3, 2))
        assert (row["height"], row["width"]) == (3, 2)
        assert np.allclose(row["pixels"], expected.ravel())


@pytest.mark.parametrize(
    "values,expected",
    [
        ([0.0, 10.0], [0, 255]),
        ([7.0, 7.0], [7, 7]),
        ([300.0, 300.0], [44, 44]),
        ([-1.0, 0.0, 1.0], [0, 127, 255]),
        ([5.0], [5]),
        (None, None),
    ],
)
def test_scale_to_byte(spark, values, expected):
    df = spark.createDataFrame([(values,)], "px array<double>")
    assert df.select(pixels.scale_to_byte(F.col("px"))).first()[0] == expected


def test_scale_to_byte_equals_single_precision_numpy(spark):
    rng = np.random.default_rng(3)
    images = [rng.integers(0, 4096, 64).astype(np.float32) for _ in range(200)]
    df = spark.createDataFrame([(i, [float(v) for v in m]) for i, m in enumerate(images)], "i int, px array<float>")
    for row in df.select("i", pixels.scale_to_byte(F.col("px")).alias("b")).collect():
        m = images[row["i"]]
        expected = ((m - m.min()) / (m.max() - m.min()) * np.float32(255.0)).astype(np.uint8)
        assert row["b"] == expected.tolist()


def test_standardize_channels(spark):
    df = spark.createDataFrame([([0, 255],)], "px array<int>")
    out = df.select(pixels.standardize_channels(F.col("px"))).first()[0]
    expected = [[-0.485 / 0.229, 0.515 / 0.229], [-0.456 / 0.224, 0.544 / 0.224], [-0.406 / 0.225, 0.594 / 0.225]]
    assert np.allclose(out, expected)


def test_whole_image_job_equals_table_form_and_quarantines(spark):
    rng = np.random.default_rng(4)
    images = [rng.integers(0, 4096, (12, 10)) for _ in range(5)]
    files = [(f"raw/{i}.dcm", bytearray(json.dumps(m.tolist()).encode())) for i, m in enumerate(images)]
    files.append(("raw/broken.dcm", bytearray(b"no image")))
    df = spark.createDataFrame(files, "path string, content binary")
    out = {
        r["image_id"]: r
        for r in pixels.preprocess_images(df, lambda b: np.array(json.loads(b)), (4, 3)).collect()
    }
    assert out["broken"]["pixels"] is None and out["broken"]["error"]
    table = pixels.preprocess_pixel_table(image_frame(spark, images), (4, 3))
    for row in table.collect():
        same = out[str(row["image_id"])]
        assert same["pixels"] == row["pixels"] and same["error"] is None
        assert (same["height"], same["width"]) == (4, 3)
        assert len(same["content_hash"]) == 32


def test_upload_features(spark):
    rng = np.random.default_rng(5)
    image = rng.integers(0, 256, (6, 5, 3))
    rows = [("a.png", bytearray(json.dumps(image.tolist()).encode())), ("b.png", bytearray(b"not an image"))]
    df = spark.createDataFrame(rows, "filename string, content binary")
    out = {
        r["filename"]: r
        for r in pixels.upload_features(df, lambda b: np.array(json.loads(b)), (6, 5)).collect()
    }
    assert out["b.png"]["features"] is None and out["b.png"]["error"]
    # At the same size the resize is the identity.
    expected = (np.moveaxis(image, -1, 0) / 255.0 - np.array([0.485, 0.456, 0.406])[:, None, None]) / np.array(
        [0.229, 0.224, 0.225]
    )[:, None, None]
    assert np.allclose(out["a.png"]["features"], expected.ravel())


def test_default_decoders_need_their_packages(spark):
    df = spark.createDataFrame([("raw/a.dcm", bytearray(b"x"))], "path string, content binary")
    row = pixels.preprocess_images(df).first()
    assert row["error"] and row["pixels"] is None
