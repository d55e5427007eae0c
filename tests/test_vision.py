"""Pixels: red stamps, thresholds, straightening, light and contrast."""

import colorsys

import numpy as np
import pytest

from docforge.functions import vision


def test_hues_as_the_standard_library_has_them():
    pixels = np.random.default_rng(1).integers(0, 256, (20, 20, 3), dtype=np.uint8)
    h, s, v = vision.hue_saturation_value(pixels)
    want = np.array([[colorsys.rgb_to_hsv(*(p[::-1] / 255)) for p in row] for row in pixels])
    assert np.allclose(h, want[..., 0] * 180, atol=1e-6) and np.allclose(s, want[..., 1] * 255) and np.allclose(v, want[..., 2] * 255)


def test_stamps_but_no_single_pixels_are_masked():
    page = np.full((12, 12, 3), 255, np.uint8)
    page[2:6, 3:8] = (30, 20, 200)
    page[9, 9] = (30, 20, 200)
    page[0, 0] = (200, 20, 30)
    want = np.zeros((12, 12), bool)
    want[2:6, 3:8] = True
    assert (vision.red_mask(page) == want).all()


def test_threshold_between_two_groups():
    page = np.concatenate([np.full(500, 40), np.full(300, 60), np.full(900, 210)]).astype(np.uint8)
    assert 60 <= vision.otsu(page) < 210


@pytest.mark.parametrize("angle", [-7.0, 0.0, 3.0, 10.0])
def test_a_turned_page_is_straightened(angle):
    page = np.full((300, 400), 255, np.uint8)
    page[100:200, 80:320] = 0
    found = vision.skew(vision.turned(page, -angle))
    assert found == pytest.approx(angle, abs=1.0)
    assert abs(vision.skew(vision.turned(vision.turned(page, -angle), found))) < 1.0


def test_light_and_contrast():
    light = np.tile(np.linspace(90, 250, 200), (160, 1))
    page = light.copy()
    page[60:64, 10:190] *= 0.5
    even = vision.even_light(page.astype(np.uint8)).astype(int)
    assert even[20].min() > 235 and even[62, 15:185].max() < 160
    dull = np.random.default_rng(2).integers(100, 140, (128, 128)).astype(np.uint8)
    assert np.ptp(vision.local_contrast(dull).astype(int)) > np.ptp(dull.astype(int)) and vision.local_contrast(dull[:3, :3]).shape == (3, 3)


def test_pages_are_prepared_and_fail_alone(spark):
    page = np.full((40, 30, 3), 250, np.uint8)
    page[10:14, 5:25] = 20
    rows = [(0, (40, 30, 3, page.tobytes())), (1, (5, 5, 3, b"short"))]
    df = spark.createDataFrame([(i, dict(zip(("height", "width", "nChannels", "data"), map(lambda v: bytearray(v) if isinstance(v, bytes) else v, p), strict=True))) for i, p in rows], "i int, image struct<height:int,width:int,nChannels:int,data:binary>")
    out = {r.i: r.page for r in vision.prepare_pages(df).collect()}
    assert out[0].ok and len(out[0].data) == 1200 and not out[1].ok and out[1].error.startswith("ValueError")
