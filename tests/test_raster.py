import math

import numpy as np
import pytest

from rasterloom.functions import codec, raster

RNG = np.random.default_rng(7)


def image(height, width, channels=3):
    return RNG.integers(0, 256, (height, width, channels)).astype(np.uint8)


def test_orientation_goldens():
    img = np.array([[1, 2, 3], [4, 5, 6]], np.uint8)[:, :, None]
    expected = {
        1: [[1, 2, 3], [4, 5, 6]],
        2: [[3, 2, 1], [6, 5, 4]],
        3: [[6, 5, 4], [3, 2, 1]],
        4: [[4, 5, 6], [1, 2, 3]],
        5: [[1, 4], [2, 5], [3, 6]],
        6: [[4, 1], [5, 2], [6, 3]],
        7: [[6, 3], [5, 2], [4, 1]],
        8: [[3, 6], [2, 5], [1, 4]],
        None: [[1, 2, 3], [4, 5, 6]],
        9: [[1, 2, 3], [4, 5, 6]],
    }
    for tag, rows in expected.items():
        assert raster.orient(img, tag)[:, :, 0].tolist() == rows


def test_orientation_has_inverses():
    img = image(5, 8)
    inverse = {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 8, 7: 7, 8: 6}
    for tag, back in inverse.items():
        assert (raster.orient(raster.orient(img, tag), back) == img).all()


def test_gray_and_rgb():
    img = np.array([[[255, 255, 255], [0, 0, 0], [255, 0, 0], [10, 200, 30]]], np.uint8)
    assert raster.luma(img).tolist() == [[255, 0, 76, 124]]
    gray = raster.grayscale(img)
    assert gray.shape == img.shape and (gray[..., 0] == gray[..., 2]).all()
    assert raster.to_rgb(img[:, :, :1]).shape == (1, 4, 3)
    assert (raster.to_rgb(np.dstack([img, img[:, :, 0]])) == img).all()


def lanczos(t):
    if not -3 <= t < 3:
        return 0.0
    if t == 0:
        return 1.0
    return math.sin(math.pi * t) / (math.pi * t) * math.sin(math.pi * t / 3) / (math.pi * t / 3)


def slow_line(line, n_out):
    scale = len(line) / n_out
    wide = max(scale, 1.0)
    out = []
    for o in range(n_out):
        center = (o + 0.5) * scale
        first, last = max(0, int(center - 3 * wide + 0.5)), min(len(line), int(center + 3 * wide + 0.5))
        weights = [lanczos((i - center + 0.5) / wide) for i in range(first, last)]
        total = 1 << 21
        for i, w in zip(range(first, last), weights):
            share = w / sum(weights) * (1 << 22)
            total += int(share + (0.5 if share >= 0 else -0.5)) * int(line[i])
        out.append(min(255, max(0, total >> 22)))
    return out


@pytest.mark.parametrize("size, target", [((31, 47), (16, 32)), ((17, 16), (16, 16)), ((20, 33), (48, 96))])
def test_resample_against_a_plain_loop(size, target):
    img = image(*size)
    rows = np.array([[slow_line(img[y, :, c], target[1]) for c in range(3)] for y in range(size[0])])
    wide = rows.transpose(0, 2, 1)
    want = np.array([[slow_line(wide[:, x, c], target[0]) for x in range(target[1])] for c in range(3)])
    assert (raster.resample(img, *target) == want.transpose(2, 1, 0)).all()


def test_resample_keeps_an_image_of_the_right_size_and_refuses_nothing():
    img = image(16, 32)
    assert raster.resample(img, 16, 32) is img
    with pytest.raises(ValueError, match="too_small"):
        raster.resample(img, 0, 16)


@pytest.mark.parametrize("size, target", [((31, 16), (16, 16)), ((1000, 777), (992, 768)), ((15, 40), (0, 32))])
def test_snap(size, target):
    assert (raster.snap(size[0]), raster.snap(size[1])) == target


def slow_edges(gray, low, high):
    """Edge detection pixel by pixel."""
    height, width = gray.shape

    def at(y, x):
        return int(gray[min(max(y, 0), height - 1), min(max(x, 0), width - 1)])

    dx, dy, mag = {}, {}, {}
    for y in range(height):
        for x in range(width):
            gx = sum(k * (at(y + j, x + 1) - at(y + j, x - 1)) for j, k in ((-1, 1), (0, 2), (1, 1)))
            gy = sum(k * (at(y + 1, x + j) - at(y - 1, x + j)) for j, k in ((-1, 1), (0, 2), (1, 1)))
            dx[y, x], dy[y, x], mag[y, x] = gx, gy, abs(gx) + abs(gy)
    weak, strong = set(), []
    for (y, x), m in mag.items():
        if m <= low:
            continue
        gx, gy = abs(dx[y, x]), abs(dy[y, x]) << 15
        if gy < gx * 13573:
            ridge = m > mag.get((y, x - 1), 0) and m >= mag.get((y, x + 1), 0)
        elif gy > gx * 13573 + (gx << 16):
            ridge = m > mag.get((y - 1, x), 0) and m >= mag.get((y + 1, x), 0)
        else:
            s = -1 if (dx[y, x] < 0) != (dy[y, x] < 0) else 1
            ridge = m > mag.get((y - 1, x - s), 0) and m > mag.get((y + 1, x + s), 0)
        if ridge:
            weak.add((y, x))
            if m > high:
                strong.append((y, x))
    kept = set(strong)
    while strong:
        y, x = strong.pop()
        for near in [(y + j, x + i) for j in (-1, 0, 1) for i in (-1, 0, 1)]:
            if near in weak and near not in kept:
                kept.add(near)
                strong.append(near)
    out = np.zeros(gray.shape, bool)
    for y, x in kept:
        out[y, x] = True
    return out


@pytest.mark.parametrize("size, smooth", [((24, 24), 1), ((17, 40), 3), ((40, 9), 5), ((1, 1), 1)])
def test_edges_against_a_plain_loop(size, smooth):
    img = image(*size)
    blurred = raster.nearest(img[::smooth, ::smooth], *size)
    gray = raster.luma(blurred, raster.EDGE_WEIGHTS, raster.EDGE_SHIFT)
    for low, high in ((100, 200), (20, 400), (0, 0)):
        assert (raster.edges(blurred, low, high) == slow_edges(gray, low, high)).all()


def test_edge_map_of_a_step():
    img = np.zeros((8, 8, 3), np.uint8)
    img[:, 4:] = 255
    found = raster.edge_map(img)
    assert set(np.unique(found)) == {0, 255}
    assert (found[:, :, 0].sum(axis=1) == 255).all()


def test_whiten_uses_all_channels_of_the_original():
    result = np.full((2, 2, 3), 9, np.uint8)
    original = np.array([[[246, 246, 246], [245, 250, 250]], [[255, 255, 255], [0, 0, 0]]], np.uint8)
    assert raster.whiten(result, original)[:, :, 0].tolist() == [[255, 9], [255, 9]]
    bigger = np.repeat(np.repeat(original, 3, axis=0), 3, axis=1)
    assert raster.whiten(result, bigger)[:, :, 0].tolist() == [[255, 9], [255, 9]]


def test_laplacian_energy():
    flat = np.full((4, 4, 3), 7, np.uint8)
    assert raster.laplacian_energy(flat) == 0
    flat[1, 1] = 8
    assert raster.laplacian_energy(flat) == 16 + 1 + 1


def test_bitmap_round_trip():
    img = image(5, 7)
    assert (codec.decode(codec.encode(img, "a.BMP")) == img).all()
    with pytest.raises(ValueError, match="decode_failed"):
        codec.decode_bmp(codec.encode_bmp(img)[:60])
    with pytest.raises(ValueError, match="decode_failed"):
        codec.decode_bmp(b"")
