"""Decoding and encoding hooks. Real codecs come from the user or from Pillow, if it is installed;
uncompressed 24-bit BMP works without either."""

from __future__ import annotations

import io
import struct

import numpy as np

JPEG_QUALITY = 95  # fixed value


def encode_bmp(img: np.ndarray) -> bytes:
    height, width = img.shape[:2]
    rows = np.zeros((height, -(-width * 3 // 4) * 4), dtype=np.uint8)
    rows[:, : width * 3] = img[::-1, :, 2::-1].reshape(height, -1)
    head = struct.pack("<2sIHHI", b"BM", 54 + rows.size, 0, 0, 54)
    info = struct.pack("<IiiHHIIiiII", 40, width, height, 1, 24, 0, rows.size, 2835, 2835, 0, 0)
    return head + info + rows.tobytes()


def decode_bmp(content: bytes) -> np.ndarray:
    if len(content) < 54 or content[:2] != b"BM":
        raise ValueError("decode_failed: not a bitmap")
    start, width, height, depth, packing = struct.unpack("<10xI4xii2xHI", content[:34])
    if depth != 24 or packing != 0 or height < 1 or width < 1:
        raise ValueError("decode_failed: only uncompressed 24-bit bitmaps")
    stride = -(-width * 3 // 4) * 4
    if len(content) < start + stride * height:
        raise ValueError("decode_failed: truncated bitmap")
    rows = np.frombuffer(content, np.uint8, stride * height, start).reshape(height, stride)
    return rows[::-1, : width * 3].reshape(height, width, 3)[:, :, ::-1]


def decode(content: bytes) -> np.ndarray:
    """Any format Pillow knows, with camera orientation undone; else bitmaps only."""
    if content[:2] == b"BM":
        return decode_bmp(content)
    try:
        from PIL import Image, ImageOps
    except ImportError:
        raise ValueError("decode_failed: no decoder for this format") from None
    with Image.open(io.BytesIO(content)) as opened:
        return np.asarray(ImageOps.exif_transpose(opened).convert("RGB"))


def encode(img: np.ndarray, name: str) -> bytes:
    """Encode by the suffix of ``name``."""
    if name.lower().endswith(".bmp"):
        return encode_bmp(img)
    try:
        from PIL import Image
    except ImportError:
        raise ValueError("encode_failed: no encoder for this format") from None
    out = io.BytesIO()
    kind = Image.registered_extensions()[name[name.rindex(".") :].lower()]
    Image.fromarray(img).save(out, kind, quality=JPEG_QUALITY)
    return out.getvalue()
