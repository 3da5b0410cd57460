"""Small PNG files without an image library."""

import struct
import zlib

import numpy as np


def png(image: np.ndarray) -> bytes:
    """RGB (height, width, 3) as PNG bytes."""
    height, width, _ = image.shape
    rows = b"".join(b"\0" + image[y].astype(np.uint8).tobytes() for y in range(height))

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")
