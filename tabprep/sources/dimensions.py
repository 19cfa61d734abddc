"""Width and height of images from their headers, without decoding a pixel.

PNG, JPEG, BMP and GIF are told by their first bytes, not by their names.
"""

from __future__ import annotations

import struct
from collections.abc import Callable

#: Bytes of a file that are read first; a JPEG whose size stands later is read on from there.
HEAD = 4096

# fixed values: JPEG segments that hold a picture's size, and those without a length
_FRAMES = frozenset(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}
_BARE = frozenset({0x01, *range(0xD0, 0xD9)})


def dimensions(read: Callable[[int, int], bytes]) -> tuple[int, int] | None:
    """``(width, height)`` of the image whose bytes ``read(start, size)`` gives; None if its header is broken."""
    head = read(0, HEAD)
    try:
        if head[:8] == b"\x89PNG\r\n\x1a\n" and head[12:16] == b"IHDR":
            found = struct.unpack(">II", head[16:24])
        elif head[:2] == b"BM":
            found = _bmp(head)
        elif head[:6] in (b"GIF87a", b"GIF89a"):
            found = struct.unpack("<HH", head[6:10])
        elif head[:2] == b"\xff\xd8":
            found = _jpeg(head, read)
        else:
            return None
    except struct.error:  # the header ends too early
        return None
    return found if found and min(found) > 0 else None


def _bmp(head: bytes) -> tuple[int, int]:
    """The core header has 16-bit sizes; in the others a negative height means rows from the top."""
    if struct.unpack("<I", head[14:18])[0] == 12:
        return struct.unpack("<HH", head[18:22])
    width, height = struct.unpack("<ii", head[18:26])
    return width, abs(height)


def _jpeg(head: bytes, read: Callable[[int, int], bytes]) -> tuple[int, int] | None:
    """Walks the segments up to the frame; their contents are skipped."""
    at, start = 2, 0
    while True:
        if at + 9 > start + len(head):
            start, head = at, read(at, HEAD)
        here = at - start
        if len(head) < here + 2 or head[here] != 0xFF:
            return None
        kind = head[here + 1]
        if kind == 0xFF:  # a fill byte
            at += 1
        elif kind in _BARE:
            at += 2
        elif kind in (0xD9, 0xDA):  # the end, or pixels, before any frame
            return None
        elif kind in _FRAMES:
            height, width = struct.unpack(">HH", head[here + 5 : here + 9])
            return width, height
        else:
            length = struct.unpack(">H", head[here + 2 : here + 4])[0]
            if length < 2:
                return None
            at += 2 + length
