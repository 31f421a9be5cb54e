"""Numbers in patched frame-of-reference blocks.

An image is a header, an index of where each block starts, and the blocks. A block holds
1,024 numbers: its minimum is subtracted, the differences are packed at the width that
the chosen percentile of them needs, and those that need more are listed with their
places, to be patched in after unpacking. All integers are little-endian:

    header     4 bytes "PFR1", uint32 numbers per block, uint64 numbers, uint64 blocks
    index      uint64 start of each block after the index, and the end of the last
    block      uint32 minimum, uint16 width, uint16 exceptions,
               16 * width packed words of uint64 (sixteen lanes of 64 numbers),
               uint16 place of each exception, uint32 difference of each
"""

import struct

import numpy as np

BLOCK = 1024
LANE = 64
PERCENTILE = 90
_HEADER = struct.Struct("<4sIQQ")
_BLOCK = struct.Struct("<IHH")
_MAGIC = b"PFR1"


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 1,024 differences below 2**width as rows of 16 * width words."""
    # All first values of the lanes together, then all second ones, so that steps run over whole rows.
    places = np.ascontiguousarray(values.reshape(-1, LANE).T).astype(np.uint64)
    words = np.zeros((width, places.shape[1]), np.uint64)
    for i in range(LANE if width else 0):
        word, shift = divmod(i * width, 64)
        words[word] |= places[i] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= places[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).reshape(len(values), -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    columns = np.ascontiguousarray(words.reshape(-1, width).T)
    places = np.empty((LANE, columns.shape[1]), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for i in range(LANE):
        word, shift = divmod(i * width, 64)
        found = columns[word] >> np.uint64(shift)
        if shift + width > 64:
            found |= columns[word + 1] << np.uint64(64 - shift)
        places[i] = found & mask
    return np.ascontiguousarray(places.T).reshape(len(words), BLOCK)


def encode(numbers: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """The image of an array of uint32, of any length."""
    blocks = -(-len(numbers) // BLOCK)
    filled = np.zeros(blocks * BLOCK, np.uint32)
    filled[: len(numbers)] = numbers
    filled[len(numbers) :] = numbers[-1] if len(numbers) else 0
    rows = filled.reshape(blocks, BLOCK)
    least = rows.min(axis=1, initial=(1 << 32) - 1)
    rows = rows - least[:, None]
    at = min(BLOCK - 1, int(BLOCK * percentile / 100))
    typical = np.partition(rows, at, axis=1)[:, at]
    widths = np.ceil(np.log2(typical.astype(np.float64) + 1)).astype(np.int64)
    parts: list[bytes] = [b""] * blocks
    for width in np.unique(widths):
        chosen = np.flatnonzero(widths == width)
        limit = np.uint32((1 << int(width)) - 1)
        packed = _pack(rows[chosen] & limit, int(width))
        over = rows[chosen] > limit
        for i, block in enumerate(chosen.tolist()):
            places = np.flatnonzero(over[i])
            exceptions = places.astype("<u2").tobytes() + rows[block, places].astype("<u4").tobytes()
            parts[block] = _BLOCK.pack(int(least[block]), width, len(places)) + packed[i].tobytes() + exceptions
    index = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype("<u8")
    return b"".join([_HEADER.pack(_MAGIC, BLOCK, len(numbers), blocks), index.tobytes(), *parts])


def decode(image: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Numbers start to stop of an image as uint32; only their blocks are read."""
    magic, size, n, blocks = _HEADER.unpack_from(image)
    if magic != _MAGIC or size != BLOCK:
        raise ValueError("not an image of this format")
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.zeros(0, np.uint32)
    index = np.frombuffer(image, "<u8", blocks + 1, _HEADER.size).astype(np.int64) + _HEADER.size + 8 * (blocks + 1)
    first, last = start // BLOCK, -(-stop // BLOCK)
    heads = [_BLOCK.unpack_from(image, at) for at in index[first:last].tolist()]
    widths = np.array([w for _, w, _ in heads])
    rows = np.zeros((last - first, BLOCK), np.uint32)
    for width in np.unique(widths).tolist():
        chosen = np.flatnonzero(widths == width)
        if width:
            words = [np.frombuffer(image, "<u8", 16 * width, index[first + i] + _BLOCK.size) for i in chosen.tolist()]
            rows[chosen] = _unpack(np.stack(words), width)
    for i, (least, width, exceptions) in enumerate(heads):
        if exceptions:
            at = index[first + i] + _BLOCK.size + 128 * width
            places = np.frombuffer(image, "<u2", exceptions, at)
            rows[i, places] = np.frombuffer(image, "<u4", exceptions, at + 2 * exceptions)
        rows[i] += np.uint32(least)
    return rows.reshape(-1)[start - first * BLOCK : stop - first * BLOCK]
