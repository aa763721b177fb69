"""Words of many texts at once as hashes, without a Python object per word."""

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPREAD = np.uint64(0xD6E8FEB86659FD93)

# ASCII letters and digits and every byte of a longer character are part of a word.
_IN_WORD = np.array([chr(x).isalnum() or x >= 0x80 for x in range(256)])
_LOWER = np.array([x + 32 if 65 <= x <= 90 else x for x in range(256)], np.uint8)
# Position powers are kept for so many bytes at a time; texts are hashed together up to so many.
SPAN = 1 << 22
BATCH = 1 << 19
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _position_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _powers:
        if size > SPAN:
            return _computed(size)
        _powers[size] = _computed(size)
    return _powers[size]


def _computed(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, _ODD)
    down = np.full(size, _INVERSE)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * _SPREAD
    x = (x ^ (x >> np.uint64(29))) * _SPREAD
    return x ^ (x >> np.uint64(32))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For all words of `texts` in order: hash, number of the text, first byte and end in `b" ".join`.

    The hash is a polynomial of the word's bytes, A-Z lowered, over a running sum, modulo 2^64.
    """
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    inside = _IN_WORD[data]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    starts, ends = edges[::2], edges[1::2]
    up, down = _position_powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    hashes = mixed((total[ends] - total[starts]) * down[starts])
    text_ends = np.cumsum([len(text) + 1 for text in texts])
    return hashes, np.searchsorted(text_ends, starts, side="right"), starts, ends


def batched(texts: list[bytes], limit: int = BATCH):
    """Ranges of `texts` of at most `limit` bytes together; a longer text stands alone."""
    start = held = 0
    for at, text in enumerate(texts):
        if at > start and held + len(text) + 1 > limit:
            yield start, at
            start, held = at, 0
        held += len(text) + 1
    if start < len(texts):
        yield start, len(texts)
