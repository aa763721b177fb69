"""Elias-Fano code of a non-decreasing sequence: about 2 + log2(top / n) bits a value."""

import struct

import numpy as np

_HEADER = struct.Struct("<QBQI")
# Every so many ones the directory notes the byte in which the next one lies.
STEP = 64
_ONES = np.array([bin(x).count("1") for x in range(256)], np.int64)
# Where the k-th one of a byte is.
_PLACE = np.array([[*(b for b in range(8) if x >> b & 1), *[0] * 8][:8] for x in range(256)], np.int64)


def encode(values: np.ndarray) -> bytes:
    """Header, low bits, high bits in unary, and a directory for `select`."""
    values = np.asarray(values, np.uint64)
    n, top = len(values), int(values[-1]) if len(values) else 0
    width = max(0, (top // n).bit_length() - 1) if n else 0
    bits = ((values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    low = np.packbits(bits.ravel(), bitorder="little")
    at = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
    unary = np.zeros(int(at[-1]) + 1 if n else 0, np.uint8)
    unary[at] = 1
    high = np.packbits(unary, bitorder="little")
    directory = (at[::STEP] // 8).astype("<u4")
    header = _HEADER.pack(n, width, len(high), len(directory))
    return header + low.tobytes() + high.tobytes() + directory.tobytes()


class Reader:
    """Answers `select(i)`, the i-th value from 0, without unpacking the sequence."""

    def __init__(self, data: bytes):
        self.n, self.width, n_high, n_directory = _HEADER.unpack_from(data)
        n_low = (self.n * self.width + 7) // 8
        raw, at = np.frombuffer(data, np.uint8), _HEADER.size
        self.low = raw[at : at + n_low]
        self.high = raw[at + n_low : at + n_low + n_high]
        start = at + n_low + n_high
        self.directory = np.frombuffer(data, "<u4", n_directory, start)
        # Ones before the byte that the directory names, for each entry.
        before = np.concatenate([[0], np.cumsum(_ONES[self.high])])
        self.before = before[self.directory]
        self.size = start + 4 * n_directory

    def select(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        entry = i // STEP
        byte, seen = int(self.directory[entry]), int(self.before[entry])
        while seen + (ones := int(_ONES[self.high[byte]])) <= i:
            byte, seen = byte + 1, seen + ones
        places = np.flatnonzero(np.unpackbits(self.high[byte : byte + 1], bitorder="little"))
        upper = byte * 8 + int(places[i - seen]) - i
        lower = 0
        for bit in range(self.width):
            place = i * self.width + bit
            lower |= (int(self.low[place >> 3]) >> (place & 7) & 1) << bit
        return (upper << self.width) | lower

    def select_many(self, numbers: np.ndarray) -> np.ndarray:
        """`select` of ascending numbers at once; only the bytes between the first and the last are read."""
        if not len(numbers):
            return np.zeros(0, np.uint64)
        if numbers[0] < 0 or numbers[-1] >= self.n:
            raise IndexError(numbers)
        entry, last = int(numbers[0]) // STEP, int(numbers[-1]) // STEP + 1
        start = int(self.directory[entry])
        stop = int(self.directory[last]) + 1 if last < len(self.directory) else len(self.high)
        window = self.high[start:stop]
        ones = np.cumsum(_ONES[window]) + int(self.before[entry])
        byte = np.searchsorted(ones, numbers, side="right")
        seen = ones[byte] - _ONES[window[byte]]
        upper = ((start + byte) * 8 + _PLACE[window[byte], numbers - seen] - numbers).astype(np.uint64)
        lower = np.zeros(len(numbers), np.uint64)
        for bit in range(self.width):
            place = numbers * self.width + bit
            lower |= (self.low[place >> 3].astype(np.uint64) >> (place & 7).astype(np.uint64) & np.uint64(1)) << np.uint64(bit)
        return (upper << np.uint64(self.width)) | lower

    def all(self) -> np.ndarray:
        """Every value, in order."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        upper = (ones - np.arange(self.n)).astype(np.uint64)
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.width]
        weights = np.uint64(1) << np.arange(self.width, dtype=np.uint64)
        lower = (bits.reshape(self.n, self.width).astype(np.uint64) * weights).sum(1, dtype=np.uint64)
        return (upper << np.uint64(self.width)) | lower
