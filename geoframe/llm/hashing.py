"""Vectorised hashes of many strings at once (64 bit, wrapping arithmetic)."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
#: a random odd number and its inverse modulo 2**64
BASE = np.uint64(int(_RNG.integers(1, 1 << 62)) * 2 + 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: a random number per byte value, so that runs and small changes do not line up
BYTE = _RNG.integers(0, 1 << 63, 256, dtype="uint64") * np.uint64(2) + np.uint64(1)
_POWERS = [np.ones(1, "uint64"), np.ones(1, "uint64")]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of ``x`` over all of the result."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE ** i`` and ``INVERSE ** i`` for i below n (kept between calls)."""
    if len(_POWERS[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for k, b in enumerate((BASE, INVERSE)):
            steps = np.full(size, b, dtype="uint64")
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype="uint64")
    return _POWERS[0][:n], _POWERS[1][:n]


class Rolling:
    """Hashes of any stretches of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        up, self.down = powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, dtype="uint64")
        np.cumsum(values * up[:-1], dtype="uint64", out=self.sums[1:])

    def __call__(self, starts, ends) -> np.ndarray:
        """Equal stretches have equal hashes wherever they are."""
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])


def batches_of(values, most: int):
    """Lists of consecutive (place, bytes) of about ``most`` bytes."""
    held, size = [], 0
    for i, v in enumerate(values):
        held.append((i, v))
        size += len(v)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (what lies between ASCII white space) of all texts,
    one after the other, and the number of words up to the end of each text."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype="u1")
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    word = ~space
    edge = np.diff(np.concatenate([[False], word]).astype("i1"))
    starts, ends = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    hashes = Rolling(BYTE[data])(starts, ends)
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.searchsorted(starts, text_ends)
