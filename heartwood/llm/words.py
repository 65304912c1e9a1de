"""Hashes of words, taken from UTF-8 bytes a block at a time."""

from __future__ import annotations

import numpy as np

from heartwood.llm.common import SPACES, mix

#: bytes of words that are hashed in one go
TILE = 1 << 18


def byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_VALUES = byte_values()
_FACTOR = 0x5851F42D4C957F2D
_POWERS: dict[int, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd number and of its inverse, modulo 2**64."""
    have = _POWERS.get(0)
    if have is None or len(have) < n:
        size = max(n, TILE + 1)
        for slot, base in ((0, _FACTOR), (1, pow(_FACTOR, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[slot] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def spaced_words() -> np.ndarray:
    """Byte table: words are what stands between white space, A-Z lower-cased."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[list(SPACES)] = 0
    return table


def letter_words() -> np.ndarray:
    """Byte table: words are runs of ASCII letters and of bytes beyond ASCII, A-Z lower-cased."""
    table = np.zeros(256, np.uint8)
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, table: np.ndarray, prefixes: tuple[int, ...] = ()
) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the words of texts that lie on end, and the text of each word.

    ``table`` maps a byte to the one it counts as; those mapped to 0 separate words, except
    that byte 0 in a text counts as byte 1 if the table maps it to itself. For each length in
    ``prefixes`` a further array has the hashes of the words cut to so many bytes.
    """
    folded = table[data]
    if table[0] == 0 and table[1] == 1:
        folded[data == 0] = 1
    part = folded != 0
    begins = part.copy()
    begins[1:] &= ~part[:-1]
    stops = part.copy()
    stops[:-1] &= ~part[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    begins[edge] = part[edge]
    stops[edge - 1] = part[edge - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    cuts = (0, *prefixes)
    out = [np.empty(len(starts), np.uint64) for _ in cuts]
    first = 0
    while first < len(starts):
        last = int(np.searchsorted(ends, starts[first] + TILE, side="right"))
        last = max(last, first + 1)
        lo, hi = int(starts[first]), int(ends[last - 1])
        up, down = powers(hi - lo + 1)
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_VALUES[folded[lo:hi]] * up[: hi - lo], out=total[1:])
        s, e = starts[first:last] - lo, ends[first:last] - lo
        for k, cut in enumerate(cuts):
            stop = np.minimum(e, s + cut) if cut else e
            out[k][first:last] = mix((total[stop] - total[s]) * down[s] + np.uint64(cut))
        first = last
    return out, np.searchsorted(offsets, starts, side="right") - 1
