"""Word shingles of whole texts as sets of 64-bit hashes, in numpy.

Words are runs of `[^\\x20\\x09-\\x0D]` after lower-casing A-Z. A text is hashed in
slices that end at white space, so the arrays stay bounded however long it is.
"""

from __future__ import annotations

import functools

import numpy as np

SLICE_BYTES = 1 << 19
# An odd base of the polynomial hash, and the multipliers of a mixing step: arbitrary fixed constants.
BASE = 0x9E3779B97F4A7C15
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)
GAPS = b"\t\n\x0b\x0c\r "


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64."""
    values = (values ^ (values >> np.uint64(30))) * MIX_A
    values = (values ^ (values >> np.uint64(27))) * MIX_B
    return values ^ (values >> np.uint64(31))


@functools.lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    up, down = np.full(size, BASE, np.uint64), np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _is_gap() -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(GAPS, np.uint8)] = True
    return table


IS_GAP = _is_gap()


def _slices(text: bytes) -> list[bytes]:
    """Parts of bounded size that end where a word does; a longer word makes a longer part."""
    parts, start = [], 0
    while len(text) - start > SLICE_BYTES:
        end = start + SLICE_BYTES
        while end < len(text) and not IS_GAP[text[end]]:
            end += 1
        parts.append(text[start:end])
        start = end
    return [*parts, text[start:]]


def _hashed(lowered: bytes) -> np.ndarray:
    codes = np.frombuffer(lowered + b" ", np.uint8)
    gap = IS_GAP[codes]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    bounds = edge if gap[0] else np.concatenate([[0], edge])
    starts, ends = bounds[0::2], bounds[1::2]
    room = 1 << max(20, (len(codes)).bit_length())
    up, down = _powers(room)
    sums = np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)])
    before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    return mixed((sums[ends - 1] - before) * down[starts])


def word_hashes(text: bytes) -> np.ndarray:
    """The hash of every word, in order."""
    lowered = text.lower()
    if len(lowered) <= SLICE_BYTES:
        return _hashed(lowered)
    return np.concatenate([_hashed(part) for part in _slices(lowered)])


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct shingles of `width` words; fewer words make one shingle, none makes an empty set."""
    words = word_hashes(text)
    span = min(width, len(words))
    if span == 0:
        return words
    total = np.full(len(words) - span + 1, np.uint64(span))
    for offset in range(span):
        total = mixed(total) + words[offset : len(words) - span + 1 + offset]
    return np.unique(mixed(total))
