"""Word-aligned packing of unsigned integers: a selector and as many equally wide values as fit in 64 bits."""

from __future__ import annotations

import numpy as np

#: (values, bits of each) by selector; the selector has the upper 4 of 64 bits. Fixed values of the Simple-8b scheme.
LAYOUTS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
#: Selector of one value of more than 60 bits: the word has its place in the list of escapes.
ESCAPE = 15
BLOCK = 1024

_COUNTS = np.array([n for n, _ in LAYOUTS] + [1, 1], np.int64)
_LIMITS = np.array([1 << b for _, b in LAYOUTS], np.uint64)
_MOST = LAYOUTS[0][0]


def _largest(classes: np.ndarray) -> dict[int, np.ndarray]:
    """By window length, the largest of the following values of that many places; the ends run short."""
    found = {1: classes}

    def widen(length: int, of: int) -> None:
        x = found[of].copy()
        np.maximum(x[:, : -(length - of)], found[of][:, length - of :], out=x[:, : -(length - of)])
        found[length] = x

    for length, of in ((2, 1), (3, 2), (4, 2), (5, 4), (6, 4), (7, 4), (8, 4), (10, 8), (12, 8), (15, 8), (16, 8), (20, 16), (30, 16), (32, 16), (60, 32)):
        widen(length, of)
    return found


def _classes(values: np.ndarray) -> np.ndarray:
    """Selector with the most values a word into which each value fits; small values are looked up."""
    most = int(values.max())
    if most < 1 << 20:
        return np.searchsorted(_LIMITS, np.arange(most + 1, dtype=np.uint64), side="right").astype(np.uint8)[values]
    return np.searchsorted(_LIMITS, values, side="right").astype(np.uint8)


def pack(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, offsets, escapes): ``offsets`` has the first word of each block of ``block`` values.

    Blocks are packed side by side, so each step of the greedy choice handles all blocks at once.
    """
    n, blocks = len(values), -(-len(values) // block)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.uint64)
    flat = np.zeros(blocks * block, np.uint64)
    flat[:n] = values
    padded = np.zeros((blocks, block + _MOST), np.uint64)
    padded[:, :block] = flat.reshape(blocks, block)
    classes = _classes(padded)
    largest = _largest(classes)
    choice = np.full(classes.shape, ESCAPE, np.uint8)
    for selector in reversed(range(len(LAYOUTS))):
        choice[largest[LAYOUTS[selector][0]] <= selector] = selector

    ends = np.full(blocks, block)
    ends[-1] = n - (blocks - 1) * block
    row, at, number = np.arange(blocks), np.zeros(blocks, np.int64), np.zeros(blocks, np.int64)
    steps = []
    while len(row):
        selector = choice[row, at[row]]
        steps.append((row, at[row], number[row], selector))
        at[row] += _COUNTS[selector]
        number[row] += 1
        row = row[at[row] < ends[row]]
    offsets = np.cumsum(number) - number
    row, at, word, selector = (np.concatenate(x) for x in zip(*steps, strict=True))
    word = offsets[row] + word
    words = np.zeros(int(number.sum()), np.uint64)
    first = row * padded.shape[1] + at
    spread = padded.ravel()
    for s, (count, bits) in enumerate(LAYOUTS):
        own = np.flatnonzero(selector == s)
        if len(own):
            packed = np.full(len(own), s << 60, np.uint64)
            for j in range(count):
                packed |= spread[first[own] + j] << np.uint64(bits * j)
            words[word[own]] = packed
    own = np.flatnonzero(selector == ESCAPE)
    own = own[np.argsort(word[own])]
    words[word[own]] = (np.arange(len(own), dtype=np.uint64)) | np.uint64(ESCAPE << 60)
    return words, offsets.astype(np.uint32), spread[first[own]]


def unpack(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` values; all words of one selector are decoded together."""
    if not n:
        return np.empty(0, np.uint64)
    blocks = len(offsets)
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNTS[selector]
    before = np.cumsum(counts) - counts
    offsets = offsets.astype(np.int64)
    row = np.repeat(np.arange(blocks), np.diff(np.append(offsets, len(words))))
    first = row * (block + _MOST) + before - before[offsets][row]
    out = np.zeros(blocks * (block + _MOST), np.uint64)
    for s, (count, bits) in enumerate(LAYOUTS):
        own = np.flatnonzero(selector == s)
        if len(own):
            mask = np.uint64((1 << bits) - 1)
            for j in range(count):
                out[first[own] + j] = (words[own] >> np.uint64(bits * j)) & mask
    own = np.flatnonzero(selector == ESCAPE)
    out[first[own]] = escapes[(words[own] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out.reshape(blocks, block + _MOST)[:, :block].ravel()[:n]
