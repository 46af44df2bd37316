"""Simple-8b: values packed into 64-bit words, 4 bits of selector and 60 bits of payload.

A selector says how many equally wide values a word holds. A value of 60 bits or more is an escape: a word with selector
15, then the value as a raw word. Encoding tests all windows of a length at once and only hops from word to
word in a loop; decoding turns selectors into output offsets and unpacks all words of a selector at once.
"""

from __future__ import annotations

import numpy as np

# Fixed values: (values in a word, bits of each), by selector 0 to 13.
LAYOUT = ((1, 60), (2, 30), (3, 20), (4, 15), (5, 12), (6, 10), (7, 8), (8, 7), (10, 6), (12, 5), (15, 4), (20, 3), (30, 2), (60, 1))
ESCAPE = 15
_COUNTS = np.zeros(16, np.int64)
_COUNTS[: len(LAYOUT)] = [n for n, _ in LAYOUT]
_COUNTS[ESCAPE] = 1


def encode(values: np.ndarray) -> np.ndarray:
    """64-bit words of unsigned 64-bit values."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64)
    selector = np.full(n, ESCAPE, np.uint8)
    narrow = values.astype(np.uint32) if values.max() < 1 << 32 else values
    most, reach = narrow, 1  # the largest value of each window, and the windows' length
    for code, (count, bits) in enumerate(LAYOUT):
        if count > n:
            break
        while reach < count:
            step = min(reach, count - reach)
            most, reach = np.maximum(most[:-step], most[step:]), reach + step
        fits = most <= narrow.dtype.type(min((1 << bits) - 1, np.iinfo(narrow.dtype).max))
        if not fits.any():
            break  # then no longer window of narrower values fits either
        selector[: n - count + 1][fits] = code
    steps, at, starts = _COUNTS[selector].tolist(), 0, []
    while at < n:
        starts.append(at)
        at += steps[at]
    starts = np.array(starts, np.int64)
    chosen = selector[starts]
    places = np.cumsum(1 + (chosen == ESCAPE)) - (1 + (chosen == ESCAPE))
    words = np.zeros(len(starts) + int((chosen == ESCAPE).sum()), np.uint64)
    for code in np.unique(chosen).tolist():
        own, where = starts[chosen == code], places[chosen == code]
        if code == ESCAPE:
            words[where] = np.uint64(ESCAPE << 60)
            words[where + 1] = values[own]
            continue
        count, bits = LAYOUT[code]
        word = np.full(len(own), code << 60, np.uint64)
        for k in range(count):
            word |= values[own + k] << np.uint64(k * bits)
        words[where] = word
    return words


def decode(words: np.ndarray) -> np.ndarray:
    """The values of a run of words."""
    words = np.ascontiguousarray(words, dtype=np.uint64)
    selector = (words >> np.uint64(60)).astype(np.uint8)
    raw = np.zeros(len(words), bool)
    for at in np.flatnonzero(selector == ESCAPE).tolist():
        if not raw[at]:
            raw[at + 1] = True
    counts = np.where(raw, 0, _COUNTS[selector])
    offsets = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for code in np.unique(selector[~raw]).tolist():
        own = np.flatnonzero((selector == code) & ~raw)
        if code == ESCAPE:
            out[offsets[own]] = words[own + 1]
            continue
        count, bits = LAYOUT[code]
        mask = np.uint64((1 << bits) - 1)
        for k in range(count):
            out[offsets[own] + k] = (words[own] >> np.uint64(k * bits)) & mask
    return out
