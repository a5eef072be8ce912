"""Word-aligned integer coding: every 64-bit word has a 4-bit selector and 60 bits of payload.

The selector says how many values the word holds and how wide each is. Values of more than 60 bits stand as zero and are
listed beside the words as escapes. Words are decoded for a whole block at once, selector by selector.
"""

from __future__ import annotations

import numpy as np

#: Fixed values: (values per word, bits per value) by selector. Selector 0 is a word of zeros only.
LAYOUT = (
    (240, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20),
    (2, 30), (1, 60),
)
_COUNTS = np.array([count for count, _ in LAYOUT], np.int64)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of the values (unsigned), positions of the escapes, and the escaped values."""
    values = np.ascontiguousarray(values)
    total = len(values)
    escaped, large = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if values.dtype != np.uint32:
        values = values.astype(np.uint64)
        escaped = np.flatnonzero(values >> np.uint64(60))
        large = values[escaped]
        if len(escaped):
            values = values.copy()
            values[escaped] = 0
        if total and int(values.max()) < 1 << 32:
            values = values.astype(np.uint32)
    choice = np.full(total, len(LAYOUT) - 1, np.int8)
    # from the fewest values per word to the most: positions where the next `count` values all fit
    for selector in range(len(LAYOUT) - 2, -1, -1):
        count, bits = LAYOUT[selector]
        fits = values < values.dtype.type(1 << bits) if bits < 32 or values.dtype == np.uint64 else None
        number = total if fits is None else int(np.count_nonzero(fits))
        # runs of values that fit, from whichever side has fewer positions
        if number > total // 2:
            over = np.flatnonzero(~fits) if number < total else np.zeros(0, np.int64)
            first, last = np.concatenate(([0], over + 1)), np.concatenate((over - 1, [total - 1]))
        else:
            under = np.flatnonzero(fits)
            cuts = np.flatnonzero(np.diff(under) != 1)
            first = under[np.concatenate(([0], cuts + 1))] if number else under
            last = under[np.concatenate((cuts, [number - 1]))] if number else under
        long = np.flatnonzero(last - first + 1 >= count)
        if not len(long):
            break  # narrower layouts need longer runs of smaller values
        first, after = first[long], last[long] - count + 2
        if len(long) < 64:
            for begin, end in zip(first.tolist(), after.tolist(), strict=True):
                choice[begin:end] = selector
        else:
            inside = np.zeros(total + 1, np.int8)
            inside[first] = 1
            inside[after] -= 1
            choice[np.cumsum(inside[:total], dtype=np.int8).view(bool)] = selector
    steps = _COUNTS[choice].tolist()
    starts, at = [], 0
    while at < total:
        starts.append(at)
        at += steps[at]
    starts = np.array(starts, np.int64)
    selectors = choice[starts] if total else np.zeros(0, np.int8)
    words = selectors.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(selectors):
        count, bits = LAYOUT[selector]
        if bits:
            mine = np.flatnonzero(selectors == selector)
            part = values[starts[mine][:, None] + np.arange(count)].astype(np.uint64)
            words[mine] |= np.bitwise_or.reduce(part << (np.arange(count, dtype=np.uint64) * np.uint64(bits)), axis=1)
    return words, escaped, large


def unpack(words: np.ndarray, escaped: np.ndarray, large: np.ndarray) -> np.ndarray:
    """The values, as 32-bit numbers if no word is laid out for larger ones."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    if len(selectors) and selectors.max() >= len(LAYOUT):
        raise ValueError("unknown selector")
    counts = _COUNTS[selectors]
    starts = np.cumsum(counts) - counts
    used = np.unique(selectors)
    narrow = not len(escaped) and all(LAYOUT[s][1] <= 32 for s in used)
    values = np.zeros(int(counts.sum()), np.uint32 if narrow else np.uint64)
    for selector in used:
        count, bits = LAYOUT[selector]
        if bits:
            mine = np.flatnonzero(selectors == selector)
            part, place = words[mine], starts[mine]
            for k in range(count):
                values[place + k] = (part >> np.uint64(k * bits)) & np.uint64((1 << bits) - 1)
    values[escaped] = large
    return values
