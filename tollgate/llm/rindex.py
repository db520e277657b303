"""Run-compressed Burrows-Wheeler index of a block of strings, and its matching statistics.

The block's strings are joined with separators and their suffixes sorted. Of the transform only its runs are kept, with the
text positions (samples) of the suffixes at both ends of each run. Inside a run, neighbours in suffix order stay neighbours
one character to the left, and the match between them grows by exactly one. So the longest match of the suffix at a position
with its neighbour before is that at the next sampled run start at or before it, less the distance; likewise with its
neighbour after and the run ends. Only samples are compared character by character; a stream over the text derives the
rest. Repetitive text has few runs.
"""

from __future__ import annotations

import numpy as np

SYMBOLS_PER_KEY = 7  # nine bits each: 256 bytes and the separator


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Positions of the suffixes in order, by doubling; each round sorts only what is still equal to a neighbour."""
    n = len(text)
    padded = np.concatenate([text + 1, np.zeros(SYMBOLS_PER_KEY, dtype=text.dtype)])  # the end is below every symbol
    key = np.zeros(n, dtype=np.uint64)
    for i in range(SYMBOLS_PER_KEY):
        key = (key << np.uint64(9)) | padded[i : i + n].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.cumsum(new) - 1
    width = SYMBOLS_PER_KEY
    while not new.all():
        equal = ~new
        equal[:-1] |= ~new[1:]
        places = np.nonzero(equal)[0]
        at = order[places]
        ahead = np.where(at + width < n, rank[np.minimum(at + width, n - 1)] + 1, 0)
        group = rank[at]
        again = np.lexsort((ahead, group))
        at, ahead, group = at[again], ahead[again], group[again]
        order[places] = at
        fresh = np.concatenate([[True], (group[1:] != group[:-1]) | (ahead[1:] != ahead[:-1])])
        new[places] = fresh | new[places]
        starts = np.nonzero(new)[0]
        # a suffix's rank is the place of the first suffix equal to it
        firsts = np.zeros(n, dtype=np.int64)
        firsts[starts] = starts
        firsts = np.maximum.accumulate(firsts)
        rank[order] = firsts
        width *= 2
    return order


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the common beginnings at pairs of positions."""
    n = len(text)
    padded = np.concatenate([text, np.full(SYMBOLS_PER_KEY, 257, dtype=np.int16)])
    length = np.zeros(len(a), dtype=np.int64)
    active = np.arange(len(a))
    while len(active):
        x, y = a[active] + length[active], b[active] + length[active]
        inside = (x < n) & (y < n)
        active, x, y = active[inside], x[inside], y[inside]
        same = np.ones(len(active), dtype=bool)
        for i in range(SYMBOLS_PER_KEY):
            xi, yi = np.minimum(x + i, n), np.minimum(y + i, n)
            same &= (padded[xi] == padded[yi]) & (xi < n) & (yi < n)
            length[active[same]] += 1
        active = active[same]
    return length


class RunIndex:
    """Runs of the transform and samples at their ends; `statistics` streams over the text."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        order = suffix_order(text)
        before = text[order - 1]  # of the first position: the last symbol
        starts = np.concatenate([[True], before[1:] != before[:-1]])
        ends = np.concatenate([starts[1:], [True]])
        self.n, self.runs = n, int(starts.sum())
        # nothing stands before position 0: it is sampled, and so is its neighbour
        first = np.nonzero(order == 0)[0]
        self.samples = []
        for bounds, step in ((starts, -1), (ends, 1)):
            bounds = bounds.copy()
            bounds[first] = True
            beside = first - step
            bounds[beside[(beside >= 0) & (beside < n)]] = True
            at = np.nonzero(bounds)[0]
            near = at + step
            real = (near >= 0) & (near < n)
            lengths = np.zeros(len(at), dtype=np.int64)
            lengths[real] = common(text, order[at[real]], order[near[real]])
            self.samples.append((order[at], lengths))

    def statistics(self) -> np.ndarray:
        """At each position, the length of the longest match with another position; it may run over separators."""
        best = np.zeros(self.n, dtype=np.int64)
        for position, length in self.samples:
            reach = np.zeros(self.n, dtype=np.int64)
            at = np.sort(position)
            reach[position] = length
            sampled = np.zeros(self.n, dtype=np.int64)
            sampled[at] = at
            last = np.maximum.accumulate(sampled)
            best = np.maximum(best, reach[last] - (np.arange(self.n) - last))
        return best


def matching_statistics(strings: list[bytes]) -> list[np.ndarray]:
    """For each string, at each position, the longest match elsewhere in the block.

    A match that reaches beyond its string's end counts on into the next one; matches that a string has room for are exact.
    """
    parts = []
    for string in strings:
        parts += [np.frombuffer(string, dtype=np.uint8).astype(np.int16) + 1, np.zeros(1, dtype=np.int16)]
    text = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int16)
    found, out, at = RunIndex(text).statistics() if len(text) else text, [], 0
    for string in strings:
        out.append(found[at : at + len(string)])
        at += len(string) + 1
    return out
