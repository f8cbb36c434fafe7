"""Suffix arrays by induced sorting, in steps that each handle a whole bucket at once.

Suffixes are classed as larger or smaller than their right neighbour, the substrings between leftmost-smaller ones are
sorted by inducing from their first symbols and named, and all other suffixes are induced from the sorted leftmost-smaller
ones: bucket by bucket, each wave of suffixes places the suffixes one to the left of it.

Where names repeat, the reduced string is not sorted by a further round of induction. Its alphabet is as large as the
string is long, and a step for each symbol, which is what makes the byte alphabet fast here, would be a step for each
element. Names of neighbours are paired instead, so each round covers twice as many, until the names are distinct or cover
the depth that is asked for: a logarithmic number of sorts of the reduced string. Induction itself is one pass over the buckets.
Common prefixes are compared eight symbols at a time up to the depth, for all suffixes together, and not carried from one
to the next.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.text import range_hashes


def classify(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; ``text`` ends with a symbol smaller than all others."""
    n = len(text)
    differs = np.append(text[:-1] != text[1:], True)
    rises = np.append(text[:-1] < text[1:], True)
    at = np.where(differs, np.arange(n), n)
    return rises[np.minimum.accumulate(at[::-1])[::-1]]


def leftmost_smaller(smaller: np.ndarray) -> np.ndarray:
    """Positions of smaller suffixes whose left neighbour is larger."""
    return np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1


def _place(out: np.ndarray, free: np.ndarray, symbols: np.ndarray, values: np.ndarray, step: int) -> None:
    """Put values into the buckets of their symbols, in order, from ``free`` on upwards (1) or downwards (-1)."""
    order = np.argsort(symbols, kind="stable")
    symbols = symbols[order]
    counts = np.bincount(symbols, minlength=len(free))
    rank = np.arange(len(symbols)) - np.repeat(np.cumsum(counts) - counts, counts)
    out[free[symbols] + step * rank] = values[order]
    free += step * counts


def induce(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The order of all suffixes that follows from the order of the leftmost-smaller ones."""
    counts = np.bincount(text)
    starts = np.cumsum(counts) - counts
    larger_counts = np.bincount(text[~smaller], minlength=len(counts))
    seed_bounds = np.searchsorted(text[seeds], np.arange(len(counts) + 1))
    out = np.full(len(text), -1, np.int32)
    free = starts.copy()
    for c in np.flatnonzero(counts).tolist():
        done = starts[c]
        while True:
            wave = out[done : free[c]] if done < free[c] else None
            if wave is None:
                break
            done = free[c]
            _left(text, smaller, wave, False, out, free, 1)
        _left(text, smaller, seeds[seed_bounds[c] : seed_bounds[c + 1]], False, out, free, 1)
    free = starts + counts - 1
    for c in np.flatnonzero(counts)[::-1].tolist():
        done = starts[c] + counts[c] - 1
        while done > free[c]:
            wave = out[free[c] + 1 : done + 1][::-1]
            done = free[c]
            _left(text, smaller, wave, True, out, free, -1)
        _left(text, smaller, out[starts[c] : starts[c] + larger_counts[c]][::-1], True, out, free, -1)
    # The last symbol is a suffix that nothing induces.
    out[0] = len(text) - 1
    return out


def _left(text: np.ndarray, smaller: np.ndarray, wave: np.ndarray, kind: bool, out: np.ndarray, free: np.ndarray, step: int) -> None:
    before = wave[wave > 0] - 1
    before = before[smaller[before] == kind]
    if len(before):
        _place(out, free, text[before], before, step)


def _names(keys: np.ndarray) -> tuple[np.ndarray, int]:
    distinct, names = np.unique(keys, return_inverse=True)
    return names, len(distinct)


def sort_seeds(text: np.ndarray, smaller: np.ndarray, depth: int | None) -> np.ndarray:
    """The leftmost-smaller suffixes in order; with ``depth``, suffixes equal in so many symbols are in any order."""
    seeds = leftmost_smaller(smaller)
    if len(seeds) < 2:
        return seeds
    # Sorted by induction from seeds in any order of their first symbol: substrings come out in order.
    first = induce(text, smaller, seeds[np.argsort(text[seeds], kind="stable")])
    seed = np.zeros(len(text), bool)
    seed[seeds] = True
    ordered = first[seed[first]]
    number = np.full(len(text), -1, np.int64)
    number[seeds] = np.arange(len(seeds))
    ends = np.minimum(np.append(seeds[1:], len(text) - 1) + 1, len(text))
    content = range_hashes(text.astype(np.uint8), seeds, ends)[number[ordered]]
    names = np.zeros(len(seeds), np.int64)
    names[number[ordered]] = np.cumsum(np.append(0, content[1:] != content[:-1]))
    distinct, covered = int(names.max()) + 1, 1
    while distinct < len(names) and (depth is None or 2 * covered < depth):
        follow = np.append(names[covered:] + 1, np.zeros(min(covered, len(names)), np.int64))
        names, distinct = _names(names * (len(names) + 2) + follow)
        covered *= 2
    return seeds[np.argsort(names, kind="stable")]


def suffix_array(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Suffixes of ``text`` in order. Symbols fit in a byte; the last one is 0 and occurs only there.

    With ``depth``, suffixes that agree in their first ``depth`` symbols are next to each other in any order.
    """
    if len(text) < 2:
        return np.arange(len(text), dtype=np.int32)
    text = text.astype(np.uint8 if text.max() < 256 else np.int64)
    smaller = classify(text)
    return induce(text, smaller, sort_seeds(text, smaller, depth))


def permuted_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For every position, how many symbols its suffix shares with the one before it in order, up to ``most`` or a bit more."""
    n = len(text)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = n
    padded = np.concatenate([text.astype(np.uint8), np.zeros(most + 16, np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    packed = np.ascontiguousarray(eight).view(np.uint64)[:, 0]
    shared = np.zeros(n, np.int64)
    row = np.flatnonzero(before < n)
    while len(row):
        differ = packed[row + shared[row]] ^ packed[before[row] + shared[row]]
        low = differ & -differ
        same = np.where(differ == 0, 8, np.bitwise_count(low - np.uint64(1)) // 8)
        shared[row] += same
        row = row[(same == 8) & (shared[row] < most)]
        row = row[np.maximum(row, before[row]) + shared[row] < n]
    return shared
