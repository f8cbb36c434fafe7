"""Vectorised work on the UTF-8 bytes of whole Arrow batches of texts.

Words are hashed to 64 bits without a Python step per word: with a prefix sum of ``value[byte] * B**position`` modulo
2**64 the hash of every run of word bytes is one subtraction. Texts are worked on half a megabyte at a time, and texts
longer than twice that are cut at separators, so memory does not depend on the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once. Arrays take some forty times that, and a worker keeps what it has once taken.
SLICE_BYTES = 1 << 19

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit words that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_VALUES = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((BASE, BASE_INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def _folded() -> np.ndarray:
    values = _VALUES.copy()
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


class Alphabet:
    """Which bytes form words. ``classes``: 0 separates, a word is a run of bytes of one other class."""

    def __init__(self, classes: np.ndarray, fold_case: bool = True):
        self.classes = classes.astype(np.uint8)
        self.values = _folded() if fold_case else _VALUES


def _space_separated() -> np.ndarray:
    classes = np.ones(256, np.uint8)
    classes[[0x20, *range(0x09, 0x0E)]] = 0
    return classes


def _letters_and_digits() -> np.ndarray:
    classes = np.zeros(256, np.uint8)
    for first, last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        classes[first : last + 1] = 1
    return classes


def _words_and_marks() -> np.ndarray:
    classes = _letters_and_digits()
    classes[(classes == 0) & (np.arange(256) > 0x20)] = 2
    return classes


#: Everything between white space, A-Z lower-cased.
SPACED = Alphabet(_space_separated())
#: Letters, digits and all characters beyond ASCII, A-Z lower-cased.
ALNUM = Alphabet(_letters_and_digits())
#: Words as above and runs of punctuation, case kept.
MARKS = Alphabet(_words_and_marks(), fold_case=False)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the n + 1 bounds of its rows; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, bounds, data = column.buffers()
    kind = np.int64 if large else np.int32
    bounds = np.frombuffer(bounds, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), bounds


def slices(bounds: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``limit`` bytes, one row at least."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def _run_hashes(data: np.ndarray, starts_of_rows: np.ndarray, alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word in ``data``; no word crosses the start of a row."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    kind = alphabet.classes[data]
    before = np.empty_like(kind)
    before[0] = 0
    before[1:] = kind[:-1]
    new = kind != before
    new[starts_of_rows[starts_of_rows < len(data)]] = True
    edges = np.flatnonzero(new)
    inside = kind[edges] > 0
    ends = np.append(edges[1:], len(data))[inside]
    starts = edges[inside]
    return range_hashes(data, starts, ends, alphabet.values), starts


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = _VALUES) -> np.ndarray:
    """Hashes of the (not empty) ranges of bytes."""
    power, inverse = _powers(len(data))
    sums = values[data]
    sums *= power
    first = sums[starts]
    np.cumsum(sums, out=sums)
    hashes = (sums[ends - 1] - sums[starts] + first) * inverse[starts]
    hashes += (ends - starts).astype(np.uint64)
    return mix(hashes)


def gather(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices of all ranges, one after the other."""
    before = np.cumsum(length) - length
    return np.arange(int(length.sum())) + np.repeat(start - before, length)


def words(data: np.ndarray, bounds: np.ndarray, alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the rows, row after row, and each row's number of words."""
    hashes, counts = [], np.zeros(len(bounds) - 1, np.int64)
    for i, j in slices(bounds):
        for lo, hi in _cuts(data, int(bounds[i]), int(bounds[j]), alphabet) if j == i + 1 else [(int(bounds[i]), int(bounds[j]))]:
            rows = bounds[i:j] - lo
            found, starts = _run_hashes(data[lo:hi], rows[rows >= 0], alphabet)
            hashes.append(found)
            if j == i + 1:
                counts[i] += len(found)
            else:
                counts[i:j] = np.diff(np.append(np.searchsorted(starts, rows), len(starts)))
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), counts


def _cuts(data: np.ndarray, lo: int, hi: int, alphabet: Alphabet) -> Iterator[tuple[int, int]]:
    """One long row in parts that end at separators."""
    while hi - lo > 2 * SLICE_BYTES:
        at = lo + SLICE_BYTES
        while at < hi:
            gap = np.flatnonzero(alphabet.classes[data[at : min(at + 4096, hi)]] == 0)
            if len(gap):
                at += int(gap[0])
                break
            at += 4096
        if at >= hi:
            break
        yield lo, at
        lo = at
    yield lo, hi


_STEPS = mix(np.arange(1001, 1033, dtype=np.uint64)) | np.uint64(1)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive words; runs over a row's end are included and left to the caller."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        total += hashes[k : len(hashes) - n + 1 + k] * _STEPS[k]
    return mix(total)


def shingle_sets(hashes: np.ndarray, counts: np.ndarray, n: int) -> list[np.ndarray]:
    """Each row's distinct n-word shingles, sorted; a row of fewer words has its whole sequence as its only one."""
    runs = grams(hashes, n)
    out, at = [], 0
    for count in counts.tolist():
        if count >= n:
            own = np.sort(runs[at : at + count - n + 1])
            if len(own) > 1:
                own = own[np.append(True, own[1:] != own[:-1])]
        elif count:
            short = (hashes[at : at + count] * _STEPS[16 : 16 + count]).sum(dtype=np.uint64) + np.uint64(count)
            own = mix(np.array([short], np.uint64))
        else:
            own = np.zeros(0, np.uint64)
        out.append(own)
        at += count
    return out


def by_row(values: list, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows for output batches of at most ``limit`` rows."""
    for i in range(0, len(values), limit):
        yield i, min(i + limit, len(values))
