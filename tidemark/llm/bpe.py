"""Byte-level BPE with a compiled lexicon: frequent words by automaton, all others by exact merges.

Words are counted over the whole corpus. The most frequent ones are encoded once and compiled into a minimal acyclic
transducer: words share prefixes and suffixes, and the outputs along a word's arcs add up to its number, which points to
its ids. The transducer is one block of bytes that every worker maps into memory and walks for many words at once.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import tempfile
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.store import stored
from tidemark.llm.text import gather, range_hashes, slices, utf8

#: Words compiled into the lexicon; bounds the transducer and what the driver holds.
LEXICON_WORDS = 50_000
#: Longest word (in bytes) that is compiled.
LEXICON_BYTES = 64
#: Words whose ids a worker remembers; when full, it forgets all and starts anew.
REMEMBERED = 600_000

#: Longest word (in bytes) that is merged together with others; longer ones are merged one by one.
TOGETHER_BYTES = 48

# The order in which bytes are given printable characters, the contractions, and letters and numbers that
# Unicode 16 has and Python's older tables may lack.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
LETTERS_16 = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NUMBERS_16 = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
)

SPACE, LETTER, NUMBER, OTHER, SPECIAL = range(5)


def character_classes() -> np.ndarray:
    """The class of every code point."""
    of = {"L": LETTER, "N": NUMBER}
    classes = np.fromiter((of.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    classes[[0x20, *range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
    for ranges, kind in ((LETTERS_16, LETTER), (NUMBERS_16, NUMBER)):
        for first, last in ranges:
            classes[first : last + 1] = kind
    return classes


def _ends(starts: np.ndarray, size: int) -> np.ndarray:
    return np.append(starts[1:], size)[: len(starts)]


class Splitter:
    """Splits texts into words as byte-level BPE does, for many texts at once.

    A word is a run of letters, of numbers or of other characters, with the one blank before it. Of white space before a
    word, all but the last character are one word, and the last is one too unless it is a blank. An apostrophe that
    stands alone takes the contraction after it. Special texts stand alone, and what is around them is split by itself.
    """

    def __init__(self, special: list[str]):
        self.classes = character_classes()
        self.special = re.compile(b"|".join(re.escape(s.encode()) for s in sorted(special, key=len, reverse=True)) or b"(?!)")

    def split(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first byte of every word, and whether it is a special text. ``bounds``: rows, from 0 to the length."""
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, bool)
        raw = data.tobytes()
        at_byte = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        n = len(points)
        kind = self.classes[points]
        apart = np.zeros(n + 1, bool)
        apart[np.searchsorted(at_byte, bounds)] = True
        for match in self.special.finditer(raw):
            first, last = match.span()
            inside = np.searchsorted(bounds, first, "right")
            if inside < len(bounds) and bounds[inside] >= last:
                i, j = np.searchsorted(at_byte, (first, last))
                apart[[i, j]] = True
                kind[i:j] = SPECIAL
        apart[n] = True
        start = np.append(True, kind[1:] != kind[:-1]) | apart[:-1]
        runs = np.flatnonzero(start)
        ends = np.append(runs[1:], n)
        word = np.append(start, True)
        more = ~apart[ends]
        end = ends[(kind[runs] == SPACE) & more]
        word[end - 1] = True
        word[end[points[end - 1] == 0x20]] = False
        lone = (kind[runs] == OTHER) & (points[runs] == 0x27) & (ends == runs + 1) & more
        which = np.flatnonzero(lone)
        which = which[word[runs[which]] & (kind[np.minimum(runs[which] + 1, n - 1)] == LETTER)]
        for k in which.tolist():
            a, stop = int(runs[k]) + 1, int(ends[k + 1])
            after = "".join(map(chr, points[a : min(a + 2, stop)]))
            for text in CONTRACTIONS:
                if after.startswith(text):
                    word[a], word[a + len(text)] = False, True
                    break
        found = np.flatnonzero(word[:n])
        return at_byte[found], kind[found] == SPECIAL


@dataclass
class Vocabulary:
    """Of a tokenizers file: the bytes of every id, the merges by pair, ids of single bytes, special texts."""

    tokens: dict[int, bytes]
    merges: dict[tuple[int, int], tuple[int, int]]
    single: list[int]
    special: dict[str, int]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            parsed = json.load(file)
        model, special = parsed["model"], {t["content"]: t["id"] for t in parsed["added_tokens"]}
        others = iter(range(0x100, 0x200))
        byte_of = {chr(b if b in set(PRINTABLE) else next(others)): b for b in range(256)}
        ids = model["vocab"]
        tokens = {i: bytes(byte_of[c] for c in text) for text, i in ids.items() if text not in special}
        tokens |= {i: text.encode() for text, i in special.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        char_of = {b: c for c, b in byte_of.items()}
        return cls(tokens, merges, [ids[char_of[b]] for b in range(256)], special)

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word: the pair of lowest rank first, the leftmost first among equals."""
        ids = [self.single[b] for b in word]
        if len(ids) < 2:
            return ids
        after, before, heap = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)], []
        for i in range(len(ids) - 1):
            if found := self.merges.get((ids[i], ids[i + 1])):
                heap.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapq.heapify(heap)
        while heap:
            _, i, left, right, joined = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = joined, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
                if found := self.merges.get((joined, ids[after[i]])):
                    heapq.heappush(heap, (found[0], i, joined, ids[after[i]], found[1]))
            if before[i] >= 0 and (found := self.merges.get((ids[before[i]], joined))):
                heapq.heappush(heap, (found[0], before[i], ids[before[i]], joined, found[1]))
        return [i for i in ids if i >= 0]


def compile_lexicon(words: list[bytes], encode) -> bytes:
    """The minimal transducer of the (distinct, not empty) words and their ids, as one block of bytes."""
    words = sorted(words)
    states: list[dict[int, int]] = [{}]
    final: list[bool] = [False]
    register: dict[tuple, int] = {}
    path = [0]

    def settle(depth: int, word: bytes) -> None:
        """Replace the states of ``word`` below ``depth`` by equal ones that exist."""
        for d in range(len(path) - 1, depth, -1):
            state = path.pop()
            key = (final[state], *states[state].items())
            known = register.setdefault(key, state)
            states[path[-1]][word[d - 1]] = known

    last = b""
    for word in words:
        common = next((i for i, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))
        settle(common, last)
        for byte in word[common:]:
            states.append({})
            final.append(False)
            states[path[-1]][byte] = len(states) - 1
            path.append(len(states) - 1)
        final[path[-1]] = True
        last = word
    settle(0, last)
    live = sorted({0, *register.values()})
    number = {state: i for i, state in enumerate(live)}
    accepted = {}
    for state in _children_first(states):
        accepted[state] = final[state] + sum(accepted[t] for t in states[state].values())
    keys, targets, outputs = [], [], []
    for state in live:
        total = int(final[state])
        for byte, target in sorted(states[state].items()):
            keys.append(number[state] * 256 + byte)
            targets.append(number[target])
            outputs.append(total)
            total += accepted[target]
    ids = [encode(word) for word in words]
    bounds = np.cumsum([0, *map(len, ids)])
    parts = [np.array(x, np.int32) for x in (keys, targets, outputs, [final[s] for s in live], bounds, list(chain.from_iterable(ids)))]
    return np.array([len(p) for p in parts], np.int32).tobytes() + b"".join(p.tobytes() for p in parts)


def _children_first(states: list[dict[int, int]]) -> Iterator[int]:
    seen, stack = set(), [(0, False)]
    while stack:
        state, done = stack.pop()
        if done:
            yield state
        elif state not in seen:
            seen.add(state)
            stack.append((state, True))
            stack += [(t, False) for t in states[state].values()]


class Lexicon:
    """A compiled transducer, mapped into memory from a file without a name."""

    def __init__(self, block: bytes):
        with tempfile.TemporaryFile() as file:
            file.write(block)
            file.flush()
            whole = np.memmap(file, np.int32, "r")
        sizes, at, parts = whole[:6], 6, []
        for n in sizes:
            parts.append(whole[at : at + n])
            at += int(n)
        self.keys, self.targets, self.outputs, self.final, self.bounds, self.ids = parts

    def find(self, words: list[bytes]) -> list[list[int] | None]:
        """The ids of each word, or None; all words take each step together."""
        data = np.frombuffer(b"".join(words), np.uint8)
        length = np.array([len(w) for w in words], np.int64)
        start = np.cumsum(length) - length
        state, number = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        alive = np.flatnonzero((length > 0) & (length <= LEXICON_BYTES))
        ended: list[np.ndarray] = []
        for step in range(LEXICON_BYTES + 1):
            at_end = length[alive] == step
            done = alive[at_end]
            ended.append(done[self.final[state[done]] == 1])
            alive = alive[~at_end]
            if not len(alive) or not len(self.keys):
                break
            wanted = state[alive] * 256 + data[start[alive] + step]
            arc = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            hit = self.keys[arc] == wanted
            alive, arc = alive[hit], arc[hit]
            number[alive] += self.outputs[arc]
            state[alive] = self.targets[arc]
        out: list[list[int] | None] = [None] * len(words)
        for i in np.concatenate(ended).tolist():
            k = number[i]
            out[i] = self.ids[self.bounds[k] : self.bounds[k + 1]].tolist()
        return out


class Encoder:
    """Encodes and decodes whole texts; remembers the ids of words it has met, by their hash."""

    def __init__(self, vocabulary: Vocabulary, block: bytes):
        self.vocabulary, self.lexicon = vocabulary, Lexicon(block)
        self.splitter = Splitter(list(vocabulary.special))
        self.single = np.array(vocabulary.single, np.int64)
        pairs = sorted((a << 32 | b, rank, new) for (a, b), (rank, new) in vocabulary.merges.items())
        self.pairs, self.ranks, self.joined = (np.array(c, np.int64) for c in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 3
        size = max(vocabulary.tokens) + 1
        self.token_length = np.array([len(vocabulary.tokens.get(i, b"")) for i in range(size)], np.int64)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.token_bytes = np.frombuffer(b"".join(vocabulary.tokens.get(i, b"") for i in range(size)), np.uint8)
        self.forget()

    def forget(self) -> None:
        self.rows: dict[int, int] = {}
        self.start, self.length, self.flat = (np.zeros(0, np.int64) for _ in range(3))

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging two ids; a rank of ``len(pairs)`` if they do not merge. -1 stands for no id."""
        if not len(self.pairs):
            return np.zeros(left.shape, np.int64), np.zeros(left.shape, np.int64)
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        hit = (self.pairs[at] == wanted) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[at], len(self.pairs)), self.joined[at]

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word, by exact merges; words of similar length are merged together, one merge of each at a time."""
        out: list = [None] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        short = [i for i in order if len(words[i]) <= TOGETHER_BYTES]
        for i in order[len(short) :]:
            out[i] = self.vocabulary.merge(words[i])
        for k in range(0, len(short), 4096):
            group = short[k : k + 4096]
            for i, ids in zip(group, self._merge([words[i] for i in group])):
                out[i] = ids
        return out

    def _merge(self, words: list[bytes]) -> list[list[int]]:
        length = np.array([len(w) for w in words], np.int64)
        width = int(length.max()) if len(words) else 0
        if width == 0:
            return [[] for _ in words]
        ids = np.full((len(words), width + 1), -1, np.int64)
        inside = np.arange(width + 1) < length[:, None]
        ids[inside] = self.single[np.frombuffer(b"".join(words), np.uint8)]
        none = len(self.pairs)
        rank, joined = self._rank(ids[:, :-1], ids[:, 1:])
        after = np.tile(np.arange(1, width + 2), (len(words), 1))
        before = np.tile(np.arange(-1, width), (len(words), 1))
        row = np.arange(len(words))
        while len(row):
            at = rank[row].argmin(axis=1)
            go = rank[row, at] < none
            row, at = row[go], at[go]
            gone = after[row, at]
            ids[row, at], ids[row, gone] = joined[row, at], -1
            next_one = after[row, gone]
            after[row, at] = next_one
            rank[row[gone < width], gone[gone < width]] = none
            has_next = next_one <= width
            before[row[has_next], next_one[has_next]] = at[has_next]
            right = np.where(has_next, ids[row, np.minimum(next_one, width)], -1)
            rank[row, at], joined[row, at] = self._rank(ids[row, at], right)
            previous = before[row, at]
            has = previous >= 0
            r, p, a = row[has], previous[has], at[has]
            rank[r, p], joined[r, p] = self._rank(ids[r, p], ids[r, a])
        return [own[own >= 0].tolist() for own in ids]

    def ids_of(self, words: list[bytes], special: list[bool]) -> list[list[int]]:
        """The ids of each word: from the lexicon, or else by exact merges."""
        found = self.lexicon.find(words)
        for i, alone in enumerate(special):
            if alone:
                found[i] = [self.vocabulary.special[words[i].decode()]]
        unseen = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(unseen, self.merge([words[i] for i in unseen])):
            found[i] = ids
        return found

    def learn(self, hashes: np.ndarray, words: list[bytes], special: list[bool]) -> None:
        ids = self.ids_of(words, special)
        length = np.array([len(x) for x in ids], np.int64)
        self.rows.update(zip(hashes.tolist(), range(len(self.start), len(self.start) + len(ids))))
        self.start = np.append(self.start, len(self.flat) + np.cumsum(length) - length)
        self.length = np.append(self.length, length)
        self.flat = np.append(self.flat, np.fromiter(chain.from_iterable(ids), np.int64, int(length.sum())))

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows, row after row, and each row's number of ids. ``bounds`` goes from 0 to the length."""
        starts, special = self.splitter.split(data, bounds)
        ends = _ends(starts, len(data))
        distinct, first, word = np.unique(range_hashes(data, starts, ends) ^ special.astype(np.uint64), return_index=True, return_inverse=True)
        if len(self.rows) > REMEMBERED:
            self.forget()
        known = np.array([self.rows.get(h, -1) for h in distinct.tolist()], np.int64)
        new = np.flatnonzero(known < 0)
        if len(new):
            raw, at = data.tobytes(), first[new]
            self.learn(distinct[new], [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())], special[at].tolist())
            known[new] = np.arange(len(self.start) - len(new), len(self.start))
        own = known[word]
        length = self.length[own]
        total = np.append(0, np.cumsum(length))
        counts = np.diff(total[np.searchsorted(starts, bounds)])
        return self.flat[gather(self.start[own], length)], counts

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids."""
        return self.token_bytes[gather(self.token_start[ids], self.token_length[ids])]

    def exactly(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, numbers of ids and decoded bytes; if two words of one hash met, the words are looked up by their bytes."""
        ids, counts = self.encode(data, bounds)
        decoded = self.decode(ids)
        if not np.array_equal(decoded, data):
            starts, special = self.splitter.split(data, bounds)
            raw, ends = data.tobytes(), _ends(starts, len(data))
            words = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
            each = self.ids_of(words, special.tolist())
            total = np.append(0, np.cumsum([len(x) for x in each]))
            ids, counts = np.array(list(chain.from_iterable(each)), np.int64), np.diff(total[np.searchsorted(starts, bounds)])
            decoded = self.decode(ids)
        return ids, counts, decoded


_OPEN: dict[str, Encoder] = {}


def _encoder(shared) -> Encoder:
    """This worker's encoder for a broadcast of (name, vocabulary, transducer)."""
    name, vocabulary, block = shared.value
    if name not in _OPEN:
        _OPEN.clear()
        _OPEN[name] = Encoder(vocabulary, block)
    return _OPEN[name]


def _counts(special: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(special)
        for batch in batches:
            data, bounds = utf8(batch.column(0))
            hashes, numbers, words = [], [], []
            for i, j in slices(bounds):
                own = data[bounds[i] : bounds[j]]
                starts, alone = splitter.split(own, bounds[i : j + 1] - bounds[i])
                ends = _ends(starts, len(own))
                starts, ends = starts[~alone], ends[~alone]
                distinct, first, n = np.unique(range_hashes(own, starts, ends), return_index=True, return_counts=True)
                length = ends[first] - starts[first]
                text = own[gather(starts[first], length)]
                hashes.append(distinct)
                numbers.append(n)
                words.append(_strings(text, np.append(0, np.cumsum(length)), pa.string()))
            if hashes:
                distinct, first, word = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
                n = np.bincount(word, np.concatenate(numbers)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(words).take(pa.array(first)), pa.array(n)], ["word", "n"])

    return run


def _strings(data: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.Array.from_buffers(kind, len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def word_counts(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """How often each word occurs in all texts: ``word, n``."""
    counted = docs.select(text_col).mapInArrow(_counts(list(vocabulary.special)), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


#: Steps of the histogram of counts for each doubling.
COUNT_STEPS = 64


def frequent_words(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", limit: int = LEXICON_WORDS) -> list[bytes]:
    """The most frequent words of the corpus, ``limit`` at most; words that occur once are not frequent.

    A histogram of the counts gives the smallest count that keeps the list within the limit, so nothing but that list and
    the histogram reaches the driver, however many partitions there are.
    """
    counts = word_counts(docs, vocabulary, text_col).where((F.col("n") > 1) & F.octet_length("word").between(1, LEXICON_BYTES))
    counts = stored(counts.withColumn("step", F.floor(COUNT_STEPS * F.log2("n"))), "word-counts")
    least, total = None, 0
    for row in sorted(counts.groupBy("step").count().collect(), reverse=True):
        total += row["count"]
        if total > limit:
            break
        least = row["step"]
    if least is None:
        return []
    return [r["word"].encode() for r in counts.where(F.col("step") >= least).select("word").toLocalIterator()]


def _encode(shared, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in batches:
            data, bounds = utf8(batch.column(len(kept)))
            for i, j in slices(bounds):
                own, rows = data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]
                ids, counts, decoded = encoder.exactly(own, rows)
                at = np.append(0, np.cumsum(counts))
                sizes = np.append(0, np.cumsum(encoder.token_length[ids]))[at]
                new = [_strings(ids.astype("<u4").view(np.uint8), at * 4, pa.binary()), pa.array(counts), _strings(decoded, sizes, pa.string())]
                columns = [batch.column(c).slice(i, j - i) for c in range(len(kept))]
                yield pa.RecordBatch.from_arrays(columns + new, [*kept, "ids", "n_tokens", "decoded"])

    return run


def encode_texts(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """Encode every whole text and decode it again: the columns in ``keep``, ``ids`` (little-endian unsigned 32-bit
    numbers, packed), ``n_tokens`` and ``decoded``.

    ``path`` is a tokenizers file of a byte-level BPE; the driver reads it. Special texts become their one id. Null and
    empty texts have no ids and decode to an empty text. Rows are encoded one by one, so repeated rows and null ids stay
    as they are; an empty table gives an empty one. ``keep`` may not name an output column.

    Plan: one pass counts words (partial counts are combined before the shuffle), one pass encodes without a shuffle.
    The broadcast holds the vocabulary and at most ``lexicon_words`` words of ``LEXICON_BYTES`` bytes.
    """
    if {"ids", "n_tokens", "decoded"} & set(keep):
        raise ValueError("keep names an output column")
    vocabulary = Vocabulary.load(path)
    block = compile_lexicon(frequent_words(docs, vocabulary, text_col, lexicon_words), vocabulary.merge)
    name = hashlib.sha256(block).hexdigest() + path
    shared = docs.sparkSession.sparkContext.broadcast((name, vocabulary, block))
    rows = docs.select(*keep, F.col(text_col).alias("_text"))
    schema = rows.drop("_text").schema.add("ids", "binary").add("n_tokens", "long").add("decoded", "string")
    return rows.mapInArrow(_encode(shared, list(keep)), schema)
