import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import jaccard, line_dedup, quality, text as t

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
TEXTS = ["", None, "A b\tc\x0bD", "ÉÉ e\u00a0f", "a", "  ", "x" * 900, "The-quick_brown 12,5 字漢 😀", "w " * 400]


@pytest.mark.parametrize(
    "alphabet,pattern", [(t.SPACED, r"[^\x20\x09-\x0D]+"), (t.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")]
)
def test_words_are_those_of_the_pattern(alphabet, pattern, monkeypatch):
    expected = [re.findall(pattern, (x or "").translate(LOWER)) for x in TEXTS]
    for limit in (1 << 20, 64):
        monkeypatch.setattr(t, "SLICE_BYTES", limit)
        hashes, counts = t.words(*t.utf8(pa.array(TEXTS)), alphabet)
        assert counts.tolist() == [len(w) for w in expected]
        seen = {}
        for word, h in zip([w for ws in expected for w in ws], hashes.tolist()):
            assert seen.setdefault(word, h) == h
        assert len(set(seen.values())) == len(seen)


def test_utf8_of_slices_and_empty_arrays():
    column = pa.array(["ab", None, "é", "xyz"]).slice(1, 3)
    data, bounds = t.utf8(column)
    assert [bytes(data[a:b]).decode() for a, b in zip(bounds, bounds[1:])] == ["", "é", "xyz"]
    assert t.words(*t.utf8(pa.array([], pa.string())), t.SPACED)[1].tolist() == []


def test_shingle_sets():
    hashes, counts = t.words(*t.utf8(pa.array(["a b c d e f", "a b", "", "a a a a a a a", "a b"])), t.SPACED)
    sets = t.shingle_sets(hashes, counts, 5)
    assert [len(s) for s in sets] == [2, 1, 0, 1, 1]
    assert sets[1].tolist() == sets[4].tolist()
    assert all((np.diff(s.astype(object)) > 0).all() for s in sets if len(s) > 1)


@pytest.fixture
def many_texts():
    """A batch of eight megabytes of text."""
    words = [f"w{k * k % 9973}" for k in range(400)]
    texts = [" ".join(words[i % 97 :] + words[: i % 89]) + "\n" for i in range(4000)]
    return pa.RecordBatch.from_arrays([pa.array(range(4000)), pa.array(texts), pa.nulls(4000, pa.list_(pa.binary()))], ["doc", "text", "_drop"])


def peak_of(work) -> float:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_a_batch_of_texts_takes_little_memory(many_texts, monkeypatch):
    assert len(t.utf8(many_texts.column(1))[0]) > 8e6
    monkeypatch.setattr(t, "_POWERS", [np.ones(1, np.uint64)] * 2)
    model = quality.Model(np.zeros(1 << quality.BITS, np.float32), True)
    assert peak_of(lambda: quality.scores(model, many_texts.column(1))) < 45
    counters = 16 * (1 << jaccard.COUNTER_BITS) / 1e6
    assert peak_of(lambda: list(jaccard._count_grams(5)(iter([many_texts.select(["text"])])))) < 45 + counters


def test_lines_leave_a_batch_in_parts(many_texts):
    kinds = pa.schema([("doc", pa.null()), ("text", pa.null()), ("n_lines", pa.null()), ("n_dropped", pa.null())])
    parts = list(line_dedup._drop(20, kinds)(iter([many_texts])))
    assert pa.Table.from_batches(parts).select(["doc", "text"]).to_pydict() == many_texts.select(["doc", "text"]).to_pydict()
    assert max(p.nbytes for p in parts) < 1e6
