import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, key int, target string, s int, bin string"


@pytest.fixture
def frame(spark):
    return lambda rows: spark.createDataFrame([(*r, "x", 1, "y", 2, "z") for r in rows], SCHEMA)


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def model(rows):
    sized = []
    for i, text, source in rows:
        text = text or ""
        plain = 1 - len(re.findall(r"[!-@\[-`{-~]", text)) / max(1, len(text))
        drawn = (int(md5(f"mix:{'-' if i is None else i}:{md5(text)}")[:13], 16) + 0.5) / (1 << 52)
        key = -math.log(drawn) / max(0.1, plain * plain)
        sized.append((key, (i is not None, i or 0), md5(text), len(re.findall(r"[^\x20\x09-\x0D]+", text)), i, source))
    sizes = Counter()
    for r in sized:
        sizes[r[5]] += r[3]
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    goal, capped = 1.5 * sum(sizes.values()), set()
    while True:
        left, over = goal - sum(2 * sizes[s] for s in capped), sum(weights[s] for s in names if s not in capped)
        more = {s for s in names if s not in capped and weights[s] * left / over >= 2 * sizes[s]}
        if not more:
            break
        capped |= more
    target = {s: 2.0 * sizes[s] if s in capped else weights[s] * left / over for s in names}
    out, used = [], defaultdict(int)
    for _, _, _, size, i, s in sorted(sized, key=lambda r: r[:3]):
        epochs = int(target[s] // sizes[s]) if sizes[s] else 0
        budget = math.floor(target[s] + 0.5) - epochs * sizes[s]
        out.append((i, size, sizes[s], round(target[s], 6), epochs * size + max(0, min(size, budget - used[s]))))
        used[s] += size
    return Counter(out)


def result(mixed):
    return Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in mixed.collect())


def rows_of(rng, n, sources):
    word = lambda: rng.choice(["one", "Zwei", "trés", "4,5;", "a-b"])
    return [(i, rng.choice([" ", "\n", "  "]).join(word() for _ in range(rng.choice([0, 1, 5, 40]))), rng.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("bin_rows", [mixing.BIN_ROWS, 3])
def test_mix_equals_model(frame, rng, monkeypatch, bin_rows):
    monkeypatch.setattr(mixing, "BIN_ROWS", bin_rows)
    rows = rows_of(rng, 400, ["a"] * 8 + ["B", "", None, "é", "z"]) + [(900, "only", "tiny"), (901, None, "empty"), (902, "w " * 100000, "a")]
    mixed = mixing.mix_sources(frame(rows))
    assert result(mixed) == model(rows)
    assert result(mixing.mix_sources(frame(rows[::-1]).repartition(5))) == model(rows)
    got, wanted = defaultdict(int), {}
    for r in mixed.collect():
        got[r["source"]] += r["taken"]
        wanted[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert all(abs(got[s] - wanted[s]) <= 0.5 for s in wanted)


def test_repeated_rows_and_nulls(frame, rng):
    rows = rows_of(rng, 50, ["a", "b"]) + [(7, "same words here", "a")] * 300 + [(None, "no id", "b")] * 9 + [(None, None, None)] * 3
    assert result(mixing.mix_sources(frame(rows))) == model(rows)


def test_copies_are_spread(frame, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 4)
    rows = [(1, "a b c", "s")] * 23 + [(2, "d", "s")]
    assert result(mixing.mix_sources(frame(rows))) == model(rows)


def test_small_tables(frame):
    assert mixing.mix_sources(frame([])).collect() == []
    for rows in ([(1, None, None)], [(1, "word", "s")], [(1, "", "a"), (2, " ", "b")]):
        assert result(mixing.mix_sources(frame(rows))) == model(rows)


def test_quality_moves_the_draw(frame, rng):
    rows = [(i, f"word{i} " * 10, "s" if i % 3 else "t") for i in range(3000)]
    mixed = mixing.mix_sources(frame(rows), weights=(1, 1), share=0.3, quality=F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0))
    taken = Counter()
    for r in mixed.collect():
        taken[r["doc_id"] % 2] += r["taken"]
    assert taken[0] > 1.8 * taken[1] > 0
