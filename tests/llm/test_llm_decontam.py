import re

from tidemark.llm import decontam

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, n=13):
    out = []
    for doc, text in docs:
        words, hit, found = split(text), set(), set()
        for item, own in items:
            own = split(own)
            k = min(n, len(own))
            grams = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if own and item is not None else set()
            for i in range(len(words) - k + 1):
                if tuple(words[i : i + k]) in grams:
                    hit.update(range(i, i + k))
                    found.add(item)
        out.append((doc, len(words), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def result(frame):
    rows = frame.collect()
    for r in rows:
        assert sum(b - a for a, b in r["runs"]) == r["n_hit"]
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(sorted(r["items"]))) for r in rows), key=str)


def sample(rng):
    words = ["of", "the", "é", "Sun", "moon", "a1", "red", "tree", "字"]
    line = lambda k: " ".join(rng.choice(words) + rng.choice(["", ",", "-"]) for _ in range(k))
    items = [(i, line(rng.choice([1, 4, 13, 14, 30]))) for i in range(12)] + [(50, None), (51, "--"), (None, "of the"), (53, "Sun sun SUN"), (7, line(13))]
    docs = [(i, " ".join([line(rng.randint(0, 40)), rng.choice(items)[1] or "", line(rng.randint(0, 40))])) for i in range(60)]
    return docs + [(100, None), (101, ""), (102, "!!"), (None, items[3][1]), (1, items[4][1])], items


def test_equals_brute_force(spark, docs, rng, monkeypatch):
    rows, items = sample(rng)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = brute(rows, items)
    assert result(decontam.contamination(docs(rows), benchmark)) == expected
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 400)
    blocks = decontam.phrase_blocks
    monkeypatch.setattr(decontam, "phrase_blocks", lambda *a: blocks(*a, at_once=9))
    assert result(decontam.contamination(docs(rows), benchmark)) == expected


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert result(decontam.contamination(docs([(1, "a b")]), none)) == [(1, 2, 0, ())]
    assert decontam.contamination(docs([]), none).collect() == []


def test_proximity_equals_brute_force(docs, rng):
    rows, _ = sample(rng)
    phrases = {1: "sun moon é", 2: "tree tree red", 3: "absent sun", 4: "a1"}
    for slop in (0, 2):
        found = {(r["item"], r["doc"], r["start"]) for r in decontam.proximity(decontam.build_index(docs(rows)), phrases, slop).collect()}
        expected = set()
        for doc, text in rows:
            words = split(text)
            for item, phrase in phrases.items():
                wanted, span = set(split(phrase)), len(split(phrase)) + slop
                starts = [i for i in range(len(words)) if wanted <= set(words[i : i + span])]
                expected |= {(item, doc, i) for i in starts if i - 1 not in starts}
        assert found == expected
