import re

import numpy as np

from tidemark.llm import jaccard

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = {i: grams(x) for i, x in rows if i is not None}
    least = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return {i: (len(s), least[i]) for i, s in sets.items()}


def share(a, b):
    """A signature of both that one of them looks up."""
    asks = np.append(a[a & np.uint64(1) == 1], b[b & np.uint64(1) == 1]) >> np.uint64(1)
    return len(np.intersect1d(np.intersect1d(a >> np.uint64(1), b >> np.uint64(1)), asks)) > 0


def test_partners_share_a_signature():
    draw = np.random.default_rng(3)
    for n in [4, 5, 6, 8, 9, 10, 13, 14, 20, 31, 33, 50, 71, 72, 100, 161, 200, 400, 1000, 2500]:
        for _ in range(60 if n < 300 else 12):
            pool = draw.integers(0, 1 << 63, 2 * n).astype(np.uint64)
            base = np.unique(pool[:n])
            out = int(draw.integers(0, n // 5 + 1))
            new = int(draw.integers(0, (n - out) * 5 // 4 - n + 1)) if (n - out) * 5 // 4 >= n else 0
            other = np.unique(np.append(base[out:], pool[n : n + new]))
            both = len(np.intersect1d(base, other))
            if 100 * both < 80 * (len(base) + len(other) - both):
                continue
            if len(base) == len(other) == both:
                continue
            (a, lack_a), (b, lack_b) = jaccard.signatures(base), jaccard.signatures(other)
            assert lack_a or lack_b or share(a, b), (n, len(base), len(other), both)
            # With some n-grams counted as frequent, a set may take other segments.
            counters = np.zeros(1 << jaccard.COUNTER_BITS, np.int64)
            hot = draw.choice(np.append(base, other), max(1, n // 8))
            counters[jaccard._counter(jaccard._mixed(hot))] = 1000
            (a, lack_a), (b, lack_b) = jaccard.signatures(base, counters), jaccard.signatures(other, counters)
            assert lack_a or lack_b or share(a, b), (n, len(base), len(other), both)


def test_sketch_never_overstates_the_difference():
    draw = np.random.default_rng(4)
    for n, m in ((10, 12), (40, 35), (300, 290), (5000, 4200)):
        pool = draw.integers(0, 1 << 63, n + m).astype(np.uint64)
        a, b = np.unique(pool[:n]), np.unique(np.append(pool[: m // 2], pool[n : n + m - m // 2]))
        bits = [np.frombuffer(jaccard.sketch(x), np.uint64) for x in (a, b)]
        for width in {1, min(map(len, bits))}:
            one, two = (jaccard._folded(x, width) for x in bits)
            assert np.bitwise_count(one ^ two).sum() <= len(np.setxor1d(a, b))


def test_a_forest_joins_what_pairs_join():
    draw = np.random.default_rng(5)
    for k in (1, 2, 5, 30):
        for _ in range(20):
            label = draw.integers(0, max(1, k // 2), k)
            apart = np.full((k, k), -1)
            for a, b in draw.integers(0, k, (k, 2)).tolist():
                if label[a] != label[b]:
                    apart[a, b] = apart[b, a] = draw.integers(0, 9)

            def groups(pairs):
                own = label.copy()
                for _ in range(k):
                    for a, b in pairs:
                        low, high = sorted((own[a], own[b]))
                        own[own == high] = low
                return own.tolist()

            tree = jaccard._forest(apart, label)
            assert groups(tree) == groups(np.argwhere(apart >= 0).tolist()) and len(tree) < max(1, k)


def test_shared_counts():
    draw = np.random.default_rng(6)
    sets = [np.unique(draw.integers(0, 5000, n).astype(np.uint64)) for n in (0, 1, 40, 3000, 4000, 40)]
    got = jaccard.shared_counts(sets)
    assert all(got[i, j] == len(np.intersect1d(a, b)) for i, a in enumerate(sets) for j, b in enumerate(sets) if i != j)
    assert jaccard.shared_counts([]).shape == (0, 0)


def test_blocks_that_do_not_settle_are_compared_exactly(docs, rng, monkeypatch):
    """Many sets just below the similarity, which sketches cannot tell from those just above."""
    monkeypatch.setattr(jaccard, "HUB_ROUNDS", 0)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"w{rng.randrange(30)}" for _ in range(rng.choice([9, 12, 14, 16, 20])))) for i in range(120)]
    found = jaccard.similar_documents(docs(rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(rows)


def rows_of(rng):
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6))) for _ in range(200)]
    rows, base = [], {}
    passage = " ".join(rng.choice(words) for _ in range(25))
    for i in range(220):
        kind = rng.random()
        if kind < 0.45 and base:
            text = base[rng.choice(list(base))].split(" ")
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(words)
            text = " ".join(text[: len(text) - rng.randint(0, 4)] or text)
        else:
            text = " ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 5, 8, 12, 20, 60, 150])))
            if rng.random() < 0.4:
                text = passage + " " + text
        base[i] = text
        rows.append((i * 7 % 1000, text))
    return rows


def test_components_equal_brute_force(docs, rng):
    rows = rows_of(rng) + [(2000, None), (2001, ""), (2002, " \t"), (2003, "One two"), (2004, "one\ntwo"), (2005, "x " * 3000)]
    found = jaccard.similar_documents(docs(rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(rows)


def test_every_list_is_compared_in_blocks(docs, rng, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 2)
    rows = rows_of(rng)
    found = jaccard.similar_documents(docs(rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(rows)


def test_sets_with_too_few_segments_are_compared_with_all(spark, docs, rng):
    rows = [(i, x) for i, x in rows_of(rng)[:60]]
    frame = docs(rows).selectExpr("doc_id AS doc", "text")
    lacking = frame.select("doc").where("doc % 3 = 0")
    found = {tuple(sorted((r["u"], r["v"]))) for part in jaccard.links_of_lacking(frame, lacking, 5, 80, at_once=7) for r in part.collect() if r["u"] != r["v"]}
    sets = {i: grams(x) for i, x in rows}
    expected = {
        tuple(sorted((a, b))) for a in sets for b in sets if a % 3 == 0 and a != b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    }
    assert found == expected


def test_empty_tables_null_ids_and_repeated_rows(docs):
    assert jaccard.similar_documents(docs([])).collect() == []
    text = "a b c d e f g h"
    found = jaccard.similar_documents(docs([(5, text), (5, text), (3, text), (None, text), (None, None)])).collect()
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in found if r["doc_id"]) == [(3, 4, 3), (5, 4, 3), (5, 4, 3)]
    assert sorted((r["n_shingles"], r["component_id"]) for r in found if r["doc_id"] is None) == [(0, None), (4, None)]
