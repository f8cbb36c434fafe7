import zlib
from collections import defaultdict

import pytest

from tidemark.llm import sharding
from tidemark.llm.sharding import PIECE, shard_documents


@pytest.fixture
def place(spark):
    def run(rows, shards=8, **options):
        frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard string")
        return shard_documents(frame, shards, **options).collect()

    return run


def check(rows, found, shards):
    assert len(found) == len(rows)
    slots, sizes, of_text = defaultdict(list), defaultdict(int), defaultdict(set)
    for r in found:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
        of_text[r["text_crc32"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    expected = sorted((d or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert sorted((r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in found) == expected
    return [sizes[k] for k in range(shards)], of_text


@pytest.mark.parametrize("shards", [8, 5])
def test_shards_have_near_equal_bytes(place, rng, shards):
    rows = [(i, f"{i} " + "é" * rng.randint(0, 80), rng.choice(["en", "de"]), rng.choice("abcd"), "z") for i in range(3000)]
    rows += [(5000 + i, "copies of one text", "en", "a", "z") for i in range(1500)] + [(9000 + i, f"pair {i // 2}", "en", "a", "z") for i in range(200)]
    sizes, of_text = check(rows, place(rows, shards), shards)
    assert max(sizes) <= 1.02 * sum(sizes) / shards
    total = sum(sizes)
    for i in range(100):
        text = f"pair {i}".encode()
        assert 2 * (len(text) + 1) > total / shards * PIECE or len(of_text[zlib.crc32(text)]) == 1


def test_few_rows_nulls_and_empty_tables(place):
    assert place([]) == []
    rows = [(1, None, None, None, ""), (None, None, "en", "s", ""), (3, "", "en", "s", ""), (3, "", "en", "s", ""), (4, "x" * 100000, "en", "s", "")]
    check(rows, place(rows), 8)


def place_by_model(unit, node):
    while node.cut:
        left = (unit[node.cut.dimension], unit["tie"]) <= (node.cut.value, node.cut.tie)
        node = node.left if left else node.right
    return node.first


@pytest.mark.parametrize("shards", [7, 64])
def test_tree_equals_a_model_in_memory(spark, rng, shards):
    """Every cut lies at the weighted median of the widest dimension of the units that reach the node."""
    units = [
        {"size": rng.randint(1, 50), "doc": rng.choice([1, 2, 3, rng.randint(-1000, 1000)]), "source": rng.randrange(4), "lang": 5, "tie": i * 7919, "bytes": rng.randint(1, 9)}
        for i in range(2000)
    ]
    frame = spark.createDataFrame([tuple(u.values()) for u in units], "size long, doc long, source long, lang long, tie long, bytes long").persist()
    root = sharding.kd_tree(frame, shards)
    spread = lambda own, d: max(u[d] for u in own) - min(u[d] for u in own)
    whole = {d: max(1, spread(units, d)) for d in sharding.DIMENSIONS}

    def check_node(node, own):
        if not node.cut:
            return
        widest = max(sharding.DIMENSIONS, key=lambda d: spread(own, d) / whole[d])
        assert node.cut.dimension == widest
        left = [u for u in own if (u[widest], u["tie"]) <= (node.cut.value, node.cut.tie)]
        total, goal = sum(u["bytes"] for u in own), sum(u["bytes"] for u in own) * node.left.leaves / node.leaves
        assert abs(sum(u["bytes"] for u in left) - goal) <= max(9, total * sharding.SLACK)
        check_node(node.left, left)
        check_node(node.right, [u for u in own if (u[widest], u["tie"]) > (node.cut.value, node.cut.tie)])

    check_node(root, units)
    placed = {r["tie"]: r["node"] for r in sharding.routed(frame, root).collect()}
    assert placed == {u["tie"]: place_by_model(u, root) for u in units}
    frame.unpersist()


def test_leaves_reach_target_bytes_in_many_shards(place, rng):
    rows = [(rng.randrange(-(1 << 63), 1 << 63), f"{i} " + "x" * rng.randint(0, 60), "en", rng.choice("ab"), "") for i in range(6000)]
    total = sum(len(t.encode()) + 1 for _, t, *_ in rows)
    found = place(rows, None, target_bytes=total // 1000)
    shards = 1 + max(r["shard"] for r in found)
    sizes, _ = check(rows, found, shards)
    assert shards == -(-total // (total // 1000)) >= 1000 and max(sizes) < 2.2 * total / shards
