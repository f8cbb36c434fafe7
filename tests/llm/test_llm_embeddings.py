import numpy as np
import pytest

from tidemark.llm import embeddings


def brute(rows):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v and len(v) == 16 and None not in v and np.isfinite(np.array(v, float)).all() and any(v)}
    ids = sorted(good)
    unit = np.array([good[i] / np.linalg.norm(good[i]) for i in ids])
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    least = np.array(ids)
    for _ in ids:
        least = np.minimum(least, np.where(linked, least[None, :], 1 << 60).min(axis=1))
    out = {i: (0, i) for i, _ in rows}
    return out | {i: (int(n), int(m)) for i, n, m in zip(ids, linked.sum(axis=1), least)}


def sample():
    draw = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in draw.standard_normal(16)]) for i in draw.permutation(300)]
    centre = draw.standard_normal(16)
    rows += [(1000 + i, (centre + draw.standard_normal(16) * 0.12).tolist()) for i in range(80)]
    rows += [(2000 + i, centre.tolist()) for i in range(50)]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 16), (3003, [None] + [1.0] * 15), (3004, [float("nan")] * 16), (3005, [float("inf")] + [1.0] * 15), (3006, [1.0, 2.0])]
    return rows


@pytest.mark.parametrize("block", [1024, 8])
def test_recall_and_no_false_links(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rows = sample()
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, n_links string")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_duplicates(frame).collect()}
    expected = brute(rows)
    assert found.keys() == expected.keys()
    assert all(found[i][0] <= expected[i][0] for i in found)
    assert sum(n for n, _ in found.values()) >= 0.97 * sum(n for n, _ in expected.values())
    assert sum(found[i][1] == expected[i][1] for i in found) >= 0.99 * len(found)


def test_null_ids_repeated_rows_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert embeddings.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    v = [1.0, 2.0, 3.0]
    rows = embeddings.near_duplicates(spark.createDataFrame([(4, v), (4, v), (2, v), (None, v)], schema)).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in rows)[1:] == [(2, 1, 2, True), (4, 1, 2, False), (4, 1, 2, False)]


def test_pairs_meet_in_one_bucket():
    draw = np.random.default_rng(1)
    masks = np.array([0, *(1 << k for k in range(embeddings.WIDTH))])
    for _ in range(300):
        a, b = draw.integers(0, 1 << 63, 2).astype(np.uint64)
        b = a ^ (b & draw.integers(0, 1 << 63, 1).astype(np.uint64)[0] & draw.integers(0, 1 << 63, 1).astype(np.uint64)[0])
        keys = [{t << embeddings.WIDTH | int(k) for t in range(embeddings.CHUNKS) for k in embeddings._chunk(np.array([x]), t) ^ masks} for x in (a, b)]
        own = int(embeddings.meeting(np.array([a]), np.array([b]))[0])
        assert own == int(embeddings.meeting(np.array([b]), np.array([a]))[0])
        assert own in keys[0] & keys[1] if keys[0] & keys[1] else own == -1


def common_direction(cosine, rows, pairs, dims=64):
    """Vectors with a mean cosine of ``cosine``; those from ``rows`` on are partners of the first, at a cosine of 0.951."""
    draw = np.random.default_rng(4)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    base = unit(np.sqrt(cosine) * unit(draw.standard_normal((1, dims))) + np.sqrt((1 - cosine) / dims) * draw.standard_normal((rows, dims)))
    way = draw.standard_normal((pairs, dims))
    way = unit(way - (way * base[:pairs]).sum(axis=1, keepdims=True) * base[:pairs])
    return np.vstack([base, 0.951 * base[:pairs] + np.sqrt(1 - 0.951**2) * way])


def test_recall_of_vectors_with_a_common_direction(spark):
    table = common_direction(0.7, 1800, 600)
    truth = (np.triu(table @ table.T, 1) >= 0.95).sum()
    found = embeddings.near_duplicates(spark.createDataFrame(list(enumerate(table.tolist())), "vec_id long, embedding array<double>")).collect()
    assert 2 * truth >= sum(r["n_links"] for r in found) >= 0.995 * 2 * truth


def test_all_pairs_are_compared_if_tables_cannot_tell_them_apart(spark):
    table = common_direction(0.93, 300, 60)
    assert embeddings.learn_rotation(table, 64).tables == 0
    truth = (np.triu(table @ table.T, 1) >= 0.95).sum()
    found = embeddings.near_duplicates(spark.createDataFrame(list(enumerate(table.tolist())), "vec_id long, embedding array<double>")).collect()
    assert sum(r["n_links"] for r in found) == 2 * truth


def test_tables_and_radius_follow_the_sample():
    even, shared = (embeddings.learn_rotation(common_direction(c, 3000, 0), 64) for c in (0.0, 0.7))
    assert embeddings.CHUNKS <= even.tables < shared.tables and even.radius < shared.radius


def test_vectors_link_within_every_length(spark):
    draw = np.random.default_rng(8)
    common, rare = draw.standard_normal((80, 16)), draw.standard_normal((20, 8))
    table = [*common.tolist(), *rare.tolist(), *rare.tolist(), *(rare * 1.5 + 0.01).tolist(), [1.0, 2.0]]
    found = embeddings.near_duplicates(spark.createDataFrame(list(enumerate(table)), "vec_id long, embedding array<double>")).collect()
    told = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found}
    assert all(told[80 + i][1] == told[100 + i][1] == told[120 + i][1] <= 80 + i and told[80 + i][0] >= 2 for i in range(20))
    assert told[140] == (0, 140)
