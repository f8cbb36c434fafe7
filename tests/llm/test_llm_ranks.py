from collections import defaultdict

import pytest

from tidemark.llm import ranks

EDGE = [-(1 << 63), (1 << 63) - 1, -1, 0, 1, None]


def test_running_totals_over_any_keys(spark, rng):
    rows = [(g, k, rng.randint(0, 9)) for g in "ab" for k in {rng.randrange(-(1 << 62), 1 << 62) >> rng.randrange(62) for _ in range(400)} | set(EDGE)]
    got = ranks.running_totals(spark.createDataFrame(rows, "g string, k long, w long"), ["g"], "k", "w").collect()
    place = lambda k: (k is not None, k or 0)
    assert len(got) == len(rows)
    for r in got:
        assert r["before"] == sum(w for g, k, w in rows if g == r["g"] and place(k) < place(r["k"]))


def test_running_totals_of_few_rows(spark):
    frame = lambda rows: spark.createDataFrame(rows, "g string, k long, w long")
    assert ranks.running_totals(frame([]), ["g"], "k", "w").collect() == []
    assert [r["before"] for r in ranks.running_totals(frame([("a", None, 3)]), ["g"], "k", "w").collect()] == [0]


@pytest.mark.parametrize("window_rows", [ranks.WINDOW_ROWS, 10])
def test_tie_offsets_number_every_group(spark, rng, monkeypatch, window_rows):
    monkeypatch.setattr(ranks, "WINDOW_ROWS", window_rows)
    rows = [(rng.choice("ab"), rng.randrange(5), i) for i in range(300)]
    got = ranks.tie_offsets(spark.createDataFrame(rows, "g string, t long, r long"), ["g"], ["t", "r"]).collect()
    by = defaultdict(list)
    for r in sorted(got, key=lambda r: (r["t"], r["r"])):
        by[r["g"]].append(r["offset"])
    assert all(v == list(range(len(v))) for v in by.values()) and len(got) == 300


def test_ordinals_follow_code_points(spark):
    names = ["", "a", "B", "é", "\U0001f600", "￿", "zz", "z"] + [f"n{i}" for i in range(100)]
    got = ranks.ordinals(spark.createDataFrame([(n,) for n in names], "name string"), "name").collect()
    assert [r["name"] for r in sorted(got, key=lambda r: r["ordinal"])] == sorted(names)
