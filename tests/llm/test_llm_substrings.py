import numpy as np
import pytest

from tidemark.llm import substrings
from tidemark.llm.suffix import permuted_prefixes, suffix_array


def test_suffix_arrays(rng):
    cases = [b"", b"a", b"banana", b"mississippi", b"aaaaaaa", b"abababab", b"zyx", b"abcabcabcabx" * 3]
    cases += [bytes(rng.choice(b"abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    for case in cases:
        text = np.append(np.frombuffer(case, np.uint8).astype(np.int64) + 1, 0)
        whole, order = bytes(text.astype(np.uint8)), suffix_array(text)
        assert order.tolist() == sorted(range(len(whole)), key=lambda i: whole[i:])
        near = suffix_array(text, 4)
        assert [whole[i : i + 4] for i in near] == [whole[i : i + 4] for i in order]
        shared = permuted_prefixes(text, order, 12)
        for a, b in zip(order, order[1:]):
            k = 0
            while max(a, b) + k < len(whole) and whole[a + k] == whole[b + k]:
                k += 1
            assert min(k, 12) == min(shared[b], 12)


def brute(rows, width=50):
    out, seen = {}, {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        windows = [data[i : i + width] for i in range(len(data) - width + 1)]
        gone = np.zeros(len(data) + 1, bool)
        for i, w in enumerate(windows):
            if seen.get(w, doc) < doc:
                gone[i : i + width] = True
        for w in windows:
            seen.setdefault(w, doc)
        edges = np.flatnonzero(np.diff(np.append(False, gone).astype(int)))
        out[doc] = (len(data), bytes(b for b, g in zip(data, gone) if not g), list(zip(edges[::2].tolist(), edges[1::2].tolist())))
    return out


def found(frame):
    return {r["doc_id"]: (r["n_bytes"], bytes(r["kept"]), [(s["start"], s["end"]) for s in r["spans"]]) for r in frame.collect()}


def sample(rng):
    text = "".join(rng.choice("abcdé \n") for _ in range(4000))
    rows = [(i, "".join(text[a : a + rng.randint(0, 130)] + rng.choice(["", "-", "q"]) for a in [rng.randrange(4000) for _ in range(rng.randint(0, 6))])) for i in range(120)]
    rows += [(500, "ab" * 300), (501, "ba" * 200), (502, "x" * 500), (503, "x" * 49), (504, "x" * 50), (505, None), (506, ""), (400, text), (401, text), (399, "é" * 70)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(docs, rng, monkeypatch, small):
    if small:
        monkeypatch.setattr(substrings, "SLICE_BYTES", 300)
        monkeypatch.setattr(substrings, "BATCH_BYTES", 900)
        monkeypatch.setattr(substrings, "SHARD_BYTES", 500)
    rows = sample(rng)
    assert found(substrings.dedup_substrings(docs(rows))) == brute(rows)


def test_null_ids_repeated_rows_and_empty_tables(docs):
    text = "0123456789" * 8
    out = substrings.dedup_substrings(docs([(None, text), (None, text), (7, text), (7, text), (9, text)])).collect()
    assert sorted((r["doc_id"] or 0, len(r["kept"])) for r in out) == [(0, 80), (0, 80), (7, 80), (7, 80), (9, 0)]
    assert substrings.dedup_substrings(docs([])).collect() == []


def test_pieces_cover_every_window_once(rng):
    for text in (b"x" * 2000, b"ab" * 700, bytes(rng.choice(b"abcd ") for _ in range(3000)), b"x" * 49, b"y" * 50):
        data = np.frombuffer(text, np.uint8)
        row, at, count, gram, content = substrings.pieces(data, np.array([0, len(data)]), 50, substrings.GRAM)
        places = [a + k for a, n in zip(at.tolist(), count.tolist()) for k in range(n)]
        assert places == list(range(max(0, len(text) - 49))) and (len(count) == 0 or count.max() <= substrings.MOST)
    run = substrings.pieces(np.full(500_000, 120, np.uint8), np.array([0, 500_000]), 50, substrings.GRAM)
    assert len(run[0]) == -(-499_951 // substrings.MOST)


@pytest.mark.parametrize("parts", [8, 16, 100, 1024])
def test_all_shards_are_used(rng, parts):
    """Only the upper bits of a gram reach the dealing of pieces' bytes."""
    table = np.zeros(40_000, substrings._CHECK)
    table["gram"] = np.array([rng.getrandbits(64) >> 24 << 24 for _ in range(len(table))], np.uint64)
    table["count"] = 1
    body = substrings.zstandard.ZstdCompressor().compress(b"z" * 60)
    batch = substrings.pa.RecordBatch.from_arrays(
        [substrings.pa.array([1]), substrings.pa.array([body]), substrings.pa.array([[table.tobytes()]])], ["doc", "body", "checks"]
    )
    used = {p for out in substrings._extract(50, parts)(iter([batch])) for p in out.column(0).to_pylist()}
    assert used == set(range(parts))


def test_long_runs_of_one_character(docs):
    """Five megabytes of runs that differ in length and surroundings: pieces repeat, and their bytes are shipped once."""
    rows = [(1, "a" + "x" * 1_700_000 + "b"), (2, "x" * 1_700_001), (3, "c" + "x" * 1_600_007 + "d" * 60), (4, "d" * 70 + " " * 200)]
    out = found(substrings.dedup_substrings(docs(rows)))
    assert out[1] == (1_700_002, rows[0][1].encode(), [])
    # One character longer than the run before it, but every window of it is in that run.
    assert out[2][0] == 1_700_001 and out[2][1] == b"" and out[2][2] == [(0, 1_700_001)]
    assert out[3][1] == b"c" + b"d" * 60 and out[4][1] == b" " * 200


def test_a_long_run_takes_bounded_memory(tmp_path):
    import subprocess
    import sys

    code = (
        "import numpy as np, resource\n"
        "from tidemark.llm import substrings as s\n"
        "import pyarrow as pa\n"
        "t = 'x' * 5_000_000\n"
        "batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([t, 'y' + t])], ['doc', 'text'])\n"
        "dealt = list(s._deal(50, 8)(iter([batch])))\n"
        "settled = [r for b in s._compare(50)(iter(dealt)) for r in b.to_pylist()]\n"
        "checks = {}\n"
        "for r in settled:\n"
        "    if r['checks']: checks.setdefault(r['doc'], []).append(r['checks'])\n"
        "press = s.zstandard.ZstdCompressor().compress\n"
        "rows = [(d, press({1: t, 2: 'y' + t}[d].encode()), c) for d, c in checks.items()]\n"
        "if rows:\n"
        "    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ['doc', 'body', 'checks'])\n"
        "    list(s._shard(50)(s._extract(50, 8)(iter([batch]))))\n"
        "print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)\n"
    )
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=str(__import__("pathlib").Path(__file__).parents[2]), check=True)
    assert int(done.stdout) < 1000
