import hashlib
import heapq
import random

import pytest

from tidemark.llm import dialogue

SCHEMA = "conv_id long, turn long, role string, text string, pos string, row int, fault string, place int"


def brute(turns):
    """Uniform-cost search over whole edit scripts, least as text first, with every role an edit may give."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    queue, seen = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, at, last, roles = heapq.heappop(queue)
        if (at, last) in seen:
            continue
        if at == len(turns) and last in ("", "a"):
            return cost, audit, roles
        seen.add((at, last))
        for role in ("user", "assistant"):
            if (last, role[0]) in after:
                heapq.heappush(queue, (cost + 5, audit + "I", at, role[0], (*roles, (None, role))))
        if at < len(turns):
            initial, fault = turns[at]
            heapq.heappush(queue, (cost + 2, audit + "D", at + 1, last, roles))
            if fault not in "bd":
                more = 5 if fault == "t" else 0
                if (last, initial) in after:
                    heapq.heappush(queue, (cost + more, audit + "K", at + 1, initial, (*roles, (at, None))))
                for role in ("user", "assistant"):
                    if (last, role[0]) in after:
                        heapq.heappush(queue, (cost + 1 + more, audit + "R", at + 1, role[0], (*roles, (at, role))))
    raise AssertionError


def symbols(rng, n):
    return [(rng.choice("suuuaaa-"), rng.choice("----btd")) for _ in range(n)]


def test_search_equals_brute_force():
    rng = random.Random(5)
    for n in [0, 1, 2, 3, 4, 5, 6, 8, 12, 16] * 30:
        turns = symbols(rng, n)
        assert dialogue.search("".join(a + b for a, b in turns), 0, None) == brute(turns)[:2], turns


def test_chunks_join_to_the_same_edits():
    rng = random.Random(6)
    for n in [4, 7, 9, 12, 15] * 25:
        turns = symbols(rng, n)
        size = rng.choice([1, 2, 3, 5])
        pieces = [turns[i : i + size] for i in range(0, n, size)]
        parts = []
        for piece in pieces:
            text = "".join(a + b for a, b in piece)
            found = [dialogue.search(text, k // 4, k % 4) for k in range(16)]
            parts.append((text, [f and f[0] for f in found], [f and f[1] for f in found]))
        cost, chosen, tail = dialogue._join_chunks(parts)
        assert (cost, "".join(e for _, e in chosen) + tail) == brute(turns)[:2], turns


def told(rows):
    """Faults, edits and repaired lines of one conversation."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    key = lambda r: hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).hexdigest()[:15]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, key(r)))
    turns, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        fault = "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "-"
        seen.add((role, text))
        turns.append((role[:1] if role[:1] in ("s", "u", "a") else "-", fault))
    cost, audit, roles = brute(turns)
    lines = [f"{role or rows[at][1]}:{'' if at is None else rows[at][2]}" for at, role in roles]
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    faults = [f for _, f in turns]
    initials = "".join(i for i, _ in turns)
    illegal = sum(initials[k : k + 2] not in ("su", "ua", "au") for k in range(len(initials) - 1))
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest() if lines else None
    return (len(rows), gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest)


def run(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA)
    fixed = dialogue.repair_conversations(frame)
    digests = {r["key"]: r["digest"] for r in dialogue.repaired_digests(fixed.lines).collect()}
    return {r["conv"]: (*tuple(r)[1:], digests.get("" if r["conv"] is None else f"={r['conv']}")) for r in fixed.summary.collect()}


def model(rows):
    grouped = {}
    for conv, *rest in rows:
        grouped.setdefault(conv, []).append(tuple(rest))
    return {conv: told(own) for conv, own in grouped.items()}


def conversation(rng, conv, n, turns=None):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "s"]
    texts = ["Yes.", "No!", "Really?", "cut off", "", " \t", None, "Ünï. ", "line\nbreak.", "a.\x0b"]
    return [(conv, rng.choice(turns) if turns else k * rng.choice([1, 1, 1, 2]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"Turn {k}.") for k in range(n)]


def test_repair_equals_model(spark, rng):
    rows = []
    for conv in range(60):
        rows += conversation(rng, conv, rng.choice([1, 2, 3, 5, 8, 16, 17, 33]))
    rows += conversation(rng, None, 5) + conversation(rng, -4, 90)
    rng.shuffle(rows)
    assert run(spark, rows) == model(rows)


@pytest.mark.parametrize("size", [1, 4])
def test_any_chunk_size(spark, rng, monkeypatch, size):
    monkeypatch.setattr(dialogue, "CHUNK", size)
    rows = [r for conv in range(12) for r in conversation(rng, conv, 1 + conv * 2)]
    assert run(spark, rows) == model(rows)


def test_ties_null_turns_and_long_texts(spark, rng):
    turns = [None, None, 3, 3, -(1 << 60), 1 << 60]
    rows = [r for conv in range(8) for r in conversation(rng, conv, 12, turns)]
    rows += [(50, None, "user", "same.")] * 30 + [(51, 1, "user", "é " * 400_000 + "."), (51, 2, "assistant", "ok.")]
    assert run(spark, rows) == model(rows)


def test_nothing_left_and_empty_tables(spark):
    assert run(spark, []) == {}
    rows = [(1, 0, "user", ""), (1, 1, "assistant", None), (2, 5, None, "x")]
    assert run(spark, rows) == model(rows)
    assert run(spark, rows)[1][6:] == (4, "DD", None)


def test_lines_are_the_repaired_turns(spark):
    frame = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "tool", "Out.")], "conv_id long, turn long, role string, text string")
    fixed = dialogue.repair_conversations(frame)
    assert fixed.summary.first()["audit"] == "KR"
    assert [(r["inserted"], r["role"], r["text"]) for r in fixed.lines.orderBy("place").collect()] == [([], "user", "Hi."), ([], "assistant", "Out.")]
