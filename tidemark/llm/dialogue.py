"""Repair of conversations by the cheapest edits, found by iterative-deepening A*.

A conversation is sound if its roles are an optional system turn and then user and assistant in turn. Turns are kept,
given another role, deleted or inserted, each at a cost. The search goes depth first in the ASCII order of the edits, under
a bound on the cost that rises by one until a path is accepted; so the first accepted path is the cheapest, and of equally
cheap ones the least as text. Its estimate of the rest counts what a turn costs by itself and pairs of neighbours that cannot
both stay as they are. States (turn, role before) that failed are remembered with the budget they failed with.

A conversation may be of any length. Turns are numbered by a radix directory and searched in chunks of a few turns: for every
state before and after a chunk, the cheapest path through it. Chunks are then joined one after the other. Of equally
cheap paths through the same turns none begins with another, so the least as text stays least whatever follows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.ranks import running_totals, tie_offsets
from tidemark.llm.store import small_or_shuffled, stored

#: Turns searched at once.
CHUNK = 16
SPACES = " \t\n\x0b\x0c\r"
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
DELETE, INSERT, REROLE, UNFINISHED = 2, 5, 1, 5

#: States are the last role: none yet (0), system (1), user (2), assistant (3). Where a turn of role s, u or a leads.
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The role that an inserted or changed turn gets, and where it leads.
GIVEN = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
ACCEPTED = (0, 3)
LEGAL = {"su", "ua", "au"}
REACHABLE = ((0, 1, 2, 3), (1, 2, 3), (2, 3), (2, 3))


def _code(initial: str, fault: str) -> tuple[str, bool, bool]:
    return initial if initial in "sua" else "", fault in "bd", fault == "t"


def _estimates(turns: list[tuple[str, bool, bool]], to_end: bool) -> tuple[list[int], list[int], list[str]]:
    """For each place: what the turns from there on cost by themselves, pairs of which one must change, and the first
    turn that may stay (if it may stay as it is)."""
    alone, pairs, first = [0], [0], ["end" if to_end else ""]
    for initial, forced, unfinished in reversed(turns):
        if forced:
            alone.append(alone[-1] + DELETE)
            pairs.append(pairs[-1])
            first.append(first[-1])
            continue
        usable = initial if initial and not unfinished else ""
        after = first[-1]
        clash = after == "end" and usable in ("s", "u") or after in ("s", "u", "a") and usable and usable + after not in LEGAL
        alone.append(alone[-1] + (min(DELETE, UNFINISHED) if unfinished else 0 if initial else REROLE))
        pairs.append(pairs[-1] + bool(clash))
        first.append(usable)
    return alone[::-1], pairs[::-1], first[::-1]


@lru_cache(maxsize=50_000)
def search(turns: str, start: int, goal: int | None) -> tuple[int, str] | None:
    """Cheapest edits from state ``start`` over all turns to state ``goal``, the last edit being that of the last turn;
    without a goal, to a sound end. Two characters a turn: role (``s``, ``u``, ``a``, other) and fault (``b``, ``d``, ``t``, none)."""
    facts = [_code(turns[k], turns[k + 1]) for k in range(0, len(turns), 2)]
    count = len(facts)
    if goal is not None and goal not in REACHABLE[start]:
        return None
    if start == 0 and goal == 1 and not any(initial == "s" and not forced for initial, forced, _ in facts):
        return None  # no edit makes a system turn
    alone, pairs, first = _estimates(facts, goal is None)
    path: list[str] = []

    def least(at: int, state: int) -> int:
        head = first[at]
        clash = head in ("s", "u", "a") and head not in STEP[state] or head == "end" and state not in ACCEPTED
        return alone[at] + (pairs[at] + clash + 1) // 2

    def descend(at: int, state: int, left: int) -> bool:
        if least(at, state) > left:
            return False
        if at == count and (state == goal or goal is None and state in ACCEPTED):
            return True
        if failed.get((at, state), -1) >= left:
            return False
        edits = []
        if at < count:
            initial, forced, unfinished = facts[at]
            more = UNFINISHED if unfinished else 0
            edits.append(("D", at + 1, state, DELETE))
        if at < count or goal is None:
            edits.append(("I", at, GIVEN[state][1], INSERT))
        if at < count and not forced:
            if initial in STEP[state]:
                edits.append(("K", at + 1, STEP[state][initial], more))
            edits.append(("R", at + 1, GIVEN[state][1], REROLE + more))
        for edit, place, reached, cost in edits:
            path.append(edit)
            if descend(place, reached, left - cost):
                return True
            path.pop()
        failed[at, state] = left
        return False

    bound = least(0, start)
    while True:
        failed: dict[tuple[int, int], int] = {}
        if descend(0, start, bound):
            return bound, "".join(path)
        bound += 1


def illegal_pairs(initials: str) -> int:
    """Neighbours whose roles may not follow each other."""
    return sum(initials[k : k + 2] not in LEGAL for k in range(len(initials) - 1))


def _apply(turns: str, state: int, edits: str) -> tuple[list[list[str]], list[str | None], int]:
    """Roles inserted before each turn, each turn's role afterwards (``=``: its own, null: deleted) and the state after."""
    before, roles, held, at = [], [], [], 0
    for edit in edits:
        if edit == "I":
            held.append(GIVEN[state][0])
            state = GIVEN[state][1]
            continue
        before.append(held)
        held = []
        if edit == "D":
            roles.append(None)
        elif edit == "K":
            roles.append("=")
            state = STEP[state][turns[2 * at]]
        else:
            roles.append(GIVEN[state][0])
            state = GIVEN[state][1]
        at += 1
    return before + [held], roles, state


_PARTS = "conv string, chunk long, turns string, costs array<int>, edits array<string>"


def _search_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each chunk the cheapest edits by state before and after (4 * before + after); a whole conversation has one entry."""
    for batch in batches:
        costs, edits = [], []
        for turns, whole in zip(batch.column("turns").to_pylist(), batch.column("whole").to_pylist()):
            found = [search(turns, 0, None)] if whole else [search(turns, k // 4, k % 4) for k in range(16)]
            costs.append([f and f[0] for f in found])
            edits.append([f and f[1] for f in found])
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("chunk"), batch.column("turns"), pa.array(costs, pa.list_(pa.int32())), pa.array(edits, pa.list_(pa.string()))],
            ["conv", "chunk", "turns", "costs", "edits"],
        )


def _join_chunks(parts: list[tuple[str, list, list]]) -> tuple[int, list[tuple[int, str]], str]:
    """Cost of the cheapest edits, for each chunk its state before and its edits, and what is inserted at the end."""
    if len(parts) == 1 and len(parts[0][1]) == 1:
        return parts[0][1][0], [(0, parts[0][2][0])], ""
    reached, trail = {0: (0, 0)}, []  # by state: cost, rank of the edits so far as text
    for _, costs, edits in parts:
        ways: dict[int, tuple] = {}
        for before, (cost, rank) in reached.items():
            for after in range(4):
                if (more := costs[4 * before + after]) is not None:
                    way = (cost + more, rank, edits[4 * before + after], before)
                    ways[after] = min(ways.get(after, way), way)
        order = {state: k for k, state in enumerate(sorted(ways, key=lambda s: ways[s][1:3]))}
        reached = {state: (way[0], order[state]) for state, way in ways.items()}
        trail.append(ways)
    ends = {0: "", 1: "II", 2: "I", 3: ""}
    cost, _, tail, state = min((cost + INSERT * len(ends[s]), rank, ends[s], s) for s, (cost, rank) in reached.items())
    chosen = []
    for ways in reversed(trail):
        _, _, edits, before = ways[state]
        chosen.append((before, edits))
        state = before
    return cost, chosen[::-1], tail


_FOLDED = "conv string, chunk long, before array<array<string>>, roles array<string>, cost long, illegal long, audit string"


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each chunk, and one without a chunk for each conversation; rows come sorted by conversation and chunk."""
    out: list[list] = [[] for _ in range(7)]

    def row(*values) -> None:
        for column, value in zip(out, values):
            column.append(value)

    def close(conv: str, parts: list[tuple[str, list, list]]) -> None:
        cost, chosen, tail = _join_chunks(parts)
        inserted: list[str] = []
        for k, ((turns, _, _), (state, edits)) in enumerate(zip(parts, chosen)):
            last = k == len(parts) - 1
            before, roles, state = _apply(turns, state, edits + (tail if last else ""))
            row(conv, k, before, roles, None, None, None)
        initials = "".join(turns[::2] for turns, _, _ in parts)
        row(conv, None, None, None, cost, illegal_pairs(initials), "".join(e for _, e in chosen) + tail)

    def flush() -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.list_(pa.list_(pa.string())), pa.list_(pa.string()), pa.int64(), pa.int64(), pa.string()]
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["conv", "chunk", "before", "roles", "cost", "illegal", "audit"])
        for column in out:
            column.clear()
        return made

    conv, parts = None, []
    for batch in batches:
        for name, turns, costs, edits in zip(*(batch.column(c).to_pylist() for c in ("conv", "turns", "costs", "edits"))):
            if name != conv and parts:
                close(conv, parts)
                parts = []
            conv = name
            parts.append((turns, costs, edits))
            if len(out[0]) >= 4096:
                yield flush()
    if parts:
        close(conv, parts)
    yield flush()


@dataclass
class Repair:
    """``summary``: a row per conversation (``conv, turns, gaps, blank, duplicate, truncated, illegal, cost, audit``). ``lines``: a
    row per turn that is left or that something is inserted before (``conv, place, inserted, role, text``; role null: only
    insertions; the last place is the end of the conversation)."""

    summary: DataFrame
    lines: DataFrame


def _numbered(rows: DataFrame) -> DataFrame:
    """Add ``pos``, a row's place in its conversation by turn (null first), then by ``tie``, then in any order."""
    counts = stored(rows.groupBy("conv", "turn").agg(F.count("*").alias("n")), "turn-counts")
    starts = stored(running_totals(counts, ["conv"], "turn", "n", "start"), "turn-starts")
    slim = rows.select("conv", "turn", "tie", "row")
    same = slim["turn"].eqNullSafe(starts["turn"]) & (slim["conv"] == starts["conv"])
    placed = slim.join(starts, same).select(slim["conv"], slim["turn"], "tie", "row", "start", "n")
    placed = stored(placed, "turn-places")
    tied = placed.where("n > 1").withColumn("at", F.coalesce("turn", F.lit(0))).withColumn("none", F.col("turn").isNull().cast("int"))
    offsets = tie_offsets(tied.select("conv", "none", "at", "tie", "row"), ["conv", "none", "at"], ["tie", "row"])
    offsets = offsets.select("row", "offset").union(placed.where("n = 1").select("row", F.lit(0).cast("long")))
    pos = placed.join(offsets, "row").select("row", (F.col("start") + F.col("offset")).alias("pos"))
    return rows.join(pos, "row")


def repair_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """Find the faults of every conversation and the cheapest edits that repair it.

    Turns are taken in the order of ``turn`` (an integer). A turn's first fault counts: blank (nothing but white space), duplicate (role
    and text occur earlier in the conversation), truncated (its last character other than white space is none of ``.!?``).
    Edits are K (keep, 0), R (other role, 1), D (delete, 2; the only one for blank and duplicate turns) and I (insert an empty
    turn, 5); a truncated turn that is not deleted costs 5 more. Roles count by their initials and must end up as
    ``(s?(ua)+)?``. A turn whose initial is none of ``s u a``, or whose role is empty, cannot stay as it is.

    Nulls and ties: null roles and texts are one space, so such a turn is blank or has an initial that cannot stay. Null conversations
    are one conversation, named null. Null turns come first. Rows of one turn are ordered by a hash of role and
    text, so equal rows are neighbours, of which all but the first are duplicates. An empty table gives empty
    results. Other columns are not read.

    Plan: rows are numbered by counts (no sort of a conversation), texts are compared by digests, searches run on
    chunks of ``CHUNK`` turns in all tasks, and a conversation's chunks, without its texts, meet in one task that holds some 20
    bytes a turn, about as much as the text of its edits.
    """
    named = F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit(""))
    rows = turns.select(
        named.alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    bare = F.btrim("text", F.lit(SPACES))
    rows = rows.withColumns(
        {
            "digest": F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256),
            "bare": F.octet_length(bare) == 0,
            "open": ~F.substring(bare, -1, 1).isin(".", "!", "?"),
            "initial": F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("-"),
        }
    )
    rows = stored(rows.withColumn("tie", F.conv(F.substring("digest", 1, 15), 16, 10).cast("long")), "turns")
    slim = stored(_numbered(rows.drop("role", "text")), "numbered-turns")

    repeated = slim.groupBy("conv", "digest").agg(F.min("pos").alias("first"), F.count("*").alias("k")).where("k > 1").drop("k")
    judged = slim.join(small_or_shuffled(stored(repeated, "repeated-turns")), ["conv", "digest"], "left")
    fault = F.when(F.col("bare"), "b").when(F.col("pos") > F.col("first"), "d").when(F.col("open"), "t").otherwise("-")
    judged = stored(judged.select("conv", "row", "turn", "pos", "initial", fault.alias("fault")), "judged-turns")
    counted = judged.groupBy("conv", "turn").agg(F.count("*").alias("n"), *[F.count_if(F.col("fault") == f).alias(f) for f in "bdt"])
    distance = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    facts = counted.groupBy("conv").agg(
        F.sum("n").alias("turns"),
        F.coalesce(distance, F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(f).cast("long").alias(name) for f, name in (("b", "blank"), ("d", "duplicate"), ("t", "truncated"))],
    )
    facts = stored(facts, "conversation-facts")

    parts = judged.groupBy("conv", F.floor(F.col("pos") / CHUNK).alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("pos", F.concat("initial", "fault").alias("t")))).alias("own"))
    parts = parts.select("conv", "chunk", F.array_join(F.transform("own", lambda t: t["t"]), "").alias("turns"))
    long = facts.where(F.col("turns") > CHUNK).select("conv", F.lit(True).alias("long"))
    parts = parts.join(small_or_shuffled(stored(long, "long-conversations")), "conv", "left")
    parts = parts.select("conv", "chunk", "turns", F.col("long").isNull().alias("whole"))
    solved = stored(parts.mapInArrow(_search_chunks, _PARTS), "searched-chunks")
    folded = stored(solved.repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(_fold, _FOLDED), "folded-chunks")

    original = F.when(F.col("conv") != "", F.expr("substring(conv, 2)")).cast(turns.schema[conv].dataType)
    ends = folded.where("chunk IS NULL").select("conv", "cost", "illegal", "audit")
    summary = facts.join(ends, "conv").select(
        original.alias("conv"), "turns", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )
    edits = folded.where("chunk IS NOT NULL").select("conv", "chunk", F.posexplode("before").alias("k", "inserted"), "roles")
    edits = edits.select("conv", (F.col("chunk") * CHUNK + F.col("k")).alias("place"), "inserted", F.try_element_at("roles", F.col("k") + 1).alias("now"), (F.col("k") < F.size("roles")).alias("real"))
    edits = stored(edits.where("now IS NOT NULL OR size(inserted) > 0"), "edits")
    kept = edits.where("now IS NOT NULL").join(judged.select("conv", F.col("pos").alias("place"), "row"), ["conv", "place"])
    texts = kept.select("conv", "place", "inserted", "now", "row").join(rows.select("row", "role", "text"), "row")
    lines = texts.select("conv", "place", "inserted", F.when(F.col("now") == "=", F.col("role")).otherwise(F.col("now")).alias("role"), "text")
    bare_edits = edits.where("now IS NULL").select("conv", "place", "inserted", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    lines = lines.union(bare_edits).select(original.alias("conv"), "place", "inserted", "role", "text")
    return Repair(summary, lines)


def _digest_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, state, convs, digests = None, None, [], []
    for batch in batches:
        for key, piece in zip(batch.column("key").to_pylist(), batch.column("piece")):
            if key != conv or state is None:
                if state is not None:
                    convs.append(conv)
                    digests.append(state.hexdigest())
                conv, state = key, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(piece.as_buffer())
    if state is not None:
        convs.append(conv)
        digests.append(state.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(convs, pa.string()), pa.array(digests, pa.string())], ["key", "digest"])


def repaired_digests(lines: DataFrame) -> DataFrame:
    """``key, digest``: SHA-256 of each conversation's lines ``role:text``, joined by newlines. ``key`` is ``=`` and the conversation
    as text, empty for null. Lines stream through the hash in order, so a long conversation takes no memory."""
    own = F.when(F.col("role").isNotNull(), F.array(F.concat("role", F.lit(":"), "text"))).otherwise(F.array().cast("array<string>"))
    piece = F.array_join(F.concat(F.transform("inserted", lambda r: F.concat(r, F.lit(":"))), own), "\n")
    key = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit(""))
    pieces = lines.select(key.alias("key"), "place", piece.alias("piece"))
    return pieces.repartition("key").sortWithinPartitions("key", "place").select("key", "piece").mapInArrow(_digest_lines, "key string, digest string")
