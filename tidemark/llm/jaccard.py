"""Exact Jaccard similarity join of documents as sets of word n-grams, by partitioning the universe of n-grams.

Sets are put into bands of size. In each band, a hash deals all n-grams into segments. Two sets of sizes r and s with
Jaccard similarity of 0.8 or more differ in at most h = (r + s) / 9 n-grams, so of any h + 1 segments at least one is
equal in both (pigeonhole); a segment compared up to one deletion counts as two. Every set indexes the segments that any
partner may look at, and the one-deletion neighbourhoods of the first few. As a query, a set is free in which segments
it spends its h + 1 on, and takes those that cost least: a first pass counts all n-grams by hash in a table of fixed size,
and the rarest n-gram of a segment bounds how many sets can have it. Segments of passages that many documents share are
thereby skipped, and where too few others are left, segments of many n-grams are also looked up by their deletions.

Signatures are packed by target partition and shuffled once; each partition lists the sets that share a signature, if one
of them looks it up. Members of a list are first compared with the list's pivot only, and what those links join is one
component. In a few more rounds, members of lists that still hold several components are compared with one hub each.
Lists that then are still open are looked at across components, in blocks of bounded size. Parity sketches rule out most
pairs without error; of the others a block only asks for a forest that joins them, so what is compared is linear in its
members. If the whole forest links, the block is settled; else its members' n-grams are brought together and compared exactly.
All links are verified on the n-grams themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.components import components
from tidemark.llm.store import partitions_for, small_or_shuffled, stored
from tidemark.llm.text import SPACED, gather, mix, shingle_sets, slices, utf8, words

#: Text bytes for each partition of signatures.
PARTITION_BYTES = 16 << 20
#: Sets of one list that meet in one block.
BLOCK = 512
#: Rounds in which members of open lists are compared with one hub each.
HUB_ROUNDS = 2
#: Bits of a parity sketch: a power of two of at least eight times the set's size, within these. So many rule out nearly
#: all pairs below a similarity of 0.79.
SKETCH_BITS = (64, 1 << 19)
#: Of the n-grams of one block's members, about so many on each side.
BLOCK_GRAMS = 1 << 20
#: A task signs equal sets once, as far as it remembers this many.
REMEMBERED = 200_000
#: Counters of n-grams, as a power of two, and how many of them make one row of the table.
COUNTER_BITS = 20
COUNTER_ROW = 1 << 12


def _bands() -> np.ndarray:
    """Smallest size of each band. The next band begins at 1.5 times that, so partners are at most one band apart."""
    out = [4]
    while out[-1] < 1 << 40:
        out.append(-(-out[-1] * 3 // 2))
    return np.array(out, np.int64)


BANDS = _bands()


def band_shape(band: int) -> tuple[int, int, int, int]:
    """Largest size in the band, its segments, segments to spare, and segments indexed with deletions."""
    largest = int(BANDS[band + 1]) - 1
    spare = 3 + largest // 24
    segments = largest * 5 // 18 + 1 + spare
    deep = segments if segments <= 40 else 2 + segments // (6 if segments <= 120 else 16)
    return largest, segments, spare, deep


def _segments(mixed: np.ndarray, band: int, costs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a set: each n-gram's segment, and by segment the sum of n-grams, their number and the count of the rarest."""
    _, m, _, _ = band_shape(band)
    at = ((mixed >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
    sums, cost = np.zeros(m, np.uint64), np.full(m, np.iinfo(np.int64).max)
    np.add.at(sums, at, mixed)
    np.minimum.at(cost, at, costs)
    return at, sums, np.bincount(at, minlength=m), cost


def _mixed(grams: np.ndarray) -> np.ndarray:
    return mix(grams ^ np.uint64(0x5851F42D4C957F2D))


def _counter(mixed: np.ndarray) -> np.ndarray:
    return (mixed & np.uint64((1 << COUNTER_BITS) - 1)).astype(np.int64)


def _salt(band: int, segment: np.ndarray) -> np.ndarray:
    return mix(segment.astype(np.uint64) + np.uint64(band << 40))


def signatures(grams: np.ndarray, counters: np.ndarray | None = None) -> tuple[np.ndarray, bool]:
    """All signatures of a set, and whether they are too few to find all partners.

    The last bit tells those that the set looks up as a query from those that it is only indexed under. Sets of fewer
    than 4 have no partner but an equal one, which the comparison of whole sets finds.
    """
    n = len(grams)
    if n < 4:
        return np.zeros(0, np.uint64), False
    mixed = _mixed(grams)
    costs = np.zeros(n, np.int64) if counters is None else counters[_counter(mixed)]
    own = int(np.searchsorted(BANDS, n, "right")) - 1
    index, query, lacking = [], [], False
    for band in (own, own - 1):
        if band < 0 or band < own and 5 * int(BANDS[own]) <= 4 * n:
            continue
        largest, m, spare, deep = band_shape(band)
        at, sums, count, cost = _segments(mixed, band, costs)
        salt = _salt(band, np.arange(m))
        exact = mix(sums + salt)
        if band == own:
            # A query r <= 1.25 n looks at its first 2 r / 9 + 1 + spare segments, or fewer.
            indexed = min(m, n * 5 // 18 + 1 + spare)
            index.append(exact[np.flatnonzero(count[:indexed] > 0)])
            near = np.flatnonzero(at < deep)
            index.append(mix(sums[at[near]] - mixed[near] + salt[at[near]]))
        need = (n + min(n, largest)) // 9 + 1
        seen = min(m, need + spare)
        chosen, raised = allocate(count[:seen], cost[:seen], need, min(deep, seen))
        query.append(exact[chosen])
        near = np.flatnonzero(np.isin(at, raised))
        query.append(mix(sums[at[near]] - mixed[near] + salt[at[near]]))
        lacking |= len(chosen) + len(raised) < need
    looked, filed = (np.unique(np.concatenate(x) >> np.uint64(1)) for x in (query, index))
    filed = np.setdiff1d(filed, looked, assume_unique=True)
    return np.concatenate([looked << np.uint64(1) | np.uint64(1), filed << np.uint64(1)]), lacking


def allocate(count: np.ndarray, cost: np.ndarray, need: int, deep: int) -> tuple[np.ndarray, np.ndarray]:
    """Segments to look up, and those of them to look up by deletions too: together ``need``, at the least cost.

    Segments are taken by the count of their rarest n-gram, with counts up to twice the median taken as equal, and then
    by their number of n-grams: the more, the fewer sets have them all. The dearest of those taken, and those of one
    n-gram, are replaced by deletions of the fullest segments among the first ``deep`` while these have five n-grams or
    more. If too few segments hold anything, what is returned is less than ``need``.
    """
    full = np.flatnonzero(count > 0)
    usual = 2 * np.median(cost[full]) if len(full) else 0
    dear = np.where(cost[full] > usual, cost[full], 0)
    chosen = full[np.lexsort((-count[full], dear))[:need]]
    rich = chosen[(chosen < deep) & (count[chosen] > 1) & (cost[chosen] <= usual)]
    lacking = need - len(chosen)
    if lacking:
        rich = np.concatenate([rich, chosen[(chosen < deep) & (count[chosen] > 1) & (cost[chosen] > usual)]])
        return chosen, rich[:lacking]
    weak = (count[chosen] == 1) | (cost[chosen] > usual)
    raised = rich[count[rich] >= 5][: int(weak.sum())]
    away = np.flatnonzero(weak)[::-1][: len(raised)]
    return np.delete(chosen, away), raised


def sketch(grams: np.ndarray) -> bytes:
    """Parities of the number of n-grams by hash; a sketch of half the bits is the exclusive or of the two halves."""
    low, high = SKETCH_BITS
    bits = min(high, max(low, 1 << (8 * max(1, len(grams)) - 1).bit_length()))
    odd = np.bincount((mix(grams) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _count_grams(n: int):
    """One table of counters for each task, in rows of ``COUNTER_ROW``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTER_BITS, np.int64)
        for batch in batches:
            data, bounds = utf8(batch.column(0))
            for i, j in slices(bounds):
                for own in shingle_sets(*words(data, bounds[i : j + 1], SPACED), n):
                    np.add.at(total, _counter(_mixed(own)), 1)
        table = np.minimum(total, (1 << 32) - 1).astype("<u4").reshape(-1, COUNTER_ROW)
        full = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array([table[k].tobytes() for k in full], pa.binary())], ["row", "counts"])

    return run


def _sum_counters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: dict[int, np.ndarray] = {}
    for batch in batches:
        for row, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = rows.setdefault(row, np.zeros(COUNTER_ROW, np.int64))
            own += np.frombuffer(counts.as_py(), "<u4")
    yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int64()), pa.array([r.tobytes() for r in rows.values()], pa.binary())], ["row", "counts"])


def gram_counters(texts: DataFrame, n: int) -> np.ndarray:
    """How many documents hold the n-grams of each hash bucket: a table of fixed size, over all documents."""
    counted = texts.select("text").mapInArrow(_count_grams(n), "row long, counts binary")
    summed = counted.repartition(8, "row").mapInArrow(_sum_counters, "row long, counts binary")
    total = np.zeros((1 << COUNTER_BITS) // COUNTER_ROW * COUNTER_ROW, np.int64).reshape(-1, COUNTER_ROW)
    for row in summed.collect():
        total[row["row"]] = np.frombuffer(row["counts"], np.int64)
    return np.minimum(total.ravel(), (1 << 62) - 1)


def _profile_and_sign(parts: int, n: int, shared):
    """Rows of two kinds: part >= 0 has packed signatures for that partition, part -1 describes one document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = shared.value
        signed_before: set[tuple[int, int]] = set()

        def first(own: np.ndarray, fingerprint: tuple[int, int]) -> bool:
            """Whether the set has not been signed in this task; a copy's links are those of the equal set."""
            if not len(own) or fingerprint in signed_before:
                return False
            if len(signed_before) >= REMEMBERED:
                signed_before.clear()
            signed_before.add(fingerprint)
            return True

        for batch in batches:
            ids = batch.column(0)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            numbers = ids.fill_null(0).to_numpy(zero_copy_only=False)
            data, bounds = utf8(batch.column(1))
            for i, j in slices(bounds, 1 << 20):
                sets = shingle_sets(*words(data, bounds[i : j + 1], SPACED), n)
                size = np.array([len(s) for s in sets], np.int64)
                low = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                high = np.array([mix(s ^ np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                signed = [
                    signatures(s, counters) if k and first(s, mark) else (np.zeros(0, np.uint64), False)
                    for s, k, mark in zip(sets, known[i:j], zip(low.tolist(), high.tolist()))
                ]
                own = [s for s, _ in signed]
                count = np.array([len(s) for s in own], np.int64)
                sigs = np.concatenate(own) if own else np.zeros(0, np.uint64)
                owner = np.repeat(numbers[i:j], count)
                part = ((sigs >> np.uint64(1)) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                sigs, owner = sigs[order], owner[order]
                at = np.searchsorted(part[order], np.arange(parts + 1))
                full = np.flatnonzero(np.diff(at))
                yield _blob_batch(
                    full.tolist(),
                    [sigs[at[p] : at[p + 1]].tobytes() for p in full],
                    [owner[at[p] : at[p + 1]].tobytes() for p in full],
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(j - i, -1), pa.int64()), pa.nulls(j - i, pa.binary()), pa.nulls(j - i, pa.binary()), ids.slice(i, j - i)]
                    + [pa.array(size), pa.array(low), pa.array(high), pa.array([sketch(s) for s in sets], pa.binary()), pa.array([x for _, x in signed], pa.bool_())],
                    _NAMES,
                )

    return run


_NAMES = ["part", "sigs", "owners", "doc", "n", "low", "high", "sketch", "flag"]
_SCHEMA = "part long, sigs binary, owners binary, doc long, n long, low long, high long, sketch binary, flag boolean"


def _blob_batch(parts: list[int], sigs: list[bytes], owners: list[bytes]) -> pa.RecordBatch:
    k = len(parts)
    return pa.RecordBatch.from_arrays(
        [pa.array(parts, pa.int64()), pa.array(sigs, pa.binary()), pa.array(owners, pa.binary())] + [pa.nulls(k, pa.int64())] * 4 + [pa.nulls(k, pa.binary()), pa.nulls(k, pa.bool_())],
        _NAMES,
    )


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct lists of documents that share a signature, a row per member; documents pass through."""
    sigs, owners = [], []
    for batch in batches:
        part = batch.column(0).to_numpy()
        for k in np.flatnonzero(part >= 0).tolist():
            sigs.append(np.frombuffer(batch.column(1)[k].as_py(), np.uint64))
            owners.append(np.frombuffer(batch.column(2)[k].as_py(), np.int64))
        docs = np.flatnonzero(part < 0)
        if len(docs):
            kept = batch.take(pa.array(docs))
            none = pa.nulls(len(docs), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, *kept.columns[3:]], _LIST_NAMES)
    if not sigs:
        return
    sig, owner = np.concatenate(sigs), np.concatenate(owners)
    order = np.argsort(sig, kind="stable")
    sig, owner, asks = sig[order] >> np.uint64(1), owner[order], (sig[order] & np.uint64(1)).astype(bool)
    shared = np.zeros(len(sig), bool)
    shared[1:] = sig[1:] == sig[:-1]
    shared[:-1] |= shared[1:]
    sig, owner, asks = sig[shared], owner[shared], asks[shared]
    order = np.lexsort((~asks, owner, sig))
    sig, owner, asks = sig[order], owner[order], asks[order]
    once = np.append(True, (sig[1:] != sig[:-1]) | (owner[1:] != owner[:-1])) if len(sig) else np.zeros(0, bool)
    sig, owner, asks = sig[once], owner[once], asks[once]
    first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])) if len(sig) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(sig)))
    used = (size > 1) & np.logical_or.reduceat(asks, first) if len(first) else np.zeros(0, bool)
    first, size = first[used], size[used]
    if not len(first):
        return
    at = gather(first, size)
    members, asks = owner[at], asks[at]
    hashed = mix(members.view(np.uint64))
    starts = np.cumsum(size) - size
    name = mix(np.add.reduceat(mix(hashed + asks), starts) + size.astype(np.uint64))
    _, pick = np.unique(name, return_index=True)
    # The pivot is the query of the least hash, so lists of one group tend to have the same one.
    ranked = np.where(asks, hashed, np.uint64((1 << 64) - 1))
    low = np.minimum.reduceat(ranked, starts)
    pivots = members[np.flatnonzero(asks & (ranked == np.repeat(low, size)))]
    for k in range(0, len(pick), 20_000):
        own = pick[k : k + 20_000]
        rows = gather(starts[own], size[own])
        for a in range(0, len(rows), 500_000):
            part = slice(a, a + 500_000)
            none = pa.nulls(len(rows[part]), pa.int64())
            columns = [np.repeat(name[own].view(np.int64), size[own])[part], np.repeat(pivots[own], size[own])[part], members[rows[part]]]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, columns), none, none, none, pa.nulls(len(none), pa.binary()), pa.array(asks[rows[part]])], _LIST_NAMES
            )


_LIST_NAMES = ["list", "pivot", "doc", "n", "low", "high", "sketch", "flag"]
#: ``flag``: of a member, whether it looks the list up; of a document, whether it lacks segments.
_LIST_SCHEMA = "list long, pivot long, doc long, n long, low long, high long, sketch binary, flag boolean"


def _linked(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (a, at_a), (b, at_b) = utf8(batch.column("text_a")), utf8(batch.column("text_b"))
            ok = []
            for i, j in slices(at_a + at_b):
                left = shingle_sets(*words(a, at_a[i : j + 1], SPACED), n)
                right = shingle_sets(*words(b, at_b[i : j + 1], SPACED), n)
                for x, y in zip(left, right):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(bool(both) and 100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))

    return run


def verified(docs: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs ``u, v`` of documents (``doc, text``) that link. Only texts of documents in pairs are shuffled."""
    involved = stored(pairs.select(F.col("u").alias("doc")).union(pairs.select(F.col("v").alias("doc"))).distinct(), "involved")
    texts = docs.join(small_or_shuffled(involved), "doc")
    joined = pairs.join(texts.select(F.col("doc").alias("u"), F.col("text").alias("text_a")), "u")
    joined = joined.join(texts.select(F.col("doc").alias("v"), F.col("text").alias("text_b")), "v")
    return stored(joined.select("u", "v", "text_a", "text_b").mapInArrow(_linked(n, percent), "u long, v long").distinct(), "links")


def _links_of(queries: list[tuple[int, np.ndarray]], n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = utf8(batch.column(1))
            ids, us, vs = batch.column(0).to_pylist(), [], []
            for i, j in slices(bounds):
                for k, own in enumerate(shingle_sets(*words(data, bounds[i : j + 1], SPACED), n)):
                    for doc, query in queries:
                        both = len(np.intersect1d(own, query, assume_unique=True))
                        if both and 100 * both >= percent * (len(own) + len(query) - both):
                            us.append(doc)
                            vs.append(ids[i + k])
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    return run


def links_of_lacking(docs: DataFrame, lacking: DataFrame, n: int, percent: int, at_once: int = 100) -> list[DataFrame]:
    """Links of the few sets whose n-grams fall into too few segments: each block of them is compared with all documents."""
    found, block = [], []
    for row in docs.join(small_or_shuffled(lacking), "doc").select("doc", "text").toLocalIterator():
        block.append((row["doc"], shingle_sets(*words(*utf8(pa.array([row["text"]], pa.string())), SPACED), n)[0]))
        if len(block) == at_once:
            found.append(stored(docs.select("doc", "text").mapInArrow(_links_of(block, n, percent), "u long, v long"), "links"))
            block = []
    if block:
        found.append(stored(docs.select("doc", "text").mapInArrow(_links_of(block, n, percent), "u long, v long"), "links"))
    return found


def _candidates(members: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
    """Members' ids, and for each two of them the bits in which their sketches differ; -1 for those that need no look:
    of one component, of one side of the block, not asked for, or ruled out by size or sketch."""
    doc, label, n, asks, side = (members.field(k).to_numpy(zero_copy_only=False) for k in ("class", "label", "n", "asks", "side"))
    sketches = [np.frombuffer(x.as_py(), np.uint64) for x in members.field("sketch")]
    width = np.array([len(x) for x in sketches])
    apart = np.full((len(doc), len(doc)), -1, np.int32)
    for own in np.unique(width).tolist():
        # Sets that can link have sketches of one width or of twice that.
        place = np.flatnonzero((width == own) | (width == 2 * own))
        bits = np.stack([_folded(sketches[k], own) for k in place])
        for at, i in enumerate(place.tolist()):
            if width[i] != own:
                continue
            fits = (label[place] != label[i]) & (asks[place] | asks[i]) & ((width[place] > own) | (place < i))
            fits &= 5 * np.minimum(n[place], n[i]) >= 4 * np.maximum(n[place], n[i])
            if side.any():
                fits &= side[place] != side[i]
            other = np.flatnonzero(fits)
            differ = np.bitwise_count(bits[other] ^ bits[at]).sum(axis=1).astype(np.int32)
            near = differ <= (n[place[other]] + n[i]) // 9
            other = place[other[near]]
            apart[i, other] = apart[other, i] = differ[near]
    return doc, apart


def _forest(apart: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that join all members which candidate pairs join, the nearest first: at most one fewer than members.

    Members of one component count as joined.
    """
    out, far = [], np.iinfo(np.int32).max
    own = np.flatnonzero((apart >= 0).any(axis=1))
    apart, label = apart[np.ix_(own, own)], label[own]
    weight = np.where(apart < 0, far, apart)
    outside = np.ones(len(label), bool)
    reach, by = np.full(len(label), far, np.int32), np.zeros(len(label), np.int64)
    while outside.any():
        at = int(np.argmin(np.where(outside, reach, far)))
        if not outside[at]:
            at = int(np.flatnonzero(outside)[0])
        elif reach[at] < far:
            out.append((int(own[by[at]]), int(own[at])))
        for new in np.flatnonzero(outside & (label == label[at])).tolist():
            outside[new] = False
            nearer = weight[new] < reach
            reach[nearer], by[nearer] = weight[new][nearer], new
    return out


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block a forest of pairs to compare, and the members that have a candidate at all. If all pairs of the forest
    link, the block is settled."""
    for batch in batches:
        rows, pairs, open_docs = [], [], []
        for row in range(batch.num_rows):
            members = batch.column("members")[row].values
            doc, apart = _candidates(members)
            tree = _forest(apart, members.field("label").to_numpy(zero_copy_only=False))
            if tree:
                rows.append(row)
                pairs.append([{"u": min(doc[a], doc[b]), "v": max(doc[a], doc[b])} for a, b in tree])
                open_docs.append(doc[(apart >= 0).any(axis=1)])
        blocks = [batch.column(c).take(pa.array(rows, pa.int64())) for c in ("list", "i", "j")]
        kind = pa.list_(pa.struct([("u", pa.int64()), ("v", pa.int64())]))
        yield pa.RecordBatch.from_arrays([*blocks, pa.array(pairs, kind), pa.array(open_docs, pa.list_(pa.int64()))], ["list", "i", "j", "pairs", "docs"])


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of the sets share."""
    out = np.zeros((len(sets), len(sets)), np.int64)
    if not sets:
        return out
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, number, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    used = times[number] > 1
    _, number = np.unique(number[used], return_inverse=True)
    owner = owner[used]
    order = np.argsort(number, kind="stable")
    number, owner = number[order], owner[order]
    for first in range(0, int(number[-1]) + 1 if len(number) else 0, 2048):
        low, high = np.searchsorted(number, [first, first + 2048])
        held = np.zeros((len(sets), 2048), np.float32)
        held[owner[low:high], number[low:high] - first] = 1
        out += (held @ held.T).astype(np.int64)
    return out


def _block_links(n: int, percent: int):
    """Compare all members of a block exactly; returns a forest of links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            for row in range(batch.num_rows):
                members = batch.column("members")[row].values
                doc, label = (members.field(k).to_numpy(zero_copy_only=False) for k in ("doc", "label"))
                data, bounds = utf8(members.field("text"))
                sets = [s for i, j in slices(bounds) for s in shingle_sets(*words(data, bounds[i : j + 1], SPACED), n)]
                both, size = shared_counts(sets), np.array([len(s) for s in sets])
                linked = (both > 0) & (100 * both >= percent * (size[:, None] + size[None, :] - both)) & (label[:, None] != label[None, :])
                for a, b in _forest(np.where(linked, 0, -1), label):
                    us.append(min(doc[a], doc[b]))
                    vs.append(max(doc[a], doc[b]))
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    return run


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    """A smaller sketch of the same set. Differing parities never outnumber differing n-grams."""
    while len(bits) > width:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def similar_documents(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of the documents that link: ``id_col, n_shingles, component_id, class_id``.

    A document is the set of its distinct runs of n words (of all words, if there are fewer), words being separated by
    ``[\\x20\\x09-\\x0D]`` and A-Z lower-cased. Two link if 100 * shared >= percent * united; ``percent`` is 80 or more, for
    which the segments are laid out. ``class_id`` is the smallest id with the same set, ``component_id`` the smallest id
    reachable by links.

    Nulls and ties: null texts and texts without words have no n-grams and link with nothing. Repeated rows are one node
    and all come back; rows without an id link with nothing and come back with null ids. Rows that share an id are
    expected to have the same n-grams: else the set of one of them stands for all. Only the named columns are read.
    """
    if percent < 80:
        raise ValueError("segments are laid out for 80 percent or more")
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    _, parts = partitions_for(rows, "text", PARTITION_BYTES)
    shared = docs.sparkSession.sparkContext.broadcast(gram_counters(rows, n))
    packed = rows.mapInArrow(_profile_and_sign(4 * parts, n, shared), _SCHEMA)
    key = F.when(F.col("part") >= 0, F.col("part")).otherwise(F.xxhash64("doc", "low"))
    listed = packed.repartition(parts, key).mapInArrow(_lists, _LIST_SCHEMA)
    listed = stored(listed, "lists")
    profile = listed.where("list IS NULL").drop("list", "pivot")
    lists = listed.where("list IS NOT NULL").select("list", "pivot", "doc", F.col("flag").alias("asks"))

    whole = profile.where("doc IS NOT NULL AND n > 0")
    equal = whole.groupBy("low", "high", "n").agg(F.min("doc").alias("class"), F.count("*").alias("k")).where("k > 1")
    equal = stored(equal, "equal-sets")
    classes = stored(whole.join(equal, ["low", "high", "n"]).where("doc <> class").select("doc", "class").distinct(), "classes")
    same = classes.select(F.col("doc").alias("u"), F.col("class").alias("v"))
    # A node stands for itself unless it has an equal set of a smaller id; a repeated id may have several.
    lead = classes.groupBy("doc").agg(F.min("class").alias("class"))

    def led(frame: DataFrame, column: str) -> DataFrame:
        named = lead.select(F.col("doc").alias(column), F.col("class").alias("_lead"))
        return frame.join(named, column, "left").withColumn(column, F.coalesce("_lead", column)).drop("_lead")

    members = stored(led(lists.groupBy("list", "pivot", "doc").agg(F.max("asks").alias("asks")), "doc"), "members")
    first = led(members.where("pivot <> doc").select("pivot", "doc"), "pivot").where("pivot <> doc")
    counted = first.groupBy("pivot", "doc").agg(F.count("*").alias("k"))
    best = counted.groupBy("doc").agg(F.max_by("pivot", F.struct("k", "pivot")).alias("pivot"))
    texts = rows.where(F.col("doc").isNotNull())
    links = verified(texts, stored(best.select(F.col("doc").alias("u"), F.col("pivot").alias("v")), "pivot-pairs"), n, percent)
    joined = stored(components(links.union(same)), "first-components")

    def labelled(frame: DataFrame, joined: DataFrame) -> DataFrame:
        return frame.join(joined, F.col("doc") == F.col("node"), "left").select(*frame.columns, F.coalesce("component", "doc").alias("label"))

    def merged(joined: DataFrame, links: DataFrame) -> DataFrame:
        """Components after more links: only the components that the links touch are worked on, each as one node."""
        ends = labelled(links.select(F.col("u").alias("doc"), "v"), joined).select(F.col("label").alias("u"), F.col("v").alias("doc"))
        ends = labelled(ends, joined).select("u", F.col("label").alias("v")).where("u <> v").distinct()
        ends = stored(ends, "component-links")
        if ends.isEmpty():
            return joined
        moves = stored(components(ends), "component-moves")
        to = moves.select(F.col("node").alias("component"), F.col("component").alias("_to"))
        moved = joined.join(small_or_shuffled(to), "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
        return stored(moved.union(moves.join(joined.select("node"), "node", "left_anti")), "components")

    seats = members.groupBy("list", "doc").agg(F.max("asks").alias("asks"))
    for turn in range(HUB_ROUNDS + 1):
        spread = stored(labelled(seats, joined), "labelled-members")
        hub = F.min_by(F.struct(F.col("doc").alias("hub"), F.col("label").alias("hub_label")), F.xxhash64("doc", F.lit(turn))).alias("h")
        found = spread.groupBy("list").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), hub).where("lo <> hi")
        open_lists = stored(found.select("list", "h.*"), "open-lists")
        if turn == HUB_ROUNDS:
            break
        # Members of other components meet one hub each before any pairs are formed.
        tried = spread.join(open_lists, "list").where("label <> hub_label").groupBy("doc", "hub").agg(F.count("*").alias("k"))
        tried = tried.groupBy("doc").agg(F.max_by("hub", F.struct("k", "hub")).alias("hub"))
        hub_pairs = stored(tried.select(F.col("doc").alias("u"), F.col("hub").alias("v")), "hub-pairs")
        joined = merged(joined, verified(texts, hub_pairs, n, percent))
    told = profile.groupBy("doc").agg(F.max(F.struct("n", "sketch")).alias("p")).select("doc", F.col("p.n").alias("n"), F.col("p.sketch").alias("sketch"))
    told = stored(told, "sketches")

    # Open lists in blocks of one or two of their parts, so that each two members meet in one.
    sized = spread.join(open_lists.select("list"), "list").join(told, "doc")
    parts = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_GRAMS)).alias("blocks")
    parts = stored(sized.groupBy("list").agg(parts), "list-parts")
    crossing = sized.join(parts, "list").withColumn("own", F.pmod(F.xxhash64("doc"), F.col("blocks")))
    crossing = crossing.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    member = F.struct(F.col("doc").alias("class"), "label", "n", "asks", "sketch", (F.col("own") > F.col("other")).cast("int").alias("side"))
    blocks = crossing.groupBy("list", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).agg(F.collect_list(member).alias("members"))
    forests = stored(blocks.mapInArrow(_block_pairs, "list long, i long, j long, pairs array<struct<u:long,v:long>>, docs array<long>"), "block-forests")
    asked = forests.select("list", "i", "j", F.explode("pairs").alias("p")).select("list", "i", "j", "p.u", "p.v")
    more = verified(texts, stored(asked.select("u", "v").distinct(), "forest-pairs"), n, percent)
    # Where a pair of the forest does not link, other pairs may: what is left open in those blocks is compared exactly.
    unsettled = stored(asked.join(more, ["u", "v"], "left_anti").select("list", "i", "j").distinct(), "unsettled-blocks")
    if not unsettled.isEmpty():
        joined, more = merged(joined, more), more.limit(0)
        left = stored(forests.join(unsettled, ["list", "i", "j"]).select("list", "i", "j", "docs"), "unsettled-docs")
        # Lists of one group repeat each other: of blocks with the same documents one is enough.
        once = left.withColumn("docs", F.array_sort("docs")).dropDuplicates(["docs"])
        left = labelled(once.select("list", "i", "j", F.explode("docs").alias("doc")), joined)
        several = left.groupBy("list", "i", "j").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
        left = stored(left.join(stored(several.select("list", "i", "j"), "open-blocks"), ["list", "i", "j"]), "open-members")
        exact = left.join(texts.join(small_or_shuffled(stored(left.select("doc").distinct(), "open-docs")), "doc"), "doc")
        exact = exact.groupBy("list", "i", "j").agg(F.collect_list(F.struct("doc", "label", "text")).alias("members"))
        more = more.union(stored(exact.select("members").mapInArrow(_block_links(n, percent), "u long, v long").distinct(), "block-links"))
    lacking = profile.where("flag").select("doc").distinct()
    if not lacking.isEmpty():
        for found in links_of_lacking(texts, stored(lacking, "lacking"), n, percent):
            more = more.union(found)
    final = merged(joined, more)
    out = profile.join(final, F.col("doc") == F.col("node"), "left").join(lead.withColumnRenamed("doc", "_doc"), F.col("doc") == F.col("_doc"), "left")
    return out.select(
        F.col("doc").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc").alias("component_id"),
        F.coalesce("class", "doc").alias("class_id"),
    )
