"""Removal of byte strings that also start in a document of a smaller id, by suffix arrays over shards of candidates.

Every ``width``-byte window belongs to the smallest-hashed gram within it (its minimiser), wherever it occurs, so windows
are dealt into shards by minimiser without losing a match. Neighbouring windows of one minimiser form one piece of text, of bounded length.
A piece that an earlier document holds unchanged is all repeat, which hashes settle: within a batch before anything is
shuffled, else within the shard. What is left are pieces that share a minimiser but not their bytes; only those are
shipped as text, and a suffix array by induced sorting with its permuted common prefixes finds the windows that an
earlier document's piece contains.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.store import partitions_for, stored
from tidemark.llm.suffix import permuted_prefixes, suffix_array
from tidemark.llm.text import _VALUES, _powers, gather, mix, range_hashes, slices, utf8

GRAM = 20
#: Windows of one piece: their number is kept in a byte.
MOST = 255
#: Text bytes for each partition of pieces, text bytes handled at once, and pieces' bytes in one suffix array.
PARTITION_BYTES = 16 << 20
SLICE_BYTES = 1 << 20
BATCH_BYTES = 6 << 20
SHARD_BYTES = 1 << 20

_PIECE = np.dtype([("gram", "<u8"), ("content", "<u8"), ("doc", "<i8"), ("at", "<u4"), ("count", "u1")])
_RUN = np.dtype([("start", "<i4"), ("end", "<i4")])
_CHECK = np.dtype([("gram", "<u8"), ("at", "<u4"), ("count", "u1")])


def pieces(data: np.ndarray, bounds: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one minimiser: row, first window, number of windows, hashes of the gram and of all bytes.

    ``bounds`` goes from 0 to the length; windows lie within rows. It is the gram's hash that counts, not its place, so
    equal windows have equal minimisers, and a run of one character is one piece after the other of ``MOST`` windows.
    """
    n = len(data)
    if n < width:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    power, inverse = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[data] * power[:n], out=sums[1:])
    grams = mix((sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1])
    low, span, have = grams, width - gram + 1, 1
    while have < span:
        step = min(have, span - have)
        low = np.minimum(low[: len(low) - step], low[step:])
        have += step
    first, last = bounds[:-1], bounds[1:] - width
    long = last >= first
    edge = np.zeros(n + 2, np.int32)
    np.add.at(edge, first[long], 1)
    np.add.at(edge, last[long] + 1, -1)
    valid = np.cumsum(edge[: len(low)]) > 0
    new = valid.copy()
    new[1:] &= (low[1:] != low[:-1]) | ~valid[:-1]
    new[first[long]] = True
    start = np.flatnonzero(new)
    count = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], True)) - start + 1
    cuts = -(-count // MOST)
    skip = MOST * (np.arange(int(cuts.sum())) - np.repeat(np.cumsum(cuts) - cuts, cuts))
    start, count = np.repeat(start, cuts) + skip, np.minimum(MOST, np.repeat(count, cuts) - skip)
    stop = start + count - 1
    row = np.searchsorted(bounds, start, "right") - 1
    content = mix((sums[stop + width] - sums[start]) * inverse[start] + count.astype(np.uint64))
    return row, start - bounds[row], count, low[start], content


def _cut(data: np.ndarray, bounds: np.ndarray, i: int, j: int, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """Rows i to j as parts of bounded size: first row, bytes, bounds, and the first byte's place in its row.

    A long row is cut into parts that share ``width - 1`` bytes, so that each window is in one part.
    """
    lo, hi = int(bounds[i]), int(bounds[j])
    if j > i + 1 or hi - lo <= 2 * SLICE_BYTES:
        yield i, data[lo:hi], bounds[i : j + 1] - lo, 0
        return
    for at in range(lo, hi - width + 1, SLICE_BYTES):
        end = min(hi, at + SLICE_BYTES + width - 1)
        yield i, data[at:end], np.array([0, end - at], np.int64), at - lo


def _runs(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Byte runs merged and packed by document."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, []
    shift = np.unique(doc, return_inverse=True)[1].astype(np.int64) << 32
    reach = np.maximum.accumulate(end + shift)
    first = np.flatnonzero(np.append(True, start[1:] + shift[1:] > reach[:-1]))
    last = np.append(first[1:], len(doc)) - 1
    out = np.zeros(len(first), _RUN)
    out["start"], out["end"] = start[first], reach[last] - shift[last]
    own = doc[first]
    at = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    stop = np.append(at[1:], len(own))
    return own[at], [out[a:b].tobytes() for a, b in zip(at, stop)]


def _first_of(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces sorted by gram, content and document; and the smallest document with the same content, for each."""
    table = table[np.lexsort((table["doc"], table["content"], table["gram"]))]
    new = np.append(True, (table["content"][1:] != table["content"][:-1]) | (table["gram"][1:] != table["gram"][:-1])) if len(table) else np.zeros(0, bool)
    return table, table["doc"][np.flatnonzero(new)[np.cumsum(new) - 1]] if len(table) else table["doc"]


_SHARD_SCHEMA = "part long, body binary, doc long, runs binary, checks binary"
_SHARD_NAMES = ["part", "body", "doc", "runs", "checks"]


def _rows(part=None, body=None, doc=None, runs=None, checks=None) -> pa.RecordBatch:
    n = max(len(x) for x in (part, doc) if x is not None)
    column = lambda x, kind: pa.nulls(n, kind) if x is None else pa.array(x, kind)
    return pa.RecordBatch.from_arrays(
        [column(part, pa.int64()), column(body, pa.binary()), column(doc, pa.int64()), column(runs, pa.binary()), column(checks, pa.binary())], _SHARD_NAMES
    )


def _deal(width: int, parts: int):
    """Pieces packed by target partition, and the runs that an earlier document of the batch already has."""

    def batch_of(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        table, owner = _first_of(np.concatenate(found))
        again = table["doc"] > owner
        gone = table[again]
        docs, runs = _runs(gone["doc"], gone["at"].astype(np.int64), gone["at"].astype(np.int64) + gone["count"] + width - 1)
        if len(docs):
            yield _rows(doc=docs, runs=runs)
        table = table[~again]
        part = (table["gram"] % np.uint64(parts)).astype(np.int64)
        table = table[np.argsort(part, kind="stable")]
        at = np.searchsorted(np.sort(part), np.arange(parts + 1))
        full = np.flatnonzero(np.diff(at)).tolist()
        if full:
            yield _rows(part=full, body=[_pack(table[at[p] : at[p + 1]]) for p in full])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            data, bounds = utf8(batch.column(1))
            found, held = [], 0
            for i, j in slices(bounds, SLICE_BYTES):
                for first, own, rows, offset in _cut(data, bounds, i, j, width):
                    row, at, count, gram, content = pieces(own, rows, width, GRAM)
                    table = np.zeros(len(row), _PIECE)
                    table["gram"], table["content"], table["doc"] = gram, content, ids[first + row]
                    table["at"], table["count"] = at + offset, count
                    found.append(table)
                    held += len(own)
                if held > BATCH_BYTES:
                    yield from batch_of(found)
                    found, held = [], 0
            if found:
                yield from batch_of(found)

    return run


def _pack(table: np.ndarray) -> bytes:
    """Columns one after the other; 40 bits of the gram, and documents as numbers into a list of them."""
    docs, which = np.unique(table["doc"], return_inverse=True)
    narrow = which.astype("<u2" if len(docs) <= 1 << 16 else "<u4")
    gram = np.ascontiguousarray(table["gram"]).view(np.uint8).reshape(-1, 8)[:, 3:]
    sizes = np.array([len(table), len(docs), narrow.itemsize], "<i4")
    columns = (docs.astype("<i8"), narrow, np.ascontiguousarray(gram), *(np.ascontiguousarray(table[c]) for c in ("content", "at", "count")))
    return sizes.tobytes() + b"".join(c.tobytes() for c in columns)


def _unpack(body: bytes) -> np.ndarray:
    n, k, size = (int(x) for x in np.frombuffer(body, "<i4", 3))
    at = 12

    def column(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(body, kind, count, at)
        at += out.nbytes
        return out

    table = np.zeros(n, _PIECE)
    docs = column("<i8", k)
    table["doc"] = docs[column(f"<u{size}", n)]
    gram = np.zeros((n, 8), np.uint8)
    gram[:, 3:] = column("u1", 5 * n).reshape(n, 5)
    table["gram"] = gram.view("<u8")[:, 0]
    table["content"], table["at"], table["count"] = column("<u8", n), column("<u4", n), column("u1", n)
    return table


def _by_part(batches: Iterator[pa.RecordBatch], other: list[pa.RecordBatch]) -> dict[int, list[bytes]]:
    bodies: dict[int, list[bytes]] = {}
    for batch in batches:
        part = batch.column(0)
        for k in np.flatnonzero(part.is_valid().to_numpy(zero_copy_only=False)).tolist():
            bodies.setdefault(part[k].as_py(), []).append(batch.column(1)[k].as_py())
        rest = batch.filter(part.is_null())
        if rest.num_rows:
            other.append(rest)
    return bodies


def _compare(width: int):
    """Runs settled by whole pieces, and the pieces whose bytes must be compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        other: list[pa.RecordBatch] = []
        bodies = _by_part(batches, other)
        yield from other
        for part in sorted(bodies):
            table, owner = _first_of(np.concatenate([_unpack(b) for b in bodies.pop(part)]))
            new = np.flatnonzero(np.append(True, table["gram"][1:] != table["gram"][:-1]))
            group = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(table))))
            mixed = (np.minimum.reduceat(owner, new) < np.maximum.reduceat(owner, new))[group]
            again = table["doc"] > owner
            gone, look = table[again], table[~again & mixed]
            docs, runs = _runs(gone["doc"], gone["at"].astype(np.int64), gone["at"].astype(np.int64) + gone["count"] + width - 1)
            if len(docs):
                yield _rows(doc=docs, runs=runs)
            if len(look):
                look = look[np.argsort(look["doc"], kind="stable")]
                at = np.flatnonzero(np.append(True, look["doc"][1:] != look["doc"][:-1]))
                packed = np.zeros(len(look), _CHECK)
                for name in _CHECK.names:
                    packed[name] = look[name]
                yield _rows(doc=look["doc"][at], checks=[packed[a:b].tobytes() for a, b in zip(at, np.append(at[1:], len(look)))])

    return run


def _extract(width: int, parts: int):
    """The bytes of the pieces to compare, packed by target partition."""

    def batch_of(docs: list, tables: list[np.ndarray], texts: list[np.ndarray]) -> pa.RecordBatch:
        doc, table, text = np.repeat(docs, [len(t) for t in tables]).astype("<i8"), np.concatenate(tables), np.concatenate(texts)
        length = table["count"].astype(np.int64) + width - 1
        start = np.cumsum(length) - length
        # A document's equal pieces share one copy of their bytes; the copies are only places.
        content = range_hashes(text, start, start + length)
        order = np.lexsort((content, doc))
        new = np.append(True, (doc[order[1:]] != doc[order[:-1]]) | (content[order[1:]] != content[order[:-1]]))
        first, same = order[new], np.empty(len(order), np.int64)
        same[order] = np.cumsum(new) - 1
        # The gram's low bits are not kept, so it is mixed before it is dealt.
        part = ((mix(table["gram"]) >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((same, part))
        at = np.searchsorted(part[order], np.arange(parts + 1))
        full = np.flatnonzero(np.diff(at)).tolist()
        bodies = []
        for p in full:
            own = order[at[p] : at[p + 1]]
            new = np.append(True, same[own[1:]] != same[own[:-1]])
            held = first[same[own[new]]]
            sizes = np.array([len(own), len(held)], "<i4")
            columns = (table["at"][own], (np.cumsum(new) - 1).astype("<u4"), doc[held], table["count"][held], text[gather(start[held], length[held])])
            bodies.append(sizes.tobytes() + b"".join(np.ascontiguousarray(c).tobytes() for c in columns))
        return _rows(part=full, body=bodies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_text = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            docs, tables, texts, held = [], [], [], 0
            for doc, body, packed in zip(*batch.columns):
                text = np.frombuffer(open_text(body.as_py()), np.uint8)
                table = np.concatenate([np.frombuffer(x, _CHECK) for x in packed.as_py()])
                docs.append(doc.as_py())
                tables.append(table)
                texts.append(text[gather(table["at"].astype(np.int64), table["count"].astype(np.int64) + width - 1)])
                held += len(texts[-1])
                if held > BATCH_BYTES:
                    yield batch_of(docs, tables, texts)
                    docs, tables, texts, held = [], [], [], 0
            if docs:
                yield batch_of(docs, tables, texts)

    return run


def _shard(width: int):
    """Windows of the pieces of a shard that a piece of an earlier document contains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bodies = _by_part(batches, [])
        for part in sorted(bodies):
            places, which, docs, counts, texts, before = [], [], [], [], [], 0
            for body in bodies.pop(part):
                n, k = (int(x) for x in np.frombuffer(body, "<i4", 2))
                places.append(np.frombuffer(body, "<u4", n, 8).astype(np.int64))
                which.append(np.frombuffer(body, "<u4", n, 8 + 4 * n).astype(np.int64) + before)
                docs.append(np.frombuffer(body, "<i8", k, 8 + 8 * n))
                counts.append(np.frombuffer(body, "u1", k, 8 + 8 * n + 8 * k).astype(np.int64))
                texts.append(np.frombuffer(body, np.uint8, offset=8 + 8 * n + 9 * k))
                before += k
            at, which, doc, count, text = map(np.concatenate, (places, which, docs, counts, texts))
            found = repeated_windows(text, count + width - 1, doc, width)
            # Of each piece its windows, for each place that holds it.
            start = (np.cumsum(count) - count)[which]
            hit = found[gather(start, count[which])]
            place = np.repeat(at, count[which]) + gather(np.zeros(len(at), np.int64), count[which])
            own, runs = _runs(np.repeat(doc[which], count[which])[hit], place[hit], place[hit] + width)
            if len(own):
                yield _rows(doc=own, runs=runs)

    return run


def repeated_windows(text: np.ndarray, length: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
    """For every window of every piece, whether a piece of a smaller document contains it.

    ``text`` is the pieces one after the other. UTF-8 has no bytes above 0xF4, which leaves room for two more symbols:
    one after each piece, and the end.
    """
    k = len(length)
    place = np.arange(len(text)) + np.repeat(np.arange(k), length)
    whole = np.ones(len(text) + k + 1, np.uint8)
    whole[place] = text + 2
    whole[-1] = 0
    order = suffix_array(whole, width)
    shared = permuted_prefixes(whole, order, width)
    windows = length - width + 1
    starts = np.cumsum(length) - length + np.arange(k)
    valid = np.zeros(len(whole), bool)
    at = gather(starts, windows)
    valid[at] = True
    owner = np.zeros(len(whole), np.int64)
    owner[at] = np.repeat(doc, windows)
    order = order[valid[order]]
    # Windows with equal bytes are neighbours, and no other suffix lies between them.
    group = np.flatnonzero(np.append(True, shared[order[1:]] < width))
    least = np.repeat(np.minimum.reduceat(owner[order], group), np.diff(np.append(group, len(order))))
    later = np.zeros(len(whole), bool)
    later[order] = owner[order] > least
    return later[at]


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        bodies = [press(t.as_buffer() or b"") for t in batch.column(1).cast(pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bodies, pa.binary())], ["doc", "body"])


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_text = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        rows, size, start = [], 0, 0
        for k, (body, packed) in enumerate(zip(batch.column("body"), batch.column("runs"))):
            text = open_text(body.as_py())
            spans = []
            if packed.is_valid:
                runs = np.concatenate([np.frombuffer(x, _RUN) for x in packed.as_py()])
                runs = np.frombuffer(_runs(np.zeros(len(runs), np.int64), runs["start"].astype(np.int64), runs["end"].astype(np.int64))[1][0], _RUN)
                spans = runs.tolist()
            kept = b"".join(text[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(text)]))
            rows.append((len(text), kept, [{"start": a, "end": b} for a, b in spans]))
            size += len(kept)
            if size > 4 << 20 or k + 1 == batch.num_rows:
                lengths, kept_texts, all_spans = zip(*rows)
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").slice(start, len(rows)), pa.array(lengths, pa.int64()), pa.array(kept_texts, pa.binary()), pa.array(all_spans, kind)],
                    ["doc", "n_bytes", "kept", "spans"],
                )
                rows, size, start = [], 0, k + 1


def dedup_substrings(docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every byte that lies in a ``width``-byte string which also starts in a document of a smaller id.

    Texts are taken as UTF-8 and judged as they come in. Returns ``id_col, n_bytes, kept`` (the bytes left; a cut may
    split a character) and ``spans`` (start and end of every maximal removed run). ``width`` is from ``GRAM`` to 200.

    Nulls and ties: a null text is empty; texts shorter than ``width`` stay whole. Rows without an id stay whole and take
    nothing from others. Rows that share an id are expected to share the text; they take nothing from each other. Only
    the named columns are read, so others never clash.
    """
    if not GRAM <= width <= 200:
        raise ValueError(f"width is from {GRAM} to 200")
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    known = rows.where(F.col("doc").isNotNull())
    total, parts = partitions_for(rows, "text", PARTITION_BYTES)
    dealt = known.where(F.octet_length("text") >= width).mapInArrow(_deal(width, 4 * parts), _SHARD_SCHEMA)
    to = F.coalesce(F.col("part"), F.xxhash64("doc"))
    settled = stored(dealt.repartition(parts, to).mapInArrow(_compare(width), _SHARD_SCHEMA), "pieces")
    packed = rows.mapInArrow(_compressed, "doc long, body binary")
    checks = settled.where("checks IS NOT NULL").groupBy("doc").agg(F.collect_list("checks").alias("checks"))
    distinct = packed.join(checks, "doc").select("doc", "body", "checks")
    size = settled.agg(F.sum(F.octet_length("checks")).alias("n")).first()["n"] or 0
    shards = max(8, size // _CHECK.itemsize * (width + 20) // SHARD_BYTES)
    texts = distinct.mapInArrow(_extract(width, shards), _SHARD_SCHEMA)
    found = stored(texts.repartition(max(8, shards // 4), "part").mapInArrow(_shard(width), _SHARD_SCHEMA), "repeats")
    runs = settled.where("runs IS NOT NULL").select("doc", "runs").union(found.select("doc", "runs"))
    runs = runs.groupBy("doc").agg(F.collect_list("runs").alias("runs")).withColumnRenamed("doc", "_doc")
    joined = packed.join(runs, F.col("doc") == F.col("_doc"), "left").select("doc", "body", "runs")
    spans = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    out = T.StructType([T.StructField("doc", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("kept", T.BinaryType()), T.StructField("spans", spans)])
    return joined.mapInArrow(_remove, out).withColumnRenamed("doc", id_col)
