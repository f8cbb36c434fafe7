"""Near-duplicate embeddings: iterative quantisation codes, multi-index Hamming tables, reranking by exact cosine.

Equal vectors are one class first. Rotations learned on a bounded sample turn every class into a balanced binary code.
The code's chunks are the keys of the Hamming tables; each class is filed under its own key and all keys one bit away,
so two classes meet wherever their chunks differ in at most two bits. Codes follow the angle as seen from the mean, which
spreads vectors with a common direction over the buckets but also spreads close pairs; so the number of tables and the
radius are taken from pairs of exactly the least cosine, made from the sample. A pair belongs to one bucket only, the smallest key
both share in the first table where they meet, so links can be counted without listing pairs: a first pass over codes
marks which classes have candidates in which bucket, and only those take their vectors there to be compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.components import components
from tidemark.llm.store import stored

#: Vectors that the rotation is learned from at most (in expectation; picked by a hash).
SAMPLE = 8_000
ROUNDS = 40
BITS = 64
CHUNKS = 4
WIDTH = BITS // CHUNKS
#: Candidates may differ in at least so many of each ``BITS`` bits, and in more if close pairs of the sample do.
RADIUS = 18
#: Words of ``BITS`` bits in a code. If close pairs need more than the most, all classes are compared with one another.
WORDS, MOST_WORDS = 2, 8
#: Share of the sample's close pairs that tables are added for, and the share that the radius takes in.
RECALL, INSIDE = 0.999, 0.9995
BLOCK = 1024
#: Classes for each partition of the Hamming tables.
PARTITION_ROWS = 4_000
#: Keys that a worker makes at a time.
KEYS = 1_000_000


@dataclass
class Rotation:
    """``turn`` has ``BITS`` columns for each word; without ``tables``, every pair has to be compared."""

    mean: np.ndarray
    turn: np.ndarray
    tables: int = CHUNKS
    radius: int = RADIUS

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """One row for each word."""
        bits = ((unit - self.mean) @ self.turn >= 0).astype(np.uint8)
        words = self.turn.shape[1] // BITS
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).T if len(bits) else np.zeros((words, 0), np.uint64)


def close_pairs(unit: np.ndarray, least: float, draw: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs with a cosine of exactly ``least``: every vector moved in any direction, and in one in which the sample varies."""
    pairs = []
    for way in (draw.standard_normal(unit.shape), unit[draw.permutation(len(unit))] - unit[draw.permutation(len(unit))]):
        way = way - (way * unit).sum(axis=1, keepdims=True) * unit
        size = np.linalg.norm(way, axis=1, keepdims=True)
        good = size[:, 0] > 1e-9
        pairs.append((unit[good], least * unit[good] + np.sqrt(max(0.0, 1 - least * least)) * way[good] / size[good]))
    return [p for p in pairs if len(p[0])]


def learn_rotation(unit: np.ndarray, dims: int, least: float = 0.95, seed: int = 5) -> Rotation:
    """Principal axes, then alternating between the nearest binary codes and the rotation that fits them best.

    Of fewer than ``BITS`` dimensions, further bits are signs of random directions. Every word starts from a random
    rotation of its own; words are added until tables find ``RECALL`` of the sample's close pairs.
    """
    draw = np.random.default_rng(seed)
    mean = unit.mean(axis=0) if len(unit) else np.zeros(dims)
    centred = unit - mean
    k = min(BITS, dims)
    if len(unit) > 1:
        _, axes = np.linalg.eigh(centred.T @ centred)
        axes = axes[:, ::-1][:, :k]
    else:
        axes = np.eye(dims)[:, :k]
    flat = centred @ axes
    pairs = close_pairs(unit, least, np.random.default_rng(seed + 1))
    apart, missed = [np.zeros(len(u), np.int64) for u, _ in pairs], [np.ones(len(u), bool) for u, _ in pairs]
    turns, tables = [], 0
    while len(turns) < WORDS or (not tables and len(turns) < MOST_WORDS):
        turn, _ = np.linalg.qr(draw.standard_normal((k, k)))
        for _ in range(ROUNDS if len(unit) > 1 else 0):
            left, _, right = np.linalg.svd(np.where(flat @ turn >= 0, 1.0, -1.0).T @ flat)
            turn = right.T @ left.T
        turns.append(np.hstack([axes @ turn, draw.standard_normal((dims, BITS - k))]))
        word = Rotation(mean, turns[-1])
        differ = [(word.codes(u) ^ word.codes(v))[0] for u, v in pairs]
        for far, d in zip(apart, differ):
            far += np.bitwise_count(d)
        for chunk in range(CHUNKS):
            for miss, d in zip(missed, differ):
                miss &= np.bitwise_count(_chunk(d, chunk)) > 2
            table = CHUNKS * (len(turns) - 1) + chunk + 1
            if not tables and table >= CHUNKS and all(miss.mean() <= 1 - RECALL for miss in missed):
                tables = table
    inside = [np.quantile(far, INSIDE, method="higher") for far in apart]
    return Rotation(mean, np.hstack(turns), tables, int(max([RADIUS * len(turns), *inside])))


def _units(column: pa.Array, dims: int) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    table = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    # Scaled first, so that squares neither overflow nor vanish.
    table = table / np.abs(table).max(axis=1, keepdims=True) if len(table) else table
    return table / np.linalg.norm(table, axis=1, keepdims=True)


def _chunk(codes: np.ndarray, table: int) -> np.ndarray:
    word = np.atleast_2d(codes)[table // CHUNKS]
    return (word >> np.uint64(table % CHUNKS * WIDTH) & np.uint64((1 << WIDTH) - 1)).astype(np.int64)


def meeting(a: np.ndarray, b: np.ndarray, tables: int = CHUNKS) -> np.ndarray:
    """The bucket to which a pair of codes belongs, -1 if no table has one."""
    out = np.full(a.shape[-1], -1, np.int64)
    for table in reversed(range(tables)):
        x, y = _chunk(a, table), _chunk(b, table)
        differ = x ^ y
        low = differ & -differ
        # Keys that both are filed under: either, if they differ in one bit; else those with one of the two bits.
        key = np.where(np.bitwise_count(differ) == 2, np.minimum(x ^ low, y ^ low), np.minimum(x, y))
        out = np.where(np.bitwise_count(differ) <= 2, table << WIDTH | key, out)
    return out


def _file(rotation: Rotation, dims: int, parts: int):
    """Every class under all its keys, packed by target partition."""
    masks = np.array([0, *(1 << k for k in range(WIDTH))], np.int64)
    each = KEYS // (rotation.tables * len(masks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, each) for b in batches for at in range(0, b.num_rows, each)):
            ids = batch.column(0).to_numpy()
            codes = rotation.codes(_units(batch.column(1), dims))
            bucket = np.concatenate([(t << WIDTH | (_chunk(codes, t)[:, None] ^ masks)).ravel() for t in range(rotation.tables)])
            row = np.tile(np.repeat(np.arange(len(ids)), len(masks)), rotation.tables)
            part = bucket % parts
            order = np.argsort(part, kind="stable")
            at = np.searchsorted(part[order], np.arange(parts + 1))
            full = np.flatnonzero(np.diff(at)).tolist()
            pack = lambda x: pa.array([x[order[at[p] : at[p + 1]]].tobytes() for p in full], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pack(bucket), pack(ids[row]), pack(codes.T[row])], ["part", "buckets", "ids", "codes"])

    return run


def _candidates(rotation: Rotation):
    """``bucket, id`` of the classes that have a candidate in the bucket to which the pair belongs."""
    words = rotation.turn.shape[1] // BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed: list[list[np.ndarray]] = [[], [], []]
        for batch in batches:
            for column, out, kind in zip(batch.columns[1:], packed, (np.int64, np.int64, np.uint64)):
                out += [np.frombuffer(x.as_py(), kind) for x in column]
        if not packed[0]:
            return
        bucket, ids, codes = (np.concatenate(x) for x in packed)
        order = np.argsort(bucket, kind="stable")
        bucket, ids, codes = bucket[order], ids[order], np.ascontiguousarray(codes.reshape(-1, words)[order].T)
        last = np.searchsorted(bucket, bucket, "right")
        active = np.zeros(len(ids), bool)
        row, step = np.arange(len(ids)), 1
        while len(row := row[row + step < last[row]]):
            apart = sum(np.bitwise_count(word[row] ^ word[row + step]).astype(np.int16) for word in codes)
            near = row[apart <= rotation.radius]
            near = near[meeting(codes[:, near], codes[:, near + step], rotation.tables) == bucket[near]]
            active[near] = active[near + step] = True
            step += 1
        yield pa.RecordBatch.from_arrays([pa.array(bucket[active]), pa.array(ids[active])], ["bucket", "id"])

    return run


def _links(rotation: Rotation, dims: int, least: float):
    """Of each block: how many vectors each class is linked with, and the smallest class its links there lead to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                members = batch.column("members")[row].values
                ids, copies, side = (np.asarray(members.field(c)) for c in ("id", "k", "side"))
                unit = _units(members.field("vector"), dims)
                codes = rotation.codes(unit)
                linked = unit @ unit.T >= least
                if side.any():
                    linked &= side[:, None] != side[None, :]
                np.fill_diagonal(linked, False)
                a, b = np.nonzero(linked)
                linked[a, b] = meeting(codes[:, a], codes[:, b], rotation.tables) == batch.column("bucket")[row].as_py()
                if not linked.any():
                    continue
                label, before = ids.copy(), None
                while before is None or (label != before).any():
                    before = label
                    label = np.minimum(label, np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1))
                has = linked.any(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[has]), pa.array((linked @ copies)[has].astype(np.int64)), pa.array(label[has])], ["id", "n", "least"]
                )

    return run


def _linked(classes: DataFrame, n: int, dims: int, least: float) -> DataFrame:
    """``id, n, least`` of the links between the ``n`` classes, all of ``dims`` numbers."""
    pick = F.pmod(F.xxhash64("h"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / max(1, n)))
    sample = classes.where(pick).select("class", "vector").toArrow().sort_by("class")
    rotation = learn_rotation(_units(sample.column("vector"), dims), dims, least)
    if rotation.tables:
        parts = max(8, -(-n * rotation.tables // (PARTITION_ROWS * CHUNKS)))
        filed = classes.select("class", "vector").mapInArrow(_file(rotation, dims, 4 * parts), "part long, buckets binary, ids binary, codes binary")
        near = stored(filed.repartition(parts, "part").mapInArrow(_candidates(rotation), "bucket long, id long"), "candidates")
    else:
        near = classes.select(F.lit(-1).cast("long").alias("bucket"), F.col("class").alias("id"))
    crowded = near.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    placed = near.join(crowded, "bucket").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    placed = placed.join(classes.select(F.col("class").alias("id"), "k", "vector"), "id")
    member = F.struct("id", "k", "vector", (F.col("own") > F.col("other")).cast("int").alias("side"))
    blocks = placed.groupBy("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).agg(F.collect_list(member).alias("members"))
    return stored(blocks.select("bucket", "members").mapInArrow(_links(rotation, dims, least), "id long, n long, least long"), "vector-links")


def near_duplicates(vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id_col, n_links, component_id, kept``: links are pairs found with a cosine of ``least`` or more.

    Tables are added until ``RECALL`` of sample pairs with a cosine of exactly ``least`` meet; closer pairs meet more often.
    If ``MOST_WORDS`` are too few for that, since all vectors are close to one another, every pair is compared. Links are
    counted between ids; ``component_id`` is the smallest id reachable by links, and ``kept`` marks it.

    Nulls and ties: vectors that are null, empty, all zero, or hold a null or non-finite component link with nothing;
    vectors of different lengths do not link with one another. Repeated rows of an id count once and all come back; rows
    without an id link with nothing and have a null component. Only the named columns are read; labels play no part.

    Plan: classes are formed with partial sums. Lengths are handled one after another, each with its own rotation. Hamming
    tables are packed and shuffled once, a few numbers a class; only classes with candidates take their vectors along, in
    blocks of ``BLOCK``. No pair is ever a row.
    """
    value = F.col(vector_col).cast("array<double>")
    sound = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(value, lambda x: x != 0.0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), value.alias("vector"), F.coalesce(sound, F.lit(False)).alias("sound"))
    usable = F.col("sound") & F.col("id").isNotNull()
    rows = rows.select("id", F.when(usable, F.col("vector")).alias("vector"))
    rows = stored(rows.withColumn("h", F.xxhash64("vector")).withColumn("g", F.xxhash64(F.lit(7), "vector")), "vectors")
    one_each = rows.where("vector IS NOT NULL").groupBy("h", "g", "id").agg(F.first("vector").alias("vector"))
    classes = one_each.groupBy("h", "g").agg(F.min("id").alias("class"), F.count("*").alias("k"), F.first("vector").alias("vector"))
    classes = stored(classes.withColumn("dims", F.size("vector")), "vector-classes")
    lengths = classes.groupBy("dims").agg(F.count("*").alias("n")).where("n > 1").orderBy("dims").collect()
    links = classes.sparkSession.createDataFrame([], "id long, n long, least long")
    for r in lengths:
        links = links.unionByName(_linked(classes.where(F.col("dims") == r["dims"]), r["n"], r["dims"], least))
    counts = links.groupBy("id").agg(F.sum("n").alias("n"))
    joined = components(links.select(F.col("id").alias("u"), F.col("least").alias("v")))
    told = classes.select("h", "g", "class", "k").join(counts, F.col("class") == F.col("id"), "left").drop("id")
    told = told.join(joined, F.col("class") == F.col("node"), "left").select(
        "h", "g", (F.coalesce("n", F.lit(0)) + F.col("k") - 1).alias("n_links"), F.coalesce("component", "class").alias("component")
    )
    told = stored(told, "vector-results")
    good = rows.where("vector IS NOT NULL").join(told, ["h", "g"]).select("id", "n_links", "component")
    rest = rows.where("vector IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return good.union(rest).select(
        F.col("id").alias(id_col), "n_links", F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept")
    )
