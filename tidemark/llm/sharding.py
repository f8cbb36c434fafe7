"""Sharding by a k-d tree over document metadata, with DataFrame operations only.

The unit that is placed is a group of equal texts; a group of more than a small share of a shard is dealt into pieces
first. The tree splits a node at the weighted median of the metadata dimension along which it is widest. Medians are
found by counting bytes in a fixed number of buckets per node and looking closer at the one that holds the median, so
the driver only ever sees a bounded histogram.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.store import stored

DIMENSIONS = ("size", "doc", "source", "lang")
BUCKETS = 2048
#: Largest unit, as a share of a shard; there are at most shards / this of groups that are dealt into pieces.
PIECE = 1 / 200
#: A cut may miss the weighted median by this share of the node.
SLACK = 1 / 2000
TIES = 1 << 62
SLOT_ROWS = 100_000


#: Buckets of all histograms that are collected at once.
HISTOGRAM_ROWS = 1 << 17


@dataclass
class Cut:
    """Units with a smaller value go left, those with the value by their tie; ``tie`` -1: all of them go right."""

    dimension: str
    value: int
    tie: int


@dataclass
class Node:
    """A part of the tree that holds the shards from ``first`` on; it is cut in two as long as it has several."""

    first: int
    leaves: int
    cut: Cut | None = None
    left: Node | None = None
    right: Node | None = None

    def levels(self) -> Iterator[list[Node]]:
        """Cut nodes, level by level."""
        nodes = [self]
        while nodes := [n for n in nodes if n.cut is not None]:
            yield nodes
            nodes = [half for n in nodes for half in (n.left, n.right)]

    def ends(self) -> list[Node]:
        return [self] if self.cut is None else [*self.left.ends(), *self.right.ends()]


def _table(spark: SparkSession, names: str, rows: list[tuple[int | None, ...]]) -> DataFrame:
    """A small table of whole numbers, inline in the plan."""
    value = lambda v: "CAST(NULL AS BIGINT)" if v is None else f"BIGINT('{v}')"
    return spark.sql(f"SELECT * FROM VALUES {', '.join('(' + ', '.join(map(value, row)) + ')' for row in rows)} AS t({names})")


def _along(dimension: Column) -> Column:
    """The value of a unit in the dimension of that number."""
    return F.element_at(F.array(*[F.col(d) for d in DIMENSIONS]), (dimension + 1).cast("int"))


def routed(units: DataFrame, root: Node) -> DataFrame:
    """Add ``node``, the first shard of the unit's leaf: one join with a table of cuts for each level of the tree."""
    # All begin at the root; as a literal, that would turn the first join into one without a key.
    placed = units.withColumn("node", F.pmod("tie", F.lit(1)) + F.lit(root.first))
    for nodes in root.levels():
        rows = [(n.first, DIMENSIONS.index(n.cut.dimension), n.cut.value, n.cut.tie, n.right.first) for n in nodes]
        cuts = F.broadcast(_table(units.sparkSession, "node, dimension, cut, cut_tie, beyond", rows))
        v = _along(F.col("dimension"))
        stays = F.col("dimension").isNull() | (v < F.col("cut")) | ((v == F.col("cut")) & (F.col("tie") <= F.col("cut_tie")))
        placed = placed.join(cuts, "node", "left").select(*units.columns, F.when(stays, F.col("node")).otherwise(F.col("beyond")).alias("node"))
    return placed


@dataclass
class _Search:
    """Where the cut of a node lies: in [lo, hi] of ``column``, with ``below`` bytes before lo."""

    node: Node
    dimension: str
    goal: float
    slack: float
    lo: int
    hi: int
    column: str = "value"
    value: int | None = None
    below: float = 0.0
    step: int = 1

    def row(self, buckets: int) -> tuple[int | None, ...]:
        self.step = max(1, -(-(self.hi - self.lo + 1) // buckets))
        return self.node.first, DIMENSIONS.index(self.dimension), self.value, self.lo, self.hi, self.step

    def cut(self, last: int) -> Cut:
        """All values up to ``last`` go left."""
        if self.column == "tie":
            return Cut(self.dimension, self.value, last)
        return Cut(self.dimension, last, TIES)

    def look(self, histogram: list[tuple[int, float, int]]) -> Cut | None:
        """The cut if it is close enough to the goal, else None after narrowing the range."""
        for bucket, weight, units in histogram:
            if self.below + weight < self.goal and bucket != histogram[-1][0]:
                self.below += weight
                continue
            start = self.lo + bucket * self.step
            end = min(self.hi, start + self.step - 1)
            under, over = self.goal - self.below, self.below + weight - self.goal
            if units == 1 or min(abs(under), abs(over)) <= self.slack:
                return self.cut(end if abs(over) < abs(under) else start - 1)
            if self.step == 1:
                if self.column == "tie":
                    return self.cut(end if abs(over) < abs(under) else start - 1)
                self.column, self.value, self.lo, self.hi = "tie", start, 0, TIES - 1
            else:
                self.lo, self.hi = start, end
            return None
        return self.cut(self.hi)


def _histograms(placed: DataFrame, searches: list[_Search]) -> dict[int, list[tuple[int, float, int]]]:
    """Bytes and units by bucket of every search."""
    buckets = max(16, min(BUCKETS, HISTOGRAM_ROWS // len(searches)))
    ranges = _table(placed.sparkSession, "node, dimension, fixed, lo, hi, step", [s.row(buckets) for s in searches])
    v = _along(F.col("dimension"))
    # Within one value of the dimension the tie is searched, else the value.
    looked = F.when(F.col("fixed").isNull(), v).when(v == F.col("fixed"), F.col("tie"))
    rows = placed.join(F.broadcast(ranges), "node").withColumn("v", looked).where("v BETWEEN lo AND hi")
    found: dict[int, list[tuple[int, float, int]]] = {}
    for r in rows.groupBy("node", F.expr("(v - lo) div step").alias("bucket")).agg(F.sum("bytes").alias("w"), F.count("*").alias("n")).collect():
        found.setdefault(r["node"], []).append((r["bucket"], float(r["w"]), r["n"]))
    return found


def kd_tree(units: DataFrame, shards: int) -> Node:
    """Split ``units`` (the dimensions, ``tie`` and ``bytes``) until every leaf is one shard of near equal bytes.

    A node of k shards is cut where the left part has the bytes of k // 2 of them. Levels are worked on together; plans grow
    with the number of levels, not of nodes, and what the driver sees is a bounded number of histogram rows.
    """
    root = Node(0, shards)
    whole: dict[str, float] = {}
    while open_nodes := [n for n in root.ends() if n.leaves > 1]:
        placed = routed(units, root)
        spread = [f(d).alias(f"{k}_{d}") for d in DIMENSIONS for k, f in (("lo", F.min), ("hi", F.max))]
        stats = {r["node"]: r for r in placed.groupBy("node").agg(F.sum("bytes").alias("bytes"), *spread).collect()}
        searches = []
        for node in open_nodes:
            own = stats.get(node.first)
            width = {d: own[f"hi_{d}"] - own[f"lo_{d}"] if own else 0 for d in DIMENSIONS}
            whole = whole or width
            widest = max(DIMENSIONS, key=lambda d: width[d] / max(1, whole[d]))
            if own is None:
                _split(node, Cut(widest, 0, -1))
                continue
            total = float(own["bytes"])
            searches.append(_Search(node, widest, total * (node.leaves // 2) / node.leaves, total * SLACK, own[f"lo_{widest}"], own[f"hi_{widest}"]))
        while searches:
            found = _histograms(placed, searches)
            left = []
            for search in searches:
                cut = search.look(sorted(found.get(search.node.first, [])))
                if cut is None:
                    left.append(search)
                else:
                    _split(search.node, cut)
            searches = left
    return root


def _split(node: Node, cut: Cut) -> None:
    half = node.leaves // 2
    node.left, node.right, node.cut = Node(node.first, half), Node(node.first + half, node.leaves - half), cut


def shard_documents(
    docs: DataFrame,
    shards: int | None = 8,
    target_bytes: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
) -> DataFrame:
    """Place every row in one of ``shards`` shards of near equal bytes, or in as many as reach ``target_bytes`` each.

    Returns ``id_col``, ``size`` (UTF-8 bytes of the text plus 1), ``text_crc32``, ``shard`` and ``slot`` (gapless from 0
    within the shard). Equal texts share a shard unless they weigh more than ``PIECE`` of one: larger groups are dealt
    into pieces, because no shard could hold a third of all rows.

    Nulls and ties: null texts are one group of size 1; null ids, sources and languages count as 0. Repeated rows each
    get a slot. A table of fewer groups than shards leaves shards empty; an empty table gives an empty one. Only the
    named columns are read, so others never clash.

    Plan: texts are read once, for a few numbers each. Those are summed by group with partial sums, the list of groups
    to deal out is bounded by ``shards / PIECE`` and broadcast, and the rest works on the table of units.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    code = lambda c: F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(0)).cast("long")
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
        code(source_col).alias("source"),
        code(lang_col).alias("lang"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stored(rows, "shard-rows")
    totals = rows.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first()
    if target_bytes is not None:
        shards = max(1, -(-(totals["bytes"] or 0) // target_bytes))
    most = max(1, int((totals["bytes"] or 0) / shards * PIECE))
    groups = rows.groupBy("h", "size").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > most)
    large = groups.where("bytes > size").select("h", "size", F.ceil(F.col("bytes") / most).alias("pieces"))
    rows = rows.join(F.broadcast(large), ["h", "size"], "left").withColumn("piece", F.coalesce(F.pmod("row", "pieces"), F.lit(0)).cast("long"))
    # Two bits less, so that differences fit in a long whatever the ids.
    doc = F.shiftright(F.coalesce(F.min(F.col("id").cast("long")), F.lit(0)), 2)
    units = rows.groupBy("h", "size", "piece").agg(
        F.sum("size").alias("bytes"), doc.alias("doc"), F.min("source").alias("source"), F.min("lang").alias("lang")
    )
    units = stored(units.withColumn("tie", F.pmod(F.xxhash64("h", "size", "piece"), F.lit(TIES))), "units")
    placed = routed(units, kd_tree(units, shards)).select("h", "size", "piece", F.col("node").alias("shard"))
    rows = stored(rows.join(placed, ["h", "size", "piece"]).select("id", "size", "text_crc32", "row", "shard"), "placed-rows")
    parts = max(1, -(-totals["n"] // (shards * SLOT_ROWS)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "part").count().withColumn("start", F.coalesce(F.sum("count").over(before), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("shard", "part").orderBy("id", "row")) - 1
    rows = rows.withColumn("within", within).join(starts.select("shard", "part", "start"), ["shard", "part"])
    return rows.select(F.col("id").alias(id_col), "size", "text_crc32", F.col("shard").cast("int"), (F.col("start") + F.col("within")).cast("long").alias("slot"))
