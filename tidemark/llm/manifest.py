"""A Merkle manifest of a dataset: leaf coordinates by ranks in bitmaps, levels by keyed slot arrays.

Within each group (a language) leaves stand in the order of their ids. Their places are found without sorting them:
the ids of a group form a compressed bitmap of 64-bit words, of which only those with a bit set exist. Every task ORs
the words that it has seen, the words are merged by key, and a directory of popcounts says how many rows come before
each word. A leaf's place is a rank query: what its word's directory entry says, plus the bits below its own.

Nodes are then filed under (group, place / 8) into arrays of eight slots, whose digests are the nodes of the next level,
and so on up to the group's root; the roots of the groups are reduced the same way. Paths are handed down from the root
by equi-joins of runs, an eighth of the leaves, with their parents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.ranks import ordinals, running_totals, tie_offsets
from tidemark.llm.store import small_or_shuffled, stored
from tidemark.operators.sizes import fits_broadcast

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The word of rows without an id; real words have 58 bits.
NO_ID = -(1 << 63)
_PATH = "array<struct<slots:array<string>,at:int>>"


def digest(text: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of a row: each value as its byte count, a colon and its text, or ``-`` for null, one after the other."""
    told = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return digest(F.concat(*told))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings on a path, level by level, from left to right."""
    others = F.transform(path, lambda e: F.filter(e["slots"], lambda _, i: i != e["at"]))
    return digest(F.array_join(F.flatten(others), ""))


def fold(start: Column, path: Column) -> Column:
    """The root that follows from a leaf's digest and the siblings on its path."""

    def up(node: Column, e: Column) -> Column:
        return digest(F.array_join(F.transform(e["slots"], lambda s, i: F.when(i == e["at"], node).otherwise(s)), ""))

    return F.aggregate(path, start, up)


def _slots(value: Column) -> Column:
    """The values of a run in the order of their places."""
    return F.transform(F.array_sort(F.collect_list(F.struct("pos", value.alias("value")))), lambda s: s["value"])


def _reduce(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """From nodes ``g, pos, n, hash`` (n: nodes of the group on this level) the runs of each level and each group's root.

    Nodes come out of slot arrays, so a run of eight is the largest group; each level has an eighth of the rows.
    """
    runs, roots = [], []
    while True:
        roots.append(nodes.where("n = 1").select("g", "hash"))
        level = stored(nodes.where("n > 1").groupBy("g", "n", F.shiftright("pos", 3).alias("run")).agg(_slots(F.col("hash")).alias("slots")), "runs")
        if level.isEmpty():
            break
        runs.append(level)
        nodes = _parents(level)
    out = roots[0]
    for more in roots[1:]:
        out = out.union(more)
    return runs, out


def _parents(runs: DataFrame) -> DataFrame:
    """The nodes that runs become on the next level."""
    count = F.shiftright(F.col("n") + (FAN - 1), 3)
    return runs.select("g", F.col("run").alias("pos"), count.alias("n"), digest(F.array_join("slots", "")).alias("hash"))


def _paths(runs: list[DataFrame], above: DataFrame | None) -> DataFrame | None:
    """Of every run of the lowest level the path ``up`` above its parent node. ``above``: ``g, path`` above the group's root,
    if there is anything above it."""
    lower = None
    for level in reversed(runs):
        top = level.where(F.col("n") <= FAN)
        top = top.withColumn("up", F.array().cast(_PATH)) if above is None else top.join(above, "g").withColumnRenamed("path", "up")
        if lower is not None:
            parents = lower.select("g", F.col("run").alias("_run"), F.col("slots").alias("_slots"), F.col("up").alias("_up"))
            rest = level.where(F.col("n") > FAN).withColumn("_run", F.shiftright("run", 3)).join(parents, ["g", "_run"])
            step = F.struct(F.col("_slots").alias("slots"), F.col("run").bitwiseAND(F.lit(FAN - 1)).cast("int").alias("at"))
            top = top.union(rest.withColumn("up", F.concat(F.array(step), "_up")).select(top.columns))
        lower = top
    return lower


def _placed(rows: DataFrame) -> DataFrame:
    """Rows ``g, word, bit, tie, row`` with their place ``pos`` in the group."""
    bits = F.bit_or(F.expr("shiftleft(1L, bit)"))
    words = stored(rows.groupBy("g", "word").agg(bits.alias("bits"), F.count("*").alias("n")), "id-bitmaps")
    ranked = running_totals(words.withColumn("key", F.expr(f"nullif(word, {NO_ID}L)")), ["g"], "key", "n")
    directory = ranked.select("g", "word", "bits", F.col("before").alias("start"))
    crowded = words.where(F.col("n") > F.bit_count("bits")).select("g", "word")
    extra = F.lit(0).cast("long")
    if not crowded.isEmpty():
        tied = rows.join(small_or_shuffled(crowded), ["g", "word"])
        repeated = stored(tied.groupBy("g", "word", "bit").agg(F.count("*").alias("k")).where("k > 1"), "repeated-ids")
        surplus = F.collect_list(F.struct("bit", (F.col("k") - 1).alias("k"))).alias("surplus")
        directory = directory.join(repeated.groupBy("g", "word").agg(surplus), ["g", "word"], "left")
        below = F.filter("surplus", lambda s: s["bit"] < F.col("bit"))
        extra = F.coalesce(F.aggregate(below, F.lit(0).cast("long"), lambda a, s: a + s["k"]), F.lit(0))
        places = repeated.select("g", "word", "bit")
        own = stored(tied.join(small_or_shuffled(places), ["g", "word", "bit"]).select("g", "word", "bit", "tie", "row"), "tied-rows")
        offsets = stored(tie_offsets(own, ["g", "word", "bit"], ["tie", "row"]).select("row", "offset"), "offsets")
        rows = rows.join(small_or_shuffled(offsets), "row", "left").withColumn("offset", F.coalesce("offset", F.lit(0)))
    else:
        rows = rows.withColumn("offset", F.lit(0).cast("long"))
    below = F.bit_count(F.expr("bits & ~shiftleft(-1L, bit)"))
    joined = rows.join(small_or_shuffled(stored(directory, "directory")), ["g", "word"])
    return joined.withColumn("pos", F.col("start") + below + extra + F.col("offset"))


def merkle_manifest(
    docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: Sequence[str] = FIELDS, claim: Column | None = None
) -> DataFrame:
    """One row per document: ``id_col, position, leaf, claim, subroot, root, path``.

    ``leaf`` is :func:`leaf_digest` of ``fields``, ``position`` the leaf's place in its group, ``path`` the runs from the leaf
    up to the root as ``slots`` (digests) and ``at`` (the own place among them), which :func:`proof_digest` and :func:`fold`
    read. ``claim`` is a digest to check later against the path, computed from the row while its text is at hand (null:
    none, as without it). Levels of one node are not hashed again: a group's only leaf is its subroot.

    Nulls and ties: a null group is a group of its own and comes first; groups follow in bytewise order. Rows without an
    id come first in their group. Rows of one group that share an id stand in the order of their leaves; equal rows have
    consecutive places, in any order. An empty table gives an empty manifest. Ids are integers. Columns other than
    the named ones are not read, so names cannot clash.

    Plan: texts are read once; from then on rows have a few dozen bytes and two digests. Rows are joined with the bitmaps
    (broadcast if counted to be small) and shuffled once into runs; groups and ids of any size are spread over all tasks.
    """
    leaf = leaf_digest([F.col(c) for c in fields])
    word = F.coalesce(F.shiftright(F.col(id_col).cast("long"), 6), F.lit(NO_ID))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("group"),
        word.alias("word"),
        F.coalesce(F.col(id_col).cast("long").bitwiseAND(F.lit(63)), F.lit(0)).cast("int").alias("bit"),
        leaf.alias("leaf"),
        (F.lit(None).cast("string") if claim is None else claim).alias("claim"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stored(rows, "leaves")
    groups = stored(ordinals(rows.groupBy("group").agg(F.count("*").alias("n")), "group", "g"), "groups")
    known = groups.select("group", "g", "n")
    rows = rows.join(F.broadcast(known) if fits_broadcast(known) else known, "group")
    rows = rows.withColumn("tie", F.conv(F.substring("leaf", 1, 15), 16, 10).cast("long"))
    placed = _placed(rows.drop("group")).select("g", "n", "pos", "id", "leaf", "claim")

    member = F.struct("pos", "leaf", "id", "claim")
    leaves = placed.groupBy("g", "n", F.shiftright("pos", 3).alias("run")).agg(F.array_sort(F.collect_list(member)).alias("members"))
    leaves = stored(leaves.withColumn("slots", F.transform("members", lambda m: m["leaf"])), "runs")
    single = leaves.where("n = 1").select("g", F.col("slots")[0].alias("hash"))
    upper, roots = _reduce(_parents(leaves.where("n > 1")))
    subroots = stored(single.union(roots), "subroots")

    told = subroots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("pos"), F.lit(groups.count()).cast("long").alias("n"), "hash")
    runs, root = _reduce(told)
    none = F.array().cast(_PATH)
    heads = subroots.withColumnRenamed("hash", "subroot")
    if runs:
        paths = _paths(runs, None).select(F.col("run").alias("_run"), "slots", "up")
        step = F.struct("slots", F.col("g").bitwiseAND(F.lit(FAN - 1)).cast("int").alias("at"))
        heads = heads.withColumn("_run", F.shiftright("g", 3)).join(paths, "_run").select("g", "subroot", F.concat(F.array(step), "up").cast(_PATH).alias("path"))
    else:
        heads = heads.withColumn("path", none)
    heads = stored(heads, "group-paths")

    paths = _paths([leaves, *upper], heads.select("g", "path"))
    top = root.select("hash").first()
    named = heads.select("g", "subroot")
    found = paths.join(F.broadcast(named) if fits_broadcast(named) else named, "g")
    each = found.select("n", "slots", "up", "subroot", F.lit(top[0] if top else None).cast("string").alias("root"), F.explode("members").alias("m"))
    step = F.struct("slots", F.col("m.pos").bitwiseAND(F.lit(FAN - 1)).cast("int").alias("at"))
    path = F.when(F.col("n") > 1, F.concat(F.array(step), "up")).otherwise(F.col("up"))
    return each.select(
        F.col("m.id").alias(id_col), F.col("m.pos").alias("position"), F.col("m.leaf").alias("leaf"), F.col("m.claim").alias("claim"), "subroot", "root", path.alias("path")
    )
