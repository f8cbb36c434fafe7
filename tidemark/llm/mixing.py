"""Mixing sources to target weights by Efraimidis-Spirakis sampling, with DataFrame operations only.

Every source gets a budget of words. As many complete epochs as fit are taken first; the rest of the budget is a weighted
sample without replacement: each document draws an exponential key at the rate of its quality, documents are ordered
by key within their source, and the prefix sums of their sizes are filled up to the budget.

A source may hold any share of the rows, so its order is found in two steps. The logarithm of an exponential variable of
any rate has a density of at most 1/e, which gives bins of a bounded number of rows; bins are summed and added up by a
radix directory, and rows are only sorted within their bin.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.ranks import ordinals, running_totals
from tidemark.llm.store import small_or_shuffled, stored
from tidemark.operators.sizes import fits_broadcast, lookup_join

#: Documents expected in the fullest bin.
BIN_ROWS = 2_000
WORD = r"[^\x20\x09-\x0D]+"
#: Digits, punctuation and other marks of ASCII.
MARK = r"[!-@\[-`{-~]"
#: Copies that one row is spread into at a time.
COPIES = 1 << 16


def plain_prose(text: Column) -> Column:
    """A quality weight between 0.1 and 1: the square of the share of characters that are neither digits nor ASCII marks."""
    share = 1 - F.regexp_count(text, F.lit(MARK)) / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.lit(0.1).cast("double"), share * share)


def uniform(seed: str, doc: Column, text: Column) -> Column:
    """A number strictly between 0 and 1 that depends on the seed, the id and the text alone."""
    drawn = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc.cast("string"), F.lit("-")), F.lit(":"), F.md5(text.cast("binary"))).cast("binary"))
    return (F.conv(F.substring(drawn, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def share_targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Add ``target`` to ``ordinal, source_size``: ``share`` of all sizes, dealt out by weight.

    Weights repeat in the order of the sources. No target exceeds ``most`` times its source's size; what is over is dealt
    out again by weight among the others until none is above. Each round is one sum over the sources, which gives the
    driver three numbers; rounds are as many as sets of sources that reach their limit together.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("ordinal") % len(weights) + 1).cast("int"))
    sources = stored(sources.withColumns({"weight": weight, "limit": F.col("source_size") * F.lit(float(most))}), "sources")
    goal = share * float(sources.agg(F.sum("source_size")).first()[0] or 0)
    left, over, full = goal, float(sources.agg(F.sum("weight")).first()[0] or 1), -1
    while True:
        dealt = F.col("weight") * F.lit(left) / F.lit(over)
        filled = dealt >= F.col("limit")
        row = sources.agg(
            F.count_if(filled).alias("full"),
            F.sum(F.when(filled, F.col("limit"))).alias("taken"),
            F.sum(F.when(~filled, F.col("weight"))).alias("weight"),
        ).first()
        if row["full"] == full or not row["weight"]:
            return sources.withColumn("target", F.least(dealt, "limit")).drop("weight", "limit")
        full, left, over = row["full"], goal - (row["taken"] or 0.0), row["weight"]


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    quality: Column | None = None,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: ``id_col, source, size, source_size, target, epochs, key, taken``.

    ``size`` is the number of words, ``target`` the words wanted of the source (:func:`share_targets`, sources in code
    point order, null last), ``taken`` the words that the mix takes of the document, repeats counted: ``epochs`` times its
    size, and its size once more if it is among the smallest keys that fill the rest of the budget. The one document
    at the edge of the budget is taken in part, so the words taken of a source are its target rounded. ``quality`` is
    a positive weight for each row (default :func:`plain_prose`); of two documents, the one with twice the weight is
    drawn as if it had two chances.

    Nulls and ties: null texts have no words, and nothing is taken of them. Null sources are one source. Null ids draw by
    their text. Equal keys are ordered by id (null first) and text. Equal rows share a key and come back as often as
    they are given; they are counted before the shuffle, so a row repeated without end stays one row until the last step.
    An empty table gives an empty mix. Columns other than the named ones are not read. The result depends on
    the rows alone: neither their order nor the partitions matter.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rate = plain_prose(text) if quality is None else quality
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("~")).alias("s"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        (-F.log(uniform(seed, F.col(id_col), text)) / rate).alias("key"),
        F.md5(text.cast("binary")).alias("digest"),
    )
    units = stored(rows.groupBy("s", "id", "size", "key", "digest").agg(F.count("*").alias("copies")), "units")
    words = F.col("size") * F.col("copies")
    sizes = stored(units.groupBy("s").agg(F.sum(words).alias("source_size"), F.count("*").alias("units")), "source-sizes")
    sources = stored(share_targets(ordinals(sizes, "s"), weights, share, most), "targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = sources.withColumn("epochs", whole)
    sources = sources.withColumn("budget", F.round("target").cast("long") - F.col("epochs") * F.col("source_size"))
    sources = stored(sources.drop("ordinal"), "budgets")

    if fits_broadcast(sources):
        units = units.join(F.broadcast(sources), "s")
    else:
        units = lookup_join(units, sources, "s", "digest")
    bins = F.floor(F.log("key") * F.col("units") / F.lit(math.e * BIN_ROWS)).cast("long")
    units = stored(units.withColumn("bin", bins).drop("units"), "keyed-units")
    counted = stored(units.groupBy("s", "bin").agg(F.sum(words).alias("words")), "bins")
    starts = stored(running_totals(counted, ["s"], "bin", "words", "start").drop("words"), "bin-starts")
    units = units.join(small_or_shuffled(starts), ["s", "bin"])
    order = Window.partitionBy("s", "bin").orderBy("key", "id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    units = units.withColumn("before", F.col("start") + F.coalesce(F.sum(words).over(order), F.lit(0)))

    again = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long")))
    units = units.withColumn("first", again)
    units = units.withColumn("copy", F.explode(F.sequence("first", F.least(F.col("first") + (COPIES - 1), F.col("copies") - 1))))
    room = F.col("budget") - F.col("before") - F.col("copy") * F.col("size")
    taken = F.col("epochs") * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least("size", room))
    source = F.when(F.col("s") != "~", F.expr("substring(s, 2)"))
    return units.select(F.col("id").alias(id_col), source.alias(source_col), "size", "source_size", "target", "epochs", "key", taken.alias("taken"))
