"""URL filter: listed hosts and paths first, gradient-boosted trees on lexical features for all other URLs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.store import BROADCAST_ROWS, stored

#: Labelled URLs that training reads at most (in expectation; picked by a hash of the URL).
TRAIN_URLS = 50_000
#: Statistics of one kind of suffix are sent to all executors only if their suffixes were measured to have at most so many bytes.
BROADCAST_BYTES = 16 << 20
#: Suffixes of more URLs than this are hot: their statistics are sent to all executors.
HOT_ROWS = 100_000
#: Labelled URLs of overall rate that each suffix starts with.
SMOOTHING = 5.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``host/path`` and its verdict; it fits the host, its subdomains, and paths that start with its path."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as text; null if none does."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.lit(rule.text)).otherwise(chosen)
    return chosen


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Numbers that depend on the characters of the URL alone; all are 0 for a null or empty one."""
    url = F.coalesce(url, F.lit(""))
    length = F.length(url)
    digits = length - F.length(F.regexp_replace(url, "[0-9]", ""))
    counts = F.transform(F.array_distinct(F.split(url, "")), lambda c: F.length(url) - F.length(F.replace(url, c, F.lit(""))))
    share = F.transform(F.filter(counts, lambda n: n > 0), lambda n: n / length)
    entropy = F.aggregate(share, F.lit(0.0), lambda total, p: total - p * F.log2(p))
    columns = {
        "url_length": length,
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": _count(path, "/"),
        "labels": _count(host, "."),
        "digit_ratio": digits / F.greatest(length, F.lit(1)),
        "entropy": entropy,
        "parameters": _count(url, "="),
        "fragments": _count(url, "#"),
        "hyphens": _count(url, "-"),
        "secure": url.startswith("https://").cast("int"),
        "page_file": F.coalesce(path.rlike(r"\.[a-z0-9]{1,5}$"), F.lit(False)).cast("int"),
    }
    return {name: F.coalesce(column.cast("double"), F.lit(0.0)) for name, column in columns.items()}


@dataclass
class UrlModel:
    """``trees`` is None if the labelled URLs were not of both verdicts; ``base`` then decides."""

    trees: GBTClassificationModel | None
    suffixes: DataFrame
    base: float


def _suffixes(host: Column) -> dict[str, Column]:
    return {"top": F.substring_index(host, ".", -1), "site": F.substring_index(host, ".", -2)}


def _shuffled_join(rows: DataFrame, names: DataFrame, known: DataFrame, name: str) -> DataFrame:
    """Left join of ``known`` by ``name``; the few hot names are broadcast, and their rows dealt over all partitions."""
    told = [f"{name}_rate", f"{name}_seen"]
    hot = names.groupBy(name).count().where(F.col("count") > HOT_ROWS).join(known, name, "left")
    hot = stored(hot.select(name, *[F.col(c).alias(f"_hot_{c}") for c in told], F.lit(True).alias("_hot")), "hot-suffixes")
    # No host holds a slash, so the keys of hot rows match nothing.
    key = F.when(F.col("_hot"), F.concat(F.lit("/"), F.monotonically_increasing_id().cast("string"))).otherwise(F.col(name))
    rows = rows.join(F.broadcast(hot), name, "left").withColumn("_key", key).join(known.withColumnRenamed(name, "_key"), "_key", "left")
    return rows.withColumns({c: F.coalesce(f"_hot_{c}", c) for c in told}).drop("_key", "_hot", *[f"_hot_{c}" for c in told])


def _with_features(pages: DataFrame, suffixes: DataFrame, base: float) -> DataFrame:
    rows = pages.withColumns(lexical_features(F.col("_url"), F.col("host"), F.col("path"))).withColumns(_suffixes(F.col("host")))
    sizes = suffixes.groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.octet_length("suffix")).alias("bytes")).collect()
    small = {r["kind"] for r in sizes if r["n"] <= BROADCAST_ROWS and r["bytes"] <= BROADCAST_BYTES}
    for name in ("top", "site"):
        known = suffixes.where(F.col("kind") == name).select(F.col("suffix").alias(name), F.col("rate").alias(f"{name}_rate"), F.col("seen").alias(f"{name}_seen"))
        if name in small:
            rows = rows.join(F.broadcast(known), name, "left")
        else:
            rows = _shuffled_join(rows, pages.select(_suffixes(F.col("host"))[name].alias(name)), known, name)
        rows = rows.fillna({f"{name}_rate": base, f"{name}_seen": 0.0})
    inputs = [*lexical_features(F.col("_url"), F.col("host"), F.col("path")), "top_rate", "top_seen", "site_rate", "site_seen"]
    return VectorAssembler(inputCols=inputs, outputCol="_features", handleInvalid="keep").transform(rows)


def train(labelled: DataFrame, max_urls: int = TRAIN_URLS, seed: int = 7) -> UrlModel:
    """Fit trees on ``_url, host, path, label`` (1: block). Suffix statistics count all labelled URLs."""
    spark = labelled.sparkSession
    totals = labelled.agg(F.count("*").alias("n"), F.avg("label").alias("rate")).first()
    base = 0.0 if totals["rate"] is None else float(totals["rate"])
    pairs = labelled.select("label", F.explode(F.create_map(*[x for k, c in _suffixes(F.col("host")).items() for x in (F.lit(k), c)])).alias("kind", "suffix"))
    rates = pairs.groupBy("kind", "suffix").agg(F.count("*").alias("n"), F.sum("label").alias("k"))
    rates = rates.select("kind", "suffix", ((F.col("k") + SMOOTHING * base) / (F.col("n") + SMOOTHING)).alias("rate"), F.log1p("n").alias("seen"))
    suffixes = stored(rates, "suffixes")
    if base in (0.0, 1.0):
        return UrlModel(None, suffixes, base)
    share = min(1.0, max_urls / totals["n"])
    few = labelled.where(F.pmod(F.xxhash64("_url"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = stored(_with_features(few, suffixes, base).select("_features", F.col("label").cast("double").alias("label")), "labelled-urls")
    trees = GBTClassifier(featuresCol="_features", labelCol="label", maxIter=12, maxDepth=3, maxBins=32, stepSize=0.3, seed=seed)
    return UrlModel(trees.fit(sample) if len(sample.select("label").distinct().take(2)) == 2 else None, suffixes, base)


def filter_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """``id_col, host, path, rule, verdict, p_block``: a rule's verdict where one fits, else the trees'.

    The URLs that rules fit are the labelled ones, and trees learn from them. Nulls and ties: a null URL, or one without
    ``://``, has an empty host and path, fits no rule and is judged by the trees. Rows are judged one by one, so repeated
    rows and null ids are kept as they are. If rules fit no URL, or only give one verdict, the trees cannot be trained:
    all other URLs then get that verdict, or allow if there is none. Only the named columns are read.
    """
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"))
    rows = rows.withColumn("host", host_of(F.col("_url"))).withColumn("path", path_of(F.col("_url")))
    rows = stored(rows.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules)), "urls")
    verdicts = F.create_map(*[F.lit(x) for r in rules for x in (r.text, r.verdict)]) if rules else F.create_map().cast("map<string,string>")
    labelled = rows.where(F.col("rule").isNotNull()).withColumn("label", (verdicts[F.col("rule")] == "block").cast("int"))
    model = train(labelled.select("_url", "host", "path", "label"))
    if model.trees is None:
        judged = rows.withColumn("p_block", F.lit(model.base))
    else:
        judged = model.trees.transform(_with_features(rows, model.suffixes, model.base)).withColumn("p_block", vector_to_array("probability")[1])
    by_trees = F.when(F.col("p_block") >= threshold, "block").otherwise("allow")
    return judged.select(F.col("_id").alias(id_col), "host", "path", "rule", F.coalesce(verdicts[F.col("rule")], by_trees).alias("verdict"), "p_block")
