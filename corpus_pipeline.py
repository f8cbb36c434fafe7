"""A training corpus from documents: filter, deduplicate, decontaminate, tokenise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, decontam, jaccard, line_dedup, quality
from tidemark.llm.queries import bpe_path, table
from tidemark.llm.store import small_or_shuffled, stored


def _packed(docs: DataFrame) -> Column:
    """All columns of a row as one, so that no name of theirs can clash with a name that a stage uses."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; a null text counts as an empty one, null ids and repeated rows are
    judged like others. Without labels of both classes nothing is rejected."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    if not model.trained:
        return docs
    # The text beside the other columns, not within: it goes to Python and back once.
    scored = quality.score_texts(docs.select(_packed(docs.drop("text")), F.col("text").alias("_whole")), model, text_col="_whole")
    kept = scored.where(F.col("_score") >= quality.THRESHOLD)
    return kept.select(*[(F.col("_whole") if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without repeated lines; their length is that of the text left. Null texts become empty, rows without an
    id keep all lines."""
    kept = line_dedup.dedup_lines(docs.select("doc_id", "text", _packed(docs)), keep=["row"])
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return kept.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the one with the smallest id; of repeated rows one. Rows without an id stay.

    Where rows share an id but not their text, all rows are numbered and the numbers compared instead.
    """
    repeated = stored(docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated-ids")
    if repeated.isEmpty():
        found = stored(jaccard.similar_documents(docs).where("doc_id <> component_id").select("doc_id"), "near-duplicates")
        return docs.join(small_or_shuffled(found), "doc_id", "left_anti").select(docs.columns)
    rows = stored(docs.select(_packed(docs), "doc_id", "text", F.monotonically_increasing_id().alias("node")), "numbered-rows")
    found = jaccard.similar_documents(rows.where("doc_id IS NOT NULL"), id_col="node").select("node", "component_id")
    found = stored(found.join(rows.select("node", "doc_id", F.xxhash64("text").alias("same")), "node"), "components")
    first = found.groupBy("component_id").agg(F.min(F.struct("doc_id", "node")).alias("first"))
    # Rows without words are components of their own: of equal ones one stays.
    single = found.groupBy("doc_id", "same").agg(F.min("node").alias("node"))
    stay = stored(first.select(F.col("first.node").alias("node")).join(single.select("node"), "node", "left_semi"), "first-rows")
    kept = rows.join(small_or_shuffled(stay), "node", "left_semi").select("row")
    return kept.union(rows.where("doc_id IS NULL").select("row")).select("row.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth lie in passages of the benchmark. The text alone decides, so rows are
    told apart by a digest of it, whatever their ids; a null text counts as an empty one."""
    keyed = docs.select(_packed(docs), "text", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("key"))
    found = decontam.contamination(keyed, table(spark, sf_dir, "benchmark"), id_col="key")
    bad = stored(found.where("n_hit > 0 AND 20 * n_hit >= n_words").select("key").distinct(), "contaminated")
    return keyed.join(small_or_shuffled(bad), "key", "left_anti").select("row.*")


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit numbers) and their decoded text's digest; a null text has none."""
    coded = bpe.encode_texts(docs, bpe_path(), keep=("doc_id", "lang", "source"))
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("bpe", token_stage),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder before the next.

    Nulls, repeated rows and further columns pass through as each stage says; an empty table gives an empty one.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
