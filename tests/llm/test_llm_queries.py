import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import decontam, jaccard, line_dedup, queries, quality


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    got = queries.QUERIES[name](spark, sf_dir)
    expected = duck.execute(queries.ORACLES[name]).df()
    frame = pd.DataFrame([tuple(r) for r in got.collect()], columns=got.columns)
    columns = sorted(frame.columns)
    text = lambda f: sorted(tuple("" if pd.isna(v) else str(int(v)) if isinstance(v, float) and v.is_integer() else str(v) for v in r) for r in f[columns].astype(object).itertuples(index=False))
    assert columns == sorted(expected.columns) and len(frame) > 0
    assert text(frame) == text(expected)


def test_pipeline_stages(spark, sf_dir):
    """Each stage against the rows that its operator's own result names."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    wanted = documents.columns
    docs = documents.where("doc_id < 400")
    by_name = dict(corpus_pipeline.STAGES)
    ids = lambda f: {r[0] for r in f.select("doc_id").collect()}

    good = by_name["quality"](spark, docs, sf_dir)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert ids(good) == ids(quality.score_texts(docs, model).where(F.col("_score") >= 0.7)) and good.columns == wanted

    lines = by_name["line_dedup"](spark, good, sf_dir)
    assert lines.columns == wanted and {tuple(r) for r in lines.select("doc_id", "text").collect()} == {
        tuple(r) for r in line_dedup.dedup_lines(good).select("doc_id", "text").collect()
    }
    assert lines.where(F.length("text") != F.col("n_chars")).isEmpty()

    once = by_name["ngram_jaccard"](spark, lines.union(lines.limit(3)), sf_dir)
    found = jaccard.similar_documents(lines).collect()
    assert sorted(r[0] for r in once.select("doc_id").collect()) == sorted({r["component_id"] for r in found}) and once.columns == wanted

    clean = by_name["decontamination"](spark, once, sf_dir)
    judged = queries.contamination_columns(decontam.contamination(once, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))
    assert ids(clean) == ids(judged.where("NOT contaminated")) and clean.columns == wanted

    tokens = by_name["bpe"](spark, clean, sf_dir).collect()
    assert {r["doc_id"] for r in tokens} == ids(clean) and all(4 * r["n_tokens"] == len(r["ids"]) for r in tokens)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def folder(spark, tmp_path):
    """A folder whose labels and benchmark are given."""

    def build(labels=(), benchmark=()):
        spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
        spark.createDataFrame(list(benchmark), "item_id long, text string").write.mode("overwrite").parquet(f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)

    return build


def test_pipeline_of_odd_rows(spark, folder):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (None, "", "en", "s", 0), (None, None, None, None, None), (2, "a b c d e f", "en", "s", 11), (2, "a b c d e f", "en", "s", 11)], DOCS
    )
    path = folder()
    for rows, left in ((docs, [None, None, 1, 2]), (docs.limit(0), [])):
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, path)
        assert sorted((r["doc_id"] for r in rows.collect()), key=str) == sorted(left, key=str)


def test_a_null_row_is_not_taken_for_document_42(spark, folder):
    path = folder(benchmark=[(1, "one two three four five")])
    docs = spark.createDataFrame([(42, "one two three four five", "en", "s", 1), (None, None, None, None, None), (None, "clean words", "en", "s", 1)], DOCS)
    kept = dict(corpus_pipeline.STAGES)["decontamination"](spark, docs, path).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in kept) == [(None, ""), (None, "clean words")]


def test_stages_keep_columns_of_any_name(spark, folder, rng):
    extra = ["n_lines", "n_dropped", "_drop", "_score", "_key", "row", "key", "_whole", "node", "component_id"]
    texts = [" ".join(rng.choice("abcdefgh" if i % 4 else "wxyz") * 3 for _ in range(30)) + f" {i}" for i in range(40)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS)
    docs = docs.withColumns({c: F.concat(F.lit(c), "doc_id") for c in extra})
    path = folder([(i, int(i % 4 > 0), 0) for i in range(40)] * 3, [(1, texts[3])])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in extra), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, path).count() == 40


def test_rows_of_one_id_and_several_texts(spark, folder):
    one, two = (" ".join(f"{c}{i}" for i in range(20)) for c in "ab")
    docs = spark.createDataFrame(
        [(7, one, "en", "s", 1), (7, two, "en", "s", 1), (7, two, "de", "t", 2), (9, one, "en", "s", 1), (8, "", "en", "s", 0), (8, "", "en", "s", 0), (None, two, "", "", 0)], DOCS
    )
    kept = dict(corpus_pipeline.STAGES)["ngram_jaccard"](spark, docs, folder()).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted([(7, one), (7, two), (8, ""), (0, two)])
