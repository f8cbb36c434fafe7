import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from tidemark.plans.checks import ORACLES
from tidemark.plans.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield con
    con.close()


def rows_of(frame):
    columns = sorted(frame.columns)
    rows = frame[columns].astype(object).where(frame[columns].notna(), None)
    return columns, sorted((tuple(map(str, r)) for r in rows.itertuples(index=False)))


def plain(frame):
    """Numbers that pandas widened because of NULLs back to integers."""
    for c in frame.columns:
        if frame[c].dtype.kind == "f" and frame[c].dropna().mod(1).eq(0).all():
            frame[c] = frame[c].astype("Int64")
    return frame


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    got = contract.queries()[name](spark, sf_dir)
    expected = duck.execute(contract.oracle_sql()[name]).df()
    frame = pd.DataFrame([tuple(r) for r in got.collect()], columns=got.columns)
    assert len(frame) == len(expected) > 0
    assert rows_of(plain(frame)) == rows_of(plain(expected))


def test_landed_triggers_have_a_file_for_each_core(spark):
    from pyspark.sql import functions as F
    from tidemark.plans.queries import _landed

    path, _, files = _landed(spark, spark.range(200_000).select(F.col("id").alias("seq")), 2)
    assert files == spark.sparkContext.defaultParallelism and spark.read.parquet(path).count() == 200_000
