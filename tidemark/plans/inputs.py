"""The driver tables seen as the inputs of the jobs: logs, change records, configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.time import ntz_to_epoch_ms


def table(spark: SparkSession, sf_dir: str, name: str, stream: bool = False) -> DataFrame:
    batch = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if not stream:
        return batch
    # A file stream takes a folder, not a single file.
    return spark.readStream.schema(batch.schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


#: Rows of one task that writes or parses text.
TASK_ROWS = 250_000


def _spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over all cores, and over more tasks than that if there are many.

    Writing and parsing text is costly per row. A split of a file says little about its rows: a Parquet row group, of
    any length, goes to one split, and the others of the file stay empty. The rows are few columns without text yet.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // TASK_ROWS)))


def _counter() -> F.Column:
    return F.get_json_object("props", "$.k").cast("int")


def _events(spark: SparkSession, sf_dir: str, stream: bool) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events", stream).select(
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("mid"),
        ntz_to_epoch_ms("ts").alias("ts"),
        F.when(_counter() % 2 == 0, "1").otherwise("0").alias("is_new"),
        F.when(kind == "view", None).when(kind == "click", "").otherwise(kind).alias("last_page_id"),
        "event_type",
        _counter().alias("k"),
    )


def log_view(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """``events`` as parsed page logs: ``seq, mid, ts, is_new, last_page_id``."""
    return _events(spark, sf_dir, stream).drop("event_type", "k")


def raw_log(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """``events`` as raw log text (``seq, value``).

    Errors carry ``err`` (and ``start`` when the counter is odd), sign-ups
    ``start``; the rest are pages with ``k % 3`` actions and ``k % 2``
    displays. Purchases with a counter of 90 or more are cut off, hence dirty.
    """
    k, kind = F.col("k"), F.col("event_type")
    is_page = ~kind.isin("error", "signup")
    indexes = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    actions = F.transform(indexes(k % 3), lambda i: F.struct(F.concat(F.lit("a"), i).alias("action_id")))
    displays = F.transform(indexes(k % 2), lambda i: F.struct(k.alias("item"), (i + 1).alias("order")))
    record = F.struct(
        F.struct(F.col("mid").cast("string").alias("mid"), "is_new").alias("common"),
        F.when(is_page, F.struct(kind.alias("page_id"), "last_page_id")).alias("page"),
        F.when(kind == "error", F.struct(k.alias("code"))).alias("err"),
        F.when((kind == "signup") | ((kind == "error") & (k % 2 == 1)), F.struct(k.alias("entry"))).alias("start"),
        F.when(is_page, actions).alias("actions"),
        F.when(is_page, displays).alias("displays"),
        "ts",
    )
    text = F.to_json(record)
    broken = (kind == "purchase") & (k >= 90)
    value = F.when(broken, F.substring(text, F.lit(1), F.length(text) - 2)).otherwise(text)
    return _spread(_events(spark, sf_dir, stream)).select("seq", value.alias("value"))


def raw_changes(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """``orders`` as database change text (``seq, value``), one source table per status."""
    kind = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "insert")
        .when(F.col("o_orderpriority") == "2-HIGH", "update")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "bootstrap-start")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "delete")
        .otherwise("bootstrap-insert")
    )
    data = F.struct(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("last_order"), F.col("o_totalprice").alias("price")
    )
    record = F.struct(
        F.when(F.col("o_totalprice") > 100000, "shop").otherwise("archive").alias("database"),
        F.concat(F.lit("orders_"), F.lower("o_orderstatus")).alias("table"),
        kind.alias("type"),
        data.alias("data"),
    )
    return _spread(table(spark, sf_dir, "orders", stream)).select(
        F.col("o_orderkey").alias("seq"), F.to_json(record).alias("value")
    )


def raw_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``nation`` as configuration change text (``seq, value``): 25 changes of three source tables."""
    n = F.col("n_nationkey")
    source = F.concat(F.lit("orders_"), F.element_at(F.array(F.lit("f"), F.lit("o"), F.lit("p")), n % 3 + 1))
    settings = F.struct(
        source.alias("source_table"),
        F.concat(F.lit("dim_"), F.lower("n_name")).alias("sink_table"),
        F.when(n % 2 == 0, "id,price").otherwise("id,last_order,price").alias("sink_columns"),
        F.lit("id").alias("sink_primary_key"),
    )
    deleted = n % 7 == 6
    record = F.struct(
        F.when(deleted, "d").when(n < 3, "c").otherwise("u").alias("op"),
        F.when(deleted, settings).alias("before"),
        F.when(~deleted, settings).alias("after"),
    )
    return table(spark, sf_dir, "nation").select((n * 500).cast("bigint").alias("seq"), F.to_json(record).alias("value"))
