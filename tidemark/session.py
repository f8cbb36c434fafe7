"""Session settings and the shared folder used for checkpoints and state."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, else one below the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_tidemark"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unique path below :func:`shared_root`."""
    return f"{shared_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def no_rows(spark: SparkSession, schema: str) -> DataFrame:
    """An empty table that the optimiser sees to be empty; one made from a list is a job with Python workers."""
    fields = T.StructType.fromDDL(schema)
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields]).where(F.lit(False))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any file system that Spark reads."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """Write a few bytes as one file, without a job; the file appears whole or not at all."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, partial = hadoop.Path(path), hadoop.Path(f"{path}.{uuid.uuid4().hex}")
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = system.create(partial, True)
    out.write(bytearray(text.encode()))
    out.close()
    system.delete(target, False)
    if not system.rename(partial, target):
        raise OSError(f"cannot write {path}")


def read_note(spark: SparkSession, path: str) -> str | None:
    """What :func:`write_note` wrote; None if there is no such file."""
    if not path_exists(spark, path):
        return None
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    source = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
