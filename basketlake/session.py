"""Session settings and the shared scratch area."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Spark's setting that removes the shuffle files of a query when it ends (4.1; earlier versions ignore it).
SHUFFLE_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's limit, in bytes, for a generated method that holds a whole stage. The JVM leaves methods above 8,000 to its
#: interpreter, so beyond that operators with methods of their own are faster; Spark's default is 65,535.
METHOD_LIMIT_KEY, METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit", "8000"


def build_session(app: str = "basketlake", cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster use the session you are given."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder the cluster names.

    Where none is set, a local session gets a temporary one; on a cluster, whose machines do not share local folders,
    that is an error.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="basketlake-")
        spark.conf.set(CHECKPOINT_KEY, root)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def without_leftovers(spark: SparkSession):
    """Writes inside remove their shuffle files at their end, not when the driver happens to collect garbage."""
    return _setting(spark, SHUFFLE_CLEANUP_KEY, "true")


def compiled(spark: SparkSession):
    """In writes inside, stages too long for the JVM to compile run operator by operator."""
    return _setting(spark, METHOD_LIMIT_KEY, METHOD_LIMIT)


def stored(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The frame as a table in the scratch area: computed once, with a short plan for what follows.

    What follows reads the table only, so the shuffle files of the write are of no use after it. `by` names last columns
    that become folders.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    with without_leftovers(spark):
        df.write.partitionBy(*by).option("compression", "zstd" if by else "snappy").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables; only for those of which everything that reads them is written."""
    for table in tables:
        spark = table.sparkSession
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
