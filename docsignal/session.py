"""Session helpers: the shared folder, and cutting lineage through it."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which driver and executors must share.

    Where it is unset, a folder in the session's warehouse, which they share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    return root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_docsignal"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner real sizes.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables as ``materialize`` returned them; nothing may read them afterwards."""
    for table in tables:
        jvm, files = table.sparkSession._jvm, table.inputFiles()
        if not files:
            continue
        folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(files[0])).getParent()
        if not re.search("-[0-9a-f]{32}$", folder.getName()):
            raise ValueError(f"{folder} was not written by materialize")
        folder.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def no_shuffles_left(spark: SparkSession) -> Iterator[None]:
    """Queries made and run inside leave no shuffle files behind.

    Otherwise these stay until the driver happens to collect its garbage; a fit of many passes
    would hold the sums of all of them on disk.
    """
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)
