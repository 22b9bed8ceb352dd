"""Tables kept in the folder that driver and executors share."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def chosen_folder(named: str | None, warehouse: str, master: str) -> str:
    """The named folder, else one in the warehouse.

    On a cluster a warehouse on the machine's own disk is another folder on every machine:
    then the folder has to be named.
    """
    if named:
        return named.rstrip("/")
    one_machine = master == "local" or master.startswith("local[")
    if not one_machine and re.match("(file:|/|(?![a-z0-9+.-]+:))", warehouse):
        raise ValueError(f"{CHECKPOINT_DIR} is not set, and {warehouse} is not shared by the "
                         f"machines of {master}")
    return f"{warehouse.rstrip('/')}/kept"


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in spark.checkpoint.dir, else one in its warehouse."""
    return chosen_folder(spark.conf.get(CHECKPOINT_DIR, None),
                         spark.conf.get("spark.sql.warehouse.dir"), spark.sparkContext.master)


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run, removed when the application ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return path


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write go when it ends.

    Otherwise they stay until the driver happens to collect its garbage, and those of all steps
    add up.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    That cuts the lineage, survives lost executors, and gives Spark the table's true size,
    by which it picks joins.  What the write shuffled is dropped at once.
    """
    path = f"{new_folder(df.sparkSession, name)}/table"
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
