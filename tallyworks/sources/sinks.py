"""Writers of published outputs, and the saved results that later runs revise."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyworks import constants as c
from tallyworks.functions.expressions import is_in


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """One output as a folder of CSV parts, written by all tasks."""
    df.write.mode("errorifexists").option("header", header).csv(path)


def folder_name(name: str) -> str:
    return name.lower().replace(" ", "_")


def write_by_period(df: DataFrame, path: str, header: bool = False) -> None:
    """One folder per month, in files of even size.

    Rows of a month are gathered to keep files few, but a month that is too large for one
    task is split over several.
    """
    (df.withColumn("_period", F.col(c.PERIOD)).hint("rebalance", F.col("_period"))
     .write.mode("errorifexists").option("header", header)
     .partitionBy("_period").csv(path))


def write_colon_by_month(df: DataFrame, columns, path: str, prefix: str) -> None:
    """Frame rows in the colon format, one folder per month named by ``prefix`` and month.

    Positions without a column in ``df`` stay blank.
    """
    fields = [F.col(f"`{name}`").cast("string") if name in df.columns
              else F.lit(" ") for name in columns]
    (df.select(*[field.alias(f"_c{i}") for i, field in enumerate(fields)],
               F.concat(F.lit(prefix), F.col(c.PERIOD).cast("string")).alias("frame"))
     .write.mode("errorifexists").partitionBy("frame").option("sep", ":").option("quote", "")
     .csv(path))


def month_folder(path: str, month: int) -> str:
    return f"{path}/{c.PERIOD}={month}"


def revise_months(df: DataFrame, path: str, months: Iterable[int]) -> None:
    """Put the rows of ``df`` in place of ``months`` in the results saved under ``path``.

    Results lie in a folder per month.  Only the folders of ``months`` are replaced, when all
    rows are written; other months are not read or touched, and a run that is repeated, or was
    broken off, leaves the same files behind.  A month without rows any more is emptied.
    A row of a month that is not named raises.  ``path`` is made if it is not there.
    """
    months = sorted(set(months))
    here = F.when(is_in(c.PERIOD, months), F.col(c.PERIOD)).otherwise(F.raise_error(F.concat(
        F.lit("row of a month that is not revised: "),
        F.coalesce(F.col(c.PERIOD).cast("string"), F.lit("none")))).cast("int"))
    seen = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path
    (df.withColumn(c.PERIOD, here.cast("int")).hint("rebalance", F.col(c.PERIOD))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(c.PERIOD).parquet(path))
    held = {row[0] for row in df.select(c.PERIOD).distinct().collect()}
    files = seen(path).getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    for month in months:
        if month not in held:
            files.delete(seen(month_folder(path, month)), True)


def read_months(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Saved results of all months, in the order of ``columns``.  A filter on the month opens
    the folders of those months alone."""
    saved = spark.read.parquet(path)
    saved = saved.withColumn(c.PERIOD, F.col(c.PERIOD).cast("int"))
    return saved if columns is None else saved.select(*columns)
