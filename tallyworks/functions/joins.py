"""How tables that grow with the survey are joined."""

from __future__ import annotations

from pyspark.sql import DataFrame


def by_merge(df: DataFrame) -> DataFrame:
    """A table with a row per unit and month, for the right side of a join.

    Spark takes its size from the bytes of compressed files, or from the table its months were
    added to, and so may broadcast what the driver cannot hold.  It is sorted and merged instead,
    which spills to disk and takes nothing of the driver.
    """
    return df.hint("merge")


def by_partition(df: DataFrame) -> DataFrame:
    """A table of keys, or of keys and one value, that picks out some rows of the panel.

    It is never a broadcast either.  Each partition hashes its own share, which spares sorting
    the panel by the keys.
    """
    return df.hint("shuffle_hash")
