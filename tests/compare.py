"""Comparison of a Spark result with its SQL statement, cell by cell."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)) or hasattr(value, "as_tuple"):
        return float(value)
    return str(value)


def _rows(pdf) -> list[tuple]:
    names = sorted(pdf.columns)
    table = [tuple(_cell(None if pd.isna(v) else v) for v in row)
             for row in pdf[names].astype(object).itertuples(index=False)]
    return sorted(table, key=lambda row: tuple((v is None, str(type(v)), v) if v is not None
                                               else (True, "", 0) for v in row))


def difference(spark_df, con, sql: str) -> str | None:
    """None when both hold the same rows, else what differs."""
    mine, theirs = spark_df.toPandas(), con.execute(sql).df()
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(set(mine.columns) ^ set(theirs.columns))}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    a, b = _rows(mine), _rows(theirs)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        return f"{len(wrong)} of {len(a)} rows differ, e.g. {sorted(mine.columns)}\n" + "\n".join(
            f"  spark {x}\n  sql   {y}" for x, y in wrong[:3])
    return None
