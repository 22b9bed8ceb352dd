"""Every registered output as it lies in its files, cell by cell against what was computed."""

from __future__ import annotations

from pyspark.sql import functions as F
from tallyworks.plans import additional
from tallyworks.plans.catalog import S, _thousands
from tallyworks.sources import order_survey as survey

SF_DIR = "/root/testdata/sf0.001"


def test_written_cells(spark, tmp_path):
    entries = additional.registry(S, additional.OutputOptions(repair_output=True),
                                  survey.local_units(spark, SF_DIR))
    results = _thousands(spark, SF_DIR)
    computed = additional.compute_outputs(results, entries)
    written = additional.write_outputs(results, entries, str(tmp_path / "main"),
                                       str(tmp_path / "replication"))
    assert set(written) == set(computed) == set(entries)
    for name, df in computed.items():
        files = spark.read.option("recursiveFileLookup", True).option(
            "header", entries[name].header).schema(
            ", ".join(f"_{i} string" for i in range(len(df.columns)))).option(
            "enforceSchema", True).csv(written[name])
        cells = df.toDF(*files.columns).select(
            *[F.nullif(F.col(x).cast("string"), F.lit("")).alias(x) for x in files.columns])
        assert files.count() > 0, name
        assert files.exceptAll(cells).isEmpty() and cells.exceptAll(files).isEmpty(), name
