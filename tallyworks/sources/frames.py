"""Sample frames, population frames, local units and parameter files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyworks import constants as c
from tallyworks.operators.staging import enforce_types
from tallyworks.settings import shift_period

# Columns of the frame files by position.
SAMPLE_COLUMNS = (
    "reference", "checkletter", "frosic2003", "rusic2003", "frosic2007", "rusic2007", "froempees",
    "employees", "froempment", "employment", "froFTEempt", "FTEempt", "frotover", "turnover",
    "entref", "wowentref", "vatref", "payeref", "crn", "live_lu", "live_vat", "live_paye",
    "legalstatus", "entrepmkr", "region", "birthdate", "entname1", "entname2", "entname3",
    "runame1", "runame2", "runame3", "ruaddr1", "ruaddr2", "ruaddr3", "ruaddr4", "ruaddr5",
    "rupostcode", "tradstyle1", "tradstyle2", "tradstyle3", "contact", "telephone", "fax",
    "seltype", "inclexcl", "cell_no", "formtype", "cso_tel", "currency",
)
POPULATION_COLUMNS = (
    "reference", "checkletter", "inqcode", "entref", "wowentref", "frosic2003", "rusic2003",
    "frosic2007", "rusic2007", "froempees", "employees", "froempment", "employment", "froFTEempt",
    "FTEempt", "frotover", "turnover", "entrepmkr", "legalstatus", "inqstop", "entzonemkr",
    "region", "live_lu", "live_vat", "live_paye", "immfoc", "ultfoc", "cell_no", "selmkr",
    "inclexcl",
)
LOCAL_UNIT_COLUMNS = (
    "ruref", "entref", "lu ref", "check letter", "sic03", "sic07", "employees", "employment",
    "fte", "Name1", "Name2", "Name3", "Address1", "Address2", "Address3", "Address4",
    "Address5", "Postcode", "trading as 1", "trading as 2", "trading as 3", "region",
)

SAMPLE_KEEP = (c.REFERENCE, c.PERIOD, c.SIC, "formtype", c.CELL, "froempment", c.AUXILIARY,
               "region", "runame1", "entname1")
FRAME_TYPES = {
    "reference": "int", "ruref": "int", "period": "date", "frosic2007": "str",
    "formtype": "str", "cell_no": "int", "froempment": "int", "froempees": "int",
    "frotover": "float", "employment": "int", "region": "str", "questioncode": "int",
    "adjustedresponse": "float", "question_no": "int", "returned_value": "float",
    "adjusted_value": "float", "type": "int", "response_type": "int", "sic_5_digit": "str",
    "classification": "int", "l_value": "float", "outlier_weight": "float",
}


def read_csv(spark: SparkSession, path: str, columns: Sequence[str],
             types: Mapping[str, str] = FRAME_TYPES) -> DataFrame:
    """CSV with a header: ``columns`` by their trimmed names, in whatever order files have them.

    All files of one read share a header; a column that is absent raises.
    """
    raw = (spark.read.option("header", True).option("enforceSchema", False)
           .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
           .csv(path))
    raw = raw.toDF(*[name.strip() for name in raw.columns])
    wanted = [name.strip() for name in columns]
    absent = [name for name in wanted if name not in raw.columns]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    return enforce_types(raw, wanted, types)


def read_colon(spark: SparkSession, path: str, columns: Sequence[str],
               keep: Sequence[str] | None = None) -> DataFrame:
    """Colon-separated files without header.  ``path`` may be a glob of files, or of
    folders of part files; the month its name ends with becomes ``period``.  Only the
    columns in ``keep`` are parsed.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    reader = (spark.read.schema(schema).option("sep", ":").option("quote", "")
              .option("ignoreLeadingWhiteSpace", True)
              .option("ignoreTrailingWhiteSpace", True))
    month = F.regexp_extract(F.col("_metadata.file_path"), r"(\d{6})(?:/part-[^/]*)?$", 1)
    rows = reader.csv(path).select(
        *[F.col(f"`{name}`") for name in columns], month.alias(c.PERIOD))
    return enforce_types(rows, keep or [*columns, c.PERIOD], FRAME_TYPES)


def window_months(current_period: int, revision_window: int) -> list[int]:
    """The ``revision_window`` months that end at ``current_period``."""
    return [shift_period(current_period, -k) for k in range(revision_window)][::-1]


def read_frame_window(spark: SparkSession, folder: str, prefix: str, columns: Sequence[str],
                      current_period: int, revision_window: int,
                      keep: Sequence[str] | None = None) -> DataFrame:
    """Frame files of the months in the window.  Other months are not opened; a month of the
    window without a file raises."""
    window = window_months(current_period, revision_window)
    place = spark._jvm.org.apache.hadoop.fs.Path
    files = place(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    absent = [m for m in window if not files.globStatus(place(f"{folder}/{prefix}*{m}"))]
    if absent:
        raise FileNotFoundError(f"{folder}/{prefix}: no file for {absent}")
    months = ",".join(str(m) for m in window)
    return read_colon(spark, f"{folder}/{prefix}*{{{months}}}", columns, keep)


def read_local_units(spark: SparkSession, folder: str, prefix: str,
                     current_period: int, revision_window: int) -> DataFrame:
    """Local units with the reporting unit as ``reference``."""
    units = read_frame_window(
        spark, folder, prefix, LOCAL_UNIT_COLUMNS, current_period, revision_window,
        keep=("ruref", c.PERIOD, "employment", "region"))
    return units.withColumnRenamed("ruref", c.REFERENCE)
