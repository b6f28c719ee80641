"""Landing zone: raw incident text files, every column kept as text.

Blanks and leading zeros must survive the load (district ``004``, beat ``0421``), so the
schema is declared as all-string and never inferred. Typing happens in staging.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Column order of the raw incident file.
LANDING_COLUMNS = [
    "id", "case_number", "date", "block", "iucr", "primary_type", "description",
    "location_description", "arrest", "domestic", "beat", "district", "ward",
    "community_area", "fbi_code", "x_coordinate", "y_coordinate", "year",
    "updated_on", "latitude", "longitude", "location",
]

LANDING_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in LANDING_COLUMNS])

_CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "mode": "FAILFAST",
    # keep surrounding blanks: staging decides what to trim
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "multiLine": "false",
}


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """A1: read raw CSV file(s) with header; every column text; empty field -> NULL.

    Splittable plain-text CSV is read in parallel by ``spark.sql.files.maxPartitionBytes``
    slices; the explicit schema avoids a sampling pass over the data.
    """
    reader = spark.read.schema(LANDING_SCHEMA)
    for k, v in _CSV_OPTIONS.items():
        reader = reader.option(k, v)
    return reader.csv(path)


# The raw text of a line that does not have the landing layout, in tables read by ``read_landing_checked``.
CORRUPT = "_corrupt_line"

_CHECKED = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "columnPruning": "false"}  # a line is judged by all its fields
CHECKED_SCHEMA = T.StructType([*LANDING_SCHEMA.fields, T.StructField(CORRUPT, T.StringType(), True)])


def checked_options(header: bool = True) -> dict[str, str]:
    return _CSV_OPTIONS | _CHECKED | {"header": str(header).lower()}


def read_landing_checked(spark: SparkSession, path: str) -> DataFrame:
    """``read_landing`` that keeps every line: one with too few or too many fields, or with an open quote, comes with its
    text in ``CORRUPT``, for ``plans.staging.staged_and_quarantined`` to sort out."""
    return spark.read.schema(CHECKED_SCHEMA).options(**checked_options()).csv(path)


def read_landing_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, checked: bool = False) -> DataFrame:
    """New landing files as a stream; a malformed line fails it, as in batch, unless ``checked``."""
    reader = spark.readStream.schema(CHECKED_SCHEMA if checked else LANDING_SCHEMA).options(**(checked_options() if checked else _CSV_OPTIONS))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path)


def write_landing(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write rows in the landing layout (header, quoted, blanks preserved)."""
    (
        df.select(*LANDING_COLUMNS)
        .write.mode(mode)
        .option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
