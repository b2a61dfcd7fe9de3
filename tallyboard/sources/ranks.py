"""Readers of rank and report files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


# Any text survives: quotes inside a value are doubled, line ends and blanks at its ends are kept.
CSV = {"header": True, "sep": ",", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, **options: object) -> DataFrame:
    """Rank tables and reports as ``write_rank_csv`` and ``write_report_csv`` write them; empty text and null stay apart.

    A value may hold line ends, so a file is read by one task; a file holds one run's top-n table.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    # What stands for null inside the reader: an unquoted empty field is null, a quoted one is empty text.
    return reader.options(**CSV, multiLine=True, nullValue="\0", **options).csv(path)


def read_dated_ranks(spark: SparkSession, path: str, schema: T.StructType | None = None,
                     pattern: str = r"(\d{2}_\d{2}_\d{4})", date_format: str = "dd_MM_yyyy",
                     date: str = "run_date") -> DataFrame:
    """CSV rank files of many runs; each row's date is taken from its file's path.

    Without a schema the header names the columns and all of them are text.
    """
    files = read_csv(spark, path, schema, recursiveFileLookup=True)
    text = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    return files.withColumn(date, F.to_date(text, date_format))
