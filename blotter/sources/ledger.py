"""Which landed files have been taken in.

The ledger is a table with a row per city and file: its length, its time of change and
the delivery that took it in. A file is taken again only if one of the first two differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

LEDGER = "city string, file string, bytes bigint, modified timestamp, delivery bigint"


def landed_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, path, bytes, modified) of the files in a folder and those below it.

    Only listed, not read. `file` is the name by which rows know their file
    (`_metadata.file_path`), `path` that by which a reader finds it. Names that begin with
    a dot or an underscore are passed over, as by every reader.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return listing.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("path"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    )


def not_taken(files: DataFrame, ledger: DataFrame, city: str) -> DataFrame:
    """The files that the city's rows of the ledger do not have as they are now."""
    known = ledger.filter(F.col("city") == city).select("file", "bytes", "modified")
    return files.join(known, ["file", "bytes", "modified"], "left_anti")


def globless(path: str) -> str:
    """A path that a reader takes as it is, brackets, stars and braces included."""
    return "".join("\\" + letter if letter in "[]{}*?\\" else letter for letter in path)
