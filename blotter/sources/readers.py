"""Reading landed files."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: Header lines that one read may meet at most; each becomes an expression of the plan.
LAYOUTS = 200


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    infer: bool = False,
) -> DataFrame:
    """CSV files with a header line, bound to columns by that line.

    By default every column is text and takes its name from the header: `conform`
    does the typing. All files must have the same header. Each file's is compared
    when the file is read, and one with columns in another order, without one of
    them or with another raises, as values would end up in the wrong columns; read
    such files apart and unite them with `unionByName(allowMissingColumns=True)`.
    `infer` costs one more pass over the files and lets the types depend on the
    data. An explicit schema names the header's columns in its order.
    """
    if schema is None:
        schema = spark.read.option("header", True).option("inferSchema", infer).csv(path).schema
    checked = spark.read.option("header", True).option("enforceSchema", False)
    # Without pruning, the whole of every header is compared.
    return checked.option("columnPruning", False).schema(schema).csv(path)


def _names(header: str) -> list[str]:
    """Column names of a header line; a column without one is named by its place."""
    names = [name or f"_c{place}" for place, name in enumerate(next(csv.reader([header])))]
    if len({name.lower() for name in names}) < len(names):
        raise ValueError(f"a header names a column twice: {header}")
    return names


def read_mixed_csv(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """CSV files whose headers may differ: their rows, and the lines that are no rows.

    Each file is read by its own header line. The rows have every column that any
    header names, as text, whatever its case (in the spelling that sorts first, and
    ordered by name); it is null where a file has it not. Rejected are lines with more
    or fewer fields than their header, as `file` and `line`. A line that repeats its
    file's header is no row, nor is a blank one; fields do not go over line ends.
    Empty files have no rows. More than LAYOUTS distinct headers raise, as does a
    header that names a column twice.

    One pass over the files' first blocks finds the headers, of which only the distinct
    ones reach the driver; one more reads the rows of all files, by whichever header.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("line"),
    )
    # Lines of a block are numbered in their order.
    heads = lines.filter("start = 0").groupBy("file").agg(F.min_by("line", "place").alias("header"))
    found = [row["header"] for row in heads.select("header").distinct().limit(LAYOUTS + 1).collect()]
    if len(found) > LAYOUTS:
        raise ValueError(f"more than {LAYOUTS} distinct headers")

    spelled: dict[str, str] = {}
    layouts = [(header, _names(header)) for header in sorted(found)]
    for name in sorted(name for _, names in layouts for name in names):
        spelled.setdefault(name.lower(), name)

    body = lines.select("file", "line").join(heads, "file")
    body = body.filter("line <> header AND trim(line) <> ''")
    parsed, broken = [], []
    columns: dict[str, list] = {name: [] for name in spelled}
    for number, (header, names) in enumerate(layouts):
        # Fields by place, so that no name clashes with that of the broken line.
        fields = ", ".join(f"f{place} string" for place in range(len(names)))
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}
        fit = F.from_csv("line", f"{fields}, broken string", options)
        parsed.append(F.when(F.col("header") == header, fit).alias(f"p{number}"))
        broken.append(F.col(f"p{number}.broken"))
        for place, name in enumerate(names):
            columns[name.lower()].append(F.col(f"p{number}.f{place}"))
    none = F.lit(None).cast("string")
    read = body.select("file", "line", *parsed).withColumn("broken", F.coalesce(none, *broken))
    rows = read.filter("broken IS NULL").select(
        *[F.coalesce(*found).alias(spelled[name]) for name, found in columns.items()]
    )
    return rows, read.filter("broken IS NOT NULL").select("file", "line")
