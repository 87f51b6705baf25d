"""Header-less sheets as cell grids."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandspark.sources.tables import cut_lineage

KEY_PATTERN = r"([^/]+/[^/]+/[^/]+)\.[A-Za-z]+$"


def split_cells(line: Column, width: int | None = None) -> Column:
    """Cells of a comma-separated line; give ``width`` when cells may be quoted."""
    if width is None:
        return F.split(line, ",", -1)
    names = [f"c{i}" for i in range(width)]
    parsed = F.from_csv(line, ", ".join(f"{n} string" for n in names), {"quote": '"', "escape": '"'})
    return F.array(*[parsed[n] for n in names])


def explode_sheets(files: DataFrame, width: int | None = None) -> DataFrame:
    """``(partition_key, value)`` with one sheet text per row, to grid rows.

    Row numbers are made inside one sheet and are therefore exact. One final
    newline is not a row.
    """
    text = F.regexp_replace("value", r"\r?\n\z", "")
    rows = files.select("partition_key", F.posexplode(F.split(text, r"\r?\n", -1)).alias("row_idx", "_line"))
    return rows.select("partition_key", F.col("row_idx").cast("bigint").alias("row_idx"), split_cells(F.col("_line"), width).alias("cells"))


def sheet_key(path: Column, pattern: str = KEY_PATTERN) -> Column:
    """Key of a sheet file: the groups of ``pattern`` in its path, joined by slashes."""
    return F.concat_ws("/", *[F.regexp_extract(path, pattern, i + 1) for i in range(re.compile(pattern).groups)])


def list_sheets(spark: SparkSession, path: str, pattern: str = KEY_PATTERN) -> DataFrame:
    """``(partition_key, path, size, modified)`` of the sheet files; nothing is read from them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(sheet_key(F.col("path"), pattern).alias("partition_key"), "path", F.col("length").alias("size"),
                        F.col("modificationTime").alias("modified"))


def read_sheets(spark: SparkSession, path: str | Sequence[str], width: int | None = None, pattern: str = KEY_PATTERN) -> DataFrame:
    """All sheet files under a directory (``<year>/<month>/<file>``), or those listed, as one grid.

    A file is read as one text, so quoted cells may hold line breaks; larger files are for
    :func:`read_large_sheets`.
    """
    paths = path if isinstance(path, str) else list(path)
    files = (spark.read.text(paths, wholetext=True, recursiveFileLookup=True)
             .select(sheet_key(F.col("_metadata.file_path"), pattern).alias("partition_key"), "value"))
    return explode_sheets(files, width)


def read_large_sheets(spark: SparkSession, path: str, width: int | None = None, pattern: str = KEY_PATTERN,
                      in_parts: bool = False) -> DataFrame:
    """The same grid with each file cut over many tasks.

    Lines are read block by block. A line's number is its place in its block plus the lines
    of the blocks before it in the file, which are counted, one row per block. With ``in_parts``
    the files of one key are the parts of one sheet, in order of their paths. Lines end at
    a line feed, a carriage return or both. Runs a job: the lines are staged, as their places
    must not change between two reads.
    """
    lines = spark.read.text(path, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), "value",
        F.monotonically_increasing_id().alias("_mark"))
    lines = cut_lineage(lines)
    blocks = lines.groupBy("_file", "_block").agg(F.min("_mark").alias("_first"), F.count(F.lit(1)).alias("_n"))
    sheet = sheet_key(F.col("_file"), pattern) if in_parts else F.col("_file")
    ahead = Window.partitionBy(sheet).orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_file", "_block", "_first", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    row = F.col("_before") + F.col("_mark") - F.col("_first")
    return lines.join(F.broadcast(blocks), ["_file", "_block"]).select(
        sheet_key(F.col("_file"), pattern).alias("partition_key"), row.alias("row_idx"), split_cells(F.col("value"), width).alias("cells"))
