"""Parquet footers read in tasks (S2, U2, A1, A8): one row per file.

The files of the given paths are listed by a scan that reads no content; tasks
then read each file's footer only.  A file that can't be read gives a row with
its error and harms no other."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.tables import parallelism

FOOTER = "path string, row_count bigint, columns array<struct<name: string, type: string>>, error string"


def _footer(path: str) -> tuple:
    import pyarrow.parquet as pq
    from pyarrow import fs
    from pyspark.sql.pandas.types import from_arrow_type

    filesystem, inner = fs.FileSystem.from_uri(quote(path, safe=":/"))  # an unknown kind of storage is no fault of the file
    try:
        with filesystem.open_input_file(inner) as f:
            found = pq.ParquetFile(f)
            columns = []
            for field in found.schema_arrow:
                try:
                    kind = from_arrow_type(field.type, prefer_timestamp_ntz=True).simpleString()
                except Exception:  # noqa: BLE001 - a type that Spark has no name for
                    kind = str(field.type)
                columns.append((field.name, kind))
            return path, found.metadata.num_rows, columns, None
    except Exception as e:  # noqa: BLE001 - whatever is wrong with the file is its row's error
        return path, None, None, (str(e).splitlines() or [type(e).__name__])[0]


def _read(batches: Iterator) -> Iterator:
    import pandas as pd

    for pdf in batches:
        yield pd.DataFrame([_footer(p) for p in pdf["path"]], columns=["path", "row_count", "columns", "error"]).astype(
            {"row_count": "Int64"})


def files_under(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """``path`` of the files at or below ``paths``; None if one is missing."""
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    except AnalysisException:
        return None
    return found.select("path")


def footers(files: DataFrame) -> DataFrame:
    """``FOOTER`` of each file of ``files(path, ..)``, other columns kept."""
    spark = files.sparkSession
    dealt = files.select("path").distinct().repartition(max(parallelism(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return files.join(dealt.mapInPandas(_read, FOOTER), "path")


def table_footers(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """``(table_name, FOOTER)`` of the files of named Parquet tables; a path
    that doesn't exist, or holds no file, gives one row with an error."""
    listed, absent = None, []
    for name, path in tables.items():
        files = files_under(spark, [path])
        if files is None:
            absent.append(name)
            continue
        files = files.select(F.lit(name).alias("table_name"), "path")
        listed = files if listed is None else listed.unionByName(files)
    rows = spark.createDataFrame([(n, None, None, None, "no such path") for n in absent], f"table_name string, {FOOTER}")
    if listed is None:
        return rows
    found = footers(listed).select("table_name", "path", "row_count", "columns", "error")
    names = spark.createDataFrame([(n,) for n in tables if n not in absent], "table_name string")
    bare = names.join(found.select("table_name").distinct(), "table_name", "left_anti").select(
        "table_name", F.lit(None).cast("string").alias("path"), F.lit(None).cast("bigint").alias("row_count"),
        F.lit(None).cast("array<struct<name: string, type: string>>").alias("columns"), F.lit("no files").alias("error"))
    return rows.unionByName(found).unionByName(bare)


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)
