"""Dashboard statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.sources.footers import file_name, table_footers


def table_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """A1: ``(table_name, row_count)`` per named parquet path; a table that
    is missing, or of which a file cannot be read, reports -1 and leaves the
    other counts alone.  Counts come from the footers, read in tasks."""
    found = table_footers(spark, paths).groupBy("table_name").agg(
        F.sum("row_count").alias("n"), F.count("error").alias("errors"))
    return found.select("table_name", F.when(F.col("errors") > 0, F.lit(-1)).otherwise(F.col("n")).cast("bigint").alias("row_count"))


def row_counts_map(counts: DataFrame) -> DataFrame:
    """The run's ``row_counts`` JSON object from ``table_counts`` rows."""
    return counts.agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("table_name", "row_count")))).alias("row_counts")
    )


def display_class(status: Column, ok: Sequence[str], warning: Sequence[str] = (),
                  otherwise: str = "error") -> Column:
    """``ok`` / ``warning`` / ``error`` badge for a status (mirror files:
    ok or warning; assets: ok, warning or error)."""
    return F.when(status.isin(*ok), "ok").when(status.isin(*warning) if warning else F.lit(False),
                                               "warning").otherwise(otherwise)


def status_counts(df: DataFrame, status_col: str = "status") -> DataFrame:
    """A2: ``count(*)`` per status (partial aggregation before the shuffle)."""
    return df.groupBy(F.col(status_col).alias("status")).agg(F.count(F.lit(1)).alias("count"))


def counts_desc(df: DataFrame, col: str) -> DataFrame:
    """A3: count per value, largest first (value breaks ties)."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(col).asc_nulls_last()))


def table_profile(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Per table and column: ordinal, name and type (of the first readable
    file by name) and the rows of the readable files.  A table with a file that
    cannot be read has that file's ``error`` in its rows, one without any
    readable file a single row."""
    first = F.min_by("columns", F.when(F.col("columns").isNotNull(), F.col("path")))
    found = table_footers(spark, paths).groupBy("table_name").agg(
        first.alias("columns"), F.sum("row_count").alias("row_count"), F.min("error").alias("error"))
    return _with_columns(found, "table_name").select("table_name", "ordinal", "column_name", "data_type", "row_count", "error")


def file_profile(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """A8 by file: ``(table_name, file_name, ordinal, column_name, data_type,
    row_count, error)``; a file that cannot be read has one row, with its
    error."""
    found = table_footers(spark, paths).withColumn("file_name", file_name(F.col("path")))
    return _with_columns(found, "table_name", "file_name").select(
        "table_name", "file_name", "ordinal", "column_name", "data_type", "row_count", "error")


def _with_columns(found: DataFrame, *keys: str) -> DataFrame:
    """A row per element of ``columns``; one without names where there is none."""
    return found.select(*keys, "row_count", "error", F.posexplode_outer("columns").alias("at", "c")).select(
        *keys, "row_count", "error", (F.col("at") + 1).alias("ordinal"), F.col("c.name").alias("column_name"),
        F.col("c.type").alias("data_type"))


def table_samples(spark: SparkSession, paths: dict[str, str], n: int = 3) -> DataFrame:
    """The first ``n`` rows of each table, files by path and rows in their
    order, as JSON text: ``(table_name, row, sample, error)``.  A sample is the
    feature here: only the first files that hold ``n`` rows are read.  A table
    without a readable row that has an error has one row, with the error."""
    found = table_footers(spark, paths)
    before = Window.partitionBy("table_name").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    first = found.filter("error IS NULL AND row_count > 0").withColumn("_before", F.coalesce(F.sum("row_count").over(before), F.lit(0)))
    files: dict[str, list[str]] = {}
    for r in first.filter(F.col("_before") < n).select("table_name", "path").orderBy("path").collect():  # n files of a table at most
        files.setdefault(r["table_name"], []).append(r["path"])
    parts = [found.groupBy("table_name").agg(F.min("error").alias("error")).filter("error IS NOT NULL").select(
        "table_name", F.lit(None).cast("bigint").alias("row"), F.lit(None).cast("string").alias("sample"), "error")]
    place = ["_metadata.file_path", "_metadata.row_index"]
    for name, chosen in files.items():
        try:
            df = spark.read.parquet(*chosen)
        except PySparkException as e:  # a footer without a schema Spark can read
            parts.append(spark.createDataFrame([(name, None, None, str(e).splitlines()[0])], parts[0].schema))
            continue
        rows = df.filter(F.col(place[1]) < n).select(
            F.struct(*place).alias("_at"), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("sample"))
        at = F.row_number().over(Window.orderBy("_at")) - 1  # of n rows
        parts.append(rows.orderBy("_at").limit(n).select(
            F.lit(name).alias("table_name"), at.cast("bigint").alias("row"), "sample", F.lit(None).cast("string").alias("error")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
