"""Sharded parquet scan (S2, U2, P8) and the NDJSON twin (S3)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.convert import raw_json, safe_int, safe_str, truthy_coalesce
from quarry.sources.footers import files_under, footers

# Candidate source columns of a full-text shard, in priority order.
DOC_ID_CANDIDATES = ("id", "doc_id", "document_id")
TEXT_CANDIDATES = ("text", "content", "body", "full_text", "extracted_text")
PAGE_CANDIDATES = ("page_number", "page")


def fulltext_rows(df: DataFrame, shard_name) -> DataFrame:
    """P8 on one shard: ``(doc_id, shard_name, page_number, text, raw_json)``."""
    shard = F.lit(shard_name) if isinstance(shard_name, str) else shard_name
    doc = truthy_coalesce(df, DOC_ID_CANDIDATES)
    txt = truthy_coalesce(df, TEXT_CANDIDATES)
    page = truthy_coalesce(df, PAGE_CANDIDATES)
    doc_dt = df.select(doc.alias("x")).schema[0].dataType
    txt_dt = df.select(txt.alias("x")).schema[0].dataType
    page_dt = df.select(page.alias("x")).schema[0].dataType
    return df.select(
        safe_str(doc, doc_dt).alias("doc_id"),
        shard.alias("shard_name"),
        safe_int(page, page_dt).alias("page_number"),
        safe_str(txt, txt_dt).alias("text"),
        raw_json(df).alias("raw_json"),
    )


def _decoded(path: Column) -> Column:
    """A path as its file system names it: scans report URIs."""
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)


def shard_stem(path: Column, parents: Sequence[str]) -> Column:
    """Name of the shard that the file ``path`` belongs to: what follows one of
    the folders ``parents``, without ``.parquet``."""
    below = [F.nullif(F.regexp_extract(path, re.escape(p) + r"/([^/]+)", 1), F.lit("")) for p in parents]
    return F.regexp_replace(F.coalesce(*below), r"\.parquet$", "")


def shard_union(spark: SparkSession, shard_paths: Sequence[str]) -> DataFrame:
    """Shards may name their columns differently, so all footers are read
    first, in tasks; shards of equal schema are then one scan, mapped by P8 and
    tagged with their file's stem.  However many shards there are, the union
    has a scan per different schema.  A shard whose footer can't be read is an
    error that names it; one without rows and columns adds nothing."""
    empty = spark.createDataFrame([], "doc_id string, shard_name string, page_number int, text string, raw_json string")
    if not shard_paths:
        return empty
    roots = sorted({p.split("?")[0].rstrip("/") for p in shard_paths})
    files = files_under(spark, roots)
    if files is None:  # say which
        files = spark.read.format("binaryFile").load(roots).select("path")
    plain = {r: re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", r) for r in roots}
    parents = sorted({p.rsplit("/", 1)[0] for p in plain.values()})
    found = footers(files.select("path", shard_stem(F.col("path"), parents).alias("stem")))
    shards = found.groupBy("stem").agg(F.min("columns").alias("columns"), F.min("error").alias("error")).collect()  # a row per shard asked for
    broken = [f"{r['stem']}: {r['error']}" for r in shards if r["error"]]
    if broken:
        raise ValueError("; ".join(sorted(broken)))
    schema_of = {r["stem"]: tuple((c["name"], c["type"]) for c in r["columns"]) for r in shards}
    groups: dict[tuple, list[str]] = {}
    for root, path in plain.items():
        stem = path.rsplit("/", 1)[1].removesuffix(".parquet")
        if stem in schema_of:
            groups.setdefault(schema_of[stem], []).append(root)
    out = None
    for members in groups.values():
        df = spark.read.parquet(*members)
        part = fulltext_rows(df, shard_stem(_decoded(F.col("_metadata.file_path")), parents))
        out = part if out is None else out.unionByName(part)
    return empty if out is None else out


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType,
                partitions: int | None = None) -> DataFrame:
    """S3: gzip NDJSON with an explicit schema (no inference pass).  A .gz
    file is one task; repartition after the read to spread the work."""
    df = spark.read.schema(schema).json(path)
    return df.repartition(partitions) if partitions else df
