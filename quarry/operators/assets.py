"""Asset discovery (U7, U4, A5, P18, F8) and pending work."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.jsonpath import array_elements
from quarry.functions.urls import is_http, is_url_column
from quarry.operators.merge import dedupe_first, insert_if_absent

REGISTRY_COLUMNS = ("asset_url", "source_dataset", "source_entity_type", "source_entity_id", "status")


@dataclass(frozen=True)
class ColumnSource:
    """A table whose URL columns are discovered from its schema."""

    df: DataFrame
    dataset: str
    entity_type: str


@dataclass(frozen=True)
class JsonSource:
    """A JSON-array column whose elements carry ``url`` (attachments)."""

    df: DataFrame
    dataset: str
    entity_type: str
    id_col: str
    json_col: str


def urls_from_columns(src: ColumnSource) -> DataFrame:
    """Unpivot the URL columns (schema-discovered) into rows; entity id is
    ``id`` else ``doc_id`` else NULL; F8 keeps only ``http..`` values."""
    cols = [c for c in src.df.columns if is_url_column(c)]
    if not cols:
        return None
    id_col = "id" if "id" in src.df.columns else ("doc_id" if "doc_id" in src.df.columns else None)
    ent = F.col(id_col).cast("string") if id_col else F.lit(None).cast("string")
    base = src.df.select(ent.alias("source_entity_id"), *[F.col(c).cast("string").alias(c) for c in cols])
    long = base.unpivot("source_entity_id", cols, "url_column", "asset_url")
    rank = {c: i for i, c in enumerate(cols)}
    col_rank = F.lit(0)
    for c, i in rank.items():
        col_rank = F.when(F.col("url_column") == c, F.lit(i)).otherwise(col_rank)
    return long.filter(is_http(F.col("asset_url"))).select(
        "asset_url",
        F.lit(src.dataset).alias("source_dataset"),
        F.lit(src.entity_type).alias("source_entity_type"),
        "source_entity_id",
        col_rank.alias("_col_rank"),
    )


def urls_from_json(src: JsonSource) -> DataFrame:
    """J5 + P10: ``elem ->> 'url'`` of every element of a JSON array column."""
    elems = src.df.select(
        F.col(src.id_col).cast("string").alias("source_entity_id"),
        F.explode(array_elements(F.col(src.json_col))).alias("_e"),
    )
    url = F.try_variant_get(F.col("_e"), "$.url", "string")
    return elems.select(
        url.alias("asset_url"),
        F.lit(src.dataset).alias("source_dataset"),
        F.lit(src.entity_type).alias("source_entity_type"),
        "source_entity_id",
        F.lit(0).alias("_col_rank"),
    ).filter(is_http(F.col("asset_url")))


def discover_assets(sources: Sequence[ColumnSource | JsonSource]) -> DataFrame:
    """Union of every source, keep-first per URL by (source order, entity
    id, column order).  Output: one ``discovered`` registry row per URL."""
    parts = []
    for rank, src in enumerate(sources):
        part = urls_from_columns(src) if isinstance(src, ColumnSource) else urls_from_json(src)
        if part is not None:
            parts.append(part.withColumn("_src_rank", F.lit(rank)))
    if not parts:
        raise ValueError("no source has URL columns")
    allurls = parts[0]
    for p in parts[1:]:
        allurls = allurls.unionByName(p)
    first = dedupe_first(
        allurls, "asset_url",
        [F.col("_src_rank"), F.col("source_entity_id").isNull(), F.col("source_entity_id"),
         F.col("_col_rank")],
    )
    return first.select(
        "asset_url", "source_dataset", "source_entity_type", "source_entity_id",
        F.lit("discovered").alias("status"),
    )


def register_assets(registry: DataFrame, discovered: DataFrame) -> DataFrame:
    """S7 on ``asset_url``: existing registry rows win."""
    return insert_if_absent(registry, discovered.select(*registry.columns), "asset_url",
                            [F.col("asset_url")])


def pending_assets(registry: DataFrame, id_col: str, status: str = "discovered") -> DataFrame:
    """rows in ``status``, by id."""
    return registry.filter(F.col("status") == status).orderBy(id_col)
