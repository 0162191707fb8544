"""Keyed merges without a table format.

All merges are joins/aggregations on the key: keep-first is a ``min_by`` with
map-side partial aggregation (a hot key is combined before the shuffle), the
conflict rules are ``left_anti`` / ``full_outer`` joins.  Results are new
DataFrames; write them to a new directory and swap, never over the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def dedupe_first(df: DataFrame, key: str | Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """A5: one row per key - the smallest by ``order`` (ties: whole-row order)."""
    keys = _keys(key)
    rest = [c for c in df.columns if c not in keys]
    order_struct = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    payload = F.struct(*[F.col(c) for c in rest])
    picked = df.groupBy(*keys).agg(F.min_by(payload, order_struct).alias("_first"))
    return picked.select(*keys, *[F.col("_first")[c].alias(c) for c in rest])


def latest_by(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """T7 per key: the row with the largest ``order`` tuple (``max_by``)."""
    keys = _keys(key)
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(o) for o in order])).alias("_l")
    )
    return picked.select(*keys, *[F.col("_l")[c].alias(c) for c in rest])


def latest_row(df: DataFrame, order_col: str) -> DataFrame:
    """The single latest row (NULLs last) - ``TakeOrderedAndProject``."""
    return df.orderBy(F.col(order_col).desc_nulls_last()).limit(1)


def insert_if_absent(target: DataFrame, batch: DataFrame, key: str | Sequence[str],
                     batch_order: Sequence[Column | str]) -> DataFrame:
    """S7 ``INSERT .. ON CONFLICT (key) DO NOTHING``: existing rows win; inside
    the batch the first row by ``batch_order`` wins."""
    keys = _keys(key)
    first = dedupe_first(batch, keys, batch_order).select(*target.columns)
    fresh = first.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh)


def upsert_partial(target: DataFrame, batch: DataFrame, key: str | Sequence[str],
                   update_cols: Sequence[str]) -> DataFrame:
    """S8 ``ON CONFLICT (key) DO UPDATE SET update_cols``: on conflict only
    ``update_cols`` take the new value, every other column keeps the old one;
    new keys are inserted whole.  Batch keys must be unique (dedupe first)."""
    keys = _keys(key)
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in target.columns if c not in keys],
                      F.lit(True).alias("_in_t"))
    b = batch.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in target.columns if c not in keys],
                     F.lit(True).alias("_in_b"))
    j = t.join(b, keys, "full_outer")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in update_cols:
            out.append(F.when(F.col("_in_b"), F.col(f"_b_{c}")).otherwise(F.col(f"_t_{c}")).alias(c))
        else:
            out.append(F.when(F.col("_in_t"), F.col(f"_t_{c}")).otherwise(F.col(f"_b_{c}")).alias(c))
    return j.select(*out)


def classify_http(status: Column) -> Column:
    """200 -> downloaded; 403/404/410 -> unreachable; else (NULL too) failed."""
    return (
        F.when(status == 200, "downloaded")
        .when(status.isin(403, 404, 410), "unreachable")
        .otherwise("failed")
    )


def apply_outcomes(registry: DataFrame, attempts: DataFrame, url_col: str = "asset_url",
                   attempt_url_col: str = "url", attempt_order: Sequence[str] = ("attempted_at",)) -> DataFrame:
    """U6 + S10: advance ``discovered`` registry rows by their latest attempt.

    ``attempts`` carries (url, http_status, content_type, size_bytes, sha256,
    local_path, attempted_at).  On 200 the file attributes and time are set;
    otherwise only status and http_status.  Rows not ``discovered`` or without
    an attempt are unchanged.
    """
    last = latest_by(attempts.withColumnRenamed(attempt_url_col, "_url"), "_url", list(attempt_order))
    a = last.select(
        "_url",
        F.col("http_status").alias("_a_http"),
        F.col("content_type").alias("_a_ct"),
        F.col("size_bytes").alias("_a_size"),
        F.col("sha256").alias("_a_sha"),
        F.col("local_path").alias("_a_path"),
        F.col(attempt_order[0]).alias("_a_at"),
    )
    j = registry.join(a, registry[url_col] == a["_url"], "left")
    act = (F.col("status") == "discovered") & F.col("_url").isNotNull()
    ok = act & (F.col("_a_http") == 200)
    new_status = classify_http(F.col("_a_http"))
    sets = {
        "status": F.when(act, new_status).otherwise(F.col("status")),
        "http_status": F.when(act, F.col("_a_http")).otherwise(F.col("http_status")),
        "local_path": F.when(ok, F.col("_a_path")).otherwise(F.col("local_path")),
        "content_type": F.when(ok, F.col("_a_ct")).otherwise(F.col("content_type")),
        "size_bytes": F.when(ok, F.col("_a_size")).otherwise(F.col("size_bytes")),
        "sha256": F.when(ok, F.col("_a_sha")).otherwise(F.col("sha256")),
        "downloaded_at": F.when(ok, F.col("_a_at")).otherwise(F.col("downloaded_at")),
    }
    return j.select(*[sets[c].alias(c) if c in sets else F.col(c) for c in registry.columns])
