"""A stored text index in segments (F10, U12, X1): base, deltas, tombstones.

A refresh writes only what changed: the postings and page rows of new pages as
a segment of their own, and the keys of pages that are gone as its tombstones.
Readers take all live segments and leave out, with one anti join, what a later
segment's tombstones name.  Compaction writes the live postings as a new base.

Layout under the index's folder, all Parquet but the log::

    postings/seg=<n>/entity_type=<t>/   sorted by term, so terms prune pages; the
                                        first base has the pages' own rows, too
    pages/seg=<n>/                      a row per page: key and equal rows
    dead/seg=<n>/                       page keys that segments before n lose
    log/                                a JSON line per segment that is complete

A segment counts from its line in the log on, written last: readers never see
a part of a refresh, and one that was cut off is written again under the same
number.  Segments before the newest base can be deleted when no reader is left.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import index as IX
from quarry.session import ensure_checkpoint_dir

_LOG = "seg bigint, base bigint"


def live_segments(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the segments that readers take, oldest first; one for each
    refresh since the last compaction."""
    try:
        last = spark.read.schema(_LOG).json(f"{path}/log").orderBy(F.col("seg").desc()).first()
    except AnalysisException:
        return []
    return list(range(last["base"], last["seg"] + 1)) if last else []


def _read(spark: SparkSession, path: str, part: str, segments: list[int]) -> DataFrame:
    return spark.read.option("basePath", f"{path}/{part}").parquet(*[f"{path}/{part}/seg={n}" for n in segments])


def _commit(spark: SparkSession, path: str, seg: int, base: int) -> None:
    spark.createDataFrame([(seg, base)], _LOG).coalesce(1).write.mode("append").json(f"{path}/log")


def _write_postings(postings: DataFrame, path: str, seg: int) -> None:
    # a hot term spreads by entity; AQE joins the small partitions of a small segment
    (IX.spread(postings, ["entity_type", "term"], "entity_id").sortWithinPartitions("entity_type", "term", "entity_id")
     .write.mode("overwrite").partitionBy("entity_type").parquet(f"{path}/postings/seg={seg}"))


def _write_pages(pages: DataFrame, path: str, seg: int) -> None:
    pages.select("entity_type", *IX.PAGE_KEY, "copies").write.mode("overwrite").parquet(f"{path}/pages/seg={seg}")


def _living(rows: DataFrame, dead: DataFrame | None) -> DataFrame:
    if dead is None:
        return rows
    same = " AND ".join(f"r.{c} <=> d.{c}" for c in ("entity_type", *IX.PAGE_KEY))
    return rows.alias("r").join(dead.alias("d"), F.expr(f"{same} AND d.seg > r.seg"), "left_anti")


def _dead(spark: SparkSession, path: str, segments: list[int]) -> DataFrame | None:
    return _read(spark, path, "dead", segments[1:]) if len(segments) > 1 else None  # a base has none


def create(index: DataFrame, path: str) -> None:
    """Store ``index`` (rows of :func:`quarry.operators.index.index_rows`, with
    or without positions) as the first base.  The texts are analysed once: the
    page table is read from the pages' rows as stored."""
    spark = index.sparkSession
    _write_postings(index, path, 1)
    _write_pages(IX.page_rows(_read(spark, path, "postings", [1])), path, 1)
    _commit(spark, path, 1, 1)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The live postings, for :func:`quarry.operators.index.search_index` and
    the other readers; term filters reach the scan of every segment."""
    segments = live_segments(spark, path)
    return _living(IX.postings(_read(spark, path, "postings", segments)), _dead(spark, path, segments)).drop("seg")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """The live pages: ``(entity_type, entity_id, page, content_hash, copies)``."""
    segments = live_segments(spark, path)
    return _living(_read(spark, path, "pages", segments), _dead(spark, path, segments)).drop("seg")


def refresh(spark: SparkSession, path: str, source: DataFrame, entity_type: str, id_col: str, text_col: str,
            page_col: str | None = None) -> int:
    """F10 + U12: bring the stored index up to date with ``source`` for one
    type; the number of the new segment, or of the last if nothing changed.

    Page keys, one narrow row per page, are compared with the page table; only
    texts of new or edited pages are analysed and written, whatever the size of
    the index.  Equal rows of a page count: a page whose number of equal rows
    changed is written anew."""
    ensure_checkpoint_dir(spark)
    segments = live_segments(spark, path)
    seg = segments[-1] + 1
    known = read_pages(spark, path).filter(F.col("entity_type") == entity_type).select(*IX.PAGE_KEY, "copies")
    hashed = IX.source_pages(source, id_col, text_col, page_col)
    changes = IX.page_changes(known, hashed).checkpoint()  # a row per changed page, read three times
    new, stale = IX.to_index(changes), IX.to_drop(changes)
    if not changes.take(1):
        return segments[-1]
    positions = "positions" in _read(spark, path, "postings", segments[:1]).columns
    same = F.expr(" AND ".join(f"t.{c} <=> n.{c}" for c in IX.PAGE_KEY))
    texts = hashed.alias("t").join(new.alias("n"), same, "left_semi")
    rows = IX.index_rows(texts, entity_type, "entity_id", "_text", "page", positions)
    _write_postings(IX.postings(rows), path, seg)
    typed = F.lit(entity_type).alias("entity_type")
    _write_pages(changes.filter("copies IS NOT NULL").select(typed, *IX.PAGE_KEY, "copies"), path, seg)
    stale.select(typed, *IX.PAGE_KEY).write.mode("overwrite").parquet(f"{path}/dead/seg={seg}")
    _commit(spark, path, seg, segments[0])
    return seg


def compact(spark: SparkSession, path: str) -> int:
    """Write the live postings and pages as a new base; its number."""
    segments = live_segments(spark, path)
    seg = segments[-1] + 1
    _write_postings(read_index(spark, path), path, seg)
    _write_pages(read_pages(spark, path), path, seg)
    _commit(spark, path, seg, seg)
    return seg
