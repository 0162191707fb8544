"""Ingest job (U8, S6, S7, S12, A9): schema-adaptive load of the archive
datasets into parquet tables, recipients normalised, manifest recorded, and the
run logged.

Every table is one ``read -> select -> write`` job with a single scan of its
source (tables are independent); rows read, written and rejected are observed
as they pass.  Each converter is a Column expression, so the load never leaves
the JVM.  Output tables are full refreshes (``mode('overwrite')``) of their own
directory.  The run log holds an event when a run opens and one when it closes;
:func:`run_log` folds them, so a run whose driver died reads as ``running``.
"""

from __future__ import annotations

import datetime as _dt
import os
import uuid
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from quarry.functions.convert import adaptive_select, raw_json, safe_timestamp
from quarry.functions.jsonpath import field_text
from quarry.operators.merge import latest_by, upsert_partial
from quarry.operators.recipients import normalize_recipients
from quarry.sources.manifest import flatten_manifest, read_manifest
from quarry.sources.shards import shard_union

# Target tables in load order, each column with its converter
# (source column name = target column name) and the key used for
# insert-if-absent (None = plain insert).
TABLE_SPECS: dict[str, tuple[str | None, list[tuple[str, str]]]] = {
    "release_batches": ("id", [
        ("id", "str"), ("name", "str"), ("release_date", "timestamp"), ("description", "str"),
        ("source", "str"), ("document_count", "int")]),
    "people": ("id", [
        ("id", "str"), ("name", "str"), ("slug", "str"), ("aliases", "json"), ("description", "str"),
        ("image_url", "str"), ("email_addresses", "json")]),
    "photos": ("id", [
        ("id", "str"), ("filename", "str"), ("title", "str"), ("description", "str"),
        ("date_taken", "timestamp"), ("width", "int"), ("height", "int"), ("image_url", "str"),
        ("thumbnail_url", "str"), ("volume", "str"), ("release_batch", "str"), ("source", "str")]),
    "photo_faces": (None, [
        ("photo_id", "str"), ("person_id", "str"), ("confidence", "str"), ("bounding_box", "json")]),
    "imessage_conversations": ("id", [
        ("id", "str"), ("slug", "str"), ("title", "str"), ("participants", "json"),
        ("message_count", "int")]),
    "imessage_messages": ("id", [
        ("id", "str"), ("conversation_id", "str"), ("conversation_slug", "str"), ("sender", "str"),
        ("body", "str"), ("date", "timestamp"), ("attachments", "json")]),
    "star_counts": (None, [("entity_type", "str"), ("entity_id", "str"), ("count", "int")]),
    "documents": ("id", [
        ("id", "str"), ("doc_id", "str"), ("title", "str"), ("filename", "str"), ("file_type", "str"),
        ("page_count", "int"), ("volume", "str"), ("bates_start", "str"), ("bates_end", "str"),
        ("release_batch", "str"), ("source", "str"), ("pdf_url", "str"), ("thumbnail_url", "str")]),
    "emails": ("id", [
        ("id", "str"), ("doc_id", "str"), ("subject", "str"), ("sender", "str"), ("sender_name", "str"),
        ("recipients", "json"), ("cc", "json"), ("bcc", "json"), ("date", "timestamp"), ("body", "str"),
        ("body_html", "str"), ("thread_id", "str"), ("in_reply_to", "str"), ("labels", "json"),
        ("attachments", "json"), ("starred", "bool"), ("star_count", "int"), ("release_batch", "str"),
        ("source", "str")]),
}


def list_paths(spark: SparkSession, directory: str, glob: str) -> list[str]:
    """Sorted paths of the entries (files, or directories such as
    Spark-written parquet datasets) directly under ``directory`` whose name
    matches ``glob``, on any Hadoop-compatible file system.  Built from the
    source's file index (nothing is read); a missing directory gives []."""
    import fnmatch
    import re

    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .load(directory).inputFiles())
    except AnalysisException:
        return []
    tail = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "", directory.rstrip("/")) + "/"
    out = set()
    for f in files:
        i = f.find(tail)
        if i < 0:
            continue
        child = f[i + len(tail):].split("/")[0]
        if child and not child.startswith(("_", ".")) and fnmatch.fnmatch(child, glob):
            out.add(f[:i + len(tail)] + child)
    return sorted(out)


def _try_read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


class Loaded(tuple):
    """(rows read, rows written); ``rejected``: the values that didn't parse."""

    rejected: int

    def __new__(cls, read: int, written: int, rejected: int = 0) -> "Loaded":
        self = super().__new__(cls, (read, written))
        self.rejected = rejected
        return self

    read = property(lambda self: self[0])
    written = property(lambda self: self[1])


def _rejects(src: DataFrame, columns: list[tuple[str, str]]) -> Column:
    """The text timestamps of a row that don't parse, as array<struct<column_name,
    value>>: the reference would abort the load there; here they load as NULL."""
    texts = [c for c, conv in columns if conv == "timestamp" and c in src.columns
             and src.schema[c].dataType.simpleString() == "string"]
    none = F.array().cast("array<struct<column_name: string, value: string>>")
    if not texts:
        return none
    bad = [F.when((F.trim(c) != "") & safe_timestamp(F.col(c), src.schema[c].dataType).isNull(),
                  F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"))) for c in texts]
    return F.filter(F.array(*bad), lambda x: x.isNotNull())


def load_table(spark: SparkSession, src: DataFrame, out_path: str, columns: list[tuple[str, str]],
               key: str | None, order: Sequence[str] | None = None, rejects_path: str | None = None) -> Loaded:
    """S6 + P1 + S7: map, keep the first row per key, overwrite ``out_path``.

    The first row of a key is the first by the source columns ``order``, or in
    file order (file path, then row index in the file) of a file scan.  Rows
    without a key, and so all rows of a source that has no key column, are
    plain inserts.  A source with none of the mapped columns leaves the table
    as it is.

    One scan reads, maps, reduces and writes; the returned counts are observed
    on the way.  In file order the source's columns are reduced and only the
    rows that stay are mapped, since a record as JSON is the widest column.  Values that don't parse are counted; with ``rejects_path``
    they are written there as ``(key, column_name, value, raw_json)``, in a
    second scan that is made only if there are any."""
    if not {c for c, _ in columns} & set(src.columns):
        return Loaded(src.count(), 0, 0)
    names = [*(c for c, _ in columns), "raw_json"]
    mapping = {c: (c, conv) for c, conv in columns}
    keyed = key is not None and key in src.columns
    extra = [F.size(_rejects(src, columns)).alias("_rejected")]
    in_file_order = keyed and not order
    if keyed:
        place = F.struct(*order) if order else F.struct("_metadata.file_path", "_metadata.row_index")
        extra.append(place.alias("_place"))
    try:
        if in_file_order:
            mapped = adaptive_select(src, {key: mapping[key]} if key in mapping else {}, extra=[
                F.struct(*[F.col(f"`{c}`") for c in src.columns]).alias("_row"), *extra])
        else:
            mapped = adaptive_select(src, mapping, with_raw_json=True, extra=extra)
    except AnalysisException as e:
        if keyed and not order:
            raise ValueError("a source that is no file scan needs an order to keep the first row of a key") from e
        raise
    seen, kept = Observation(), Observation()
    mapped = mapped.observe(seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_rejected"), F.lit(0)).alias("rejected"))
    if keyed:
        # a row without a key is a group by itself: its place is unique, or whole ties stay with its values
        alone = F.when(F.col(key).isNull(), F.struct("_place", F.monotonically_increasing_id().alias("i"))).alias("_alone")
        mapped = mapped.withColumn("_alone", alone)
        if in_file_order:  # a place is one row, so there are no ties
            first = mapped.groupBy(key, "_alone").agg(F.min_by("_row", "_place").alias("_row"))
            mapped = adaptive_select(first.select(*[F.col("_row")[c].alias(c) for c in src.columns]), mapping, with_raw_json=True)
        else:
            payload = F.struct(*[c for c in names if c != key])
            mapped = mapped.groupBy(key, "_alone").agg(F.min_by(payload, F.struct("_place", payload)).alias("_first")).select(
                *[F.col(c) if c == key else F.col(f"_first.{c}") for c in names])
    mapped.select(*names).observe(kept, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(out_path)
    counts = Loaded(seen.get["n"], kept.get["n"], seen.get["rejected"])
    if rejects_path and counts.rejected:
        keys = F.col(key).cast("string") if keyed else F.lit(None).cast("string")
        src.select(keys.alias("key"), F.explode(_rejects(src, columns)).alias("r"), raw_json(src).alias("raw_json")).select(
            "key", "r.column_name", "r.value", "raw_json").write.mode("overwrite").parquet(rejects_path)
    return counts


RUN_EVENTS = ("run_id string, event_at timestamp, started_at timestamp, completed_at timestamp, status string, "
              "tables_loaded array<string>, row_counts map<string,bigint>, rows_read map<string,bigint>, "
              "rejected map<string,bigint>, errors map<string,string>")


def append_run_event(spark: SparkSession, path: str, **values) -> None:
    """One event of a run, as a new file: the opening of a run goes to
    ``<path>_opened``, its end, which has ``completed_at``, to ``path``.
    Columns not given are NULL, ``event_at`` is now."""
    schema = StructType.fromDDL(RUN_EVENTS)
    values.setdefault("event_at", _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))
    to = path if values.get("completed_at") else f"{path}_opened"
    spark.createDataFrame([tuple(values.get(f.name) for f in schema)], schema).coalesce(1).write.mode("append").parquet(to)


def run_log(spark: SparkSession, path: str) -> DataFrame:
    """The state of each run: its last event, a closing one before one
    that opens.  A run without an end, such as one whose driver died, is
    ``running``."""
    events = spark.createDataFrame([], RUN_EVENTS)
    for part in (path, f"{path}_opened"):
        try:
            events = events.unionByName(spark.read.schema(RUN_EVENTS).parquet(part))
        except AnalysisException:  # no run has got so far
            continue
    events = events.withColumn("_closed", F.col("completed_at").isNotNull())
    return latest_by(events, "run_id", ["_closed", "event_at"]).drop("_closed", "event_at")


def ingest_all(spark: SparkSession, raw_root: str, out_root: str,
               run_started: _dt.datetime | None = None,
               tables: Iterable[str] | None = None) -> DataFrame:
    """U8: load every dataset present under ``raw_root`` into ``out_root``.

    Absent files are skipped.  The run is logged as ``running`` before the
    first table is read.  A failure marks it ``failed`` with the error; tables
    written before it stay loaded.  Values that didn't parse are in
    ``out_root/rejects/<table>``.  Returns the run's row of the log
    (``out_root/ingest_runs``, see :func:`run_log`).
    """
    started = run_started or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    log, run_id = os.path.join(out_root, "ingest_runs"), uuid.uuid4().hex
    append_run_event(spark, log, run_id=run_id, started_at=started, status="running")
    counts: dict[str, int] = {}
    read_counts: dict[str, int] = {}
    rejected: dict[str, int] = {}
    loaded: list[str] = []
    errors: dict[str, str] = {}
    status = "completed"
    try:
        for name in tables or TABLE_SPECS:
            key, cols = TABLE_SPECS[name]
            src = _try_read(spark, os.path.join(raw_root, f"{name}.parquet"))
            if src is None:
                continue
            got = load_table(spark, src, os.path.join(out_root, name), cols, key,
                             rejects_path=os.path.join(out_root, "rejects", name))
            read_counts[name], counts[name], rejected[name] = got.read, got.written, got.rejected
            loaded.append(name)
            if name == "emails":
                emails, kept = spark.read.parquet(os.path.join(out_root, "emails")), Observation()
                normalize_recipients(emails).observe(kept, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(
                    os.path.join(out_root, "email_recipients"))
                counts["email_recipients"] = kept.get["n"]
                loaded.append("email_recipients")
        shards = list_paths(spark, os.path.join(raw_root, "documents-full"), "*.parquet")
        if shards:
            kept = Observation()
            shard_union(spark, shards).observe(kept, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(
                os.path.join(out_root, "document_fulltext"))
            counts["document_fulltext"] = kept.get["n"]
            loaded.append("document_fulltext")
        manifest_path = os.path.join(raw_root, "manifest.json")
        if list_paths(spark, raw_root, "manifest.json"):
            record_manifest(spark, manifest_path, out_root, started)
            record_mirrored_files(spark, manifest_path, raw_root, out_root, started)
            loaded += ["dataset_manifest", "mirrored_files"]
    except Exception as e:  # noqa: BLE001 - the run log records any failure
        status = "failed"
        errors["fatal"] = str(e).splitlines()[0]
    append_run_event(spark, log, run_id=run_id, started_at=started, status=status, tables_loaded=loaded,
                     completed_at=_dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None), row_counts=counts,
                     rows_read=read_counts, rejected=rejected, errors=errors or None)
    return run_log(spark, log).filter(F.col("run_id") == run_id)


def record_manifest(spark: SparkSession, manifest_path: str, out_root: str, now: _dt.datetime) -> None:
    """A ``dataset_manifest`` row with the whole manifest as it was read."""
    text = spark.read.text(manifest_path, wholetext=True)
    text.select(
        field_text(F.col("value"), "run_id").alias("run_id"),
        safe_timestamp(field_text(F.col("value"), "generated_at"), StringType()).alias("generated_at"),
        F.col("value").alias("raw_json"), F.lit(now).cast("timestamp").alias("fetched_at"),
    ).write.mode("append").parquet(os.path.join(out_root, "dataset_manifest"))


def record_mirrored_files(spark: SparkSession, manifest_path: str, raw_root: str, out_root: str,
                          now: _dt.datetime) -> DataFrame:
    """S4 + S8: one ``mirrored_files`` row per (dataset, format); on conflict
    only ``status``/``downloaded_at`` change - expected size/hash keep the old
    values, as in the reference."""
    flat = flatten_manifest(read_manifest(spark, manifest_path))
    batch = flat.select(
        F.col("dataset").alias("dataset_name"), "format", "url",
        F.concat(F.lit(raw_root.rstrip("/") + "/"), F.col("rel_path")).alias("local_path"),
        F.col("size").alias("expected_size"), F.col("sha256").alias("expected_sha256"),
        F.lit("downloaded").alias("status"), F.lit(now).cast("timestamp").alias("downloaded_at"),
    )
    path = os.path.join(out_root, "mirrored_files")
    old = _try_read(spark, path)
    merged = batch if old is None else upsert_partial(old, batch, ["dataset_name", "format"],
                                                      ["status", "downloaded_at"])
    # never overwrite the directory being read: stage, then replace
    staged = path + ".next"
    merged.write.mode("overwrite").parquet(staged)
    spark.read.parquet(staged).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_KIND_BY_TYPE = {"string": "str", "boolean": "bool", "timestamp": "timestamp", "date": "timestamp",
                 "int": "int", "smallint": "int", "tinyint": "int"}


def columns_for(df: DataFrame) -> list[tuple[str, str]]:
    """A column map for a table the specs do not know: text for strings and
    wide numbers (the reference stores ids and sizes as text), int for small
    integers, bool/timestamp as such, JSON for nested values."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        kind = _KIND_BY_TYPE.get(t)
        if kind is None:
            kind = "json" if t.startswith(("array", "struct", "map")) else "str"
        out.append((f.name, kind))
    return out


def load_tables(spark: SparkSession, paths: dict[str, str], out_root: str,
                keys: dict[str, str] | None = None) -> DataFrame:
    """Load arbitrary parquet tables with a schema-derived map + ``raw_json``
    (P1, P7, S6).  Returns ``(table_name, rows_read, rows_written)``."""
    rows = []
    for name, path in paths.items():
        src = _try_read(spark, path)
        if src is None:
            continue
        key = (keys or {}).get(name)
        got = load_table(spark, src, os.path.join(out_root, name), columns_for(src), key)
        rows.append((name, got.read, got.written))
    return spark.createDataFrame(rows, "table_name string, rows_read bigint, rows_written bigint")
