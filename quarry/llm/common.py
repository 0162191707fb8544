"""Shared helpers: checkpoints, folds, distributed order, sorted runs."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.session import ensure_checkpoint_dir

BATCH_BYTES = 4 << 20
WORD = r"[^\x20\x09-\x0D]+"


def stable(df: DataFrame) -> DataFrame:
    """``df`` materialised in the shared checkpoint folder: later reads see the
    same rows in the same partitions, also after executors are lost."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's text modulo ``parts`` (a null id counts as '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(parts)


_shipped: set[str] = set()


def ship(df: DataFrame) -> None:
    """Hand this package to the executors once per application
    (``addPyFile``), so jobs need no copy of it installed there; and bound the
    Arrow batches of the session by bytes, as rows may be very long texts."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        stage = Path(tempfile.mkdtemp(prefix="quarry-ship-"))
        for f in package.rglob("*.py"):
            to = stage / "src" / package.name / f.relative_to(package)
            to.parent.mkdir(parents=True, exist_ok=True)
            shutil.copy(f, to)
        sc.addPyFile(shutil.make_archive(str(stage / package.name), "zip", stage / "src"))
        _shipped.add(sc.applicationId)


def map_arrow(df: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the tasks."""
    ship(df)
    return df.mapInArrow(run, schema)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ordered(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows in a distributed total order: range-partitioned and sorted by
    ``order``, tagged with ``_part`` (partition) and ``_pos`` (increasing in
    the order), and checkpointed so the tags cannot change between uses."""
    out = df.repartitionByRange(shuffle_partitions(df), *order).sortWithinPartitions(*order)
    return stable(out.withColumn("_part", F.spark_partition_id()).withColumn("_pos", F.monotonically_increasing_id()))


def slices(array: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a string array of at most ``limit`` bytes each (a longer
    text makes a range of its own), so working memory stays bounded."""
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    lo = 0
    while lo < len(array):
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), len(array))
        yield lo, hi
        lo = hi


def texts_of(column: pa.Array) -> pa.Array:
    """The column as non-null ``large_string`` (null becomes '')."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Groups of equal ``keys`` from batches already sorted by them, only
    those of two rows or more.  Groups may cross batches; one group is held."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table]).combine_chunks()
        if not table.num_rows:
            continue
        change = np.zeros(table.num_rows - 1, bool)
        for k in keys:
            v = table[k].to_numpy()
            change |= v[1:] != v[:-1]
        starts = np.r_[0, np.flatnonzero(change) + 1]
        sizes = np.diff(np.r_[starts, table.num_rows])
        for s, n in zip(starts[:-1][sizes[:-1] > 1].tolist(), sizes[:-1][sizes[:-1] > 1].tolist()):
            yield table.slice(s, n)
        held = table.slice(int(starts[-1]))
    if held is not None and held.num_rows > 1:
        yield held


def collected(df: DataFrame) -> list[np.ndarray]:
    """The columns of a small result (bounded by a parameter) as numpy arrays,
    without a detour through rows or pandas."""
    table = df.toArrow()
    return [table[c].combine_chunks().to_numpy(zero_copy_only=False) for c in table.column_names]


def frame(schema: pa.Schema, columns: Sequence) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
