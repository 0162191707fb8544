"""File listing and checksums in tasks.

Folders are expanded level by level: the folders of a level are dealt over the
tasks, which list them, and only whether there is a next level reaches the
driver.  The paths that need hashing are then dealt over the tasks, which read
each file in chunks whatever its size.  No bytes and no paths reach the driver.

Storage that only Spark's readers know is listed by a ``binaryFile`` scan
instead, whose file index is the driver's.
"""

from __future__ import annotations

from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir
from quarry.sources.tables import parallelism


def _norm_path(c):
    # the file index reports URIs (file:///x), scans report Hadoop paths (file:/x)
    return F.regexp_replace(c, r"^file:///", "file:/")


def _hidden(name: str) -> bool:
    """What file scans leave out: ``_temporary``, ``.crc`` files and the like."""
    return name.startswith(".") or name.startswith("_") and "=" not in name


def _children(glob: str):
    """mapInPandas body: what stands in the folder ``path``, and a file itself."""
    import fnmatch

    import pandas as pd
    from pyarrow import fs

    def run(batches):
        for pdf in batches:
            found = []
            for path in pdf["path"]:
                filesystem, inner = fs.FileSystem.from_uri(quote(path, safe=":/"))
                stem = path[:len(path) - len(inner)] if path.endswith(inner) else path.split(":", 1)[0] + "://"
                info = filesystem.get_file_info(inner)
                entries = [info] if info.is_file else filesystem.get_file_info(fs.FileSelector(inner))
                for e in entries:
                    folder = e.type == fs.FileType.Directory
                    if not _hidden(e.base_name) and (folder or fnmatch.fnmatchcase(e.base_name, glob)):
                        found.append((stem + e.path, None if folder else e.size, folder))
            yield pd.DataFrame(found, columns=["path", "actual_size", "folder"]).astype(
                {"path": "object", "actual_size": "Int64", "folder": "bool"})

    return run


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``(path, file_name, actual_size)`` of the files under ``path`` (or of
    the file ``path``) whose name matches ``glob``, empty ones too, without
    hidden ones.  A path that doesn't exist is an error."""
    from pyarrow import fs
    from pyarrow.lib import ArrowInvalid

    root = path if "://" in path or path.startswith("file:") else "file://" + path
    root = root.replace("file:///", "file:/").rstrip("/")
    try:
        filesystem, inner = fs.FileSystem.from_uri(quote(root, safe=":/"))
    except (ArrowInvalid, OSError):
        return _list_by_scan(spark, path, glob)
    if filesystem.get_file_info(inner).type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    ensure_checkpoint_dir(spark)
    level, files = spark.createDataFrame([(root,)], "path string"), None
    while True:
        entries = level.repartition(parallelism(spark)).mapInPandas(
            _children(glob), "path string, actual_size bigint, folder boolean").checkpoint()
        found = entries.filter("NOT folder").select("path", "actual_size")
        files = found if files is None else files.unionByName(found)
        level = entries.filter("folder").select("path")
        if not level.take(1):
            return _named(files)


def _named(files: DataFrame) -> DataFrame:
    return files.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "actual_size")


def _list_by_scan(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """The same by a scan: it reads only ``path`` and ``length``, and skips
    zero-byte files, so those are added from the scan's file index."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    scanned = df.select(_norm_path(F.col("path")).alias("path"), F.col("length").alias("actual_size"))
    # the index gives URIs: a blank in a name is %20 there
    indexed = spark.createDataFrame([(unquote(p),) for p in df.inputFiles()], "path string") \
        .select(_norm_path(F.col("path")).alias("path"))
    empty = indexed.join(scanned, "path", "left_anti").withColumn("actual_size", F.lit(0).cast("bigint"))
    return _named(scanned.unionByName(empty))


def _stream_sha256(batches):
    """mapInPandas body: chunked SHA-256 of each path through pyarrow's file
    systems (local, HDFS, S3, ...); never holds a whole file in memory."""
    import hashlib

    import pandas as pd
    from pyarrow import fs

    for pdf in batches:
        out = []
        for path in pdf["path"]:
            filesystem, inner = fs.FileSystem.from_uri(quote(path, safe=":/"))
            h = hashlib.sha256()
            with filesystem.open_input_stream(inner) as fh:
                while True:
                    chunk = fh.read(8 << 20)
                    if not chunk:
                        break
                    h.update(chunk)
            out.append(h.hexdigest())
        yield pd.DataFrame({"path": pdf["path"], "actual_sha256": out})


def checksums(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``(path, file_name, actual_size, actual_sha256)`` for every file."""
    listing = list_files(spark, path, glob)
    return listing.join(checksums_for(spark, listing), "path")


def checksums_for(spark: SparkSession, listing: DataFrame) -> DataFrame:
    """``(path, actual_sha256)`` of the listed ``path`` values only (e.g. those
    that passed the size test), hashed by chunks inside the tasks."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return listing.select("path").distinct().repartition(parts).mapInPandas(
        _stream_sha256, "path string, actual_sha256 string")
