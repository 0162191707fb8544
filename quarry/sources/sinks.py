"""Sinks (S6, S9, S11): full refresh, append-only audit log, JSON reports."""

from __future__ import annotations

from pyspark.sql import DataFrame


def overwrite_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Full refresh of one table directory (never the directory ``df`` reads)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_audit(attempts: DataFrame, path: str) -> None:
    """Append fetch attempts to the audit log (input of ``apply_outcomes``).
    Appends are new files - concurrent writers never rewrite each other."""
    attempts.write.mode("append").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """A small summary frame (tallies, counts, profiles) as JSON lines in
    one file; reports are aggregates, so one partition is bounded."""
    report.coalesce(1).write.mode("overwrite").json(path)
