"""Preload: the source as of a cut-off, ready to be the first state of a store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timeconv import SENTINEL_NS
from tidemark.operators.temporal import rebuild_as_of
from tidemark.operators.validate import diff_summary
from tidemark.spec import TableSpec


def cutoff(journal: DataFrame, default_ns: int) -> DataFrame:
    """The cut-off of a preload: the latest event time of the snapshot reads, or the default (one row, ``cutoff_ns``)."""
    reads = journal.filter(F.col("operation") == "r")
    return reads.agg(F.coalesce(F.max("event_time"), F.lit(default_ns)).alias("cutoff_ns"))


def current_as_of(main: DataFrame, archive: DataFrame, t: int, spec: TableSpec) -> DataFrame:
    """The current table at t: rows as they stood then, open."""
    return rebuild_as_of(main, archive, t, spec).withColumn("valid_to", F.lit(SENTINEL_NS))


def archive_as_of(main: DataFrame, archive: DataFrame, t: int, spec: TableSpec) -> DataFrame:
    """The archive at t: versions closed by then.  ``deleted``: no version of the key starts where this
    one ends (a successor may have been closed since, so both tables are asked)."""
    closed = archive.filter((F.col("valid_to") <= F.lit(t)) & (F.col("valid_to") != F.lit(SENTINEL_NS))).select(*spec.columns)
    starts = (main.select(spec.key, F.col("valid_from").alias("valid_to"))
              .unionByName(archive.select(spec.key, F.col("valid_from").alias("valid_to")))
              .filter(F.col("valid_to") <= F.lit(t)).distinct().withColumn("_next", F.lit(True)))
    return closed.join(starts, [spec.key, "valid_to"], "left").select(*spec.columns, F.col("_next").isNull().alias("deleted"))


def validate_preload(main: DataFrame, archive: DataFrame, loaded: DataFrame, loaded_archive: DataFrame, t: int,
                     spec: TableSpec) -> DataFrame:
    """Source as of t against the loaded tables: a summary row for the current table and one for the archive."""
    columns = [*spec.columns, "deleted"] if spec.has_deleted else spec.columns
    return diff_summary(spec.name, current_as_of(main, archive, t, spec), loaded.select(*spec.columns)).unionByName(
        diff_summary(spec.archive_name, archive_as_of(main, archive, t, spec).select(*columns), loaded_archive.select(*columns)))
