"""Temporal queries over a system-versioned pair (main + archive).

Periods are epoch-ns longs; the open end is the sentinel, tested before
any comparison (as a number it sorts first).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timeconv import NS_PER_S, SENTINEL_NS, round_seconds_ns
from tidemark.spec import TableSpec

HALF_SECOND = NS_PER_S // 2  # what rounding to whole seconds moves a time by, at most


def _ends_after(vt: Column, t: Column, closed: bool) -> Column:
    open_end = vt == F.lit(SENTINEL_NS)
    return open_end | ((t <= vt) if closed else (t < vt))


def valid_at(df: DataFrame, t: int, closed: bool = False) -> DataFrame:
    """Rows whose period contains t: [from, to] if closed else [from, to)."""
    return df.filter((F.col("valid_from") <= F.lit(t)) & _ends_after(F.col("valid_to"), F.lit(t), closed))


def _archive_at(main: DataFrame, archive: DataFrame, t: int, spec: TableSpec, closed: bool) -> DataFrame:
    """Archive rows valid at t with no main successor starting at their end (<= t)."""
    succ = (main.filter(F.col("valid_from") <= F.lit(t))
            .select(F.col(spec.key), F.col("valid_from").alias("valid_to")))
    return valid_at(archive, t, closed).join(succ, on=[spec.key, "valid_to"], how="left_anti")


def snapshot_size(main: DataFrame, archive: DataFrame, t: int, spec: TableSpec,
                  closed: bool = True) -> DataFrame:
    """Rows a snapshot as of t holds: live rows started by t plus archive rows
    valid at t without a successor (no per-key dedupe, as the sizing rule
    does), and for the archive table the rows closed by t.
    One row per table: (table_name, ending_offset)."""
    live = main.filter(F.col(spec.date_key) <= F.lit(t)).select(F.lit(1).alias("one"))
    hist = _archive_at(main, archive, t, spec, closed).select(F.lit(1).alias("one"))
    main_n = live.unionByName(hist).agg(F.count("*").alias("ending_offset")) \
        .select(F.lit(spec.name).alias("table_name"), "ending_offset")
    closed_by = (F.col("valid_to") <= F.lit(t)) & (F.col("valid_to") != F.lit(SENTINEL_NS))
    arch_n = archive.filter(closed_by).agg(F.count("*").alias("ending_offset")) \
        .select(F.lit(spec.archive_name).alias("table_name"), "ending_offset")
    return main_n.unionByName(arch_n)


def rebuild_as_of(main: DataFrame, archive: DataFrame, t: int, spec: TableSpec,
                  closed: bool = False, valid_from_rule: str = "version") -> DataFrame:
    """The table as it was at t.

    Live rows started by t, plus per key the archive version valid at t
    (per-key maxima of valid_from and valid_to taken independently, then
    the version carrying both).  ``closed=True`` is the reference's
    closed-period test; the default is half-open.  ``valid_from_rule=
    "reference"`` projects rebuilt rows as (valid_from = version end,
    valid_to = open) like the reference's select list.
    """
    cols = spec.columns
    live = main.filter(F.col(spec.date_key) <= F.lit(t)).select(*cols)
    cand = _archive_at(main, archive, t, spec, closed)
    w = Window.partitionBy(spec.key)
    picked = (cand.withColumn("_mf", F.max("valid_from").over(w)).withColumn("_mt", F.max("valid_to").over(w))
              .filter((F.col("valid_from") == F.col("_mf")) & (F.col("valid_to") == F.col("_mt"))))
    if valid_from_rule == "reference":
        picked = picked.withColumn("valid_from", F.col("valid_to")).withColumn("valid_to", F.lit(SENTINEL_NS))
    return live.unionByName(picked.select(*cols))


def window_rows(main: DataFrame, archive: DataFrame, lo: int, hi: int, spec: TableSpec) -> DataFrame:
    """Rows that validate the window (lo, hi] of a current table.

    Live rows that started in the window, plus per key the archive version
    that was current at hi, started after lo and has no live successor
    starting at its end by hi.  For keys gone from the live table
    (deleted) times compare at whole seconds -- the warehouse closes them
    at the envelope time, which is not the source's own period end -- and
    the closing time is reported rounded.
    """
    key = spec.key
    cols = spec.columns
    part_a = main.filter((F.col("valid_from") > F.lit(lo)) & (F.col("valid_from") <= F.lit(hi))).select(*cols)
    live = main.select(F.col(key), F.col("valid_from").alias("_m_from"), F.lit(True).alias("_live"))
    # a superset that the scan can skip by: the period ends half a second before hi or later, or is open
    near = ((F.col("valid_from") > F.lit(lo)) & (F.col("valid_from") <= F.lit(hi + HALF_SECOND))
            & ((F.col("valid_to") >= F.lit(hi - HALF_SECOND)) | (F.col("valid_to") == F.lit(SENTINEL_NS))))
    a = archive.select(*cols).filter(near).join(live, on=key, how="left")
    gone = F.col("_live").isNull()

    def p(c: Column) -> Column:
        return F.when(gone, round_seconds_ns(c)).otherwise(c)

    vt_open = F.col("valid_to") == F.lit(SENTINEL_NS)
    hit = ((F.col("valid_from") > F.lit(lo))
           & (p(F.col("valid_from")) <= p(F.lit(hi)))
           & (vt_open | (p(F.lit(hi)) <= p(F.col("valid_to"))))
           & ~F.coalesce((F.col("_m_from") == F.col("valid_to")) & (F.col("_m_from") <= F.lit(hi)), F.lit(False)))
    w = Window.partitionBy(key)
    picked = (a.filter(hit).withColumn("_mf", F.max("valid_from").over(w))
              .withColumn("_mt", F.max("valid_to").over(w))
              .filter((F.col("valid_from") == F.col("_mf")) & (F.col("valid_to") == F.col("_mt")))
              .withColumn("valid_to", p(F.col("valid_to"))))
    return part_a.unionByName(picked.select(*cols))


def archive_window_rows(main: DataFrame, archive: DataFrame, lo: int, hi: int, spec: TableSpec) -> DataFrame:
    """Archive rows closed in (lo, hi]; for deleted keys the close time is
    compared and reported at whole seconds."""
    key = spec.key
    cols = spec.columns
    live = main.select(F.col(key), F.lit(True).alias("_live"))
    near = (F.col("valid_to") > F.lit(lo - HALF_SECOND)) & (F.col("valid_to") <= F.lit(hi + HALF_SECOND))
    a = archive.select(*cols).filter(near).join(live, on=key, how="left")
    gone = F.col("_live").isNull()
    vt = F.when(gone, round_seconds_ns(F.col("valid_to"))).otherwise(F.col("valid_to"))
    hi_p = F.when(gone, round_seconds_ns(F.lit(hi))).otherwise(F.lit(hi))
    return a.filter((vt > F.lit(lo)) & (vt <= hi_p)).withColumn("valid_to", vt).select(*cols)


def suggest_cutoff(mains: list[DataFrame], col: str = "valid_from") -> DataFrame:
    """Second-latest distinct period start across tables (the min of the top
    two distinct values; the latest if there is only one), a safe default
    cut-off.  Two partial aggregates through a scalar subquery: no distinct
    shuffle, no sort, no cross join."""
    starts = None
    for df in mains:
        s = df.select(F.col(col).alias("v"))
        starts = s if starts is None else starts.unionByName(s)
    return starts.sparkSession.sql(
        "SELECT coalesce(max(v) FILTER (WHERE v < (SELECT max(v) FROM {s})), max(v)) AS cutoff_ns FROM {s}",
        s=starts)
