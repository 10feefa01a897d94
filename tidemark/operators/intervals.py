"""Sets of stream positions as merged offset intervals.

(topic, partition, lo, hi): all offsets from lo to hi.  Work goes by
cells of consecutive offsets of a partition, so that a topic with one
partition is spread over tasks too; nulls in topic and partition are
values like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELL_BITS = 16
PLACE = ["topic", "partition"]
SCHEMA = "topic STRING, partition INT, lo BIGINT, hi BIGINT"


def offset_intervals(msgs: DataFrame) -> DataFrame:
    """The merged intervals of the messages' positions (topic, partition, message_id)."""
    cell = F.shiftright("message_id", CELL_BITS).alias("cell")
    at = msgs.filter(F.col("message_id").isNotNull()).select(*PLACE, cell, "message_id").distinct()
    run = F.col("message_id") - F.row_number().over(Window.partitionBy(*PLACE, "cell").orderBy("message_id"))
    runs = at.withColumn("run", run).groupBy(*PLACE, "cell", "run").agg(F.min("message_id").alias("lo"), F.max("message_id").alias("hi"))
    return merged(runs.select(*PLACE, "lo", "hi"))


def merged(intervals: DataFrame) -> DataFrame:
    """Overlapping and adjoining intervals of a partition joined."""
    w = Window.partitionBy(*PLACE).orderBy("lo", "hi")
    before = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.col("lo") > before + 1, F.lit(True)).cast("int")
    group = F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = intervals.select(*PLACE, "lo", "hi", new.alias("new"))
    return marked.withColumn("g", group).groupBy(*PLACE, "g").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("g")


def outside(msgs: DataFrame, intervals: DataFrame) -> DataFrame:
    """The messages at no position of the (merged) intervals.  One sort of each cell: an interval is cut at cell bounds,
    and the last one that starts at or before a message covers it or not.  Messages without a position are outside."""
    cells = F.explode(F.sequence(F.shiftright("lo", CELL_BITS), F.shiftright("hi", CELL_BITS)))
    cut = intervals.select(*PLACE, "lo", "hi", cells.alias("_cell")).select(
        *PLACE, "_cell", F.greatest("lo", F.shiftleft("_cell", CELL_BITS)).alias("_at"), F.col("hi").alias("_hi"))
    rows = msgs.select("*", F.shiftright("message_id", CELL_BITS).alias("_cell"), F.col("message_id").alias("_at"), F.lit(None).cast("long").alias("_hi"))
    both = rows.unionByName(cut.withColumn("_interval", F.lit(True)), allowMissingColumns=True)
    w = Window.partitionBy(*PLACE, "_cell").orderBy("_at", F.col("_interval").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    covered = F.coalesce(F.last("_hi", ignorenulls=True).over(w) >= F.col("message_id"), F.lit(False))
    return both.withColumn("_covered", covered).filter("_interval IS NULL AND NOT _covered").select(*msgs.columns)
