"""Load-history control table: status, watermarks and stream offsets.

The history is append-only; a row is identified by (table_name, load_id)
and a later ``version`` of the same row wins (that is how "mark
validated" updates it without rewriting).  Status order: 'Initial'
(offsets recorded) < 'Successful' (loaded).  A table counts as
initialised with either status; preloaded and validated need
'Successful' -- one documented order instead of two conflicting checks.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HISTORY_SCHEMA = ("table_name STRING, load_id BIGINT, version BIGINT, load_date BIGINT, last_message_id BIGINT,"
                  " status STRING, is_preloaded BOOLEAN, ending_offset BIGINT, is_validated BOOLEAN,"
                  " validated_date BIGINT")
HISTORY_COLUMNS = [f.split()[0] for f in HISTORY_SCHEMA.split(", ")]
INITIAL, SUCCESSFUL = "Initial", "Successful"


SUMMARY_SCHEMA = ("table STRING, topic STRING, partition INT, n BIGINT, reads BIGINT, first_time BIGINT, last_time BIGINT,"
                  " first_message_id BIGINT, last_message_id BIGINT")
PROGRESS_SCHEMA = "load_id BIGINT, topic STRING, partition INT, last_message_id BIGINT, event_time BIGINT, n BIGINT"


def step_summary(journal: DataFrame) -> DataFrame:
    """Per table, topic and partition: rows, snapshot reads, bounds of event time and offset.  Summaries of disjoint
    sets of rows can be merged."""
    return journal.groupBy("table", "topic", "partition").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("operation") == "r", 1)).alias("reads"),
        F.min("event_time").alias("first_time"), F.max("event_time").alias("last_time"),
        F.min("message_id").alias("first_message_id"), F.max("message_id").alias("last_message_id"))


def merged_summary(summaries: DataFrame) -> DataFrame:
    return summaries.groupBy("table", "topic", "partition").agg(
        F.sum("n").alias("n"), F.sum("reads").alias("reads"), F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"),
        F.min("first_message_id").alias("first_message_id"), F.max("last_message_id").alias("last_message_id"))


def summary_offsets(summary: DataFrame) -> DataFrame:
    """(topic, partition, offset): the next offset of every partition seen, as ``partition_offsets`` finds it in the
    journal, from its summary."""
    return summary.filter("topic IS NOT NULL").groupBy("topic", "partition").agg((F.max("last_message_id") + 1).alias("offset"))


def batch_progress(journal: DataFrame, batch_col: str) -> DataFrame:
    """High-water marks of each applied batch per topic and partition: offsets of different ones do not compare."""
    return journal.groupBy(F.col(batch_col).alias("load_id"), "topic", "partition").agg(
        F.max("message_id").alias("last_message_id"), F.max("event_time").alias("event_time"), F.count("*").alias("n"))


def effective(history: DataFrame) -> DataFrame:
    """Latest version of each (table_name, load_id)."""
    latest = history.groupBy("table_name", "load_id").agg(
        F.max_by(F.struct(*[c for c in HISTORY_COLUMNS if c not in ("table_name", "load_id")]), "version")
        .alias("_r"))
    return latest.select("table_name", "load_id", "_r.*").select(*HISTORY_COLUMNS)


def batch_history_rows(journal: DataFrame, batch_col: str, loaded_at_ns: int) -> DataFrame:
    """One 'all' row per applied batch: high-water message id and event time."""
    return journal.groupBy(F.col(batch_col).alias("load_id")).agg(
        F.max("message_id").alias("last_message_id"), F.max("event_time").alias("validated_date")
    ).select(F.lit("all").alias("table_name"), "load_id", F.lit(0).cast("long").alias("version"),
             F.lit(loaded_at_ns).cast("long").alias("load_date"), "last_message_id",
             F.lit(SUCCESSFUL).alias("status"), F.lit(False).alias("is_preloaded"),
             F.lit(-1).cast("long").alias("ending_offset"), F.lit(False).alias("is_validated"),
             "validated_date")


def batch_history_row(load_id: int, last_message_id: int | None, event_time: int | None, loaded_at_ns: int) -> tuple:
    """The same for one batch whose marks are known (in the order of the history's columns)."""
    return "all", load_id, 0, loaded_at_ns, last_message_id, SUCCESSFUL, False, -1, False, event_time


def offset_history_rows(starting: DataFrame, journal: DataFrame, loaded_at_ns: int) -> DataFrame:
    """'Initial' rows after the bootstrap: per table, the starting offset
    plus the snapshot reads ('r') journaled for it.

    ``starting``: (table_name, starting_offset).  The journal side is
    pre-aggregated per table before the (tiny) join; the result equals a
    left join counting matches, including repeated offset rows.
    """
    reads = journal.filter(F.col("operation") == "r").groupBy(F.col("table").alias("table_name")) \
        .agg(F.count("message_id").alias("_reads"))
    so = starting.groupBy("table_name").agg(F.max("starting_offset").alias("_so"), F.count("*").alias("_k"))
    return so.join(reads, on="table_name", how="left").select(
        "table_name", F.lit(0).cast("long").alias("load_id"), F.lit(0).cast("long").alias("version"),
        F.lit(loaded_at_ns).cast("long").alias("load_date"), F.lit(-1).cast("long").alias("last_message_id"),
        F.lit(INITIAL).alias("status"), F.lit(True).alias("is_preloaded"),
        (F.col("_so") + F.col("_k") * F.coalesce(F.col("_reads"), F.lit(0))).cast("long").alias("ending_offset"),
        F.lit(False).alias("is_validated"), F.lit(None).cast("long").alias("validated_date"))


def _table_flags(history: DataFrame) -> DataFrame:
    h = effective(history)
    ok = F.col("status") == SUCCESSFUL
    return h.groupBy("table_name").agg(
        F.max(F.col("status").isin(INITIAL, SUCCESSFUL)).alias("initialized"),
        F.max(ok & F.coalesce(F.col("is_preloaded"), F.lit(False))).alias("preloaded"),
        F.max(ok & F.coalesce(F.col("is_preloaded"), F.lit(False))
              & F.coalesce(F.col("is_validated"), F.lit(False))).alias("validated"))


def required_tables(spark: SparkSession, tables: str | list[str]) -> DataFrame:
    csv = tables if isinstance(tables, str) else ",".join(tables)
    return spark.range(1).select(F.explode(F.split(F.lit(csv), ",")).alias("table_name")).distinct()


def table_status(history: DataFrame, tables: str | list[str]) -> DataFrame:
    """Per required table: initialized / preloaded / validated."""
    req = required_tables(history.sparkSession, tables)
    flags = _table_flags(history)
    return req.join(flags, on="table_name", how="left").select(
        "table_name", *[F.coalesce(F.col(c), F.lit(False)).alias(c)
                        for c in ("initialized", "preloaded", "validated")])


def load_status(history: DataFrame, tables: str | list[str]) -> DataFrame:
    """One row: each flag is true only if every listed table qualifies;
    a validated set implies preloaded, preloaded implies initialized."""
    st = table_status(history, tables).agg(
        F.min("initialized").alias("i"), F.min("preloaded").alias("p"), F.min("validated").alias("v"))
    return st.select((F.col("i") | F.col("p") | F.col("v")).alias("is_initialized"),
                     (F.col("p") | F.col("v")).alias("is_preloaded"),
                     F.col("v").alias("is_preloaded_validated"))


def watermarks(history: DataFrame) -> DataFrame:
    """Last validated time and the next one to validate (latest unvalidated
    successful load after it).  One row; scalar subquery, no cross join."""
    h = effective(history)
    return h.sparkSession.sql(
        """
        SELECT max(validated_date) FILTER (WHERE status = 'Successful' AND is_validated) AS last_validated_ns,
               max(validated_date) FILTER (WHERE status = 'Successful' AND NOT is_validated
                   AND validated_date > (SELECT max(validated_date) FROM {h}
                                         WHERE status = 'Successful' AND is_validated)) AS next_validated_ns
        FROM {h}
        """, h=h)


def mark_validated(history: DataFrame, lo: int | None, hi: int, version: int) -> DataFrame:
    """New versions of the successful rows whose validated_date is in (lo, hi]."""
    h = effective(history)
    cond = (F.col("status") == SUCCESSFUL) & (F.col("validated_date") <= F.lit(hi))
    if lo is not None:
        cond = cond & (F.col("validated_date") > F.lit(lo))
    return (h.filter(cond & ~F.coalesce(F.col("is_validated"), F.lit(False)))
            .withColumn("is_validated", F.lit(True)).withColumn("version", F.lit(version).cast("long"))
            .select(*HISTORY_COLUMNS))


def mark_preloaded(history: DataFrame, tables: list[str], loaded_at_ns: int) -> DataFrame:
    """'Initial' -> 'Successful' for the tables that were loaded: new versions of their rows."""
    h = effective(history).filter((F.col("status") == INITIAL) & F.col("is_preloaded") & F.col("table_name").isin(tables))
    return h.withColumns({"status": F.lit(SUCCESSFUL), "load_date": F.lit(loaded_at_ns).cast("long"),
                          "version": F.col("version") + 1}).select(*HISTORY_COLUMNS)


def mark_preload_validated(history: DataFrame, tables: list[str], cutoff_ns: int) -> DataFrame:
    """The preloaded rows of the tables, validated as of the cut-off: from there the watermarks start."""
    h = effective(history).filter((F.col("status") == SUCCESSFUL) & F.col("is_preloaded") & F.col("table_name").isin(tables)
                                  & ~F.coalesce(F.col("is_validated"), F.lit(False)))
    return h.withColumns({"is_validated": F.lit(True), "validated_date": F.lit(cutoff_ns).cast("long"),
                          "version": F.col("version") + 1}).select(*HISTORY_COLUMNS)


def partition_offsets(journal: DataFrame) -> DataFrame:
    """(topic, partition, offset): the next offset after what is journaled, for every partition seen."""
    return journal.filter("topic IS NOT NULL").groupBy("topic", "partition").agg((F.max("message_id") + 1).alias("offset"))


def offset_lookup(history: DataFrame, topics: dict[str, str], positions: DataFrame) -> DataFrame:
    """Start offset of every partition of the topics of preloaded tables: where the journal stands
    (``positions``), or 0 in partition 0 if nothing of the topic was journaled."""
    h = effective(history).filter(F.col("status").isin(INITIAL, SUCCESSFUL) & F.col("is_preloaded"))
    topic_map = F.create_map(*[x for kv in topics.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    ready = h.filter(F.col("table_name").isin(list(topics))).select("table_name").distinct().select(
        "table_name", topic_map[F.col("table_name")].alias("topic"))
    return ready.join(positions, "topic", "left").select(
        "table_name", "topic", F.coalesce("partition", F.lit(0)).alias("partition"),
        F.coalesce("offset", F.lit(0)).cast("long").alias("offset"))


def offsets_json_column(offsets: DataFrame) -> DataFrame:
    """{"topic": {"partition": offset, ...}, ...} as one string, topics and partitions sorted."""
    entry = F.concat(F.lit('"'), F.col("partition").cast("string"), F.lit('":'), F.col("offset").cast("string"))
    inner = F.transform(F.array_sort(F.collect_list(F.struct("partition", entry.alias("e")))), lambda x: x["e"])
    topics = offsets.groupBy("topic").agg(F.array_join(inner, ",").alias("p"))  # as many as the topic has partitions
    whole = F.concat(F.lit('"'), F.col("topic"), F.lit('":{'), F.col("p"), F.lit("}"))
    return topics.agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(whole)), ","), F.lit("}")).alias("starting_offsets"))


def starting_offsets(offsets: DataFrame, required: list[str]) -> str:
    """Driver-side: the small offsets map for ``startingOffsets``; refuses to
    start when a required table has no preloaded offset."""
    rows = offsets.select("table_name", "topic", "partition", "offset").collect()
    have = {r["table_name"] for r in rows}
    missing = sorted(set(required) - have)
    if missing:
        raise RuntimeError(f"tables not preloaded: {', '.join(missing)}")
    out: dict[str, dict[str, int]] = {}
    for r in rows:
        out.setdefault(r["topic"], {})[str(r["partition"])] = int(r["offset"])
    return json.dumps(out, sort_keys=True)
