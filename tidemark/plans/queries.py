"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables (or data Spark derives from them)
in full, so its work grows with them.  The matching DuckDB oracle for
each lives in ``tidemark.plans.oracle``.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.envelope import add_key, parse_envelope, row_image
from tidemark.functions.timeconv import SENTINEL_NS, epoch_to_ts, ms_to_ts, ns_div, ns_to_ts, round_seconds_ns, ts_to_ns, \
    day_to_date
from tidemark.operators import control, intervals, preload, route
from tidemark.operators.apply import applied_marks, apply_changes, archive_rows, project, rejects
from tidemark.operators.journal import SOURCE_COLUMNS, dedupe, range_number, select_batch, to_messages, unprocessed
from tidemark.operators.temporal import (archive_window_rows, rebuild_as_of, snapshot_size, suggest_cutoff,
                                         window_rows)
from tidemark.operators.validate import checksum_summary, diff_summary, duplicate_keys, key_bucket, multiset_diff
from tidemark.plans import derive as d
from tidemark.plans.derive import LAST_ORDER, SPECS, T_CUTOFF, USER_STATE, WINDOW_HI, WINDOW_LO
from tidemark.session import use_utc, work_dir
from tidemark.sources.store import CdcStore, buckets_for
from tidemark.sources.streams import RAW_SCHEMA, read_topic_files
from tidemark.operators.cycle import validate_cycle
from tidemark.streaming.pipeline import bootstrap, dedupe_within, start_apply, start_journal

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
T_ORDERS = 820454400 * 1_000_000_000  # a cut-off inside the orders' dates: 1996-01-01T00:00:00Z
BATCH_ROWS = 500            # messages per apply batch (the reference's configured batch)
LOADED_AT = T_CUTOFF        # load time stamped on history rows, passed in so runs repeat
TOPICS = {USER_STATE.name: USER_STATE.topic, USER_STATE.archive_name: USER_STATE.archive_topic}
MESSAGE_VIEW = ["message_id", "operation", "schema", "table", "ts_ns", "key_id", "event_time"]


def query(name: str):
    def wrap(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return wrap


# ---------------------------------------------------------------- derived input
@query("changelog")
def q_changelog(spark, sf):
    return d.changelog(spark, sf)


def _parsed(spark, sf) -> DataFrame:
    return parse_envelope(d.raw_stream(spark, sf))


def _journal_rows(spark, sf) -> DataFrame:
    return to_messages(_parsed(spark, sf), SPECS)


# ---------------------------------------------------------------- apply
@query("apply_current")
def q_apply_current(spark, sf):
    return apply_changes(None, d.messages(spark, sf), USER_STATE)


@query("apply_archive")
def q_apply_archive(spark, sf):
    return archive_rows(d.messages(spark, sf), USER_STATE)


def _archive_topic_messages(spark, sf) -> DataFrame:
    msgs = to_messages(parse_envelope(d.raw_stream(spark, sf, kinds=("archive",))), SPECS)
    return msgs.filter(F.col("table") == USER_STATE.archive_name).drop("topic", "partition")


@query("apply_multi_table")
def q_apply_multi_table(spark, sf):
    """Route by (schema, table), all tables in one plan: messages of *_archive topics match no route."""
    allm = (d.messages(spark, sf).unionByName(d.order_messages(spark, sf))
            .unionByName(_archive_topic_messages(spark, sf)))
    rows = route.apply_routed(None, route.routed(allm, SPECS), SPECS)
    return rows.select(F.col("of_table").alias("table_name"), "key_id", F.col("valid_from__bigint").alias("valid_from"),
                       F.col("valid_to__bigint").alias("valid_to"))


HOT_USER = 999_999  # the mixed log's key with a third of all messages, within an hour


def mixed_log(spark, sf) -> tuple[DataFrame, DataFrame]:
    """A log with what real ones bring, on a table with rows: (existing rows, messages).  Every 11th update
    is a create, every 13th create an update; event times are whole hours, so that most tie; a third of the
    messages belong to one key and one hour; every 17th new image is cut off."""
    m = d.messages(spark, sf)
    op, i = F.col("operation"), F.col("message_id")
    hot = i % 3 == 0
    hour = F.lit(3_600_000_000_000)
    time = F.when(hot, F.lit(T_CUTOFF)).otherwise(F.col("event_time") - F.pmod("event_time", hour))
    after = F.when(hot, F.regexp_replace("after", '"user_id":[0-9]+', f'"user_id":{HOT_USER}')).otherwise(F.col("after"))
    m = m.withColumns({
        "operation": F.when((op == "u") & (i % 11 == 0), "c").when((op == "c") & (i % 13 == 0), "u").otherwise(op),
        "event_time": time, "key_id": F.when(hot & F.col("key_id").isNotNull(), HOT_USER).otherwise(F.col("key_id")),
        "after": F.when(i % 17 == 0, after.substr(1, 20)).otherwise(after)})
    users = d.table(spark, sf, "events").select("user_id").distinct().filter("user_id % 2 = 0")
    existing = users.select("user_id", F.lit("seed").alias("event_type"), F.lit(0.0).alias("value"), F.lit(0).cast("long").alias("valid_from"),
                            F.lit(SENTINEL_NS).alias("valid_to"))
    return existing, m


@query("apply_mixed")
def q_apply_mixed(spark, sf):
    existing, msgs = mixed_log(spark, sf)
    return apply_changes(existing, msgs, USER_STATE)


@query("apply_rejects")
def q_apply_rejects(spark, sf):
    """What the mixed log asks for and cannot have, by reason."""
    _, msgs = mixed_log(spark, sf)
    return rejects(msgs, USER_STATE).groupBy("operation", "reason").agg(F.count("*").alias("n"))


def _late(spark, sf, mode: str) -> DataFrame:
    """Late data: every 7th message arrives one batch late; it is applied
    after the on-time batch ("apply") or dropped when older than what was
    applied to its key ("ignore")."""
    m = d.messages(spark, sf)
    on_time = m.filter(F.col("message_id") % 7 != 0)
    late = m.filter(F.col("message_id") % 7 == 0)
    first = d.materialize(apply_changes(None, on_time, USER_STATE))
    return apply_changes(first, late, USER_STATE, late=mode, marks=applied_marks(on_time, USER_STATE))


@query("late_messages")
def q_late_messages(spark, sf):
    return _late(spark, sf, "apply")


@query("late_messages_ignore")
def q_late_messages_ignore(spark, sf):
    return _late(spark, sf, "ignore")


# ---------------------------------------------------------------- envelopes
@query("envelope_parse")
def q_envelope_parse(spark, sf):
    return _parsed(spark, sf).drop("before", "after")


@query("key_extract")
def q_key_extract(spark, sf):
    return add_key(_parsed(spark, sf), SPECS).select("topic", "offset", "key_id")


@query("event_time")
def q_event_time(spark, sf):
    return _journal_rows(spark, sf).select(
        F.col("message_id").alias("offset"), "operation", "table", "event_time")


@query("row_image")
def q_row_image(spark, sf):
    p = _parsed(spark, sf).filter(F.col("table") == USER_STATE.name)
    return row_image(p, USER_STATE, "after", keep=("offset",))


# ---------------------------------------------------------------- journal
def _journal_so_far(spark, sf) -> DataFrame:
    return d.messages(spark, sf).filter(F.col("event_time") <= F.lit(T_CUTOFF))


@query("journal_dedupe")
def q_journal_dedupe(spark, sf):
    """Whole topic set redelivered (e.g. after losing a checkpoint) against
    a journal holding everything up to the cut-off."""
    return dedupe(_journal_rows(spark, sf), _journal_so_far(spark, sf)).select(*MESSAGE_VIEW)


@query("duplicate_keys")
def q_duplicate_keys(spark, sf):
    return duplicate_keys(_journal_rows(spark, sf), ["key_id", "operation", "table", "ts_ns"])


def _order_stream(spark, sf) -> DataFrame:
    use_utc(spark)
    return d.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("message_id"), ts_to_ns(F.col("o_orderdate")).alias("event_time"))


@query("batch_select")
def q_batch_select(spark, sf):
    return select_batch(_order_stream(spark, sf), BATCH_ROWS)


@query("batch_select_journal")
def q_batch_select_journal(spark, sf):
    """The next batch of a journal that holds snapshot reads and has been applied up to the window's start."""
    # parsed once, stored as a journal is: both sides of the selection read it twice
    journal = d.stored(_journal_rows(spark, sf).select(*SOURCE_COLUMNS, "operation", "event_time"), "positions")
    applied = journal.filter(F.col("event_time") <= F.lit(WINDOW_LO)).select(*SOURCE_COLUMNS)
    return select_batch(journal, BATCH_ROWS, applied).select("topic", "partition", "message_id", "operation", "event_time")


@query("batch_select_third")
def q_batch_select_third(spark, sf):
    """A batch of a third of the table."""
    orders = _order_stream(spark, sf)
    return select_batch(orders, orders.count() // 3)


@query("unprocessed_intervals")
def q_unprocessed_intervals(spark, sf):
    """What is left after everything up to the window's start, and every fifth position, with redelivered copies."""
    journal = _journal_rows(spark, sf)
    done = journal.filter((F.col("event_time") <= F.lit(WINDOW_LO)) | (F.col("message_id") % 5 == 0))
    return unprocessed(journal, intervals.offset_intervals(done)).select("topic", "partition", "message_id", "operation", "event_time")


# ---------------------------------------------------------------- time functions
@query("epoch_to_ts")
def q_epoch_to_ts(spark, sf):
    use_utc(spark)
    v = d.versions(spark, sf)
    return v.select(
        "event_id", "valid_from", "valid_to",
        F.date_format(ns_to_ts("valid_from"), TS_FORMAT).alias("from_ts"),
        F.date_format(epoch_to_ts("valid_to", "NANOSECOND"), TS_FORMAT).alias("to_ts"),
        F.date_format(ms_to_ts(ns_div("valid_from", 1_000_000)), TS_FORMAT).alias("from_ms_ts"),
        epoch_to_ts("valid_from", "SECOND").isNull().alias("unknown_unit_is_null"))


@query("epoch_day_to_date")
def q_epoch_day_to_date(spark, sf):
    o = d.table(spark, sf, "orders").select("o_orderkey", F.unix_date(F.col("o_orderdate").cast("date"))
                                            .alias("order_day"))
    return o.select("o_orderkey", "order_day", F.date_format(day_to_date("order_day"), "yyyy-MM-dd")
                    .alias("order_date"))


@query("round_seconds")
def q_round_seconds(spark, sf):
    v = d.versions(spark, sf)
    return v.select("event_id", "valid_to", round_seconds_ns("valid_to").alias("rounded_ns"))


# ---------------------------------------------------------------- temporal
@query("asof_rebuild")
def q_asof_rebuild(spark, sf):
    main, arch = d.source_pair(spark, sf)
    return rebuild_as_of(main, arch, T_CUTOFF, USER_STATE)


@query("asof_rebuild_orders")
def q_asof_rebuild_orders(spark, sf):
    """Another table through its select list: the wire day becomes a date."""
    main, arch = d.order_pair(spark, sf)
    rows = project(rebuild_as_of(main, arch, T_ORDERS, LAST_ORDER), LAST_ORDER)
    return rows.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))


@query("asof_rebuild_reference")
def q_asof_rebuild_reference(spark, sf):
    main, arch = d.source_pair(spark, sf)
    return rebuild_as_of(main, arch, T_CUTOFF, USER_STATE, closed=True, valid_from_rule="reference")


@query("snapshot_size")
def q_snapshot_size(spark, sf):
    main, arch = d.source_pair(spark, sf)
    return snapshot_size(main, arch, T_CUTOFF, USER_STATE, closed=True)


@query("suggest_cutoff")
def q_suggest_cutoff(spark, sf):
    main, _ = d.source_pair(spark, sf)
    omain, _ = d.order_pair(spark, sf)
    return suggest_cutoff([main, omain])


@query("window_rows")
def q_window_rows(spark, sf):
    main, arch = d.source_pair(spark, sf)
    return window_rows(main, arch, WINDOW_LO, WINDOW_HI, USER_STATE)


@query("archive_window_rows")
def q_archive_window_rows(spark, sf):
    main, arch = d.source_pair(spark, sf)
    return archive_window_rows(main, arch, WINDOW_LO, WINDOW_HI, USER_STATE)


# ---------------------------------------------------------------- validation
DELETE_DELAY_NS = 300_000_000  # how much later than the source's period end a delete's envelope is


def faulty(main: DataFrame, archive: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Changed rows in a current table, doubled rows in an archive."""
    changed = F.when(F.col("user_id") % 13 == 5, F.col("value") + 1.0).otherwise(F.col("value"))
    return main.withColumn("value", changed), archive.unionByName(archive.filter(F.col("user_id") % 11 == 7))


def _warehouse(spark, sf) -> tuple[DataFrame, DataFrame]:
    """A warehouse with faults, stored once as the source is: lost messages, late delete times, changed and doubled rows."""
    late = F.when(F.col("operation") == "d", DELETE_DELAY_NS).otherwise(0)
    m = d.messages(spark, sf).filter(F.col("message_id") % 53 != 7).withColumns(
        {"ts_ns": F.col("ts_ns") + late, "event_time": F.col("event_time") + late})
    return faulty(d.once(spark, sf, "warehouse", lambda: apply_changes(None, m, USER_STATE)),
                  d.once(spark, sf, "warehouse archive", lambda: archive_rows(m, USER_STATE).drop("deleted")))


@query("validate_window")
def q_validate_window(spark, sf):
    main, arch = d.source_pair(spark, sf)
    wmain, warch = _warehouse(spark, sf)
    return diff_summary(USER_STATE.name, window_rows(main, arch, WINDOW_LO, WINDOW_HI, USER_STATE),
                        window_rows(wmain, warch, WINDOW_LO, WINDOW_HI, USER_STATE))


CHECKSUM_BUCKETS = 64


@query("validate_checksum")
def q_validate_checksum(spark, sf):
    """The same window by checksums of key buckets; only unequal buckets are compared row by row."""
    sides = []
    for name, (main, arch) in (("source", d.source_pair(spark, sf)), ("target", _warehouse(spark, sf))):
        path = work_dir(spark, f"window-{name}")
        rows = window_rows(main, arch, WINDOW_LO, WINDOW_HI, USER_STATE)
        rows.withColumn("bucket", key_bucket([USER_STATE.key], CHECKSUM_BUCKETS)).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)
        sides.append(spark.read.schema(f"{USER_STATE.row_schema}, bucket INT").parquet(path))
    return checksum_summary(USER_STATE.name, *sides, USER_STATE.columns)


@query("validate_archive_window")
def q_validate_archive_window(spark, sf):
    main, arch = d.source_pair(spark, sf)
    wmain, warch = _warehouse(spark, sf)
    return diff_summary(USER_STATE.archive_name, archive_window_rows(main, arch, WINDOW_LO, WINDOW_HI, USER_STATE),
                        archive_window_rows(wmain, warch, WINDOW_LO, WINDOW_HI, USER_STATE))


def _preload_check(spark, sf) -> DataFrame:
    """Source as of T against tables made another way, and with faults: every message up to T applied."""
    main, arch = d.source_pair(spark, sf)
    m = _journal_so_far(spark, sf)
    loaded, archived = faulty(apply_changes(None, m, USER_STATE), archive_rows(m, USER_STATE))
    return preload.validate_preload(main, arch, loaded, archived, T_CUTOFF, USER_STATE)


@query("validate_preload")
def q_validate_preload(spark, sf):
    return _preload_check(spark, sf).filter(F.col("table_name") == USER_STATE.name)


@query("validate_preload_archive")
def q_validate_preload_archive(spark, sf):
    return _preload_check(spark, sf).filter(F.col("table_name") == USER_STATE.archive_name)


def _injected(spark, sf) -> tuple[DataFrame, DataFrame]:
    a = d.events_ns(spark, sf)
    b = (a.filter(F.col("event_id") % 97 != 0)
         .unionByName(a.filter(F.col("event_id") % 89 == 0))
         .withColumn("value", F.when(F.col("event_id") % 83 == 0, F.col("value") + F.lit(1.0))
                     .otherwise(F.col("value"))))
    return a, b


@query("multiset_diff")
def q_multiset_diff(spark, sf):
    a, b = _injected(spark, sf)
    return multiset_diff(a, b)


# ---------------------------------------------------------------- control
@query("preload_cutoff")
def q_preload_cutoff(spark, sf):
    return preload.cutoff(_journal_rows(spark, sf), T_CUTOFF)


def _offset_history(spark, sf) -> DataFrame:
    main, arch = d.source_pair(spark, sf)
    starting = snapshot_size(main, arch, T_CUTOFF, USER_STATE, closed=True) \
        .withColumnRenamed("ending_offset", "starting_offset")
    preload_journal = dedupe(_journal_rows(spark, sf).filter(F.col("operation") == "r"), preloaded=True)
    return control.offset_history_rows(starting, preload_journal, LOADED_AT)


@query("offset_history")
def q_offset_history(spark, sf):
    return _offset_history(spark, sf)


def _batch_history(spark, sf) -> DataFrame:
    j = d.messages(spark, sf).withColumn("_batch", F.floor(F.col("event_time") / F.lit(d.DAY_NS)).cast("long"))
    return control.batch_history_rows(j, "_batch", LOADED_AT)


@query("load_history")
def q_load_history(spark, sf):
    return _batch_history(spark, sf)


def control_history(spark, sf) -> DataFrame:
    """History after bootstrap, preload (both tables loaded, main validated, archive not yet) and one apply
    batch per day from the cut-off on."""
    initial = d.materialize(_offset_history(spark, sf))
    loaded = initial.unionByName(control.mark_preloaded(initial, list(TOPICS), LOADED_AT))
    checked = loaded.unionByName(control.mark_preload_validated(loaded, [USER_STATE.name], T_CUTOFF))
    return checked.unionByName(_batch_history(spark, sf).filter(F.col("validated_date") > F.lit(T_CUTOFF)))


@query("load_history_partitions")
def q_load_history_partitions(spark, sf):
    """High-water marks of a batch a day, per topic and partition."""
    j = unprocessed(_journal_rows(spark, sf)).withColumn("_batch", F.floor(F.col("event_time") / F.lit(d.DAY_NS)).cast("long"))
    return control.batch_progress(j, "_batch")


@query("mark_validated")
def q_mark_validated(spark, sf):
    base = _batch_history(spark, sf)
    return control.mark_validated(base, WINDOW_LO, WINDOW_HI, version=1)


@query("load_status")
def q_load_status(spark, sf):
    return control.load_status(control_history(spark, sf), [USER_STATE.name, USER_STATE.archive_name])


@query("table_status")
def q_table_status(spark, sf):
    return control.table_status(control_history(spark, sf),
                                f"{USER_STATE.name},{USER_STATE.archive_name},{LAST_ORDER.name}")


@query("validation_watermarks")
def q_validation_watermarks(spark, sf):
    return control.watermarks(control_history(spark, sf))


@query("offset_lookup")
def q_offset_lookup(spark, sf):
    return _offsets(spark, sf)


def _offsets(spark, sf) -> DataFrame:
    """Start offsets of all partitions, with everything up to the cut-off journaled."""
    journal = _journal_rows(spark, sf).filter(F.col("ts_ns") <= F.lit(T_CUTOFF))
    return control.offset_lookup(control_history(spark, sf), TOPICS, control.partition_offsets(journal))


@query("starting_offsets")
def q_starting_offsets(spark, sf):
    return control.offsets_json_column(_offsets(spark, sf))


# ---------------------------------------------------------------- streaming
MICRO_BATCH_ROWS = 250_000  # records of the simulated topic in a micro-batch; at least two are made
MICRO_BATCH_FILES = 16  # files of a micro-batch: as its rows, they don't grow with the tables


def write_topic(spark: SparkSession, sf: str, kinds: tuple[str, ...], after_ns: int | None = None, until_ns: int | None = None) -> tuple[str, int]:
    """Write the simulated topic as ranges in record-time order, each as the same number of files; returns the folder and
    that number, which a file stream takes per trigger.  One shuffle deals the records to the files of all ranges; the
    files' times are set in the ranges' order afterwards, as a file stream takes the oldest first."""
    path = work_dir(spark, "topic")
    ts = F.unix_micros(F.col("timestamp"))
    raw = d.raw_stream(spark, sf, kinds=kinds)
    if after_ns is not None:
        raw = raw.filter(ts > F.lit(after_ns // 1000))
    if until_ns is not None:
        raw = raw.filter(ts <= F.lit(until_ns // 1000))
    rows = raw.count()
    parts = max(2, -(-rows // MICRO_BATCH_ROWS))
    cuts = raw.select(ts.alias("t")).approxQuantile("t", [i / parts for i in range(1, parts)], 0.1 / parts)
    if cuts:
        raw = raw.filter(F.col("timestamp").isNotNull())  # a record without a time is in no range
    bounds = [None, *[int(c) + 1 for c in cuts], None]  # a range ends with its cut
    number = range_number(list(zip(bounds[:-1], bounds[1:], strict=True)), ts)
    share = F.pmod(F.xxhash64("topic", "offset"), F.lit(MICRO_BATCH_FILES))
    ranges = len(bounds) - 1
    raw.repartitionById(ranges * MICRO_BATCH_FILES, (number * MICRO_BATCH_FILES + share).cast("int")).write.parquet(path)
    _in_order(spark, path, ranges)
    return path, MICRO_BATCH_FILES


def _in_order(spark: SparkSession, path: str, ranges: int) -> None:
    """Times for the files of a topic, a second apart from range to range; a file's task number says whose it is.  A file
    that had no records is made without any, so that every range has the same number."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)

    def files() -> list[str]:
        return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(folder)) if n.startswith("part-"))

    now, by_range = int(time.time() * 1000), {k: [] for k in range(ranges)}
    for name in files():
        by_range[int(name.split("-")[1]) // MICRO_BATCH_FILES].append(name)
    for k, names in by_range.items():
        while 0 < len(names) < MICRO_BATCH_FILES:
            seen = set(files())
            spark.createDataFrame([], RAW_SCHEMA).coalesce(1).write.mode("append").parquet(path)
            names += [n for n in files() if n not in seen]
        for name in names:
            fs.setTimes(jvm.org.apache.hadoop.fs.Path(path, name), now + 1000 * (k - ranges), -1)


def _store(spark, sf) -> CdcStore:
    """A store for ``user_state``: its current table has a row per user, not one per event."""
    users = d.table(spark, sf, "events").select("user_id").distinct().count()
    return CdcStore(spark, work_dir(spark, "store"), SPECS, buckets_for(users, 10_000))


def _run(spark, sf, store: CdcStore, start, kinds, after_ns: int | None = None, until_ns: int | None = None, times: int = 1, **how) -> None:
    """The simulated topic to its end by one stream, or by as many one after another; each has a checkpoint of its own."""
    topic, files = write_topic(spark, sf, kinds, after_ns, until_ns)
    for _ in range(times):
        start(read_topic_files(spark, topic, max_files_per_trigger=files), store, work_dir(spark, "stream"),
              lambda: LOADED_AT, **how).awaitTermination()


CHANGES = tuple(k for k in d.RECORD_KINDS if k != "snapshot")


@query("stream_journal")
def q_stream_journal(spark, sf):
    store = _store(spark, sf)
    _run(spark, sf, store, start_journal, d.RECORD_KINDS, available_now=True)
    return store.journal().select(*MESSAGE_VIEW)


@query("stream_apply")
def q_stream_apply(spark, sf):
    store = _store(spark, sf)
    _run(spark, sf, store, start_apply, d.RECORD_KINDS, available_now=True)
    return store.current(USER_STATE)


@query("stream_late_ignore")
def q_stream_late_ignore(spark, sf):
    """Every third change comes in a later micro-batch and is ignored where its key is further on, also after a delete."""
    store, path, files = _store(spark, sf), work_dir(spark, "topic"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    changes = d.raw_stream(spark, sf, kinds=("change",))
    for late in (False, True):
        changes.filter((F.col("offset") % 3 == 0) == F.lit(late)).repartition(files).write.mode("append").parquet(path)
    start_apply(read_topic_files(spark, path, max_files_per_trigger=files), store, work_dir(spark, "stream"), lambda: LOADED_AT,
                available_now=True, late="ignore").awaitTermination()
    return store.current(USER_STATE)


@query("stream_dedupe_watermark")
def q_stream_dedupe_watermark(spark, sf):
    """Copies that come within ten minutes are dropped by the state store, without a look at a journal."""
    topic, files = write_topic(spark, sf, d.RECORD_KINDS)
    path = work_dir(spark, "deduped")
    stream = dedupe_within(read_topic_files(spark, topic, max_files_per_trigger=files), SPECS, "10 minutes")
    writer = stream.writeStream.foreachBatch(lambda batch, epoch: batch.write.parquet(f"{path}/epoch={epoch}"))
    writer.option("checkpointLocation", work_dir(spark, "stream")).trigger(availableNow=True).start().awaitTermination()
    found = to_messages(parse_envelope(spark.read.parquet(path)), SPECS)
    return found.select(*[c for c in MESSAGE_VIEW if c != "message_id"])


@query("journal_dedupe_indexed")
def q_journal_dedupe_indexed(spark, sf):
    """The whole topic twice, by two streams: the second time the index tells which folders hold the messages."""
    store = _store(spark, sf)
    _run(spark, sf, store, start_journal, d.RECORD_KINDS, times=2, available_now=True)
    return store.journal().select(*MESSAGE_VIEW)


@query("journal_summary")
def q_journal_summary(spark, sf):
    """The journal's counts and bounds per table, topic and partition, merged step by step."""
    store = _store(spark, sf)
    _run(spark, sf, store, start_journal, d.RECORD_KINDS, available_now=True)
    return store.summary()


@query("stream_compacted")
def q_stream_compacted(spark, sf):
    """The archive of a stream after its steps were made one."""
    store = _store(spark, sf)
    _run(spark, sf, store, start_apply, CHANGES, available_now=True)
    store.compact()
    return store.archive_view(USER_STATE)


@query("stream_bootstrap")
def q_stream_bootstrap(spark, sf):
    store = _store(spark, sf)
    _run(spark, sf, store, bootstrap, ("snapshot",))
    return _initial_rows(spark, sf, store)


def _initial_rows(spark, sf, store: CdcStore) -> DataFrame:
    main, arch = d.source_pair(spark, sf)
    starting = snapshot_size(main, arch, T_CUTOFF, USER_STATE, closed=True) \
        .withColumnRenamed("ending_offset", "starting_offset")
    return control.offset_history_rows(starting, store.journal(), LOADED_AT)


def _preloaded(spark, sf) -> CdcStore:
    """Bootstrap, preload, and the marks that go with them."""
    store = _store(spark, sf)
    _run(spark, sf, store, bootstrap, ("snapshot",))
    store.record(lambda _: _initial_rows(spark, sf, store))
    store.preload({USER_STATE.name: d.source_pair(spark, sf)}, T_CUTOFF, LOADED_AT)
    return store


@query("preload_load")
def q_preload_load(spark, sf):
    return _preloaded(spark, sf).current(USER_STATE)


@query("preload_archive")
def q_preload_archive(spark, sf):
    return _preloaded(spark, sf).archive_view(USER_STATE)


@query("stream_bootstrap_then_apply")
def q_stream_bootstrap_then_apply(spark, sf):
    """Two streams with two checkpoints on one store: the snapshot, then everything after the cut-off."""
    store = _preloaded(spark, sf)
    _run(spark, sf, store, start_apply, CHANGES, T_CUTOFF, available_now=True)
    return store.current(USER_STATE)


@query("apply_in_batches")
def q_apply_in_batches(spark, sf):
    """The whole journal as a backlog, applied in bounded batches."""
    store = _store(spark, sf)
    _run(spark, sf, store, start_journal, CHANGES, available_now=True)
    store.process_journal(batch_rows=-(-store.journal().count() // 4), loaded_at_ns=LOADED_AT)
    return store.current(USER_STATE)


@query("process_journal")
def q_process_journal(spark, sf):
    """Journal and apply in turns: what one stream has journaled, then what another adds; redelivered
    messages are known by then."""
    store = _store(spark, sf)
    for until in (T_CUTOFF, None):  # the second delivers everything, the first's records again
        _run(spark, sf, store, start_journal, CHANGES, until_ns=until, available_now=True)
        store.process_journal(batch_rows=-(-store.journal().count() // 20), loaded_at_ns=LOADED_AT)
    return store.current(USER_STATE)


@query("validation_cycle")
def q_validation_cycle(spark, sf):
    """Preload, check, mark; apply the rest; check the next window of both tables; mark it if it holds."""
    store = _preloaded(spark, sf)
    source = d.source_pair(spark, sf)
    validate_cycle(store, source, USER_STATE, T_CUTOFF)
    _run(spark, sf, store, start_journal, CHANGES, T_CUTOFF, available_now=True)
    store.process_journal(batch_rows=1 << 40, loaded_at_ns=LOADED_AT)
    validate_cycle(store, source, USER_STATE, T_CUTOFF)
    return control.watermarks(store.history())
