"""Streaming ingest and apply with ``foreachBatch``.

Each micro-batch is handed to ``CdcStore.process_batch`` on the
executors' data -- no collect of messages to the driver.  A stream's
identity lies in its checkpoint folder: after a restart from the same
checkpoint, a batch that the store has is skipped; a lost or new
checkpoint is another stream, whose redelivered messages the journal
recognises.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.envelope import ENVELOPE_SCHEMA, key_expr
from tidemark.operators import control
from tidemark.operators.journal import DEDUPE_KEY
from tidemark.sources.store import CdcStore
from tidemark.spec import TableSpec


def stream_id(store: CdcStore, checkpoint: str) -> str:
    """The id kept in the checkpoint folder, made on its first use."""
    path = f"{checkpoint.rstrip('/')}/_stream_id"
    if not store.files.exists(path):
        store.files.create(path, uuid.uuid4().hex)
    return store.files.read(path)


def _start(stream: DataFrame, store: CdcStore, checkpoint: str, available_now: bool, processing_time: str | None,
           loaded_at_ns: Callable[[], int], **how) -> StreamingQuery:
    ident = stream_id(store, checkpoint)

    def step(batch: DataFrame, epoch: int) -> None:
        store.process_batch(batch, ident, epoch, loaded_at_ns=loaded_at_ns(), **how)

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def start_apply(stream: DataFrame, store: CdcStore, checkpoint: str, loaded_at_ns: Callable[[], int], available_now: bool = False,
                processing_time: str | None = None, late: str = "apply") -> StreamingQuery:
    """Journal, apply, archive and record history per micro-batch.  ``loaded_at_ns`` is asked once a batch.
    ``late="ignore"``: messages older than what was applied to their key, in any earlier batch, change nothing and are
    among the rejects."""
    return _start(stream, store, checkpoint, available_now, processing_time, loaded_at_ns, late=late)


def start_journal(stream: DataFrame, store: CdcStore, checkpoint: str, loaded_at_ns: Callable[[], int], available_now: bool = False,
                  processing_time: str | None = None) -> StreamingQuery:
    """Journal only (dedupe across batches against the stored journal); ``store.process_journal`` applies."""
    return _start(stream, store, checkpoint, available_now, processing_time, loaded_at_ns, journal_only=True)


def bootstrap(stream: DataFrame, store: CdcStore, checkpoint: str, loaded_at_ns: Callable[[], int]) -> StreamingQuery:
    """One-shot snapshot load: everything available now, journaled as
    preloaded (snapshot reads kept, no dedupe against history), then stop."""
    return _start(stream, store, checkpoint, True, None, loaded_at_ns, preloaded=True)


def dedupe_within(stream: DataFrame, specs: Iterable[TableSpec], lateness: str, time: str = "timestamp") -> DataFrame:
    """The stream's records, each message (key, operation, table, envelope time) once if its copies come within
    ``lateness`` of each other by record time.  For sources whose lateness is known: what is known of a message is
    dropped from the state when the watermark passes it, so the state is bounded by the rate and the lateness, and records
    later than that are dropped too.  Records without all four are never copies of another."""
    parsed = F.from_json(F.col("value").cast("string"), ENVELOPE_SCHEMA).getField("payload")
    columns = {"operation": "op", "table": "source.table", "ts_ns": "source.ts_ns", "before": "before", "after": "after"}
    seen = stream.withWatermark(time, lateness).select(*stream.columns, parsed.alias("_p"))
    seen = seen.select(*stream.columns, *[F.col(f"_p.{path}").alias(name) for name, path in columns.items()]).withColumn("key_id", key_expr(specs))
    whole = F.col("key_id").isNotNull() & F.col("operation").isNotNull() & F.col("table").isNotNull() & F.col("ts_ns").isNotNull()
    place = F.concat_ws("/", F.col("topic"), F.col("partition").cast("string"), F.col("offset").cast("string"))
    seen = seen.withColumn("_own", F.when(~whole, place))
    return seen.dropDuplicatesWithinWatermark([*DEDUPE_KEY, "_own"]).select(*stream.columns)


def open_from_history(store: CdcStore, topics: dict[str, str], reader: Callable[[str], DataFrame]) -> DataFrame:
    """The stream after what the store has journaled: ``reader`` gets the start offsets of every partition
    as JSON, from the journal's summary.  Refuses if a table (key of ``topics``) is not preloaded."""
    history, summary = store.history(), store.summary()
    if history is None or summary is None:
        raise RuntimeError(f"tables not preloaded: {', '.join(sorted(topics))}")
    offsets = control.offset_lookup(history, topics, control.summary_offsets(summary))
    return reader(control.starting_offsets(offsets, list(topics)))
