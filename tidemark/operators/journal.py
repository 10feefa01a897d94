"""Message journal: dedupe against history and bounded batch selection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.envelope import event_time_expr, key_expr
from tidemark.operators.apply import MIN_LONG
from tidemark.operators.intervals import merged, outside
from tidemark.operators.selection import cut_points, nth_value
from tidemark.spec import TableSpec

MESSAGE_COLUMNS = ["operation", "schema", "table", "ts_ns", "before", "after", "key_id"]
SOURCE_COLUMNS = ["message_id", "topic", "partition"]  # together a message's own place in the stream
DEDUPE_KEY = ["key_id", "operation", "table", "ts_ns"]
DAY_NS = 86_400 * 1_000_000_000


def day_of(col: str = "ts_ns"):
    """Whole days since the epoch: the journal's partitions."""
    return F.coalesce(F.floor(F.col(col) / F.lit(float(DAY_NS))), F.lit(-1)).cast("int")


def to_messages(parsed: DataFrame, specs: Iterable[TableSpec], id_col: str = "offset") -> DataFrame:
    """Parsed envelopes -> journal rows (key and event time computed once)."""
    specs = list(specs)
    source = [F.col(c) if c in parsed.columns else F.lit(None).cast(t).alias(c) for c, t in (("topic", "string"), ("partition", "int"))]
    return parsed.select(
        F.col(id_col).cast("long").alias("message_id"), *source, *MESSAGE_COLUMNS[:-1],
        key_expr(specs).alias("key_id")).withColumn("event_time", event_time_expr())


def dedupe(batch: DataFrame, journal: DataFrame | None = None, preloaded: bool = False, parts: int | None = None) -> DataFrame:
    """New journal rows from one incoming batch.

    * duplicates inside the batch (all message columns equal) collapse to
      one row, the one with the lowest source position;
    * unless preloading, snapshot reads (op 'r') and null ops are dropped,
      and messages already journaled -- equal on (key_id, operation, table,
      ts_ns), nulls never equal -- are removed by an anti-join, on the day
      too if the journal has one.

    ``parts``: rows are dealt to that many parts by their hash, once and as they are; for a batch of a bounded size.
    Without it copies are collapsed before the shuffle too, which takes a sort of all texts more.
    """
    source = [c for c in SOURCE_COLUMNS if c in batch.columns]
    b = batch
    if not preloaded:
        b = b.filter(F.col("operation") != "r")
    # the hash comes first: sorting compares numbers, and texts only where these are equal
    b = b.select(*source, *MESSAGE_COLUMNS, F.xxhash64(*MESSAGE_COLUMNS).alias("_h"))
    if parts is None:
        b = b.groupBy("_h", *MESSAGE_COLUMNS).agg(F.min(F.struct(*source)).alias("_s")).select(*[F.col(f"_s.{c}").alias(c) for c in source], *MESSAGE_COLUMNS)
    else:
        place = Window.partitionBy("_h", *MESSAGE_COLUMNS).orderBy(*source).rowsBetween(Window.unboundedPreceding, 0)
        b = b.repartition(parts, "_h").withColumn("_n", F.count("*").over(place)).filter("_n = 1").drop("_h", "_n")
    b = b.withColumn("event_time", event_time_expr())
    return b if journal is None or preloaded else not_journaled(b, journal)


def not_journaled(batch: DataFrame, journal: DataFrame) -> DataFrame:
    """The messages that the journal does not have, by the dedupe key and, if the journal has it, the day."""
    columns, keys, b = batch.columns, DEDUPE_KEY, batch
    if "day" in journal.columns:
        b, keys = b.withColumn("day", day_of()), [*DEDUPE_KEY, "day"]
    return b.join(journal.select(*keys), on=keys, how="left_anti").select(*columns)


def unprocessed(journal: DataFrame, applied: DataFrame | None = None) -> DataFrame:
    """Journaled messages to apply: no snapshot reads, none at a position in ``applied``.  That is either a table of
    offset intervals (topic, partition, lo, hi) or of single positions."""
    j = journal.filter(F.coalesce(F.col("operation") != "r", F.lit(False)))
    if applied is None:
        return j
    if "lo" in applied.columns:
        return outside(j, merged(applied))
    on = [j[c].eqNullSafe(applied[c]) for c in SOURCE_COLUMNS if c in j.columns and c in applied.columns]
    match = on[0]
    for c in on[1:]:
        match = match & c
    return j.join(applied, match, "left_anti")


def batch_bounds(msgs: DataFrame, n: int) -> dict | None:
    """Position of the n-th message by (event_time nulls first, message_id), or of the last if there are fewer, and the
    event-time range of those up to it.  Found by counting: no stage holds the first n rows."""
    places = msgs.select("event_time", "message_id").persist()  # each round reads these, not what they are derived from
    try:
        return _bounds(places, n)
    finally:
        places.unpersist()


def _bounds(msgs: DataFrame, n: int) -> dict | None:
    nulls, total = msgs.agg(F.count("*") - F.count("event_time"), F.count("*")).first()
    if not total or n < 1:
        return None
    n = min(n, total)
    if n <= nulls:
        last_t, below, t = MIN_LONG, 0, F.col("event_time").isNull()
    else:
        last_t, below = nth_value(msgs, F.col("event_time"), n - nulls)
        below, t = below + nulls, F.col("event_time") == F.lit(last_t)
    last_m, _ = nth_value(msgs.filter(t), F.col("message_id"), n - below) or (None, 0)
    lo = msgs.agg(F.min("event_time")).first()[0] if n > nulls else None
    return {"lo": lo, "hi": last_t if n > nulls else None, "last_t": last_t, "last_m": last_m, "n": n}


def batch_condition(bounds: dict):
    """Predicate selecting the batch described by ``bounds``."""
    t = F.coalesce(F.col("event_time"), F.lit(MIN_LONG))
    in_top = (t < F.lit(bounds["last_t"])) | ((t == F.lit(bounds["last_t"]))
                                               & (F.col("message_id") <= F.lit(bounds["last_m"])))
    cond = in_top
    if bounds["lo"] is not None:
        cond = cond | F.coalesce(F.col("event_time").between(bounds["lo"], bounds["hi"]), F.lit(False))
    return cond


def select_batch(msgs: DataFrame, n: int, applied: DataFrame | None = None) -> DataFrame:
    """First n unprocessed messages plus every other one whose event time
    falls inside their [min, max] (ties are never split across batches).
    Where messages have an operation, snapshot reads are never among them."""
    if "operation" in msgs.columns:
        msgs = unprocessed(msgs, applied)
    bounds = batch_bounds(msgs, n)
    if bounds is None:
        return msgs.limit(0)
    return msgs.filter(batch_condition(bounds))


def batch_ranges(msgs: DataFrame, n: int) -> list[tuple[int | None, int | None]]:
    """Event-time ranges [lo, hi) that cut a backlog into batches of at most n messages, in order.  Equal times are never
    split, so a time with more makes a batch of its own; null times belong to the first."""
    cuts, total = cut_points(msgs, F.col("event_time"), n)
    return list(zip([None, *cuts], [*cuts, None], strict=True)) if total else []


def in_range(bounds: tuple[int | None, int | None]):
    """Plain comparisons, which a scan can skip by; null times belong to the first range."""
    lo, hi = bounds
    t = F.col("event_time")
    if lo is None:
        return F.lit(True) if hi is None else t.isNull() | (t < F.lit(hi))
    return (t >= F.lit(lo)) if hi is None else (t >= F.lit(lo)) & (t < F.lit(hi))


def range_number(ranges: list[tuple[int | None, int | None]], time: Column | None = None):
    """The number of the range that an event time (or ``time``) lies in, by halving: the expression is as deep as the
    logarithm of the number of ranges."""
    time = F.col("event_time") if time is None else time

    def among(lo: int, hi: int):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2
        return F.when(time >= F.lit(ranges[mid][0]), among(mid, hi)).otherwise(among(lo, mid - 1))

    return among(0, len(ranges) - 1)
