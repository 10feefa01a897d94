"""Change data derived from the driver's tables.

The given tables hold no change log, so one is derived from ``events``:
each user is a row of table ``user_state``; an 'error' event deletes it,
any other event creates it (first, or after a delete) or updates it.  A
second table, ``customer_last_order``, treats each order as a new
version of the customer's last order.  Everything is plain DataFrame
work that grows with the inputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.timeconv import SENTINEL_NS, ts_to_ns
from tidemark.session import checkpoint_root, use_utc, work_dir
from tidemark.spec import TableSpec

DAY_NS = 86_400 * 1_000_000_000
# Fixed points in the event range: cut-off T = 2024-01-15T00:00:00Z and
# the validation window (2024-01-10T00:00:00Z, T].
T_CUTOFF = 1705276800000000000
WINDOW_LO = 1704844800000000000
WINDOW_HI = T_CUTOFF

USER_STATE = TableSpec(
    name="user_state", key="user_id",
    row_schema="user_id BIGINT, event_type STRING, value DOUBLE, valid_from BIGINT, valid_to BIGINT",
    topic="shop.dbo.user_state", archive_topic="shop.dbo.user_state_archive")
LAST_ORDER = TableSpec(
    name="customer_last_order", key="o_custkey",
    row_schema=("o_custkey BIGINT, o_orderkey BIGINT, o_totalprice DOUBLE, order_date INT,"
                " valid_from BIGINT, valid_to BIGINT"),
    topic="shop.dbo.customer_last_order", archive_topic="shop.dbo.customer_last_order_archive",
    projection=("o_custkey", "o_orderkey", "o_totalprice", "date_from_unix_date(order_date) AS order_date",
                "valid_from", "valid_to"))
SPECS = (USER_STATE, LAST_ORDER)

# Offsets of the simulated topics: each kind of record lives in its own
# offset range so every (topic, partition, offset) is unique.
DUP_OFFSET = 1_000_000_000_000
TOMBSTONE_OFFSET = 2_000_000_000_000
MALFORMED_OFFSET = 3_000_000_000_000
SNAPSHOT_OFFSET = 4_000_000_000_000
PARTITIONS = 3  # of each simulated topic


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def neighbours(df: DataFrame, key: str, t: str, tie: str, cols: list[str], width: int = DAY_NS) -> DataFrame:
    """Add prev_<c> / next_<c>: the key's previous and next row by (t, tie).

    Skew-safe: rows are ordered inside (key, time slice) groups; the
    first/last row of each slice borrows from the neighbouring non-empty
    slice via per-slice summaries (one row per key and slice)."""
    d = df.withColumn("_sl", F.floor(F.col(t) / F.lit(width)).cast("long"))
    w = Window.partitionBy(key, "_sl").orderBy(t, tie)
    pos = F.struct(F.col(t), F.col(tie))
    row = F.struct(*[F.col(c) for c in cols])
    d = d.withColumn("_prev", F.lag(row).over(w)).withColumn("_next", F.lead(row).over(w))
    summ = d.groupBy(key, "_sl").agg(F.max_by(row, pos).alias("_last"), F.min_by(row, pos).alias("_first"))
    ws = Window.partitionBy(key).orderBy("_sl")
    summ = summ.select(key, "_sl", F.lag("_last").over(ws).alias("_pl"), F.lead("_first").over(ws).alias("_nf"))
    d = d.join(summ, on=[key, "_sl"], how="left")
    prev = F.coalesce(F.col("_prev"), F.col("_pl"))
    nxt = F.coalesce(F.col("_next"), F.col("_nf"))
    out = [F.col(c) for c in df.columns]
    out += [prev[c].alias(f"prev_{c}") for c in cols] + [nxt[c].alias(f"next_{c}") for c in cols]
    return d.select(*out)


def events_ns(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", ts_to_ns(F.col("ts")).alias("ts_ns"))


def _linked_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(events_ns(spark, sf_dir), "user_id", "ts_ns", "event_id",
                      ["event_id", "event_type", "value", "ts_ns"])


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log of ``user_state``: one message per event."""
    e = _linked_events(spark, sf_dir)
    has_prev = F.col("prev_event_id").isNotNull()
    prev_live = has_prev & (F.col("prev_event_type") != "error")
    op = (F.when(F.col("event_type") == "error", "d")
          .when(~has_prev | (F.col("prev_event_type") == "error"), "c").otherwise("u"))
    return e.select(
        F.col("event_id").alias("message_id"), F.col("user_id").alias("key_id"), op.alias("op"), "ts_ns",
        F.when(prev_live, F.col("prev_event_type")).alias("before_event_type"),
        F.when(prev_live, F.col("prev_value")).alias("before_value"),
        F.when(prev_live, F.col("prev_ts_ns")).alias("before_valid_from"),
        F.when(op != "d", F.col("event_type")).alias("after_event_type"),
        F.when(op != "d", F.col("value")).alias("after_value"),
        F.when(op != "d", F.col("ts_ns")).alias("after_valid_from"))


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source-side versions of ``user_state``: each non-error event opens a
    version closed by the user's next event of any kind."""
    e = _linked_events(spark, sf_dir).filter(F.col("event_type") != "error")
    return e.select(
        "event_id", "user_id", "event_type", "value", F.col("ts_ns").alias("valid_from"),
        F.coalesce(F.col("next_ts_ns"), F.lit(SENTINEL_NS)).alias("valid_to"),
        F.coalesce(F.col("next_event_type") == "error", F.lit(False)).alias("deleted"),
        F.col("next_ts_ns").isNull().alias("is_live"))


def materialize(df: DataFrame) -> DataFrame:
    """Store a derived input once (reliable checkpoint in spark.checkpoint.dir),
    as the source and warehouse tables it stands for would be stored."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written as Parquet and read back."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_KEPT: dict[tuple, DataFrame] = {}


def _stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """Sizes and times of the files that derived inputs come from: another table at the same place is another input."""
    jvm, conf, found = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), []
    for name in ("events", "orders"):
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            found += [(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path)]
    return tuple(sorted(found))


def once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A derived input, stored once per application and folder: queries time their own work, not this.  As Parquet, so
    that a reader of some columns or of some kinds of records reads no more than those."""
    key = (spark.sparkContext.applicationId, sf_dir, _stamp(spark, sf_dir), name)
    if key not in _KEPT:
        _KEPT[key] = stored(build(), f"derived-{name.replace(' ', '-')}")
    return _KEPT[key]


def source_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(main, archive) of the system-versioned source table ``user_state``."""
    v = once(spark, sf_dir, "versions", lambda: versions(spark, sf_dir))
    cols = USER_STATE.columns
    return v.filter("is_live").select(*cols), v.filter(~F.col("is_live")).select(*cols)


def _image(*fields: Column) -> Column:
    return F.struct(*fields)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "messages", lambda: _messages(spark, sf_dir))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_state`` change log in journal layout (JSON row images)."""
    c = changelog(spark, sf_dir)
    before = F.when(F.col("before_valid_from").isNotNull(), F.to_json(_image(
        F.col("key_id").alias("user_id"), F.col("before_event_type").alias("event_type"),
        F.col("before_value").alias("value"), F.col("before_valid_from").alias("valid_from"),
        F.lit(SENTINEL_NS).alias("valid_to"))))
    after = F.when(F.col("op") != "d", F.to_json(_image(
        F.col("key_id").alias("user_id"), F.col("after_event_type").alias("event_type"),
        F.col("after_value").alias("value"), F.col("after_valid_from").alias("valid_from"),
        F.lit(SENTINEL_NS).alias("valid_to"))))
    return c.select("message_id", F.col("op").alias("operation"), F.lit("dbo").alias("schema"),
                    F.lit(USER_STATE.name).alias("table"), "ts_ns", before.alias("before"),
                    after.alias("after"),
                    F.when((F.col("op") != "d") | F.col("before_valid_from").isNotNull(), F.col("key_id"))
                    .alias("key_id"), F.col("ts_ns").alias("event_time"))


def order_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(main, archive) of the source table ``customer_last_order``."""
    v = once(spark, sf_dir, "order versions", lambda: _order_versions(spark, sf_dir))
    cols = LAST_ORDER.columns
    return v.filter("is_live").select(*cols), v.filter(~F.col("is_live")).select(*cols)


def _order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    o = _order_rows(spark, sf_dir)
    n = neighbours(o, "o_custkey", "ts_ns", "o_orderkey", ["ts_ns"], width=365 * DAY_NS)
    return n.select("o_custkey", "o_orderkey", "o_totalprice", "order_date", F.col("ts_ns").alias("valid_from"),
                    F.coalesce(F.col("next_ts_ns"), F.lit(SENTINEL_NS)).alias("valid_to"),
                    F.col("next_ts_ns").isNull().alias("is_live"))


def _order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice",
        F.unix_date(F.col("o_orderdate").cast("date")).alias("order_date"),
        ts_to_ns(F.col("o_orderdate")).alias("ts_ns"))


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer_last_order`` change log: first order creates, later ones update."""
    use_utc(spark)
    o = _order_rows(spark, sf_dir)
    n = neighbours(o, "o_custkey", "ts_ns", "o_orderkey", ["o_orderkey", "o_totalprice", "order_date", "ts_ns"],
                   width=365 * DAY_NS)
    has_prev = F.col("prev_o_orderkey").isNotNull()
    before = F.when(has_prev, F.to_json(_image(
        F.col("o_custkey"), F.col("prev_o_orderkey").alias("o_orderkey"),
        F.col("prev_o_totalprice").alias("o_totalprice"), F.col("prev_order_date").alias("order_date"),
        F.col("prev_ts_ns").alias("valid_from"), F.lit(SENTINEL_NS).alias("valid_to"))))
    after = F.to_json(_image(F.col("o_custkey"), "o_orderkey", "o_totalprice", "order_date",
                             F.col("ts_ns").alias("valid_from"), F.lit(SENTINEL_NS).alias("valid_to")))
    return n.select(F.col("o_orderkey").alias("message_id"), F.when(has_prev, "u").otherwise("c").alias("operation"),
                    F.lit("dbo").alias("schema"), F.lit(LAST_ORDER.name).alias("table"), "ts_ns",
                    before.alias("before"), after.alias("after"), F.col("o_custkey").alias("key_id"),
                    F.col("ts_ns").alias("event_time"))


RECORD_KINDS = ("change", "duplicate", "tombstone", "malformed", "archive", "snapshot")


def raw_stream(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...] = RECORD_KINDS) -> DataFrame:
    records = once(spark, sf_dir, "records", lambda: _records(spark, sf_dir, T_CUTOFF))
    return records.filter(F.col("kind").isin(*kinds)).drop("kind")


def _records(spark: SparkSession, sf_dir: str, cutoff: int) -> DataFrame:
    """Raw stream records (Kafka column layout) for ``user_state``, in three partitions by user.

    Besides one envelope per change it carries what a real topic does:
    a tombstone after each delete, redelivered copies, malformed values,
    snapshot reads of the rows live at the cut-off, and envelopes on the
    archive topic.  The injections are chosen by event id.
    """
    c = changelog(spark, sf_dir)
    img_b = F.when(F.col("before_valid_from").isNotNull(), _image(
        F.col("key_id").alias("user_id"), F.col("before_event_type").alias("event_type"),
        F.col("before_value").alias("value"), F.col("before_valid_from").alias("valid_from"),
        F.lit(SENTINEL_NS).alias("valid_to")))
    img_a = F.when(F.col("op") != "d", _image(
        F.col("key_id").alias("user_id"), F.col("after_event_type").alias("event_type"),
        F.col("after_value").alias("value"), F.col("after_valid_from").alias("valid_from"),
        F.lit(SENTINEL_NS).alias("valid_to")))

    def envelope(op, tbl, ts, b, a) -> Column:
        return F.to_json(F.struct(F.struct(
            op.alias("op"), F.struct(F.lit("dbo").alias("schema"), F.lit(tbl).alias("table"),
                                     ts.alias("ts_ns")).alias("source"),
            b.alias("before"), a.alias("after")).alias("payload"))).cast("binary")

    main = c.select(F.lit(USER_STATE.topic).alias("topic"), F.col("message_id").alias("event_id"), "key_id", "op",
                    "ts_ns",
                    envelope(F.col("op"), USER_STATE.name, F.col("ts_ns"), img_b, img_a).alias("value"))
    main = main.withColumn("_ts", F.col("ts_ns"))
    base = main.select("topic", F.col("event_id").alias("offset"), "key_id", "value", "_ts")
    dups = main.filter(F.col("event_id") % 89 == 0).select(
        "topic", (F.col("event_id") + DUP_OFFSET).alias("offset"), "key_id", "value", "_ts")
    tombs = main.filter(F.col("op") == "d").select(
        "topic", (F.col("event_id") + TOMBSTONE_OFFSET).alias("offset"), "key_id",
        F.lit(None).cast("binary").alias("value"), "_ts")
    bad = main.filter(F.col("event_id") % 97 == 0).select(
        "topic", (F.col("event_id") + MALFORMED_OFFSET).alias("offset"), "key_id",
        F.lit('{"payload": {"op": "c", "source": ').cast("binary").alias("value"), "_ts")
    v = once(spark, sf_dir, "versions", lambda: versions(spark, sf_dir))
    arch_img = _image("user_id", "event_type", "value", "valid_from", "valid_to")
    arch = v.filter(~F.col("is_live")).select(
        F.lit(USER_STATE.archive_topic).alias("topic"), F.col("event_id").alias("offset"),
        F.col("user_id").alias("key_id"),
        envelope(F.lit("c"), USER_STATE.archive_name, F.col("valid_to"), F.lit(None), arch_img).alias("value"),
        F.col("valid_to").alias("_ts"))
    from tidemark.operators.temporal import rebuild_as_of
    mainv, archv = source_pair(spark, sf_dir)
    snap_rows = rebuild_as_of(mainv, archv, cutoff, USER_STATE).join(
        v.select("user_id", "valid_from", "event_id"), on=["user_id", "valid_from"])
    snap = snap_rows.select(
        F.lit(USER_STATE.topic).alias("topic"), (F.col("event_id") + SNAPSHOT_OFFSET).alias("offset"),
        F.col("user_id").alias("key_id"),
        envelope(F.lit("r"), USER_STATE.name, F.lit(cutoff), F.lit(None),
                 _image("user_id", "event_type", "value", "valid_from",
                        F.lit(SENTINEL_NS).alias("valid_to"))).alias("value"), F.lit(cutoff).alias("_ts"))
    parts = {"change": base, "duplicate": dups, "tombstone": tombs, "malformed": bad, "archive": arch,
             "snapshot": snap}
    allrec = None
    for kind, part in parts.items():
        part = part.withColumn("kind", F.lit(kind))
        allrec = part if allrec is None else allrec.unionByName(part)
    return allrec.select("kind", "topic", F.pmod("key_id", F.lit(PARTITIONS)).cast("int").alias("partition"), F.col("offset").cast("long").alias("offset"),
                         F.col("key_id").cast("string").cast("binary").alias("key"), "value",
                         F.timestamp_micros(F.call_function("div", F.col("_ts"), F.lit(1000))).alias("timestamp"))
