"""Set-based change apply: creates, updates and deletes in event-time order.

Per key, with messages in the order of (event time, message id, topic,
partition), the sequential rules are:  create inserts only if the key is
absent; update overwrites only if present; delete removes.  Snapshot
reads and messages of other tables are not applied.

The result needs three positions per key, all plain aggregates that are
combined before the shuffle: the last delete; the first create after it
(or, without a delete, the row that is there already); and the last
update.  The update wins if it comes after that base, else the base does.
Only positions travel for this -- the winning row images are fetched
afterwards by one join on (key, position), which is unique -- so a key
with a third of all messages is a few rows per task.

A row image that does not parse, or has no key, is rejected rather than
applied: see ``rejects``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import checkpoint_root
from tidemark.spec import TableSpec

MIN_LONG = -(2 ** 63)
APPLIED_OPS = ("c", "u", "d")
CORRUPT = "_corrupt"


def position_columns(msgs: DataFrame) -> list[str]:
    """What makes a message's place unique besides its event time."""
    return ["message_id", *[c for c in ("topic", "partition") if c in msgs.columns]]


def order_key(msgs: DataFrame) -> Column:
    """Total order of messages within a key; null event times sort first."""
    return F.struct(F.coalesce(F.col("event_time"), F.lit(MIN_LONG)).alias("t"),
                    *[F.col(c) for c in position_columns(msgs)])


def parsed_image(side: str, spec: TableSpec) -> Column:
    """The image with a column that holds the text if it is not a row of the table."""
    return F.from_json(F.col(side), f"{spec.row_schema}, {CORRUPT} STRING", {"columnNameOfCorruptRecord": CORRUPT})


def image_ok(side: str, spec: TableSpec) -> Column:
    image = parsed_image(side, spec)
    return F.coalesce(image[CORRUPT].isNull() & image[spec.key].isNotNull(), F.lit(False))


def _of_table(spec: TableSpec) -> Column:
    return F.col("table") == spec.name


def applicable(msgs: DataFrame, spec: TableSpec) -> DataFrame:
    """Messages that can change ``spec``'s current table: with a key, and a sound image if they bring one."""
    op = F.col("operation")
    return msgs.filter(_of_table(spec) & F.col("key_id").isNotNull()
                       & ((op == "d") | (op.isin("c", "u") & image_ok("after", spec))))


def rejects(msgs: DataFrame, spec: TableSpec) -> DataFrame:
    """Messages of the table that ask for a change but cannot make it, with the reason: a missing or
    malformed image, or no key.  A delete without a before image is not one: the key was absent."""
    op = F.col("operation")
    bad_after = op.isin("c", "u") & ~image_ok("after", spec)
    bad_before = op.isin("u", "d") & F.col("before").isNotNull() & ~image_ok("before", spec)
    reason = (F.when(bad_after & F.col("after").isNull(), "no after image").when(bad_after, "malformed after image")
              .when(bad_before, "malformed before image").when(op.isin("c", "u") & F.col("key_id").isNull(), "no key"))
    return msgs.filter(_of_table(spec) & op.isin(*APPLIED_OPS)).withColumn("reason", reason).filter("reason IS NOT NULL")


def applied_marks(msgs: DataFrame, spec: TableSpec, marks: DataFrame | None = None) -> DataFrame:
    """(key_id, last_time): the latest event time applied per key, deletes included, on top of ``marks``."""
    new = applicable(msgs, spec).select("key_id", F.col("event_time").alias("last_time"))
    both = new if marks is None else new.unionByName(marks)
    return both.groupBy("key_id").agg(F.max("last_time").alias("last_time"))


def drop_late(msgs: DataFrame, marks: DataFrame) -> DataFrame:
    """Without the messages that are older than what was applied to their key, whether it lives or not."""
    return (msgs.join(marks, on="key_id", how="left")
            .filter(F.col("last_time").isNull() | F.col("event_time").isNull() | (F.col("event_time") >= F.col("last_time")))
            .drop("last_time"))


def winners(msgs: DataFrame, existing: DataFrame | None, keys: Sequence[str] = ("key_id",)) -> DataFrame:
    """(keys, o, live): per key of ``msgs`` the position of the message whose image it ends with, or null;
    ``live``: the row that is there already stays as it is.  ``existing``: keys of live rows."""
    keys, op, o = list(keys), F.col("operation"), F.col("o")
    slim = msgs.select(*keys, "operation", order_key(msgs).alias("o"))
    bounds = slim.groupBy(*keys).agg(
        F.max(F.when(op == "d", o)).alias("d"), F.max(F.when(op == "u", o)).alias("u"),
        F.min(F.when(op == "c", o)).alias("c"), F.max(F.when(op == "c", o)).alias("c_last"))
    # one small row per key; as a table of its own, so that a hot key's side of the next join can be split
    checkpoint_root(msgs.sparkSession)
    bounds = bounds.checkpoint()
    between = bounds.filter((F.col("c") < F.col("d")) & (F.col("d") < F.col("c_last"))).select(*keys, "d")
    after = (slim.filter(op == "c").join(between, keys).filter(o > F.col("d")).select(*keys, "o")
             .hint("rebalance").groupBy(*keys).agg(F.min("o").alias("c_after")))
    found = bounds.join(after, keys, "left")
    if existing is None:
        found = found.withColumn("there", F.lit(False))
    else:
        here = existing.select(*keys).withColumn("there", F.lit(True))
        found = found.join(here, keys, "left").withColumn("there", F.coalesce("there", F.lit(False)))
    created = F.when(F.col("d").isNull() | (F.col("c") > F.col("d")), F.col("c")).otherwise(F.col("c_after"))
    keeps = F.col("there") & F.col("d").isNull()
    update = F.when(keeps | (F.col("u") > created), F.col("u"))
    return found.select(*keys, F.coalesce(update, F.when(~keeps, created)).alias("o"), (keeps & F.col("u").isNull()).alias("live"))


def apply_changes(current: DataFrame | None, msgs: DataFrame, spec: TableSpec, late: str = "apply",
                  marks: DataFrame | None = None) -> DataFrame:
    """New current table = ``current`` with ``msgs`` applied (columns: spec row fields).

    ``msgs`` needs message_id, operation, table, ts_ns, after, key_id,
    event_time (the journal layout).  Only keys in ``current`` that the
    caller passes are touched, so callers pass just the affected
    buckets of a large table.

    ``late="apply"`` (default, the reference's behaviour) applies late
    messages after what is already applied; ``late="ignore"`` drops those
    older than ``marks`` (see ``applied_marks``).
    """
    if late not in ("apply", "ignore"):
        raise ValueError(f"late must be 'apply' or 'ignore', not {late!r}")
    m = applicable(msgs, spec)
    if late == "ignore" and marks is not None:
        m = drop_late(m, marks)
    elif late == "ignore" and current is not None:
        raise ValueError("late='ignore' needs the marks of what was applied")
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.struct.fields]
    key = F.col(spec.key).cast("long")
    won = winners(m, None if current is None else current.select(key.alias("key_id")))
    images = m.select("key_id", order_key(m).alias("o"), "after").join(won.filter("o IS NOT NULL").select("key_id", "o"), ["key_id", "o"])
    # equal positions are copies of one message
    rows = images.groupBy("key_id", "o").agg(F.max("after").alias("after")).select(parsed_image("after", spec).alias("i")).select(
        *[F.col(f"i.{c}").alias(c) for c in spec.columns])
    if current is None:
        return rows
    changed = won.filter(~F.col("live")).select("key_id")
    kept = current.withColumn("key_id", key).join(changed, "key_id", "left_anti").select(*fields)
    return kept.unionByName(rows)


def archive_rows(msgs: DataFrame, spec: TableSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """History rows produced by updates and deletes (stateless, map-only).

    update: the ``before`` image closed at the new image's start, deleted 0;
    delete: the ``before`` image closed at the envelope time, deleted 1.
    A null or malformed ``before`` yields nothing, and so does an update
    whose new image is malformed.  Written whether or not a live row
    matched, as the sequential rules do.
    """
    op = F.col("operation")
    sound = image_ok("before", spec) & ((op == "d") | ((op == "u") & image_ok("after", spec)))
    m = msgs.filter(_of_table(spec) & op.isin("u", "d") & sound)
    closed_at = F.when(op == "u", parsed_image("after", spec)["valid_from"]).otherwise(F.col("ts_ns"))
    img = m.select(*keep, parsed_image("before", spec).alias("_img"), closed_at.alias("_to"), (op == "d").alias("deleted"))
    cols = [F.col("_to").alias(c) if c == "valid_to" else F.col(f"_img.{c}").alias(c) for c in spec.columns]
    return img.select(*keep, *cols, "deleted")


def project(df: DataFrame, spec: TableSpec, archive: bool = False) -> DataFrame:
    """Apply the table's select list (e.g. wire dates to DATE); on an archive table its own, with the
    deleted flag if the table has one."""
    if not archive:
        return df.selectExpr(*spec.select_list)
    flag = ["deleted"] if spec.has_deleted and "deleted" in df.columns else []
    return df.selectExpr(*spec.archive_select_list, *flag)
