"""Change-envelope parsing: raw stream value -> typed message columns.

``before`` and ``after`` stay JSON text (StringType) so one journal can
hold row images of every table; each table's image is parsed with its
own schema only where it is applied.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.spec import TableSpec

ENVELOPE_SCHEMA = (
    "payload STRUCT<op: STRING, source: STRUCT<schema: STRING, table: STRING, ts_ns: BIGINT>,"
    " before: STRING, after: STRING>")

META_COLUMNS = ("topic", "partition", "offset")


def parse_envelope(raw: DataFrame, keep_meta: bool = True) -> DataFrame:
    """Raw stream rows (Kafka column layout) -> one row per change message.

    Tombstones (null value) are dropped. A malformed value yields null
    fields rather than an error; those rows fail every later filter.
    """
    meta = [c for c in META_COLUMNS if keep_meta and c in raw.columns]
    parsed = (raw.filter(F.col("value").isNotNull())
              .select(*meta, F.from_json(F.col("value").cast("string"), ENVELOPE_SCHEMA)
                      .getField("payload").alias("p")))
    return parsed.select(
        *meta,
        F.col("p.op").alias("operation"),
        F.col("p.source.schema").alias("schema"),
        F.col("p.source.table").alias("table"),
        F.col("p.source.ts_ns").alias("ts_ns"),
        F.col("p.before").alias("before"),
        F.col("p.after").alias("after"),
    )


def _key_field_expr(specs: Iterable[TableSpec], image: str) -> Column:
    expr = None
    for spec in specs:
        cond = F.col("table").isin(spec.name, spec.archive_name)
        val = F.get_json_object(F.col(image), f"$.{spec.key}")
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr if expr is not None else F.lit(None).cast("string")


def key_expr(specs: Iterable[TableSpec]) -> Column:
    """Business key: from ``before`` for deletes, else from ``after``; null if it is not a whole number."""
    specs = list(specs)
    return (F.when(F.col("operation") == "d", _key_field_expr(specs, "before"))
            .otherwise(_key_field_expr(specs, "after"))).try_cast("long")


def add_key(msgs: DataFrame, specs: Iterable[TableSpec]) -> DataFrame:
    return msgs.withColumn("key_id", key_expr(specs))


def event_time_expr() -> Column:
    """Event time: the image's period start (period end on ``*_archive``
    tables, with SQL LIKE wildcard semantics) for c/u/r, else ``ts_ns``."""
    from_after = (F.when(F.col("table").like("%_archive"), F.get_json_object("after", "$.valid_to"))
                  .otherwise(F.get_json_object("after", "$.valid_from"))).try_cast("long")
    return F.when(F.col("operation").isin("c", "u", "r"), from_after).otherwise(F.col("ts_ns"))


def add_event_time(msgs: DataFrame) -> DataFrame:
    return msgs.withColumn("event_time", event_time_expr())


def row_image(msgs: DataFrame, spec: TableSpec, side: str = "after", keep: Iterable[str] = ()) -> DataFrame:
    """Parse one side's JSON image into the table's typed columns; malformed images and those without a
    key yield no row."""
    schema = f"{spec.row_schema}, _corrupt STRING"
    parsed = msgs.select(*keep, F.from_json(F.col(side), schema, {"columnNameOfCorruptRecord": "_corrupt"}).alias("_img"))
    sound = F.col("_img._corrupt").isNull() & F.col(f"_img.{spec.key}").isNotNull()
    return parsed.filter(sound).select(*keep, "_img.*").selectExpr(*keep, *spec.select_list)
