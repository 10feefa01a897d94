"""Time conversions and envelope parsing edge cases."""

import datetime

from pyspark.sql import functions as F

from helpers import RAW_SCHEMA, SENTINEL, envelope, raw_rows
from tidemark.functions.envelope import add_event_time, add_key, parse_envelope
from tidemark.functions.timeconv import day_to_date, epoch_to_ts, ns_to_ts, round_seconds_ns
from tidemark.spec import CUSTOMERS, PRODUCTS_ON_HAND


def _one(spark, expr, value, typ="long"):
    return spark.createDataFrame([(value,)], f"x {typ}").select(expr(F.col("x")).alias("y")).first()["y"]


def test_sentinel_maps_to_end_of_9999(spark):
    assert _one(spark, ns_to_ts, SENTINEL) == datetime.datetime(9999, 12, 31, 23, 59, 59, 999999)


def test_ns_to_ts_and_after_2038(spark):
    assert _one(spark, ns_to_ts, 1763475416046773700) == datetime.datetime(2025, 11, 18, 14, 16, 56, 46773)
    # 2040-01-01: no 32-bit seconds limit
    assert _one(spark, ns_to_ts, 2208988800000000000) == datetime.datetime(2040, 1, 1)


def test_ms_branch_and_unknown_unit(spark):
    assert _one(spark, lambda c: epoch_to_ts(c, "MILLISECOND"), 1000) == datetime.datetime(1970, 1, 1, 0, 0, 1)
    assert _one(spark, lambda c: epoch_to_ts(c, "SECOND"), 1000) is None


def test_round_seconds_half_up(spark):
    s = 1_000_000_000
    assert _one(spark, round_seconds_ns, 10 * s + 499_999_900) == 10 * s
    assert _one(spark, round_seconds_ns, 10 * s + 500_000_000) == 11 * s
    assert _one(spark, round_seconds_ns, -1 * s + 500_000_000) == 0            # pre-1970, half up in time
    assert _one(spark, round_seconds_ns, SENTINEL) == SENTINEL


def test_day_to_date(spark):
    assert _one(spark, day_to_date, 16816, "int") == datetime.date(2016, 1, 16)


def test_parse_tombstone_malformed_and_fields(spark):
    good = envelope("u", "customers", 99, '{"id": 1}', '{"id": 1, "valid_from": 5}')
    raw = spark.createDataFrame(raw_rows([good, None, '{"payload": {"op": '], "topic.x"), RAW_SCHEMA)
    rows = parse_envelope(raw).orderBy("offset").collect()
    assert len(rows) == 2                                   # tombstone dropped
    assert (rows[0].operation, rows[0].schema, rows[0].table, rows[0].ts_ns) == ("u", "dbo", "customers", 99)
    assert rows[0].before == '{"id":1}'                     # nested image kept as JSON text
    assert rows[1].operation is None and rows[1].table is None   # malformed: null fields


def test_key_by_op_and_table(spark):
    envs = [envelope("d", "products_on_hand", 1, '{"product_id": 7, "quantity": 1}', None),
            envelope("c", "products_on_hand_archive", 1, None, '{"product_id": 8, "valid_to": 3}'),
            envelope("c", "customers", 1, None, '{"id": 9, "valid_from": 2}'),
            envelope("d", "customers", 1, None, None)]
    raw = spark.createDataFrame(raw_rows(envs), RAW_SCHEMA)
    rows = add_event_time(add_key(parse_envelope(raw), [CUSTOMERS, PRODUCTS_ON_HAND])).orderBy("offset").collect()
    assert [r.key_id for r in rows] == [7, 8, 9, None]
    assert [r.event_time for r in rows] == [1, 3, 2, 1]


def test_archive_like_is_a_wildcard(spark):
    envs = [envelope("c", "x-archive", 1, None, '{"id": 1, "valid_from": 10, "valid_to": 20}'),
            envelope("c", "x_archive", 1, None, '{"id": 1, "valid_from": 10, "valid_to": 20}'),
            envelope("c", "xarchive", 1, None, '{"id": 1, "valid_from": 10, "valid_to": 20}'),
            envelope("c", "archive", 1, None, '{"id": 1, "valid_from": 10, "valid_to": 20}'),
            envelope("c", "x_archives", 1, None, '{"id": 1, "valid_from": 10, "valid_to": 20}')]
    raw = spark.createDataFrame(raw_rows(envs), RAW_SCHEMA)
    rows = add_event_time(parse_envelope(raw)).orderBy("offset").collect()
    assert [r.event_time for r in rows] == [20, 20, 20, 10, 10]   # '_' needs one character
