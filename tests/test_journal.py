"""Journal dedupe and bounded batch selection."""

from conftest import MSG_SCHEMA
from tidemark.operators.journal import batch_ranges, dedupe, in_range, select_batch, to_messages, unprocessed


def _m(mid, op, key, ts, et=None, table="t", after=None):
    return (mid, op, "dbo", table, ts, None, after, key, ts if et is None else et)


def test_dedupe_within_and_across_batches(spark):
    journal = spark.createDataFrame([_m(1, "u", 5, 100)], MSG_SCHEMA)
    batch = spark.createDataFrame([
        _m(10, "u", 5, 100),            # already journaled
        _m(11, "u", 6, 200), _m(12, "u", 6, 200),   # copy inside the batch: keeps the lower id
        _m(13, "r", 7, 300),            # snapshot read: dropped
        _m(14, None, 8, 300),           # null op: dropped
        _m(15, "d", None, 100),         # null key: never matches the journal
    ], MSG_SCHEMA)
    out = sorted((r.message_id, r.operation, r.key_id) for r in dedupe(batch, journal).collect())
    assert out == [(11, "u", 6), (15, "d", None)]


def test_dedupe_preloaded_keeps_reads(spark):
    batch = spark.createDataFrame([_m(1, "r", 7, 300), _m(2, "r", 7, 300)], MSG_SCHEMA)
    assert [r.message_id for r in dedupe(batch, None, preloaded=True).collect()] == [1]


def test_select_batch_keeps_ties_together(spark):
    rows = [_m(i, "u", i, 0, et=t) for i, t in enumerate([5, 1, 3, 3, 3, 9, None, 7], start=1)]
    df = spark.createDataFrame(rows, MSG_SCHEMA)
    got = sorted(r.message_id for r in select_batch(df, 3).collect())
    # first 3 by (event_time nulls first, id): 7 (null), 2 (t=1), 3 (t=3); ties at t=3 join: 4, 5
    assert got == [2, 3, 4, 5, 7]


def test_select_batch_skips_reads_and_applied(spark):
    schema = MSG_SCHEMA + ", topic STRING, partition INT"
    rows = [(*_m(i, op, i, 0, et=i), "t", 0) for i, op in enumerate("rcurud", start=1)]
    journal = spark.createDataFrame(rows, schema)
    applied = spark.createDataFrame([(2, "t", 0), (3, "t", 1)], "message_id BIGINT, topic STRING, partition INT")
    assert sorted(r.message_id for r in unprocessed(journal, applied).collect()) == [3, 5, 6]
    assert sorted(r.message_id for r in select_batch(journal, 2, applied).collect()) == [3, 5]


def test_batch_ranges_cover_everything_once(spark):
    times = [None, None] + [s * 1_000_000_000 for s in range(50)] * 3 + [7_000_000_001] * 20
    df = spark.createDataFrame([_m(i, "u", i, 0, et=t) if t is not None else (i, "u", "dbo", "t", 0, None, None, i, None)
                                for i, t in enumerate(times)], MSG_SCHEMA)
    ranges = batch_ranges(df, 30)
    assert len(ranges) > 3
    got = [sorted(r.message_id for r in df.filter(in_range(b)).collect()) for b in ranges]
    assert sorted(i for g in got for i in g) == list(range(len(times)))
    assert {0, 1} <= set(got[0]) and all(got)
    assert batch_ranges(df, 10**6) == [(None, None)] and batch_ranges(df.limit(0), 5) == []


def test_bad_keys_and_times_are_null(spark):
    parsed = spark.createDataFrame([("t", 0, 1, "c", "dbo", "items", 5, None, '{"id": "abc", "valid_from": "soon"}')],
                                   "topic STRING, partition INT, offset BIGINT, operation STRING, schema STRING, table STRING, ts_ns BIGINT,"
                                   " before STRING, after STRING")
    from tidemark.spec import TableSpec
    spec = TableSpec(name="items", key="id", row_schema="id BIGINT, valid_from BIGINT, valid_to BIGINT")
    row = to_messages(parsed, [spec]).first()
    assert row.key_id is None and row.event_time is None
