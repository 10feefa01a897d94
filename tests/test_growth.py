"""Work that must not grow faster than the tables: the topic's ranges, the buckets, the folders looked at, the rounds of a selection."""

import datetime

from pyspark.sql import functions as F

from helpers import RAW_SCHEMA, envelope, raw_rows
from tidemark.operators.journal import select_batch
from tidemark.plans import derive, queries
from tidemark.session import work_dir
from tidemark.sources.store import CdcStore
from tidemark.spec import TableSpec

SPEC = TableSpec(name="items", key="id", row_schema="id BIGINT, v STRING, valid_from BIGINT, valid_to BIGINT")
START = datetime.datetime(2024, 1, 14)


def events(spark, n=120, users=4):
    """A table folder with ``n`` events a quarter of an hour apart, some at one time, one without a time."""
    path = work_dir(spark, "test-tables")
    rows = [(i, None if i == 7 else START + datetime.timedelta(minutes=15 * (i - i % 3)), i % users, ("view", "error", "buy")[i % 5 % 3], i / 2)
            for i in range(n)]
    spark.createDataFrame(rows, "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE").write.parquet(f"{path}/events.parquet")
    return path


def test_a_range_of_the_topic_is_read_from_its_own_folder(spark, monkeypatch):
    monkeypatch.setattr(queries, "MICRO_BATCH_ROWS", 40)
    sf, scans, real = events(spark), [], derive.raw_stream

    def watched(*a, **k):
        calls = spark.sparkContext.accumulator(0)
        scans.append(calls)

        def seen(batches):
            for b in batches:
                calls.add(b.num_rows)
                yield b

        found = real(*a, **k)
        return found.mapInArrow(seen, found.schema)

    monkeypatch.setattr(derive, "raw_stream", watched)
    path, files = queries.write_topic(spark, sf, derive.RECORD_KINDS)
    raw = real(spark, sf).filter("timestamp IS NOT NULL")
    topic = spark.read.schema(RAW_SCHEMA).parquet(path)
    assert files == queries.MICRO_BATCH_FILES
    assert sorted(map(str, topic.collect())) == sorted(map(str, raw.collect()))
    total = real(spark, sf).count()
    assert total > 4 * 40 and scans[0].value <= 3 * total      # counted, measured and dealt out; not once more a range


def test_the_store_has_buckets_for_its_rows_not_for_their_messages(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(queries, "buckets_for", lambda rows, per: asked.append(rows) or 1)
    queries._store(spark, events(spark))
    assert asked == [4]


def raw(spark, times, first):
    values = [envelope("c", "items", t, None, f'{{"id": {t}, "v": "v", "valid_from": {t}, "valid_to": 0}}') for t in times]
    return spark.createDataFrame([(t, p, o + first, k, v, ts) for (t, p, o, k, v, ts) in raw_rows(values)], RAW_SCHEMA)


def test_only_folders_whose_times_meet_the_batch_are_looked_at(spark):
    store = CdcStore(spark, work_dir(spark, "test-store"), [SPEC], buckets=2)
    for k in range(3):                                            # all of one day
        store.process_batch(raw(spark, range(100 * k, 100 * k + 20), 1000 * k), "s", k, journal_only=True)
    looked, real = [], store._open

    def watched(kind, folders, schema):
        folders = list(folders)
        looked.extend(f for f in folders if kind == "index")
        return real(kind, folders, schema)

    store._open = watched
    store.process_batch(raw(spark, range(400, 420), 5000), "s", 3, journal_only=True)
    assert looked == []
    store.process_batch(raw(spark, range(110, 130), 6000), "s", 4, journal_only=True)     # half of them again
    assert looked == [store.state()["journal"][1]["folder"]] and store.journal().count() == 90
    old = store.state()["journal"]
    assert all(CdcStore._may_hold({k: v for k, v in j.items() if k != "span"}, [0, 1]) for j in old)


def test_new_messages_have_no_more_parts_than_the_batch(spark):
    store, parts, real = CdcStore(spark, work_dir(spark, "test-store"), [SPEC], buckets=2), [], CdcStore._write_index
    store._write_index = lambda folder, rows: (parts.append(rows.rdd.getNumPartitions()), real(store, folder, rows))
    name = "spark.sql.shuffle.partitions"
    kept = spark.conf.get(name)
    spark.conf.set(name, "64")
    try:
        store.process_batch(raw(spark, range(50), 0).coalesce(2), "s", 0, journal_only=True)
    finally:
        spark.conf.set(name, kept)
    assert parts and parts[0] <= spark.sparkContext.defaultParallelism and store.journal().count() == 50


def test_the_rounds_of_a_selection_do_not_derive_the_messages_again(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    msgs = spark.range(0, 1000, 1, 4).select(F.col("id").alias("message_id"), (F.col("id") % 50).alias("event_time"))
    msgs = msgs.mapInArrow(counted, msgs.schema)
    assert select_batch(msgs, 30).count() == 40                  # two times of 20 messages
    assert seen.value <= 2 * 1000                                # for the bounds, and for the batch
