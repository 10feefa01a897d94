"""The simulated topic: one pass for all ranges, each with the same number of files, oldest first."""

import os

from pyspark.sql import functions as F

from helpers import RAW_SCHEMA
from test_growth import events
from tidemark.plans import derive, queries


def jobs(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()


def by_time(path):
    files = [f"{path}/{n}" for n in os.listdir(path) if n.startswith("part-")]
    times = sorted({os.path.getmtime(f) for f in files})
    return [sorted(f for f in files if os.path.getmtime(f) == t) for t in times]


def test_the_topic_is_written_in_one_pass_however_many_ranges_it_has(spark, monkeypatch):
    sf, used, ranges = events(spark), [], []
    derive.raw_stream(spark, sf)
    monkeypatch.setattr(queries, "MICRO_BATCH_FILES", 2)
    for rows in (60, 30):
        monkeypatch.setattr(queries, "MICRO_BATCH_ROWS", rows)
        at = jobs(spark)
        path, files = queries.write_topic(spark, sf, derive.RECORD_KINDS)
        used.append(jobs(spark) - at)
        ranges.append(by_time(path))
        assert files == 2 and all(len(of) == 2 for of in ranges[-1])
        spans = [spark.read.schema(RAW_SCHEMA).parquet(*of).agg(F.min("timestamp"), F.max("timestamp")).first() for of in ranges[-1]]
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))  # what comes first is older
    assert len(ranges[1]) > len(ranges[0]) >= 3 and used[0] == used[1]


def test_a_range_with_few_records_has_as_many_files_as_any(spark, monkeypatch):
    sf = events(spark, n=20)
    monkeypatch.setattr(queries, "MICRO_BATCH_ROWS", 10)
    monkeypatch.setattr(queries, "MICRO_BATCH_FILES", 6)
    path, _ = queries.write_topic(spark, sf, derive.RECORD_KINDS)
    groups = by_time(path)
    assert len(groups) >= 3 and {len(of) for of in groups} == {6}
    assert spark.read.schema(RAW_SCHEMA).parquet(path).count() == derive.raw_stream(spark, sf).filter("timestamp IS NOT NULL").count()


def test_a_topic_that_comes_twice_is_written_once(spark, monkeypatch):
    written, real = [], queries.write_topic
    monkeypatch.setattr(queries, "write_topic", lambda *a, **k: written.append(real(*a, **k)) or written[-1])
    got = queries.q_journal_dedupe_indexed(spark, events(spark, n=40))
    assert len(written) == 1 and got.filter("key_id IS NOT NULL").count() == got.filter("key_id IS NOT NULL").distinct().count()
