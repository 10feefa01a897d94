"""Store and streaming: every batch takes effect once, whatever is repeated, lost or new."""

import json

import pytest

from helpers import RAW_SCHEMA, envelope, raw_rows
from tidemark.operators.cycle import Differs, validate_cycle
from tidemark.operators import control
from tidemark.session import work_dir
from tidemark.sources.store import EMPTY, CdcStore, Conflict, buckets_for
from tidemark.sources.streams import read_topic_files
from tidemark.spec import TableSpec
from tidemark.streaming.pipeline import bootstrap, open_from_history, start_apply, start_journal

SPEC = TableSpec(name="items", key="id", row_schema="id BIGINT, v STRING, valid_from BIGINT, valid_to BIGINT")
OPEN = -4852116231933722724


def _img(i, v, t):
    return json.dumps({"id": i, "v": v, "valid_from": t, "valid_to": OPEN})


def _state(store):
    rows = store.current(SPEC)
    return [] if rows is None else sorted((r.id, r.v) for r in rows.collect())


def _store(spark):
    return CdcStore(spark, work_dir(spark, "test-store"), [SPEC], buckets=4)


def _raw(spark, values, first=0):
    return spark.createDataFrame([(t, p, o + first, k, v, ts) for (t, p, o, k, v, ts) in raw_rows(values)], RAW_SCHEMA)


def _topic(spark, batches):
    path = work_dir(spark, "test-topic")
    for i, rows in enumerate(batches):
        _raw(spark, rows, 10 * i).repartition(1).write.mode("append").parquet(path)
    return path


def _run(spark, store, start, path, checkpoint=None, **how):
    stream = read_topic_files(spark, path, max_files_per_trigger=1)
    start(stream, store, checkpoint or work_dir(spark, "test-stream"), lambda: 5, **how).awaitTermination()


B0 = [envelope("c", "items", 1, None, _img(1, "a", 1)), envelope("c", "items", 2, None, _img(2, "b", 2)),
      envelope("u", "items", 3, _img(2, "b", 2), _img(2, "b2", 3))]
# an update before a create: replaying it on its own result would not be idempotent
B1 = [envelope("d", "items", 4, _img(1, "a", 1), None), envelope("u", "items", 5, _img(3, "x", 4), _img(3, "x2", 5)),
      envelope("c", "items", 6, None, _img(3, "y", 6))]


def test_replayed_batch_changes_nothing(spark):
    store = _store(spark)
    store.process_batch(_raw(spark, B0), "s", 0)
    store.process_batch(_raw(spark, B1, 10), "s", 1)
    expected = [(2, "b2"), (3, "y")]
    assert _state(store) == expected
    store.process_batch(_raw(spark, B1, 10), "s", 1)              # its stream has committed it: skipped
    assert _state(store) == expected
    store.files.delete(f"{store.root}/_state/2.json")             # the writer was lost before the commit
    assert _state(store) == [(1, "a"), (2, "b2")]                 # nobody sees the half-made step
    store.process_batch(_raw(spark, B1, 10), "s", 1)
    assert _state(store) == expected
    assert store.journal().count() == 6
    arch = sorted((r.id, r.deleted) for r in store.archive(SPEC).collect())
    assert arch == [(1, True), (2, False), (3, False)]
    with pytest.raises(RuntimeError):
        store.process_batch(_raw(spark, B1, 20), "s", 3)          # epoch 2 is missing


def test_a_second_writer_is_refused(spark):
    store = _store(spark)
    store.process_batch(_raw(spark, B0), "s", 0)
    with pytest.raises(Conflict):
        store._commit(json.loads(json.dumps(EMPTY)) | {"step": 1})


def test_stream_equals_batch(spark):
    batches = [
        [envelope("c", "items", 1, None, _img(1, "a", 1)), envelope("c", "items", 1, None, _img(2, "b", 1))],
        [envelope("u", "items", 2, _img(1, "a", 1), _img(1, "a2", 2)), None, envelope("u", "items", 2, None, "\"bad\"")],
        [envelope("d", "items", 3, _img(2, "b", 1), None), envelope("c", "items", 4, None, _img(2, "c", 4))],
    ]
    store = _store(spark)
    _run(spark, store, start_apply, _topic(spark, batches), available_now=True)
    assert _state(store) == [(1, "a2"), (2, "c")]
    assert store.history().count() == 3            # one 'all' row per micro-batch
    assert [r.reason for r in store.rejected().collect()] == ["malformed after image"]
    assert {r.load_date for r in store.history().collect()} == {5}


def test_lost_checkpoint_loses_nothing_and_repeats_nothing(spark):
    store = _store(spark)
    path = _topic(spark, [B0])
    _run(spark, store, start_apply, path, available_now=True)
    _raw(spark, B1, 10).repartition(1).write.mode("append").parquet(path)
    _run(spark, store, start_apply, path, available_now=True)      # a new checkpoint: everything comes again
    assert _state(store) == [(2, "b2"), (3, "y")]
    assert store.journal().count() == 6 and store.archive(SPEC).count() == 3


def test_two_streams_share_a_store(spark):
    store = _store(spark)
    _run(spark, store, bootstrap, _topic(spark, [[envelope("r", "items", 1, None, _img(9, "snap", 1))]]))
    _run(spark, store, start_apply, _topic(spark, [B0, B1]), available_now=True)
    assert _state(store) == [(2, "b2"), (3, "y")]
    assert store.journal().count() == 7


def test_same_checkpoint_goes_on(spark):
    store, checkpoint = _store(spark), work_dir(spark, "test-stream")
    path = _topic(spark, [B0])
    _run(spark, store, start_apply, path, checkpoint, available_now=True)
    _raw(spark, B1, 10).repartition(1).write.mode("append").parquet(path)
    _run(spark, store, start_apply, path, checkpoint, available_now=True)
    assert _state(store) == [(2, "b2"), (3, "y")] and store.state()["step"] == 2


def test_journal_then_apply(spark):
    store = _store(spark)
    path = _topic(spark, [B0 + B1, [envelope("r", "items", 1, None, _img(9, "snap", 1))]])
    _run(spark, store, start_journal, path, available_now=True)
    assert store.history() is None and store.current(SPEC) is None   # journaled is not applied
    assert store.process_journal(batch_rows=2, loaded_at_ns=6) >= 1
    assert _state(store) == [(2, "b2"), (3, "y")]
    assert store.process_journal(batch_rows=2) == 0
    late = work_dir(spark, "test-topic")
    _raw(spark, [envelope("u", "items", 1, None, _img(3, "late", 1))], 100).write.parquet(late)
    _run(spark, store, start_journal, late, available_now=True)
    assert store.process_journal(batch_rows=100) == 1
    assert _state(store) == [(2, "b2"), (3, "late")]


ROWS = "id BIGINT, v STRING, valid_from BIGINT, valid_to BIGINT"


def test_preload_apply_and_validate(spark):
    s = 1_000_000_000
    main = spark.createDataFrame([(1, "a2", 30 * s, OPEN), (2, "b", 5 * s, OPEN)], ROWS)
    archive = spark.createDataFrame([(1, "a", 10 * s, 30 * s), (3, "c", 10 * s, 40 * s), (4, "d", 1 * s, 4 * s)], ROWS)
    store = _store(spark)
    with pytest.raises(RuntimeError):
        open_from_history(store, {"items": "t"}, lambda offsets: pytest.fail("the reader was opened"))
    _run(spark, store, bootstrap, _topic(spark, [[envelope("r", "items", 1, None, _img(1, "a", 10 * s)), envelope("r", "items", 1, None, _img(2, "b", 5 * s))]]))
    starting = spark.createDataFrame([("items", 0), ("items_archive", 0)], "table_name STRING, starting_offset BIGINT")
    store.record(lambda _: control.offset_history_rows(starting, store.journal(), 1))
    with pytest.raises(RuntimeError):
        validate_cycle(store, (main, archive), SPEC, 20 * s)
    store.preload({"items": (main, archive)}, 20 * s, 2)
    assert _state(store) == [(1, "a"), (2, "b"), (3, "c")]
    assert sorted((r.id, r.deleted) for r in store.archive(SPEC).collect()) == [(4, True)]
    assert open_from_history(store, {"items": "t"}, lambda offsets: offsets) == '{"t": {"0": 2}}'
    assert validate_cycle(store, (main, archive), SPEC, 20 * s) == (None, 20 * s)
    assert validate_cycle(store, (main, archive), SPEC, 20 * s) is None          # nothing new to validate
    changes = [envelope("u", "items", 30 * s + 5, _img(1, "a", 10 * s), _img(1, "a2", 30 * s)),
               envelope("d", "items", 40 * s + 300_000_000, _img(3, "c", 10 * s), None)]
    _run(spark, store, start_apply, _topic(spark, [changes]), available_now=True)
    assert validate_cycle(store, (main, archive), SPEC, 20 * s) == (20 * s, 40 * s + 300_000_000)
    with pytest.raises(RuntimeError):
        store.preload({"items": (main, archive)}, 20 * s)
    wrong = spark.createDataFrame([(1, "a3", 50 * s, OPEN), (2, "b", 5 * s, OPEN)], ROWS)
    _run(spark, store, start_apply, _topic(spark, [[envelope("u", "items", 50 * s, _img(1, "a2", 30 * s), _img(1, "a4", 50 * s))]]), available_now=True)
    closed = archive.unionByName(spark.createDataFrame([(1, "a2", 30 * s, 50 * s)], ROWS))
    with pytest.raises(Differs):
        validate_cycle(store, (wrong, closed), SPEC, 20 * s)


def test_bucket_count_follows_the_table():
    assert [buckets_for(n, 1000) for n in (0, 1, 1000, 1001, 10**6)] == [1, 1, 1, 2, 1000]
