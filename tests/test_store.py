"""The store: two writers, a backlog cut once, many tables in one plan, compaction, the index, late data."""

import json
import random

import pytest
from pyspark.sql import functions as F

from helpers import RAW_SCHEMA, SENTINEL, envelope, raw_rows
from tidemark.operators import dedupe_index, intervals
from tidemark.operators.apply import apply_changes, archive_rows, rejects
from tidemark.operators.journal import batch_ranges, in_range, range_number
from tidemark.operators.route import apply_routed, archive_routed, from_wide, rejects_routed, routed
from tidemark.operators.selection import cut_points, nth_value
from tidemark.operators.validate import checksum_summary, diff_summary, key_bucket, unequal_buckets
from tidemark.session import work_dir
from tidemark.sources.store import JOURNAL_SCHEMA, CdcStore, Conflict
from tidemark.sources.streams import read_topic_files
from tidemark.spec import TableSpec
from tidemark.streaming.pipeline import dedupe_within, start_apply

DAY = 86_400 * 1_000_000_000


def spec(n):
    kind = ("BIGINT", "STRING", "DOUBLE")[n % 3]
    return TableSpec(name=f"t{n}", key="id", row_schema=f"id BIGINT, v {kind}, valid_from BIGINT, valid_to BIGINT")


SPEC = TableSpec(name="items", key="id", row_schema="id BIGINT, v STRING, valid_from BIGINT, valid_to BIGINT")


def img(i, v, t):
    return json.dumps({"id": i, "v": v, "valid_from": t, "valid_to": SENTINEL})


def create(i, v, t, table="items"):
    return envelope("c", table, t, None, img(i, v, t))


def update(i, v, t, table="items"):
    return envelope("u", table, t, img(i, "?", t - 1), img(i, v, t))


def delete(i, t, table="items"):
    return envelope("d", table, t, img(i, "?", t - 1), None)


def raw(spark, values, first=0):
    return spark.createDataFrame([(t, p, o + first, k, v, ts) for (t, p, o, k, v, ts) in raw_rows(values)], RAW_SCHEMA)


def opened(spark, root=None, specs=(SPEC,), **how):
    return CdcStore(spark, root or work_dir(spark, "test-store"), specs, buckets=2, **how)


def rows(store, of=SPEC):
    found = store.current(of)
    return [] if found is None else sorted((r.id, r.v) for r in found.collect())


def views(store):
    return [sorted(map(str, (v.collect() if v is not None else []))) for v in (
        store.journal(), store.current(SPEC), store.archive(SPEC), store.history(), store.rejected(), store.progress(), store.summary())]


# ---------------------------------------------------------------- two writers
def test_a_writer_that_is_overtaken_between_its_write_and_its_publish(spark):
    a = opened(spark, retries=0)
    b = opened(spark, a.root)
    publish = a._commit

    def overtaken(state):
        b.process_batch(raw(spark, [create(2, "b", 2)], 10), "b", 0)
        publish(state)

    a._commit = overtaken
    with pytest.raises(Conflict):
        a.process_batch(raw(spark, [create(1, "a", 1)]), "a", 0)
    assert rows(a) == [(2, "b")] and b.journal().count() == 1
    a._commit = publish
    a.process_batch(raw(spark, [create(1, "a", 1)]), "a", 0)       # its stream brings the batch again
    assert rows(b) == [(1, "a"), (2, "b")] and b.journal().count() == 2
    before = views(a)
    gone = a.vacuum()
    assert gone and all("step=000000001" in g for g in gone) and views(a) == before


def test_a_writer_that_publishes_while_another_has_written(spark):
    a = opened(spark)
    b = opened(spark, a.root, retries=0)
    first, second = a._commit, b._commit

    def late(state):                                               # b has written, a publishes, b finds the step taken
        first(held[0])
        second(state)

    held = []

    def early(state):
        held.append(state)
        b._commit = late
        with pytest.raises(Conflict):
            b.process_batch(raw(spark, [create(2, "b", 2)], 10), "b", 0)

    a._commit = early
    a.process_batch(raw(spark, [create(1, "a", 1)]), "a", 0)
    assert rows(a) == [(1, "a")]
    b._commit = second
    b.process_batch(raw(spark, [create(2, "b", 2)], 10), "b", 0)
    assert rows(a) == [(1, "a"), (2, "b")] and a.state()["streams"] == {"a": 0, "b": 0}


def test_the_loser_does_its_batch_again_by_itself(spark):
    a = opened(spark)
    b = opened(spark, a.root)
    publish = a._commit

    def overtaken(state):
        a._commit = publish
        b.process_batch(raw(spark, [update(1, "b", 5), create(1, "zero", 1)]), "b", 0)
        publish(state)

    a._commit = overtaken
    a.process_batch(raw(spark, [update(1, "a", 7)], 10), "a", 0)
    assert rows(a) == [(1, "a")] and a.state()["step"] == 2        # applied on top of what the other wrote


# ---------------------------------------------------------------- backlog
def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_backlog_is_cut_once_and_each_step_reads_its_range(spark):
    store = opened(spark)
    r = random.Random(1)
    messages = [create(i, "v0", i + 1) for i in range(4)] + [update(r.randrange(4), f"v{k}", 50 + k) for k in range(8)]
    store.process_batch(raw(spark, messages), "s", 0, journal_only=True)
    opens, real = [], store._open

    def watched(kind, folders, schema):
        found = real(kind, folders, schema)
        if kind in ("journal", "backlog"):
            opens.append(kind)
        return found

    store._open = watched
    assert store.process_journal(batch_rows=2) == 6
    assert opens.count("journal") == 1 and opens.count("backlog") == 6
    store._open = real
    whole = opened(spark)
    whole.process_batch(raw(spark, messages), "s", 0)
    assert rows(store) == rows(whole) and len(rows(store)) == 4
    state = store.state()
    assert state["processed"] == 1 and state["backlog"] is None and state["applied"] == []
    assert store.process_journal(batch_rows=10) == 0
    assert store.progress().agg(F.sum("n")).first()[0] == 12


def test_a_step_prunes_to_its_range(spark):
    store = opened(spark)
    store.process_batch(raw(spark, [create(i, "v", i) for i in range(1, 50)]), "s", 0, journal_only=True)
    store._publish(lambda state, folder: store._cut_backlog(state, folder, 10))
    cut = store.state()["backlog"]
    assert cut["ranges"] == 5
    read = store._open("backlog", [cut["folder"]], JOURNAL_SCHEMA.split(", batch")[0] + ", range INT").filter("range = 3")
    assert "PartitionFilters: [isnotnull(range" in plan(read).replace("\n", "")
    assert len({f.split("range=")[1].split("/")[0] for f in read.inputFiles()}) >= 1 and read.count() == 10


def test_a_lost_backlog_run_is_taken_up_where_it_was(spark):
    store = opened(spark)
    store.process_batch(raw(spark, [create(i, "v", i) for i in range(1, 31)]), "s", 0, journal_only=True)
    publish, done = store._commit, []

    def lost(state):
        if len(done) == 2:
            raise OSError("the driver is gone")
        done.append(state["step"])
        publish(state)

    store._commit = lost
    with pytest.raises(OSError):
        store.process_journal(batch_rows=10)
    assert len(rows(store)) == 10 and store.applied().collect()[0].asDict() == {"topic": "t", "partition": 0, "lo": 0, "hi": 9}
    store._commit = publish
    store.process_batch(raw(spark, [update(3, "live", 100)], 100), "s", 1)      # applied while the backlog waits
    assert store.process_journal(batch_rows=5) == 2                             # the ranges that were cut, not new ones
    assert len(rows(store)) == 30 and (3, "live") in rows(store)
    assert store.process_journal(batch_rows=5) == 0 and store.state()["processed"] >= 1
    assert store.archive(SPEC).count() == 1


def test_ranges_hold_no_more_than_asked_for(spark):
    r = random.Random(4)
    times = [None] * 3 + [r.choice([5, -(2 ** 62), 2 ** 62, r.randrange(100), r.randrange(10 ** 18)]) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in times], "event_time BIGINT")
    bounds = batch_ranges(df, 30)
    sizes = [df.filter(in_range(b)) for b in bounds]
    counts = [(s.count(), s.select("event_time").distinct().count()) for s in sizes]
    assert sum(c for c, _ in counts) == len(times) and all(c <= 30 or kinds <= 1 for c, kinds in counts)
    assert len(bounds) <= 2 * len(times) // 30 + 4
    numbered = df.withColumn("k", range_number(bounds))
    assert [numbered.filter(in_range(b)).select("k").distinct().collect() for b in bounds] == [[(k,)] for k in range(len(bounds))]
    assert batch_ranges(df.limit(0), 30) == [] and batch_ranges(df, 10 ** 6) == [(None, None)]
    assert cut_points(df.filter("event_time = 5"), F.col("event_time"), 2)[0] == []


def test_the_nth_value_is_exact(spark):
    r = random.Random(5)
    values = [r.choice([r.randrange(-50, 50), r.randrange(-(2 ** 63), 2 ** 63), 7]) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v BIGINT")
    ordered = sorted(values)
    for n in (1, 2, 77, 150, 299, 300):
        assert nth_value(df, F.col("v"), n) == (ordered[n - 1], sum(v < ordered[n - 1] for v in ordered))
    assert nth_value(df, F.col("v"), 301) is None


# ---------------------------------------------------------------- positions
def test_positions_as_intervals(spark):
    r = random.Random(6)
    places = [(r.choice(["a", None]), r.choice([0, 1, None]), r.choice([r.randrange(60), r.randrange(65_500, 65_560), 10 ** 12])) for _ in range(300)]
    msgs = spark.createDataFrame(places, "topic STRING, partition INT, message_id BIGINT")
    found = intervals.offset_intervals(msgs)
    got = found.collect()
    assert {(i.topic, i.partition, o) for i in got for o in range(i.lo, i.hi + 1)} == set(places)
    ends = {(i.topic, i.partition, i.hi + 1) for i in got}
    assert not ends & {(i.topic, i.partition, i.lo) for i in got}      # adjoining ones are one
    every = [(t, p, o) for t in ("a", None) for p in (0, 1, None) for o in [*range(62), *range(65_498, 65_562), 10 ** 12, 10 ** 12 + 1, None]]
    rest = intervals.outside(spark.createDataFrame(every, "topic STRING, partition INT, message_id BIGINT"), found)
    assert sorted(map(str, map(tuple, rest.collect()))) == sorted(str(e) for e in every if e not in set(places))


# ---------------------------------------------------------------- many tables
def mixed(spark, specs, n=400):
    r, out = random.Random(7), []
    for k in range(n):
        s = r.choice(specs)
        i, t = r.randrange(12), r.randrange(40)
        v = {"BIGINT": k, "STRING": f"s{k}", "DOUBLE": k / 2}[s.row_schema.split(", ")[1].split()[1]]
        bad = r.random() < 0.05
        after = None if r.random() < 0.03 else '{"id":' if bad else json.dumps({"id": i, "v": v, "valid_from": t, "valid_to": SENTINEL})
        before = json.dumps({"id": i, "v": v, "valid_from": t - 1, "valid_to": SENTINEL})
        op = r.choice("cuuudr")
        out.append((k, op, r.choice(["dbo"] * 9 + ["other"]), s.name, t, before, None if op == "d" else after, r.choice([i] * 20 + [None]), t))
    return spark.createDataFrame(out, "message_id BIGINT, operation STRING, schema STRING, table STRING, ts_ns BIGINT, before STRING, after STRING,"
                                      " key_id BIGINT, event_time BIGINT")


def test_tables_together_are_as_tables_alone(spark):
    specs = [spec(n) for n in range(5)]
    msgs = mixed(spark, specs)
    m = routed(msgs, specs)
    first = apply_routed(None, m.filter("message_id < 200"), specs)
    whole, archived = apply_routed(first, m.filter("message_id >= 200"), specs), archive_routed(m, specs)
    show = lambda df: sorted(str(tuple(r)) for r in df.collect())
    for s in specs:
        mine = msgs.filter((F.col("schema") == "dbo") & (F.col("table") == s.name))
        alone = apply_changes(apply_changes(None, mine.filter("message_id < 200"), s), mine.filter("message_id >= 200"), s)
        assert show(from_wide(whole.filter(F.col("of_table") == s.name), s)) == show(alone)
        assert show(from_wide(archived.filter(F.col("of_table") == s.name), s, "deleted")) == show(archive_rows(mine, s))
        bad = rejects_routed(m).filter(F.col("of_table") == s.name)
        assert show(bad.select("message_id", "reason")) == show(rejects(mine, s).select("message_id", "reason"))


def test_the_number_of_jobs_does_not_grow_with_the_tables(spark):
    jobs = lambda: spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()
    used = []
    for n in (2, 20):
        specs = [spec(i) for i in range(n)]
        store = opened(spark, specs=specs)
        values = [envelope("c", s.name, 1, None, json.dumps({"id": 1, "v": None, "valid_from": 1, "valid_to": SENTINEL})) for s in specs]
        store.process_batch(raw(spark, values), "s", 0)
        at = jobs()
        store.process_batch(raw(spark, [v.replace('"op": "c"', '"op": "u"').replace('"valid_from": 1', '"valid_from": 2') for v in values], 100), "s", 1)
        used.append(jobs() - at)
        assert all(store.current(s).first().valid_from == 2 for s in (specs[0], specs[-1]))
    assert used[0] == used[1]


# ---------------------------------------------------------------- writes and compaction
def test_one_day_is_written_by_several_tasks(spark):
    names = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    kept = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, "32k")
    try:
        store = opened(spark)
        values = [create(i, "".join(random.Random(i).choices("abcdefghij", k=300)), 5) for i in range(2500)]
        store.process_batch(raw(spark, values), "s", 0)
    finally:
        for n, value in zip(names, kept, strict=True):
            spark.conf.set(n, value)
    files = store.journal().inputFiles()
    assert len(files) > 1 and len({f.rsplit("/", 1)[0] for f in files}) == 1
    assert store.journal().count() == 2500 == len(rows(store))


def test_compaction_changes_no_view_and_removes_what_it_replaced(spark):
    store = opened(spark, keep=1)
    for k in range(3):
        store.process_batch(raw(spark, [create(k, "c", 10 * k * DAY + 1), update(k, "u", 10 * k * DAY + 2), '{"payload": {"op": "c"'] + (
            [delete(k - 1, 10 * k * DAY + 3), envelope("u", "items", 1, None, '"bad"')] if k else []), 10 * k), "s", k)
    before, old = views(store), {f.split("/journal/")[1].split("/")[0] for f in store.journal().inputFiles()}
    reader = store.journal()
    store.compact()
    assert views(store) == before and len(store.state()["journal"]) == 1 and len(store.state()["archive"]) == 1
    assert reader.count() == len(before[0])                          # a reader that holds the state before
    store.record(lambda h: h.limit(0).drop("batch"))
    left = set(store.files.names(f"{store.root}/journal"))
    assert not old & left and len(left) == 1
    store.process_batch(raw(spark, [create(0, "c", 1), create(9, "new", 50 * DAY)], 0), "again", 0)   # a copy is known after it
    assert store.journal().count() == len(before[0]) + 1


# ---------------------------------------------------------------- index
def test_new_keys_open_no_folder_and_copies_are_removed(spark):
    store = opened(spark)
    for k in range(3):
        store.process_batch(raw(spark, [create(100 * k + i, "v", 1000 + i) for i in range(60)], 1000 * k), "s", k)
    opens, real = [], store._open

    def watched(kind, folders, schema):
        folders = list(folders)
        opens.append((kind, folders))
        return real(kind, folders, schema)

    store._open = watched
    store.process_batch(raw(spark, [create(10_000 + i, "new", 2000 + i) for i in range(5)], 5000), "s", 3)
    past = {j["folder"] for j in store.state()["journal"][:3]}
    assert not [f for kind, fs in opens if kind == "journal" for f in fs if f in past]
    opens.clear()
    store.process_batch(raw(spark, [create(100 + i, "v", 1000 + i) for i in range(60)], 9000), "s", 4)    # the second step's messages
    assert {f for kind, fs in opens if kind == "journal" for f in fs if f in past} == {store.state()["journal"][1]["folder"]}
    assert store.journal().count() == 185


def test_the_index_holds_every_whole_key(spark):
    msgs = spark.createDataFrame([(i, "c", "t", i * 7) for i in range(500)] + [(None, "c", "t", 1)], "key_id BIGINT, operation STRING, table STRING, ts_ns BIGINT")
    index = dedupe_index.summary(msgs).withColumn("folder", F.lit("f"))
    assert dedupe_index.folders_hit(msgs.filter("key_id = 499"), index) == ["f"]
    assert dedupe_index.folders_hit(msgs.withColumn("ts_ns", F.col("ts_ns") + 1), index) == []
    assert dedupe_index.folders_hit(msgs.filter("key_id IS NULL"), index) == []


# ---------------------------------------------------------------- late data and bounded dedupe
def topic(spark, batches):
    path = work_dir(spark, "test-topic")
    for i, values in enumerate(batches):
        raw(spark, values, 100 * i).repartition(1).write.mode("append").parquet(path)
    return read_topic_files(spark, path, max_files_per_trigger=1)


def test_late_messages_are_ignored_in_a_running_stream(spark):
    batches = [[create(1, "a", 10), create(2, "b", 10), delete(2, 20), create(3, "c", 30)],
               [update(1, "late", 5), create(2, "late", 15), update(3, "new", 30), update(1, "same", 10), create(4, "d", 1)],
               [create(2, "again", 25), update(4, "late", 0)]]
    store = opened(spark)
    start_apply(topic(spark, batches), store, work_dir(spark, "test-stream"), lambda: 5, available_now=True, late="ignore").awaitTermination()
    assert rows(store) == [(1, "same"), (2, "again"), (3, "new"), (4, "d")]
    assert sorted((r.key_id, r.event_time) for r in store.rejected().collect() if r.reason == "late") == [(1, 5), (2, 15), (4, 0)]
    with pytest.raises(ValueError):
        store.process_batch(raw(spark, [create(9, "x", 1)], 900), "other", 0)       # one rule for a store
    backlog = opened(spark)
    for k, values in enumerate(batches):
        backlog.process_batch(raw(spark, values, 100 * k), "s", k, journal_only=True)
        backlog.process_journal(batch_rows=100, late="ignore")
    assert rows(backlog) == rows(store)


def test_state_of_the_bounded_dedupe_is_evicted(spark):
    import datetime
    path, at = work_dir(spark, "test-topic"), datetime.datetime(2024, 1, 1)
    kept, odd = [], '{"payload": {"op": "c"'
    for k in range(5):
        values = [create(k, "v", k + 1), create(k, "v", k + 1), odd, odd, None]
        values += [create(k - 1, "v", k)] if k % 2 else []             # a copy from the batch before, within the bound
        when = at + datetime.timedelta(minutes=20 * k)
        batch = [("t", 0, 100 * k + o, None, None if v is None else bytearray(v.encode()), when - datetime.timedelta(minutes=19 if o == 5 else 0))
                 for o, v in enumerate(values)]
        spark.createDataFrame(batch, RAW_SCHEMA).repartition(1).write.mode("append").parquet(path)
    stream = dedupe_within(read_topic_files(spark, path, max_files_per_trigger=1), [SPEC], "30 minutes")
    query = (stream.writeStream.foreachBatch(lambda batch, _: kept.extend(r.offset for r in batch.collect()))
             .option("checkpointLocation", work_dir(spark, "test-stream")).trigger(availableNow=True).start())
    query.awaitTermination()
    creates = [o for o in kept if o % 100 in (0, 1)]
    assert len(kept) == 5 * 4 and len(creates) == 5 and not [o for o in kept if o % 100 == 5]
    state = [p["stateOperators"][0] for p in map(lambda p: json.loads(p.json), query.recentProgress) if p["stateOperators"]]
    assert max(s["numRowsTotal"] for s in state) < 20 and sum(s["numRowsRemoved"] for s in state) > 0


# ---------------------------------------------------------------- validation by checksums
def test_only_unequal_buckets_are_compared(spark):
    source = spark.createDataFrame([(i, None if i % 7 == 0 else f"v{i}", i % 3) for i in range(300)], "k BIGINT, v STRING, n BIGINT")
    faulty = source.filter("k <> 17").withColumn("n", F.when(F.col("k") == 44, F.lit(None)).otherwise(F.col("n")))
    faulty = faulty.unionByName(source.filter("k = 90"))
    sides = []
    for df in (source, faulty, source.repartition(7)):
        path = work_dir(spark, "test-sides")
        df.withColumn("bucket", key_bucket(["k"], 32)).write.partitionBy("bucket").parquet(path)
        sides.append(spark.read.schema("k BIGINT, v STRING, n BIGINT, bucket INT").parquet(path))
    columns = ["k", "v", "n"]
    assert unequal_buckets(sides[0], sides[2], columns)[0] == []
    assert checksum_summary("x", sides[0], sides[2], columns).first() == diff_summary("x", source, source).first()
    unequal, *_ = unequal_buckets(sides[0], sides[1], columns)
    hit = {r[0] for r in source.filter("k IN (17, 44, 90)").select(key_bucket(["k"], 32)).collect()}
    assert set(unequal) == hit
    found = checksum_summary("x", sides[0], sides[1], columns)
    assert found.first() == diff_summary("x", source, faulty).first()
    assert "PartitionFilters: [bucket" in plan(found).replace("\n", "") or "bucket#" in plan(found).split("PartitionFilters")[1][:60]
    swapped = spark.createDataFrame([(1, None, 5)], "a BIGINT, b BIGINT, bucket BIGINT"), spark.createDataFrame([(None, 1, 5)], "a BIGINT, b BIGINT, bucket BIGINT")
    assert unequal_buckets(*swapped, ["a", "b"])[0] == [5]
