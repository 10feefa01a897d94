"""As-of rebuild boundaries, window rows, control-table status and offsets."""

import pytest

from helpers import SENTINEL
from tidemark.operators import control
from tidemark.operators.apply import project
from tidemark.operators.preload import archive_as_of
from tidemark.operators.temporal import archive_window_rows, rebuild_as_of, snapshot_size, window_rows
from tidemark.session import checkpoint_root
from tidemark.spec import TableSpec

SPEC = TableSpec(name="items", key="id", row_schema="id BIGINT, v STRING, valid_from BIGINT, valid_to BIGINT")
ROWS = "id BIGINT, v STRING, valid_from BIGINT, valid_to BIGINT"


def _pair(spark):
    main = spark.createDataFrame([(1, "b", 20, SENTINEL), (2, "z", 5, SENTINEL)], ROWS)
    arch = spark.createDataFrame([(1, "a", 10, 20), (3, "q", 10, 20)], ROWS)   # key 3 deleted at 20
    return main, arch


def test_asof_half_open_vs_closed_boundary(spark):
    main, arch = _pair(spark)
    half = sorted((r.id, r.v) for r in rebuild_as_of(main, arch, 20, SPEC).collect())
    assert half == [(1, "b"), (2, "z")]                       # period [10, 20) excludes T = 20
    closed = sorted((r.id, r.v) for r in rebuild_as_of(main, arch, 20, SPEC, closed=True).collect())
    assert closed == [(1, "b"), (2, "z"), (3, "q")]           # successor of key 1 removes the double
    ref = rebuild_as_of(main, arch, 15, SPEC, closed=True, valid_from_rule="reference").collect()
    assert sorted((r.id, r.valid_from, r.valid_to) for r in ref) == [(1, 20, SENTINEL), (2, 5, SENTINEL),
                                                                     (3, 20, SENTINEL)]


def test_snapshot_size_counts(spark):
    main, arch = _pair(spark)
    got = {r.table_name: r.ending_offset for r in snapshot_size(main, arch, 20, SPEC).collect()}
    assert got == {"items": 3, "items_archive": 2}


def test_window_rows_seconds_for_deleted(spark):
    s = 1_000_000_000
    main = spark.createDataFrame([(1, "b", 20 * s, SENTINEL)], ROWS)
    arch = spark.createDataFrame([(2, "q", 12 * s, 30 * s + 400_000_000)], ROWS)
    got = sorted((r.id, r.valid_to) for r in window_rows(main, arch, 10 * s, 30 * s, SPEC).collect())
    assert got == [(1, SENTINEL), (2, 30 * s)]                # deleted key compares/reports whole seconds


def _history(spark, rows):
    return spark.createDataFrame(rows, control.HISTORY_SCHEMA)


def test_load_status_and_watermarks(spark):
    h = _history(spark, [
        ("a", 0, 0, 1, -1, "Initial", True, 10, False, None),
        ("a", 1, 0, 2, -1, "Successful", True, 10, True, None),
        ("b", 0, 0, 1, -1, "Initial", True, 5, False, None),
        ("all", 5, 0, 3, 7, "Successful", False, -1, True, 100),
        ("all", 6, 0, 3, 9, "Successful", False, -1, False, 200),
        ("all", 7, 0, 3, 9, "Successful", False, -1, False, 150),
    ])
    st = control.load_status(h, "a,b").first()
    assert (st.is_initialized, st.is_preloaded, st.is_preloaded_validated) == (True, False, False)
    st = control.load_status(h, ["a"]).first()
    assert (st.is_initialized, st.is_preloaded, st.is_preloaded_validated) == (True, True, True)
    wm = control.watermarks(h).first()
    assert (wm.last_validated_ns, wm.next_validated_ns) == (100, 200)
    marked = control.mark_validated(h, 100, 150, version=1)
    h2 = h.unionByName(marked)
    assert control.watermarks(h2).first().last_validated_ns == 150


def test_starting_offsets_of_all_partitions(spark):
    h = _history(spark, [("a", 0, 0, 1, -1, "Initial", True, 10, False, None), ("c", 0, 0, 1, -1, "Initial", True, 0, False, None)])
    journal = spark.createDataFrame([(4, "topic.a", 0), (9, "topic.a", 2), (7, "topic.a", 2), (3, "topic.b", 0), (5, None, None)],
                                    "message_id BIGINT, topic STRING, partition INT")
    offs = control.offset_lookup(h, {"a": "topic.a", "b": "topic.b", "c": "topic.c"}, control.partition_offsets(journal))
    assert control.starting_offsets(offs, ["a", "c"]) == '{"topic.a": {"0": 5, "2": 10}, "topic.c": {"0": 0}}'
    assert control.offsets_json_column(offs).first()[0] == '{"topic.a":{"0":5,"2":10},"topic.c":{"0":0}}'
    with pytest.raises(RuntimeError):
        control.starting_offsets(offs, ["a", "b"])


def test_open_archive_rows_are_not_closed(spark):
    main = spark.createDataFrame([], ROWS)
    arch = spark.createDataFrame([(1, "a", 10, SENTINEL), (2, "b", 10, 15)], ROWS)
    got = {r.table_name: r.ending_offset for r in snapshot_size(main, arch, 20, SPEC).collect()}
    assert got["items_archive"] == 1


def test_preload_marks_start_the_watermarks(spark):
    h = _history(spark, [("a", 0, 0, 1, -1, "Initial", True, 10, False, None), ("b", 0, 0, 1, -1, "Initial", True, 5, False, None)])
    assert control.watermarks(h).first().last_validated_ns is None
    h = h.unionByName(control.mark_preloaded(h, ["a", "b"], 77))
    st = {r.table_name: (r.initialized, r.preloaded, r.validated) for r in control.table_status(h, "a,b").collect()}
    assert st == {"a": (True, True, False), "b": (True, True, False)}
    h = h.unionByName(control.mark_preload_validated(h, ["a"], 100))
    assert control.watermarks(h).first().last_validated_ns == 100
    st = {r.table_name: r.validated for r in control.table_status(h, "a,b").collect()}
    assert st == {"a": True, "b": False}


def test_archive_as_of(spark):
    main = spark.createDataFrame([(1, "c", 30, SENTINEL)], ROWS)
    arch = spark.createDataFrame([(1, "a", 10, 20), (1, "b", 20, 30), (2, "q", 5, 15), (3, "z", 5, SENTINEL)], ROWS)
    got = sorted((r.id, r.v, r.valid_to, r.deleted) for r in archive_as_of(main, arch, 25, SPEC).collect())
    assert got == [(1, "a", 20, False), (2, "q", 15, True)]


def test_archive_scans_skip_by_closing_time(spark, tmp_path):
    main, arch = _pair(spark)
    arch.write.parquet(str(tmp_path / "a"))
    for rows in (window_rows, archive_window_rows):
        plan = rows(main, spark.read.parquet(str(tmp_path / "a")), 10, 30, SPEC)._jdf.queryExecution().executedPlan().toString()
        pushed = next(x for x in plan.splitlines() if "FileScan" in x)
        assert "valid_to" in pushed.split("PushedFilters")[1]


def test_specs_from_json(tmp_path, spark):
    (tmp_path / "specs.json").write_text("""[{"name": "bills", "key": "id", "row_schema": "id INT, day INT, valid_from BIGINT, valid_to BIGINT",
        "projection": ["id", "date_from_unix_date(day) AS day", "valid_from"], "archive_projection": ["id", "valid_to"], "date_key": "valid_from",
        "has_deleted": false, "topic": "t.bills"}]""")
    spec, = TableSpec.load(str(tmp_path / "specs.json"))
    rows = spark.createDataFrame([(1, 16816, 5, SENTINEL, True)], spec.row_schema + ", deleted BOOLEAN")
    assert [(r.id, str(r.day), r.valid_from) for r in project(rows, spec).collect()] == [(1, "2016-01-16", 5)]
    assert project(rows, spec, archive=True).columns == ["id", "valid_to"]
    with pytest.raises(ValueError):
        TableSpec.from_json('{"name": "x", "key": "id", "row_schema": "id INT, valid_from BIGINT, valid_to BIGINT", "date_key": "since"}')


def test_checkpoint_folder_is_asked_for_on_a_cluster():
    class Fake:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError):
        checkpoint_root(Fake)
