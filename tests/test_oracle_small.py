"""Registered queries against their DuckDB oracles at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
FAST = ["changelog", "apply_mixed", "apply_rejects", "late_messages", "late_messages_ignore", "batch_select_journal", "asof_rebuild_orders",
        "validate_archive_window", "validate_preload", "validate_preload_archive", "validation_watermarks", "starting_offsets",
        "apply_current", "apply_archive", "asof_rebuild", "asof_rebuild_reference", "snapshot_size",
        "window_rows", "archive_window_rows", "batch_select", "multiset_diff", "epoch_to_ts", "round_seconds",
        "journal_dedupe", "validate_window", "load_status"]


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    fix = (lambda v: round(v, 6) if isinstance(v, float) and not math.isnan(v) else v)
    return sorted((tuple(fix(r[i]) for i in order) for r in rows), key=lambda t: tuple(map(str, t)))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["events", "orders"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = contract.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(contract.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, rows) == _canon(ocols, res.fetchall())


def test_entry_smoke(spark):
    df = contract.entry(spark)
    assert df.columns == ["user_id", "event_type", "value", "valid_from", "valid_to"]
    assert df.count() > 0
