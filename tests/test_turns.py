"""Queries that work in turns: every turn does its part."""

from test_growth import events
from tidemark.operators.apply import apply_changes
from tidemark.plans import derive, queries
from tidemark.plans.derive import T_CUTOFF, USER_STATE
from tidemark.sources.store import CdcStore


def test_each_turn_of_process_journal_applies_what_its_stream_has_journaled(spark, monkeypatch):
    turns, real = [], CdcStore.process_journal

    def watched(store, **how):
        waiting = store.journal().count() if not turns else None
        steps = real(store, **how | {"batch_rows": 1 << 40})          # in one step
        rows = store.progress().agg({"n": "sum", "event_time": "max"}).first()
        turns.append((steps, rows["sum(n)"], rows["max(event_time)"], waiting))
        return steps

    monkeypatch.setattr(CdcStore, "process_journal", watched)
    sf = events(spark, n=180, users=30)                           # some of them before the cut-off, some after it
    got = queries.q_process_journal(spark, sf)
    expected = apply_changes(None, derive.messages(spark, sf).filter("event_time IS NOT NULL"), USER_STATE)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    (first, some, until, waiting), (second, all_of_it, last, _) = turns
    assert first > 0 and second > 0
    assert some == waiting and until <= T_CUTOFF < last           # the first turn applies all that was journaled by then
    assert some < all_of_it                                       # the second what was new to it
