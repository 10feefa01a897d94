"""The validation cycle: which period is next, check it for both tables, mark it -- or raise."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators import control, preload
from tidemark.operators.temporal import archive_window_rows, window_rows
from tidemark.operators.validate import diff_summary
from tidemark.spec import TableSpec


class Differs(RuntimeError):
    """Source and target differ; nothing was marked."""


def _agree(summary: DataFrame) -> None:
    bad = [r.asDict() for r in summary.filter("NOT is_equal").collect()]  # a row per table
    if bad:
        raise Differs(f"source and target differ: {bad}")


def validate_cycle(store, source: tuple[DataFrame, DataFrame], spec: TableSpec, preload_cutoff_ns: int) -> tuple[int | None, int] | None:
    """One round: the preload if it is not validated yet, else the window from the last validated time to
    the next.  Returns the validated period (None, t) or (lo, hi), or None if there is nothing to do."""
    main, archive = source
    history = store.history()
    names = [spec.name, spec.archive_name]
    status = control.load_status(history, names).first()
    if not status.is_preloaded:
        raise RuntimeError(f"tables not preloaded: {', '.join(names)}")
    if not status.is_preloaded_validated:
        _agree(preload.validate_preload(main, archive, store.current(spec), store.archive(spec), preload_cutoff_ns, spec))
        store.record(lambda h: control.mark_preload_validated(h, names, preload_cutoff_ns))
        return None, preload_cutoff_ns
    marks = control.watermarks(history).first()
    lo, hi = marks.last_validated_ns, marks.next_validated_ns
    if hi is None:
        return None
    current, archived = store.current(spec), store.archive(spec).select(*spec.columns)
    _agree(diff_summary(spec.name, window_rows(main, archive, lo, hi, spec), window_rows(current, archived, lo, hi, spec)).unionByName(
        diff_summary(spec.archive_name, archive_window_rows(main, archive, lo, hi, spec),
                     archive_window_rows(current, archived, lo, hi, spec))))
    store.record(lambda h: control.mark_validated(h, lo, hi, version=1))
    return lo, hi
