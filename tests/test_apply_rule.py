"""The set-based apply rule against a sequential replay of the messages."""

import json
import random

import pytest

from conftest import MSG_SCHEMA
from tidemark.operators.apply import applied_marks, apply_changes, archive_rows, rejects
from tidemark.spec import TableSpec

SPEC = TableSpec(name="items", key="id", row_schema="id BIGINT, v STRING, valid_from BIGINT, valid_to BIGINT")
MIN = -(2 ** 63)


def replay(existing, msgs):
    state = existing
    for _, _, op, img in sorted(msgs, key=lambda m: (MIN if m[0] is None else m[0], m[1])):
        if op == "c" and state is None and img is not None:
            state = img
        elif op == "u" and state is not None and img is not None:
            state = img
        elif op == "d":
            state = None
    return state


def _img(key, tag, t):
    return {"id": key, "v": tag, "valid_from": t, "valid_to": -4852116231933722724}


def _random_case(rng, n_keys, max_ops, t_range, with_null_times=True):
    rows, existing, expected = [], {}, {}
    mid = 0
    for key in range(n_keys):
        ex = _img(key, f"seed{key}", 0) if rng.random() < 0.4 else None
        if ex:
            existing[key] = ex
        msgs = []
        for _ in range(rng.randint(0, max_ops)):
            mid += 1
            op = rng.choice("cudr")
            t = None if (with_null_times and rng.random() < 0.03) else rng.randint(0, t_range)
            img = None if op == "d" else _img(key, f"m{mid}", t if t is not None else 0)
            msgs.append((t, mid, op, img))
            rows.append((mid, op, "dbo", "items", t, None, None if img is None else json.dumps(img), key, t))
        applied = [m for m in msgs if m[2] != "r"]
        final = replay(ex, applied)
        if final is not None:
            expected[key] = final
    return rows, existing, expected


def _run(spark, rows, existing, **kw):
    msgs = spark.createDataFrame(rows, MSG_SCHEMA)
    cur = spark.createDataFrame([(e["id"], e["v"], e["valid_from"], e["valid_to"]) for e in existing.values()],
                                "id BIGINT, v STRING, valid_from BIGINT, valid_to BIGINT")
    out = apply_changes(cur, msgs, SPEC, **kw).collect()
    return {r["id"]: {"id": r["id"], "v": r["v"], "valid_from": r["valid_from"], "valid_to": r["valid_to"]}
            for r in out}, len(out)


def test_random_sequences_match_replay(spark):
    rng = random.Random(7)
    rows, existing, expected = _random_case(rng, n_keys=300, max_ops=9, t_range=20)
    got, n = _run(spark, rows, existing)
    assert n == len(got)
    assert got == expected


def test_hot_key(spark):
    """One key holding most of the batch."""
    rng = random.Random(5)
    msgs, rows = [], []
    for mid in range(1, 3001):
        op = rng.choice("cuuuud")
        t = rng.randint(0, 100000)
        img = None if op == "d" else _img(1, f"m{mid}", t)
        msgs.append((t, mid, op, img))
        rows.append((mid, op, "dbo", "items", t, None, None if img is None else json.dumps(img), 1, t))
    expected = replay(None, msgs)
    got, _ = _run(spark, rows, {})
    assert got.get(1) == expected


def test_archive_rows_update_and_delete(spark):
    b = json.dumps(_img(1, "old", 10))
    a = json.dumps(_img(1, "new", 20))
    rows = [(1, "u", "dbo", "items", 25, b, a, 1, 20),
            (2, "d", "dbo", "items", 30, a, None, 1, 30),
            (3, "d", "dbo", "items", 40, None, None, None, 40),   # delete of an absent key: nothing
            (4, "u", "dbo", "other", 50, b, a, 1, 20)]            # another table: nothing
    out = archive_rows(spark.createDataFrame(rows, MSG_SCHEMA), SPEC).orderBy("valid_from").collect()
    assert [(r.v, r.valid_from, r.valid_to, r.deleted) for r in out] == [("old", 10, 20, False),
                                                                           ("new", 20, 30, True)]


def test_late_messages_two_batches(spark):
    """Second batch holds late messages: 'apply' replays them after the
    first batch's result, 'ignore' drops those older than what was applied
    to their key, whether it lives or not."""
    rng = random.Random(21)
    first_rows, late_rows, seq = [], [], {}
    mid = 0
    for key in range(150):
        for _ in range(rng.randint(1, 8)):
            mid += 1
            op = rng.choice("cuud")
            t = rng.randint(0, 50)
            img = None if op == "d" else _img(key, f"m{mid}", t)
            row = (mid, op, "dbo", "items", t, None, None if img is None else json.dumps(img), key, t)
            (late_rows if mid % 3 == 0 else first_rows).append(row)
            seq.setdefault(key, []).append((t, mid, op, img, mid % 3 == 0))
    exp_apply, exp_ignore = {}, {}
    for key, msgs in seq.items():
        first = [m[:4] for m in msgs if not m[4]]
        s1 = replay(None, first)
        late = [m[:4] for m in msgs if m[4]]
        a = replay(s1, late)
        b = replay(s1, [m for m in late if not first or m[0] >= max(f[0] for f in first)])
        if a is not None:
            exp_apply[key] = a
        if b is not None:
            exp_ignore[key] = b
    on_time = spark.createDataFrame(first_rows, MSG_SCHEMA)
    first = apply_changes(None, on_time, SPEC)
    late_df = spark.createDataFrame(late_rows, MSG_SCHEMA)
    for mode, expected in (("apply", exp_apply), ("ignore", exp_ignore)):
        out = apply_changes(first, late_df, SPEC, late=mode, marks=applied_marks(on_time, SPEC)).collect()
        got = {r["id"]: {"id": r["id"], "v": r["v"], "valid_from": r["valid_from"], "valid_to": r["valid_to"]}
               for r in out}
        assert got == expected, mode
    with pytest.raises(ValueError):
        apply_changes(first, late_df, SPEC, late="ignore")


def test_late_create_does_not_revive_a_deleted_key(spark):
    on_time = spark.createDataFrame([(1, "c", "dbo", "items", 10, None, json.dumps(_img(1, "a", 10)), 1, 10),
                                     (2, "d", "dbo", "items", 50, None, None, 1, 50)], MSG_SCHEMA)
    late = spark.createDataFrame([(3, "c", "dbo", "items", 20, None, json.dumps(_img(1, "b", 20)), 1, 20)], MSG_SCHEMA)
    first = apply_changes(None, on_time, SPEC)
    assert apply_changes(first, late, SPEC, late="ignore", marks=applied_marks(on_time, SPEC)).count() == 0
    assert apply_changes(first, late, SPEC).count() == 1


def test_malformed_images_change_nothing_and_are_reported(spark):
    good, keyless, wrong = json.dumps(_img(1, "a", 10)), json.dumps(_img(None, "n", 20)), '{"id": "x", "v": "w", "valid_from": 20}'
    rows = [(1, "c", "dbo", "items", 10, None, good, 1, 10),
            (2, "u", "dbo", "items", 20, good, good[:25], 1, 20),
            (3, "u", "dbo", "items", 21, good, keyless, None, 21),
            (4, "u", "dbo", "items", 22, good, wrong, None, 22),
            (5, "u", "dbo", "items", 23, good, None, 1, 23),
            (6, "d", "dbo", "items", 24, good[:30], None, 2, 24),
            (7, "r", "dbo", "items", 25, None, "{", 1, 25),
            (8, "u", "dbo", "other", 26, None, "{", 1, 26)]
    msgs = spark.createDataFrame(rows, MSG_SCHEMA)
    assert [(r.id, r.v) for r in apply_changes(None, msgs, SPEC).collect()] == [(1, "a")]
    assert archive_rows(msgs, SPEC).count() == 0
    assert sorted((r.message_id, r.reason) for r in rejects(msgs, SPEC).collect()) == [
        (2, "malformed after image"), (3, "malformed after image"), (4, "malformed after image"), (5, "no after image"),
        (6, "malformed before image")]


def test_ties_across_topics_and_partitions(spark):
    """Equal event times and offsets: topic and partition decide, and copies of one message are one."""
    a, b, c = (json.dumps(_img(1, v, 5)) for v in "abc")
    schema = MSG_SCHEMA + ", topic STRING, partition INT"
    rows = [(7, "u", "dbo", "items", 5, None, b, 1, 5, "t", 1), (7, "c", "dbo", "items", 5, None, a, 1, 5, "t", 0),
            (7, "u", "dbo", "items", 5, None, c, 1, 5, "s", 9), (7, "u", "dbo", "items", 5, None, b, 1, 5, "t", 1)]
    out = apply_changes(None, spark.createDataFrame(rows, schema), SPEC).collect()
    assert [r.v for r in out] == ["b"]


def test_specs_refuse_what_the_journal_cannot_key():
    with pytest.raises(ValueError):
        TableSpec(name="t", key="code", row_schema="code STRING, valid_from BIGINT, valid_to BIGINT")
    with pytest.raises(ValueError):
        TableSpec(name="t", key="id", row_schema="id INT, valid_from BIGINT")
