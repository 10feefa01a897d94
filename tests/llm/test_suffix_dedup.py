import numpy as np
import pyarrow as pa
import pytest

from tests.llm import fixtures
from tidemark.llm import suffix_dedup as sd
from tidemark.llm.common import packed


def brute_force(rows, size=100):
    """(id, text) -> removed flags per row in (id, text) order, by a dictionary of all windows."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, (rows[i][1] or "").encode()))
    seen, out = set(), {}
    for i in order:
        data = (rows[i][1] or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - size + 1):
            w = data[s:s + size]
            if w in seen:
                gone[s:s + size] = True
            seen.add(w)
        out[i] = (data, gone)
    return [out[i] for i in range(len(rows))]


def expected(rows, size=100):
    for data, gone in brute_force(rows, size):
        yield len(data), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), bytes(np.frombuffer(data, np.uint8)[~gone])


def test_matches_brute_force(spark):
    rows = fixtures.rows()
    got = sd.dedup_suffixes(fixtures.documents(spark), block_bytes=4000).collect()
    want = sorted((str(r[0]), *e) for r, e in zip(rows, expected(rows), strict=True))
    assert sorted((str(g.row.doc_id), g.n_bytes, g.n_removed, len(g.spans), bytes(g.kept)) for g in got) == want
    assert sum(w[2] for w in want) > 5000
    assert got[0].row.asDict().keys() == {"doc_id", "row", "id", "block", "key", "bits", "n_chars"}
    for g in got:
        assert sum(s.end - s.start for s in g.spans) == g.n_removed


def test_as_text_drops_split_characters(spark):
    rows = [(1, "é" * 60), (2, "a" + "é" * 60), (3, "x" * 99 + "é")]
    got = {g.row.doc_id: g.kept for g in sd.dedup_suffixes(spark.createDataFrame(rows, "doc_id long, text string"), as_text=True).collect()}

    want = [bytes(np.frombuffer(d, np.uint8)[~g]).decode(errors="ignore") for d, g in brute_force(rows)]
    assert [got[r[0]] for r in rows] == want


def test_empty_table(spark):
    assert sd.dedup_suffixes(fixtures.empty(spark)).collect() == []


def exchange(rows, n_blocks, cuts, hot, size=100):
    """The operator's steps without Spark."""
    n = n_blocks
    tables = []
    for b in range(n_blocks):
        mine = [r for i, r in enumerate(rows) if i % n_blocks == b]
        doc = pa.StructArray.from_arrays([pa.array([r[0] for r in mine], pa.int64()), pa.array([r[1] for r in mine], pa.string()),
                                          pa.array([r[0] for r in mine], pa.int64())], ["id", "text", "row"])
        tables.append(pa.table({"doc": doc, "block": pa.array([b] * len(mine), pa.int32())}))

    def by(found, column):
        every = pa.concat_tables(found)
        return {k: every.filter(pa.compute.equal(every[column], k)) for k in set(every[column].to_pylist())}

    none = sd.messages([], [], [])
    counted = by([sd.count(t) for t in by([sd.send_leads(t, size, n) for t in tables], "bucket").values()], "block")
    sent = by([sd.send(t, counted.get(b, none), size, n, cuts, hot) for b, t in enumerate(tables)], "bucket")
    answers = by([sd.resolve(t, size, n) for t in sent.values()], "block")
    out = pa.concat_tables([sd.cut(t, answers[b], size, n, cuts, hot, False) for b, t in enumerate(tables)])
    return {r["row"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept"]) for r in out.to_pylist()}


@pytest.mark.parametrize("share", [0, 0.02, 0.5, 1])
def test_hot_leads_are_spread_and_exact(share):
    rows = [(i, t) for i, t in enumerate(fixtures.texts())]
    leads = np.unique(np.concatenate([p.leads() for p in sd.contexts([(t or "").encode() for _, t in rows], 100)]))
    cuts = leads[[len(leads) // 3, 2 * len(leads) // 3]]
    common = "All rights reserved by the owners of this page, who may be asked".encode()
    hot = leads[np.random.default_rng(0).random(len(leads)) < share]
    hot = np.unique(np.concatenate([hot, [x for x in leads if bytes(x) in common]])) if share else hot
    assert exchange(rows, 3, cuts, hot) == {r[0]: e for r, e in zip(rows, expected(rows), strict=True)}


def test_multikey_groups_equal_strings():
    rng = np.random.default_rng(1)
    strings = [bytes(rng.integers(97, 99, 4, dtype=np.uint8)) * 8 for _ in range(300)]
    data = np.frombuffer(b"".join(strings), np.uint8)
    got, group = sd.multikey(data, np.arange(300) * 32, 32)
    same = {}
    for i, s in enumerate(strings):
        same.setdefault(s, []).append(i)
    want = sorted(sorted(v) for v in same.values() if len(v) > 1)
    assert sorted(sorted(got[group == g].tolist()) for g in np.unique(group)) == want


@pytest.mark.parametrize("ids", [[1, 2, 3], [None] * 900])
def test_splitters_follow_bytes(spark, ids):
    """Few long documents, or many without an id, give as good splitters as any others."""
    rng = np.random.default_rng(0)
    size = 5_400_000 // len(ids)
    docs = [bytes(rng.integers(97, 123, size, dtype=np.uint8)).decode() for _ in ids]
    given = packed(spark.createDataFrame(list(zip(ids, docs, strict=True)), "doc_id long, text string"), "doc_id", "text")
    cuts, hot = sd.splitters(given, 100, 16)
    assert len(cuts) == 7 and not len(hot)  # no groups: half of the cuts
    bucket = np.concatenate([sd.placed(c.leads(), cuts, hot)[0] for c in sd.contexts([d.encode() for d in docs], 100)])
    many = np.bincount(bucket, minlength=16)
    assert many.max() < 4 * many.sum() / 16
