import re

import pytest

from tests.llm import fixtures
from tidemark.llm import decontaminate as dc

ITEMS = [(1, fixtures.prose("passage", 60)), (20, fixtures.prose("passage", 30)), (3, "one two"), (4, "A"), (5, None), (6, "..."),
         (7, fixtures.prose("none", 40)), (20, "the owners of this page"), (None, "for every single part of this page as well as all"), (8, "é")]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(texts, items, size=13):
    windows = {}
    for ident, text in items:
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(ident)
    for t in texts:
        d, hit, found = words(t), set(), set()
        for window, ids in windows.items():
            for i in range(len(d) - len(window) + 1):
                if tuple(d[i:i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found |= ids
        yield len(d), len(hit), sorted(str(i) for i in found - {None}), bool(hit) and 20 * len(hit) >= len(d)


@pytest.mark.parametrize("part_bytes", [dc.PART_BYTES, 200])
def test_matches_brute_force(spark, part_bytes):
    rows = fixtures.rows()
    got = dc.decontaminate(fixtures.documents(spark), spark.createDataFrame(ITEMS, "item_id long, text string"), part_bytes=part_bytes).collect()
    want = sorted((str(r[0]), *e) for r, e in zip(rows, brute_force([r[1] for r in rows], ITEMS), strict=True))
    assert sorted((str(g.row.doc_id), g.n_words, g.n_hit, g["items"], g.contaminated) for g in got) == want
    assert sum(w[4] for w in want) > 5


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert dc.decontaminate(fixtures.empty(spark), items).collect() == []
    got = dc.decontaminate(fixtures.documents(spark), items.limit(0)).collect()
    assert len(got) == len(fixtures.rows()) and not any(g.n_hit or g.contaminated for g in got)


def test_every_shared_window_is_found(spark):
    """One window of 13 words, at any place and with any neighbours."""
    item = fixtures.prose("w", 13).replace(",", "").replace(".", "")
    docs = [(i, fixtures.prose(f"l{i}", i) + " " + item.upper() + " " + fixtures.prose(f"r{i}", 30 - i)) for i in range(30)]
    got = dc.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string"))
    want = list(brute_force([d[1] for d in docs], [(1, item)]))
    assert [(g.n_words, g.n_hit, g["items"], g.contaminated) for g in got.orderBy("row.doc_id").collect()] == want


def test_fifty_parts_one_index_at_a_time(spark, monkeypatch):
    """Each part is a plan of its own: no plan has two searches, and so no task two indexes."""
    items = [(i, fixtures.prose(f"item{i % 40}", 16)) for i in range(120)] + ITEMS
    table = spark.createDataFrame(items, "item_id long, text string")
    plans, real = [], dc.materialize
    monkeypatch.setattr(dc, "materialize", lambda df, name: plans.append(df) or real(df, name))
    docs = [(i, fixtures.prose(f"l{i}", i) + " " + fixtures.prose(f"item{i}", 16)) for i in range(40)] + [(99, "nothing of it")]
    found = dc.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), table, part_bytes=100)
    assert len(plans) >= 20
    for df in (*plans[:3], found):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    want = sorted((i, *e) for (i, _), e in zip(docs, brute_force([d[1] for d in docs], items), strict=True))
    assert sorted((g.row.doc_id, g.n_words, g.n_hit, g["items"], g.contaminated) for g in found.collect()) == want


def test_common_fingerprints_in_slices(spark, monkeypatch):
    monkeypatch.setattr(dc, "PAIRS", 7)
    items = [(i, "who is the best of all " + fixtures.prose(f"q{i}", 9)) for i in range(30)] + [(50, "who is"), (51, "who is")]
    docs = [(i, "who is the best of all " * 8 + items[i][1]) for i in range(6)]
    index = dc.Index([[str(i)] for i, _ in items], [t.encode() for _, t in items], 13)
    first, start, end, doc, item = dc.hits([t.encode() for _, t in docs], index)
    for d, (_, n_hit, ids, _) in enumerate(brute_force([t for _, t in docs], items)):
        mine = doc == d
        assert sorted({index.ids[i][0] for i in item[mine]}) == ids
        assert len({w for a, b in zip(start[mine], end[mine], strict=True) for w in range(a, b)}) == n_hit
