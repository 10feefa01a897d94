import re
from collections import Counter

from tests.llm import fixtures
from tidemark.llm import substring_dedup as sub


def brute_force(texts, size=35):
    docs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(d[i:i + size]) for d in docs for i in range(len(d) - size + 1))
    for d in docs:
        gone = {i + k for i in range(len(d) - size + 1) if seen[tuple(d[i:i + size])] > 1 for k in range(size)}
        yield len(d), len(gone), " ".join(w for i, w in enumerate(d) if i not in gone)


def test_matches_brute_force(spark):
    rows = fixtures.rows()
    got = sub.dedup_substrings(fixtures.documents(spark), block_bytes=4000).collect()
    want = sorted((str(r[0]), *e) for r, e in zip(rows, brute_force([r[1] for r in rows]), strict=True))
    assert sorted((str(g.row.doc_id), g.n_words, g.n_removed, g.kept) for g in got) == want
    assert sum(w[2] for w in want) > 300
    for g in got:
        assert sum(s.end - s.start for s in g.spans) == g.n_removed


def test_window_length_is_a_parameter(spark):
    rows = [(1, "a b c d e"), (2, "x b c d y"), (3, "b c")]
    got = {g.row.doc_id: g.kept for g in sub.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"), size=3).collect()}
    assert got == {1: "a e", 2: "x y", 3: "b c"}


def test_empty_table(spark):
    assert sub.dedup_substrings(fixtures.empty(spark)).collect() == []
