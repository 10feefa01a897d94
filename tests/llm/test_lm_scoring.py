from collections import Counter

import numpy as np
import pytest

from tests.llm import fixtures
from tidemark.llm import lm_scoring as lm


def brute_force(rows, targets, vocabulary):
    docs = [(r[1] or "").encode().lower().split() for r in rows]
    counts = Counter(w for d in docs for w in d)
    kept = set()
    for n in sorted(set(counts.values()), reverse=True):
        more = {w for w, c in counts.items() if c == n}
        if len(kept) + len(more) > vocabulary:
            break
        kept |= more
    docs = [[w if w in kept else b"?" * 9 for w in d] + ["end"] for d in docs]
    width = len(kept) + 2
    for r, d in zip(rows, docs, strict=True):
        losses = []
        for model in (0, 1):
            others = [e for s, e in zip(rows, docs, strict=True) if (model or s[0] in targets) and e is not d]
            one = Counter(w for e in others for w in e)
            two = Counter(p for e in others for p in zip(["start", *e], e, strict=False))
            one["start"] = len(others)
            total = sum(map(len, others))
            losses.append(np.mean([-np.log((two[v, w] + lm.MU * (one[w] + 1) / (total + width)) / (one[v] + lm.MU))
                                   for v, w in zip(["start", *d], d, strict=False)]))
        yield len(d), *losses


@pytest.mark.parametrize("vocabulary", [lm.VOCABULARY, 40, 0])
def test_matches_brute_force(spark, vocabulary):
    rows = fixtures.rows()
    targets = {r[0] for r in rows[:40:3]} - {None}
    ids = spark.createDataFrame([(t,) for t in [*targets, *targets, None, 10**9]], "doc_id long")
    got = lm.score_documents(fixtures.documents(spark), ids, vocabulary=vocabulary, block_bytes=4000).collect()
    key = lambda x: (str(x[0]), x[1], round(x[2], 6), round(x[3], 6))
    have = sorted((key((g.row.doc_id, g.n_tokens, g.loss_target, g.loss_background)) for g in got))
    want = sorted(key((r[0], *b)) for r, b in zip(rows, brute_force(rows, targets, vocabulary), strict=True))
    assert [h[:2] for h in have] == [w[:2] for w in want]
    assert np.allclose([h[2:] for h in have], [w[2:] for w in want], atol=1e-5)
    assert all(abs(g.score - (g.loss_target - g.loss_background)) < 1e-12 for g in got)


def test_rare_words_count(spark):
    """Of 70,000 words that occur three times at most, each is told from the others."""
    docs = [(i, " ".join(f"w{(i * 6000 + k) % 70_000}" for k in range(9000))) for i in range(12)]
    ids = spark.createDataFrame([(0,), (1,), (5,)], "doc_id long")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(lm.score_documents(frame, ids, block_bytes=100_000).collect(), key=lambda g: g.row.doc_id)
    want = list(brute_force(docs, {0, 1, 5}, float("inf")))
    assert [g.n_tokens for g in got] == [w[0] for w in want]
    assert np.allclose([(g.loss_target, g.loss_background) for g in got], [w[1:] for w in want], atol=1e-9)
    assert np.ptp([g.score for g in got]) > 0.5


def test_without_targets_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long")
    assert lm.score_documents(fixtures.empty(spark), none).collect() == []
    got = lm.score_documents(fixtures.documents(spark), none).collect()
    assert len(got) == len(fixtures.rows()) and np.ptp([g.loss_target for g in got]) < 1e-9  # uniform


def test_prefers_documents_like_the_target(spark):
    docs = [(i, fixtures.prose(i, 80)) for i in range(40)] + [(100 + i, fixtures.prose(i, 80, ("zig", "zag", "zog"))) for i in range(40)]
    ids = spark.createDataFrame([(i,) for i in range(0, 20)], "doc_id long")
    got = {g.row.doc_id: g.score for g in lm.score_documents(spark.createDataFrame(docs, "doc_id long, text string"), ids).collect()}
    assert max(got[i] for i in range(40)) < min(got[100 + i] for i in range(40))
