import random
import re
from collections import Counter, defaultdict

import numpy as np
from tests.llm import fixtures

from tidemark.llm import collocations as co


def phrases_of(text, longest=5):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
        words = re.findall("[^ \t]+", piece)
        for k in range(1, longest + 1):
            for i in range(len(words) - k + 1):
                yield tuple(words[i:i + k])


def brute(rows, least, top=2000, percent=100):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for p in phrases_of(text):
            f[lang or "und" if lang is None else lang][p] += 1
            n["und" if lang is None else lang] += len(p) == 1
    out = []
    for lang, count in f.items():
        found = []
        often = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], a)
        for p, a in often.items():
            if 100 * inside[p] < percent * a:
                score, _, left, right = min((1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), " ".join(p), left, right))
        for rank, (score, a, _, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p, -a, left, right, n[lang], -score))
    return sorted(out)


def found(spark, rows, **how):
    docs = spark.createDataFrame([(*r, 1, "w", 2, 3) for r in rows], "text string, lang string, chunk int, word string, ids int, n int")
    return sorted(tuple(r) for r in co.collocations(docs, **how).collect())


def corpus(seed, n):
    r = random.Random(seed)
    words = ["the", "The", "of", "a", "é", "日本", "x-y", "\x0bz", "\0", "<b>", "'s", *[f"w{i}" for i in range(12)]]
    weights = [60, 20, 40, 30, *[5] * (len(words) - 4)]
    rows = []
    for _ in range(n):
        parts = [r.choices(words, weights)[0] + r.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!? ", "\r"]) for _ in range(r.randrange(60))]
        rows.append(("".join(parts), r.choice(["en", "en", "en", None, "", "de"])))
    return rows + [(None, "en"), ("", None), ("   .. ,\n", "de"), ("lone", "fr"), ("one phrase said twice " * 40, "en"), ("of the a " * 4000, "hot")]


def test_against_brute_force(spark):
    rows = corpus(1, 150)
    assert found(spark, rows, least=7) == brute(rows, 7)
    assert found(spark, rows, least=3, top=40, percent=50) == brute(rows, 3, 40, 50)


def test_hot_words_and_many_buckets_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(co, "SLICE", 101)
    rows = corpus(2, 150)
    for hot, bucket in ((40, 300), (3, 50), (10 ** 9, 100)):
        assert found(spark, rows, least=4, hot=hot, bucket=bucket) == brute(rows, 4)


def test_the_fixtures_and_nothing(spark):
    rows = [(r[1], r[2]) for r in fixtures.rows()] * 3
    assert found(spark, rows, least=9) == brute(rows, 9)
    assert found(spark, [], least=2) == [] == found(spark, [(None, None), ("a b", "x")], least=2)


def test_sorting_abandons_nothing_that_is_frequent():
    r = random.Random(3)
    for _ in range(60):
        seq = np.array([r.randrange(r.randrange(1, 6) + 1) for _ in range(r.randrange(2, 400))], np.int32)
        words, _ = co.suffixes(seq, 5)
        words, weight = co.grouped(words)
        least, got = r.randrange(1, 6), {}
        for k, pointers, counts in co.frequent_phrases(words, np.ones(len(weight), np.int64), weight, least):
            got |= {tuple(words[:k, p].tolist()): int(c) for p, c in zip(pointers, counts, strict=True)}
        s = seq.tolist()
        want = Counter(tuple(s[i:i + k]) for k in range(2, 6) for i in range(len(s) - k + 1) if 0 not in s[i:i + k])
        assert got == {p: a for p, a in want.items() if a >= least}


def test_scores_beyond_64_bits(spark):
    big = 10 ** 13
    frequent = spark.createDataFrame([(1, "en", "a", 3 * big), (2, "en", "b", 7 * big)], "id long, lang string, word string, f long")
    phrases = spark.createDataFrame([([1, 2], big + 1)], "ids array<long>, f long")
    totals = spark.createDataFrame([("en", 900 * big)], "lang string, n long")
    row = co.scored(frequent, phrases, totals).first()
    assert int(row.score) == 1000 * (big + 1) * 900 * big // (21 * big * big)
