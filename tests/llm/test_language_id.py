import zlib

import numpy as np

from tests.llm import fixtures
from tidemark.llm import language_id as li

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    filters = li.learn(docs)
    assert filters.languages == ["de", "en", "es", "fr"]
    got = li.identify(docs.select("doc_id", "text", "lang"), filters).selectExpr("row.*", "lang_pred", "score").collect()
    held = [g for g in got if zlib.crc32(str(g.doc_id).encode()) % 5 == 0]
    assert len(held) > 150 and np.mean([g.lang == g.lang_pred for g in held]) > 0.98
    assert all(0 <= g.score <= 1 for g in got)


def test_learns_from_the_training_fold_only(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    spoiled = docs.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 'zzzz qqqq' ELSE text END AS text",
                              "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 'xx' ELSE lang END AS lang")
    a, b = li.learn(docs), li.learn(spoiled)
    assert a.languages == b.languages and (a.slots == b.slots).all()


def test_counts_are_corrected():
    """With a crowded filter, a language of which a text has nothing is corrected to about none."""
    rng = np.random.default_rng(0)
    grams = rng.integers(0, 2**64, 400_000, dtype=np.uint64)
    language = np.where(np.arange(400_000) < 300_000, 0, 70)  # in the second word of the masks
    filters = li.Filters.of([f"l{k:02d}" for k in range(71)], language, grams)
    assert filters.false_share[0] > 0.4
    text = grams[350_000:]
    counts = filters.counts(text, np.array([0, 0, 50_000, 50_000]))
    assert counts.shape == (3, 71) and not counts[[0, 2]].any()
    assert abs(counts[1, 70] - 50_000) < 1 and abs(counts[1, 0]) < 1000 and abs(counts[1, 5]) < 1


def test_ngrams_stay_inside_texts():
    texts = ["Ab cd", "", "...", "é", "a  b!c ", None or "\0x\0"]
    for t in texts:
        alone, _ = li.ngrams([t])
        every, first = li.ngrams([*texts, t])
        assert (every[first[-2]:first[-1]] == alone).all()
        cleaned = " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split())
        assert len(alone) == max(0, len(cleaned) + 2 - li.GRAM + 1) * bool(cleaned)


def test_odd_rows(spark):
    docs = fixtures.documents(spark)
    labelled = docs.selectExpr("*", "CASE WHEN doc_id % 3 = 0 THEN 'aa' WHEN doc_id % 3 = 1 THEN 'bb' END AS lang")
    got = li.identify(docs, li.learn(labelled)).collect()
    assert sorted(str(g.row.doc_id) for g in got) == sorted(str(r[0]) for r in fixtures.rows())
    for g in got:
        if not any(c.isalpha() for c in g.text or ""):
            assert (g.lang_pred, g.score) == ("und", 0)
        else:
            assert g.lang_pred in ("aa", "bb")


def test_without_labels_or_rows(spark):
    docs = fixtures.documents(spark)
    none = li.learn(docs.selectExpr("*", "CAST(NULL AS STRING) AS lang"))
    assert {g.lang_pred for g in li.identify(docs, none).collect()} == {"und"}
    assert li.identify(fixtures.empty(spark), none).collect() == []
    assert li.learn(fixtures.empty(spark).selectExpr("*", "'en' AS lang")).languages == []


def test_one_document_is_enough_to_learn(spark):
    rows = [(1, "the quick brown fox jumps over the lazy dog", "en"), (4, "der schnelle braune Fuchs springt", "de"),
            (2, "quick brown dog", None), (3, "braune schnelle", None)]
    assert not any(zlib.crc32(str(r[0]).encode()) % 5 == 0 for r in rows[:2])  # neither is held out
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = li.learn(docs)
    assert filters.languages == ["de", "en"]
    got = {g.row.doc_id: (g.lang_pred, g.outcome) for g in li.identify(docs, filters).collect()}
    assert got[2] == ("en", "predicted") and got[3] == ("de", "predicted")


def test_outcomes(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, "12 !"), (3, None)], "doc_id long, text string")
    unlearned = li.learn(docs.selectExpr("*", "CAST(NULL AS STRING) AS lang"))
    learned = li.learn(docs.selectExpr("*", "'en' AS lang"))
    for filters, first in ((unlearned, "unlearned"), (learned, "predicted")):
        got = {g.row.doc_id: g.outcome for g in li.identify(docs, filters).collect()}
        assert got == {1: first, 2: "no letter", 3: "no letter"}


def test_filters_hold_the_exact_sets_and_counts_are_near_them(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    filters = li.learn(docs)
    train = [r for r in docs.collect() if r.text and r.lang and zlib.crc32(str(r.doc_id).encode()) % 5]
    exact = []
    for lang in filters.languages:
        mine = [np.unique(li.ngrams([r.text])[0]) for r in train if r.lang == lang]
        gram, many = np.unique(np.concatenate(mine), return_counts=True)
        exact.append(gram[many >= li.MIN_SHARE * len(mine)])
    of = li.Filters.of(filters.languages, np.repeat(np.arange(len(exact)), [len(e) for e in exact]), np.concatenate(exact))
    assert (of.slots == filters.slots).all()
    for r in docs.limit(60).collect():
        grams, first = li.ngrams([r.text or ""])
        counts = filters.counts(grams, first)[0]
        want = [np.isin(grams, e).sum() for e in exact]
        assert np.abs(counts - want).max() <= 3 + 0.02 * len(grams)


def test_a_full_filter_says_nothing(spark):
    grams = np.random.default_rng(1).integers(0, 2**64, 8_000_000, dtype=np.uint64)
    some, _ = li.ngrams(["plain words of the other language"])
    filters = li.Filters.of(["full", "other"], np.append(np.zeros(len(grams), np.int64), np.ones(len(some), np.int64)), np.append(grams, some))
    assert filters.false_share[0] == 1
    docs = spark.createDataFrame([(1, "plain words of the other language"), (2, "zzz qqq"), (3, "12")], "doc_id long, text string")
    got = {g.row.doc_id: (g.lang_pred, g.score) for g in li.identify(docs, filters).collect()}
    assert got[1] == ("other", 1.0) and got[2][1] < 0.2 and got[3] == ("und", 0.0)
    alone = li.Filters.of(["full"], np.zeros(len(grams), np.int64), grams)
    assert {(g.lang_pred, g.score) for g in li.identify(docs.limit(2), alone).collect()} == {("full", 0.0)}


def test_a_language_without_ngrams_is_not_one(spark):
    rows = [(1, "the quick brown fox jumps", "en"), (2, "...", "aa"), (4, "der schnelle braune Fuchs", "de"), (3, "12", "zz")]
    filters = li.learn(spark.createDataFrame([(i * 6 + 1, t, x) for i, t, x in rows] + [(i * 6 + 2, t, x) for i, t, x in rows], "doc_id long, text string, lang string"))
    assert filters.languages == ["de", "en"]
    grams, first = li.ngrams(["the quick brown fox jumps"])
    assert filters.counts(grams, first).argmax() == 1
