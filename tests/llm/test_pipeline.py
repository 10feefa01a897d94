"""The pipeline, stage by stage and as a whole, against a brute-force version."""

import json

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import fixtures, test_decontaminate, test_simhash, test_suffix_dedup
from tidemark.llm import bpe
from tidemark.llm.language_id import identify, learn
from tidemark.session import work_dir

SCHEMA = fixtures.SCHEMA + ", lang string"


def rows():
    return [(*r, (None, "aa", "bb")[i % 3]) for i, r in enumerate(fixtures.rows())]


@pytest.fixture(scope="module")
def folder(spark):
    path = work_dir(spark, "test-pipeline")
    spark.createDataFrame(rows(), SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(test_decontaminate.ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def brute_force():
    """What each stage leaves: rows, and at last (doc_id, ids)."""
    kept = [r for r in rows() if any(c.isalpha() for c in r[1] or "")]
    yield kept
    component = test_simhash.components([r[0] for r in kept], [test_simhash.fingerprint(r[1]) for r in kept])
    seen, some = set(), []
    for r, c in zip(kept, component, strict=True):
        if r[0] == c and str(c) not in seen:
            seen.add(str(c))
            some.append(r)
    yield some
    cut = []
    for r, (data, gone) in zip(some, test_suffix_dedup.brute_force(some), strict=True):
        text = bytes(np.frombuffer(data, np.uint8)[~gone]).decode(errors="ignore")
        cut.append((r[0], text, *r[2:7], len(text), r[8]))
    yield cut
    clean = [r for r, b in zip(cut, test_decontaminate.brute_force([r[1] for r in cut], test_decontaminate.ITEMS), strict=True) if not b[3]]
    yield clean
    tokenizer = Tokenizer.from_file(bpe.tokenizer_file())
    yield [(r[0], [*tokenizer.encode(r[1], add_special_tokens=False).ids, 0]) for r in clean]


def test_stages_and_run(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = list(brute_force())
    key = lambda r: json.dumps([str(x) for x in r])
    for (name, stage), left in zip(corpus_pipeline.STAGES[:-1], want, strict=False):
        out = stage(spark, docs, folder)
        assert out.dtypes == docs.dtypes, name
        assert sorted(map(key, out.collect())) == sorted(map(key, left)), name
        out.write.parquet(path := work_dir(spark, "test-stage"))
        docs = spark.read.parquet(path)
    assert all(len(a) > len(b) for a, b in zip([rows(), *want], want[:2], strict=False)) and len(want[3]) < len(want[2])
    pieces = sorted(corpus_pipeline.run(spark, folder).collect(), key=lambda p: (str(p.doc_id), p.start))
    found = {}
    for p in pieces:
        assert p.length & (p.length - 1) == 0 and p.length <= 1024 and p.offset == 0
        found.setdefault(str(p.doc_id), []).extend(p.ids)
    assert found == {str(i): ids for i, ids in want[4]}
    assert len({p.sequence_id for p in pieces}) == len(pieces)


def test_empty_table(spark, folder):
    path = work_dir(spark, "test-pipeline")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(test_decontaminate.ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, path).collect() == []


def test_unlabelled_documents_stay(spark, folder):
    """Without any label nothing is learned; the stage keeps what it keeps with labels."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("* EXCEPT (lang)", "CAST(NULL AS STRING) AS lang")
    got = corpus_pipeline.language_id(spark, docs, folder).collect()
    assert sorted(str(g.doc_id) for g in got) == sorted(str(r[0]) for r in next(brute_force()))


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "SimHash near-dedup", "suffix-array dedup", "benchmark decontamination", "packing"]


def test_the_language_stage_can_keep_languages_and_scores(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = identify(docs, learn(docs)).collect()
    stage = lambda **how: {r.doc_id for r in corpus_pipeline.language_id(spark, docs, "", **how).collect()}
    assert stage(languages=("de", "fr")) == {g.row.doc_id for g in found if g.lang_pred in ("de", "fr")}
    assert stage(least_score=0.6) == {g.row.doc_id for g in found if g.outcome == "predicted" and g.score >= 0.6}
    assert stage() == {g.row.doc_id for g in found if g.outcome != "no letter"}
