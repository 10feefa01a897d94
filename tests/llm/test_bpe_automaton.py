import hashlib
import random

import numpy as np
import pytest
from tests.llm import fixtures
from tokenizers import Tokenizer, models

from tidemark.llm import bpe_automaton as b
from tidemark.llm.bpe import tokenizer_file
from tidemark.llm.queries import REGISTRY


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_file())


def explicit(n_bytes, merges):
    """The automaton with every arc written out: state -> {label: state}."""
    arcs, target = [{t: 0 for t in range(n_bytes)}], {t: 0 for t in range(n_bytes)}
    for u, v, c in merges:
        s2 = target[u]
        if v not in arcs[s2]:
            target[c] = target[v]
            continue
        s3 = arcs[s2][v]
        copy = len(arcs)
        arcs.append({label: to for label, to in arcs[s2].items() if label != v})
        for arc in arcs:
            if u in arc:
                arc[u] = copy
                arc[c] = s3
        target[u], target[c] = copy, s3
    return arcs


def random_merges(r, letters, n):
    names = [bytes([97 + i]) for i in range(letters)]
    merges = []
    while len(merges) < n:
        u, v = r.randrange(len(names)), r.randrange(len(names))
        if names[u] + names[v] not in names and len(names[u] + names[v]) <= 12:
            names.append(names[u] + names[v])
            merges.append((u, v, len(names) - 1))
    return names, merges


def test_gadgets_give_the_same_paths_as_the_automaton_with_every_arc_and_the_library():
    r = random.Random(5)
    for _ in range(40):
        names, merges = random_merges(r, r.randrange(1, 4), r.randrange(1, 9))
        a = b.build(dict(enumerate(names)), merges)
        arcs = explicit(len(names) - len(merges), merges)
        letters = [n.decode() for n in names]
        bpe = Tokenizer(models.BPE({n: i for i, n in enumerate(letters)}, [(letters[u], letters[v]) for u, v, _ in merges]))
        words = ["".join(r.choice(letters[:len(names) - len(merges)]) for _ in range(r.randrange(1, 70))) for _ in range(30)]
        ids, many = b.encode_words(a, [w.encode() for w in words])
        for word, got in zip(words, np.split(ids, np.cumsum(many)[:-1]), strict=True):
            assert got.tolist() == bpe.encode(word).ids == b.walk(a, word.encode())
            state = 0
            for token in got.tolist():  # the path is one of the automaton
                state = arcs[state][token]


def test_merges_that_cannot_be_built_in_are_refused():
    with pytest.raises(ValueError):
        b.build({0: b"a", 1: b"b", 2: b"ab"}, [(0, 1, 2), (0, 1, 2)])
    with pytest.raises(ValueError):
        b.build({0: b"a", 1: b"b", 2: b"ab", 3: b"aba"}, [(2, 0, 3), (0, 1, 2)])


def test_texts_as_the_library_encodes_them(library):
    r = random.Random(1)
    parts = ["a", "the", " ", "  ", "\n", "\t", "'s", "'", "1", "é", "日本", "<|endoftext|>", "<|endof", "\x1c", "\x85", "​", "\0", "x" * 70, "!",
             "...", "\U0001F600", "՘", "ᲊ", "\U000323b0", "'ll", "\r\n", "abcab" * 30]
    docs = ["".join(r.choice(parts) for _ in range(r.randrange(40))) for _ in range(1500)]
    docs += ["".join(chr(r.randrange(32, 0x3000)) for _ in range(3000)), "a" * 5000, " " * 1000, "日本語" * 400, "", None, *fixtures.texts()]
    coder = b.AutomatonEncoder(b.compile_tokenizer())
    ids, many = coder.encode(docs)
    for doc, got in zip(docs, np.split(ids, np.cumsum(many)[:-1]), strict=True):
        assert got[:-1].tolist() == library.encode(doc or "", add_special_tokens=False).ids


def test_documents_with_nulls_copies_and_clashing_columns(spark, library):
    docs = fixtures.documents(spark)
    got = b.decode_documents(b.encode_documents(docs)).select("row.*", "n_tokens", "ids", "decoded").collect()
    assert len(got) == docs.count()
    want = sorted((str(t), len(i := library.encode(t or "", add_special_tokens=False).ids), np.array(i, "<u4").tobytes(), t or "")
                  for t in (row[1] for row in fixtures.rows()))
    assert sorted((w[0], r.n_tokens, bytes(r.ids), r.decoded) for r, w in zip(
        sorted(got, key=lambda r: (r.decoded, r.n_tokens)), sorted(want, key=lambda w: (w[3], w[1])), strict=True)) == want
    empty = b.decode_documents(b.encode_documents(fixtures.empty(spark)))
    assert empty.columns == ["row", "n_tokens", "ids", "decoded"] and empty.count() == 0


def test_any_ids_decode_as_in_the_library(spark, library):
    r = random.Random(2)
    lists = [[r.randrange(50257) for _ in range(r.randrange(30))] for _ in range(200)] + [[], [127, 127, 50256]]
    rows = spark.createDataFrame([(i, np.array(x, "<u4").tobytes()) for i, x in enumerate(lists)] + [(-1, None)], "n int, ids binary")
    got = {row.n: row.decoded for row in b.decode_documents(rows).collect()}
    assert got == {-1: ""} | {i: library.decode(x, skip_special_tokens=False) for i, x in enumerate(lists)}


def test_query_against_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    sha = lambda x: hashlib.sha256(x).hexdigest()
    want = []
    for row in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        want.append((row.doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False).encode())))
    got = REGISTRY["op11_bpe_automaton"](spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)
