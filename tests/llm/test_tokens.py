"""Encoding, packing and token files."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm import fixtures
from tidemark.llm import bpe, packing, token_files
from tidemark.session import work_dir

ODD = ["", " ", "  a  b", "a\n\nb \n c\t\td", "x y  z <|endoftext|> k<|endoftext|>", "don't  you've\n 's ", "\0 a b", "Ünï 一二三 ²³ ½ q r",
       "a \n b", "..  ..   x\r\ny", "\x1c \x1f a", " lead", "trail ", "a\n\n\ta\ta", "a\n\tb", "word, word. 'word.' we're. é. 一。 一. it's... x's, a.b, (c) [d]. <|endoftext|>. a<|endoftext|>, end!<|endoftext|>", "   three   spaces", "a" * 500]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(bpe.tokenizer_file())


@pytest.fixture(scope="module")
def coder():
    with open(bpe.tokenizer_file()) as f:
        return bpe.Encoder(f.read())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_pieces_give_the_same_ids(tokenizer, coder):
    texts = [*ODD, None, *fixtures.texts()]
    for _ in range(2):  # from the library, then from what was remembered
        ids, many = coder.encode(texts)
        ends = np.cumsum(many)
        for t, a, b in zip(texts, ends - many, ends, strict=True):
            assert ids[a:b].tolist() == ids_of(tokenizer, t)


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from([*"aB'1 é\n\t.,*<|>\u00a0\u3000字", "end", "  ", "'s", " \n"]), max_size=30).map("".join))
def test_any_text_gives_the_same_ids(tokenizer, coder, text):
    assert coder.encode([text])[0].tolist() == ids_of(tokenizer, text)


def test_forgetting_changes_nothing(tokenizer, monkeypatch):
    with open(bpe.tokenizer_file()) as f:
        small = bpe.Encoder(f.read())
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    for t in fixtures.texts():
        assert small.encode([t])[0].tolist() == ids_of(tokenizer, t)


@pytest.mark.parametrize("longest", [1024, 8])
def test_pieces_partition_documents(spark, tokenizer, longest):
    rows = fixtures.rows()
    got = packing.pack_documents(fixtures.documents(spark), longest=longest).collect()
    assert len({g.sequence_id for g in got}) == len(got)  # one piece per sequence: none crosses documents
    by_length = {}
    for g in got:
        assert g.length <= longest and g.length & (g.length - 1) == 0 and g.offset == 0 and crc(g.ids) == g.ids_crc32 and len(g.ids) == g.length
        by_length.setdefault(g.length, []).append(g.sequence_id)
    for n, ids in by_length.items():  # equal lengths are numbered side by side, longest first
        assert all(max(ids) < min(by_length[m]) for m in by_length if m < n)
    docs = {}
    for g in got:
        docs.setdefault((str(g.row.doc_id), str(g.row.id), str(g.row.n_chars)), []).append(g)
    for r in rows:
        mine = sorted(docs[str(r[0]), str(r[3]), str(r[7])], key=lambda g: g.start)
        ids = ids_of(tokenizer, r[1])
        copies = sum(x == r for x in rows)
        assert sum(g.length for g in mine) == copies * len(ids) and {g.doc_tokens for g in mine} == {len(ids)}
        for g in mine:
            assert list(g.ids) == ids[g.start:g.start + g.length]


def test_pack_empty_table(spark):
    assert packing.pack_documents(fixtures.empty(spark)).collect() == []


def test_lengths():
    assert packing.lengths(1500, 1024) == [1024, 256, 128, 64, 16, 8, 4]
    assert packing.lengths(2048, 1024) == [1024, 1024] and packing.lengths(1, 1024) == [1]


@pytest.mark.parametrize("shard_bytes", [token_files.SHARD_BYTES, 20_000])
def test_token_files_round_trip(spark, tokenizer, shard_bytes):
    rows = fixtures.rows()
    path = work_dir(spark, "test-token-files")
    manifest = token_files.write_token_files(fixtures.documents(spark), path, shard_bytes=shard_bytes)
    got = sorted(token_files.read_token_files(spark, path).collect(), key=lambda g: g.start)
    ids = [g.doc_id for g in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [g.start for g in got] == [0, *np.cumsum([g.n_tokens for g in got])[:-1].tolist()]
    want = sorted((str(r[0]), len(ids_of(tokenizer, r[1])), crc(ids_of(tokenizer, r[1]))) for r in rows)
    assert sorted((str(g.doc_id), g.n_tokens, g.ids_crc32) for g in got) == want
    at = 0
    for entry in manifest:  # each document by select
        shard = token_files.Shard(f"{path}/{entry['file']}")
        assert shard.about["width"] == 2
        for i in range(entry["docs"]):
            ident, found = shard.document(i)
            assert (ident, len(found), crc(found)) == (got[at].doc_id, got[at].n_tokens, got[at].ids_crc32)
            at += 1
    assert at == len(rows)


def test_token_files_of_an_empty_table(spark):
    path = work_dir(spark, "test-token-files")
    assert token_files.write_token_files(fixtures.empty(spark), path) == []
    assert token_files.read_token_files(spark, path).collect() == []


@pytest.mark.parametrize("values", [[], [0], [0, 0, 0], [5, 5, 9, 1000, 10**12], list(range(0, 5000, 3)), [2**62] * 3])
def test_elias_fano(values):
    code = token_files.EliasFano.of(np.array(values, np.int64))
    assert code.all().tolist() == values
    assert [code.select(i) for i in range(len(values))] == values


def test_elias_fano_is_small():
    values = np.sort(np.random.default_rng(0).integers(0, 10**7, 20_000))
    code = token_files.EliasFano.of(values)
    bits = 8 * (len(code.low) + len(code.high) + 8 * len(code.samples))
    assert bits < 20_000 * (np.log2(10**7 / 20_000) + 2.5)
    assert [code.select(i) for i in range(0, 20_000, 37)] == values[::37].tolist()


def test_parts_of_elias_fano_lists_are_selected():
    r = np.random.default_rng(3)
    for n, top in ((1, 1), (5, 3), (700, 40), (3000, 10**9), (900, 900), (600, 2)):
        values = np.sort(r.integers(0, top, n)).astype(np.uint64)
        held = token_files.EliasFano.of(values)
        for lo, hi in ((0, n), (0, 0), (n, n), *[sorted(r.integers(0, n + 1, 2).tolist()) for _ in range(20)]):
            assert (held.part(lo, hi) == values[lo:hi]).all()
        assert [held.select(i) for i in range(0, n, 97)] == values[::97].tolist()


class Counting:
    """The library's tokenizer, which counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, 0

    def encode_batch_fast(self, texts, **how):
        self.given += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **how)


def test_new_pieces_are_encoded_together_and_known_ones_not_at_all(tokenizer):
    with open(bpe.tokenizer_file()) as f:
        coder = bpe.Encoder(f.read())
    text = " ".join(f"w{i}x" for i in range(5000))
    coder.tokenizer = Counting(coder.tokenizer)
    assert coder.encode([text])[0].tolist() == ids_of(tokenizer, text)
    given = coder.tokenizer.given
    assert given <= 5000 / bpe.TOGETHER + 2
    assert coder.encode([text, text])[0].tolist() == 2 * ids_of(tokenizer, text)
    assert coder.tokenizer.given == given


def test_pieces_that_differ_little_are_told_apart(tokenizer, coder):
    texts = [f"{lead}{'x' * n}{tail}" for n in (0, 1, 5, 6, 7, 8, 9, 13, 14, 15, 16, 17, 24) for lead in ("", "k ", "\0", "k \0") for tail in ("", "\0", "\0\0", "y")]
    texts += [f"a{c}b {c}c{c} d\n{c}\ne {c}{c} f" for c in "\x1c\x1f\x85\xa0 ᠎  ​    　Ġ﻿\r\v"]
    for _ in range(2):
        for some in (texts, texts[::-1]):
            ids, many = coder.encode(some)
            for t, got in zip(some, np.split(ids, np.cumsum(many)[:-1]), strict=True):
                assert got.tolist() == ids_of(tokenizer, t)


def test_a_table_that_fills_grows(tokenizer):
    with open(bpe.tokenizer_file()) as f:
        coder = bpe.Encoder(f.read())
    for k in range(3):
        text = " ".join(f"{i:x}" for i in range(k * 9000, k * 9000 + 12000))
        assert coder.encode([text])[0].tolist() == ids_of(tokenizer, text)
    assert len(coder.table) >= 2 * coder.known
