"""Encoding whole texts with a tokenizer file of the tokenizers library, inside tasks.

Byte-level BPE never joins a character and the single space after it, nor
a single newline and what stands beside it, so a text may be cut before
such spaces and around such newlines and its pieces encoded one by one:
the ids are the same.  Pieces repeat, so each Python worker remembers the
ids of about ``REMEMBERED`` pieces.  Short pieces are told apart by their
own bytes in two 64-bit numbers and looked up a chunk of text at a time;
new ones are encoded together.  Any other tokenizer is given whole texts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types

import numpy as np
from pyspark.sql import SparkSession

from tidemark.llm.common import texts, trim
from tidemark.llm.hashing import BASE, chunks, mix, ranges

REMEMBERED = 1_200_000
END = 0
SHORT = 15  # bytes of a piece that is told apart by two numbers: the last of 16 bytes is its length
TOGETHER = 2000  # new pieces that are encoded as one text
KEPT = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)  # the first k bytes of eight
WHITE = np.isin(np.arange(256), [*range(0x09, 0x0E), *range(0x1C, 0x21)])  # ASCII's white space, as str.split has it
LEAD = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])  # first bytes of any other white space


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def shared_tokenizer(spark: SparkSession, path: str | None):
    """The tokenizer file's text, broadcast (files of a megabyte or two)."""
    with open(path or tokenizer_file(), encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def white(data: np.ndarray) -> np.ndarray:
    """Which bytes of some UTF-8 text belong to a white space character."""
    found = WHITE[data]
    at = np.flatnonzero(LEAD[data])
    if len(at):
        a, b, c = (np.append(data, np.zeros(2, np.uint8))[at + k] for k in range(3))
        two = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
        three = ((a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE2) & (b == 0x81) & (c == 0x9F) | (a == 0xE3) & (b == 0x80) & (c == 0x80)
                 | (a == 0xE2) & (b == 0x80) & ((c >= 0x80) & (c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)))
        for k, which in ((0, two | three), (1, two | three), (2, three)):
            found[at[which] + k] = True
    return found


class Encoder:
    def __init__(self, description: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(description)
        self.vocabulary = self.tokenizer.get_vocab_size()
        about = json.loads(description)
        kind = about.get("pre_tokenizer") or {}
        self.cuts = (kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not kind.get("add_prefix_space")
                     and not about.get("normalizer") and not about.get("truncation")
                     and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in about["added_tokens"]))
        named = self.tokenizer.get_vocab(with_added_tokens=False)
        added = {t["id"] for t in about["added_tokens"]}
        self.opens = np.zeros(1 + max([*named.values(), *added], default=0), bool)  # ids of tokens that begin with a space
        self.opens[[i for name, i in named.items() if name.startswith("\u0120") and i not in added]] = True
        self.forget()

    def forget(self) -> None:
        """Only the end of a text is known: its code is 0."""
        self.known, self.long = 1, {}
        self.key = np.zeros((1 << 12, 2), np.uint64)
        self.start, self.length, self.uses = (np.zeros(1 << 12, np.int64) for _ in range(3))
        self.ids, self.used = np.full(1 << 14, END, np.uint32), 1
        self.length[0] = 1
        self.table = np.full(1 << 14, -1, np.int32)

    def shrink(self) -> None:
        """Keep the half that was used most."""
        n = self.known
        keep = np.zeros(n, bool)
        keep[np.argsort(-self.uses[:n], kind="stable")[:n // 2]] = True
        keep[0] = True
        number = np.cumsum(keep) - 1
        self.long = {p: int(number[c]) for p, c in self.long.items() if keep[c]}
        length = self.length[:n][keep]
        self.ids = self.ids[ranges(self.start[:n][keep], length)]
        self.key, self.known = self.key[:n][keep], int(keep.sum())
        self.start, self.length, self.uses, self.used = np.cumsum(length) - length, length, self.uses[:n][keep] // 2, len(self.ids)
        self.table[:] = -1
        self.enter(np.flatnonzero(self.key[:, 1]))

    def places(self, key: np.ndarray) -> np.ndarray:
        return (mix(key[:, 0] ^ key[:, 1] * np.uint64(BASE)) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def enter(self, codes: np.ndarray) -> None:
        """Put the codes of short pieces into the table, each at the first free place from its own on."""
        at = self.places(self.key[codes])
        while len(codes):
            free = self.table[at] < 0
            self.table[at[free]] = codes[free]
            left = self.table[at] != codes
            codes, at = codes[left], (at[left] + 1) & (len(self.table) - 1)

    def find(self, key: np.ndarray) -> np.ndarray:
        """The codes of short pieces, -1 for those not known."""
        at = self.places(key)
        out = self.table[at].astype(np.int64)
        todo = np.flatnonzero((out >= 0) & (self.key[out] != key).any(axis=1))
        while len(todo):
            at[todo] = (at[todo] + 1) & (len(self.table) - 1)
            code = self.table[at[todo]].astype(np.int64)
            out[todo] = code
            todo = todo[(code >= 0) & (self.key[code] != key[todo]).any(axis=1)]
        return out

    def pieces(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where the pieces of texts begin; ``ends`` has the places of the newlines after each, which are pieces of their own."""
        cut = np.zeros(len(data) + 1, bool)
        cut[0] = True
        cut[ends] = cut[ends + 1] = True
        if self.cuts:
            blank = white(data)
            one = np.flatnonzero(blank[1:-1] & ~blank[:-2] & ~blank[2:]) + 1
            cut[one[data[one] == 0x20]] = True
            lines = one[data[one] == 0x0A]
            cut[lines] = cut[lines + 1] = True
        return np.flatnonzero(cut[:-1])

    def ids_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, and the number of ids of each."""
        if self.cuts and all(p[0] == " " for p in pieces):
            text = "".join(pieces)
            words = text.split()
            if len(words) == len(pieces) == len(text) - len("".join(words)):  # a space, and a word without any
                ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
                first = np.flatnonzero(self.opens[ids])
                if len(first) == len(pieces):
                    return ids, np.diff(first, append=len(ids))
        found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        size = np.array([len(x) for x in found], np.int64)
        return np.fromiter((i for x in found for i in x), np.uint32, int(size.sum())), size

    def remember(self, pieces: list[bytes], key: np.ndarray) -> np.ndarray:
        """The codes of new pieces; ``key`` is zero for long ones."""
        n, many = self.known, len(pieces)
        texts = [p.decode() for p in pieces]
        spaced = np.array([t[0] == " " for t in texts], bool)
        order = np.argsort(~spaced, kind="stable")
        at, middle = 0, int(spaced.sum())
        self.start, self.length, self.uses, self.key = (room(x, n, many) for x in (self.start, self.length, self.uses, self.key))
        while at < many:
            stop = min(at + TOGETHER, middle if at < middle else many)
            mine = order[at:stop]
            ids, size = self.ids_of([texts[i] for i in mine.tolist()])
            self.start[n + mine], self.length[n + mine] = self.used + np.cumsum(size) - size, size
            self.ids = room(self.ids, self.used, len(ids))
            self.ids[self.used:self.used + len(ids)] = ids
            self.used += len(ids)
            at = stop
        self.key[n:n + many], self.uses[n:n + many] = key, 0
        self.known += many
        codes = np.arange(n, n + many)
        brief = key[:, 1] > 0
        self.long.update((pieces[i], n + i) for i in np.flatnonzero(~brief).tolist())
        if 2 * self.known > len(self.table):
            self.table = np.full(1 << (4 * self.known).bit_length(), -1, np.int32)
            self.enter(np.flatnonzero(self.key[:self.known, 1]))
        else:
            self.enter(codes[brief])
        return codes

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, an END after each; and the number of ids of each text with its END."""
        return self.encode_bytes([(t or "").encode() for t in texts])

    def encode_bytes(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same of texts in UTF-8."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if self.known > REMEMBERED:
            self.shrink()
        if self.used > 8 * REMEMBERED:  # long pieces
            self.forget()
        raw = b"\n".join([*texts, b""])
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        start = self.pieces(np.frombuffer(raw, np.uint8), ends)
        size = np.diff(start, append=len(raw))
        eight = np.ndarray(len(raw) + 9, "<u8", raw + bytes(16), strides=(1,))  # the eight bytes from each place on
        key = np.empty((len(start), 2), np.uint64)
        key[:, 0] = eight[start] & KEPT[np.minimum(size, 8)]
        key[:, 1] = eight[start + 8 * (size > 8)] & KEPT[np.clip(size - 8, 0, 7)] | size.astype(np.uint64) << np.uint64(56)
        key[size > SHORT] = 0
        last = np.searchsorted(start, ends)
        code = self.find(key)
        code[last] = 0
        for i in np.flatnonzero(size > SHORT).tolist():
            code[i] = self.long.get(raw[start[i]:start[i] + size[i]], -1)
        missing = np.flatnonzero(code < 0)
        if len(missing):
            number: dict[bytes, int] = {}
            which = [number.setdefault(raw[a:b], len(number)) for a, b in zip(start[missing].tolist(), (start + size)[missing].tolist(), strict=True)]
            _, first = np.unique(which, return_index=True)
            code[missing] = self.remember(list(number), key[missing[first]])[which]
        np.add.at(self.uses, code, 1)
        length = self.length[code]
        total = np.cumsum(length)[last]
        return self.ids[ranges(self.start[code], length)], np.diff(total, prepend=0)


def room(array: np.ndarray, used: int, more: int) -> np.ndarray:
    if used + more <= len(array):
        return array
    out = np.zeros((max(2 * len(array), used + more), *array.shape[1:]), array.dtype)
    out[:used] = array[:used]
    return out


def encoder(description: str) -> Encoder:
    """This Python worker's encoder; it outlives a task."""
    kept = sys.modules.setdefault("_tidemark_worker", types.ModuleType("_tidemark_worker")).__dict__
    key = ("encoder", hash(description))
    if key not in kept:
        kept[key] = Encoder(description)
    return kept[key]


def encoded(batches, description: str):
    """(batch, first row, ids, numbers of ids) for slices of about a megabyte of the rows of each batch."""
    coder = encoder(description)
    for batch in batches:
        docs = texts(batch)
        for a, b in chunks(docs):
            yield batch, a, *coder.encode_bytes(docs[a:b])
    trim()
