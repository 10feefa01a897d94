"""Byte-level BPE as a deterministic automaton over tokens.

The automaton accepts exactly the token sequences that the merges give.
It starts with one state and an arc to it for each byte.  The merges are
then built in, in their order, each by one gadget: for the merge of u and
v into c, the state after u is copied without its arc v (so that v no
longer follows u), all arcs u now lead to the copy, and every state with
an arc u gets an arc c to where v led.  All arcs with one label lead to
one state, so a token's target is one number.

Arcs that a gadget adds need no table of their own: a state has the arc c
if it had the arc u when c was made.  So the table holds, per state, only
the arcs that were taken away and by which merge; a state's arc is looked
up along the left halves of its label (14,639 states and 365,863 arcs
taken away for a vocabulary of 50,256).

Each prefix of a word has exactly one path.  A word is encoded from left
to right: from the state of each prefix, a walk down the trie of labels
finds the arcs that spell the next bytes, and each arc that the state has
gives the state of a longer prefix; the longest prefix found is gone on
from first, until the word's end is reached.  The path is read backwards
from there.  All words of a batch take these steps together.

Decoding emits the labels of the arcs; bytes that are no UTF-8 become
U+FFFD.

Null texts are empty and have no ids.  A special token's string in a text
is that token, as in the tokenizers library.  Each row is a document of
its own, repeated or not; other input columns come back in ``row``.
Words of any length are encoded whole.
"""

from __future__ import annotations

import json
import sys
import types
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import Encoder, room, tokenizer_file
from tidemark.llm.common import field, packed, quoted, result, share, small_batches, texts, trim
from tidemark.llm.hashing import BASE, chunks, ranges

ALWAYS = np.int32(2**31 - 1)  # the number of a merge that never comes
LONG = 50  # bytes of a word; longer ones are walked one by one
PAST = 256  # no byte
# How the byte-level scheme splits a text into words.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Table:
    """Whole numbers from 64-bit keys, found by open addressing; ``missing`` for all other keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int):
        bits = max(4, (2 * len(keys)).bit_length())
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys, self.values, self.missing = np.full(self.mask + 1, -1, np.int64), np.zeros(self.mask + 1, np.int32), missing
        rest, at = np.arange(len(keys)), self.place(keys)
        while len(rest):
            free = self.keys[at] < 0
            slot, first = np.unique(np.where(free, at, -1), return_index=True)  # one key for each free slot
            first = first[slot >= 0]
            self.keys[at[first]], self.values[at[first]] = keys[rest[first]], values[rest[first]]
            stay = np.ones(len(rest), bool)
            stay[first] = False
            rest, at = rest[stay], (at[stay] + ~free[stay]) & self.mask

    def place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(BASE) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self.place(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], self.missing)
        rest = np.flatnonzero((held != keys) & (held >= 0))
        at = at[rest]
        while len(rest):
            at = (at + 1) & self.mask
            held = self.keys[at]
            hit = held == keys[rest]
            out[rest[hit]] = self.values[at[hit]]
            go = ~hit & (held >= 0)
            rest, at = rest[go], at[go]
        return out

    def plain(self) -> dict[int, int]:
        used = self.keys >= 0
        return dict(zip(self.keys[used].tolist(), self.values[used].tolist(), strict=True))


@dataclass
class Automaton:
    """``labels`` of the arcs by token; ``target``: the state after a token; ``left``: the bytes of its left half;
    ``born``: its merge (-1: a byte); ``taken``: merge by state * size + token; ``child`` by node * 512 + byte and
    ``token`` by node: the trie of labels (0 is the root, -1 no token)."""

    labels: list[bytes]
    target: np.ndarray
    left: np.ndarray
    born: np.ndarray
    taken: Table
    child: Table
    token: np.ndarray
    states: int
    size: int


def byte_letters() -> dict[str, int]:
    """The letter by which a vocabulary file shows each byte: itself if it prints, else one after U+00FF."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


def build(labels: dict[int, bytes], merges: list[tuple[int, int, int]]) -> Automaton:
    """The automaton of a vocabulary (token: its bytes) and its merges (left, right, whole), in their order."""
    size = max(labels, default=-1) + 1
    target = {t: 0 for t, label in labels.items() if len(label) == 1}
    if len(target) != len({labels[t] for t in target}):
        raise ValueError("two tokens are the same byte")
    half: dict[int, int] = {}
    born = dict.fromkeys(target, -1)
    states: list[dict[int, int]] = [{}]  # the arcs taken away from each
    users = [len(target) + 1]  # labels that lead to a state, and the start

    def gone(state: dict[int, int], token: int) -> int:
        """The merge that took the arc away; -1 if it was never there."""
        if born[token] >= 0 and gone(state, half[token]) <= born[token]:
            return -1
        return state.get(token, ALWAYS)

    for k, (u, v, c) in enumerate(merges):
        if u not in target or v not in target or c in target or labels[c] != labels[u] + labels[v]:
            raise ValueError(f"merge {k} does not make a new token of earlier ones")
        state, after = target[u], target[v]
        half[c], born[c], target[c] = u, k, after
        users[after] += 1
        if gone(states[state], v) != ALWAYS:  # v never follows u: c has no arc
            born[c] = ALWAYS
        elif users[state] == 1:  # nothing else leads there: it is its own copy
            states[state][v] = k
        else:
            users[state] -= 1
            states.append(states[state] | {v: k})
            users.append(1)
            target[u] = len(states) - 1
    row = lambda of, other: np.array([of.get(t, other) for t in range(size)], np.int32)
    taken = [(s * size + t, k) for s, state in enumerate(states) for t, k in state.items()]
    keys, values = (np.array(x, np.int64) for x in zip(*taken, strict=True)) if taken else (np.zeros(0, np.int64),) * 2
    child, token = trie({t: labels[t] for t in target if born[t] != ALWAYS})
    return Automaton([labels.get(t, b"") for t in range(size)], row(target, 0), row({t: len(labels[u]) for t, u in half.items()}, 0),
                     row(born, -1), Table(keys, values.astype(np.int32), ALWAYS), child, token, len(states), size)


def trie(labels: dict[int, bytes]) -> tuple[Table, np.ndarray]:
    edges: dict[int, int] = {}
    token = [-1]
    for t, label in labels.items():
        node = 0
        for byte in label:
            new = edges.setdefault(node * 512 + byte, len(token))
            if new == len(token):
                token.append(-1)
            node = new
        token[node] = t
    return Table(np.fromiter(edges, np.int64, len(edges)), np.fromiter(edges.values(), np.int32, len(edges)), -1), np.array(token, np.int32)


def encode_words(a: Automaton, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words, one after another, and the number of ids of each."""
    size = np.array([len(w) for w in words], np.int64)
    if not len(words):
        return np.zeros(0, np.uint32), size
    short = np.flatnonzero(size <= LONG)
    short = short[np.argsort(-size[short], kind="stable")]  # those that still have bytes come first
    found: list[np.ndarray | None] = [None] * len(words)
    for i in np.flatnonzero(size > LONG).tolist():
        found[i] = np.array(walk(a, words[i]), np.uint32)
    if not len(short):
        return np.concatenate(found), np.array([len(f) for f in found], np.int64)
    length = size[short]
    longest = int(length[0])
    text = np.full((longest + 1, len(short)), PAST, np.int64)
    flat = np.frombuffer(b"".join(words[i] for i in short.tolist()), np.uint8)
    text[ranges(np.zeros(len(short)), length), np.repeat(np.arange(len(short)), length)] = flat
    state, last = (np.full((longest + 1, len(short)), -1, np.int32) for _ in range(2))
    state[0] = 0
    left = np.zeros((longest + 1, len(short)), np.int32)  # by bytes walked: the merge that took the arc away
    left[0] = ALWAYS
    reached, done = np.ones(len(short), np.int64), np.zeros(len(short), np.int64)  # a bit per prefix
    open_ = np.flatnonzero(length > 0)
    while len(open_):
        at = (np.frexp((reached & ~done)[open_].astype(np.float64))[1] - 1).astype(np.int64)  # the longest one that is left
        done[open_] |= 1 << at
        rows, start, node, n = open_, at, np.zeros(len(open_), np.int64), 0
        while len(rows):
            node = a.child.find(node * 512 + text[start + n, rows])
            go = np.flatnonzero(node >= 0)
            rows, start, node, n = rows[go], start[go], node[go].astype(np.int64), n + 1
            token = a.token[node]
            left[n, rows] = -1
            arc = np.flatnonzero((token >= 0) & (left[a.left[token], rows] > a.born[token]))
            row, begin, token = rows[arc], start[arc], token[arc]
            gone = a.taken.find(state[begin, row].astype(np.int64) * a.size + token)
            left[n, row] = gone
            arc = np.flatnonzero(gone == ALWAYS)
            row, end, token = row[arc], begin[arc] + n, token[arc]
            state[end, row], last[end, row] = a.target[token], token
            reached[row] |= 1 << end
            if n >= longest:
                break
        open_ = open_[reached[open_] >> length[open_] == 0]
    many = np.zeros(len(short), np.int64)
    steps, rows, end = [], np.arange(len(short)), length.copy()
    width = np.array([len(label) for label in a.labels], np.int64)
    while len(rows := rows[end[rows] > 0]):
        token = last[end[rows], rows]
        steps.append((rows, token))
        many[rows] += 1
        end[rows] -= width[token]
    ends = np.cumsum(many)
    ids = np.zeros(int(ends[-1]), np.uint32)
    for n, (rows, token) in enumerate(steps):
        ids[ends[rows] - 1 - n] = token
    if len(short) == len(words):  # back to the order of the words
        order = np.argsort(short, kind="stable")
        return ids[ranges((ends - many)[order], many[order])], many[order]
    for n, i in enumerate(short.tolist()):
        found[i] = ids[ends[n] - many[n]:ends[n]]
    return np.concatenate(found), np.array([len(f) for f in found], np.int64)


def walk(a: Automaton, word: bytes) -> list[int]:
    """The ids of one word of any length."""
    kept = a.__dict__
    if "plain" not in kept:
        kept["plain"] = a.child.plain(), a.taken.plain(), a.token.tolist(), a.target.tolist(), a.left.tolist(), a.born.tolist()
    child, taken, tokens, target, half, born = kept["plain"]
    state, last = [0] * (len(word) + 1), [-1] * (len(word) + 1)
    for i in range(len(word)):
        node, left, base = 0, [int(ALWAYS)], state[i] * a.size
        for n in range(i, len(word)):
            node = child.get(node * 512 + word[n], -1)
            if node < 0:
                break
            token = tokens[node]
            left.append(-1)
            if token >= 0 and left[half[token]] > born[token]:
                left[-1] = taken.get(base + token, ALWAYS)
                if left[-1] == ALWAYS:
                    state[n + 1], last[n + 1] = target[token], token
    out, end = [], len(word)
    while end:
        out.append(last[end])
        end -= len(a.labels[last[end]])
    return out[::-1]


def newer_letters(pre_tokenizer) -> str:
    """Letters and digits of this Unicode table of ``regex`` that the tokenizers library does not know as such."""
    import regex

    known = regex.compile(r"[\p{L}\p{N}]")
    new = [c for c in map(chr, range(0x80, 0x110000)) if unicodedata.category(c) == "Cn" and known.match(c)]
    return "".join(c for c in new if len(pre_tokenizer.pre_tokenize_str("!" + c)) == 1)


@dataclass
class Compiled:
    """What tasks need: the automaton, the special tokens, the code points that are no letters, whether texts may be cut."""

    automaton: Automaton
    special: dict[str, int]
    newer: str
    cuts: bool


@lru_cache(4)
def compile_tokenizer(path: str | None = None) -> Compiled:
    """From a file of the tokenizers library with byte-level BPE, on the driver (a second or two)."""
    from tokenizers import pre_tokenizers

    with open(path or tokenizer_file(), encoding="utf-8") as f:
        about = json.load(f)
    model, kind = about["model"], about.get("pre_tokenizer") or {}
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
    if (model["type"], kind.get("type")) != ("BPE", "ByteLevel") or kind.get("add_prefix_space") or not kind.get("use_regex", True) \
            or about.get("normalizer") or about.get("truncation") or about.get("padding") or odd:
        raise ValueError("only byte-level BPE without normalizer, truncation and padding can be compiled")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in about["added_tokens"]):
        raise ValueError("special tokens that look at their surroundings cannot be compiled")
    letter, vocabulary = byte_letters(), model["vocab"]
    special = {t["content"]: t["id"] for t in about["added_tokens"]}
    own = {i: bytes(letter[c] for c in name) for name, i in vocabulary.items() if name not in special}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    automaton = build(own, [(vocabulary[u], vocabulary[v], vocabulary[u + v]) for u, v in pairs])
    automaton.labels += [b""] * (max(special.values(), default=-1) + 1 - len(automaton.labels))
    for name, i in special.items():
        automaton.labels[i] = bytes(letter[c] for c in name) if all(c in letter for c in name) else name.encode()
    newer = newer_letters(pre_tokenizers.ByteLevel(add_prefix_space=False))
    return Compiled(automaton, special, newer, not any(set(s) & set(" \n") or not s.strip() for s in special))


class AutomatonEncoder(Encoder):
    """A worker's encoder: remembers pieces as its base class does, and finds new ones by the automaton."""

    def __init__(self, compiled: Compiled):
        import regex

        self.compiled, self.cuts = compiled, compiled.cuts
        self.vocabulary = len(compiled.automaton.labels)
        self.word = regex.compile(WORDS)
        self.newer = frozenset(compiled.newer)
        names = sorted(compiled.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.forget()

    def words(self, piece: str) -> list[str]:
        """The words of a piece of text; a special token is a word."""
        if self.special and any(s in piece for s in self.compiled.special):
            parts = self.special.split(piece)
            return [w for p in parts for w in ([p] if p in self.compiled.special else self.plain_words(p))]
        return self.plain_words(piece)

    def plain_words(self, piece: str) -> list[str]:
        if piece.isascii() or self.newer.isdisjoint(piece):
            return self.word.findall(piece)
        like = "".join("\u0378" if c in self.newer else c for c in piece)  # a code point that no table knows
        return [piece[m.start():m.end()] for m in self.word.finditer(like)]

    def ids_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        every = [self.words(p) for p in pieces]
        number: dict[str, int] = {}
        which = np.fromiter((number.setdefault(w, len(number)) for words in every for w in words), np.int64)
        special = self.compiled.special
        ids, many = encode_words(self.compiled.automaton, [b"" if w in special else w.encode() for w in number])
        if special and not special.keys().isdisjoint(number):
            at = [number[s] for s in special if s in number]
            ids = np.insert(ids, (np.cumsum(many) - many)[at], [special[s] for s in special if s in number])
            many[at] = 1
        start = np.cumsum(many) - many
        size = np.add.reduceat(np.append(many[which], 0), np.cumsum([0, *map(len, every[:-1])])) if every else np.zeros(0, np.int64)
        size[[not words for words in every]] = 0
        return ids[ranges(start[which], many[which])], size


def kept(name: str, given, make):
    """What this Python worker made of a broadcast value, once."""
    store = sys.modules.setdefault("_tidemark_worker", types.ModuleType("_tidemark_worker")).__dict__
    if store.get((name, "of")) != given.id:
        store[name, "of"], store[name] = given.id, make(given.value())
    return store[name]


@dataclass
class Given:
    id: str
    value: object


def shared(spark, value, name: str) -> Given:
    import uuid

    return Given(f"{name}-{uuid.uuid4().hex}", share(spark, value))


def binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def encode_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None,
                     carry: list[str] | None = None) -> DataFrame:
    """One row per document: ``row`` (carried columns), ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit
    integers).  One pass over the texts, without a shuffle."""
    given = packed(docs, key, text, carry)
    compiled = shared(docs.sparkSession, compile_tokenizer(tokenizer), "compiled")
    return given.mapInArrow(lambda batches: encode(batches, compiled), result(given, "n_tokens long, ids binary"))


def encode(batches, compiled: Given):
    coder = kept("automaton", compiled, AutomatonEncoder)
    for batch in batches:
        docs = texts(batch)
        for a, b in chunks(docs):
            ids, many = coder.encode_bytes(docs[a:b])
            ends = 4 * np.cumsum(many)  # each text's ids have an end mark after them, which is not asked for here
            raw = ids.astype("<u4").tobytes()
            parts = [raw[e - 4 * n:e - 4] for e, n in zip(ends.tolist(), many.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([field(batch, "row").slice(a, b - a), pa.array(many - 1), binary(parts)],
                                             ["row", "n_tokens", "ids"])
    trim()


def decode_documents(encoded: DataFrame, ids: str = "ids", tokenizer: str | None = None) -> DataFrame:
    """The rows with ``decoded`` after their columns; null ids are no ids.  An id without a token has no label."""
    small_batches(encoded.sparkSession)
    labels = shared(encoded.sparkSession, compile_tokenizer(tokenizer).automaton.labels, "labels")
    rows = encoded.select(F.struct(*[F.col(quoted(c)) for c in encoded.columns]).alias("doc"), F.col(quoted(ids)).alias("ids"))
    done = rows.mapInArrow(lambda batches: decode(batches, labels), f"doc {rows.schema['doc'].dataType.simpleString()}, decoded string")
    return done.select(*[F.col("doc")[c].alias(c) for c in encoded.columns], "decoded")


def decode(batches, given: Given):
    labels = kept("labels", given, lambda value: value)
    for batch in batches:
        out = []
        for raw in batch.column("ids").to_pylist():
            ids = np.frombuffer(raw or b"", "<u4").tolist()
            try:
                text = b"".join(map(labels.__getitem__, ids))
            except IndexError:
                text = b"".join(labels[i] for i in ids if i < len(labels))
            out.append(text.decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(out, pa.string())], ["doc", "decoded"])
    trim()
