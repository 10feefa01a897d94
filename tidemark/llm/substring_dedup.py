"""Substring dedup: remove words covered by repeated fixed-length word windows.

Every window of ``size`` consecutive words of one document gets a
Rabin-Karp hash.  Documents are dealt into blocks; each block sends the
distinct hashes of its windows, with a bit for "twice in this block
already", to hash-range buckets, where they are counted over all blocks;
the counts come back as one bit per hash that was sent.  So a window
that a third of all documents share is one row per block, and no
document ever meets another.  Repeated windows merge into maximal
removal intervals.

Nulls and texts without words: nothing to remove.  Rows repeated in the
input are occurrences like any other.  Ties don't matter: all
occurrences go.  An empty table gives an empty result.  Other input
columns come back untouched inside ``row``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import BLOCK_BYTES, block_count, blocks, field, packed, result, texts, trimmed
from tidemark.llm.hashing import Spans, Words, chunks, covered, mix, white_space

SIZE = 35
MESSAGES = "block int, bucket int, body binary"


def dedup_substrings(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE,
                     carry: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: ``row`` (carried columns), ``n_words``, ``n_removed``, ``spans``
    (removed word ranges [start, end)) and ``kept`` (kept words joined by one space)."""
    n = block_count(docs, text, block_bytes)
    given = packed(docs, key, text, carry)
    out = result(given, "n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept string")
    dealt = blocks(given, n)
    sent = dealt.groupBy("block").applyInArrow(trimmed(lambda t: send(t, size, n)), MESSAGES)
    repeated = sent.groupBy("bucket").applyInArrow(trimmed(lambda t: count(t)), MESSAGES)
    return dealt.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(
        trimmed(lambda t, answers: cut(t, answers, size, n)), out)


def windows(docs: list[bytes], size: int):
    """Per chunk of documents: its first document, its words, where windows start and their hashes (lowest bit 0)."""
    is_word = ~white_space()
    for lo, hi in chunks(docs):
        words = Words(docs[lo:hi], is_word)
        at = words.windows(size)
        hashes = mix(Spans(words.hashes()).fixed(size)[at]) if len(at) else np.zeros(0, np.uint64)
        yield lo, words, at, hashes & ~np.uint64(1)


def distinct(docs: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    return distinct_flags(np.concatenate([np.zeros(0, np.uint64), *[h for _, _, _, h in windows(docs, size)]]))


def distinct_flags(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, sorted, and whether each occurs more than once."""
    every = np.sort(values)
    new = np.ones(len(every), bool)
    new[1:] = every[1:] != every[:-1]
    first = np.flatnonzero(new)
    return every[first], np.diff(first, append=len(every)) > 1


def limits(n: int) -> np.ndarray:
    """Lower hash bounds of n equal hash ranges."""
    return np.array([(i << 64) // n for i in range(n)], np.uint64)


def pack(sorted_hashes: np.ndarray) -> bytes:
    """Differences of sorted hashes, byte plane by byte plane: the upper planes are mostly zero and compress."""
    gaps = np.diff(sorted_hashes, prepend=np.uint64(0))
    return gaps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(body: bytes) -> np.ndarray:
    planes = np.frombuffer(body, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def messages(block: list[int], bucket: list[int], body: list[bytes]) -> pa.Table:
    return pa.table({"block": pa.array(block, pa.int32()), "bucket": pa.array(bucket, pa.int32()), "body": pa.array(body, pa.binary())})


def send(table: pa.Table, size: int, n: int) -> pa.Table:
    """The distinct hashes of a block by bucket; the lowest bit says that the block has the window twice."""
    if not table.num_rows:
        return messages([], [], [])
    hashes, twice = distinct(texts(table), size)
    cuts = np.append(np.searchsorted(hashes, limits(n)), len(hashes))
    hashes |= twice.astype(np.uint64)
    used = np.flatnonzero(np.diff(cuts))
    block = table.column("block")[0].as_py()
    return messages([block] * len(used), used.tolist(), [pack(hashes[cuts[b]:cuts[b + 1]]) for b in used])


def count(table: pa.Table) -> pa.Table:
    """For each message of a bucket, a bit per hash: it occurs at least twice over all blocks."""
    if not table.num_rows:
        return messages([], [], [])
    parts = [unpack(b) for b in table.column("body").to_pylist()]
    every = np.concatenate(parts)
    twice = (every & np.uint64(1)).astype(bool)
    every &= ~np.uint64(1)
    by = np.sort(every)
    many = np.unique(np.concatenate([by[1:][by[1:] == by[:-1]], every[twice]]))
    bits = member(every, many)
    ends = np.cumsum([len(p) for p in parts])
    body = [np.packbits(x).tobytes() for x in np.split(bits, ends[:-1])]
    return messages(table.column("block").to_pylist(), table.column("bucket").to_pylist(), body)


def member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array ``among``."""
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.searchsorted(among, values)
    at[at == len(among)] = 0
    return among[at] == values


def cut(table: pa.Table, answers: pa.Table, size: int, n: int) -> pa.Table:
    """Remove what repeated windows cover, document by document."""
    docs = texts(table)
    hashes, _ = distinct(docs, size)
    cuts = np.append(np.searchsorted(hashes, limits(n)), len(hashes))
    many = np.zeros(len(hashes), bool)
    for bucket, body in zip(answers.column("bucket").to_pylist(), answers.column("body").to_pylist(), strict=True):
        a, b = cuts[bucket], cuts[bucket + 1]
        many[a:b] = np.unpackbits(np.frombuffer(body, np.uint8), count=b - a)
    repeated = hashes[many]
    n_words, n_removed, spans, kept = [], [], [], []
    for _, words, at, own in windows(docs, size):
        hit = at[member(own, repeated)]
        gone = covered(len(words.start), hit, hit + size)
        out = words.data.copy()
        out[white_space()[out]] = 0x20
        stay = ~gone
        depth = np.zeros(len(out) + 1, np.int8)
        depth[words.start[stay]] += 1
        depth[words.end[stay] + 1] -= 1  # with the space after the word; the next word starts later or there
        mask = np.cumsum(depth[:-1], dtype=np.int8) > 0
        for d in range(len(words.offsets) - 1):
            lo, hi = words.first[d], words.first[d + 1]
            a, b = words.offsets[d], words.offsets[d + 1]
            mine = gone[lo:hi]
            n_words.append(int(hi - lo))
            n_removed.append(int(mine.sum()))
            kept.append(out[a:b][mask[a:b]].tobytes()[:-1].decode())
            if n_removed[-1]:
                edge = np.flatnonzero(np.diff(mine, prepend=False, append=False)).tolist()
                spans.append([{"start": s, "end": e} for s, e in zip(edge[0::2], edge[1::2], strict=True)])
            else:
                spans.append([])
    return pa.table({"row": field(table, "row"), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                     "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     "kept": pa.array(kept, pa.string())})
