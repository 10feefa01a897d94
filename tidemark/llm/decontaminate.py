"""Benchmark decontamination by winnowing.

A training word is hit if it lies in an occurrence of a benchmark
window: ``size`` consecutive words of one item, or the whole item if it
has fewer.  Both sides keep, of every ``size - GRAM + 1`` consecutive
hashes of ``GRAM`` words, the least (the last of equals): a shared window
has the same hashes on both sides, so at least one fingerprint of it is
kept on both.  Fingerprints that both sides have are extended word by
word in both directions, at most to the window's length, and count if
the common span is long enough.  An item shorter than a window is
fingerprinted whole, and so are all spans of its length.

Equal item texts are one.  The benchmark is cut into parts of about
``part_bytes`` of distinct texts and ids; each is broadcast, and the
documents pass one part after the other, written between two, so that
a worker holds one part at a time whatever the benchmark's size.  No
shuffle of documents.  Places of common fingerprints are compared in
slices of ``PAIRS``.

Null texts have no words; items without words have no window.  Items
with a null id hit words but are not listed.  Repeated rows and items are
treated each on its own; equal item ids count once.  Empty tables on
either side give no hits.  Other input columns come back untouched inside
``row``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import field, materialize, packed, quoted, share, texts
from tidemark.llm.hashing import Spans, Words, chunks, covered, mix, ranges

SIZE = 13
GRAM = 5
PART_BYTES = 16 << 20
PAIRS = 1 << 20
FOUND = "array<struct<start:long,end:long>>"


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text", size: int = SIZE, carry: list[str] | None = None,
                  part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per input row: ``row`` (carried columns), ``text``, ``n_words``, ``n_hit``, ``spans`` (hit word
    ranges [start, end)), ``items`` (ids of items with occurring windows, as sorted strings) and
    ``contaminated``: at least a twentieth of the words is hit."""
    items = benchmark.select(F.col(quoted(item)).cast("string").alias("id"), F.col(quoted(item_text)).cast("string").alias("text"))
    items = items.filter("text IS NOT NULL").groupBy("text").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    size_of = F.octet_length("text") + F.octet_length(F.array_join("ids", ","))
    n = max(1, math.ceil((items.agg(F.sum(size_of)).first()[0] or 0) / part_bytes))
    given = packed(docs, key, text, carry)
    found = given.withColumns({"spans": F.array().cast(FOUND), "items": F.array().cast("array<string>"), "n_words": F.lit(0).cast("long")})
    schema = T.StructType([given.schema["doc"], *T.StructType.fromDDL(f"spans {FOUND}, items array<string>, n_words long").fields])
    for part in range(n):
        # about part_bytes, give or take what chance deals to a part
        mine = items.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == part).collect()
        index = share(docs.sparkSession, Index([r.ids for r in mine], [r.text.encode() for r in mine], size))
        found = found.mapInArrow(lambda batches, index=index: search(batches, index()), schema)
        if part < n - 1:
            found = materialize(found, "decontaminated")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select("doc.row", "doc.text", "n_words", hit.alias("n_hit"), "spans", F.sort_array("items").alias("items")).withColumn(
        "contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def word_bytes() -> np.ndarray:
    """Byte table of 0-9, A-Z, a-z and all non-ASCII bytes."""
    table = np.zeros(256, bool)
    table[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
    return table


def word_hashes(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all documents, and the number of words before each document."""
    words = Words([d.lower() for d in docs], word_bytes())  # bytes.lower changes A-Z only
    return words.hashes(), words.first


def kept(grams: np.ndarray, lo: np.ndarray, hi: np.ndarray, window: int) -> np.ndarray:
    """Winnowing: places of the least hash of every ``window`` consecutive ones inside [lo, hi), the last of equals."""
    n = len(grams)
    starts = ranges(lo, np.maximum(hi - lo - window + 1, 0))
    if not len(starts):
        return starts
    place = np.uint64(n - 1) - np.arange(n, dtype=np.uint64)  # falls, so that the least value is the last of equal hashes
    least = grams & ~np.uint64(0xFFFFFFFF) | place
    step = 1
    while 2 * step <= window:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < window:
        least = np.minimum(least[:step - window], least[window - step:])
    at = n - 1 - (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return np.unique(at)


class Index:
    """Fingerprints of some benchmark items, and their words' hashes."""

    def __init__(self, ids: list[list[str]], items: list[bytes], size: int):
        self.ids, self.size = ids, size
        self.words, self.first = word_hashes(items)
        n = np.diff(self.first)
        long = n >= size
        sums = Spans(self.words)
        grams = mix(sums.fixed(GRAM))
        at = kept(grams, self.first[:-1][long], self.first[1:][long] - GRAM + 1, size - GRAM + 1)
        self.long = Postings(grams[at], at)
        self.short = {}
        for length in np.unique(n[(n > 0) & ~long]).tolist():
            at = self.first[:-1][n == length]
            self.short[length] = Postings(sums.hash(at, at + length), at)
        self.item = np.repeat(np.arange(len(n)), n)


class Postings:
    """Places by hash."""

    def __init__(self, hashes: np.ndarray, places: np.ndarray):
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.first, self.many = np.unique(hashes[order], return_index=True, return_counts=True)
        self.places = places[order]

    def join(self, hashes: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All (place here, place there) with equal hashes, about PAIRS at a time."""
        if not len(self.hashes):
            return
        row = np.searchsorted(self.hashes, hashes)
        row[row == len(self.hashes)] = 0
        same = self.hashes[row] == hashes
        row, at = row[same], at[same]
        slice_of = np.cumsum(self.many[row]) // PAIRS
        edges = [*np.flatnonzero(np.diff(slice_of, prepend=-1)).tolist(), len(row)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield np.repeat(at[a:b], self.many[row[a:b]]), self.places[ranges(self.first[row[a:b]], self.many[row[a:b]])]


def extended(words: np.ndarray, lo: np.ndarray, hi: np.ndarray, at: np.ndarray, index: Index, there: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grow equal grams to both sides by up to size - GRAM words; those of at least ``size`` words: (start, end, item)."""
    item = index.item[there]
    low, high = index.first[item], index.first[item + 1]
    left, right = np.zeros(len(at), np.int64), np.full(len(at), GRAM)
    same = np.ones(len(at), bool)
    for k in range(GRAM):  # the gram itself, word by word
        same &= words[at + k] == index.words[there + k]
    growing = same.copy()
    for k in range(1, index.size - GRAM + 1):
        growing &= (at - k >= lo) & (there - k >= low)
        growing[growing] = words[at[growing] - k] == index.words[there[growing] - k]
        left += growing
    growing = same.copy()
    for k in range(GRAM, index.size):
        growing &= (at + k < hi) & (there + k < high)
        growing[growing] = words[at[growing] + k] == index.words[there[growing] + k]
        right += growing
    enough = same & (left + right >= index.size)
    return (at - left)[enough], (at + right)[enough], item[enough]


def hits(docs: list[bytes], index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words before each document, and start, end, document and item of the hit spans."""
    words, first = word_hashes(docs)
    n = np.diff(first)
    doc = np.repeat(np.arange(len(docs)), n)
    sums = Spans(words)
    start, end, item = [], [], []
    if len(index.long.hashes):
        grams = mix(sums.fixed(GRAM))
        at = kept(grams, first[:-1], first[1:] - GRAM + 1, index.size - GRAM + 1)
        for here, there in index.long.join(grams[at], at):
            found = extended(words, first[doc[here]], first[doc[here] + 1], here, index, there)
            for out, x in zip((start, end, item), found, strict=True):
                out.append(x)
    for length, postings in index.short.items():
        at = ranges(first[:-1], np.maximum(n - length + 1, 0))
        for here, there in postings.join(sums.hash(at, at + length), at):
            start.append(here)
            end.append(here + length)
            item.append(index.item[there])
    start, end, item = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (start, end, item))
    return first, start, end, doc[start], item


def search(batches, index: Index):
    for batch in batches:
        docs = texts(batch)
        old_spans, old_items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
        n_words, spans, items = [], [], []
        for a, b in chunks(docs):
            first, start, end, doc, item = hits(docs[a:b], index)
            n_words += np.diff(first).tolist()
            order = np.argsort(doc, kind="stable")
            edges = np.searchsorted(doc[order], np.arange(b - a + 1))
            for d in range(b - a):
                mine = order[edges[d]:edges[d + 1]]
                if not len(mine):
                    spans.append(old_spans[a + d])
                    items.append(old_items[a + d])
                    continue
                lo = first[d]
                was = old_spans[a + d]
                s = np.concatenate([start[mine] - lo, np.array([x["start"] for x in was], np.int64)])
                e = np.concatenate([end[mine] - lo, np.array([x["end"] for x in was], np.int64)])
                edge = np.flatnonzero(np.diff(covered(int(first[d + 1] - lo), s, e), prepend=False, append=False)).tolist()
                spans.append([{"start": x, "end": y} for x, y in zip(edge[0::2], edge[1::2], strict=True)])
                items.append(sorted({x for i in np.unique(item[mine]) for x in index.ids[i]} | set(old_items[a + d])))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
             pa.array(items, pa.list_(pa.string())), pa.array(n_words, pa.int64())], ["doc", "spans", "items", "n_words"])
