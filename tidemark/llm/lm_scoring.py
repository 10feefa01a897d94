"""Cross-entropy difference: score documents by two matched bigram models.

The target model counts the documents whose label says so, the background
model counts all documents.  Both have the same vocabulary (every word of
all documents, however rare, unless a caller bounds it), order and
smoothing: a bigram's probability is its relative frequency with ``MU``
pseudo-counts of the unigram distribution, which has one pseudo-count for
each word.  Unknown words and the ends of documents are words of the
vocabulary.  A document is scored by what the others hold: its own counts
are taken out of the models that it is in.  A document's score is the mean over its tokens of the
target's loss minus the background's: below zero, it resembles the target
more than the rest.

Documents are dealt into blocks.  A block sends the distinct events
(bigrams and unigrams) of its documents with their counts in both models
to hash-range buckets, which add them up over all blocks and send the
sums back: each block gets exactly the part of the models that its
documents need, and no table of all words or n-grams is ever broadcast or
joined.  Words are known by 64-bit hashes and numbered inside a block.
Every bucket also counts the distinct words that it has, and tells every
block: the sum is the size of the vocabulary, which smoothing needs.
Only a vocabulary that a caller bounds is broadcast.

Null texts are empty: one token, the end.  Labels of other documents, null
ids, and repeated labels change nothing.  Repeated documents count as
often as they occur.  Empty tables: without target documents the target
model is uniform; without documents the result is empty.  Other input
columns come back inside ``row``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BLOCK_BYTES, block_count, blocks, checkpointed, field, packed, result, share, texts, trimmed
from tidemark.llm.hashing import BASE, Words, chunks, mix, white_space
from tidemark.llm.substring_dedup import MESSAGES, limits, messages, pack, unpack

VOCABULARY = math.inf  # no bound
MU = 8.0
SPECIAL = mix(np.arange(1, 4, dtype=np.uint64))  # stand for unknown words, ends and starts beside the words' hashes


def score_documents(docs: DataFrame, target_ids: DataFrame, key: str = "doc_id", text: str = "text", carry: list[str] | None = None,
                    vocabulary: float = VOCABULARY, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: ``row`` (carried columns), ``n_tokens`` (its words and the end), ``loss_target``,
    ``loss_background`` (nats per token) and ``score``.  ``target_ids`` has the target documents' ids in its first column.
    With a finite ``vocabulary``, only so many of the most frequent words are told apart."""
    n = block_count(docs, text, block_bytes)
    given = packed(docs, key, text, carry)
    kept = share(docs.sparkSession, None if vocabulary == math.inf else common_words(given, vocabulary))
    dealt = blocks(given, n)
    target = target_ids.select(F.col(target_ids.columns[0]).cast("long").alias("id")).filter("id IS NOT NULL").distinct()
    target = target.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
    sent = dealt.groupBy("block").cogroup(target.groupBy("block")).applyInArrow(trimmed(lambda t, ids: send(t, ids, kept(), n)), MESSAGES)
    summed = sent.groupBy("bucket").applyInArrow(trimmed(lambda t: add(t, n)), MESSAGES)
    out = result(given, "n_tokens long, loss_target double, loss_background double, score double")
    return dealt.groupBy("block").cogroup(summed.groupBy("block")).applyInArrow(trimmed(lambda t, answers: score(t, answers, kept(), n)), out)


def common_words(given: DataFrame, vocabulary: int) -> np.ndarray:
    """Sorted hashes of the words with the highest counts over all documents; words of equal count are in or out together."""
    counts = checkpointed(given.mapInArrow(word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    total, least = 0, None
    for row in counts.groupBy("n").count().orderBy(F.desc("n")).limit(vocabulary).toLocalIterator():  # a row per count, as few as needed
        total += row["count"]
        if total > vocabulary:
            break
        least = row["n"]
    if least is None:
        return np.zeros(0, np.uint64)
    return np.sort(counts.filter(F.col("n") >= least).select("word").toArrow().column("word").to_numpy().view(np.uint64))


def word_counts(batches):
    for batch in batches:
        docs = texts(batch)
        every = [np.zeros(0, np.uint64), *[Words([d.lower() for d in docs[a:b]], ~white_space()).hashes() for a, b in chunks(docs)]]
        word, n = np.unique(np.concatenate(every), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], ["word", "n"])


class Chunk:
    """Some documents as word numbers (the block's words, then unknown, end and start), and their distinct bigrams."""

    def __init__(self, first: int, own: np.ndarray, distinct: np.ndarray, word: np.ndarray, words: np.ndarray):
        unknown, end, start = len(words), len(words) + 1, len(words) + 2
        at = np.minimum(np.searchsorted(words, distinct), max(0, len(words) - 1))
        number = np.where(words[at] == distinct, at, unknown) if len(words) else np.full(len(distinct), unknown)
        self.first_doc = first
        self.many = own + 1  # tokens per document, with its end
        self.starts = np.cumsum(self.many) - self.many
        self.doc = np.repeat(np.arange(len(own)), self.many)
        self.token = np.full(len(word) + len(own), end, np.int64)
        self.token[np.arange(len(word)) + np.repeat(np.arange(len(own)), own)] = number[word]
        before = np.concatenate([[start], self.token[:-1]])
        before[self.starts] = start
        value = np.concatenate([words, SPECIAL])
        self.pairs, self.pair = np.unique(mix(value[before] * np.uint64(BASE) + value[self.token]) & ~np.uint64(1), return_inverse=True)

    def previous(self, values: np.ndarray, at_start) -> np.ndarray:
        """The value of each token's predecessor; at a document's start, ``at_start``."""
        out = np.concatenate([values[:1], values[:-1]])
        out[self.starts] = at_start
        return out

    def in_document(self, event: np.ndarray, events: int) -> np.ndarray:
        """How often a token's event occurs in its document."""
        _, at, many = np.unique(self.doc * events + event, return_inverse=True, return_counts=True)
        return many[at]


def read(docs: list[bytes], kept: np.ndarray | None) -> tuple[list[Chunk], np.ndarray]:
    """Documents in chunks, and the sorted hashes of their distinct words (of those in ``kept``, if given)."""
    found = []
    for a, b in chunks(docs):
        split = Words([d.lower() for d in docs[a:b]], ~white_space())
        found.append((a, np.diff(split.first), *np.unique(split.hashes(), return_inverse=True)))
    words = np.unique(np.concatenate([np.zeros(0, np.uint64), *[distinct for _, _, distinct, _ in found]]))
    if kept is not None:
        words = words[np.isin(words, kept)]
    return [Chunk(*part, words) for part in found], words


def unigram_events(words: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Events of word numbers; that of the start stands for all tokens together.  Those of words, and no others, are odd."""
    found = mix(np.concatenate([words, SPECIAL])[numbers] + np.uint64(1))
    return np.where(numbers < len(words), found | np.uint64(1), found & ~np.uint64(1))


def events(found: list[Chunk], words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct events of some documents, sorted; and of those, places and numbers of the unigrams."""
    seen = np.zeros(len(words) + 3, bool)
    seen[-1] = True
    for c in found:
        seen[c.token] = True
    numbers = np.flatnonzero(seen)
    single = unigram_events(words, numbers)
    known = np.unique(np.concatenate([single, *[c.pairs for c in found]]))
    return known, np.searchsorted(known, single), numbers


def planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(body: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(body, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def send(table: pa.Table, ids: pa.Table, kept: np.ndarray | None, n: int) -> pa.Table:
    """The distinct events of a block with their counts in the target and in all documents.  Every bucket gets a
    message, if only an empty one, so that it answers with its number of words."""
    if not table.num_rows:
        return messages([], [], [])
    docs = texts(table)
    own = field(table, "id").fill_null(0).to_numpy(zero_copy_only=False)
    wanted = np.isin(own, ids.column("id").to_numpy()) & field(table, "id").is_valid().to_numpy(zero_copy_only=False)
    found, words = read(docs, kept)
    known, single, numbers = events(found, words)
    counts, ones = np.zeros((2, len(known)), np.int64), np.zeros((2, len(words) + 3), np.int64)
    for c in found:
        mine = wanted[c.first_doc:c.first_doc + len(c.many)][c.doc]
        at = np.searchsorted(known, c.pairs)
        for k, rows in enumerate((mine, slice(None))):
            counts[k, at] += np.bincount(c.pair[rows], minlength=len(c.pairs))
            ones[k] += np.bincount(c.token[rows], minlength=len(words) + 3)
    ones[:, -1] = ones.sum(axis=1)
    counts[:, single] = ones[:, numbers]
    cuts = np.append(np.searchsorted(known, limits(n)), len(known))
    body = [pack(known[cuts[b]:cuts[b + 1]]) + planes(counts[0, cuts[b]:cuts[b + 1]].astype(np.uint32)) +
            planes(counts[1, cuts[b]:cuts[b + 1]].astype(np.uint32)) for b in range(n)]
    number = table.column("block")[0].as_py()  # to itself, the block sends which of its documents are targets
    return messages([number] * (n + 1), [*range(n), n + number], [*body, np.unique(own[wanted]).astype(np.int64).tobytes()])


def add(table: pa.Table, n: int) -> pa.Table:
    """The bucket's number of distinct words, and the sums over all blocks, sent back to each block for its events.
    What a block sends to itself stays as it is."""
    if not table.num_rows or table.column("bucket")[0].as_py() >= n:
        return table.select(["block", "bucket", "body"])
    bodies = table.column("body").to_pylist()
    sizes = [len(b) // 16 for b in bodies]
    known, at = np.unique(np.concatenate([unpack(b[:8 * s]) for b, s in zip(bodies, sizes, strict=True)]), return_inverse=True)
    sums = []
    for lo in (8, 12):
        part = np.concatenate([from_planes(b[lo * s:(lo + 4) * s], np.uint32) for b, s in zip(bodies, sizes, strict=True)])
        total = np.zeros(len(known), np.uint64)
        np.add.at(total, at, part.astype(np.uint64))
        sums.append(total[at])
    ends = np.cumsum(sizes)[:-1]
    many = np.int64(np.count_nonzero(known & np.uint64(1))).tobytes()
    body = [many + planes(t) + planes(b) for t, b in zip(np.split(sums[0], ends), np.split(sums[1], ends), strict=True)]
    return messages(table.column("block").to_pylist(), table.column("bucket").to_pylist(), body)


def score(table: pa.Table, answers: pa.Table, kept: np.ndarray | None, n: int) -> pa.Table:
    docs = texts(table)
    found, words = read(docs, kept)
    known, single, numbers = events(found, words)
    cuts = np.append(np.searchsorted(known, limits(n)), len(known))
    counts = np.zeros((2, len(known)))
    targets = np.zeros(0, np.int64)
    vocabulary = 2  # unknown and end, and every bucket's words
    for bucket, body in zip(answers.column("bucket").to_pylist(), answers.column("body").to_pylist(), strict=True):
        if bucket >= n:
            targets = np.frombuffer(body, np.int64)
            continue
        vocabulary += int(np.frombuffer(body, np.int64, 1)[0])
        for k, half in enumerate((body[8:4 + len(body) // 2], body[4 + len(body) // 2:])):
            counts[k, cuts[bucket]:cuts[bucket + 1]] = from_planes(half, np.uint64)
    ones = np.zeros((2, len(words) + 3))
    ones[:, numbers] = counts[:, single]
    ids = field(table, "id")
    member = np.isin(ids.fill_null(0).to_numpy(zero_copy_only=False), targets) & ids.is_valid().to_numpy(zero_copy_only=False)
    n_tokens, losses = [], [[], []]
    width, end = len(words) + 3, len(words) + 1
    for c in found:
        at = np.searchsorted(known, c.pairs)
        own_pair, own_word = c.in_document(c.pair, len(c.pairs)), c.in_document(c.token, width)
        own_context = c.previous(own_word, 1)  # a token is a context once; the start is, once a document, like the end
        for k, inside in enumerate((member[c.first_doc:c.first_doc + len(c.many)], np.ones(len(c.many), bool))):
            mine = inside[c.doc]
            word = ones[k][c.token] - mine * own_word
            pair = counts[k][at][c.pair] - mine * own_pair
            context = c.previous(ones[k][c.token], ones[k][end]) - mine * own_context
            unigram = (word + 1) / (ones[k][-1] - mine * c.many[c.doc] + vocabulary)
            loss = -np.log((pair + MU * unigram) / (context + MU))
            losses[k].append(np.add.reduceat(loss, c.starts) / c.many)
        n_tokens.append(c.many)
    target, background = (np.concatenate([np.zeros(0), *x]) for x in losses)
    return pa.table({"row": field(table, "row"), "n_tokens": pa.array(np.concatenate([np.zeros(0, np.int64), *n_tokens])),
                     "loss_target": target, "loss_background": background, "score": target - background})

