"""Packing by power-of-two decomposition.

A document's ids (an end id after them) are cut from left to right into
pieces of ``longest`` ids and then into pieces of falling powers of two,
one for each bit of the remainder.  Each piece is a sequence of its own:
no sequence crosses documents, and none is padded.  Pieces of equal
length form a bucket, so that a batch has one shape.

A sequence's number is made of its bucket, its task and its place among
the task's pieces of that length: in the order of the numbers, buckets
follow each other, longest first.  So packing is one pass over the texts
without a shuffle; numbers are unique, with gaps between tasks.  Write
the result with ``partitionBy("length")`` to have a folder per bucket.

Null texts are empty: one piece, the end id.  Repeated rows are documents
of their own.  An empty table gives an empty result.  Other input columns
come back inside ``row``.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.bpe import encoded, shared_tokenizer
from tidemark.llm.common import field, packed, result

LONGEST = 1024


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", longest: int = LONGEST,
                   tokenizer: str | None = None, carry: list[str] | None = None, with_ids: bool = True) -> DataFrame:
    """One row per piece: ``row`` (carried columns), ``start`` (its document's ids before it), ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` and, if asked for, ``ids``."""
    if longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    given = packed(docs, key, text, carry)
    shared = shared_tokenizer(docs.sparkSession, tokenizer)
    columns = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    return given.mapInArrow(lambda batches: cut(batches, shared.value, longest, with_ids), result(given, columns))


def first_number(length: int, longest: int, task: int) -> int:
    """The number of a task's first piece of that length: four bits or more of bucket, 24 of task, 32 of place."""
    return (longest.bit_length() - length.bit_length()) << 56 | task << 32


def lengths(tokens: int, longest: int) -> list[int]:
    rest = tokens % longest
    return [longest] * (tokens // longest) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def cut(batches, description: str, longest: int, with_ids: bool):
    task, numbers = TaskContext.get().partitionId(), Counter()
    known: dict[int, list[int]] = {}
    for batch, first, ids, many in encoded(batches, description):
        sizes = [known.get(n) or known.setdefault(n, lengths(n, longest)) for n in many.tolist()]
        pieces = np.array([len(s) for s in sizes], np.int64)
        length = np.array([n for s in sizes for n in s], np.int64)
        doc = np.repeat(np.arange(len(many)), pieces)
        at = np.cumsum(length) - length
        raw = memoryview(ids.astype("<u4").tobytes())
        crc = [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
        number = np.zeros(len(length), np.int64)
        for n in np.unique(length).tolist():
            mine = length == n
            number[mine] = first_number(n, longest, task) + numbers[n] + np.arange(mine.sum())
            numbers[n] += int(mine.sum())
        columns = [field(batch, "row").take(pa.array(first + doc)), pa.array(at - (np.cumsum(many) - many)[doc]), pa.array(length),
                   pa.array(crc, pa.int64()), pa.array(many[doc]), pa.array(number), pa.array(np.zeros(len(doc), np.int64))]
        names = ["row", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        if with_ids:
            offsets = pa.array(np.append(at, len(ids)).astype(np.int32))
            columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(columns, names)
