"""Token-id files with Elias-Fano document boundaries.

Documents are dealt by ascending id into shards (range partitions,
sorted inside); each task encodes its documents and writes one file:

    magic "TKEF0001"
    ids         all ids, an end id after each document, unsigned little-endian, 2 bytes
                each if the vocabulary allows, else 4
    boundaries  Elias-Fano code of the documents' ends (ids up to and with the end id)
    documents   Elias-Fano code of the document ids less the least one
    footer      JSON: counts, widths, and each section's place
    8 bytes     the footer's length

An Elias-Fano code keeps n non-decreasing numbers below u in about
2 + log2(u / n) bits each: the lower bits side by side, the upper bits as
gaps in unary, with the place of every ``STEP``-th one, so that the i-th
number is found by a short scan (select) and the file needs no table of
64-bit offsets.

A task writes under a name of its own and renames the finished file, so
a lost or repeated task leaves no half file behind that counts: the
manifest lists the files whose tasks succeeded.  Null ids come first and
are counted in the footer.  Null texts are empty (the end id only).
Equal ids keep to one or more shards, ordered by a hash of their text.
An empty table gives an empty manifest.
"""

from __future__ import annotations

import json
import uuid
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import encoded, encoder, shared_tokenizer
from tidemark.llm.common import block_count, field, packed

MAGIC = b"TKEF0001"
STEP = 256
SHARD_BYTES = 128 << 20  # text bytes of a shard


class EliasFano:
    """Non-decreasing numbers >= 0."""

    def __init__(self, n: int, shift: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.shift, self.low, self.high, self.samples = n, shift, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        bound = int(values[-1]) + 1 if n else 1
        shift = max(0, (bound // max(1, n)).bit_length() - 1)
        bits = (values[:, None] >> np.arange(shift, dtype=np.uint64) & np.uint64(1)).astype(np.uint8)
        low = np.packbits(bits.ravel(), bitorder="little")
        ones = (values >> np.uint64(shift)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(ones[-1]) // 8 + 1) if n else 0, np.uint8)
        np.bitwise_or.at(high, ones // 8, (1 << (ones % 8)).astype(np.uint8))
        return cls(n, shift, low, high, ones[::STEP].astype(np.uint64))

    def place(self, i: int) -> int:
        """Where the i-th one of the upper bits is, by the sample before it and a scan of about STEP gaps."""
        place = int(self.samples[i // STEP])
        left = i % STEP
        byte = place // 8
        word = int(self.high[byte]) >> (place % 8) << (place % 8)
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        return 8 * byte + (word & -word).bit_length() - 1

    def select(self, i: int) -> int:
        """The i-th number."""
        one = self.place(i)
        at, low = i * self.shift, 0
        for k in range(self.shift):
            low |= (int(self.low[(at + k) // 8]) >> ((at + k) % 8) & 1) << k
        return (one - i) << self.shift | low

    def part(self, lo: int, hi: int) -> np.ndarray:
        """The numbers from the lo-th to before the hi-th: the bits between two selected places."""
        if lo >= hi:
            return np.zeros(0, np.uint64)
        first = self.place(lo) // 8
        bits = np.unpackbits(self.high[first:self.place(hi - 1) // 8 + 1], bitorder="little")
        ones = np.flatnonzero(bits) + 8 * first
        before = int(np.unpackbits(self.high[first:first + 1], bitorder="little")[:self.place(lo) - 8 * first].sum())
        values = (ones[before:before + hi - lo] - np.arange(lo, hi)).astype(np.uint64) << np.uint64(self.shift)
        start, end = lo * self.shift, hi * self.shift
        low = np.unpackbits(self.low[start // 8:-(-end // 8)], bitorder="little")[start % 8:start % 8 + end - start]
        low = low.reshape(hi - lo, self.shift).astype(np.uint64)
        return values + (low << np.arange(self.shift, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def all(self) -> np.ndarray:
        return self.part(0, self.n)

    def write(self, out, at: int) -> dict:
        parts = [self.low.tobytes(), self.high.tobytes(), self.samples.astype("<u8").tobytes()]
        for p in parts:
            out.write(p)
        return {"n": self.n, "shift": self.shift, "at": at, "sizes": [len(p) for p in parts]}

    @classmethod
    def read(cls, source, about: dict) -> EliasFano:
        source.seek(about["at"])
        low, high, samples = (source.read(n) for n in about["sizes"])
        return cls(about["n"], about["shift"], np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8), np.frombuffer(samples, "<u8"))


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def write_token_files(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", tokenizer: str | None = None,
                      shard_bytes: int = SHARD_BYTES) -> list[dict]:
    """Write the shards and ``manifest.json`` into the new folder ``path`` (shared by all executors); returns the manifest:
    the files in ascending order of ids, with their counts and the ids of all files before them."""
    spark = docs.sparkSession
    given = packed(docs, key, text, [])
    n = block_count(docs, text, shard_bytes)
    store, root = opened(path)
    store.create_dir(root)
    shared = shared_tokenizer(spark, tokenizer)
    order = [F.col("doc.id"), F.xxhash64("doc.text")]
    dealt = given.repartitionByRange(n, *order).sortWithinPartitions(*order)
    written = dealt.mapInArrow(lambda batches: write_shard(batches, path, shared.value), "shard int, file string, docs long, tokens long").collect()
    manifest, before = [], 0
    for row in sorted(written, key=lambda r: r.shard):
        manifest.append({"file": row.file, "docs": row.docs, "tokens": row.tokens, "before": before})
        before += row.tokens
    with store.open_output_stream(f"{root}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def write_shard(batches, path: str, description: str):
    store, root = opened(path)
    shard = TaskContext.get().partitionId()
    name = f"shard-{shard:06d}-{uuid.uuid4().hex}"
    ids_of, many_of, out, width, tokens = [], [], None, 0, 0
    nulls = 0
    for batch, first, ids, many in encoded(batches, description):
        if out is None:
            width = 2 if encoder(description).vocabulary <= 1 << 16 else 4
            out = store.open_output_stream(f"{root}/.{name}")
            out.write(MAGIC)
        out.write(ids.astype(f"<u{width}").tobytes())
        tokens += len(ids)
        mine = field(batch, "id").slice(first, len(many))
        nulls += mine.null_count
        ids_of.append(mine.drop_null().to_numpy(zero_copy_only=False))
        many_of.append(many)
    if out is None:
        return
    many, doc_ids = np.concatenate(many_of), np.concatenate(ids_of)
    least = int(doc_ids[0]) if len(doc_ids) else 0
    at = len(MAGIC) + width * tokens
    boundaries = EliasFano.of(np.cumsum(many)).write(out, at)
    at += sum(boundaries["sizes"])
    documents = EliasFano.of((doc_ids.view(np.uint64) - np.array(least, np.int64).view(np.uint64))).write(out, at)
    footer = json.dumps({"tokens": tokens, "width": width, "nulls": nulls, "least": least, "boundaries": boundaries, "documents": documents}).encode()
    out.write(footer)
    out.write(len(footer).to_bytes(8, "little"))
    out.close()
    store.move(f"{root}/.{name}", f"{root}/{name}.tkef")
    yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "file": [f"{name}.tkef"], "docs": [len(many)], "tokens": [tokens]})


class Shard:
    """One file, read by parts: ``document(i)`` gives its id and its ids without reading the rest."""

    def __init__(self, path: str):
        store, name = opened(path)
        self.source = store.open_input_file(name)
        size = self.source.size()
        self.source.seek(size - 8)
        length = int.from_bytes(self.source.read(8), "little")
        self.source.seek(size - 8 - length)
        self.about = json.loads(self.source.read(length))
        self.boundaries = EliasFano.read(self.source, self.about["boundaries"])
        self.documents = EliasFano.read(self.source, self.about["documents"])

    def ids(self, start: int, end: int) -> np.ndarray:
        width = self.about["width"]
        self.source.seek(len(MAGIC) + width * start)
        return np.frombuffer(self.source.read(width * (end - start)), f"<u{width}")

    def document(self, i: int) -> tuple[int | None, np.ndarray]:
        start = self.boundaries.select(i - 1) if i else 0
        nulls = self.about["nulls"]
        return None if i < nulls else self.documents.select(i - nulls) + self.about["least"], self.ids(start, self.boundaries.select(i))

    def doc_ids(self, lo: int, hi: int) -> pa.Array:
        nulls = self.about["nulls"]
        found = self.documents.part(max(lo, nulls) - nulls, max(hi, nulls) - nulls)
        found = (found + np.array(self.about["least"], np.int64).view(np.uint64)).view(np.int64)
        return pa.concat_arrays([pa.nulls(hi - lo - len(found), pa.int64()), pa.array(found)])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files in ``path``: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens`` and ``ids_crc32``."""
    store, root = opened(path)
    with store.open_input_stream(f"{root}/manifest.json") as source:
        manifest = json.loads(source.read())
    rows = [(f"{path}/{m['file']}", m["before"]) for m in manifest]
    files = spark.createDataFrame(rows, "file string, before long").repartition(max(1, len(rows)))
    return files.mapInArrow(read_shards, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_shards(batches):
    for batch in batches:
        for file, before in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist(), strict=True):
            shard = Shard(file)
            lo, start, n = 0, 0, shard.boundaries.n
            while lo < n:  # some million ids at a time, whole documents; their bounds are selected
                hi = max(lo + 1, bisect_right(range(n), start + (1 << 22), lo, key=shard.boundaries.select))
                ends = shard.boundaries.part(lo, hi).astype(np.int64)
                starts = np.append(start, ends[:-1])
                raw = memoryview(shard.ids(start, int(ends[-1])).astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (a - start):4 * (b - start)]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([shard.doc_ids(lo, hi), pa.array(before + starts), pa.array(ends - starts), pa.array(crc, pa.int64())],
                                                 ["doc_id", "start", "n_tokens", "ids_crc32"])
                lo, start = hi, int(ends[-1])
