"""Phrase collocations by multikey three-way quicksort of suffixes.

1. Tasks read the texts once: pieces, words, and for each chunk of texts
   its distinct words with their counts; the word numbers of the chunk
   are kept in a table.  Words are dealt to buckets and added up there;
   those that reach the least count get a number that holds for all
   chunks.
2. A chunk gets the numbers of its own words back.  A suffix is the
   phrase of up to ``longest`` words that starts at a place; it ends
   before a rare word, of which no frequent phrase can be made.  Suffixes
   are routed by their leading words up to the first that is not hot (a
   word is hot if it occurs more than ``hot`` times), so no route takes
   more than ``hot`` suffixes.  Phrases of hot words alone have few
   distinct values: they are added up in the chunk and routed whole.
   Equal suffixes of a chunk are sent once, with their number.
3. Buckets sort pointers to their suffixes: partitions are split three
   ways by a pivot's word, smaller and larger parts go on at the same
   depth, equal parts one word deeper.  The weight of an equal part is the
   count of its phrase.  A part of less than the least count is abandoned.
4. Joins of the frequent phrases with their own parts give the scores;
   they are exact decimals.

Words are compared as strings when they are counted, and by number after
that, so counts are exact.  Null texts are empty, null languages are
``und``.  Repeated rows count each.  An empty table gives an empty
result.  Texts of any length are read whole; words never cross texts.
Extra columns are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import block_count, materialize, quoted, small_batches, trim, trimmed
from tidemark.llm.hashing import BASE, mix, ranges

LEAST = 100
LONGEST = 5
HOT = 1 << 19  # occurrences beyond which a word alone routes no suffix
CHUNK_TEXT = 16 << 20  # bytes of text that are numbered together
BUCKET = 1 << 20  # suffixes of a bucket, about
SLICE = 1 << 20  # words whose suffixes are made at a time
# What ends a piece, and what lies between words.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b" \t"


def byte_table(values: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(values)] = True
    return table


# ---------------------------------------------------------------- words
def numbered_words(batches, buckets: int):
    """For each chunk: its distinct words by bucket, with their counts and their numbers there; and the numbers of all
    words in their order, -1 where a piece ends."""
    held, size, n = [], 0, 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= CHUNK_TEXT:
            yield number(pa.Table.from_batches(held), n, buckets)
            held, size, n = [], 0, n + 1
    if held:
        yield number(pa.Table.from_batches(held), n, buckets)
    trim()


CHUNK_SCHEMA = "chunk long, bucket long, body binary, codes binary"
COUNTED_SCHEMA = "chunk long, body binary, id long, lang string, word string, f long"


def number(table: pa.Table, n: int, buckets: int) -> pa.RecordBatch:
    chunk = (TaskContext.get().partitionId() << 32) + n
    parts, sequence, known = [], [], 0
    by_lang = table.column("lang").combine_chunks()
    for lang in pc.unique(by_lang).to_pylist():
        texts = table.column("text").filter(pc.equal(by_lang, lang)).cast(pa.large_binary()).to_pylist()
        place, word = split(texts)
        found = word.dictionary_encode()
        code = found.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        m = len(found.dictionary)
        sequence.append(np.where(place < 0, -1, np.append(code, -1)[place] + known).astype(np.int32))
        seed = zlib.crc32(lang.encode())
        bucket = np.fromiter((zlib.crc32(w, seed) for w in found.dictionary.cast(pa.binary()).to_pylist()), np.int64, m) % buckets
        parts.append(pa.table({"bucket": bucket, "lang": pa.array([lang] * m, pa.string()), "word": found.dictionary,
                               "code": np.arange(known, known + m, dtype=np.int32), "n": np.bincount(code, minlength=m).astype(np.int64)}))
        known += m
    words = pa.concat_tables(parts)
    order = np.argsort(words.column("bucket").to_numpy(), kind="stable")
    words = words.take(pa.array(order))
    bucket = words.column("bucket").to_numpy()
    edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)).tolist() if known else []
    bodies = [written(words.slice(a, b - a).drop_columns("bucket")) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    whole = zstandard.ZstdCompressor(level=1).compress(np.concatenate([np.zeros(0, np.int32), *sequence]).tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(bodies) + 1, chunk)), pa.array([*(int(bucket[a]) for a in edges[:-1]), None], pa.int64()),
         pa.array([*bodies, None], pa.binary()), pa.array([None] * len(bodies) + [whole], pa.binary())], ["chunk", "bucket", "body", "codes"])


def written(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def read(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(body).read_all()


def count_words(messages: pa.Table, least: int, buckets: int) -> pa.Table:
    """A bucket's frequent words with their numbers, all its words by language (without a word), and for each message
    the numbers and counts of its frequent words."""
    out = pa.schema([("chunk", pa.int64()), ("body", pa.binary()), ("id", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("f", pa.int64())])
    if not messages.num_rows:
        return out.empty_table()
    bucket = messages.column("bucket")[0].as_py()
    tables = [read(b) for b in messages.column("body").to_pylist()]
    size = np.array([len(t) for t in tables])
    every = pa.concat_tables(tables).combine_chunks()
    number, often = np.zeros(len(every), np.int64), every.column("n").to_numpy().copy()
    known, parts = 0, []
    for lang in pc.unique(every.column("lang")).to_pylist():
        mine = np.flatnonzero(pc.equal(every.column("lang"), lang).to_numpy(zero_copy_only=False))
        found = every.column("word").take(pa.array(mine)).combine_chunks().dictionary_encode()
        code = found.indices.to_numpy(zero_copy_only=False)
        total = np.zeros(len(found.dictionary), np.int64)
        np.add.at(total, code, often[mine])
        frequent = np.flatnonzero(total >= least)
        ids = np.zeros(len(total), np.int64)
        ids[frequent] = (known + np.arange(len(frequent))) * buckets + bucket + 1
        known += len(frequent)
        number[mine], often[mine] = ids[code], total[code]
        parts.append(pa.table({"id": ids[frequent], "lang": pa.array([lang] * len(frequent), pa.string()),
                               "word": found.dictionary.take(pa.array(frequent)), "f": total[frequent]}))
        parts.append(pa.table({"lang": pa.array([lang], pa.string()), "f": np.array([total.sum()])}))
    end, answers, code = np.cumsum(size), [], every.column("code").to_numpy()
    for a, b in zip((end - size).tolist(), end.tolist(), strict=True):
        at = a + np.flatnonzero(number[a:b])
        answers.append(written(pa.table({"code": code[at], "id": number[at], "n": often[at]})))
    parts.append(pa.table({"chunk": messages.column("chunk"), "body": pa.array(answers, pa.binary())}))
    full = [pa.table([p.column(f.name).cast(f.type) if f.name in p.column_names else pa.nulls(len(p), f.type) for f in out], schema=out) for p in parts]
    return pa.concat_tables(full)


def split(texts: list[bytes | None]) -> tuple[np.ndarray, pa.Array]:
    """The words of all texts; and their numbers with a -1 between pieces that have words."""
    whole = b"\n".join([*(t or b"" for t in texts), b""]).lower()  # of bytes: A-Z only
    data = np.frombuffer(whole, np.uint8)
    ends_piece = byte_table(BREAKS)[data]
    inside = ~(ends_piece | byte_table(BLANKS)[data])
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[0::2], edge[1::2]
    piece = np.cumsum(ends_piece, dtype=np.int32)[start]
    first = np.diff(piece, prepend=-1) != 0
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=offsets[1:])
    values = data[inside].tobytes()
    word = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(values)).cast(pa.string())
    place = np.full(len(start) + int(first.sum()), -1, np.int64)
    place[np.arange(len(start)) + np.cumsum(first)] = np.arange(len(start))
    return place, word


# ---------------------------------------------------------------- suffixes
def suffixes(sequence: np.ndarray, longest: int, start: int = 0, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``sequence``: word ids, 0 where no phrase goes on.  The words of the suffix at each place from ``start`` to before
    ``end``, a row per depth, 0 after its end; and the suffixes' lengths.  Suffixes of one word are left out."""
    end = len(sequence) if end is None else end
    near = np.append(sequence[start:end + longest], np.zeros(longest, sequence.dtype))
    n = end - start
    words = np.zeros((longest, n), sequence.dtype)
    going = np.ones(n, bool)
    for k in range(longest):
        going &= near[k:k + n] != 0
        words[k, going] = near[k:k + n][going]
    words = words[:, words[1] != 0]
    return words, (words != 0).sum(axis=0)


def routes(words: np.ndarray, length: np.ndarray, is_hot: np.ndarray) -> np.ndarray:
    """How many leading words route each suffix: up to the first that is not hot; 0 if all are."""
    depth = np.zeros(len(length), np.int64)
    for k in range(len(words) - 1, -1, -1):
        depth[(k < length) & ~is_hot[words[k]]] = k + 1
    return depth


def grouped(words: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """Equal columns of ``words`` once, sorted, how often each occurs, and what else belongs to it."""
    keys = list(words)
    if words.dtype == np.int32:  # two words in a key
        keys = [(a.astype(np.int64) << 32) | b for a, b in zip(words[0::2], words[1::2], strict=False)] + list(words[2 * (len(words) // 2):])
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[1:] != k[:-1] for k in (k[order] for k in keys)], axis=0)
    first = np.flatnonzero(new)
    once = order[first]
    return words[:, once], np.diff(first, append=len(order)), *[m[once] for m in more]


def bucket_of(words: np.ndarray, depth: np.ndarray, buckets: int) -> np.ndarray:
    value = np.zeros(len(depth), np.uint64)
    for k, row in enumerate(words):
        value = np.where(k < depth, mix((value + row.astype(np.uint64) + np.uint64(1)) * np.uint64(BASE)), value)
    return (value % np.uint64(buckets)).astype(np.int64)


def packed_suffixes(words: np.ndarray, depth: np.ndarray, weight: np.ndarray) -> bytes:
    """Sorted suffixes, field by field: neighbours share their upper bytes."""
    fields = [np.diff(words[0], prepend=words.dtype.type(0)), *words[1:], depth.astype(words.dtype), weight.astype(words.dtype)]
    raw = b"".join(np.ascontiguousarray(f).view(np.uint8).reshape(-1, f.itemsize).T.tobytes() for f in fields)
    return bytes([words.itemsize]) + zstandard.ZstdCompressor(level=1).compress(raw)


def unpacked_suffixes(body: bytes, longest: int) -> np.ndarray:
    size = body[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(body[1:]), np.uint8).reshape(longest + 2, size, -1)
    rows = np.stack([np.ascontiguousarray(p.T).view(f"<i{size}").ravel() for p in planes])
    rows[0] = np.cumsum(rows[0])
    return rows


def dealt(columns: np.ndarray, length: np.ndarray, is_hot: np.ndarray, given: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Suffixes in the chunk's own numbers, equal ones added up, by bucket."""
    depth = routes(columns, length, is_hot)
    parts = [(columns[:, depth > 0], depth[depth > 0])]
    for k in range(2, len(columns) + 1):  # the phrases of hot words that suffixes start with
        mine = (length >= k) & ((depth == 0) | (depth > k))
        if mine.any():
            lead = columns[:, mine].copy()
            lead[k:] = 0
            parts.append((lead, np.full(lead.shape[1], k)))
    columns, depth = np.concatenate([p[0] for p in parts], axis=1), np.concatenate([p[1] for p in parts])
    columns, weight, depth = grouped(given[columns], depth)
    bucket = bucket_of(columns, depth, buckets)
    order = np.argsort(bucket, kind="stable")
    columns, weight, depth, bucket = columns[:, order], weight[order], depth[order], bucket[order]
    edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)).tolist()
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield int(bucket[a]), packed_suffixes(columns[:, a:b], depth[a:b], weight[a:b])


NO_WORDS = pa.table({"code": np.zeros(0, np.int32), "id": np.zeros(0, np.int64), "n": np.zeros(0, np.int64)})


def send(codes: pa.Table, answers: pa.Table, longest: int, hot: int, buckets: int) -> pa.Table:
    """A chunk's suffixes by bucket."""
    out: tuple[list, list] = [], []
    for body in codes.column("codes").to_pylist():
        code = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.int32)
        words = pa.concat_tables([NO_WORDS, *(read(a) for a in answers.column("body").to_pylist())])
        number, ids, often = (words.column(c).to_numpy() for c in ("code", "id", "n"))
        wide = np.int32 if not len(ids) or ids.max() < 2**31 else np.int64
        own = np.zeros(int(code.max(initial=-1)) + 2, wide)  # a word's place among this chunk's frequent words, by its code
        own[number] = np.arange(1, len(number) + 1)
        is_hot = np.append(False, often > hot)
        given = np.append(0, ids).astype(wide)
        sequence = own[code]
        for start in range(0, len(sequence), SLICE):
            found = suffixes(sequence, longest, start, min(start + SLICE, len(sequence)))
            for bucket, message in dealt(*found, is_hot, given, buckets):
                out[0].append(bucket)
                out[1].append(message)
    return pa.table({"bucket": pa.array(out[0], pa.int64()), "body": pa.array(out[1], pa.binary())})


# ---------------------------------------------------------------- sorting
def frequent_phrases(words: np.ndarray, depth: np.ndarray, weight: np.ndarray, least: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(k, pointers, counts) of the phrases of k words that occur ``least`` times: a suffix that starts with the phrase,
    and the weight of all that do, of those routed by no more than k words.

    Multikey three-way quicksort of the pointers.  All partitions of a depth are split at once, each by its own pivot."""
    longest = len(words)
    found = []
    pointer = np.arange(words.shape[1])
    # partitions lie one after another; `start` are their first places
    start, level = np.array([0]), np.zeros(1, np.int64)
    while len(pointer):
        size = np.diff(start, append=len(pointer))
        part = np.repeat(np.arange(len(start)), size)
        word = words[level[part], pointer]
        pivot = middle(word, start, size)
        side = np.sign(word - pivot[part]).astype(np.int64) + 1  # 0 smaller, 1 equal, 2 larger
        group = 3 * part + side
        heavy = np.bincount(group, weight[pointer], 3 * len(start)).astype(np.int64)
        # equal parts go one word deeper, those that end here (word 0) or are at the last depth no further
        equal = np.arange(1, len(heavy), 3)
        real = (heavy[equal] >= least) & (pivot > 0)
        counted = np.bincount(part, weight[pointer] * ((side == 1) & (depth[pointer] <= level[part] + 1)), len(start)).astype(np.int64)
        keep = heavy >= least
        keep[equal] = real & (level + 1 < longest)
        at = np.flatnonzero(side == 1)
        sample = np.zeros(len(start), np.int64)
        sample[part[at]] = pointer[at]
        for k in range(2, longest + 1):
            mine = real & (level + 1 == k) & (counted >= least)
            if mine.any():
                found.append((k, sample[mine], counted[mine]))
        stay = np.flatnonzero(keep[group])
        stay = stay[np.argsort(group[stay], kind="stable")]
        pointer, group = pointer[stay], group[stay]
        first = np.flatnonzero(np.diff(group, prepend=-1))
        start = first
        level = level[group[first] // 3] + (group[first] % 3 == 1)
    return found


def middle(word: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A pivot of each partition: the median of three of its words."""
    a, b, c = word[start], word[start + size // 2], word[start + size - 1]
    return np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))


def sort(table: pa.Table, longest: int, least: int) -> pa.Table:
    """The frequent phrases of a bucket."""
    bodies = table.column("body").to_pylist()
    phrases, counts = [], []
    if bodies:
        rows = [unpacked_suffixes(b, longest) for b in bodies]
        rows = np.concatenate([r.astype(max(r.dtype for r in rows)) for r in rows], axis=1)
        words = rows[:longest]
        for k, pointer, count in frequent_phrases(words, rows[longest], rows[longest + 1], least):
            phrases += words[:k, pointer].T.tolist()
            counts += count.tolist()
    return pa.table({"ids": pa.array(phrases, pa.list_(pa.int64())), "f": pa.array(counts, pa.int64())})


# ---------------------------------------------------------------- scores
def exact(column: Column) -> Column:
    return column.cast("decimal(38,0)")


def scored(frequent: DataFrame, phrases: DataFrame, totals: DataFrame, scale: int = 1000) -> DataFrame:
    """(lang, ids, a, l, r, n, score): each phrase with its lowest-scoring cut, the leftmost of several."""
    counts = phrases.unionByName(frequent.select(F.array("id").alias("ids"), "f"))
    cut = F.posexplode(F.transform(F.sequence(F.lit(1), F.size("ids") - 1), lambda k: F.struct(
        F.slice("ids", 1, k).alias("left"), F.slice("ids", k + 1, F.size("ids") - k).alias("right"))))
    cuts = phrases.select("ids", "f", cut.alias("k", "c")).select("ids", F.col("f").alias("a"), "k", "c.left", "c.right")
    cuts = cuts.join(counts.select(F.col("ids").alias("left"), F.col("f").alias("l")), "left").join(
        counts.select(F.col("ids").alias("right"), F.col("f").alias("r")), "right")
    cuts = cuts.withColumn("id", F.element_at("ids", 1)).join(frequent.select("id", "lang"), "id").join(totals, "lang")
    score = F.call_function("div", exact(F.col("a")) * exact(F.col("n")) * F.lit(scale), exact(F.col("l")) * exact(F.col("r")))
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return cuts.groupBy("ids").agg(F.first("lang").alias("lang"), F.first("a").alias("a"), F.first("n").alias("n"), best).select(
        "lang", "ids", "a", "best.l", "best.r", "n", "best.score")


def contained(phrases: DataFrame, percent: int) -> DataFrame:
    """Phrases that lie inside a longer one that occurs (``percent`` / 100 times) as often: (ids)."""
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("ids") - 1), lambda k: F.transform(
        F.sequence(F.lit(1), F.size("ids") - k + 1), lambda i: F.slice("ids", i, k))))
    longer = phrases.filter(F.size("ids") > 2).select(F.explode(inner).alias("ids"), "f").groupBy("ids").agg(F.max("f").alias("most"))
    return longer.join(phrases, "ids").filter(F.col("most") * 100 >= F.col("f") * percent).select("ids")


def named(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """``rows`` with ``phrase``, the words of ``ids``."""
    key = F.col("ids")
    words = rows.select(key, F.posexplode("ids").alias("at", "id")).join(frequent.select("id", "word"), "id").groupBy("ids").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ").alias("phrase"))
    return rows.join(words, "ids")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
                 top: int = 2000, percent: int = 100, hot: int = HOT, bucket: int = BUCKET) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of each language by falling score, ``top`` at most."""
    spark = docs.sparkSession
    small_batches(spark)
    given = docs.select(F.coalesce(F.col(quoted(lang)).cast("string"), F.lit("und")).alias("lang"), F.col(quoted(text)).cast("string").alias("text"))
    word_buckets = block_count(given, "text")
    chunks = materialize(given.mapInArrow(lambda batches: numbered_words(batches, word_buckets), CHUNK_SCHEMA), "chunk-words")
    messages = chunks.filter(F.col("bucket").isNotNull()).select("bucket", "chunk", "body")
    counted = materialize(messages.groupBy("bucket").applyInArrow(trimmed(lambda t: count_words(t, least, word_buckets)), COUNTED_SCHEMA), "counted-words")
    frequent = counted.filter(F.col("id").isNotNull()).select("id", "lang", "word", "f")
    totals = counted.filter("chunk IS NULL AND id IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    answers = counted.filter(F.col("chunk").isNotNull()).select("chunk", "body")
    codes = chunks.filter(F.col("codes").isNotNull()).select("chunk", "codes")
    occurrences = frequent.agg(F.sum("f")).first()[0] or 0
    buckets = max(1, math.ceil(occurrences / bucket))
    sent = codes.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        trimmed(lambda c, a: send(c, a, longest, hot, buckets)), "bucket long, body binary")
    phrases = sent.groupBy("bucket").applyInArrow(trimmed(lambda t: sort(t, longest, least)), "ids array<long>, f long")
    phrases = materialize(phrases, "phrases")
    kept = scored(frequent, phrases, totals).join(contained(phrases, percent), "ids", "left_anti")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return named(kept, frequent).withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
