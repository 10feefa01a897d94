"""Suffix-array dedup: remove every byte covered by a ``size``-byte string that also starts earlier.

Only a sparse set of suffixes is sorted, chosen so that no match is
lost.  Every window of ``size`` bytes of a text has an anchor: the
leftmost of its ``LEAD``-byte strings with the least hash.  Equal
windows have equal anchors at equal offsets, so two windows can only be
equal if the suffixes at their anchors share their leading ``LEAD``
bytes.  About one position in forty is an anchor.

1. Documents are dealt into blocks, in id order inside.  A block keeps
   one suffix for each distinct context (all windows of one anchor,
   with the anchor's place in it): the earliest; the others are known
   repeats.
2. The leads' hashes are counted over all blocks (as in substring_dedup);
   a suffix whose lead occurs once has no partner and stays at home.
3. Sampled splitters range-partition the other suffixes by leading bytes
   into buckets; a suffix carries its context.
4. A bucket sorts its suffixes by a multikey sort (eight bytes a round,
   only what is still tied goes on), compares neighbours, and looks into
   the windows of those only that share the lead with another suffix:
   which of them starts earlier elsewhere.
5. Leads so frequent that they fill whole buckets (they fall on several
   equal splitters) are spread over buckets by whole windows instead,
   so that these groups are compared across bucket bounds exactly.
6. One bit for each window comes back to its block, which removes what
   repeated windows cover.

The order of places is (id, offset); rows of equal id count as one after
the other, ordered by text.  Null ids come first.  Null texts are empty;
texts shorter than ``size`` have no window.  Windows are judged on the
input.  An empty table gives an empty result.  Other input columns come
back untouched inside ``row``.  Kept bytes are binary: a cut may split a
character.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BLOCK_BYTES, block_count, blocks, field, packed, result, texts, trimmed
from tidemark.llm.hashing import CHUNK_BYTES, Spans, byte_values, chunks, covered, mix, ranges
from tidemark.llm.substring_dedup import MESSAGES, count, distinct_flags, limits, member, messages, pack

SIZE = 100
LEAD = 32
SAMPLES_PER_BUCKET = 64
MAX_SAMPLES = 1 << 16  # bound of the splitter sample on the driver, as rows of LEAD bytes, times OVERSAMPLE
OVERSAMPLE = 8
PIECE = 1 << 13  # bytes of text that the splitter sample takes or leaves as one
NULL_ID = -(1 << 63)


def dedup_suffixes(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE,
                   carry: list[str] | None = None, block_bytes: int = BLOCK_BYTES // 2, as_text: bool = False) -> DataFrame:
    """One row per input row: ``row`` (carried columns), ``n_bytes``, ``n_removed``, ``spans`` (maximal
    removed byte ranges [start, end)) and ``kept`` (remaining bytes concatenated, binary; with ``as_text``
    a string, without what is left of characters that a cut split)."""
    if size < LEAD:
        raise ValueError(f"size must be at least {LEAD}")
    n = block_count(docs, text, block_bytes)
    given = packed(docs, key, text, carry)
    out = result(given, "n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept " + ("string" if as_text else "binary"))
    cuts, hot = splitters(given, size, n)
    shared = docs.sparkSession.sparkContext.broadcast((cuts, hot))
    dealt = blocks(given, n)
    leads = dealt.groupBy("block").applyInArrow(trimmed(lambda t: send_leads(t, size, n)), MESSAGES)
    counted = leads.groupBy("bucket").applyInArrow(trimmed(lambda t: count(t)), MESSAGES)
    sent = dealt.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(
        trimmed(lambda t, answers: send(t, answers, size, n, *shared.value)), MESSAGES)
    repeated = sent.groupBy("bucket").applyInArrow(trimmed(lambda t: resolve(t, size, n)), MESSAGES)
    return dealt.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(
        trimmed(lambda t, answers: cut(t, answers, size, n, *shared.value, as_text)), out)


def splitters(given: DataFrame, size: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """n - 1 leads that cut what will be sent into about equal parts, and those that fill more than a part.

    From a sample of pieces of texts, so that its size follows the bytes of all texts, whatever their lengths and
    ids; a piece is taken by its id, place and bytes, and copies collapse into their distinct leads.  Half of the cuts are quantiles of its leads, which pairs and small groups
    follow; half are quantiles of the leads that have several contexts in the sample already, each as often
    as it has, which large groups follow.  For balance only: whatever it holds, the result is the same."""
    wanted = min(MAX_SAMPLES, SAMPLES_PER_BUCKET * n) * OVERSAMPLE
    length = F.greatest(F.octet_length("doc.text") - size + 1, F.lit(0))
    total = given.agg(F.sum(length)).first()[0] or 0
    density = (size - LEAD + 2) / 2  # positions per anchor
    share = min(1.0, wanted * density / max(1, total))
    most = int(share * (1 << 30))
    piece = lambda i: F.substring(F.col("doc.text").cast("binary"), i * PIECE + 1, F.lit(PIECE))
    places = F.sequence(F.lit(0), F.floor(F.octet_length("doc.text") / PIECE).cast("int"))
    taken = F.filter(places, lambda i: F.pmod(F.xxhash64("doc.id", i, piece(i)), F.lit(1 << 30)) <= most)
    picked = given.filter("doc.text IS NOT NULL").select(F.explode(F.transform(taken, piece)).alias("text")).select(F.struct("text").alias("doc"))

    def leads(batches):
        for batch in batches:
            for part in contexts(texts(batch), size):
                yield pa.RecordBatch.from_arrays([pa.array([bytes(x).ljust(LEAD, b"\0") for x in part.leads()], pa.binary()),
                                                  pa.array(part.hash.view(np.int64))], ["lead", "context"])

    rows = picked.mapInArrow(leads, "lead binary, context long").groupBy("lead").agg(F.countDistinct("context").alias("n")).toArrow()
    if not rows.num_rows:
        return np.zeros(0, f"S{LEAD}"), np.zeros(0, f"S{LEAD}")
    every, many = np.array(rows.column("lead").to_pylist(), f"S{LEAD}"), rows.column("n").to_numpy()
    order = np.argsort(every)
    every, many = every[order], many[order]
    half = n // 2
    cuts = [every[(np.arange(1, n - half) * len(every)) // (n - half)]]
    groups = np.flatnonzero(many > 1)
    if len(groups):
        ends = np.cumsum(many[groups])
        cuts.append(every[groups[np.searchsorted(ends, (np.arange(half) * ends[-1]) // max(1, half), side="right")]])
    cuts = np.sort(np.concatenate(cuts))
    return cuts, np.unique(cuts[1:][cuts[1:] == cuts[:-1]])


class Contexts:
    """Runs of windows with one anchor, in a chunk of documents."""

    def __init__(self, data: np.ndarray, lo: np.ndarray, hi: np.ndarray, anchor: np.ndarray, size: int, offsets: np.ndarray):
        self.data, self.lo, self.anchor, self.size = data, lo, anchor, size
        self.n = hi - lo  # windows start at lo, lo + 1, ... (n of them)
        self.offsets = offsets
        self.hash = self.lead = np.zeros(0, np.uint64)  # of the whole context, and of its lead

    def leads(self, pick: np.ndarray | slice = slice(None)) -> np.ndarray:
        at = self.anchor[pick, None] + np.arange(LEAD)
        return np.ascontiguousarray(self.data[at]).view(f"S{LEAD}").ravel()


def contexts(docs: list[bytes], size: int):
    """The contexts of consecutive chunks of documents, with a hash of bytes, length and anchor's place."""
    values = byte_values()
    for a, b in chunks(docs):
        data = np.frombuffer(b"".join(docs[a:b]), np.uint8)
        offsets = np.zeros(b - a + 1, np.int64)
        np.cumsum([len(d) for d in docs[a:b]], out=offsets[1:])
        starts = ranges(offsets[:-1], np.maximum(np.diff(offsets) - size + 1, 0))
        if not len(starts):
            yield Contexts(data, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), size, offsets)
            continue
        spans = Spans(values[data])
        leads = mix(spans.fixed(LEAD))
        least = leads & ~np.uint64(0xFFFFFFFF) | np.arange(len(data) - LEAD + 1, dtype=np.uint64)
        width, step = size - LEAD + 1, 1
        while 2 * step <= width:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if step < width:
            least = np.minimum(least[:step - width], least[width - step:])
        anchor = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.flatnonzero(np.diff(anchor, prepend=-1))
        # the windows of one anchor follow each other: the leftmost least string leaves for good once another beats it
        lo, n = starts[new], np.diff(new, append=len(starts))
        out = Contexts(data, lo, lo + n, anchor[new], size, offsets)
        place = (out.anchor - lo).astype(np.uint64) << np.uint64(32) | n.astype(np.uint64)
        out.hash = mix(spans.hash(lo, lo + n + size - 1) + place * np.uint64(0x9E3779B97F4A7C15))
        out.lead = leads[out.anchor] & ~np.uint64(1)
        yield out


class Block:
    """A block's documents in id order, and the first of each distinct context in it."""

    def __init__(self, table: pa.Table, size: int):
        ids = field(table, "id").fill_null(NULL_ID).to_numpy(zero_copy_only=False)
        docs = texts(table)
        self.order = np.array(sorted(range(len(docs)), key=lambda i: (ids[i], docs[i])), np.int64)
        self.docs = [docs[i] for i in self.order]
        self.ids = ids[self.order]
        length = np.array([len(d) for d in self.docs], np.int64)
        before = np.cumsum(length) - length
        new = np.ones(len(length), bool)
        new[1:] = self.ids[1:] != self.ids[:-1]
        self.shift = before - before[new][np.cumsum(new) - 1] if len(length) else before  # bytes before it in rows of its id
        self.before = before
        self.parts = list(contexts(self.docs, size))
        every = np.concatenate([np.zeros(0, np.uint64), *[part.hash for part in self.parts]])
        self.first = firsts(every)
        self.leads, self.twice = distinct_flags(np.concatenate([np.zeros(0, np.uint64), *[part.lead for part in self.parts]])[self.first])
        self.sent = self.leads  # those that occur elsewhere

    def cuts(self, n: int) -> np.ndarray:
        return np.append(np.searchsorted(self.leads, limits(n)), len(self.leads))

    def walk(self, n: int, cuts: np.ndarray, hot: np.ndarray):
        """Per chunk: its first document, its contexts, and for the first of each distinct context in
        the block, if its lead occurs elsewhere: its index, bucket, and whether its lead is hot."""
        base = done = 0
        for part in self.parts:
            pick = np.flatnonzero(self.first[done:done + len(part.hash)])
            pick = pick[member(part.lead[pick], self.sent)]
            bucket, spread = placed(part.leads(pick), cuts, hot)
            yield base, part, pick, bucket, spread
            base += len(part.offsets) - 1
            done += len(part.hash)

    def spread_windows(self, n: int, cuts: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, ...]:
        """Windows of the contexts with hot leads: hash, id, offset, and whether the block has it first here."""
        found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for base, part, pick, _, spread in self.walk(n, cuts, hot):
            if spread.any():
                pick = pick[spread]
                ids, offs = positions(part, base, pick, self)
                starts = ranges(part.lo[pick], part.n[pick])
                hashes = Spans(byte_values()[part.data]).hash(starts, starts + part.size)
                found.append((hashes, np.repeat(ids, part.n[pick]),
                              np.repeat(offs - part.lo[pick], part.n[pick]) + starts))
        hashes, ids, offs = (np.concatenate(x) for x in zip(*found, strict=True))
        return hashes, ids, offs, firsts(hashes)


def firsts(values: np.ndarray) -> np.ndarray:
    """Which elements are the first of their value."""
    out = np.zeros(len(values), bool)
    out[np.unique(values, return_index=True)[1]] = True
    return out


def gathered(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    return data[ranges(start, length)]


def placed(leads: np.ndarray, cuts: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each lead, and whether its windows are dealt out one by one."""
    if not len(cuts):
        return np.zeros(len(leads), np.int64), np.zeros(len(leads), bool)
    return np.searchsorted(cuts, leads, side="right"), np.isin(leads, hot)


def positions(part: Contexts, base: int, pick: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(id, offset) of the first window of the picked contexts."""
    doc = np.searchsorted(part.offsets, part.lo[pick], side="right") - 1
    return block.ids[base + doc], part.lo[pick] - part.offsets[doc] + block.shift[base + doc]


def spread_bucket(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def send_leads(table: pa.Table, size: int, n: int) -> pa.Table:
    """Hashes of the leads of the block's first contexts, by hash range."""
    if not table.num_rows:
        return messages([], [], [])
    block = Block(table, size)
    bounds = block.cuts(n)
    hashes = block.leads | block.twice.astype(np.uint64)
    used = np.flatnonzero(np.diff(bounds))
    return messages([table.column("block")[0].as_py()] * len(used), used.tolist(), [pack(hashes[bounds[b]:bounds[b + 1]]) for b in used])


def send(table: pa.Table, answers: pa.Table, size: int, n: int, cuts: np.ndarray, hot: np.ndarray) -> pa.Table:
    """The block's first contexts whose leads occur elsewhere, and the windows of those with hot leads,
    by bucket; and for the block itself, the bits of its leads."""
    if not table.num_rows:
        return messages([], [], [])
    block = Block(table, size)
    bounds = block.cuts(n)
    many = np.zeros(len(block.leads), bool)
    for bucket, body in zip(answers.column("bucket").to_pylist(), answers.column("body").to_pylist(), strict=True):
        lo, hi = bounds[bucket], bounds[bucket + 1]
        many[lo:hi] = np.unpackbits(np.frombuffer(body, np.uint8), count=hi - lo)
    block.sent = block.leads[many]
    whole: list[list[tuple]] = [[] for _ in range(n)]
    for base, part, pick, bucket, spread in block.walk(n, cuts, hot):
        ids, offs = positions(part, base, pick, block)
        plain = np.flatnonzero(~spread)
        for b, rows in grouped(bucket[plain]):
            rows = plain[rows]
            p = pick[rows]
            whole[b].append((part.n[p].astype(np.uint16), (part.anchor[p] - part.lo[p]).astype(np.uint16), ids[rows], offs[rows],
                             gathered(part.data, part.lo[p], part.n[p] + size - 1)))
    hashes, ids, offs, first = block.spread_windows(n, cuts, hot)
    hashes, ids, offs = hashes[first], ids[first], offs[first]
    single = {b: (hashes[r], ids[r], offs[r]) for b, r in grouped(spread_bucket(hashes, n))}
    used = [b for b in range(n) if whole[b] or b in single]
    number = table.column("block")[0].as_py()
    body = [encode(whole[b], single.get(b)) for b in used]
    return messages([number] * (len(used) + 1), [*used, n + number], [*body, np.packbits(many).tobytes()])


def grouped(bucket: np.ndarray):
    """(bucket, indices in order) for each bucket that occurs."""
    order = np.argsort(bucket, kind="stable")
    if not len(order):
        return
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for a, b in zip(edges, np.append(edges[1:], len(order)), strict=True):
        yield int(bucket[order[a]]), order[a:b]


KINDS = (np.uint16, np.uint16, np.int64, np.int64, np.uint8, np.uint64, np.int64, np.int64)


def encode(whole: list[tuple], single: tuple | None) -> bytes:
    arrays = [np.concatenate([np.zeros(0, KINDS[i]), *[w[i] for w in whole]]) for i in range(5)]
    arrays += single or [np.zeros(0, k) for k in KINDS[5:]]
    sizes = np.array([a.nbytes for a in arrays], np.int64).tobytes()
    body = b"".join([sizes, *[a.astype(k).tobytes() for a, k in zip(arrays, KINDS, strict=True)]])
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def decode(body: bytes) -> list[np.ndarray]:
    raw = pa.decompress(body[8:], int.from_bytes(body[:8], "little"), codec="zstd", asbytes=True)
    sizes = np.frombuffer(raw, np.int64, len(KINDS))
    ends = 8 * len(KINDS) + np.cumsum(sizes)
    return [np.frombuffer(raw, k, s // np.dtype(k).itemsize, e - s) for k, s, e in zip(KINDS, sizes, ends, strict=True)]


def word_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as a big-endian number, so that numbers sort as strings."""
    if not len(at):
        return np.zeros(0, np.uint64)
    words = np.ndarray((len(data) - 7,), ">u8", np.ascontiguousarray(data), 0, (1,))  # one word from each byte on
    return words[at].astype(np.uint64)


def multikey(data: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort strings of ``length`` bytes, eight bytes a round; a string that differs from its neighbours
    leaves.  Returns those that equal another, group by group, and their group numbers."""
    rows, group = np.arange(len(start)), np.zeros(len(start), np.int64)
    for depth in [*range(0, length - 8, 8), length - 8]:
        if not len(rows):
            break
        word = word_at(data, start[rows] + depth)
        order = np.lexsort((word, group)) if depth else np.argsort(word, kind="stable")
        rows, group, word = rows[order], group[order], word[order]
        new = np.ones(len(rows) + 1, bool)
        new[1:-1] = (group[1:] != group[:-1]) | (word[1:] != word[:-1])
        tied = ~(new[:-1] & new[1:])
        group = np.cumsum(new[:-1])
        rows, group = rows[tied], group[tied]
    return rows, group


def resolve(table: pa.Table, size: int, n_buckets: int) -> pa.Table:
    """For each message, a bit per window: an equal window starts earlier.  What a block sends to itself stays as it is."""
    if not table.num_rows or table.column("bucket")[0].as_py() >= n_buckets:
        return table.select(["block", "bucket", "body"])
    parts = [decode(b) for b in table.column("body").to_pylist()]
    n, place, ids, offs, data, hashes, wid, woff = (np.concatenate([p[i] for p in parts]) for i in range(8))
    n, place = n.astype(np.int64), place.astype(np.int64)
    length = n + size - 1
    start = np.cumsum(length) - length
    flags = repeats(data, start, n, place, ids, offs, size)
    late = later(hashes, wid, woff)
    bounds = np.cumsum([0, *[int(p[0].sum(dtype=np.int64)) for p in parts]])
    singles = np.cumsum([0, *[len(p[5]) for p in parts]])
    body = [np.packbits(np.concatenate([late[singles[i]:singles[i + 1]], flags[bounds[i]:bounds[i + 1]]])).tobytes() for i in range(len(parts))]
    return messages(table.column("block").to_pylist(), table.column("bucket").to_pylist(), body)


def later(hashes: np.ndarray, ids: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Which of the windows have an equal one at an earlier place."""
    order = np.lexsort((offs, ids, hashes))
    late = np.zeros(len(hashes), bool)
    late[order[1:]] = hashes[order[1:]] == hashes[order[:-1]]
    return late


def hashed(data: np.ndarray, start: np.ndarray, length: np.ndarray, rows: np.ndarray):
    """Some of the contexts at a time: which, where each begins in their joined bytes, and those bytes' hashes."""
    values = byte_values()
    ends = np.cumsum(length[rows])
    lo = 0
    while lo < len(rows):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CHUNK_BYTES, side="right")))
        part = rows[lo:hi]
        yield part, np.cumsum(length[part]) - length[part], Spans(values[gathered(data, start[part], length[part])])
        lo = hi


def repeats(data: np.ndarray, start: np.ndarray, n: np.ndarray, place: np.ndarray, ids: np.ndarray, offs: np.ndarray, size: int) -> np.ndarray:
    """A flag per window of the contexts: it starts earlier in another."""
    windows = int(n.sum())
    flags = np.zeros(windows, bool)
    rows, lead = multikey(data, start + place, LEAD)
    if not len(rows):
        return flags
    first_window = np.cumsum(n) - n
    # whole contexts that are equal: all but the earliest are repeats throughout
    length = n + size - 1
    full = np.concatenate([spans.hash(own, own + length[part]) + (place[part].astype(np.uint64) << np.uint64(32) | n[part].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                           for part, own, spans in hashed(data, start, length, rows)])
    order = np.lexsort((offs[rows], ids[rows], full))
    again = np.zeros(len(rows), bool)
    again[order[1:]] = full[order[1:]] == full[order[:-1]]
    gone = rows[again]
    flags[ranges(first_window[gone], n[gone])] = True
    # windows of the others, in order of their places, by hash; neighbours are compared byte by byte
    left = np.flatnonzero(~again)
    left = left[np.lexsort((offs[rows[left]] + place[rows[left]], ids[rows[left]]))]
    keep = rows[left]
    hashes = np.concatenate([np.zeros(0, np.uint64), *[spans.hash(inner, inner + size) for part, own, spans in hashed(data, start, length, keep)
                                                       for inner in (ranges(own, n[part]),)]])
    which = ranges(first_window[keep], n[keep])
    at = ranges(start[keep], n[keep])
    order = np.argsort(hashes, kind="stable")
    tied = np.zeros(len(order), bool)
    tied[1:] = hashes[order[1:]] == hashes[order[:-1]]
    late = order[tied]
    earlier = order[np.flatnonzero(tied) - 1]
    same = np.ones(len(late), bool)
    for depth in [*range(0, size - 8, 8), size - 8]:
        same &= word_at(data, at[late] + depth) == word_at(data, at[earlier] + depth)
    flags[which[late[same]]] = True
    return flags


def cut(table: pa.Table, answers: pa.Table, size: int, n: int, cuts: np.ndarray, hot: np.ndarray, as_text: bool) -> pa.Table:
    """Remove what repeated windows cover, document by document."""
    block = Block(table, size)
    bits = {b: np.unpackbits(np.frombuffer(x, np.uint8)).astype(bool)
            for b, x in zip(answers.column("bucket").to_pylist(), answers.column("body").to_pylist(), strict=True)}
    block.sent = block.leads[bits[n + table.column("block")[0].as_py()][:len(block.leads)]]
    hashes, _, _, first = block.spread_windows(n, cuts, hot)
    late, read = np.ones(len(hashes), bool), np.zeros(n, np.int64)  # a window that the block has before is a repeat
    own = np.flatnonzero(first)
    for b, r in grouped(spread_bucket(hashes[own], n)):  # a message has these windows first
        late[own[r]] = bits[b][:len(r)]
        read[b] = len(r)
    rows: list[tuple] = []
    done = 0
    for _, part, pick, bucket, spread in block.walk(n, cuts, hot):
        # so are all windows of a context that the block has before; those whose lead occurs once are not
        repeated = np.repeat(~block.first[done:done + len(part.n)], part.n)
        done += len(part.n)
        first_window = np.cumsum(part.n) - part.n
        plain = np.flatnonzero(~spread)
        for b, r in grouped(bucket[plain]):
            p = pick[plain[r]]
            total = int(part.n[p].sum())
            repeated[ranges(first_window[p], part.n[p])] = bits[b][read[b]:read[b] + total]
            read[b] += total
        if spread.any():
            p = pick[spread]
            total = int(part.n[p].sum())
            repeated[ranges(first_window[p], part.n[p])] = late[:total]
            late = late[total:]
        hit = ranges(part.lo, part.n)[repeated]
        gone = covered(len(part.data), hit, hit + size)
        for d in range(len(part.offsets) - 1):
            a, b = part.offsets[d], part.offsets[d + 1]
            mine = gone[a:b]
            removed = int(mine.sum())
            edge = np.flatnonzero(np.diff(mine, prepend=False, append=False)).tolist() if removed else []
            rows.append((int(b - a), removed, [{"start": s, "end": e} for s, e in zip(edge[0::2], edge[1::2], strict=True)],
                         part.data[a:b][~mine].tobytes()))
    if as_text:
        rows = [(*r[:3], r[3].decode(errors="ignore")) for r in rows]
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    return pa.table({"row": field(table, "row").take(pa.array(block.order)), "n_bytes": pa.array(columns[0], pa.int64()),
                     "n_removed": pa.array(columns[1], pa.int64()),
                     "spans": pa.array(columns[2], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     "kept": pa.array(columns[3], pa.string() if as_text else pa.binary())})
