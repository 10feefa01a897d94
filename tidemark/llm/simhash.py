"""SimHash near-dedup by a binary trie self-join.

Texts are lower-cased (A-Z), cut into words at ASCII white space and
into shingles of ``shingle`` words joined by one space (a shorter text is
one shingle; without words the fingerprint is zero, linked like any
other).  A fingerprint bit is set if it is set in over half of the
shingles' XXH64 (seed 42).  Fingerprints link at ``max_bits`` or fewer
differing bits.

Equal fingerprints are first counted as one.  The distinct ones form a
binary trie that is joined with itself: pairs of nodes are walked down
together, the error is the number of bits in which their paths differ,
and a pair is dropped once it exceeds ``max_bits``.  The top of the trie
is cut where a histogram of the leading ``HISTOGRAM_BITS`` bits says that
a node is small enough for a task; its node pairs are found on the
driver (the histogram has at most 2**HISTOGRAM_BITS rows whatever the
input).  Each fingerprint goes to its own node's task and, for each
linked pair of nodes, to the other's; there the walk goes on to the
leaves.  A task returns a spanning forest of the links it finds, never
all pairs; components come from alternating star contraction.

Null text has no words.  Repeated rows have equal fingerprints.  Null ids
have a null component of their own kind: they take part in links, but
never name a component unless all its ids are null.  An empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, components, field, materialize, packed, partitions, result, texts, trim

SHINGLE = 3
MAX_BITS = 2
HISTOGRAM_BITS = 16
FRONTIER = 1 << 20  # node pairs walked at once: bounds memory, the rest waits on a stack


def simhash_components(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                       max_bits: int = MAX_BITS, carry: list[str] | None = None) -> DataFrame:
    """One row per input row: ``row`` (carried columns), ``id``, ``bits`` (the fingerprint as a long) and
    ``component_id`` (smallest id reachable over links)."""
    prints = fingerprint_rows(docs, key, text, shingle, carry)
    return prints.join(named(prints, max_bits), "bits").select("row", "id", "bits", F.col("least.id").alias("component_id"))


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, with its smallest id."""
    prints = fingerprint_rows(docs, key, text, shingle, docs.columns)
    stay = named(prints, max_bits).select("least.seq").distinct()
    return prints.join(stay, "seq", "left_semi").select("row.*")


def fingerprint_rows(docs: DataFrame, key: str, text: str, shingle: int, carry: list[str] | None) -> DataFrame:
    """Each row with its fingerprint and a number of its own, written so that the number stays."""
    given = packed(docs, key, text, carry)
    rows = given.mapInArrow(lambda batches: fingerprints(batches, shingle), result(given, "id long, bits long"))
    return materialize(rows.withColumn("seq", F.monotonically_increasing_id()), "simhash")


def named(prints: DataFrame, max_bits: int) -> DataFrame:
    """(bits, least): the first row of each fingerprint's component, by id (nulls last)."""
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "seq"))
    distinct = checkpointed(prints.groupBy("bits").agg(first.alias("least")))
    linked = components(links(distinct, max_bits))
    members = distinct.join(linked, F.col("bits") == F.col("node"), "left").select(
        "bits", "least", F.coalesce("component", "bits").alias("component"))
    least = members.groupBy("component").agg(F.min("least").alias("least"))
    return checkpointed(members.select("bits", "component").join(least, "component").select("bits", "least"))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()  # of bytes: A-Z, and the white space 20, 09-0D
    if not words:
        return 0
    data = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    start = end - length
    if len(words) > shingle:
        pieces = [data[a:b] for a, b in zip(start[:len(words) - shingle + 1].tolist(), end[shingle - 1:].tolist(), strict=True)]
    else:
        pieces = [data]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(p, 42) for p in pieces], np.uint64)
    if len(hashes) < 256:
        ones = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    else:  # by byte values: eight bits at a time
        table = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
        planes = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
        ones = np.concatenate([np.bincount(planes[:, i], minlength=256) @ table for i in range(8)])
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(batches, shingle: int):
    for batch in batches:
        bits = np.array([fingerprint(t, shingle) for t in texts(batch)], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([field(batch, "row"), field(batch, "id"), pa.array(bits)], ["row", "id", "bits"])
    trim()


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """A spanning forest (u, v) of the links between distinct fingerprints, found node by node."""
    spark = distinct.sparkSession
    top = F.shiftrightunsigned("bits", 64 - HISTOGRAM_BITS).cast("int")
    histogram = distinct.groupBy(top.alias("top")).count().toPandas()
    node, partners = cut_trie(histogram["top"].to_numpy(np.int64), histogram["count"].to_numpy(np.int64), 4 * partitions(spark), max_bits)
    shared = spark.sparkContext.broadcast((node, partners))
    sent = distinct.select("bits").mapInArrow(lambda batches: deal(batches, *shared.value), "node int, home boolean, bits long")
    found = sent.groupBy("node").applyInArrow(lambda t: join_node(t, max_bits), "u long, v long")
    return checkpointed(found.distinct())


def cut_trie(top: np.ndarray, count: np.ndarray, parts: int, max_bits: int) -> tuple[np.ndarray, list[list[int]]]:
    """Cut the trie into nodes of at most about total / parts fingerprints; returns the node of each
    leading bit pattern, and of each node the later-numbered ones within max_bits."""
    size = np.zeros(1 << HISTOGRAM_BITS, np.int64)
    size[top] = count
    limit = max(256, int(size.sum()) // parts)
    nodes: list[tuple[int, int]] = []
    stack = [(0, 0)]
    while stack:
        prefix, depth = stack.pop()
        lo, hi = prefix << (HISTOGRAM_BITS - depth), (prefix + 1) << (HISTOGRAM_BITS - depth)
        total = size[lo:hi].sum()
        if not total:
            continue
        if depth == HISTOGRAM_BITS or total <= limit:
            nodes.append((prefix, depth))
        else:
            stack += [(2 * prefix, depth + 1), (2 * prefix + 1, depth + 1)]
    node = np.full(1 << HISTOGRAM_BITS, -1, np.int32)
    prefix, depth = (np.array(x, np.int64) for x in zip(*nodes, strict=True)) if nodes else (np.zeros(0, np.int64),) * 2
    for i, (p, d) in enumerate(nodes):
        node[p << (HISTOGRAM_BITS - d):(p + 1) << (HISTOGRAM_BITS - d)] = i
    partners: list[list[int]] = []
    for i, (p, d) in enumerate(nodes):
        common = np.minimum(depth[i + 1:], d)
        errors = np.bitwise_count((prefix[i + 1:] >> (depth[i + 1:] - common)) ^ (p >> (d - common)))
        partners.append((np.flatnonzero(errors <= max_bits) + i + 1).tolist())
    return node, partners


def deal(batches, node: np.ndarray, partners: list[list[int]]):
    """Each fingerprint to its own node, and to the earlier nodes that its node is a partner of."""
    visits: list[list[int]] = [[] for _ in partners]
    for i, later in enumerate(partners):
        for j in later:
            visits[j].append(i)
    many = np.array([len(v) for v in visits], np.int64)
    flat = np.array([i for v in visits for i in v], np.int32)
    start = np.cumsum(many) - many
    for batch in batches:
        bits = batch.column("bits").to_numpy()
        own = node[(bits.view(np.uint64) >> np.uint64(64 - HISTOGRAM_BITS)).astype(np.int64)]
        copies = many[own]
        before = np.cumsum(copies) - copies
        to = flat[np.repeat(start[own] - before, copies) + np.arange(copies.sum())]
        home = np.concatenate([np.ones(len(bits), bool), np.zeros(len(to), bool)])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([own, to]).astype(np.int32)), pa.array(home),
                                          pa.array(np.concatenate([bits, np.repeat(bits, copies)]))], ["node", "home", "bits"])


def join_node(table: pa.Table, max_bits: int) -> pa.Table:
    bits = table.column("bits").to_numpy().view(np.uint64)
    home = table.column("home").to_numpy(zero_copy_only=False)
    here, there = np.sort(bits[home]), np.sort(bits[~home])
    forest = Forest(np.concatenate([here, there]))
    for a, b in trie_join(here, here, True, max_bits):
        forest.link(a, b)
    for a, b in trie_join(here, there, False, max_bits):
        forest.link(a, b + len(here))
    u, v = forest.edges()
    return pa.table({"u": pa.array(u.view(np.int64)), "v": pa.array(v.view(np.int64))})


def trie_join(x: np.ndarray, y: np.ndarray, same: bool, max_bits: int):
    """Index pairs (i, j) of the sorted arrays with at most max_bits differing bits; of one array with
    itself (``same``) each pair once.  A trie node is a range of a sorted array."""
    if not len(x) or not len(y):
        return
    z = np.zeros(1, np.int64)
    stack = [(0, z, z + len(x), z, z + len(y), z)]
    while stack:
        depth, xa, xb, ya, yb, errors = stack.pop()
        if len(xa) > FRONTIER:
            half = len(xa) // 2
            stack.append((depth, *(k[half:] for k in (xa, xb, ya, yb, errors))))
            xa, xb, ya, yb, errors = (k[:half] for k in (xa, xb, ya, yb, errors))
        small = ((xb - xa) * (yb - ya) <= 16) | (depth == 64)
        for i, j in leaves(xa[small], xb[small], ya[small], yb[small]):
            near = np.bitwise_count(x[i] ^ y[j]) <= max_bits
            if same:
                near &= i < j
            if near.any():
                yield i[near], j[near]
        xa, xb, ya, yb, errors = (k[~small] for k in (xa, xb, ya, yb, errors))
        if not len(xa):
            continue
        bit = np.uint64(63 - depth)
        xm, ym = middle(x, xa, xb, bit), middle(y, ya, yb, bit)
        pairs = [(xa, xm, ya, ym, errors), (xm, xb, ym, yb, errors), (xa, xm, ym, yb, errors + 1)]
        cross = (xm, xb, ya, ym, errors + 1)
        if same:  # a node with itself has one mixed pair of children
            other = xa != ya
            cross = tuple(k[other] for k in cross)
        pairs.append(cross)
        merged = [np.concatenate(k) for k in zip(*pairs, strict=True)]
        live = (merged[1] > merged[0]) & (merged[3] > merged[2]) & (merged[4] <= max_bits)
        if live.any():
            stack.append((depth + 1, *(k[live] for k in merged)))


def middle(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.uint64) -> np.ndarray:
    """Where the ones begin at this bit of the nodes [lo, hi)."""
    edge = (values[lo] >> bit | np.uint64(1)) << bit
    return np.clip(np.searchsorted(values, edge), lo, hi)


def leaves(xa: np.ndarray, xb: np.ndarray, ya: np.ndarray, yb: np.ndarray):
    """All index pairs of the node pairs, some million at a time."""
    many = (xb - xa) * (yb - ya)
    ends = np.cumsum(many)
    at = 0
    while at < len(many):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + 4 * FRONTIER, side="right")))
        n = many[at:to]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = np.repeat(yb[at:to] - ya[at:to], n)
        yield np.repeat(xa[at:to], n) + k // width, np.repeat(ya[at:to], n) + k % width
        at = to


class Forest:
    """Components of values under links that come in batches."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.root = np.arange(len(values))

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while len(a):
            ra, rb = root[a], root[b]
            open_ = ra != rb
            if not open_.any():
                return
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            low, high = np.minimum(ra, rb), np.maximum(ra, rb)
            order = np.lexsort((low, high))[::-1]
            root[high[order]] = low[order]  # the last write, the least, stays
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root[:] = up

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Every value that is not its component's root, with the root."""
        linked = self.root != np.arange(len(self.root))
        return self.values[linked], self.values[self.root[linked]]
