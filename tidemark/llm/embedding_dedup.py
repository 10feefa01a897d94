"""Embedding near-dedup by Euclidean p-stable hashing.

Vectors of equal label (not null) link at a cosine of at least
``threshold``.  Equal vectors are first counted as one class.  A class's
vector is normalised and projected on Gaussian directions; each
projection plus a random offset is cut into cells of ``CELL`` (for unit
vectors, distance squared = 2 - 2 cosine, so a cosine bound is a distance
bound); some projections together are the key of one table.  Classes that
share a key in any table are compared by cosine in double precision.

The number of projections per table follows half the logarithm of the
number of classes, so that cells stay small; the number of tables follows
from it and ``recall``, the chance that a pair exactly at the threshold
meets in some table (closer pairs meet more surely).

Only keys with two classes or more go on, and only then do vectors
travel.  A key with more than ``TILE`` classes is cut into chunks that
meet chunk against chunk, so no task holds more than two chunks of a key.
A pair that meets in several tables counts in the first.  A task returns
link counts and a spanning forest per class, never pairs.

Vectors that are null, zero, or hold null or non-finite components, and
those with a null label, link with nothing; vectors of unequal length
don't either.  Repeated rows are vectors of their own.  An empty table
gives an empty result.  Other input columns come back inside ``row``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, components, materialize, partitions, quoted
from tidemark.llm.hashing import mix

THRESHOLD = 0.98
RECALL = 0.9995
CELL = 1.0
TILE = 2048
SEED = 20240


def meeting_chance(distance: float, cell: float = CELL) -> float:
    """That two vectors at this distance fall into one cell of a projection."""
    r = cell / distance
    below = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def table_plan(classes: int, threshold: float, recall: float) -> tuple[int, int]:
    """Projections per table, and tables."""
    width = max(4, math.ceil(math.log2(max(2, classes)) / 2))
    chance = meeting_chance(math.sqrt(2 - 2 * threshold)) ** width
    return width, max(1, math.ceil(math.log(1 - recall) / math.log(1 - chance)))


def embedding_components(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", label: str = "label",
                         threshold: float = THRESHOLD, recall: float = RECALL, carry: list[str] | None = None) -> DataFrame:
    """One row per input row: ``row`` (carried columns), ``id``, ``n_links`` (rows linked directly) and
    ``component_id`` (smallest id reachable over links, its own included)."""
    carry = [key] if carry is None else carry
    e, name = F.col("e"), F.col("label")
    given = vectors.select(F.struct(*[F.col(quoted(c)) for c in carry]).alias("row"), F.col(quoted(key)).cast("long").alias("id"),
                           F.col(quoted(label)).cast("string").alias("label"), F.col(quoted(embedding)).cast("array<double>").alias("e"))
    sound = name.isNotNull() & e.isNotNull() & F.forall(e, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))) & F.exists(e, lambda x: x != 0)
    # a class is named by a 64-bit hash of label and vector
    given = given.withColumn("sound", F.coalesce(sound, F.lit(False))).withColumn("node", F.when(F.col("sound"), F.xxhash64("label", "e")))
    classes = materialize(given.filter("sound").groupBy("node").agg(
        F.count("*").alias("size"), F.min("id").alias("least"), F.first("label").alias("label"), F.first("e").alias("e")), "vector-classes")
    n = classes.count()
    links = class_links(classes, n, threshold, *table_plan(n, threshold, recall))
    linked = components(links.filter("node != root").select(F.col("node").alias("u"), F.col("root").alias("v")))
    total = links.groupBy("node").agg(F.sum("links").alias("links"))
    members = classes.select("node", "size", "least").join(total, "node", "left").join(linked, "node", "left").select(
        "node", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "least", F.coalesce("component", "node").alias("component"))
    least = members.groupBy("component").agg(F.min("least").alias("component_id"))
    known = checkpointed(members.join(least, "component").select("node", "n_links", "component_id"))
    return given.select("row", "id", "node").join(known, "node", "left").select(
        "row", "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def class_links(classes: DataFrame, n: int, threshold: float, width: int, tables: int) -> DataFrame:
    """(node, links, root): per class and task, how many rows of other classes it links to, and the root of
    its tree in the task's spanning forest."""
    spark = classes.sparkSession
    signed = materialize(classes.select("node", "size", "label", "e").mapInArrow(
        lambda batches: sign(batches, width, tables), "node long, size long, e array<double>, keys array<long>"), "vector-keys")
    keyed = signed.select("node", F.explode("keys").alias("key"))
    shared = checkpointed(keyed.groupBy("key").count().filter("count > 1"))
    chunks = F.ceil(F.col("count") / TILE).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit("chunk")), F.col("chunks")).cast("int")
    met = keyed.join(shared, "key").withColumn("chunks", chunks).withColumn("own", own)
    tiles = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "node", "key", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    groups = max(4 * partitions(spark), math.ceil(n * tables / 65536))
    work = tiles.join(signed, "node").withColumn("part", F.pmod(F.xxhash64("key", "i", "j"), F.lit(groups)).cast("int"))
    found = work.groupBy("part").applyInArrow(lambda t: compare(t, threshold), "node long, links long, root long")
    return materialize(found, "vector-links")


def unit(batch: pa.Array) -> np.ndarray:
    """Rows of doubles, normalised; scaled first, so that squares neither vanish nor overflow."""
    flat = batch.flatten().to_numpy(zero_copy_only=False)
    x = flat.reshape(len(batch), -1) if len(batch) else flat.reshape(0, 1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def sign(batches, width: int, tables: int):
    """The keys of each class, one per table; label, dimension and table are part of a key."""
    for batch in batches:
        label = [hash_text(x) for x in batch.column("label").to_pylist()]
        size = np.array([len(x) for x in batch.column("e").to_pylist()], np.int64)
        keys = np.zeros((batch.num_rows, tables), np.uint64)
        for d in np.unique(size).tolist():
            rows = np.flatnonzero(size == d)
            rng = np.random.default_rng([SEED, d])
            directions, offset = rng.standard_normal((d, tables * width)), rng.uniform(0, CELL, tables * width)
            cells = np.floor((unit(batch.column("e").take(pa.array(rows))) @ directions + offset) / CELL).astype(np.int64).view(np.uint64)
            out = mix(np.array(label, np.uint64)[rows, None] + np.arange(tables, dtype=np.uint64)[None] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(d))
            for k in range(width):
                out = mix(out + cells[:, k::width])
            keys[rows] = out
        column = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * tables, pa.int32()), pa.array(keys.view(np.int64).ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("size"), batch.column("e"), column], ["node", "size", "e", "keys"])


def hash_text(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode(), SEED)


def compare(table: pa.Table, threshold: float) -> pa.Table:
    """Compare what shares a tile: chunk i against chunk j of one key's classes."""
    key, i, j, own, node, size = (table.column(c).to_numpy() for c in ("key", "i", "j", "own", "node", "size"))
    order = np.lexsort((node, own, j, i, key))
    table = table.take(pa.array(order)).combine_chunks()
    key, i, j, own, node, size = (x[order] for x in (key, i, j, own, node, size))
    vectors = table.column("e").combine_chunks()
    keys = table.column("keys").combine_chunks()
    width = len(keys.flatten()) // max(1, len(keys))
    keys = keys.flatten().to_numpy().reshape(len(node), width)
    new = np.flatnonzero((np.diff(key, prepend=key[:1] - 1) != 0) | (np.diff(i, prepend=-1) != 0) | (np.diff(j, prepend=-1) != 0))
    nodes, links, roots = [], [], []
    for a, b in zip(new.tolist(), [*new[1:].tolist(), len(node)], strict=True):
        if b - a < 2:
            continue
        x, mine = unit(vectors.slice(a, b - a)), keys[a:b]
        table_number = int(np.flatnonzero((mine == key[a]).all(axis=0))[0])
        near = x @ x.T >= threshold
        np.fill_diagonal(near, False)
        if i[a] != j[a]:  # pairs inside a chunk are compared in the chunk's own tile
            near &= own[a:b, None] != own[None, a:b]
        if not near.any():
            continue
        u, v = np.nonzero(near)
        first = (mine[u, :table_number] != mine[v, :table_number]).all(axis=1)  # they meet in no earlier table
        u, v = u[first], v[first]
        many = np.zeros(b - a, np.int64)
        np.add.at(many, u, size[a:b][v])
        root = np.arange(b - a)
        while True:  # least index over links, with jumps
            low = root.copy()
            np.minimum.at(low, u, root[v])
            low = np.minimum(low, low[low])
            if np.array_equal(low, root):
                break
            root = low
        touched = np.flatnonzero(many)
        nodes.append(node[a:b][touched])
        links.append(many[touched])
        roots.append(node[a:b][root[touched]])
    none = np.zeros(0, np.int64)
    return pa.table({"node": np.concatenate([none, *nodes]), "links": np.concatenate([none, *links]), "root": np.concatenate([none, *roots])})
