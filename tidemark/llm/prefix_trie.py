"""The trie of conversation prefixes, built by a van Emde Boas recursion over depth.

Sequences are cut at half depth, and the prefixes at the cut are named;
the trie above the cut and the forests below it, one below each name, are
built by the same rule, all of them at once.  A name is a digest of the
sequence it stands for, made of the digests of its two halves, so equal
prefixes of different conversations get one name and a round costs one
shuffle, whatever the number of subproblems.  Subproblems of ``LEAF``
turns lie in one row and are solved there.  So a conversation of n turns
takes log2(n / LEAF) rounds of naming, and no task holds more of it than
``LEAF`` turns: one conversation may have a third of all rows.

Totals of subtrees go the other way: first those inside the smallest
forests; then, cut by cut from the lowest up, the total of each tree
below a cut is grafted onto all nodes between that cut and the one above.

Order of turns: null first, equal ones by a digest of role and text.
Null roles and texts are empty; rows without a conversation id belong to
no conversation.  Repeated rows are turns of their own.  Names are
128-bit digests; equal digests count as equal turns.  An empty table has
no node, not even a root.  Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, quoted, small_batches

LEAF_BITS = 3
LEAF = 1 << LEAF_BITS  # turns of the smallest subproblem
WORD = r"[^\x20\x09-\x0D]+"
CHUNK = 1 << 13  # ids of a chunk of members' ids


def digest(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


ROOT = hashlib.md5(b"").digest()


def number_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, part, pos, name, words): each turn with its place in its conversation, its digest and the words of its text.

    Rows are range-partitioned by conversation and turn and numbered where they lie; a conversation that spans
    several partitions continues the numbers by one row of counts for each."""
    said, who = (F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")) for c in (text, role))
    rows = turns.filter(F.col(quoted(conv)).isNotNull()).select(
        F.col(quoted(conv)).cast("long").alias("conv"), F.col(quoted(turn)).alias("turn"),
        digest(F.octet_length(who).cast("string"), F.lit(":"), who, said).alias("name"), F.regexp_count(said, F.lit(WORD)).alias("words"))
    order = ["conv", "turn", "name"]
    lying = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()).drop("turn")
    lying = materialize(lying, "turns").withColumns({"part": F.shiftright("place", 33), "place": F.col("place").bitwiseAND((1 << 33) - 1)})
    runs = lying.groupBy("conv", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("conv", "part", (before - F.col("first")).alias("shift"))
    return lying.join(runs, ["conv", "part"]).select("conv", "part", (F.col("place") + F.col("shift")).alias("pos"), "name", "words")


def rebuilt(numbered: DataFrame, family: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """The turns (conv, pos, name, words) and lengths (conv, length) of all conversations, in each conversation c the first
    h turns replaced by those of c - c % family; h = crc32(c) % most.  A conversation can be left without a turn."""
    numbered = materialize(numbered, "numbered")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    heads = numbered.filter((F.col("pos") < most - 1) & (F.col("conv") % family == 0)).groupBy(F.col("conv").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "name", "words"))).alias("head"))  # most - 1 turns at most
    convs = numbered.groupBy("conv").agg(F.count("*").alias("n")).withColumns({"h": h, "base": F.col("conv") - F.col("conv") % family})
    head = F.when(F.col("head").isNotNull(), F.slice("head", 1, F.col("h").cast("int")))
    convs = convs.join(heads, "base", "left").withColumns({"head": head, "taken": F.coalesce(F.array_size(head), F.lit(0)).cast("long")})
    convs = materialize(convs.select("conv", "h", "head", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "convs")
    # a shorter head moves the conversation's other turns; a row of counts per partition tells them, however many they are
    less = convs.filter("taken < h").select("conv", (F.col("taken") - F.col("h")).alias("less"))
    runs = numbered.select("conv", "part").distinct().join(less, "conv")
    own = numbered.filter(F.col("pos") >= h).join(runs, ["conv", "part"], "left").select(
        "conv", (F.col("pos") + F.coalesce("less", F.lit(0))).alias("pos"), "name", "words")
    borrowed = convs.select("conv", F.explode("head").alias("t")).select("conv", "t.pos", "t.name", "t.words")
    return own.unionByName(borrowed), convs.select("conv", "length")


def segments(rows: DataFrame) -> DataFrame:
    """(conv, seg, turns): ``LEAF`` turns of a conversation in a row."""
    turn = F.struct("pos", "name", "words")
    return rows.groupBy("conv", F.shiftright("pos", LEAF_BITS).alias("seg")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def names_of_cuts(blocks: DataFrame, last: int) -> DataFrame:
    """(conv, i, name): the name of the prefix before block ``i`` > 0 of each conversation.

    ``blocks``: (conv, i, name), the name of each block by itself (the largest of several), ``i`` up to ``last``.  Blocks are taken in pairs,
    the cuts between pairs are named by the same rule, and a cut inside a pair by the name of the cut before the
    pair and the pair's first block."""
    if last < 1:
        return blocks.filter(F.lit(False)).select("conv", "i", "name")
    odd = F.col("i").bitwiseAND(1) == 1
    pairs = blocks.groupBy("conv", F.shiftright("i", 1).alias("i")).agg(
        F.max(F.when(~odd, F.col("name"))).alias("left"), F.max(F.when(odd, F.col("name"))).alias("right"))
    pairs = materialize(pairs.filter("i > 0 OR right IS NOT NULL"), "pairs")  # of one block alone no cut is asked
    pair = digest(F.col("left"), F.coalesce("right", F.lit(b"")))  # after a block alone nothing follows that would use its name
    upper = names_of_cuts(pairs.select("conv", "i", pair.alias("name")), last >> 1)
    named = pairs.join(upper, ["conv", "i"], "left").withColumn("name", F.when(F.col("i") == 0, F.lit(ROOT)).otherwise(F.col("name")))
    at = lambda i, name: F.struct(i.alias("i"), name.alias("name"))
    both = F.array(at(F.col("i") * 2, F.col("name")), F.when(F.col("right").isNotNull(), at(F.col("i") * 2 + 1, digest(F.col("name"), F.col("left")))))
    cuts = named.select("conv", F.explode(F.array_compact(both)).alias("c")).select("conv", "c.i", "c.name").filter("i > 0")
    return materialize(cuts, "cuts")


def paths(rows: DataFrame) -> tuple[DataFrame, int]:
    """(conv, seg, path, words): the names of the prefixes that end in the segment, after that of the prefix before it;
    and the last segment's number."""
    segs = materialize(segments(rows), "segments")
    last = segs.agg(F.max("seg")).first()[0] or 0
    full = F.size("turns") == LEAF
    fold = F.aggregate("turns", F.lit(b""), lambda name, t: digest(name, t["name"]))
    # a block for every cut to name, also one after the last turns; one that is not full is followed by none that uses its name
    block = lambda i, name: F.struct(i.alias("i"), name.alias("name"))
    ends = F.array(block(F.col("seg"), F.when(full, fold).otherwise(F.lit(b""))), F.when(full, block(F.col("seg") + 1, F.lit(b""))))
    blocks = segs.filter(full | (F.col("seg") > 0)).select("conv", F.explode(F.array_compact(ends)).alias("b")).select("conv", "b.i", "b.name")
    cuts = names_of_cuts(blocks, last + 1)
    entry = F.when(F.col("seg") == 0, F.lit(ROOT)).otherwise(F.col("entry"))
    path = F.aggregate("turns", F.array(entry), lambda names, t: F.concat(names, F.array(digest(F.element_at(names, -1), t["name"]))))
    whole = F.when(full, F.concat(F.slice(path, 1, LEAF), F.array("exit"))).otherwise(path)
    named = (segs.join(cuts.select("conv", F.col("i").alias("seg"), F.col("name").alias("entry")), ["conv", "seg"], "left")
             .join(cuts.select("conv", (F.col("i") - 1).alias("seg"), F.col("name").alias("exit")), ["conv", "seg"], "left")
             .select("conv", "seg", whole.alias("path"), F.transform("turns", lambda t: t["words"].cast("long")).alias("words")))
    return materialize(named, "paths"), last


def prefix_trie(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per node: ``name``, ``parent``, ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    ``rows``: (conv, pos, name, words), the turns; ``lengths``: (conv, length), all conversations."""
    named, last = paths(rows)
    tails = lengths.filter("length > 0").withColumn("seg", F.shiftright(F.col("length") - 1, LEAF_BITS))
    seen = named.join(tails, ["conv", "seg"], "left").select("conv", "seg", "words", "path", "length", F.posexplode("path").alias("i", "name")).filter("i > 0")
    depth = F.shiftleft("seg", LEAF_BITS) + F.col("i")
    members = seen.select("name", "conv", depth.alias("depth"), F.element_at("path", F.col("i")).alias("parent"),
                          F.element_at("words", F.col("i")).alias("words"), F.coalesce(depth == F.col("length"), F.lit(False)).cast("long").alias("ends"))
    nodes = members.groupBy("name").agg(
        F.min("conv").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.count("*").alias("n_convs"),
        F.sum("ends").alias("ends"), F.min("words").alias("words"))
    leaf, saved = (F.col("ends") == F.col("n_convs")).cast("long"), (F.col("n_convs") - 1) * F.col("words")
    nodes = materialize(nodes.select("name", "conv_id", "depth", "parent", "n_convs", leaf.alias("leaf"), saved.alias("saved")), "nodes")
    root = lengths.groupBy(F.lit(ROOT).alias("name")).agg(
        F.min("conv").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("parent"),
        F.count("*").alias("n_convs"), F.min(F.col("length") == 0).cast("long").alias("leaf"), F.lit(0).cast("long").alias("saved"))
    every = nodes.unionByName(root)
    totals = subtree_totals(nodes, named, last).unionByName(
        every.groupBy(F.lit(ROOT).alias("name")).agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens")))
    children = nodes.groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    ends = seen.filter(depth == F.col("length")).select("name", "conv").unionByName(
        lengths.filter("length = 0").select(F.lit(ROOT).alias("name"), "conv"))
    parents = every.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nothing = hashlib.sha256(b"").hexdigest()
    return (every.drop("leaf", "saved").join(totals, "name").join(children, "name", "left").join(members_digest(ends), "name", "left")
            .withColumns({"n_children": F.coalesce("n_children", F.lit(0)), "ends_sha256": F.coalesce("ends_sha256", F.lit(nothing))})
            .join(parents, "parent", "left"))


def subtree_totals(nodes: DataFrame, named: DataFrame, last: int) -> DataFrame:
    """(name, n_leaves, saved_tokens) of the subtree of each node but the root."""
    place = F.col("depth") - 1
    own = nodes.groupBy(F.col("conv_id").alias("conv"), F.shiftright(place, LEAF_BITS).alias("seg")).agg(
        F.collect_list(F.struct("depth", "leaf", "saved")).alias("own"))  # a segment's nodes at most
    depth = (F.shiftleft("seg", LEAF_BITS) + F.col("i"))
    below = F.filter("own", lambda x: x["depth"] >= depth)
    add = lambda field: F.aggregate(below, F.lit(0).cast("long"), lambda a, x: a + x[field])
    inside = (named.join(own, ["conv", "seg"]).select("conv", "seg", "own", F.posexplode("path").alias("i", "name")).filter("i > 0")
              .select("name", "conv", depth.alias("depth"), add("leaf").alias("leaves"), add("saved").alias("saved")))
    found = [summed(inside)]
    for bits in range(LEAF_BITS, max(LEAF_BITS, LEAF_BITS + last.bit_length())):
        # the roots of trees below the cuts of this level, with all that was grafted inside them
        cut = (F.shiftright(place, bits).bitwiseAND(1) == 1) & (place.bitwiseAND((1 << bits) - 1) == 0)
        roots = summed(union(f.filter(cut) for f in found)).select("conv", (F.shiftright(place, bits) - 1).alias("block"), "leaves", "saved")
        above = named.withColumn("block", F.shiftright("seg", bits - LEAF_BITS)).join(roots, ["conv", "block"])
        grafted = above.select("conv", "seg", "leaves", "saved", F.posexplode("path").alias("i", "name")).filter("i > 0")
        found.append(summed(grafted.select("name", "conv", depth.alias("depth"), "leaves", "saved")))
    return union(found).groupBy("name").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def summed(parts: DataFrame) -> DataFrame:
    """One row per node: what its members bring to it.  Any member leads to the node's ancestors."""
    return materialize(parts.groupBy("name").agg(F.min("conv").alias("conv"), F.min("depth").alias("depth"), F.sum("leaves").alias("leaves"),
                                                 F.sum("saved").alias("saved")), "totals")


def union(parts) -> DataFrame:
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def members_digest(ends: DataFrame) -> DataFrame:
    """(name, ends_sha256): the digest of each name's ids, ascending, comma-joined.  Ids are sorted over all tasks and
    joined to chunks there; a digest then runs over its chunks as they come, whatever their number."""
    small_batches(ends.sparkSession)
    order = ["name", "conv"]
    sorted_ids = ends.repartitionByRange(*order).sortWithinPartitions(*order).select(*order)
    chunks = sorted_ids.mapInArrow(joined, "name binary, conv long, ids string")
    return chunks.repartition("name").sortWithinPartitions(*order).mapInArrow(hashed, "name binary, ends_sha256 string")


def joined(batches):
    for batch in batches:
        names, ids = batch.column("name").to_pylist(), batch.column("conv").to_pylist()
        out, at = [], 0
        for i in range(1, len(names) + 1):
            if i == len(names) or names[i] != names[at] or i - at == CHUNK:
                out.append((names[at], ids[at], ",".join(map(str, ids[at:i]))))
                at = i
        columns = list(zip(*out, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
                                         ["name", "conv", "ids"])


def hashed(batches):
    name, state = None, None
    for batch in batches:
        out = []
        for key, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if key == name:
                state.update(b"," + ids.encode())
                continue
            if name is not None:
                out.append((name, state.hexdigest()))
            name, state = key, hashlib.sha256(ids.encode())
        yield digests(out)
    if name is not None:
        yield digests([(name, state.hexdigest())])


def digests(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())],
                                      ["name", "ends_sha256"])


def conversation_trie(turns: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """The trie of the conversations of ``turns`` (conv_id, turn, role, text), rebuilt within families."""
    rows, lengths = rebuilt(number_turns(turns), family, most)
    return prefix_trie(rows, lengths)
