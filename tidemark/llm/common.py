"""Shared Spark helpers of the operators."""

from __future__ import annotations

import contextlib
import ctypes
import math
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import checkpoint_root, work_dir

BATCH_BYTES = 4 << 20  # of an Arrow batch between the JVM and a Python worker
BLOCK_BYTES = 24 << 20  # text bytes that one task holds at a time


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new Parquet table under ``spark.checkpoint.dir`` and read it: cuts the
    lineage, and survives the loss of executors."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def share(spark: SparkSession, value: object) -> Callable[[], object]:
    """Broadcast ``value``; the function returned gives it inside tasks.  Classes of this subpackage go by value."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(sent.value)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame, text: str) -> int:
    return docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes: ten thousand long texts at once are too much for either side."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":  # Spark's default; another value is the user's choice
        spark.conf.set(name, BATCH_BYTES)


def trim() -> None:
    """Give back to the system what a block has used: workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def trimmed(step: Callable) -> Callable:
    """A block's or bucket's step that leaves no freed memory behind."""

    def done(out: pa.Table) -> pa.Table:
        trim()
        return out

    if step.__code__.co_argcount == 1:  # Spark looks at the number of arguments
        return lambda table: done(step(table))
    return lambda table, other: done(step(table, other))


def block_count(docs: DataFrame, text: str, block_bytes: int = BLOCK_BYTES) -> int:
    """How many blocks of documents hold at most about ``block_bytes`` of text each."""
    return max(partitions(docs.sparkSession), math.ceil(text_bytes(docs, text) / block_bytes))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def packed(docs: DataFrame, key: str, text: str, carry: list[str] | None = None) -> DataFrame:
    """One struct column ``doc`` with fields ``id``, ``text`` and ``row`` (the carried columns), so
    that no other column name can clash."""
    small_batches(docs.sparkSession)
    carry = [c for c in docs.columns if c != text] if carry is None else carry
    row = F.struct(*[F.col(quoted(c)) for c in carry]) if carry else F.lit(None).cast("struct<none:int>")
    return docs.select(F.struct(F.col(quoted(key)).cast("long").alias("id"), F.col(quoted(text)).cast("string").alias("text"),
                                row.alias("row")).alias("doc"))


def result(packed_docs: DataFrame, ddl: str) -> T.StructType:
    """Schema of ``row`` and the columns of ``ddl``."""
    return T.StructType([packed_docs.schema["doc"].dataType["row"], *T.StructType.fromDDL(ddl).fields])


def blocks(packed_docs: DataFrame, n: int) -> DataFrame:
    """Documents dealt by id into n blocks; rows of equal id share a block.  Both readers of the
    result share one shuffle (the plan reuses the exchange)."""
    return packed_docs.withColumn("block", F.pmod(F.xxhash64("doc.id"), F.lit(n)).cast("int")).repartition(n, "block")


def field(table: pa.Table | pa.RecordBatch, name: str) -> pa.Array:
    column = table.column("doc")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):  # an empty table has no chunk
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return column.field(name)


def texts(table: pa.Table | pa.RecordBatch) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [t or b"" for t in field(table, "text").cast(pa.binary() if pa.types.is_string(field(table, "text").type) else pa.large_binary()).to_pylist()]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (u, v: long) as (node, component = smallest node).

    Alternating star contraction: every round links each node's larger
    neighbours, then its smaller ones, to the smallest node it knows, so
    the rounds grow with the logarithm of the longest chain.  A hub's
    edges meet in joins that adaptive execution can split; minima are
    combined before they are shuffled.  Edges are checkpointed each round.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
    edges = checkpointed(edges)
    mark = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = checkpointed(small.select("e.u", "e.v").filter("u > v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == mark:
            break
        mark = now
    low = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return low.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
