"""Two-way multiset difference and data-quality checks.

Both sides are read once: their rows are counted per distinct row in one
aggregate over the union, source rows as +1 and target rows as -1.
Copies are combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _counted(source: DataFrame, target: DataFrame) -> DataFrame:
    """Distinct rows with the number of copies on each side (``_s``, ``_t``)."""
    cols = source.columns
    both = (source.withColumns({"_s": F.lit(1), "_t": F.lit(0)})
            .unionByName(target.select(*cols).withColumns({"_s": F.lit(0), "_t": F.lit(1)})))
    return both.groupBy(*cols).agg(F.sum("_s").alias("_s"), F.sum("_t").alias("_t"))


def multiset_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows in source but not target (side='source') and the reverse
    (side='target'), each with multiplicity: EXCEPT ALL both ways."""
    cols = source.columns
    surplus = F.col("_s") - F.col("_t")
    return (_counted(source, target).filter(surplus != 0)
            .withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), F.abs(surplus))))
            .select(*cols, F.when(surplus > 0, "source").otherwise("target").alias("side")))


def diff_summary(name: str, source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: table, source rows, target rows, rows only in each, equal."""
    s, t = F.col("_s"), F.col("_t")
    totals = _counted(source, target).agg(*[
        F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for c, n in (
            (s, "source_rows"), (t, "target_rows"), (F.greatest(s - t, F.lit(0)), "only_in_source"),
            (F.greatest(t - s, F.lit(0)), "only_in_target"))])
    return totals.select(F.lit(name).alias("table_name"), "*",
                         ((F.col("only_in_source") == 0) & (F.col("only_in_target") == 0)).alias("is_equal"))


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("long") for k in keys]), F.lit(buckets)).cast("int")


def bucket_checksums(rows: DataFrame, columns: Sequence[str], bucket: str = "bucket") -> DataFrame:
    """(bucket, rows, sum_a, sum_b): counts and sums of two hashes of the rows of each bucket.  Sums do not depend on the
    order of rows and can be added, so they are combined before the shuffle: a row per bucket and task."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])  # hashes skip nulls
    sums = [F.sum(F.xxhash64(F.lit(seed), nulls, *columns).cast("decimal(20,0)")).alias(name) for seed, name in ((1, "sum_a"), (2, "sum_b"))]
    return rows.groupBy(bucket).agg(F.count("*").alias("rows"), *sums)


def unequal_buckets(source: DataFrame, target: DataFrame, columns: Sequence[str], bucket: str = "bucket") -> tuple[list[int], int, int]:
    """The buckets whose checksums differ (no more than there are buckets), and the rows of each side."""
    s, t = (bucket_checksums(side, columns, bucket) for side in (source, target))
    both = s.select(bucket, F.struct("rows", "sum_a", "sum_b").alias("s")).join(
        t.select(bucket, F.struct("rows", "sum_a", "sum_b").alias("t")), bucket, "full")
    found = both.select(bucket, ~F.col("s").eqNullSafe(F.col("t")), "s.rows", "t.rows").collect()
    return sorted(r[0] for r in found if r[1]), sum(r[2] or 0 for r in found), sum(r[3] or 0 for r in found)


def checksum_summary(name: str, source: DataFrame, target: DataFrame, columns: Sequence[str], bucket: str = "bucket") -> DataFrame:
    """As ``diff_summary``, but only the rows of unequal buckets are compared.  Both sides have a column ``bucket`` by the
    same rule (see ``key_bucket``); where it is a partition column, no other bucket's files are read."""
    unequal, source_rows, target_rows = unequal_buckets(source, target, columns, bucket)
    near = F.col(bucket).isin(unequal)
    found = diff_summary(name, source.filter(near).select(*columns), target.filter(near).select(*columns))
    return found.withColumns({"source_rows": F.lit(source_rows).cast("long"), "target_rows": F.lit(target_rows).cast("long")})


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (a primary-key check); partial
    aggregation combines copies map-side before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)
