"""Exact positions in the order of a 64-bit column, by rounds of histogram refinement.

A round counts rows by the next bits of the value, among those whose
higher bits are already known, so the driver sees counts and never rows.
Partial counts are combined before the shuffle; there is no sort and no
stage over the first n rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP_BITS = 16  # of a round that looks for one position: at most 65,536 counts
CUT_BITS = 8  # of a round that looks for many: at most 256 counts for each range that is still too large


def nth_value(df: DataFrame, value: Column, n: int) -> tuple[int, int] | None:
    """The n-th smallest non-null value (n from 1), and how many are smaller; None if there are fewer."""
    given = df.select(value.cast("long").alias("v")).filter("v IS NOT NULL")
    prefix, below = None, 0
    for shift in range(64 - STEP_BITS, -1, -STEP_BITS):
        rows = given if prefix is None else given.filter(F.shiftright("v", shift + STEP_BITS) == F.lit(prefix))
        counts = rows.groupBy(F.shiftright("v", shift).alias("bin")).agg(F.count("*").alias("n"))
        prefix = None
        for b, count in sorted((r.bin, r.n) for r in counts.collect()):
            if below + count >= n:
                prefix = b
                break
            below += count
        if prefix is None:
            return None
    return prefix, below


def cut_points(df: DataFrame, value: Column, n: int) -> tuple[list[int], int]:
    """Values that cut the rows into ranges [.., cut) of at most n rows, in order, and the number of rows (nulls, which
    belong to the first range, included).  Rows of one value stay together, however many they are."""
    given = df.select(value.cast("long").alias("v"))
    total, nulls = given.agg(F.count("*"), F.count("*") - F.count("v")).first()
    if total <= n:
        return [], total
    bins: list[tuple[int, int]] = []  # (first value, rows), none larger than n unless it is one value
    heavy: list[int] | None = None
    for shift in range(64 - CUT_BITS, -1, -CUT_BITS):
        rows = given.filter("v IS NOT NULL")
        if heavy is not None:
            rows = rows.filter(F.shiftright("v", shift + CUT_BITS).isin(heavy))
        found = [(r.bin, r.n) for r in rows.groupBy(F.shiftright("v", shift).alias("bin")).agg(F.count("*").alias("n")).collect()]
        bins += [(b << shift, count) for b, count in found if count <= n or shift == 0]
        heavy = [b for b, count in found if count > n and shift > 0]
        if not heavy:
            break
    cuts, held = [], nulls
    for first, count in sorted(bins):
        if held and held + count > n:
            cuts.append(first)
            held = 0
        held += count
    return cuts, total
