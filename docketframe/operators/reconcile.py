"""Which rows differ between a table and what was written of it.

Rows fall into buckets by the first bits of a hash of their key.  A bucket's digest is the
sum of the digests of its source rows, less that of its written ones: zero, in
all its lanes, where both sides hold the same.  Only buckets that differ are looked into again by more
bits, so equal rows are read and summed where they lie and never shuffled; the few rows that are
left in the end are compared by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketframe.session import staged

#: Bits by which buckets are split at each level.
LEVEL_BITS = 8
#: Rows of differing buckets that are few enough to be compared by key.
FEW_ROWS = 1_000_000
HASH_BITS = 64


def _lanes(c: Column) -> list[Column]:
    """A 64-bit digest as two numbers whose sums over 2 ** 31 rows fit 64 bits."""
    return [F.shiftrightunsigned(c, 32), c.bitwiseAND(F.lit(0xFFFFFFFF))]


def _sides(source: DataFrame, written: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of both, under the source's columns and types, with _side 1 or -1 and the hash of the key."""
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in source.schema.fields]
    both = source.select(F.lit(1).alias("_side"), "*").unionByName(written.select(F.lit(-1).alias("_side"), *columns))
    return both.withColumn("_hash", F.xxhash64(*key))


def _bucket(bits: int) -> Column:
    return F.shiftrightunsigned("_hash", HASH_BITS - bits)


def _inside(sides: DataFrame, buckets: DataFrame | None, bits: int) -> DataFrame:
    if buckets is None:
        return sides
    return sides.withColumn("_bucket", _bucket(bits)).join(buckets.select("_bucket"), "_bucket", "left_semi").drop("_bucket")


def differing_buckets(
    source: DataFrame,
    written: DataFrame,
    key: Sequence[str],
    few_rows: int = FEW_ROWS,
    level_bits: int = LEVEL_BITS,
) -> tuple[DataFrame, int]:
    """(_bucket, _rows of the buckets that differ; the bits of the hash that name them).

    Stops when these buckets hold ``few_rows`` rows at most, or when a further level
    does not even halve them, which is when most keys differ.
    """
    columns = source.columns
    sides = _sides(source, written, key)
    lanes = [*_lanes(F.xxhash64(*columns)), *_lanes(F.xxhash64(*columns, F.lit(1)))]
    narrow = sides.select("_side", "_hash", *[(F.col("_side") * lane).alias(f"_l{i}") for i, lane in enumerate(lanes)])
    buckets, bits, before = None, 0, None
    while True:
        inside = _inside(narrow, buckets, bits)
        bits += level_bits
        sums = [F.sum("_side").alias("_n"), *[F.sum(f"_l{i}").alias(f"_l{i}") for i in range(len(lanes))]]
        totals = inside.groupBy(_bucket(bits).alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows"), *sums)
        differs = " OR ".join(f"{c} <> 0" for c in ["_n", *[f"_l{i}" for i in range(len(lanes))]])
        buckets = staged(totals.where(differs).select("_bucket", "_rows"))
        rows = buckets.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
        if rows <= few_rows or bits + level_bits > HASH_BITS or (before is not None and 2 * rows > before):
            return buckets, bits
        before = rows


def row_differences(
    source: DataFrame,
    written: DataFrame,
    key: Sequence[str],
    few_rows: int = FEW_ROWS,
    level_bits: int = LEVEL_BITS,
) -> DataFrame:
    """The keys whose rows differ: key columns, ``difference``, ``columns``.

    ``difference`` is ``missing`` (not written), ``extra`` (only written), ``copies`` (as many rows
    on one side as not on the other) or ``changed``; ``columns`` names, for the last, the columns that differ,
    in the source's order and joined by commas.  NULL keys are keys like others, and NULL differs from ''.  Rows
    that share a key are compared as a whole, whatever their order.  ``written`` needs the source's columns by
    name; they are cast to its types.

    Both tables are read once for each level (three for 10 ** 11 rows with few differences) and once at the
    end, so store what is dear to compute.  A key of very many rows is summed before it is shuffled.
    """
    buckets, bits = differing_buckets(source, written, key, few_rows, level_bits)
    suspects = _inside(_sides(source, written, key), buckets, bits)
    others = [c for c in source.columns if c not in key]
    lanes = {c: _lanes(F.xxhash64(c)) for c in others}
    whole = [*_lanes(F.xxhash64(*source.columns)), *_lanes(F.xxhash64(*source.columns, F.lit(1)))]
    by_key = suspects.groupBy(*key).agg(
        F.count_if(F.col("_side") == 1).alias("_source"),
        F.count_if(F.col("_side") == -1).alias("_written"),
        F.array(*[F.sum(F.col("_side") * lane) for lane in whole]).alias("_whole"),
        *[F.array(*[F.sum(F.col("_side") * lane) for lane in own]).alias(f"_d_{c}") for c, own in lanes.items()],
    )
    uneven = F.exists("_whole", lambda x: x != 0)
    names = [F.when(F.exists(f"_d_{c}", lambda x: x != 0), F.lit(c)) for c in others]
    difference = (
        F.when(F.col("_written") == 0, "missing")
        .when(F.col("_source") == 0, "extra")
        .when(F.col("_source") != F.col("_written"), "copies")
        .otherwise("changed")
    )
    return (
        by_key.where(uneven | (F.col("_source") != F.col("_written")))
        .select(*key, difference.alias("difference"), F.concat_ws(",", *names).alias("columns"))
        .withColumn("columns", F.when(F.col("difference") == "changed", F.col("columns")).otherwise(""))
    )
