"""Operators over whole tables of case records."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketframe import rules
from docketframe.functions.clean import clean_content, is_blank
from docketframe.functions.text import blank_to_null, chunk_id, display_cut
from docketframe.session import staged

# monotonically_increasing_id() holds the task in the upper bits and the row
# within the task in the lower 33.
ROW_BITS = 33

RowWise = Callable[[DataFrame], DataFrame]


def merge_parts(*parts: DataFrame) -> DataFrame:
    """UNION ALL of any number of parts; ``part_no`` (1…) keeps their order."""
    return reduce(
        DataFrame.unionByName,
        [p.withColumn("part_no", F.lit(i)) for i, p in enumerate(parts, 1)],
    )


#: Rows for which a range of an ordered table is laid out, if there are few.
RANGE_ROWS = 4096


def _sampled(narrow: DataFrame, per_task: int) -> DataFrame:
    """At most ``per_task`` rows of each task, evenly drawn; ``_w`` is how many rows each stands for."""
    columns = narrow.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw, n = np.random.default_rng(TaskContext.get().partitionId()), 0
        kept, order = None, np.zeros(0)
        for batch in batches:
            n += len(batch)
            drawn = draw.random(len(batch))
            if len(order) >= per_task:
                better = drawn < order.max()
                batch, drawn = batch.filter(pa.array(better)), drawn[better]
            both = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
            order = np.concatenate([order, drawn])
            best = np.argsort(order)[:per_task]
            kept, order = both.take(pa.array(best)), order[best]
        if kept is not None and len(kept):
            yield from kept.append_column("_w", pa.array(np.full(len(kept), n / len(kept)))).combine_chunks().to_batches()

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields)
    return narrow.mapInArrow(run, f"{kinds}, _w double").select(*columns, "_w")


def range_bounds(narrow: DataFrame) -> list[Row]:
    """Where to cut a table into ranges of about as many rows each, from its sort keys alone.

    What is collected are a few rows of each task, as Spark's own range partitioning does.
    """
    spark = narrow.sparkSession
    most, cores = int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    sample = _sampled(narrow, max(40, 20 * most // cores)).orderBy(*narrow.columns).collect()
    weights = np.cumsum([r["_w"] for r in sample])
    n = min(most, max(cores, int(weights[-1]) // RANGE_ROWS)) if sample else 1
    cuts = np.searchsorted(weights, np.arange(1, n) * (weights[-1] / n)) if sample else []
    return [sample[i] for i in dict.fromkeys(cuts.tolist())] if n > 1 else []


def range_of(bounds: Sequence[Row], keys: Sequence[T.StructField]) -> Column:
    """How many bounds a row's keys reach, found in two steps of a square root's length each."""
    if not bounds:
        return F.lit(0)
    key = F.struct(*[F.col(f.name) for f in keys])
    points = [F.struct(*[F.lit(b[f.name]).cast(f.dataType).alias(f.name) for f in keys]) for b in bounds]

    def reached(points: Column) -> Column:
        return F.size(F.filter(points, lambda p: p <= key))

    width = math.isqrt(len(points)) + 1
    groups = [points[i : i + width] for i in range(0, len(points), width)]
    if len(groups) == 1:
        return reached(F.array(*points))
    group = reached(F.array(*[g[0] for g in groups[1:]]))
    return group * width + reached(F.get(F.array(*[F.array(*g) for g in groups]), group))


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    seq: str = "seq",
    start: int = 0,
    then: RowWise = lambda df: df,
    stage_path: str | None = None,
    place: str | None = None,
) -> DataFrame:
    """Number all rows ``start + 1 …`` without gaps, in the order given.

    A window over all rows would put them into one task.  Here the rows are
    dealt to ranges and sorted, each task counts its own rows from zero, and
    what the earlier tasks hold is added.  Rows that tie on ``order_by`` keep
    scan order; that distinct tie-breaker also lets the range boundaries cut
    through a block of equal keys or of copies, however large it is.

    The ranges come from a first pass that reads the sort keys only, so the rows as
    a whole are read and shuffled once.  ``then`` (row-wise) runs after the sort.  The ordered
    table is written once, because numbers must not change when a task is run
    again; the count per task reads one column of it.

    ``place`` names a further column: where in the written table a row stands.  It is the same
    for rows that one task reads, and grows with the numbers.
    """
    spark = df.sparkSession
    keys = [*order_by, "_tie"]
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    narrow = tied.select(*keys)
    bounds = range_bounds(narrow)
    ordered = (
        tied.repartitionById(len(bounds) + 1, range_of(bounds, narrow.schema.fields))
        .sortWithinPartitions(*keys)
        .drop("_tie", seq)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    table = staged(then(ordered), stage_path)

    task = F.shiftright("_at", ROW_BITS)
    # One row per writing task, so no more than there are shuffle partitions.
    sizes = dict(table.groupBy(task.alias("task")).count().collect())
    base, offsets = start, []
    for t in sorted(sizes):
        offsets.append((t, base))
        base += sizes[t]
    offsets_df = spark.createDataFrame(offsets, "_task bigint, _base bigint")
    row = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    columns = [c for c in table.columns if c != "_at"]
    if place:
        # By task, and by part of its file where that is large enough to be split.
        part = F.lpad(F.col("_metadata.file_block_start").cast("string"), 15, "0")
        table = table.withColumn(place, F.concat_ws("_", F.lpad(task.cast("string"), 8, "0"), part))
        columns.append(place)
    return (
        table.withColumn("_task", task)
        .join(F.broadcast(offsets_df), "_task")
        .select((F.col("_base") + row + 1).alias(seq), *columns)
    )


def continue_numbers(
    done: DataFrame, fresh: DataFrame, order_by: Sequence[str], seq: str = "seq"
) -> DataFrame:
    """Number new rows on from the highest number already given."""
    last = done.agg(F.max(seq).alias("last")).first()["last"] or 0
    return number_rows(fresh, order_by, seq, start=last)


def with_clean_body(df: DataFrame, noise: Sequence[str] = rules.NOISE_PATTERNS) -> DataFrame:
    """Replace ``body`` by its cleaned form; ``raw_chars`` keeps the old length."""
    return df.withColumns(
        {
            "raw_chars": F.length(F.coalesce("body", F.lit(""))),
            "body": clean_content(F.col("body"), noise),
        }
    )


def merge_and_clean(
    *parts: DataFrame,
    order_in_part: str = "seq",
    noise: Sequence[str] = rules.NOISE_PATTERNS,
    then: RowWise = lambda df: df,
    stage_path: str | None = None,
    place: str | None = None,
) -> DataFrame:
    """Parts, one after the other, cleaned and numbered 1 … N.

    ``then`` is further row-wise work to be stored in the same pass.
    """
    merged = merge_parts(*[p.withColumn("_in_part", F.col(order_in_part)) for p in parts])
    return number_rows(
        merged,
        ["part_no", "_in_part"],
        then=lambda df: then(with_clean_body(df, noise)),
        stage_path=stage_path,
        place=place,
    ).drop("_in_part")


def part_counts(df: DataFrame, part: str = "part_no") -> DataFrame:
    """Rows per part, and in all (the row whose part is NULL)."""
    return df.rollup(part).agg(F.count(F.lit(1)).alias("n_rows"))


def corpus_stats(df: DataFrame, body: str = "body", raw_chars: str = "raw_chars") -> DataFrame:
    """One row of counts over cleaned bodies; the mean is NULL on no rows."""
    chars = F.length(F.coalesce(body, F.lit("")))
    n, total = F.count(F.lit(1)), F.coalesce(F.sum(chars.cast("bigint")), F.lit(0))
    empty = F.count_if(is_blank(F.col(body)))
    return df.agg(
        n.alias("total_rows"),
        F.count_if(chars < F.col(raw_chars)).alias("cleaned_rows"),
        total.alias("total_chars"),
        empty.alias("empty_rows"),
        (n - empty).alias("valid_rows"),
        F.call_function("div", total, F.nullif(n, F.lit(0))).alias("mean_chars"),
    )


def success_counts(df: DataFrame, body: str = "body") -> DataFrame:
    """How many records got a body."""
    return df.agg(
        F.count_if(F.col(body).isNotNull()).alias("n_ok"), F.count(F.lit(1)).alias("n_total")
    )


def collected(df: DataFrame, target: int = rules.TARGET_COUNT) -> DataFrame:
    """Rows collected so far against the target."""
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("n_collected"),
        F.lit(target).alias("target"),
        (n >= target).cast("int").alias("reached"),
    )


def reconcile(source: DataFrame, written: DataFrame) -> DataFrame:
    """Rows on both sides, their difference, and whether the contents agree.

    Contents are compared by an order-free checksum, in the same single pass.
    """

    def side(df: DataFrame, ours: int) -> DataFrame:
        checksum = F.xxhash64(*[F.col(c) for c in sorted(df.columns)]).cast("decimal(20,0)")
        return df.select(
            F.lit(ours).alias("a"), F.lit(1 - ours).alias("b"), checksum.alias("checksum")
        )

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    a, b = total(F.col("a")), total(F.col("b"))
    sums = [total(F.when(F.col(x) == 1, F.col("checksum"))) for x in "ab"]
    return (
        side(source, 1)
        .unionByName(side(written, 0))
        .agg(
            a.alias("source_rows"),
            b.alias("written_rows"),
            F.abs(a - b).alias("difference"),
            (sums[0] == sums[1]).cast("int").alias("same_content"),
        )
    )


def preview(df: DataFrame, n: int = 3, seq: str = "seq") -> DataFrame:
    """The first rows, shortened for reading.

    A first pass over ``seq`` alone finds the last number shown, so that dear columns are
    computed of these rows only and not of all that are sorted.
    """
    numbers = [r[0] for r in df.select(seq).orderBy(seq).limit(n).collect()]
    if len(numbers) == n:
        last = F.lit(numbers[-1]).cast(df.schema[seq].dataType)
        df = df.where(F.col(seq).isNull() | (F.col(seq) <= last))

    def shown(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(""))

    def or_empty(c: Column) -> Column:
        return F.coalesce(blank_to_null(c), F.lit("(空)"))

    return (
        df.orderBy(seq)
        .limit(n)
        .select(
            seq,
            display_cut(shown("title"), 50).alias("title"),
            shown("court").alias("court"),
            shown("case_no").alias("case_no"),
            or_empty(shown("gender")).alias("gender"),
            F.concat(or_empty(F.left(shown("verdict"), F.lit(60))), F.lit("...")).alias("verdict"),
            F.length(shown("body")).alias("body_chars"),
        )
    )


def first_rows(df: DataFrame, order_by: str, n: int) -> DataFrame:
    """Exactly the first ``n`` rows (top-k, no full sort)."""
    return df.orderBy(order_by).limit(n)


def numbered_slice(
    df: DataFrame, skip: int = 0, n: int | None = None, seq: str = "seq"
) -> DataFrame:
    """Skip and cap on a table numbered 1 … N: a filter, no sort."""
    out = df.where(F.col(seq) > skip)
    return out if n is None else out.where(F.col(seq) <= skip + n)


def not_collected(todo: DataFrame, done: DataFrame, key: str = "link") -> DataFrame:
    """Rows of ``todo`` whose key has not been collected yet.

    Copies of a key in ``done`` are first reduced to a few per key, sliced by
    task so that this reduction has no hot group; the join then still shuffles
    both sides itself, which is what lets AQE split a skewed key of ``todo``.
    """
    seen = (
        done.select(key, (F.spark_partition_id() % 64).alias("slice")).distinct().select(key)
    )
    return todo.join(seen, key, "left_anti")


def chunked(df: DataFrame, size: int, value: str, seq: str = "seq") -> DataFrame:
    """Consecutive blocks of ``size`` rows as arrays; the last may be short."""
    pair = F.struct(F.col(seq).alias("s"), F.col(value).alias("v"))
    return (
        df.groupBy(chunk_id(F.col(seq), size).alias("chunk_id"))
        .agg(F.array_sort(F.collect_list(pair)).alias("rows"))
        .select("chunk_id", F.transform("rows", lambda r: r["v"]).alias("items"))
    )


def matching(
    df: DataFrame,
    keyword: str = rules.KEYWORD,
    body: str = "body",
    years: tuple[int, int] | None = None,
    date: str = "date",
) -> DataFrame:
    """Rows whose body contains the keyword, optionally within a range of years."""
    out = df.where(F.contains(F.col(body), F.lit(keyword)))
    if years:
        out = out.where(F.left(F.col(date), F.lit(4)).try_cast("int").between(*years))
    return out
