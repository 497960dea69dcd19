"""Large CSV parts and JSON arrays, each file read by many tasks.

A record may span lines, so where one begins depends on everything before it:
on whether a quote is open there and, in JSON, on how many brackets are.  Both
add up.  A first pass measures each byte block by itself: by how much it changes
them if it begins inside a quote, and if not.  A running sum over
the blocks, one row each, then says how every block begins, and a second pass
cuts all blocks at once.  Only what a block's edges cut through, at most one
record an edge, is put together again afterwards.

Spark's text reader does the splitting, so any file system will do, and
``spark.sql.files.maxPartitionBytes`` sets the size of a block.  Files may be plain, or
``packed``: written in frames (:mod:`docketframe.sources.frames`).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import nullcontext
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketframe import schema
from docketframe.session import ship_package, staged
from docketframe.sources import frames
from docketframe.sources.tables import CSV_OPTIONS, part_columns

#: Up to this many blocks (16 TB at 128 MB each) what is known of them goes to every task, some 40 bytes a block; beyond, units are shuffled to it.
BROADCAST_BLOCKS = 131_072

RECORD, HEAD, INNER, TAIL = range(4)
PIECES = "file long, block long, kind int, first boolean, text string"
MEASURED = "file long, block long, odd int, rise_out long, rise_in long, marked boolean"

#: Of each unit: 1 if it opens or closes a quote; by how much it changes the depth if it begins outside, and inside, a quote.
Measure = Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Format:
    """How a file is cut: into units at ``separator``, of which records are made.

    A unit that begins outside quotes, at the depth of the file's records, begins a record.
    ``end`` is what the last separator of a record takes away.  ``marked``, on a file's first
    unit, says whether its records lie in a list, or else whether its lines end in ``\\r\\n``.
    ``measured`` makes MEASURED of all units.
    """

    separator: str
    end: str
    measure: Measure
    marked: Callable[[str], bool]
    nested: bool
    measured: Callable[[DataFrame, Format], DataFrame]


def _measure_csv(lines: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).astype(np.int64) & 1
    return odd, np.zeros_like(odd), np.zeros_like(odd)


_ESCAPED = re.compile(r"\\.", re.DOTALL)


def _rise(text: str) -> int:
    return text.count("{") + text.count("[") - text.count("}") - text.count("]")


def _measure_json(units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    out = np.zeros((3, len(units)), np.int64)
    for i, unit in enumerate(units.to_pylist()):
        parts = (_ESCAPED.sub("", unit) if "\\" in unit else unit).split('"')
        odd = (len(parts) - 1) & 1
        # The bracket that ends a unit counts unless it stands inside a quote.
        out[:, i] = odd, _rise("".join(parts[::2])) - (1 - odd), _rise("".join(parts[1::2])) - odd
    return out[0], out[1], out[2]


def _measured_csv(lines: DataFrame, form: Format) -> DataFrame:
    """By expressions: lines are short and many, so that sending each to Python is dear."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"')))
    # A block is one split, which one task reads in order.
    ends = (F.col("block") == 0) & F.first(F.endswith("value", F.lit("\r")))
    return lines.groupBy("file", "block").agg(
        (F.sum(quotes) % 2).cast("int").alias("odd"),
        F.lit(0).cast("long").alias("rise_out"),
        F.lit(0).cast("long").alias("rise_in"),
        ends.alias("marked"),
    )


def _units(spark: SparkSession, path: str | list[str], form: Format, packed: bool = False) -> DataFrame:
    """The units of plain files, or the frames of packed ones."""
    read = spark.read.text(path, lineSep=frames.MARK if packed else form.separator)
    value = F.col("value").cast("binary") if packed else F.col("value")
    return read.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), value.alias("value")
    )


def _of_units(run: Callable, form: Format, packed: bool) -> Callable:
    """A function of batches of units for those that :func:`_units` gives."""
    if not packed:
        return run
    return lambda batches: run(frames.unpacked(batches, form.separator))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """Parts of batches that lie in one block, with the block."""
    for batch in batches:
        files, blocks = (batch[c].to_numpy() for c in ("file", "block"))
        edges = (np.flatnonzero((np.diff(files) != 0) | (np.diff(blocks) != 0)) + 1).tolist()
        for s, e in zip([0, *edges], [*edges, len(batch)]):
            if s < e:
                yield (int(files[s]), int(blocks[s])), batch.slice(s, e - s)


def _before(odd: np.ndarray, rise_out: np.ndarray, rise_in: np.ndarray, inside: int, depth: int):
    """(inside a quote, depth) before each unit, and after the last."""
    states = np.concatenate([[inside], inside + np.cumsum(odd)]) & 1
    depths = np.concatenate([[depth], depth + np.cumsum(np.where(states[:-1] == 1, rise_in, rise_out))])
    return states, depths


def _measured(form: Format):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list] = {}
        for key, part in _slices(batches):
            known = sums.get(key)
            if known is None:
                known = sums[key] = [0, 0, 0, key[1] == 0 and form.marked(part["value"][0].as_py())]
            measures = form.measure(part["value"])
            # Whatever it begins with, and with the opposite.
            states, outside = _before(*measures, known[0], known[1])
            _, inside = _before(*measures, 1 - known[0], known[2])
            known[:3] = int(states[-1]), int(outside[-1]), int(inside[-1])
        rows = [(*key, *known) for key, known in sums.items()]
        names = [c.split()[0] for c in MEASURED.split(", ")]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_())
        columns = zip(*rows) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def _measured_units(units: DataFrame, form: Format, packed: bool = False) -> DataFrame:
    return units.mapInArrow(_of_units(_measured(form), form, packed), MEASURED)


CSV = Format("\n", "", _measure_csv, lambda line: line.endswith("\r"), False, _measured_csv)
JSON = Format("}", "}", _measure_json, lambda unit: unit.lstrip("\ufeff \t\r\n").startswith("["), True, _measured_units)


def _begins(measured: DataFrame) -> DataFrame:
    """How each block begins: inside a quote or not, and how deep; and whether its file is marked."""
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).cast("int")
    rise = F.when(F.col("inside") == 1, F.col("rise_in")).otherwise(F.col("rise_out"))
    return (
        measured.withColumns({"inside": inside, "marked": F.max("marked").over(Window.partitionBy("file"))})
        .withColumn("depth", F.coalesce(F.sum(rise).over(earlier), F.lit(0)))
        .select("file", "block", "inside", "depth", "marked")
    )


#: What is not white space to str.strip.
NOT_BLANK = r"[^\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _whole(units: pa.Array, starts: np.ndarray, form: Format) -> pa.Array:
    """The records from each start to the next; blank ones are none."""
    lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), units.cast(pa.string()))
    texts = pc.binary_join(lists, form.separator)
    texts = texts.filter(pc.match_substring_regex(texts, NOT_BLANK))
    return pc.binary_join_element_wise(texts, form.end, "") if form.end else texts


def _cut(form: Format):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in PIECES.split(", ")]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
        here, inside, depth, marked, top = None, 0, 0, False, 0
        pending: list[str] = []  # the units of a record that has begun, here or in an earlier block
        kind, first = RECORD, False

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

        def records(texts: pa.Array) -> pa.RecordBatch:
            nonlocal first
            n = len(texts)
            columns = (np.full(n, here[0]), np.full(n, here[1]), np.full(n, RECORD), first & (np.arange(n) == 0))
            first = first and not n
            return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, kinds)), texts], names)

        for key, part in _slices(batches):
            rows: list[tuple] = []

            def put(kind: int, units: list[str]) -> None:
                """A piece; blank ones between records are none."""
                nonlocal first
                text = form.separator.join(units)
                if kind != RECORD or text.strip():
                    rows.append((*here, kind, first, text + form.end if kind == RECORD else text))
                    first = False

            if key != here:
                if pending:
                    put(INNER if kind == HEAD else TAIL, pending)
                here, pending, first = key, [], key[1] == 0
                inside, depth, marked = (part[c][0].as_py() for c in ("inside", "depth", "marked"))
                if inside is None:
                    raise RuntimeError("the file's blocks are not those of the first pass; read it again")
                top = int(form.nested and marked)
                kind = RECORD if inside == 0 and depth <= top else HEAD
            states, depths = _before(*form.measure(part["value"]), inside, depth)
            inside, depth = int(states[-1]), int(depths[-1])
            units = part["value"]
            if marked and not form.nested:
                units = pc.replace_substring_regex(units, r"\r\z", "")
            starts = np.flatnonzero((states[:-1] == 0) & (depths[:-1] <= top))
            if len(starts):
                if pending or kind == HEAD:
                    put(kind, pending + units[: starts[0]].to_pylist())
                    kind = RECORD
                if len(starts) > 1:
                    yield batch_of(rows)
                    rows.clear()
                    yield records(_whole(units, starts, form))
                pending = units[starts[-1] :].to_pylist()
            else:
                pending += units.to_pylist()
            if pending and inside == 0 and depth <= top:
                put(kind, pending)
                pending, kind = [], RECORD
            yield batch_of(rows)
        if pending:
            yield batch_of([(*here, INNER if kind == HEAD else TAIL, first, form.separator.join(pending))])

    return run


def _pieces(spark: SparkSession, path: str | list[str], form: Format, packed: bool = False) -> DataFrame:
    """All records (kind 0), and what the edges of blocks cut off of some."""
    ship_package(spark)
    units = _units(spark, path, form, packed)
    begins = staged(_begins(_measured_units(units, form, True) if packed else form.measured(units, form)))
    if begins.count() <= BROADCAST_BLOCKS:
        known = units.join(F.broadcast(begins), ["file", "block"], "left")
    else:
        known = (
            units.withColumn("_at", F.monotonically_increasing_id())
            .join(begins, ["file", "block"], "left")
            .repartition("file", "block")
            .sortWithinPartitions("file", "block", "_at")
            .drop("_at")
        )
    return known.mapInArrow(_of_units(_cut(form), form, packed), PIECES)


def _joined(pieces: DataFrame, form: Format) -> DataFrame:
    """first, text: the records that edges of blocks cut through.

    Pieces belong to the last beginning before them; that is counted on narrow rows.
    """
    narrow = pieces.select("file", "block", "kind")
    so_far = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, 0)
    numbered = narrow.withColumn("record", F.count_if(F.col("kind") == TAIL).over(so_far))
    in_order = F.array_sort(F.collect_list(F.struct("block", "kind", "text")))
    return (
        pieces.join(numbered, ["file", "block", "kind"])
        .groupBy("file", "record")
        .agg(F.max("first").alias("first"), F.array_join(F.transform(in_order, lambda p: p["text"]), form.separator).alias("text"))
        .select("first", F.concat("text", F.lit(form.end)).alias("text"))
    )


def read_records(
    spark: SparkSession, path: str | list[str], form: Format, parsed: Column, stage_path: str | None = None, packed: bool = False
) -> DataFrame:
    """first, text, r: each record, parsed by ``parsed`` on its column ``text``; ``first`` marks the first of each file.

    What is parsed is stored once, in the pass that cuts; texts are kept of first records
    and of pieces only.  The folder is the caller's to remove.
    """
    whole = F.col("kind") == RECORD
    with frames.small_splits(spark) if packed else nullcontext():
        stored = staged(
            _pieces(spark, path, form, packed).select(
                "file", "block", "kind", "first",
                F.when(~whole | F.col("first"), F.col("text")).alias("text"),
                F.when(whole & ~F.col("first"), parsed).alias("r"),
            ),
            stage_path,
        )
    records = stored.where("kind = 0 AND NOT first").select("first", "text", "r")
    cut = _joined(stored.where("kind <> 0").drop("r"), form).unionByName(stored.where("kind = 0 AND first").select("first", "text"))
    return records.unionByName(cut.withColumn("r", parsed))


def _first_record(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The first record of one of the packed CSV files; none if all are empty."""
    frame = _units(spark, path, CSV, True).where("block = 0").limit(1).collect()
    units = frames.units_of(frames.text_of(frame[0]["value"]), CSV.separator) if frame else []
    record, odd = [], 0
    for unit in units:
        record.append(unit.as_py())
        odd ^= record[-1].count('"') & 1
        if not odd and "".join(record).strip("\ufeff \t\r\n"):
            return [CSV.separator.join(record).strip("\r\n")]
        record = record if odd else []
    return []


def read_part_blocks(
    spark: SparkSession,
    path: str | list[str],
    csv_schema: T.StructType = schema.CASE_CSV,
    stage_path: str | None = None,
    packed: bool = False,
) -> DataFrame:
    """As :func:`tables.read_part`, but each file is read by as many tasks as it has blocks.

    Quotes must be as CSV writers set them: around the whole value, doubled inside it.
    Lines end in ``\\n`` or ``\\r\\n``.  Files read together must have one header.  An empty file has no rows.
    ``packed``: the files were written in frames.
    """
    begun = spark.sparkContext.parallelize(_first_record(spark, path), 1) if packed else path
    header = [h.removeprefix("\ufeff") for h in spark.read.options(**CSV_OPTIONS).csv(begun).columns] or csv_schema.names
    columns = schema.strings([f"_{i}" for i in range(len(header))])
    # A pattern makes a copy of every text.
    text = F.when(F.startswith("text", F.lit("\ufeff")), F.regexp_replace("text", "^\ufeff", "")).otherwise(F.col("text"))
    options = {k: v for k, v in CSV_OPTIONS.items() if k not in ("header", "encoding")}
    rows = read_records(spark, path, CSV, F.from_csv(text, ", ".join(f"{c} string" for c in columns.names), options), stage_path, packed)
    names = F.array(*[F.coalesce(F.col(f"r.{c}"), F.lit("")) for c in columns.names])
    other = rows.where("first").select(names.alias("h")).where(F.col("h") != F.array(*[F.lit(h) for h in header]))
    if wrong := other.limit(1).collect():
        raise ValueError(f"the header {wrong[0]['h']} is not {header}")
    return part_columns(rows.where("NOT first").select("r.*"), header, csv_schema)


_BEFORE_BRACKET = r'^[^"{]*+(?:"(?:[^"\\]++|\\.)*+"[^"{]*+)*+'


def _from_bracket(text: Column) -> Column:
    """An element from its opening bracket on; what stands before it separates records or is no object.

    Mostly that is but a comma and a line end, which need no pattern: a pattern makes copies of every text.
    """
    plain = F.ltrim(text, F.lit(", \t\r\n"))
    return F.when(F.startswith(plain, F.lit("{")), plain).otherwise(F.regexp_replace(text, _BEFORE_BRACKET, ""))


def read_json_array(
    spark: SparkSession,
    path: str,
    json_schema: T.StructType,
    corrupt: str | None = None,
    stage_path: str | None = None,
    packed: bool = False,
) -> DataFrame | None:
    """Objects of JSON arrays, each file read by as many tasks as it has blocks; None if there is no such file.

    One element that cannot be read loses only itself: it is NULL in all
    columns, and ``corrupt`` names a further column for its text.  Numbers, strings and the like among
    the elements are passed over; a list among them spoils the object after it.
    A file that holds one object is one record.  ``packed``: the files were written in frames.
    """
    if corrupt:
        json_schema = T.StructType([*json_schema.fields, T.StructField(corrupt, T.StringType())])
    text = _from_bracket(F.col("text"))
    options = {"mode": "PERMISSIVE"} | ({"columnNameOfCorruptRecord": corrupt} if corrupt else {})
    parsed = F.when(text != "}", F.from_json(text, json_schema, options))
    try:
        rows = read_records(spark, path, JSON, parsed, stage_path, packed)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return rows.where("r IS NOT NULL").select("r.*")
