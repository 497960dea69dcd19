"""Files cut into many blocks give the records that a whole read gives."""

import csv
import json
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketframe import schema
from docketframe.sources import blocks, frames, sinks, tables

PARTS = ['"', "\n", ",", "a", "正", "\\", "\r\n", '""', " ", "b" * 30]
POINT = T.StructType().add("y", "long")
JSON = T.StructType().add("title", "string").add("k", "long").add("sub", T.StructType().add("x", T.ArrayType(POINT)))


@pytest.fixture
def small_blocks(spark):
    """Blocks of 700 bytes: most edges lie inside a record, many inside a quote."""
    for key, value in {"maxPartitionBytes": "700", "openCostInBytes": "1"}.items():
        spark.conf.set(f"spark.sql.files.{key}", value)
    yield
    for key in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{key}")


def bodies(n, seed):
    rng = random.Random(seed)
    long = ["\n".join('say "x", y' for _ in range(300))]
    some = ["".join(rng.choice(PARTS) for _ in range(rng.choice([0, 1, 5, 40, 200]))) for _ in range(n)]
    return some + long + some[:5]


def write_csv(path, rows, header=schema.CASE_HEADERS, end="\n", bom=True):
    with open(path, "w", newline="", encoding="utf-8-sig" if bom else "utf-8") as f:
        out = csv.writer(f, lineterminator=end)
        out.writerow(header)
        out.writerows(rows)


def block_count(spark, path, form=blocks.CSV):
    return blocks._units(spark, str(path), form).select("block").distinct().count()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("bom", [False, True])
def test_one_csv_file_cut_inside_quotes(spark, small_blocks, tmp_path, end, bom):
    rows = [(i, "t" if i % 3 else 'x,"y"', "c", "n", "d", "l", b) for i, b in enumerate(bodies(120, 1))]
    path = str(tmp_path / "p.csv")
    write_csv(path, rows, end=end, bom=bom)
    assert block_count(spark, path) > 20
    got = blocks.read_part_blocks(spark, path)
    assert got.rdd.getNumPartitions() > 1
    assert sorted(got.collect()) == sorted(tables.read_part(spark, path).collect())
    assert got.count() == len(rows)


def test_units_are_read_by_several_tasks(spark, small_blocks, tmp_path):
    write_csv(tmp_path / "p.csv", [(i, "", "", "", "", "", "x\ny" * 50) for i in range(50)])
    units = blocks._units(spark, str(tmp_path / "p.csv"), blocks.CSV)
    tasks = units.select(F.spark_partition_id().alias("t")).distinct().count()
    assert tasks > 4


def test_a_block_in_the_middle_of_one_record(spark, small_blocks, tmp_path):
    body = "\n".join(f"line {i}" for i in range(2000))
    write_csv(tmp_path / "p.csv", [(1, "a", "", "", "", "", body), (2, "b", "", "", "", "", body), (3, "c", "", "", "", "", "")])
    got = {r.title: r.body for r in blocks.read_part_blocks(spark, str(tmp_path / "p.csv")).collect()}
    assert got == {"a": body, "b": body, "c": ""}


def test_files_of_one_header_in_any_column_order(spark, small_blocks, tmp_path):
    header = ["正文", "序号", "别的"]
    for k in range(3):
        write_csv(tmp_path / f"{k}.csv", [(f"b{k}\n{i}", i, "z") for i in range(40)], header)
    got = blocks.read_part_blocks(spark, str(tmp_path)).collect()
    assert sorted((r.seq, r.body, r.title) for r in got) == sorted((i, f"b{k}\n{i}", "") for k in range(3) for i in range(40))
    write_csv(tmp_path / "other.csv", [("1", "2", "3")], ["序号", "正文", "别的"])
    with pytest.raises(ValueError, match="header"):
        blocks.read_part_blocks(spark, str(tmp_path))


def test_empty_csv_files_and_blank_lines(spark, tmp_path):
    write_csv(tmp_path / "none.csv", [])
    assert blocks.read_part_blocks(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "blank.csv").write_text("\n" + ",".join(schema.CASE_HEADERS) + '\n\n1,,,,,,x\n\n2,,,,,,"\n\n"\n\n')
    got = blocks.read_part_blocks(spark, str(tmp_path / "blank.csv")).collect()
    assert sorted((r.seq, r.body) for r in got) == [(1, "x"), (2, "\n\n")]


def test_more_blocks_than_are_broadcast(spark, small_blocks, tmp_path, monkeypatch):
    rows = [(i, "", "", "", "", "", b) for i, b in enumerate(bodies(60, 2))]
    write_csv(tmp_path / "p.csv", rows)
    monkeypatch.setattr(blocks, "BROADCAST_BLOCKS", 0)
    got = blocks.read_part_blocks(spark, str(tmp_path / "p.csv"))
    assert sorted(got.collect()) == sorted(tables.read_part(spark, str(tmp_path / "p.csv")).collect())


@pytest.mark.parametrize("indent", [None, 1])
def test_json_array_in_blocks(spark, small_blocks, tmp_path, indent):
    rng = random.Random(4)
    texts = ["a", "}{", "[", '"q"', "\\", '\\"', '{"k": [', "]}", "正\n文"]
    rows = [{"title": "".join(rng.choices(texts, k=rng.randrange(9))), "k": i, "sub": {"x": [{"y": i}] * rng.randrange(3)}} for i in range(250)]
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=False))
    assert block_count(spark, tmp_path / "a.json", blocks.JSON) > 10
    got = blocks.read_json_array(spark, str(tmp_path / "a.json"), JSON).collect()
    assert sorted((r.asDict(True) for r in got), key=lambda r: r["k"]) == rows


def test_json_array_with_elements_that_cannot_be_read(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"k":1},{"k": tru},\n{"k":3}, 5, "x{}y", null, {"k":4}\n]\n')
    got = blocks.read_json_array(spark, str(tmp_path / "a.json"), JSON, corrupt="bad").collect()
    assert sorted((r.k, r.bad) for r in got if r.k) == [(1, None), (3, None), (4, None)]
    assert '{"k": tru}' in [r.bad for r in got]


@pytest.mark.parametrize("text, n", [("", 0), ("[]", 0), ("[\n]\n", 0), ('{"k": 1, "sub": {"x": [{"y": 1}, {"y": 2}]}}', 1), ('[{"k": 1}]', 1)])
def test_small_json_files(spark, tmp_path, text, n):
    (tmp_path / "a.json").write_text(text)
    assert blocks.read_json_array(spark, str(tmp_path / "a.json"), JSON).count() == n


def test_missing_json_file(spark, tmp_path):
    assert blocks.read_json_array(spark, str(tmp_path / "none.json"), JSON) is None


def test_json_array_round_trip(spark, tmp_path):
    rows = [(i, b) for i, b in enumerate(bodies(30, 3))]
    df = spark.createDataFrame(rows, "k long, title string")
    sinks.write_json_array(df, str(tmp_path / "j"))
    for file in (tmp_path / "j").glob("*.txt"):
        json.loads(file.read_text())
    got = blocks.read_json_array(spark, str(tmp_path / "j"), JSON).select("k", "title").collect()
    assert sorted(map(tuple, got)) == rows


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_blocks_are_measured_without_python(spark, small_blocks, tmp_path, end):
    """Sending every line to Python took most of the first pass."""
    write_csv(tmp_path / "p.csv", [(i, "", "", "", "", "", b) for i, b in enumerate(bodies(60, 5))], end=end)
    units = blocks._units(spark, str(tmp_path / "p.csv"), blocks.CSV)
    found = blocks.CSV.measured(units, blocks.CSV)
    assert found.columns == [c.split()[0] for c in blocks.MEASURED.split(", ")]
    assert "InArrow" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(found.collect()) == sorted(blocks._measured_units(units, blocks.CSV).collect())


def test_records_are_joined_from_units_without_blank_ones():
    units = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    kept = blocks._whole(pa.array([*units, "next"]), np.arange(len(units) + 1), blocks.CSV).to_pylist()
    assert kept == [u for u in units if u.strip()]
    some = pa.array(["before", "a", "", "b", " ", "\u3000", "next"])[1:]
    assert blocks._whole(some, np.array([0, 2, 3, 5]), blocks.CSV).to_pylist() == ["a\n", "b"]
    assert blocks._whole(some, np.array([0, 2, 3, 5]), blocks.JSON).to_pylist() == ["a}}", "b}", " }\u3000}"]


def test_text_of_a_json_element_begins_at_its_bracket(spark):
    texts = ['{"a": 1}', ',\n{"a": "{"}', ' \t\r\n, {}', '[{"k"}', '"x{}", {"k"}', ' 5, "\\"{", null, {"k"}', "}", "]\n", "", ", ]", "\ufeff[{}", "\xa0{}", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    by_pattern = F.regexp_replace("t", blocks._BEFORE_BRACKET, "")
    for r in rows.select(blocks._from_bracket(F.col("t")).alias("ours"), by_pattern.alias("theirs")).collect():
        assert r.ours == r.theirs


def lines_of(spark, path):
    """The lines of a text file; the last line end is none of its own."""
    text = open(path, newline="", encoding="utf-8").read().removesuffix("\n")
    return spark.createDataFrame([(line,) for line in text.split("\n")], "value string").coalesce(1)


def text_in_frames(folder):
    """The text of the one file in a folder, as any program for Zstandard reads it."""
    import io

    import zstandard

    (file,) = folder.glob("part-*")
    return zstandard.ZstdDecompressor().stream_reader(io.BytesIO(file.read_bytes()), read_across_frames=True).read()


@pytest.fixture
def few_frames(spark):
    """Splits of 1,500 bytes of packed files."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1_500 * frames.PACKED)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for key in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{key}")


def test_csv_files_in_frames(spark, few_frames, tmp_path):
    """Frames of a few lines: most edges lie inside quotes."""
    rows = [(i, frames.MARK if i % 5 == 0 else 'x,"y"', "c", "n", "d", "l", b) for i, b in enumerate(bodies(120, 6))]
    write_csv(tmp_path / "p.csv", rows)
    frames.write_frames(lines_of(spark, tmp_path / "p.csv"), str(tmp_path / "f"), "\n", frame_bytes=300)
    assert text_in_frames(tmp_path / "f") == (tmp_path / "p.csv").read_bytes()
    with frames.small_splits(spark):
        units = blocks._units(spark, str(tmp_path / "f"), blocks.CSV, packed=True)
        assert units.select("block").distinct().count() > 5
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    got = blocks.read_part_blocks(spark, str(tmp_path / "f"), packed=True)
    assert sorted(got.collect()) == sorted(tables.read_part(spark, str(tmp_path / "p.csv")).collect())
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == split


@pytest.mark.parametrize("indent", [None, 1])
def test_json_arrays_in_frames(spark, few_frames, tmp_path, indent):
    rng = random.Random(4)
    texts = ["a", "}{", "[", '"q"', "\\", '{"k": [', "]}", "正\n文", frames.MARK]
    rows = [{"title": "".join(rng.choices(texts, k=rng.randrange(9))), "k": i, "sub": {"x": [{"y": i}] * rng.randrange(3)}} for i in range(250)]
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=False) + "\n")
    frames.write_frames(lines_of(spark, tmp_path / "a.json"), str(tmp_path / "f"), "}", frame_bytes=200)
    assert text_in_frames(tmp_path / "f") == (tmp_path / "a.json").read_bytes()
    got = blocks.read_json_array(spark, str(tmp_path / "f"), JSON, packed=True).collect()
    assert sorted((r.asDict(True) for r in got), key=lambda r: r["k"]) == rows
    assert blocks.read_json_array(spark, str(tmp_path / "none"), JSON, packed=True) is None


def test_sinks_write_the_same_text_in_frames(spark, tmp_path):
    some = [(i, b, None if i % 3 else ' a "b"\\', " x ", "", "l,", b + "\r" * (i % 2)) for i, b in enumerate(bodies(40, 7))]
    cases = spark.createDataFrame(some, schema.CASE).coalesce(1)
    for name, df in (("all", cases), ("none", cases.limit(0).coalesce(1))):
        for kind, write in {
            "csv": lambda df, to, c: sinks.write_cases(df, to, bom=True, rows_per_file=0, compression=c),
            "json": sinks.write_json_array,
        }.items():
            plain, packed = tmp_path / f"{name}_{kind}", tmp_path / f"{name}_{kind}_frames"
            write(df, str(plain), None)
            write(df, str(packed), sinks.FRAMES)
            if name == "all":
                (file,) = plain.glob("part-*")
                assert text_in_frames(packed) == file.read_bytes()
        n = 0 if name == "none" else len(some)
        assert blocks.read_part_blocks(spark, str(tmp_path / f"{name}_csv_frames"), packed=True).count() == n
        assert blocks.read_json_array(spark, str(tmp_path / f"{name}_json_frames"), schema.CASE, packed=True).count() == n
    with pytest.raises(ValueError, match="rows_per_file"):
        sinks.write_cases(cases, str(tmp_path / "no"), compression=sinks.FRAMES)


def test_frames_hold_no_mark_and_are_read_whole(tmp_path):
    text = "".join(f"{i}{frames.MARK}正" for i in range(50)).encode()
    raw = frames._MARK  # too short to be compressed, so that a frame holds it as it is
    for t in (text, raw, b"", b"a"):
        packed = frames._packed(t)
        assert frames._MARK not in packed and frames.text_of(packed + frames._SKIPPED) == t
    with pytest.raises(ValueError, match="cut short"):
        frames.text_of(frames._packed(text)[:-1] + frames._SKIPPED)
    with pytest.raises(ValueError, match="not written in frames"):
        frames.text_of(b"1,2,3")
    for t in ("", "a", "}", "a}", "a}b", "}}正}", "\n]\n"):
        assert frames.units_of(t.encode(), "}").to_pylist() == (t.removesuffix("}").split("}") if t else [])
