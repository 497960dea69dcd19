import random
import shutil
from pathlib import Path

import pytest

from docketframe.operators import keyword_index as ki

ALPHABET = "ab 故意\n😀"


def texts():
    rng = random.Random(9)
    rows = [(i, "".join(rng.choices(ALPHABET, k=rng.choice([0, 1, 2, 30, 300])))) for i in range(150)]
    # A phrase across the edge of two segments, at each distance, and at a text's end.
    rows += [(1000 + d, "x" * (ki.SEGMENT - d) + "被告人故意伤害罪" + "y" * 10) for d in range(12)]
    rows += [(2000, None), (None, "故意"), (2001, "故意"), (2001, "ab"), (-5, "z" * 3 * ki.SEGMENT + "故意ab")]
    return rows


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "i")
    ki.build(spark.createDataFrame(texts(), "doc long, body string"), "doc", "body", path, block_rows=20)
    return path


@pytest.mark.parametrize(
    "phrase",
    ["", "a", "意", "ab", "故意", "故意伤害罪", "被告人故意伤害罪", "罪y", "y", "aa", "a b", "\n", "😀😀", "x" * 40, "x" * 200 + "被告", "z" * 5000, "没有", "q"],
)
@pytest.mark.parametrize("few", [ki.FEW_ROWS, 0])
def test_finds_what_contains_finds(spark, index, phrase, few, monkeypatch):
    monkeypatch.setattr(ki, "FEW_ROWS", few)
    got = sorted((r.key, r.text) for r in ki.search(spark, index, phrase).collect())
    assert got == sorted((k, t) for k, t in texts() if k is not None and t is not None and phrase in t)


def test_positions_leave_few_candidates(spark, tmp_path):
    """All grams of the phrase occur in every text, but far apart."""
    parts = ["故意", "意伤", "伤害", "害罪"]
    rows = [(i, ("-" * ki.SEGMENT).join(parts)) for i in range(50)] + [(50, "故意伤害罪")]
    ki.build(spark.createDataFrame(rows, "k long, t string"), "k", "t", str(tmp_path / "i"))
    assert [r.key for r in ki.candidates(spark, str(tmp_path / "i"), "故意伤害罪").collect()] == [50]


def test_only_blocks_of_candidates_are_read(spark, tmp_path):
    path = str(tmp_path / "i")
    ki.build(spark.createDataFrame([(i, f"text number {i}!") for i in range(400)], "k long, t string"), "k", "t", path, block_rows=10)
    block = ki.candidates(spark, path, "number 77!").first().block
    others = [p for p in Path(path, "texts").glob("block=*") if p.name != f"block={block}"]
    assert len(others) > 20
    for folder in others:  # whatever reads one of these fails
        for file in folder.glob("*.parquet"):
            file.write_bytes(b"no table")
            shutil.rmtree(folder / f".{file.name}.crc", ignore_errors=True)
            (folder / f".{file.name}.crc").unlink(missing_ok=True)
    assert [r.key for r in ki.search(spark, path, "number 77!").collect()] == [77]


def test_no_texts(spark, tmp_path):
    ki.build(spark.createDataFrame([], "k long, t string"), "k", "t", str(tmp_path / "i"))
    assert ki.search(spark, str(tmp_path / "i"), "ab").count() == 0
