"""Periodic runs and fill-in-middle against plain versions, and on odd input."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketframe.llm import fill_in_middle as fim
from docketframe.llm import periodic_runs, queries
from docketframe.session import ship_package

SCHEMA = "doc_id long, text string, n long, form string, runs int, start string, output string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_runs(w, least=6, times=4):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i + q - start
            if length >= max(least, times * q):
                smaller = any(w[start : start + length - d] == w[start + d : start + length] for d in range(1, q))
                out += [] if smaller else [(start, length, q)]
            i += i == start
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected_runs(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        sha(" ".join(x for i, x in enumerate(w) if i not in gone)),
    )


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    out = {}
    for i in range(150):
        words = [rng.choice("a b c de é 😀 <P".split()[: rng.randrange(1, 7)]) for _ in range(rng.randrange(1, 90))]
        out[i] = rng.choice(["", " ", "\n\t"]) + rng.choice([" ", "\n", " \x0b "]).join(words) + rng.choice(["", " ", "　"])
    again = " ".join(rng.choice("xyz") for _ in range(11))
    out |= {200: None, 201: "", 202: " \n\t ", 203: "one", 204: " ".join([again] * 9), 205: "a " * 5, 206: "a " * 6}
    out |= {207: " ".join(f"w{rng.randrange(50)}" for _ in range(1500)), 208: "u v <S> w", 209: "\x1c\x85 a\xa0b"}
    return out


def table(spark, rows):
    ship_package(spark)
    return spark.createDataFrame([(i, t, 1, "x", 2, "y", "z") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def sf_dir(spark, texts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("small"))
    rows = [*texts.items(), *list(texts.items())[:5], (None, texts[204]), (None, None)]
    table(spark, rows).write.parquet(f"{path}/documents.parquet")
    return path


def test_runs_as_a_plain_search_finds_them(spark, texts, sf_dir):
    got = [tuple(r) for r in queries.op11_periodic_runs(spark, sf_dir).collect()]
    rows = [*texts.items(), *list(texts.items())[:5], (None, texts[204]), (None, None)]
    assert sorted(got, key=repr) == sorted((expected_runs(i, t) for i, t in rows), key=repr)
    assert any(r[1] for r in got)


def test_runs_of_random_words_of_few_letters():
    rng = random.Random(8)
    for _ in range(400):
        batch = [[rng.choice([b"a", b"b", b"c"][: rng.randrange(1, 4)]) for _ in range(rng.randrange(50))] for _ in range(3)]
        assert periodic_runs.text_runs(batch) == [plain_runs(w) for w in batch]
        assert periodic_runs.text_runs(batch, 2, 2) == [plain_runs(w, 2, 2) for w in batch]


@pytest.mark.parametrize("period", [1, 7, 1000])
def test_very_long_runs(period):
    n = 60_000
    assert periodic_runs.text_runs([[str(i % period).encode() for i in range(n)]]) == [[(0, n, period)]]


def test_strongest_compares_exactly():
    assert periodic_runs.strongest([(9, 3**35, 3**33), (5, 3**35 + 1, 3**33), (4, 9, 1)]) == (5, 3**35 + 1, 3**33)
    assert periodic_runs.strongest([(4, 12, 3), (2, 8, 2), (2, 16, 4)]) == (2, 8, 2)
    assert periodic_runs.strongest([]) is None


def expected_middle(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    low, high = sorted(x % (n + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (tokens[:low], tokens[low:high], tokens[high:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return (doc_id, n, "plain", None, None, sha(text), sha(text))
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 80 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return (doc_id, n, form, len(p), len(m), sha(out), sha(text))


def test_middle_as_a_plain_version_cuts_it(spark, texts, sf_dir):
    got = [tuple(r) for r in queries.op13_fill_in_middle(spark, sf_dir).collect()]
    rows = [*texts.items(), *list(texts.items())[:5], (None, texts[204]), (None, None)]
    assert sorted(got, key=repr) == sorted((expected_middle(i, t) for i, t in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_rate_and_seed_are_parameters(spark, texts):
    docs = table(spark, texts.items())
    always = fim.fill_in_middle(docs, seed=1, percent=100, suffix_first=0)
    assert {r["form"] for r in always.collect()} == {"plain", "psm"}
    back = always.select("doc_id", fim.restored(F.col("output"), F.col("form")).alias("t")).collect()
    assert {r["doc_id"]: r["t"] for r in back} == {i: t or "" for i, t in texts.items()}
    assert {r["form"] for r in fim.fill_in_middle(docs, percent=0).collect()} == {"plain"}


@pytest.mark.parametrize("error", [0, 3, 127])
def test_rank_index_is_exact_and_within_its_error(error):
    rng = np.random.default_rng(2)
    sizes = [1, 2, 3, 1, 5000, 40]
    steps = [rng.integers(1, 30, n) * rng.choice([1, 200], n, p=[0.999, 0.001]) for n in sizes]
    offsets = np.concatenate([np.cumsum(s) for s in steps])
    first = np.cumsum([0, *sizes[:-1]])
    index = fim.RankIndex(offsets, first, error)
    ranks = np.arange(len(offsets))
    assert (index.offset(ranks) == offsets).all()
    assert np.abs(index.predicted(ranks) - offsets).max() <= error
    assert len(index) >= len(sizes) and (error < 127 or len(index) < len(offsets) / 10)


def test_boundaries_of_a_very_long_text():
    text = "word " * 400_000 + "\n"
    offsets, first, n = fim.boundaries(["", text, "x"])
    assert n.tolist() == [0, 400_001, 1] and first.tolist() == [0, 1, 400_003]
    assert offsets[400_001] == 1_999_999 and offsets[400_002] == len(text)


@pytest.mark.parametrize("find", [periodic_runs.find_runs, fim.fill_in_middle])
def test_no_rows_give_no_rows(spark, find):
    assert find(table(spark, [(1, "a")]).limit(0)).count() == 0
