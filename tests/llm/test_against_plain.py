"""Span finders, decontamination and archives against plain versions, on random and on very long input."""

import random
import re

import pytest
import zstandard
from pyspark.sql import functions as F

from docketframe.llm import archive, decontaminate, personal, secrets
from docketframe.session import ship_package

SCHEMA = "doc_id long, text string, key string, kind int, start int, words string, least int, prints int"


def table(spark, rows):
    ship_package(spark)
    return spark.createDataFrame([(i, t, "x", 1, 2, "y", 3, 4) for i, t in rows], SCHEMA)


# -- personal data ------------------------------------------------------------

PLAIN = [
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
    (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def test_plain_spans_of_random_texts():
    rng = random.Random(7)
    parts = ["a", "B9", ".", "@", "@x.", "-", "_", "%", "+", " ", "1", "42", "4111 1111 1111 1111", "0", "(", ")", "256", "255", ".1.2.3", "é", "\n", "+1 202 555 0143"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randrange(30)))
        expected = sorted((m.start(), k, m.end()) for k, (p, good) in enumerate(PLAIN) for m in re.finditer(p, text) if good(m[0]))
        assert personal.detect(text) == expected, text


@pytest.mark.parametrize("text", ["we meet at 3.5 km", "arrive at 10.30 today", "we met at noon.Then we left", "at 1.2.3", "start at v2.0"])
def test_prose_that_is_no_address(text):
    assert personal.find(text) == ([], [])


@pytest.mark.parametrize("sign", [" at ", "(at)", " @ "])
def test_any_number_of_disguised_dots(sign):
    local = " dot ".join("abcdefghij")
    text = f"mail {local}{sign}mail dot example dot com now"
    assert personal.redacted(text, personal.find(text)[1]) == "mail [EMAIL] now"


@pytest.mark.parametrize("text", ["𝐣𝐚𝐧𝐞@example.com", "ｊane@example.com", "jane@example․com", "jane@example。com", "ⓙⓐⓝⓔ@example.com", "𝟙92.168.0.①"])
def test_forms_of_letters_and_stops(text):
    base, more = personal.find(f"x {text} y")
    assert personal.redacted(f"x {text} y", base + more) in ("x [EMAIL] y", "x [IP] y")


def test_very_long_chains_take_no_longer():
    for text in ("a dot " * 100_000 + "b at x", "a." * 100_000, "a at " * 100_000 + "x.com", "one " * 100_000):
        personal.find(text)


# -- secrets ------------------------------------------------------------------


def test_many_secrets_in_a_very_long_text(spark):
    n = 60_000
    row = secrets.find_secrets(table(spark, [(1, "é password=hunter22 " * n), (2, "token: abcdefg")])).orderBy("doc_id").collect()
    assert (row[0].n_assign, row[1].n_assign) == (n, 1)
    spans = row[0].spans.split(",")
    assert len(spans) == n and spans[-1] == f"assign:{20 * (n - 1) + 2}:{20 * n - 1}"


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 256, 300])
def test_stretches_meet(spark, n):
    text = "".join(f"{'z' * (i % 5)} token='abcdef{i}'," for i in range(n))
    got = secrets.find_secrets(table(spark, [(1, text)])).first()
    found = [m for m in re.finditer(r"""token["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text)]
    assert got.spans == ",".join(f"assign:{m.start()}:{m.end()}" for m in found) and got.n_assign == n


def test_settings_in_capitals_and_other_schemes_link(spark):
    text = "CLIENT_ID=abc123 then Zx9AbcdefghijklmnopqrstuvwxyzABCDEF0123 on postgres://db.example.com:5432"
    got = secrets.find_secrets(table(spark, [(1, text), (2, "clientId: bob, mysql://db")])).orderBy("doc_id").collect()
    assert [s.split(":")[0] for s in got[0].spans.split(",")] == ["ident", "secret", "endpoint"] and got[1].spans == ""


# -- decontamination ----------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def expected_hits(docs, items, window):
    runs = {}
    for item, text in items:
        w = words_of(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if w else 0):
            runs.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, of = words_of(text), set(), set()
        for n in range(1, window + 1):
            for i in range(len(w) - n + 1):
                found = runs.get(tuple(w[i : i + n]))
                if found:
                    hit.update(range(i, i + n))
                    of |= {x for x in found if x is not None}
        out.append((doc, len(w), len(hit), len(of), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_hits_of_random_texts(spark, seed, monkeypatch):
    rng = random.Random(seed)
    if seed % 2:
        monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    window, gram = rng.choice([(10, 5), (6, 3), (5, 5), (8, 1)])
    text = lambda n, k=12: rng.choice([" ", "-", "\n"]).join(rng.choice(["w%d", "W%d", "é%d"]) % rng.randrange(k) for _ in range(n))
    items = [(i, text(rng.randrange(0, 40))) for i in range(25)] + [(None, text(12)), (90, None), (91, "solo"), (1, text(15))]
    docs = [(i, text(rng.randrange(0, 60))) for i in range(80)] + [(i, f"{text(20, 400)} {items[i % 25][1].upper()} {text(9, 400)}") for i in range(80, 130)]
    docs += [(200, None), (201, ""), (202, "x Solo. y"), (None, items[3][1]), (203, text(4000, 500) + " " + items[5][1] * 30), *docs[:5]]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1))
    got = decontaminate.contamination(table(spark, docs), benchmark, window, gram).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got), key=repr) == expected_hits(docs, items, window)


# -- archive ------------------------------------------------------------------

PAGES = "page_id long, url string, html string, record_type string, refers_to long, digest string"


def pages(spark, rows):
    ship_package(spark)
    return spark.createDataFrame([(i, "http://h/", h, "x", 1, "y") for i, h in rows], PAGES)


def test_an_archive_is_read_by_a_task_for_each_bundle(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choices("abcdefgh", k=400))) for i in range(60)]
    # Only the small size of the fixture would make AQE write one bundle.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        archive.write_archive(pages(spark, rows), str(tmp_path / "w")).write.parquet(str(tmp_path / "index"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    index = spark.read.parquet(str(tmp_path / "index"))
    back = archive.read_archive(index)
    assert back.rdd.getNumPartitions() == index.select("bundle").distinct().count() > 1
    assert back.select(F.spark_partition_id()).distinct().count() > 1 and back.count() == 60


def test_records_have_what_a_reader_needs(spark, tmp_path):
    archive.write_archive(pages(spark, [(1, "é" * 100), (2, "é" * 100), (None, "x"), (1, "é" * 100)]).coalesce(1), str(tmp_path / "w")).collect()
    data = b"".join(zstandard.ZstdDecompressor().decompress(f, max_output_size=1 << 20) for f in frames(tmp_path / "w"))
    found = [(h, c) for _, _, h, c in archive.records(data)]
    kinds = [h["WARC-Type"] for h, _ in found]
    assert kinds[0] == "warcinfo" and sorted(kinds[1:]) == ["response"] * 3 + ["revisit"]
    assert len({h["WARC-Record-ID"] for h, _ in found}) == 5
    for h, content in found:
        assert re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", h["WARC-Record-ID"]) and re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", h["WARC-Date"])
        assert h["Content-Type"] and int(h["Content-Length"]) == len(content)
        if h["WARC-Type"] == "response":
            head, payload = content.split(b"\r\n\r\n", 1)
            assert head.startswith(b"HTTP/1.1 200 OK") and f"Content-Length: {len(payload)}".encode() in head


def frames(folder):
    out = []
    for path in folder.glob("*.warc.zst"):
        with archive._files(str(path))[0].open_input_file(str(path)) as file:
            for start, packed, _ in archive.read_seek_table(file):
                file.seek(start)
                out.append(file.read(packed))
    return out


def test_a_payload_that_is_not_what_its_record_says_shows(spark, tmp_path):
    rows = [(1, "a" * 200), (2, "a" * 200), (3, "b" * 200)]
    good = {r.page_id: r.payload_digest for r in archive.round_trip(pages(spark, rows), str(tmp_path / "w")).collect()}
    assert good[1] == good[2] != good[3]
    index = archive.write_archive(pages(spark, rows).coalesce(1), str(tmp_path / "x"))
    index.write.parquet(str(tmp_path / "index"))
    for path in (tmp_path / "x").glob("*.warc.zst"):
        rewrite(path)
    back = {r.page_id: r for r in archive.checked(archive.read_archive(spark.read.parquet(str(tmp_path / "index")))).collect()}
    assert back[1].payload_digest is None and back[2].payload_digest is None and back[3].payload_digest == good[3]


def rewrite(path):
    """The first payload of a's gets another letter, under headers that stay."""
    with archive._files(str(path))[0].open_input_file(str(path)) as file:
        table, packed = archive.read_seek_table(file), []
        for start, size, plain in table:
            file.seek(start)
            packed.append(zstandard.ZstdDecompressor().decompress(file.read(size), max_output_size=plain))
    new = [zstandard.ZstdCompressor().compress(f.replace(b"aaaa", b"aaac", 1)) for f in packed]
    path.write_bytes(b"".join(new) + archive.seek_table([(len(n), len(p)) for n, p in zip(new, packed)]))
    (path.parent / f".{path.name}.crc").unlink(missing_ok=True)


def test_repeated_and_null_pages(spark, tmp_path):
    rows = [(2, "a" * 200), (1, "a" * 200), (1, "a" * 200), (None, "a" * 200), (None, "b" * 200), (3, None), (3, "")]
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in archive.round_trip(pages(spark, rows), str(tmp_path / "w")).collect()), key=repr)
    assert got == sorted(
        [(2, "revisit", 1, 200), (1, "response", None, 200), (1, "response", None, 200), (None, "revisit", 1, 200), (None, "response", None, 200), (3, "response", None, 0), (3, "response", None, 0)],
        key=repr,
    )
    assert archive.round_trip(pages(spark, rows).limit(0), str(tmp_path / "n")).count() == 0
