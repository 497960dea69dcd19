"""The operators against plain versions, and on odd input, on small tables."""

import hashlib
import importlib.util
import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402
from docketframe.llm import (  # noqa: E402
    archive,
    decontaminate,
    ngram_join,
    packing,
    personal,
    quality_classifier,
    quality_rules,
    secrets,
    substring_dedup,
    toxicity,
)
from docketframe.llm.labelled import held_out  # noqa: E402
from docketframe.session import ship_package  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, key string, label int, token string, bucket int"


def words(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def table(spark, texts: list):
    """Rows (doc_id, text), with further columns whose names operators use themselves."""
    ship_package(spark)
    rows = [(i, t, "en" if i is None or i % 3 else None, f"s{(i or 0) % 2}", "x", 1, "y", 2) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    shared, base = words(rng, 60), words(rng, 120)
    out = {i: words(rng, rng.randrange(1, 150)) for i in range(40)}
    for i in range(40, 50):
        out[i] = words(rng, 20) + "\n" + shared + " " + words(rng, 20)
    for i in range(50, 60):
        out[i] = base
    for i in range(60, 90):  # near copies: one to three words changed
        w = base.split(" ")
        for _ in range(1 + i % 3):
            w[rng.randrange(len(w))] = f"v{i}"
        out[i] = " ".join(w)
    out |= {90: None, 91: "", 92: "  \n\t ", 93: "one two", 94: "One TWO", 95: shared + " " + shared, 96: words(rng, 30_000)}
    return out


def test_substring_dedup(spark, texts):
    for n in (35, 8):
        got = substring_dedup.remove_repeats(table(spark, texts.items()), min_words=n).collect()
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute.repeats(texts, n)
        assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in got)


def test_repeated_rows_repeat_each_other(spark):
    text = " ".join(map(str, range(40)))
    got = substring_dedup.remove_repeats(table(spark, [(1, text), (1, text), (None, text)])).collect()
    assert [r.n_removed for r in got] == [40] * 3


@pytest.mark.parametrize("short", [12, 0])
def test_ngram_join(spark, texts, monkeypatch, short):
    monkeypatch.setattr(ngram_join, "SHORT_LIST", short)
    got = ngram_join.near_duplicates(table(spark, texts.items())).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.similar(texts)


def test_ngram_join_all_links(spark, texts):
    classes, found = ngram_join.links(table(spark, texts.items()), connect_only=False)
    sets = brute.shingle_sets(texts)
    ids = sorted({r.class_id for r in classes.collect()} - {None})
    wanted = {(a, b) for a in ids for b in ids if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert {(r.a, r.b) for r in found.collect()} == wanted


def test_ngram_join_odd_rows(spark):
    text = " ".join(map(str, range(30)))
    got = ngram_join.near_duplicates(table(spark, [(5, text), (5, text), (None, text), (7, text), (8, None)])).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == [(5, 5), (5, 5), (7, 5), (8, 8), (None, None)]


def test_secrets(spark):
    text = "é user_id: alice9 then Zx9AbcdefghijklmnopqrstuvwxyzABCDEF0123 at https://x.example.com:80"
    cases = [
        (1, "password = 'hunter22' token=abc AKIA" + "A" * 16 + " " + "0a" * 12),
        (2, text), (3, "https://x.example.com only, user_id: bob"), (4, None), (5, ""), (2, text), (None, "secret=token:abcdefgh"),
    ]
    got = {(r.doc_id, r.spans) for r in secrets.find_secrets(table(spark, cases)).collect()}
    key = text.index("Zx9")
    assert got == {
        (1, "assign:0:20,access:32:52,hex:53:77"),
        (2, f"ident:2:17,secret:{key}:{text.index(" at ")},endpoint:{text.index('https')}:{len(text)}"),
        (3, ""), (4, ""), (5, ""), (None, ""),
    }


def test_personal(spark):
    plain = "a@b.co 1.2.3.4 999.1.1.1, 4111 1111 1111 1111 +1 (202) 555-0143"
    cases = {1: plain, 2: "write to joe at mail dot org", 3: None, 4: "", 5: "call ＋1 202 555 0143", 6: "é dot at the top."}
    got = {r.doc_id: r for r in personal.find_personal(table(spark, cases.items())).collect()}
    assert (got[1].n_email, got[1].n_ip, got[1].n_card, got[1].n_phone) == (1, 1, 1, 1)
    assert got[2].spans == "email:9:28" and got[2].n_email == 0 and got[2].redacted == "write to [EMAIL]"
    assert got[3].redacted is None and got[4].spans == "" and got[5].spans == f"phone:5:{len(cases[5])}" and got[6].spans == ""


@pytest.mark.parametrize(
    ("before", "span", "kind"),
    [
        ("mail ", "jane at example.com", "email"),
        ("mail ", "JANE AT example.com", "email"),
        ("mail ", "jane.doe[at]example.com", "email"),
        ("mail ", "jane @ example.com", "email"),
        ("mail ", "joe@example dot com", "email"),
        ("mail ", "joe@example[.]com", "email"),
        ("mail ", "joe@example(.)com", "email"),
        ("mail ", "joe@example { . } com", "email"),
        ("mail ", "joe[@]example.com", "email"),
        ("mail ", "joe(@)example.com", "email"),
        ("mail ", "joe.d <@> example.com", "email"),
        ("host ", "192 dot 168 dot 0 dot 1", "ip"),
        ("host ", "192[.]168[.]0[.]1", "ip"),
        ("host ", "192.168(.)0 [dot] 1", "ip"),
    ],
)
def test_each_sign_disguise_needs_no_other(before, span, kind):
    for text, n in ((before + span, len(before)), (before + span + " today", len(before)), (span, 0)):
        base, more = personal.find(text)
        assert (base, personal.written(more)) == ([], f"{kind}:{n}:{n + len(span)}"), text
        assert personal.redacted(text, more) == text[:n] + f"[{kind.upper()}]" + text[n + len(span) :]


def test_signs_that_hide_nothing():
    for text in ("we met at noon. Then", "3 dot 5 dot 7", "see [.] and (.) there", "an anecdote at large", "look at (a.b)"):
        assert personal.find(text) == ([], []), text


@pytest.mark.parametrize(
    ("span", "plain", "kind"),
    [
        ("j\u043ehn.smith@example.com", "hn.smith@example.com", "email"),
        ("j\u200bohn@example.com", "ohn@example.com", "email"),
        ("joe@mail.example.c\u043em", "joe@mail.example.c", "email"),
        ("joe@mail.example dot org", "joe@mail.example", "email"),
        ("joe@mail.example[.]co[.]uk", "joe@mail.example", "email"),
        ("+44 20 7946 095\uff18", "+44 20 7946 095", "phone"),
        ("10.0.0.\u200b1", None, "ip"),
        ("10.0.0.2\u200b1", "10.0.0.2", "ip"),
    ],
)
def test_a_disguised_span_beside_the_plain_one_in_it(span, plain, kind):
    text = f"to {span}, today"
    base, more = personal.find(text)
    assert base == personal.detect(text) and [text[s:e] for s, _, e in base] == ([plain] if plain else [])
    assert personal.written(more) == f"{kind}:3:{3 + len(span)}"
    assert personal.redacted(text, base + more) == f"to [{kind.upper()}], today"


def test_a_disguise_elsewhere_adds_nothing_to_plain_spans():
    assert personal.find("a@b.co 1.2.3.4 \u0430nd \u200b here")[1] == []
    # The address reaches beyond the plain ip in it, and both are there.
    assert personal.written(sorted(sum(personal.find("joe at 10.0.0.1"), []))) == "email:0:15,ip:7:15"


def test_redacted_documents_keep_their_columns(spark):
    docs = table(spark, [(1, "x a@b.co"), (2, None)]).withColumn("n_chars", F.length("text").cast("long"))
    got = personal.redact(docs)
    assert got.schema == docs.schema
    assert [(r.text, r.n_chars) for r in got.orderBy("doc_id").collect()] == [("x [EMAIL]", 9), (None, None)]


def test_decontamination(spark):
    item = "The quick, brown fox jumps over the lazy dog today and tomorrow"
    items = spark.createDataFrame([(7, item), (8, "short ITEM"), (9, None), (10, "--")], "item_id long, text string")
    docs = [(1, "x " + item.upper() + " y"), (2, "a short item here"), (3, "quick brown fox jumps"), (4, None), (1, "x " + item.upper() + " y")]
    got = decontaminate.contamination(table(spark, docs), items).collect()
    rows = {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got}
    assert len(got) == 5
    assert rows == {(1, 14, 12, 1, True), (2, 4, 2, 1, True), (3, 4, 0, 0, False), (4, 0, 0, 0, False)}


def test_quality_counts_and_verdict(spark):
    rng = random.Random(5)
    good = {i: words(rng, 100).capitalize() + "." for i in range(200)}
    odd = {900: "### " * 3 + words(rng, 100).replace(" ", "### "), 901: "a b\n c d\na b\n\n\n", 902: None, 903: " ".join(["x y"] * 50)}
    got = {r.doc_id: r for r in quality_rules.assess(table(spark, (good | odd).items())).collect()}
    assert len(got) == 204 and all(got[i].kept for i in good) and not any(got[i].kept for i in odd)
    assert (got[901].n_words, got[901].word_chars, got[901].n_dup_lines) == (6, 6, 1)
    assert got[903].n_repeat_words == 100 and got[902].n_words == 0 and not got[900].base_failed


def test_small_groups_are_kept(spark):
    assert all(r.kept for r in quality_rules.assess(table(spark, [(i, words(random.Random(i), 30)) for i in range(5)])).collect())


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(9)
    texts = [(i, words(rng, 80) + (" vile slime filth" * 3 if i % 4 == 0 else "")) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0), int(i % 4 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    return table(spark, texts + [(1000, None), (1001, "")]), labels


@pytest.mark.parametrize("name", ["toxic", "quality"])
def test_classifiers_on_the_held_out_fold(labelled, name):
    docs, labels = labelled
    if name == "toxic":
        scored = toxicity.score(docs, toxicity.train(docs, labels))
    else:
        scored = quality_classifier.score(docs, quality_classifier.train(docs, labels, "quality"))
    rows = scored.where(held_out() & (F.col("doc_id") < 1000)).collect()
    assert rows and all((r.score >= 0.5) == (r.doc_id % 4 == 0) for r in rows)
    assert all(0 <= r.score <= 1 for r in scored.where("doc_id >= 1000").collect())


def test_nothing_to_learn_from(labelled, spark):
    docs, labels = labelled
    none = labels.where("doc_id < 0")
    assert toxicity.score(docs, toxicity.train(docs, none)).count() == 402
    assert quality_classifier.score(docs, quality_classifier.train(docs, none)).count() == 402


def test_segments_are_the_maximal_ones():
    import numpy as np

    found = toxicity.maximal_segments(np.array([0, 1, 5, 30]), np.array([2.0, 2.0, 3.0, 1.0]), 0.5)
    assert found == [(0, 5, 5.5), (30, 30, 1.0)]


@pytest.mark.skipif(importlib.util.find_spec("public_tokenizers") is None, reason="no tokenizer files")
def test_packing(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    odd = {200: "a  b\n\n c\t.\n.x!!\nY it's ... don't x \n", 201: "end.\n", 202: "\n\n", 203: "x,\ny. 12,3#\n#"}
    got = packing.pack(table(spark, (texts | odd).items()), path, keep_ids=True).collect()
    model, held = Tokenizer.from_file(path), {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        ids = [int.from_bytes(r.ids[k : k + 4], "little") for k in range(0, len(r.ids), 4)]
        held.setdefault(r.doc_id, []).extend(ids)
        assert len(ids) == r.length <= 2048
    for i, t in (texts | odd).items():
        assert held[i] == model.encode(t or "", add_special_tokens=False).ids + [0]
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048


@pytest.mark.skipif(importlib.util.find_spec("public_tokenizers") is None, reason="no tokenizer files")
def test_added_tokens_in_texts(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path, end = public_tokenizers.path("byte_bpe_50k.json"), "<|endoftext|>"
    texts = [
        end, f"a {end} b", f"in{end}side", f"{end}{end}", f"x  {end}  y", f"a.\n{end}\nb", f"a\n\n{end}\n\n", f"{end}|,", f"{end}word.", f"it{end}'s",
        f"x, {end}. Y\n{end[:-1]} {end[1:]}", f" {end} ", "<| endoftext |>", f"\t{end}\t x", f"{end}\u00a0{end}",
    ]
    model, held = Tokenizer.from_file(path), {}
    for r in packing.pack(table(spark, enumerate(texts)), path, keep_ids=True).collect():
        held[r.doc_id] = [int.from_bytes(r.ids[k : k + 4], "little") for k in range(0, len(r.ids), 4)]
    for i, t in enumerate(texts):
        assert held[i] == model.encode(t, add_special_tokens=False).ids + [0], t


@pytest.mark.skipif(importlib.util.find_spec("public_tokenizers") is None, reason="no tokenizer files")
def test_pieces_of_texts_give_the_ids_of_the_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path, rng = public_tokenizers.path("byte_bpe_50k.json"), random.Random(7)
    parts = ["<|endoftext|>", "<|endoftext|>", " ", " ", "\n", "\t", "a", "word", "It", "'s", ".", ",", "|", "<|", "|>", "12", "\u00e9", "\u00a0", "#"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 14))) for _ in range(20_000)]
    wanted = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    got = packing.WordTokenizer(path).ids(texts)
    wrong = [t for t, e, ids in zip(texts, wanted, got) if b"".join(x.to_bytes(4, "little") for x in e.ids) != ids]
    assert not wrong, wrong[:5]


@pytest.mark.skipif(importlib.util.find_spec("public_tokenizers") is None, reason="no tokenizer files")
def test_a_piece_is_looked_up_once_for_many_texts():
    import public_tokenizers

    class Counted(dict):
        asked = 0

        def get(self, *a):
            Counted.asked += 1
            return super().get(*a)

        def __getitem__(self, k):
            Counted.asked += 1
            return super().__getitem__(k)

    tokenizer = packing.WordTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.known = Counted()
    got = tokenizer.ids(["one two two" + " two" * 1000] * 20)
    assert Counted.asked < 100 and len(set(got)) == 1


def test_workers_give_memory_back():
    import ctypes

    import numpy as np
    import psutil
    from docketframe.llm import arrays

    if not hasattr(ctypes.CDLL(None), "malloc_trim"):
        pytest.skip("not glibc")
    held = [np.ones(12_500) for _ in range(3000)]  # 100 KB each: below what is mapped by itself
    last = np.ones(12_500)
    held.clear()
    arrays.give_back()
    before = psutil.Process().memory_info().rss
    held = [np.ones(12_500) for _ in range(3000)]
    kept = held[2::3]  # holes between what is still in use
    full = psutil.Process().memory_info().rss
    held.clear()
    arrays.give_back()
    after = psutil.Process().memory_info().rss
    assert full - before > 200 << 20 and after - before < (full - before) * 0.6, (before, full, after, len(kept), len(last))


def test_archive(spark, tmp_path):
    big = "x" * 200
    rows = [(3, "u", big), (1, "u\r\nv", big), (2, None, "small"), (4, "u", "small"), (5, "u", None), (6, "u", "é" * 300_000)]
    ship_package(spark)
    index = archive.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w")).cache()
    got = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in archive.read_archive(index).collect()}
    assert got == {
        1: ("response", None, 200), 2: ("response", None, 5), 3: ("revisit", 1, 200),
        4: ("response", None, 5), 5: ("response", None, 0), 6: ("response", None, 600_000),
    }
    stored = {r.page_id: bytes(r.payload) for r in archive.fetch(index.where("page_id IN (1, 6)")).collect()}
    assert stored == {1: big.encode(), 6: ("é" * 300_000).encode()}


def test_empty_tables(spark):
    docs = table(spark, [])
    items = spark.createDataFrame([], "item_id long, text string")
    assert substring_dedup.remove_repeats(docs).isEmpty()
    assert ngram_join.near_duplicates(docs).isEmpty()
    assert secrets.find_secrets(docs).isEmpty()
    assert personal.find_personal(docs).isEmpty()
    assert decontaminate.contamination(docs, items).isEmpty()
    assert quality_rules.assess(docs).isEmpty()


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(2)
    item = words(rng, 15)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    texts = {i: words(rng, 60) for i in range(80)}
    texts |= {100: texts[0], 101: words(rng, 40) + " " + item, 102: words(rng, 40) + " a@b.co", 103: "too short"}
    rows = [(i, t, "en", "s", len(t)) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns
    rows = {r.doc_id: r.text for r in kept.collect()}
    assert set(rows) == set(range(80)) | {102} and rows[102].endswith("[EMAIL]")


def test_pipeline_judges_each_row_by_itself(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(4)
    item = words(rng, 15)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    a, b, c, d, e = (words(rng, 60) for _ in range(5))
    leak = words(rng, 40) + " " + item
    good = [(i, words(rng, 60)) for i in range(100, 160)]
    rows = [
        (1, a), (1, b), (1, "too short"),  # one id, texts that are not alike, one poor
        (2, b), (2, leak), (3, c), (3, c), (None, c),  # b is there with a smaller id
        (None, d), (None, d), (None, e), (None, leak + " x"), (None, "poor"), (None, None),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in rows + good], "doc_id long, text string, lang string, source string")

    def after(*names):
        kept = docs
        for name, stage in corpus_pipeline.STAGES:
            if name in names:
                kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns
        return sorted(((r.doc_id, r.text) for r in kept.collect() if r.doc_id is None or r.doc_id < 100), key=str)

    def wanted(*gone):
        return sorted((r for r in rows if r[1] not in gone), key=str)

    assert after("quality_rules") == wanted("too short", "poor", None)
    assert after("decontamination") == wanted(leak, leak + " x")
    copies = sorted([(1, a), (1, b), (3, c), (None, d), (None, e), (2, leak)], key=str)
    assert after("quality_rules", "ngram_join") == copies
    assert after("quality_rules", "ngram_join", "decontamination") == [r for r in copies if r[1] != leak]
