"""The registered queries of this subpackage: thin uses of its operators on whole tables."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketframe.llm import (
    archive,
    decontaminate,
    fill_in_middle,
    ngram_join,
    oracles,
    packing,
    periodic_runs,
    personal,
    quality_classifier,
    quality_rules,
    secrets,
    substring_dedup,
    toxicity,
    vector_graph,
)
from docketframe.llm.labelled import held_out
from docketframe.session import ship_package

#: The file of the public tokenizers that packing uses here.
TOKENIZER = "byte_bpe_50k.json"


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark, sf_dir):
    removed = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), min_words=35, keep_text=False)
    return removed.drop("kept_text")


def op2_secret_scan(spark, sf_dir):
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op3_personal_data(spark, sf_dir):
    return personal.find_personal(table(spark, sf_dir, "documents")).drop("redacted")


def op4_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_decontamination(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality_rules(spark, sf_dir):
    return quality_rules.assess(table(spark, sf_dir, "documents"))


def _predicted(scored: DataFrame, least: float) -> DataFrame:
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return _predicted(toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels"))), 0.5)


def op8_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return _predicted(quality_classifier.score(docs, quality_classifier.train(docs, table(spark, sf_dir, "labels"))), 0.3)


def op9_packing(spark, sf_dir):
    import public_tokenizers

    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_warc(spark, sf_dir):
    back = archive.round_trip(table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _planted_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """One text in ten repeats a part of itself up to its end; which, where and how follows from doc_id."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op11_periodic_runs(spark, sf_dir):
    found = periodic_runs.find_runs(table(spark, sf_dir, "documents"), rewrite=_planted_tail)
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"strongest.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("strongest.length * 1000 div strongest.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_nearest_neighbours(spark, sf_dir):
    return vector_graph.search_all(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op13_fill_in_middle(spark, sf_dir):
    cut = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_secret_scan": op2_secret_scan,
    "op3_personal_data": op3_personal_data,
    "op4_ngram_join": op4_ngram_join,
    "op5_decontamination": op5_decontamination,
    "op6_quality_rules": op6_quality_rules,
    "op7_toxicity": op7_toxicity,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_packing": op9_packing,
    "op10_warc": op10_warc,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_nearest_neighbours": op12_nearest_neighbours,
    "op13_fill_in_middle": op13_fill_in_middle,
    "pipeline": pipeline,
}

ORACLE_SQL: dict[str, str] = oracles.ORACLE_SQL
