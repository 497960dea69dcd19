"""Quality rules: counts of a text, and robust outliers among texts of its kind.

Per language and source, the minimum covariance determinant: the centre and
covariance of the three quarters of the texts that lie closest together, found
by concentration steps from medians and quartiles.  A step is two aggregations
over a narrow table, so no group's rows meet in one task.  A text is rejected
if its transformed statistics lie too far by Mahalanobis distance.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketframe.llm import arrays
from docketframe.session import staged

#: Bytes of text taken at a time, unless one text alone is longer; arrays of some 50 times that are made of them.
BATCH_BYTES = 1_000_000
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Share of a group that its estimate rests on.
CORE = 0.75
STEPS = 4
#: Smaller groups are pooled: with others of their language, then with all.
LEAST_GROUP = 50
#: Share of good texts that the cut would reject if their statistics were normal.
REJECTED = 1e-8

SYMBOLS = b"#*$%&|<>"
#: Transformed statistics and the least standard deviation that each is given:
#: square roots of rates, and the logarithm of the mean length of words.
STATISTICS = {"symbols": 0.10, "capitals": 0.10, "word_length": 0.15, "repeats": 0.12, "same_lines": 0.12, "marks": 0.10}

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FACTS = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS) + ", " + ", ".join(f"{s} double" for s in STATISTICS)


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL, _CAPITAL, _MARK = _table(SYMBOLS), _table(bytes(range(65, 91))), _table(b".,;:!?")


def _same_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    seen, n = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\x0b\x0c\r"):
            n += line in seen
            seen.add(line)
    return n


def _facts(texts: pa.Array) -> dict[str, np.ndarray]:
    data, sizes = arrays.joined(texts)
    w = arrays.Words(np.frombuffer(data, np.uint8), sizes, arrays.BLANK_SEPARATED)
    starts = w.bounds[:-1]

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags, starts, dtype=np.int64)

    inside = arrays.BLANK_SEPARATED[w.data].astype(bool)
    at = np.flatnonzero(w.whole(REPEAT_WINDOW))
    again = np.zeros(len(w) + 1, np.int64)
    if len(at):
        # Windows are equal within one text only: its number is the second lane.
        _, group, n = arrays.distinct(w.windows(REPEAT_WINDOW)[at], w.doc[at].astype(np.uint64))
        again[:-1] = arrays.cover(at[n[group] > 1], REPEAT_WINDOW, len(w))
    out = {
        "n_words": w.counts,
        "word_chars": per_text(inside & ((w.data & 0xC0) != 0x80)),
        "n_symbols": per_text(_SYMBOL[w.data]),
        "n_dup_lines": np.array([_same_lines(t or "") for t in texts.to_pylist()], np.int64),
        "n_repeat_words": np.add.reduceat(again, w.first[:-1]) * (w.counts > 0),
    }
    words, chars = np.maximum(w.counts, 1), np.maximum(out["word_chars"], 1)
    out["symbols"] = np.sqrt(out["n_symbols"] / words)
    out["capitals"] = np.sqrt(per_text(_CAPITAL[w.data]) / chars)
    out["word_length"] = np.log(chars / words)
    out["repeats"] = np.sqrt(out["n_repeat_words"] / words)
    out["same_lines"] = np.sqrt(out["n_dup_lines"] / (1 + per_text(w.data == 10)))
    out["marks"] = np.sqrt(per_text(_MARK[w.data]) / words)
    return out


def statistics(docs: DataFrame) -> DataFrame:
    """Counts and transformed statistics per row; null texts have no words."""

    def run(source):
        arrays.give_back()
        for rows in source:
            size, cut = 0, [0]
            for i, n in enumerate(pc.fill_null(pc.binary_length(rows["text"]), 0).to_pylist()):
                if size and size + n > BATCH_BYTES:
                    cut.append(i)
                    size = 0
                size += n + 1
            for a, b in zip(cut, [*cut[1:], rows.num_rows]):
                if a < b:
                    part = rows.slice(a, b - a)
                    facts = _facts(part["text"])
                    yield pa.RecordBatch.from_arrays(
                        [part["doc_id"], part["lang"], part["source"], *map(pa.array, facts.values())],
                        ["doc_id", "lang", "source", *facts],
                    )
        arrays.give_back()

    return docs.select(
        F.col("doc_id").cast("long"), *[F.col(c).cast("string") for c in ("lang", "source", "text")]
    ).mapInArrow(run, FACTS)


# -- estimates ------------------------------------------------------------------


def chi2_below(x: float, d: int) -> float:
    """Distribution function of chi square, d even."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(d // 2))


def chi2_quantile(above: float, d: int) -> float:
    """The value that chi square exceeds with the probability given, d even."""
    low, high = 0.0, 1e4
    for _ in range(200):
        x = (low + high) / 2
        tail = math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(d // 2))
        low, high = (x, high) if tail > above else (low, x)
    return low


def _with_group(facts: DataFrame, least: int) -> DataFrame:
    """A column ``key``: the group whose estimate judges the row."""
    lang, source = (F.coalesce(F.col(c), F.lit("")) for c in ("lang", "source"))
    facts = facts.withColumns({"_lang": lang, "_source": source})
    sizes = facts.groupBy("_lang", "_source").agg(F.count("*").alias("n"))
    own = F.to_json(F.array("_lang", "_source"))
    small = staged(sizes.withColumn("key", F.when(F.col("n") >= least, own)))
    pooled = small.where("key IS NULL").groupBy("_lang").agg(F.sum("n").alias("m"))
    keys = small.join(pooled, "_lang", "left").select(
        "_lang", "_source",
        F.coalesce("key", F.when(F.col("m") >= least, F.to_json(F.array("_lang"))), F.lit("[]")).alias("key"),
    )
    return facts.join(keys, ["_lang", "_source"]).drop("_lang", "_source")


_PARAMS = "key string, centre array<double>, inverse array<double>"


def _squared(names: list[str]) -> Column:
    """Mahalanobis distance, squared, from columns ``centre`` and ``inverse``."""
    d = len(names)
    off = [F.col(s) - F.get(F.col("centre"), F.lit(i)) for i, s in enumerate(names)]
    terms = [off[i] * off[j] * F.get(F.col("inverse"), F.lit(i * d + j)) * (1 if i == j else 2) for i in range(d) for j in range(i, d)]
    return sum(terms[1:], terms[0])


def estimates(facts: DataFrame, core: float = CORE, steps: int = STEPS) -> DataFrame:
    """key, centre and inverse covariance of each group of ``facts``."""
    names, floors = list(STATISTICS), np.array(list(STATISTICS.values()))
    d = len(names)
    quarter = chi2_quantile(1 - core, d)
    wider = core / chi2_below(quarter, d + 2)  # a core's covariance is that much too small

    def from_quartiles(source):
        for rows in source:
            centre, inverse = [], []
            for q in zip(*(rows[s].to_pylist() for s in names)):
                scale = np.maximum([(x[2] - x[0]) / 1.349 for x in q], floors)
                centre.append([x[1] for x in q])
                inverse.append(np.diag(scale**-2).ravel())
            yield pa.RecordBatch.from_pydict({"key": rows["key"], "centre": centre, "inverse": inverse}, kinds)

    def from_sums(source):
        for rows in source:
            centre, inverse = [], []
            for r in rows.to_pylist():
                mean = np.array([r[f"s{i}"] for i in range(d)]) / r["n"]
                second = np.array([[r[f"p{min(i, j)}_{max(i, j)}"] for j in range(d)] for i in range(d)]) / r["n"]
                spread = (second - np.outer(mean, mean)) * wider
                centre.append(mean)
                # Statistics that hardly vary in the core would make any other value an outlier.
                inverse.append(np.linalg.inv(spread + np.diag(floors**2)).ravel())
            yield pa.RecordBatch.from_pydict({"key": rows["key"], "centre": centre, "inverse": inverse}, kinds)

    kinds = pa.schema([("key", pa.string()), ("centre", pa.list_(pa.float64())), ("inverse", pa.list_(pa.float64()))])
    quartiles = [F.percentile_approx(s, [0.25, 0.5, 0.75], 2000).alias(s) for s in names]
    params = staged(facts.groupBy("key").agg(*quartiles).mapInArrow(from_quartiles, _PARAMS))
    for _ in range(steps):
        far = facts.join(params, "key").select("key", *names, _squared(names).alias("far"))
        cut = far.groupBy("key").agg(F.percentile_approx("far", core, 2000).alias("cut"))
        sums = [F.sum(s).alias(f"s{i}") for i, s in enumerate(names)]
        sums += [F.sum(F.col(names[i]) * F.col(names[j])).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
        near = far.join(cut, "key").where("far <= cut").groupBy("key").agg(F.count("*").alias("n"), *sums)
        params = staged(near.mapInArrow(from_sums, _PARAMS))
    return params


def assess(docs: DataFrame, core: float = CORE, least_group: int = LEAST_GROUP, rejected: float = REJECTED) -> DataFrame:
    """Counts, distance and verdict of each row of ``docs``.

    ``docs`` has doc_id, text, lang and source; other columns are ignored.  A
    null text has no words; null lang or source counts as ''.  base_failed:
    fewer than MIN_WORDS words, or more than MAX_REPEAT_PERCENT of the words in
    repeated windows.  The estimates rest on all rows that are not base_failed;
    groups of fewer than ``least_group`` of them are pooled, and where even all
    small ones together are fewer, the distance is null and such rows are kept.
    Rows repeated, null doc_id included, each count and get the same row.  No
    rows give no rows.
    """
    names = list(STATISTICS)
    facts = statistics(docs)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    facts = staged(facts.withColumn("base_failed", failed))
    grouped = staged(_with_group(facts.where("NOT base_failed").select("doc_id", "lang", "source", *COUNTS, *names), least_group))
    enough = grouped.groupBy("key").agg(F.count("*").alias("n")).where(f"n >= {least_group}").select("key")
    params = estimates(grouped.join(enough, "key", "left_semi"), core)
    judged = grouped.join(params, "key", "left").withColumn("distance", F.sqrt(F.greatest(_squared(names), F.lit(0.0))))
    cut = math.sqrt(chi2_quantile(rejected, len(names)))
    judged = judged.select(
        "doc_id", *COUNTS, F.lit(False).alias("base_failed"), F.coalesce(F.col("distance") <= cut, F.lit(True)).alias("kept"), "distance"
    )
    return judged.unionByName(
        facts.where("base_failed").select("doc_id", *COUNTS, "base_failed", F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance"))
    )
