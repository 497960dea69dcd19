"""Toxic passages: maximal segments of word log-odds, calibrated by extreme values.

Words get log-odds of toxic against other texts under a Dirichlet prior; those
that stand out are the model, all others count slightly against.  In each text a
linear scan finds every maximal scoring segment.  How surprising a best segment
is follows from the extreme-value law of clean text of the same length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketframe.llm import arrays, shared_keys
from docketframe.llm.labelled import training_rows

#: Bound on the labelled rows that are learned from, and on words in the model.
MAX_ROWS = 20_000
MAX_WORDS = 20_000
#: Weight of the prior, as a share of all counts, and least z score of a word.
PRIOR = 0.05
LEAST_Z = 2.5
#: What a word outside the model scores.
DRIFT = 0.5

LETTERS = arrays.byte_class((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))

RESULT = "doc_id long, score double, passages array<struct<first_word: long, last_word: long, score: double>>"


@dataclass
class Model:
    keys: np.ndarray  # sorted hashes of words
    scores: np.ndarray
    decay: float  # lambda of the extreme-value law
    scale: float  # its K
    weights: np.ndarray  # of the calibration


def maximal_segments(places: np.ndarray, scores: np.ndarray, drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score); places between hits score -drift."""
    segments: list[tuple[int, int, float, float, int]] = []  # first, last, sum before, sum after, left neighbour with a lesser sum before
    total, last = 0.0, -1
    for place, score in zip(places.tolist(), scores.tolist()):
        before = total - drift * (place - last - 1)
        total, last = before + score, place
        first, left = place, len(segments) - 1
        while True:
            while left >= 0 and segments[left][2] >= before:
                left = segments[left][4]
            if left < 0 or segments[left][3] >= total:
                break
            first, _, before, _, further = segments[left]
            del segments[left:]
            left = further
        segments.append((first, place, before, total, left))
    return [(a, b, after - before) for a, b, before, after, _ in segments]


def _hits(words: arrays.Words, model_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words of the batch that are in the model, their places there)."""
    if not len(model_keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(model_keys, words.hash), len(model_keys) - 1)
    hit = np.flatnonzero(model_keys[at] == words.hash)
    return hit, at[hit]


def _segments(b: shared_keys.Batch, keys: np.ndarray, scores: np.ndarray):
    """Per text: number of words, segments."""
    words = b.words(LETTERS, lower=True)
    hit, which = _hits(words, keys)
    edges = np.searchsorted(hit, words.first)
    for i, n in enumerate(words.counts):
        own = slice(edges[i], edges[i + 1])
        yield int(n), maximal_segments(hit[own] - words.first[i], scores[which[own]])


def _features(n: int, segments: list, decay: float, scale: float) -> list[float]:
    """What the calibration sees: the surprise of the best segment, and that of all together."""
    surprises = sorted((decay * s - np.log(scale * max(n, 1)) for _, _, s in segments), reverse=True)
    best = surprises[0] if surprises else -1.0
    return [1.0, float(np.clip(best, -1, 30)), float(np.log1p(sum(max(x, 0) for x in surprises)))]


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_words: int = MAX_WORDS) -> Model:
    """Learn from at most ``max_rows`` labelled rows outside the held-out fold.

    Rows without a label or text say nothing.  Without rows of both labels the model is
    empty, and every score the share of toxic rows, or 0.
    """
    rows = training_rows(docs, labels, "toxic", max_rows)

    def count(source):
        for batch in source:
            texts, toxic = batch["text"], batch["label"].to_numpy().astype(np.int64)
            data, sizes = arrays.joined(texts)
            words = arrays.Words(np.frombuffer(data, np.uint8), sizes, LETTERS, lower=True)
            first, _, _ = arrays.distinct(words.hash, words.doc.astype(np.uint64))  # once a text
            key, of = words.hash[first], toxic[words.doc[first]]
            at, group, n = arrays.distinct(key)
            bad = np.bincount(group, of, len(n)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"key": key[at].view(np.int64), "bad": bad, "good": n - bad})

    counts = rows.select("text", "label").mapInArrow(count, "key long, bad long, good long")
    counts = counts.groupBy("key").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    totals = counts.agg(F.sum("bad"), F.sum("good")).first()
    n_bad, n_good = totals[0] or 0, totals[1] or 0
    if not n_bad or not n_good:
        share = 1.0 if n_bad else 0.0
        return Model(np.zeros(0, np.uint64), np.zeros(0), 1.0, 1.0, np.array([20.0 if share else -20.0, 0, 0]))
    prior = PRIOR * (n_bad + n_good)
    alpha = F.lit(prior) * (F.col("bad") + F.col("good")) / F.lit(n_bad + n_good)
    bad, good = F.col("bad") + alpha, F.col("good") + alpha
    odds = F.log(bad / (n_bad + prior - bad)) - F.log(good / (n_good + prior - good))
    z = odds / F.sqrt(1 / bad + 1 / good)
    best = counts.select("key", odds.alias("odds"), z.alias("z"), (good / (n_good + prior)).alias("rate"))
    best = best.where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "key").limit(max_words).toPandas()
    keys = best["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    keys, scores, rate = keys[order], best["odds"].to_numpy()[order] - DRIFT, best["rate"].to_numpy()[order]
    scores = np.maximum(scores, DRIFT)
    decay = _decay(scores, rate)

    def segments(source):
        for batch in source:
            data, sizes = arrays.joined(batch["text"])
            b = shared_keys.Batch(0, [], data, sizes)
            found = list(_segments(b, keys, scores))
            yield pa.RecordBatch.from_pydict({
                "label": batch["label"].cast(pa.int64()),
                "n": pa.array([n for n, _ in found], pa.int64()),
                "scores": pa.array([[s for _, _, s in x] for _, x in found], pa.list_(pa.float64())),
            })

    seen = rows.select("text", "label").mapInArrow(segments, "label long, n long, scores array<double>").collect()  # at most max_rows
    # K: how many segments clean text has, against what the law says for K = 1.
    least = float(scores.min()) if len(scores) else 1.0
    clean = [r for r in seen if r["label"] == 0]
    many = 0.5 + sum(sum(s >= least for s in r["scores"]) for r in clean)
    scale = many / (max(1, sum(r["n"] for r in clean)) * np.exp(-decay * least))
    x = np.array([_features(r["n"], [(0, 0, s) for s in r["scores"]], decay, scale) for r in seen])
    y = np.array([r["label"] for r in seen], float)
    return Model(keys, scores, decay, float(scale), _logistic(x, y))


def _decay(scores: np.ndarray, rate: np.ndarray) -> float:
    """The positive root of sum(rate * exp(root * score)) = 1 over all words of clean text."""
    rest = max(1e-9, 1 - rate.sum())
    low, high = 1e-3, 50.0
    for _ in range(100):
        at = (low + high) / 2
        with np.errstate(over="ignore"):
            above = rest * np.exp(-DRIFT * at) + (rate * np.exp(at * scores)).sum() > 1
        low, high = (low, at) if above else (at, high)
    return low


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton steps of a logistic regression."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step * min(1.0, 5 / (np.abs(step).max() + 1e-9))
    return w


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) and the toxic passages, in words, of each row of ``docs``.

    ``docs`` has doc_id and text; other columns are ignored.  Null and empty
    texts have no passage and the score of that.  Rows repeated, null doc_id
    included, each give the same row.  No rows give no rows.  A passage is
    listed if clean text of that length holds a better one less than one time in e.
    """

    def use(b: shared_keys.Batch) -> pa.RecordBatch:
        scores, passages = [], []
        for n, segments in _segments(b, model.keys, model.scores):
            x = float(np.dot(_features(n, segments, model.decay, model.scale), model.weights))
            scores.append(1 / (1 + np.exp(-np.clip(x, -30, 30))))
            passages.append(
                [{"first_word": a, "last_word": z, "score": s} for a, z, s in segments if model.decay * s > np.log(model.scale * max(n, 1))]
            )
        kind = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("score", pa.float64())]))
        return pa.RecordBatch.from_pydict({"doc_id": pa.array(b.ids, pa.int64()), "score": pa.array(scores, pa.float64()), "passages": pa.array(passages, kind)})

    return shared_keys.mapped(docs, use, RESULT)
