"""A text classifier by supervised subword embeddings.

Words, pairs of words and runs of four bytes are hashed to buckets, each with a
learned vector.  A text is the mean of its vectors, and a softmax over two
classes reads it.  The vectors and the softmax are trained together by
stochastic gradient descent on a bounded sample.  As the softmax is linear in
the mean, scoring needs one number per bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketframe.llm import arrays, shared_keys
from docketframe.llm.labelled import training_rows

#: Bound on the labelled rows that are learned from.
MAX_ROWS = 4_000
BITS = 17
DIMENSION = 8
EPOCHS = 8
RATE = 20.0
GRAM = 4

RESULT = "doc_id long, score double"


@dataclass
class Model:
    margins: np.ndarray  # log-odds that each bucket's vector adds, times its share
    bias: float


def _buckets(b: shared_keys.Batch, bits: int):
    """(buckets of all features, their texts), in parts: byte runs, words, pairs, repeats."""
    words = b.words()
    shift = np.uint64(64 - bits)
    n = max(0, len(words.data) - GRAM + 1)
    run = np.zeros(n, np.uint64)
    for i in range(GRAM):
        run |= words.data[i : i + n].astype(np.uint64) << np.uint64(8 * i)
    text_of = np.repeat(np.arange(len(b.sizes)), b.sizes + 1)
    yield (arrays.mix(run + np.uint64(1)) >> shift).astype(np.int32), text_of[:n], text_of[GRAM - 1 :] == text_of[:n]
    yield (words.hash >> shift).astype(np.int32), words.doc, np.ones(len(words), bool)
    yield (words.windows(2) >> shift).astype(np.int32), words.doc[: max(0, len(words) - 1)], words.whole(2)
    # A word after itself, whatever the word: the pair that no list of pairs can hold.
    again = np.flatnonzero((words.hash[1:] == words.hash[:-1]) & words.whole(2))
    yield np.zeros(len(again), np.int32), words.doc[again], np.ones(len(again), bool)


def fit(features: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bits: int, dimension: int, epochs: int, rate: float) -> Model:
    """Stochastic gradient descent; ``features``: distinct buckets and their shares of each text."""
    random = np.random.default_rng(11)
    vectors = (random.random((1 << bits, dimension), np.float32) - 0.5) / dimension
    read = ((random.random((2, dimension)) - 0.5) * 2).astype(np.float32)
    bias, steps, done = np.zeros(2, np.float32), epochs * len(labels), 0
    for _ in range(epochs):
        for i in random.permutation(len(labels)):
            at, share = features[i]
            if not len(at):
                continue
            mean = share @ vectors[at]
            logits = read @ mean + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            now = rate * (1 - done / steps)
            back = p @ read
            read -= 0.02 * now * np.outer(p, mean)
            bias -= 0.005 * now * p
            vectors[at] -= now * np.outer(share, back)
            done += 1
    margin = read[1] - read[0]
    return Model((vectors @ margin).astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS, bits: int = BITS) -> Model:
    """Learn from at most ``max_rows`` labelled rows outside the held-out fold, whole texts each.

    Without rows of both labels every score is the share of label 1, or 1 if there is no row.
    """

    def extract(source):
        for rows in source:
            for at in range(0, rows.num_rows, 100):
                part = rows.slice(at, 100)
                data, sizes = arrays.joined(part["text"])
                b, found = shared_keys.Batch(0, [], data, sizes), [[] for _ in range(len(part))]
                for bucket, text, whole in _buckets(b, bits):
                    bucket, text = bucket[whole], text[whole]
                    edges = np.searchsorted(text, np.arange(len(part) + 1))
                    for i in range(len(part)):
                        found[i].append(bucket[edges[i] : edges[i + 1]])
                own = [np.unique(np.concatenate(x), return_counts=True) for x in found]
                yield pa.RecordBatch.from_pydict({
                    "label": part["label"].cast(pa.int64()),
                    "buckets": pa.array([u.astype("<i4").tobytes() for u, _ in own], pa.binary()),
                    "shares": pa.array([(c / max(1, c.sum())).astype("<f4").tobytes() for _, c in own], pa.binary()),
                })

    def learn(rows: pa.Table) -> pa.Table:
        y = rows["label"].to_numpy().astype(np.int64)
        x = [(np.frombuffer(a, "<i4"), np.frombuffer(s, "<f4")) for a, s in zip(rows["buckets"].to_pylist(), rows["shares"].to_pylist())]
        order = sorted(range(len(y)), key=lambda i: (len(x[i][0]), x[i][0].tobytes(), y[i]))  # the same order in every run
        m = fit([x[i] for i in order], y[order], bits, DIMENSION, EPOCHS, RATE)
        return pa.table({"margins": pa.array([m.margins.tobytes()], pa.binary()), "bias": [m.bias], "good": [int(y.sum())], "n": [len(y)]})

    rows = training_rows(docs, labels, label, max_rows).select("text", "label")
    sample = rows.mapInArrow(extract, "label long, buckets binary, shares binary")
    # One group of at most max_rows rows.
    got = sample.withColumn("all", F.lit(1)).groupBy("all").applyInArrow(learn, "margins binary, bias double, good long, n long").first()
    if got is None or got["good"] in (0, got["n"]):
        return Model(np.zeros(1 << bits, np.float32), 20.0 if got is None or got["good"] else -20.0)
    return Model(np.frombuffer(got["margins"], np.float32), got["bias"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of each row of ``docs``.

    ``docs`` has doc_id and text; other columns are ignored.  Null and empty
    texts have no features and the score of the bias alone.  Rows repeated,
    null doc_id included, each give the same row.  No rows give no rows.
    """
    bits = int(len(model.margins)).bit_length() - 1

    def use(b: shared_keys.Batch) -> pa.RecordBatch:
        total, n = np.zeros(len(b.ids)), np.zeros(len(b.ids))
        for bucket, text, whole in _buckets(b, bits):
            total += np.bincount(text, np.where(whole, model.margins[bucket], 0), len(b.ids))
            n += np.bincount(text, whole, len(b.ids))
        logit = total / np.maximum(n, 1) + model.bias
        return pa.RecordBatch.from_pydict({"doc_id": pa.array(b.ids, pa.int64()), "score": 1 / (1 + np.exp(-np.clip(logit, -30, 30)))})

    return shared_keys.mapped(docs, use, RESULT)
