"""Periodic runs of words in texts: stretches that repeat a short sequence of words again and again.

Suffixes that share their first words are classes; going down from the longest
common prefix, classes unite (union-find, the smaller one into the larger), and
each keeps its positions in order.  Two positions that become neighbours at a
prefix of l words and stand q apart, q within l, are a stretch of period q: no
position between them starts alike, so no shorter period fits.  All stretches of one
period and one end are one run, and its first position is among them, so the
earliest of them is where the run starts.

Runs wanted here hold at least ``times`` periods and ``least`` words, so two
such neighbours share at least ``least`` words, less q, and ``times - 1`` periods; shorter prefixes need
not be looked at.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_WORDS = 6
LEAST_TIMES = 4

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = (
    "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
    "strongest struct<start:long,length:long,period:long>, collapsed string"
)

#: Given doc_id and the words of its text, the words to look at.
Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


def alike_neighbours(labels: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in suffix order that share ``least`` words or more: (position, position, words shared).

    ``labels`` are small numbers that equal words of one text share, and words of
    different texts do not; ``ends`` is the end of the text of each position.
    Suffixes are put in order by doubling the prefix looked at; those that are
    alone with their prefix are left out from then on.
    """
    n = len(labels)
    sizes = np.bincount(labels)
    rank = (np.cumsum(sizes) - sizes)[labels]
    left = np.flatnonzero(sizes[labels] > 1)
    levels, width = [rank.astype(np.int32)], 1
    while len(left):
        ahead = left + width
        inside = ahead < ends[left]
        key = rank[left] * (n + 1) + np.where(inside, rank[np.where(inside, ahead, 0)] + 1, 0)
        order = np.argsort(key)
        left, key = left[order], key[order]
        old = rank[left]
        place = np.arange(len(left))
        new = np.ones(len(left), bool)
        new[1:] = key[1:] != key[:-1]
        wider = np.ones(len(left), bool)
        wider[1:] = old[1:] != old[:-1]
        start = np.maximum.accumulate(np.where(new, place, 0))
        rank[left] = old + start - np.maximum.accumulate(np.where(wider, place, 0))
        alone = new & np.append(new[1:], True)
        left = left[~alone]
        levels.append(rank.astype(np.int32))
        width *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    # Equal labels of the widest prefix that is no longer than wanted come first: few pairs are left.
    widest = min(len(levels), max(1, least.bit_length())) - 1
    a, b = order[:-1], order[1:]
    near = levels[widest][a] == levels[widest][b]
    a, b = a[near], b[near]
    shared = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        pa_, pb = a + shared, b + shared
        inside = (pa_ < ends[a]) & (pb < ends[b])
        same = inside & (levels[k][np.where(inside, pa_, 0)] == levels[k][np.where(inside, pb, 0)])
        shared[same] += 1 << k
    enough = shared >= least
    return a[enough], b[enough], shared[enough]


def runs_of(a: np.ndarray, b: np.ndarray, shared: np.ndarray, least: int, times: int) -> dict[tuple[int, int], int]:
    """Start of each run, by (period, end), from neighbours in suffix order."""
    order = np.lexsort((np.minimum(a, b), -shared))
    found: dict[tuple[int, int], int] = {}
    home: dict[int, list[int]] = {}  # the class of a position: its positions in order

    def seed(low: int, high: int, words: int) -> None:
        period = high - low
        if (times - 1) * period <= words and period + words >= least:
            key = (period, high + words)
            if low < found.get(key, high):
                found[key] = low

    for x, y, words in zip(a[order].tolist(), b[order].tolist(), shared[order].tolist()):
        large, small = home.get(x) or [x], home.get(y) or [y]
        if len(large) < len(small):
            large, small = small, large
        home.setdefault(large[0], large)
        for p in small:
            insort(large, p)
        for p in small:
            i = bisect_left(large, p)
            # A neighbour that came along with p was its neighbour before.
            if i and home.get(large[i - 1]) is large:
                seed(large[i - 1], p, words)
            if i + 1 < len(large) and home.get(large[i + 1]) is large:
                seed(p, large[i + 1], words)
        for p in small:
            home[p] = large
    return found


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run (start, length, period) with most periods, the first of them, then of the shorter period."""
    best = None
    for run in runs:
        if best is None:
            best = run
            continue
        more = run[1] * best[2] - best[1] * run[2]
        if more > 0 or more == 0 and (run[0], run[2]) < (best[0], best[2]):
            best = run
    return best


def text_runs(texts: list[list[bytes]], least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each list of words, by start and period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    if not sizes.sum():
        return [[] for _ in texts]
    labels, base = [], 0
    for words in texts:
        numbers: dict[bytes, int] = {}
        labels += [numbers.setdefault(w, base + len(numbers)) for w in words]
        base += len(numbers)
    stop = np.cumsum(sizes)
    # A period of q needs max(least - q, (times - 1) * q) shared words: the least of these over all q.
    shared = min(max(least - q, (times - 1) * q) for q in range(1, least + 1))
    pairs = alike_neighbours(np.array(labels, np.int64), np.repeat(stop, sizes), shared)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = runs_of(*pairs, least, times)
    if found:
        starts = np.fromiter(found.values(), np.int64, len(found))
        docs = np.searchsorted(stop, starts, "right").tolist()
        for doc, ((period, end), start) in zip(docs, found.items()):
            out[doc].append((start - int(stop[doc] - sizes[doc]), end - start, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words left when each run keeps its first period only, joined by blanks."""
    if not runs:
        return b" ".join(words).decode()
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept)]).decode()


def find_runs(docs: DataFrame, rewrite: Rewrite | None = None, least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> DataFrame:
    """The periodic runs of each text, the strongest of them, and the text without their repeats.

    ``docs`` has doc_id and text; other columns are ignored.  Words are what
    ASCII white space separates, numbered from 0.  A run is a stretch with smallest period q and
    at least ``least`` words and ``times`` periods that neither neighbour
    continues.  ``rewrite`` may replace a text's words first.  Null, empty and blank texts
    have no words and no runs.  Each row is judged by itself, so repeated rows
    give repeated rows, and a null doc_id stays null.  A text of any length is
    looked at whole.  No rows give no rows.
    """
    kinds = [pa.int64(), pa.int64(), pa.list_(RUN), RUN, pa.string()]
    schema = pa.schema(list(zip(("doc_id", "n_words", "runs", "strongest", "collapsed"), kinds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = RUN.names
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            texts = [(t or "").encode().split() for t in batch["text"].to_pylist()]
            if rewrite:
                texts = [rewrite(i, words) for i, words in zip(ids, texts)]
            runs = text_runs(texts, least, times)
            best = [strongest(r) for r in runs]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, kinds[0]),
                    pa.array([len(t) for t in texts], kinds[1]),
                    pa.array([[dict(zip(names, r)) for r in own] for own in runs], kinds[2]),
                    pa.array([r and dict(zip(names, r)) for r in best], kinds[3]),
                    pa.array([collapsed(t, r) for t, r in zip(texts, runs)], kinds[4]),
                ],
                schema=schema,
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, RUNS)
