"""Fill-in-middle training texts, cut at token boundaries through a learned rank index.

The offsets of all token boundaries of a text, in order, are a monotone function
of their rank.  :class:`RankIndex` learns that function as straight segments,
each within a stated error of every boundary it covers, and stores what the
line misses each boundary by in one byte.  A cut is then the predicted offset
plus its residual, which is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
#: Code points by which a segment may miss a boundary; a residual is one signed byte.
MAX_ERROR = 127

FORMS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class RankIndex:
    """Offsets by rank for several texts at once: learned segments and residuals.

    ``offsets`` holds the boundary offsets of all texts, one text after the
    other, and ``first`` the place of each text's first boundary.  A segment
    runs from its first to its last offset; one that misses a boundary by more
    than ``max_error`` is cut in two, so the number of segments follows the
    shape of the texts and not their number of boundaries.
    """

    def __init__(self, offsets: np.ndarray, first: np.ndarray, max_error: int = MAX_ERROR):
        self.residual = np.zeros(len(offsets), np.int8)
        low, high = first.astype(np.int64), np.append(first[1:], len(offsets)).astype(np.int64) - 1
        kept = []
        while len(low):
            slope = (offsets[high] - offsets[low]) / np.maximum(high - low, 1)
            sizes = high - low + 1
            starts = np.cumsum(sizes) - sizes
            step = np.arange(sizes.sum()) - np.repeat(starts, sizes)
            at = step + np.repeat(low, sizes)
            missed = offsets[at] - self._line(np.repeat(offsets[low], sizes), np.repeat(slope, sizes), step)
            good = np.maximum.reduceat(np.abs(missed), starts) <= max_error
            inside = np.repeat(good, sizes)
            self.residual[at[inside]] = missed[inside]
            kept.append((low[good], offsets[low[good]], slope[good]))
            low, high = low[~good], high[~good]
            middle = (low + high) // 2
            low, high = np.concatenate([low, middle + 1]), np.concatenate([middle, high])
        columns = [np.concatenate(c) if kept else np.zeros(0, np.int64) for c in zip(*kept)] or [np.zeros(0, np.int64)] * 3
        order = np.argsort(columns[0])
        self.low, self.base, self.slope = (c[order] for c in columns)

    @staticmethod
    def _line(base: np.ndarray, slope: np.ndarray, step: np.ndarray) -> np.ndarray:
        return base + np.floor(slope * step).astype(np.int64)

    def __len__(self) -> int:
        return len(self.low)

    def predicted(self, rank: np.ndarray) -> np.ndarray:
        k = np.searchsorted(self.low, rank, "right") - 1
        return self._line(self.base[k], self.slope[k], rank - self.low[k])

    def offset(self, rank: np.ndarray) -> np.ndarray:
        return self.predicted(rank) + self.residual[rank]


_SPACE = np.zeros(0x21, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def boundaries(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets of all token boundaries, place of each text's first, tokens of each text).

    A token is a word with the white space before it, or what white space ends
    the text.  Offsets count code points within the text; the first is 0.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    space = (points < 0x21) & _SPACE[np.minimum(points, 0x20)]
    # A boundary stands after the last character of a word and after that of a text.
    last = np.zeros(len(points) + 1, bool)
    last[ends[sizes > 0]] = True
    after = np.ones(len(points) + 1, bool)
    after[:-1] = space
    last[1:] |= ~space & after[1:]
    found = np.flatnonzero(last[1:]) + 1
    doc = np.searchsorted(ends, found, "left")
    n = np.bincount(doc, minlength=len(texts)).astype(np.int64)
    first = np.cumsum(n + 1) - (n + 1)
    offsets = np.zeros(len(found) + len(texts), np.int64)
    place = np.arange(len(found)) + doc + 1
    offsets[place] = found - (ends - sizes)[doc]
    return offsets, first, n


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """Four numbers below 2 ** 32 that follow from the seed and the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))


def _arranged(text: str, form: str, low: int, high: int) -> str:
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if form == "psm":
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, seed: int = 42, percent: int = 50, suffix_first: int = 80) -> DataFrame:
    """Each text, rearranged so that its middle comes last, or as it is.

    ``docs`` has doc_id and text; other columns are ignored.  Of the texts,
    ``percent`` in a hundred are rearranged, ``suffix_first`` in a hundred of those
    with the suffix before the prefix (spm), the others prefix first (psm).  The draw and the
    cuts follow from the seed and doc_id, so a repeated row gives the same row
    again, and a null doc_id draws as an empty one.  Null and empty texts, and
    texts that hold a sentinel, stay plain; a plain row has no lengths.  Texts of any length are
    taken whole.  No rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            texts = [t or "" for t in batch["text"].to_pylist()]
            offsets, first, n = boundaries(texts)
            index = RankIndex(offsets, first)
            h = np.array([draws(seed, i) for i in ids], np.int64).reshape(-1, 4)
            ranks = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
            cuts = index.offset(first[:, None] + ranks)
            rows = {name.split()[0]: [] for name in FORMS.split(", ")}
            for i, text, count, (_, _, h3, h4), (low, high) in zip(ids, texts, n.tolist(), h.tolist(), cuts.tolist()):
                plain = not text or h3 % 100 >= percent or any(s in text for s in SENTINELS)
                form = "plain" if plain else "spm" if h4 % 100 < suffix_first else "psm"
                output = text if plain else _arranged(text, form, low, high)
                sizes = (None, None) if plain else (low, high - low)
                for column, value in zip(rows.values(), (i, count, form, *sizes, output)):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_pydict(rows, pa.schema(list(zip(rows, kinds))))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, FORMS)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of; no sentinel can arise across its parts' borders."""

    def between(start: str, end: str | None = None) -> Column:
        rest = F.substring_index(output, start, -1)
        return rest if end is None else F.substring_index(rest, end, 1)

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
