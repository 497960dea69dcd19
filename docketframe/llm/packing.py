"""Packing of tokenized documents into sequences, best fit, largest first.

Pieces are put in order of length by a range sort, which gives each its rank.
Best fit then goes on in supersteps, one per length, longest first: the gaps
are in order of size, a sweep finds the successor of the length among them, all
pieces of that length go there at once (rank i takes the i-th place, so two
never claim the same), the gaps shrink, and what finds no gap opens sequences.

Pieces and gaps of one size are alike and there are at most ``capacity`` sizes,
so the sweeps work on counts: what they read and write is bounded by the
capacity, not by the corpus.  Every row finds its place by its rank.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketframe.llm import arrays
from docketframe.operators.corpus import number_rows
from docketframe.session import staged

CAPACITY = 2048
END = 0
#: Word pieces whose ids a Python worker keeps.
CACHED_PIECES = 1_200_000
#: Texts whose pieces are looked up together, of those that come in one batch of rows.
TEXTS = 1000

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"

#: Pieces that are encoded as one text.
CHAIN = 1000

_SPACE_THEN_SPACE = re.compile(r"\s ")
_BEFORE_WORD = re.compile(r"(?<=\S)(?= )")


class WordTokenizer:
    """Token ids of texts, by the ids of their blank-separated pieces.

    Byte-level BPE never joins a character and a blank after it, so a text's
    ids are those of its pieces, each with its leading blank.  Equal pieces are encoded once,
    many in one text: the bytes that each token stands for show where a piece's ids end.
    The literal of an added token, like <|endoftext|>, is that token; no piece ends inside it.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        vocabulary = self.model.get_vocab(with_added_tokens=True)
        added = {t.content for t in self.model.get_added_tokens_decoder().values()}
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            # Other tokens are written with one character for each byte.
            self.sizes[i] = len(token.encode()) if token in added else len(token)

    def _learn_alone(self, pieces: list[str]) -> None:
        for piece, e in zip(pieces, self.model.encode_batch_fast(pieces, add_special_tokens=False)):
            self.known[piece] = np.array(e.ids, "<u4").tobytes()

    def _learn(self, pieces: set[str]) -> None:
        chained, alone = [], []
        for p in pieces:
            # Only between a character and a blank nothing is joined.
            (chained if p[:1] == " " and not p[-1].isspace() else alone).append(p)
        chains = [chained[i : i + CHAIN] for i in range(0, len(chained), CHAIN)]
        for chain, e in zip(chains, self.model.encode_batch_fast(["".join(c) for c in chains], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            ends, stops = np.cumsum(self.sizes[ids]), np.cumsum([len(p.encode()) for p in chain])
            last = np.searchsorted(ends, stops)
            if len(ends) and last[-1] == len(ends) - 1 and (ends[last] == stops).all():
                data, edges = ids.tobytes(), (4 * (last + 1)).tolist()
                self.known.update(zip(chain, [data[s:e] for s, e in zip([0, *edges], edges)]))
            else:
                alone += chain
        self._learn_alone(alone)

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if len(self.known) > CACHED_PIECES:
            self.known = {}
        # Only a blank after another kind of character surely begins a piece.
        odd = {i for i, text in enumerate(texts) if _SPACE_THEN_SPACE.search(text)}
        rows = [_BEFORE_WORD.split(texts[i]) for i in odd]
        out = self._ids_of_plain(pa.array(["" if i in odd else t for i, t in enumerate(texts)], pa.large_string()))
        self._learn(set().union(*rows).difference(self.known))
        known = self.known.__getitem__
        for i, row in zip(odd, rows):
            out[i] = b"".join(map(known, row))
        return out

    def _ids_of_plain(self, texts: pa.Array) -> list[bytes]:
        """Of texts in which every blank begins a piece: a piece that a batch holds many times is looked up once."""
        if not len(texts):
            return []
        parts = pc.split_pattern(texts, " ")
        edges, words = parts.offsets.to_numpy(), parts.values.dictionary_encode()
        code = words.indices.to_numpy().astype(np.int64)
        # What stands before the first blank is a piece without one; those are named by their texts.
        blank, nothing = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
        after = pc.binary_join_element_wise(blank, words.dictionary, nothing)
        heads = parts.values.take(pa.array(edges[:-1]))
        code[edges[:-1]] = len(after) + np.arange(len(heads))
        pieces = pa.concat_arrays([after, heads]).to_numpy(zero_copy_only=False).tolist()
        data = list(map(self.known.get, pieces))
        new = [i for i, known in enumerate(data) if known is None]
        self._learn({pieces[i] for i in new})
        for i in new:
            data[i] = self.known[pieces[i]]
        sizes = np.fromiter(map(len, data), np.int64, len(data)) >> 2
        ids, begin = np.frombuffer(b"".join(data), "<u4"), np.cumsum(sizes) - sizes
        own = sizes[code]
        ends = np.cumsum(own)
        placed = ids[np.repeat(begin[code] - ends + own, own) + np.arange(ends[-1])].tobytes()
        bounds = (4 * np.append(0, ends)[edges]).tolist()
        return [placed[s:e] for s, e in zip(bounds, bounds[1:])]


_TOKENIZERS: dict[str, WordTokenizer] = {}
# Tasks of this operator share them; those of others have no use for them.
arrays.KEPT.append(_TOKENIZERS.clear)


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Each document's ids and an end mark, cut from the end into pieces of at most ``capacity``."""

    def run(source):
        for rows in source:
            ids, texts = rows["doc_id"].to_pylist(), rows["text"].to_pylist()
            for at in range(0, len(texts), TEXTS):
                out = {c.split()[0]: [] for c in PIECE.split(", ")}
                for doc_id, data in zip(ids[at : at + TEXTS], _tokenizer(tokenizer).ids([t or "" for t in texts[at : at + TEXTS]])):
                    data += END.to_bytes(4, "little")
                    n = len(data) // 4
                    edges = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                    for piece, (s, e) in enumerate(zip(edges, edges[1:])):
                        own = data[4 * s : 4 * e]
                        for column, value in zip(out.values(), (doc_id, piece, s, e - s, zlib.crc32(own), own if keep_ids else None)):
                            column.append(value)
                yield pa.RecordBatch.from_pydict(out, pa.schema(
                    [(c.split()[0], {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[c.split()[1]]) for c in PIECE.split(", ")]
                ))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECE)


def best_fit(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Where the pieces of each length go, by rank in order of length, longest first.

    Rows (first rank, pieces per sequence, first sequence, offset, length):
    rank r is in sequence first + (r - first rank) // per, at offset + its
    place there * length.
    """
    # Gap size -> groups of like sequences: (first sequence, how many).
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    plan, rank, opened = [], 0, 0

    def put(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                insort(sizes, gap)
                gaps[gap] = []
            gaps[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            i = bisect_left(sizes, length)
            if i < len(sizes):
                gap = sizes[i]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[i]
            else:
                gap, first, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            per = gap // length
            used = min(n, -(-left // per))
            placed = min(left, used * per)
            plan.append((rank, per, first, capacity - gap, length))
            full, rest = divmod(placed, per)
            put(gap - per * length, first, full)
            if rest:
                put(gap - rest * length, first + full, 1)
            put(gap, first + used, n - used)
            rank, left = rank + placed, left - placed
    return np.array(plan, np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """A row per piece, with its sequence and its offset there.

    ``docs`` has doc_id and text; other columns are ignored.  ``tokenizer`` is
    the path of a byte-level BPE file that all executors have.  A null text is
    empty; an empty text is its end mark alone.  Texts beyond ``capacity`` are
    cut; their first piece may be shorter.  Rows repeated, null doc_id included,
    are packed each.  No rows give no rows.
    """
    pieces = staged(token_pieces(docs, tokenizer, capacity, keep_ids))
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most capacity rows
    plan = best_fit(counts, capacity)
    ranked = number_rows(pieces.withColumn("shorter", -F.col("length")), ["shorter", "doc_id", "piece"], seq="rank").drop("shorter")
    names = [c.split()[0] for c in PIECE.split(", ")]

    def place(source):
        arrays.give_back()  # all texts are encoded by now; the worker may be kept for other work
        for rows in source:
            rank = rows["rank"].to_numpy() - 1
            first_rank, per, first, offset, length = plan[np.searchsorted(plan[:, 0], rank, "right") - 1].T
            at = rank - first_rank
            yield pa.RecordBatch.from_arrays(
                [*[rows[c] for c in names], pa.array(first + at // per), pa.array(offset + at % per * length)],
                [*names, "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, f"{PIECE}, sequence_id long, offset long")
