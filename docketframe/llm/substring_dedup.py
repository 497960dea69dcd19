"""Remove passages that occur more than once, by fixed-block anchors.

Any run of ``min_words`` words holds a whole block of half its length when
blocks are laid end to end from the start of its text.  So the blocks are the
index, every rolling window of a block's length is a probe, and a block that
another place's probe meets is an anchor.  Around anchors alone, all windows of
``min_words`` are compared by 104-bit hashes, which extends the hits to
maximal exact repeats: their words are the union of the repeated windows.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docketframe.llm import arrays, shared_keys
from docketframe.session import staged

RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def _anchor_keys(words: arrays.Words, block: int, groups: int):
    """(first word of each window, which windows are index blocks, their distinct keys)."""
    at = np.flatnonzero(words.whole(block))
    aligned = (at - words.first[words.doc[at]]) % block == 0
    return at, aligned, shared_keys.Keys([words.windows(block)[at]], groups)


def _candidates(words: arrays.Words, min_words: int, anchors: np.ndarray, block: int, groups: int):
    """(first word of each window of min_words that holds an anchor as its first whole block, their keys)."""
    near = arrays.cover(np.maximum(anchors - block + 1, 0), block, len(words)) if len(anchors) else np.zeros(len(words), bool)
    at = np.flatnonzero(words.whole(min_words) & near[: max(0, len(words) - min_words + 1)])
    return at, shared_keys.Keys([words.windows(min_words)[at], words.windows(min_words, 1)[at]], groups)


def remove_repeats(docs: DataFrame, min_words: int = 35, keep_text: bool = True) -> DataFrame:
    """Per document, how many words there are, how many repeat elsewhere, and the rest.

    ``docs`` has doc_id and text; other columns are ignored.  Rows are taken as
    they come: a row repeated, null doc_id included, counts as a document of
    its own, so both rows repeat each other.  Null and empty texts have no
    words.  No rows give no rows.  ``kept_text`` joins kept words by a space.

    The input is read three times and must give the same rows in the same
    tasks, as files do; if not, the job fails rather than err.
    """
    block = (min_words + 1) // 2
    groups = shared_keys.groups_for(docs)

    def probe(b):
        at, aligned, keys = _anchor_keys(b.words(), block, groups)
        indexed = np.bincount(keys.group, aligned, len(keys)) > 0
        return keys.blocks(b.uid, indexed)

    def anchors_of(words, replies):
        at, aligned, keys = _anchor_keys(words, block, groups)
        return at[aligned & (keys.totals(replies)[keys.group] >= 2)]

    def extend(b, replies):
        words = b.words()
        _, keys = _candidates(words, min_words, anchors_of(words, replies), block, groups)
        return pa.Table.from_batches([keys.blocks(b.uid)])

    def finish(b, replies):
        words, block_of = b.words(), replies["second"].to_numpy(zero_copy_only=False).astype(bool)
        first, second = replies.filter(pa.array(~block_of)), replies.filter(pa.array(block_of))
        at, keys = _candidates(words, min_words, anchors_of(words, first), block, groups)
        gone = arrays.cover(at[keys.totals(second)[keys.group] >= 2], min_words, len(words)) if len(at) else np.zeros(len(words), bool)
        removed = np.add.reduceat(np.append(gone, False), words.first[:-1], dtype=np.int64) * (words.counts > 0) if len(words.counts) else words.counts
        digests, texts = [], []
        for i, (start, size) in enumerate(zip(words.bounds, b.sizes)):
            kept = b.bytes[start : start + size].split()
            if removed[i]:
                kept = compress(kept, ~gone[words.first[i] : words.first[i + 1]])
            text = b" ".join(kept)
            digests.append(hashlib.sha256(text).hexdigest())
            texts.append(text.decode() if keep_text else None)
        return pa.table(
            {
                "doc_id": pa.array(b.ids, pa.int64()),
                "n_words": pa.array(words.counts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()),
                "kept_text": pa.array(texts, pa.string()),
            }
        )

    found = staged(shared_keys.repeated(shared_keys.mapped(docs, probe, shared_keys.BLOCK)))
    repeats = shared_keys.repeated(shared_keys.answered(docs, found, extend, shared_keys.BLOCK))
    both = found.selectExpr("*", "false AS second").unionByName(repeats.selectExpr("*", "true AS second"))
    return shared_keys.answered(docs, both, finish, RESULT)
