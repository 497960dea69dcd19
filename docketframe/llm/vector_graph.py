"""Approximate nearest neighbours by graphs whose edges are pruned for diversity.

Vectors are dealt out to shards by a hash; each shard is one graph.  A graph
grows in batches: a greedy beam search in the graph so far proposes neighbours
of each new vector, and relaxed distance pruning keeps an edge only if no kept neighbour
is closer to its end than the vector itself is, by a factor ``ALPHA``.  Edges back are
added and pruned alike.  Every query is searched with a beam in each shard;
the candidates found are scored exactly.

The largest inner product is the nearest vector once a further coordinate
makes all vectors of a shard equally long, so the graph works with distances.

Equal vectors are one class, with its smallest ids: a vector that very many
rows share is one node, and its rows still come out by id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketframe.session import staged

DEGREE = 32
BEAM = 64
ALPHA = 1.2
#: Vectors that every search starts from; the graph's first ones.
STARTS = 32
#: Nodes that one step of a search expands per query.
EXPANDED = 4
#: A shard holds at least this many vectors, up to ``MOST_SHARDS`` shards; beyond, shards grow up to ``SHARD_BYTES`` of vectors.
SHARD_ROWS = 8192
MOST_SHARDS = 64
SHARD_BYTES = 128 << 20
_MARKS = 64 << 20  # bytes of marks on visited nodes, which bound the queries searched at once

FOUND = "class_id long, score double, ids array<long>"


class PrunedGraph:
    """A directed graph over the rows of ``x``, searched by largest inner product."""

    def __init__(self, x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, batch: int = 512):
        self.x, self.degree, self.beam, self.alpha = x, degree, beam, alpha
        scaled = x.astype(np.float64) / (np.abs(x).max() or 1)
        squares = np.einsum("ij,ij->i", scaled, scaled)
        longest = squares.max()
        rest = np.sqrt(np.maximum(longest - squares, 0))
        self.points = (np.column_stack([scaled, rest]) / np.sqrt(longest)).astype(np.float32)
        n = len(x)
        self.edges = np.full((n, degree), -1, np.int32)
        order = np.random.default_rng(n).permutation(n)
        self.starts = order[:STARTS]
        self._join(self.starts, np.broadcast_to(self.starts, (len(self.starts), len(self.starts))))
        done = len(self.starts)
        while done < n:
            fresh = order[done : done + min(done, batch)]
            self._join(fresh, self._beams(self.points[fresh]))
            done += len(fresh)

    # -- building ------------------------------------------------------------

    def _pruned(self, nodes: np.ndarray, proposed: np.ndarray) -> np.ndarray:
        """For each node, those of the proposed neighbours (-1: none) to keep, nearest first."""
        out = np.full((len(nodes), self.degree), -1, np.int32)
        m = proposed.shape[1]
        step = max(1, (4 << 20) // (m * m))
        for at in range(0, len(nodes), step):
            node, near = nodes[at : at + step], proposed[at : at + step]
            there = (near >= 0) & (near != node[:, None])
            points = self.points[near]
            away = 2 - 2 * np.einsum("ijk,ik->ij", points, self.points[node])
            away[~there] = np.inf
            order = np.argsort(away, axis=1)
            near, away = (np.take_along_axis(a, order, 1) for a in (near, away))
            points = self.points[near]
            between = (2 - 2 * (points @ points.transpose(0, 2, 1))) * np.float32(self.alpha**2)
            left, kept = np.isfinite(away), np.zeros(len(node), np.int64)
            for j in range(m):
                rows = np.flatnonzero(left[:, j] & (kept < self.degree))
                if len(rows):
                    out[at + rows, kept[rows]] = near[rows, j]
                    kept[rows] += 1
                    left[rows] &= between[rows, j] > away[rows]
        return out

    def _join(self, nodes: np.ndarray, proposed: np.ndarray) -> None:
        """Give new nodes their edges, and the nodes these lead to edges back."""
        self.edges[nodes] = chosen = self._pruned(nodes, proposed)
        row, col = np.nonzero(chosen >= 0)
        to, source = chosen[row, col], nodes[row]
        order = np.argsort(to, kind="stable")
        to, source = to[order], source[order]
        target, first, count = np.unique(to, return_index=True, return_counts=True)
        place = np.arange(len(to)) - np.repeat(first, count)
        # Those that get about as many edges go together, so that few are padded much.
        size = 1 << np.ceil(np.log2(np.maximum(count, 4))).astype(np.int64)
        for s in np.unique(size):
            group = np.flatnonzero(size == s)
            more = np.full((len(group), s), -1, np.int64)
            at = np.flatnonzero(np.repeat(size == s, count))
            more[np.repeat(np.arange(len(group)), count[group]), place[at]] = source[at]
            own = self.edges[target[group]]
            both = np.concatenate([own, more], axis=1)
            full = (both >= 0).sum(1) > self.degree
            self.edges[target[group[full]]] = self._pruned(target[group[full]], both[full])
            order = np.argsort(both[~full] < 0, axis=1, kind="stable")[:, : self.degree]
            self.edges[target[group[~full]]] = np.take_along_axis(both[~full], order, 1)

    # -- searching -----------------------------------------------------------

    def _beams(self, queries: np.ndarray) -> np.ndarray:
        """The best nodes (-1: none) that a beam search finds for each query, best first."""
        size = max(1, min(256, _MARKS // len(self.points)))
        parts = [self._beam(queries[at : at + size]) for at in range(0, len(queries), size)]
        return np.concatenate(parts) if parts else np.zeros((0, self.beam), np.int64)

    def _beam(self, queries: np.ndarray) -> np.ndarray:
        n, b, width = len(self.points), len(queries), max(self.beam, len(self.starts))
        marks = np.zeros(b * n, np.uint8)
        marks.reshape(b, n)[:, self.starts] = 255
        ids = np.full((b, width), -1, np.int64)
        far = np.full((b, width), np.inf, np.float32)
        ids[:, : len(self.starts)] = self.starts
        far[:, : len(self.starts)] = -(queries @ self.points[self.starts].T)
        order = np.argsort(far, axis=1)
        ids, far = np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)
        closed = ids < 0
        mark = np.arange(1, EXPANDED * self.degree + 1, dtype=np.uint8)
        rows = np.arange(b)
        while len(rows):
            pick = np.argsort(closed[rows], axis=1, kind="stable")[:, :EXPANDED]
            opened = ~np.take_along_axis(closed[rows], pick, 1)
            closed[rows[:, None], pick] = True
            near = self.edges[np.take_along_axis(ids[rows], pick, 1)]
            near = np.where(opened[:, :, None], near, -1).reshape(len(rows), -1)
            r, c = np.nonzero(near >= 0)
            node = near[r, c].astype(np.int64)
            at = rows[r] * n + node
            new = marks[at] == 0
            r, c, node, at = r[new], c[new], node[new], at[new]
            marks[at] = mark[c]
            once = marks[at] == mark[c]  # of a node met twice in this step, the last
            r, c, node = r[once], c[once], node[once]
            more_far = np.full(near.shape, np.inf, np.float32)
            more_far[r, c] = -np.einsum("ij,ij->i", self.points[node], queries[rows[r]])
            all_far = np.concatenate([far[rows], more_far], axis=1)
            all_ids = np.concatenate([ids[rows], near], axis=1)
            all_closed = np.concatenate([closed[rows], ~np.isfinite(more_far)], axis=1)
            order = np.argsort(all_far, axis=1, kind="stable")[:, :width]
            far[rows] = np.take_along_axis(all_far, order, 1)
            ids[rows] = np.take_along_axis(all_ids, order, 1)
            closed[rows] = np.take_along_axis(all_closed, order, 1)
            rows = rows[~closed[rows].all(axis=1)]
        ids[~np.isfinite(far)] = -1
        return ids[:, : self.beam]

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nodes found for each query, their inner products in double precision); a node of -1 is none."""
        lengths = np.sqrt(np.einsum("ij,ij->i", q := queries / np.abs(queries).max(axis=1, keepdims=True), q))
        points = np.column_stack([q / lengths[:, None], np.zeros(len(q))]).astype(np.float32)
        found = self._beams(points)
        scores = np.empty(found.shape)
        for i, own in enumerate(found):
            scores[i] = np.einsum("ij,j->i", self.x[own].astype(np.float64), queries[i])
        scores[found < 0] = -np.inf
        return found, scores


def _matrices(rows: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Vectors by their number of components: (row numbers, matrix)."""
    vectors = rows["v"].combine_chunks()
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    bounds = np.cumsum(sizes) - sizes
    out = {}
    for d in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == d)
        out[d] = (at, flat[bounds[at][:, None] + np.arange(d)])
    return out


class _Shard:
    """The graphs of one shard, one for each length of vectors."""

    def __init__(self, rows: pa.Table, kept: int):
        self.ids, self.kept = rows["ids"].to_pylist(), kept
        self.graphs = {d: (at, PrunedGraph(x)) for d, (at, x) in _matrices(rows).items()} if len(rows) else {}

    def search(self, rows: pa.Table) -> pa.RecordBatch:
        asked, out = rows["class_id"].to_numpy(), ([], [], [])
        for d, (at, queries) in _matrices(rows).items():
            if d not in self.graphs:
                continue
            own, graph = self.graphs[d]
            found, scores = graph.nearest(queries.astype(np.float64))
            first = np.array([self.ids[i][0] for i in own])
            order = np.lexsort((first[found], -scores), axis=1)[:, : self.kept]
            for i, places in enumerate(order):
                for k in places:
                    if found[i, k] >= 0:
                        for column, value in zip(out, (asked[at[i]], scores[i, k], self.ids[own[found[i, k]]])):
                            column.append(value)
        kinds = (pa.int64(), pa.float64(), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["class_id", "score", "ids"])


def _search(kept: int):
    """Tasks get, shard by shard, the vectors to index and then the queries, which stream through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, shard = None, [], None
        for batch in batches:
            numbers = batch["shard"].to_numpy()
            edges = np.flatnonzero(np.diff(numbers)) + 1
            for s, e in zip([0, *edges], [*edges, len(numbers)]):
                if s == e:
                    continue
                if numbers[s] != number:
                    number, parts, shard = numbers[s], [], None
                part = batch.slice(s, e - s)
                asked = int(np.count_nonzero(part["asked"].to_numpy(zero_copy_only=False)))
                if asked < len(part):
                    parts.append(part.slice(0, len(part) - asked))
                if asked:
                    shard = shard or _Shard(pa.Table.from_batches(parts, batch.schema), kept)
                    parts = []
                    yield shard.search(pa.Table.from_batches([part.slice(len(part) - asked)]))

    return run


def usable(v: Column) -> Column:
    """Whether a vector has components, all of them finite and not all zero."""
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def search_all(vectors: DataFrame, is_query: Column, k: int = 20, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` vectors of largest inner product found for each query.

    ``vectors`` has vec_id and embedding (an array of numbers); other columns
    are ignored.  ``is_query``, on vec_id, says which rows are queries; all
    rows but the query's own are candidates.  Fewer candidates than ``k`` all
    come out.  Ties go to the smaller vec_id.  Vectors that are null, empty, zero or hold
    null or non-finite components take no part, nor do rows without vec_id.  Rows that
    share a vec_id count once, with the least of their vectors.  Vectors of different
    length never meet.  No rows give no rows.

    Each query is searched in every shard, so that work grows with queries
    times shards; there are few shards as long as each fits a task.
    """
    kind = vectors.schema["embedding"].dataType.elementType
    v = F.col("embedding") if isinstance(kind, T.FloatType) else F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"))
    # Of a class of equal vectors no answer needs more than its k + 1 smallest ids; the limit is taken before the shuffle too.
    in_class = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    firsts = rows.withColumn("_r", in_class).where(F.col("_r") <= k + 1)
    ids = F.array_sort(F.collect_list("vec_id"))
    classes = staged(firsts.groupBy("v").agg(ids.alias("ids")).select(F.col("ids")[0].alias("class_id"), "ids", "v"))
    asked = staged(rows.where(is_query).join(classes.select("v", "class_id"), "v").select(F.col("vec_id").alias("query_id"), "class_id"))

    n, size = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    shards = max(1, min(-(-n // shard_rows), MOST_SHARDS), -(-n * 4 * (size or 0) // SHARD_BYTES))
    index = classes.select((F.pmod(F.xxhash64("class_id"), F.lit(shards))).cast("int").alias("shard"), F.lit(False).alias("asked"), "class_id", "ids", "v")
    queries = classes.join(asked.select("class_id").distinct(), "class_id", "left_semi").select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("asked"), "class_id", F.lit(None).cast("array<long>").alias("ids"), "v"
    )
    found = (
        index.unionByName(queries)
        .repartition(2 * shards, "shard")
        .sortWithinPartitions("shard", "asked", "class_id")
        .mapInArrow(_search(k + 1), FOUND)
    )
    # The k + 1 best classes hold the k + 1 best rows, and one of these may be the query's own.
    place = F.row_number().over(Window.partitionBy("class_id").orderBy(F.desc("score"), "ids"))
    best = found.withColumn("_r", place).where(F.col("_r") <= k + 1).select("class_id", F.struct((-F.col("score")).alias("far"), "ids").alias("c"))
    flat = F.flatten(F.transform(F.collect_list("c"), lambda c: F.transform(c["ids"], lambda i: F.struct(c["far"].alias("far"), i.alias("vec_id")))))
    best = best.groupBy("class_id").agg(F.slice(F.array_sort(flat), 1, k + 1).alias("best"))
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    return (
        asked.join(best, "class_id")
        .select("query_id", F.posexplode(others).alias("at", "b"))
        .select("query_id", (F.col("at") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.far")).alias("score"))
    )
