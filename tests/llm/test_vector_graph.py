"""Approximate neighbours against exact ones, and on odd input."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketframe.llm import queries, vector_graph
from docketframe.session import ship_package

SCHEMA = "vec_id long, embedding array<float>, class_id int, ids string, v int, shard int, asked string, rank int, score int"


def table(spark, rows):
    ship_package(spark)
    return spark.createDataFrame([(i, v, 1, "x", 2, 3, "y", 4, 5) for i, v in rows], SCHEMA)


def single(v):
    return [float(np.float32(x)) for x in v]


def exact(rows, k, every):
    """Of rows (vec_id, vector): all answers, best first, ties to the smaller id."""
    least = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            least[i] = min(least.get(i, v), v)
    out = {}
    for q, v in least.items():
        if q % every == 0:
            scores = [(-float(np.dot(np.array(v), np.array(w))), i) for i, w in least.items() if i != q and len(w) == len(v)]
            out[q] = sorted(scores)[:k]
    return out


def answers(found):
    out = {}
    for r in found.collect():
        out.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    return {q: [own[i] for i in sorted(own)] for q, own in out.items()}


def recall(found, expected):
    hits = sum(len({i for i, _ in found.get(q, [])} & {i for _, i in own}) for q, own in expected.items())
    return hits / sum(map(len, expected.values()))


@pytest.mark.parametrize("unit", [True, False])
def test_finds_nearly_all_of_many_clustered_vectors(spark, unit):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 24))
    x = centres[rng.integers(0, 8, 6000)] + 0.7 * rng.normal(size=(6000, 24))
    if unit:
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, single(v)) for i, v in enumerate(x)]
    found = answers(vector_graph.search_all(table(spark, rows), F.col("vec_id") % 20 == 0, shard_rows=1500))
    expected = exact(rows, 20, 20)
    assert recall(found, expected) >= 0.95
    vectors = dict(rows)
    for q, own in found.items():
        assert len(own) == 20 and q not in [i for i, _ in own]
        assert [s for _, s in own] == sorted((s for _, s in own), reverse=True)
        assert all(abs(s - np.dot(vectors[q], vectors[i])) < 1e-12 for i, s in own)


def test_registered_query_on_a_small_table_is_exact(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(i, single(v)) for i, v in enumerate(rng.normal(size=(500, 8)))]
    table(spark, rows).select("vec_id", "embedding").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = answers(queries.op12_nearest_neighbours(spark, str(tmp_path)))
    expected = exact(rows, 20, 20)
    assert found.keys() == expected.keys() and recall(found, expected) >= 0.99


def test_copies_ties_and_odd_vectors(spark):
    rng = random.Random(6)
    common, other = [1.0, 2.0, -1.0], [0.5, 0.5, 0.5]
    rows = [(i, common) for i in range(300)] + [(i, other) for i in range(300, 310)]
    rows += [(i, single([rng.random() for _ in range(3)])) for i in range(310, 330)]
    rows += [(400, None), (401, []), (420, [0.0, 0.0, 0.0]), (440, [float("nan"), 1.0, 1.0]), (460, [float("inf"), 1.0, 1.0])]
    rows += [(None, common), (461, [None, 1.0, 1.0]), (480, [1.0, 1.0]), (481, [2.0, 1.0]), (500, [1e-30, 0.0, 0.0]), (520, [1e30, 0.0, 0.0])]
    rows += rows[:40] + [(540, [3.0, 1.0, 1.0]), (540, [-3.0, 1.0, 1.0]), (560, [7.0])]
    found = answers(vector_graph.search_all(table(spark, rows), F.col("vec_id") % 20 == 0))
    expected = exact(rows, 20, 20)
    assert not expected.pop(560)  # alone with its length
    assert found.keys() == expected.keys()
    for q, own in expected.items():
        assert [i for i, _ in found[q]] == [i for _, i in own], q
        assert [s for _, s in found[q]] == pytest.approx([-s for s, _ in own])


def test_fewer_candidates_than_asked_for(spark):
    found = answers(vector_graph.search_all(table(spark, [(0, [1.0]), (1, [3.0]), (2, [-2.0])]), F.col("vec_id") == 0, k=5))
    assert found == {0: [(1, 3.0), (2, -2.0)]}


def test_doubles_and_whole_numbers(spark):
    for kind in ("double", "int"):
        df = spark.createDataFrame([(0, [1, 2]), (1, [3, 4]), (2, [0, 0])], "vec_id int, embedding array<int>")
        df = df.withColumn("embedding", F.col("embedding").cast(f"array<{kind}>"))
        assert answers(vector_graph.search_all(df, F.col("vec_id") == 0)) == {0: [(1, 11.0)]}


def test_no_rows_give_no_rows(spark):
    assert vector_graph.search_all(table(spark, [(1, [1.0])]).limit(0), F.lit(True)).count() == 0


def test_edges_are_pruned_for_diversity():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 6)).astype(np.float32)
    graph = vector_graph.PrunedGraph(x, degree=8)
    for node in range(400):
        own = graph.edges[node][graph.edges[node] >= 0]
        assert len(own) and node not in own and len(set(own.tolist())) == len(own)
    proposed = np.argsort(-(graph.points @ graph.points[7]))[None, :60]
    kept = graph._pruned(np.array([7]), proposed)[0]
    kept = kept[kept >= 0]
    away = np.linalg.norm(graph.points - graph.points[7], axis=1)
    for i, a in enumerate(kept):
        assert all(graph.alpha * np.linalg.norm(graph.points[a] - graph.points[b]) > away[a] - 1e-4 for b in kept[:i])
