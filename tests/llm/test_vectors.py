from __future__ import annotations

import math

import numpy as np
import pytest
from flarebook.llm import top_k, vamana
from flarebook.llm.tables import scratch
from flarebook.llm.vectors import vectors
from pyspark.sql import functions as F

ODD = [
    (0, [1.0, 2.0]),
    (1, [1.0, 2.0]),
    (2, [1.0, 2.0]),
    (3, [1.0]),
    (4, []),
    (5, None),
    (6, [1.0, None]),
    (7, [math.nan, 1.0]),
    (8, [math.inf, 1.0]),
    (9, [0.0, 0.0]),
    (None, [1.0, 1.0]),
    (100, [-3.0, 0.5]),
    (100, [-3.0, 0.5]),
]


def table(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return frame.withColumn("vector", F.lit("clash")).withColumn("shard", F.lit(1)).repartition(3)


def lists(rows):
    out = {}
    for row in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(row.query_id, []).append((row.vec_id, row.score))
    return out


def test_top_k_of_odd_rows(spark):
    rows = vectors(table(spark, ODD))
    got = lists(top_k.top_k(rows, rows.filter("vec_id % 20 = 0"), k=4).collect())
    assert got[0] == [(1, 64 * 64 * 5), (2, 64 * 64 * 5), (3, 64 * 64), (4, 0)]
    assert got[100][:2] == [(4, 0), (9, 0)] and len(got[100]) == 4


def test_top_k_against_brute_force_in_many_groups(spark):
    random = np.random.default_rng(2)
    data = np.round(random.standard_normal((400, 6)), 1)
    rows = vectors(table(spark, [(i, row) for i, row in enumerate(data.tolist())]))
    found = top_k.top_k(rows, rows.filter("vec_id % 20 = 0"), pivots=5, queries_per_group=4, candidates_per_task=90)
    whole = np.floor(64 * data).astype(int)
    for query, near in lists(found.collect()).items():
        scores = (whole @ whole[query]).tolist()
        wanted = sorted((i for i in range(400) if i != query), key=lambda i: (-scores[i], i))[:20]
        assert near == [(i, scores[i]) for i in wanted]


def test_bounds_leave_out_far_cells_only():
    random = np.random.default_rng(0)
    centres = np.array([[300.0, 0], [-300, 0], [0, 300]])
    rows = np.floor(np.concatenate([c + random.standard_normal((50, 2)) for c in centres]))
    cells = top_k.Cells(centres)
    cell, gap = cells.place(rows)
    queries = rows[cell == 0][:10]
    products = queries @ centres.T
    gaps = [np.sort(gap[cell == c])[:6].tolist() for c in range(3)]
    highest, lowest = np.full((3, 3), -np.inf), np.full((3, 3), np.inf)
    highest[0], lowest[0] = products.max(axis=0), products.min(axis=0)
    norms = np.array([np.linalg.norm(queries, axis=1).max(), -1, -1])
    bounds = top_k.Bounds(highest, lowest, norms, gaps, 6)
    kept = bounds.matters(0, cell, gap)
    assert not kept[cell != 0].any()
    scores = queries @ rows.T
    assert all(kept[np.argsort(-s, kind="stable")[:6]].all() for s in scores)


def test_large_numbers_are_exact():
    queries, rows = np.array([[2.0**40, 1.0]]), np.array([[2.0**20, 1.0], [2.0**20, 3.0], [2.0**30, 0.0]])
    got = top_k.best(queries, np.array([9]), rows, np.array([1, 2, 3]), 3)
    assert got == [(9, 3, 2**63 - 1), (9, 2, 2**60 + 3), (9, 1, 2**60 + 1)]


def test_no_vectors(spark):
    rows = vectors(table(spark, [(5, None)]))
    assert top_k.top_k(rows, rows).collect() == []
    index = vamana.build_index(rows, scratch(spark, "test-graphs"))
    assert vamana.search_index(index, rows).collect() == []


def test_neighbours_of_odd_rows(spark):
    rows = vectors(table(spark, ODD), zero=False)
    index = vamana.build_index(rows, scratch(spark, "test-graphs"), shard_rows=3)
    got = lists(vamana.search_index(index, rows.filter("vec_id % 100 = 0")).collect())
    assert [i for i, _ in got[0]] == [1, 2, 3, 100, 100]
    assert got[0][2][1] == 2.0 and [i for i, _ in got[100]] == [3, 0, 1, 2]


def test_many_equal_vectors(spark):
    data = [(i, [1.0, 0.0, 0.0]) for i in range(300)] + [(1000 + i, [0.0, float(i), 1.0]) for i in range(300)]
    rows = vectors(table(spark, data), zero=False)
    index = vamana.build_index(rows, scratch(spark, "test-graphs"), shard_rows=150)
    got = lists(vamana.search_index(index, rows.filter("vec_id % 100 = 0")).collect())
    assert [i for i, _ in got[0]] == list(range(1, 11)) and [i for i, _ in got[200]] == list(range(10))


def test_recall_and_diverse_edges():
    random = np.random.default_rng(4)
    data = random.standard_normal((2000, 24))
    graph = vamana.Graph(data).build()
    found, _ = graph.search(data[:100].astype(np.float32), vamana.SEARCH_BEAM)
    gaps = ((data[:100, None] - data[None]) ** 2).sum(axis=2)
    wanted = np.argsort(gaps, axis=1)[:, :10]
    recall = np.mean([len(set(f) & set(w)) / 10 for f, w in zip(found[:, :10].tolist(), wanted.tolist())])
    assert recall >= 0.9
    assert ((graph.edges != vamana.NONE).sum(axis=1) <= vamana.DEGREE + vamana.SLACK).all()
    line = vamana.Graph(np.array([[0.0], [1.0], [1.1], [-1.0]]))
    kept = line.prune(np.array([0]), np.array([[1, 2, 3, vamana.NONE]]))
    assert sorted(kept[0][kept[0] != vamana.NONE]) == [1, 3]  # 2 lies behind 1


@pytest.mark.parametrize("beam", [16, 96])
def test_search_ends_on_a_graph_without_edges(beam):
    graph = vamana.Graph(np.eye(3))
    ids, _ = graph.search(np.eye(3, dtype=np.float32), beam)
    assert (ids[:, 0] == graph.entry).all()


def test_queries_larger_and_longer_than_all_rows(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.5]), (2, [-1.0, 0.25])], "vec_id long, vector array<double>")
    asked = spark.createDataFrame([(7, [10.0, 0.0, 3.0]), (8, [-0.5])], "vec_id long, vector array<double>")
    found = top_k.top_k(rows, asked, 20, 64)
    got = {(r.query_id, r.vec_id): r.score for r in found.collect()}
    assert got == {(7, 1): 640 * 64, (7, 2): -640 * 64, (8, 1): -32 * 64, (8, 2): 32 * 64}
