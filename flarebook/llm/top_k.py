"""Exact top-k search as a Voronoi join.

Pivots cut the space into cells. Summaries of the cells give each group of
queries a bound on the k-th best score it is sure to reach, and each candidate
a bound on the best score it can reach there. A candidate goes only to the
groups it may matter to; each of those is solved locally and the lists are
merged. Scores are inner products of whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flarebook.llm.vectors import matrix, widest

PIVOTS = 16
QUERIES_PER_GROUP = 4096
CANDIDATES_PER_TASK = 32_768
LONG = 2**63


def whole(vectors: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(scale * vectors)


class Cells:
    """Pivots, and how rows lie around them."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots

    def place(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest pivot of each row and the distance to it, not below the true one."""
        gaps = np.array([np.sqrt(((rows - p) ** 2).sum(axis=1)) for p in self.pivots]).reshape(len(self.pivots), -1)
        nearest = gaps.argmin(axis=0)
        return nearest, gaps[nearest, np.arange(len(rows))] * (1 + 1e-9)


class Bounds:
    """What the summaries promise to each query cell.

    Per query cell and pivot the highest and lowest product, per query cell
    the greatest norm, per cell the smallest distances to its pivot. A product
    differs from that with the pivot by the norm times the distance at most,
    so ``needed`` rows are sure to reach a score.
    """

    def __init__(self, highest: np.ndarray, lowest: np.ndarray, norms: np.ndarray, gaps: list[list], needed: int):
        self.highest, self.norms = highest, norms
        self.sure = np.full(len(norms), -np.inf)
        for group in np.flatnonzero(norms >= 0):
            reached = [lowest[group, cell] - norms[group] * np.array(near) for cell, near in enumerate(gaps)]
            reached = np.sort(np.concatenate(reached))
            if len(reached) >= needed:
                self.sure[group] = reached[-needed]

    def matters(self, group: int, cell: np.ndarray, gap: np.ndarray) -> np.ndarray:
        """Which candidates may reach what the group is sure of; a little slack covers rounding."""
        reach = self.highest[group, cell] + self.norms[group] * gap
        return reach + 1e-6 + 1e-9 * np.abs(reach) >= self.sure[group]


def smallest_type(limit: float) -> np.dtype:
    """In which whole numbers up to ``limit`` travel."""
    for kind in (np.int8, np.int16, np.int32):
        if limit <= np.iinfo(kind).max:
            return np.dtype(kind)
    return np.dtype(np.float64)


def scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products. Python's whole numbers where doubles would round; beyond 64 bits they stop there."""
    queries, candidates = queries.astype(float), candidates.astype(float)
    limit = np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0) * max(1, queries.shape[1])
    if limit < 2**24:
        return (queries.astype(np.float32) @ candidates.astype(np.float32).T).astype(float)
    if limit < 2**53:
        return queries @ candidates.T
    exact = np.vectorize(int, otypes=[object])
    product = exact(queries).dot(exact(candidates).T)
    return np.clip(product, -LONG, LONG - 1)


def best(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> list[tuple]:
    """``(query_id, vec_id, score)``: the k best of each query, ties to smaller ids."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    found: list[tuple] = []
    for start in range(0, len(queries), 256):
        own = query_ids[start : start + 256]
        table = scores(queries[start : start + 256], vectors)
        lowest = -2 * LONG
        table[own[:, None] == ids[None, :]] = lowest
        if len(ids) > k and table.dtype != object:
            limit = np.partition(table, len(ids) - k, axis=1)[:, len(ids) - k, None]
            rows, places = np.nonzero(table >= np.maximum(limit, lowest + 4096))
        else:
            rows, places = np.nonzero(table > lowest)
        values = table[rows, places]
        by_rank = np.lexsort((places, -values if values.dtype != object else [-v for v in values], rows))
        rows, places, values = rows[by_rank], places[by_rank], values[by_rank]
        turn = np.arange(len(rows)) - np.searchsorted(rows, rows)
        for i in np.flatnonzero(turn < k):
            found.append((int(own[rows[i]]), int(ids[places[i]]), int(values[i])))
    return found


def summarize(rows: DataFrame, queries: DataFrame, cells: Cells, width: int, scale: float, k: int) -> Bounds:
    """Bounds from ``PIVOTS``-squared numbers and the ``k`` smallest distances in each cell."""
    count = len(cells.pivots)

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.full((count, count), -np.inf), np.full((count, count), np.inf)
        norm = np.full(count, -1.0)
        for batch in batches:
            given = whole(matrix(batch.column("vector"), width), scale)
            nearest, _ = cells.place(given)
            products = given @ cells.pivots.T
            np.maximum.at(high, nearest, products)
            np.minimum.at(low, nearest, products)
            np.maximum.at(norm, nearest, np.sqrt((given**2).sum(axis=1)) * (1 + 1e-9))
        used = np.repeat(norm >= 0, count)
        groups, others = np.divmod(np.arange(count * count)[used], count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(groups), pa.array(others), pa.array(high[groups, others]), pa.array(low[groups, others]),
             pa.array(norm[groups])],
            names=["group", "cell", "high", "low", "norm"],
        )

    def gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = [np.zeros(0)] * count
        for batch in batches:
            nearest, gap = cells.place(whole(matrix(batch.column("vector"), width), scale))
            for cell in np.unique(nearest):
                kept[cell] = np.sort(np.concatenate((kept[cell], gap[nearest == cell])))[: k + 1]
        numbers = np.repeat(np.arange(count), [len(v) for v in kept])
        yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(np.concatenate(kept))], names=["cell", "gap"])

    highest, lowest = np.full((count, count), -np.inf), np.full((count, count), np.inf)
    norms = np.full(count, -1.0)
    around = queries.select("vector").mapInArrow(extremes, "group long, cell long, high double, low double, norm double")
    for group, cell, high, low, norm in (
        around.groupBy("group", "cell").agg(F.max("high"), F.min("low"), F.max("norm")).collect()
    ):
        highest[group, cell], lowest[group, cell], norms[group] = high, low, norm
    nearest: list[list[float]] = [[] for _ in range(count)]
    turn = F.row_number().over(Window.partitionBy("cell").orderBy("gap"))
    close = rows.select("vector").mapInArrow(gaps, "cell long, gap double").withColumn("turn", turn)
    for cell, gap, _ in close.filter(F.col("turn") <= k + 1).collect():
        nearest[cell].append(gap)
    return Bounds(highest, lowest, norms, nearest, k + 1)  # a query's own row may be among them


def top_k(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 20,
    scale: float = 64.0,
    pivots: int = PIVOTS,
    queries_per_group: int = QUERIES_PER_GROUP,
    candidates_per_task: int = CANDIDATES_PER_TASK,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` highest inner products of each query.

    Both take ``vec_id`` and ``vector`` as made by ``vectors``. A component x
    counts as floor(scale * x); a shorter vector ends in zeros. Rows with the
    query's id are its own and left out; equal rows with other ids each count.
    Repeated queries are answered once. Scores beyond 64 bits stop at the limit.

    The pivots are the ``pivots`` vectors with the smallest hash of their id.
    The number of tasks grows with queries times candidates; none holds more
    than about ``queries_per_group`` and ``candidates_per_task`` vectors.
    """
    width = max(widest(rows), widest(queries))
    largest = F.max(F.array_max(F.transform("vector", F.abs)))
    total, most = rows.agg(F.count(F.lit(1)), largest).first()
    asked, most_asked = queries.agg(F.count(F.lit(1)), largest).first()
    most = max(most or 0.0, most_asked or 0.0)
    schema = "query_id long, vec_id long, score long"
    if not total or not asked:
        empty = rows.sparkSession.createDataFrame([], schema)
        return empty.select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()
    cells = Cells(whole(np.array([row.vector + [0.0] * (width - len(row.vector)) for row in chosen]), scale))
    bounds = summarize(rows, queries, cells, width, scale, k)
    parts, subgroups = -(-total // candidates_per_task), -(-asked // queries_per_group)
    kind = smallest_type(float(np.floor(most * scale)) + 1)

    def block(group: int, sub: int, part: int, ids: np.ndarray, vectors: np.ndarray) -> tuple:
        return group, sub, part, ids.astype("<i8").tobytes(), vectors.astype(kind).tobytes()

    def batch_of(held: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        names = ["group", "sub", "part", "ids", "vectors"]
        columns = zip(*held) if held else [[] for _ in kinds]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=names)

    def spread(ids: np.ndarray, over: int) -> np.ndarray:
        mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(32)) % np.uint64(over)).astype(np.int64)

    def query_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = whole(matrix(batch.column("vector"), width), scale)
            ids = batch.column("vec_id").to_numpy()
            nearest, _ = cells.place(given)
            of_group = spread(ids, subgroups)
            held = []
            for group, sub in np.unique(np.stack((nearest, of_group), axis=1), axis=0).tolist():
                mine = (nearest == group) & (of_group == sub)
                held += [block(group, sub, part, ids[mine], given[mine]) for part in range(parts)]
            yield batch_of(held)

    def candidate_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = whole(matrix(batch.column("vector"), width), scale)
            ids = batch.column("vec_id").to_numpy()
            nearest, gap = cells.place(given)
            of_part = spread(ids, parts)
            for group in np.flatnonzero(bounds.norms >= 0).tolist():
                matters = bounds.matters(group, nearest, gap)
                held = []
                for part in np.unique(of_part[matters]).tolist():
                    mine = matters & (of_part == part)
                    held += [block(group, sub, part, ids[mine], given[mine]) for sub in range(subgroups)]
                yield batch_of(held)

    def unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids = np.frombuffer(b"".join(table.column("ids").to_pylist()), "<i8")
        packed = np.frombuffer(b"".join(table.column("vectors").to_pylist()), kind)
        return ids, packed.reshape(len(ids), width)

    def solve(asked_here: pa.Table, near: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        found: list[tuple] = []
        if asked_here.num_rows and near.num_rows:
            query_ids, wanted = unpack(asked_here)
            query_ids, first = np.unique(query_ids, return_index=True)
            ids, given = unpack(near)
            found = best(wanted[first], query_ids, given, ids, k)
        columns = zip(*found) if found else [[], [], []]
        return pa.table([pa.array(list(c), pa.int64()) for c in columns], names=names)

    layout = "group long, sub long, part long, ids binary, vectors binary"
    keys = ["group", "sub", "part"]
    local = (
        queries.select("vec_id", "vector")
        .mapInArrow(query_blocks, layout)
        .groupBy(*keys)
        .cogroup(rows.select("vec_id", "vector").mapInArrow(candidate_blocks, layout).groupBy(*keys))
        .applyInArrow(solve, schema)
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return local.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
