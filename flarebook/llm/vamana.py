"""Nearest neighbours by a robust-pruned directed graph over each shard.

A graph is built by inserting batches of vectors: a greedy beam search over
the graph so far proposes neighbours, and pruning keeps a near one only if no
kept one is much nearer to it, so that edges point in diverse directions. A
query runs a beam search over every shard; the shards' lists are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flarebook.llm.vectors import matrix, widest

SHARD_ROWS = 4096
DEGREE = 24
SLACK = 12  # edges a node may gain before it is pruned again
BUILD_BEAM = 48
SEARCH_BEAM = 96
RELAXED = 1.2  # how much nearer a kept neighbour must be to drop another
BATCH = 256
QUERIES_PER_TASK = 4096
NONE = -1


class Graph:
    """Out-edges of each vector (``NONE`` where there are fewer) and where searches start."""

    def __init__(self, vectors: np.ndarray, edges: np.ndarray | None = None, entry: int | None = None):
        self.vectors = np.ascontiguousarray(vectors, np.float32)
        self.squares = (self.vectors**2).sum(axis=1)
        self.edges = np.full((len(vectors), DEGREE + SLACK), NONE, np.int32) if edges is None else edges
        middle = ((self.vectors - self.vectors.mean(axis=0)) ** 2).sum(axis=1)
        self.entry = int(middle.argmin()) if entry is None else entry

    def gaps(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared distances, less the query's own square, to rows of ids."""
        products = np.einsum("qd,qnd->qn", queries, self.vectors[ids], optimize=True)
        return self.squares[ids] - 2 * products

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each query, the nearest found and all that were expanded on the way."""
        count, line = len(queries), np.arange(len(queries))
        ids = np.full((count, beam), NONE, np.int32)
        gaps = np.full((count, beam), np.inf, np.float32)
        open_ = np.zeros((count, beam), bool)
        seen = np.zeros((count, len(self.vectors)), bool)
        ids[:, 0], open_[:, 0], seen[:, self.entry] = self.entry, True, True
        gaps[:, 0] = self.gaps(queries, ids[:, :1])[:, 0]
        expanded = []
        while open_.any():
            active = line[open_.any(axis=1)]
            at = open_[active].argmax(axis=1)  # beams are in order, so this is the nearest
            nodes = ids[active, at]
            open_[active, at] = False
            step = np.full(count, NONE, np.int32)
            step[active] = nodes
            expanded.append(step)
            near = self.edges[nodes]
            fresh = (near != NONE) & ~seen[active[:, None], near]
            seen[active[:, None], np.where(fresh, near, nodes[:, None])] = True
            found = np.where(fresh, self.gaps(queries[active], near), np.inf)
            all_gaps = np.concatenate((gaps[active], found), axis=1)
            order = np.argsort(all_gaps, axis=1, kind="stable")[:, :beam]
            rows = np.arange(len(active))[:, None]
            gaps[active] = all_gaps[rows, order]
            ids[active] = np.concatenate((ids[active], np.where(fresh, near, NONE)), axis=1)[rows, order]
            open_[active] = np.concatenate((open_[active], fresh), axis=1)[rows, order]
        return ids, np.stack(expanded, axis=1)

    def prune(self, nodes: np.ndarray, proposed: np.ndarray) -> np.ndarray:
        """Up to ``DEGREE`` diverse neighbours of each node among those proposed."""
        rows = np.arange(len(nodes))
        near = self.vectors[proposed]
        gaps = np.maximum(self.gaps(self.vectors[nodes], proposed) + self.squares[nodes, None], 0)
        alive = (proposed != NONE) & (proposed != nodes[:, None])
        squares = self.squares[proposed]
        between = squares[:, :, None] + squares[:, None, :] - 2 * (near @ near.transpose(0, 2, 1))
        kept = np.full((len(nodes), DEGREE), NONE, np.int32)
        for place in range(DEGREE):
            at = np.where(alive, gaps, np.inf).argmin(axis=1)
            some = alive[rows, at]
            if not some.any():
                break
            kept[some, place] = proposed[rows, at][some]
            alive &= RELAXED**2 * np.maximum(between[rows, at], 0) > gaps
            alive[rows, at] = False
        return kept

    def insert(self, nodes: np.ndarray) -> None:
        ids, expanded = self.search(self.vectors[nodes], BUILD_BEAM)
        kept = self.prune(nodes, np.concatenate((ids, expanded), axis=1))
        self.edges[nodes, :DEGREE] = kept
        self.edges[nodes, DEGREE:] = NONE
        sources, places = np.nonzero(kept != NONE)
        self.link(kept[sources, places], nodes[sources])

    def link(self, targets: np.ndarray, sources: np.ndarray) -> None:
        """Edges back; a node that has too many is pruned."""
        while len(targets):
            order = np.argsort(targets, kind="stable")
            targets, sources = targets[order], sources[order]
            turn = np.arange(len(targets)) - np.searchsorted(targets, targets)
            free = (self.edges != NONE).sum(axis=1)[targets] + turn
            fits = free < self.edges.shape[1]
            self.edges[targets[fits], free[fits]] = sources[fits]
            targets, sources = targets[~fits], sources[~fits]
            full = np.unique(targets)
            for part in np.array_split(full, -(-len(full) // 1024)) if len(full) else []:
                self.edges[part, :DEGREE] = self.prune(part, self.edges[part])
                self.edges[part, DEGREE:] = NONE

    def build(self) -> Graph:
        order = np.random.default_rng(1).permutation(len(self.vectors))
        order = np.concatenate(([self.entry], order[order != self.entry]))
        start, size = 1, 1
        while start < len(order):
            self.insert(order[start : start + size])
            start += size
            size = min(2 * size, BATCH)
        return self


def distinct(ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Different vectors, and the ids of each in order: equal ones would only point at each other."""
    different, which = np.unique(vectors, axis=0, return_inverse=True)
    order = np.lexsort((ids, which.ravel()))
    cuts = np.flatnonzero(np.diff(which.ravel()[order])) + 1
    return different, np.split(ids[order], cuts)


@dataclass(frozen=True)
class Index:
    """A written index: a row per shard in ``folder``."""

    folder: str
    width: int
    shards: int


def build_index(rows: DataFrame, folder: str, shard_rows: int = SHARD_ROWS) -> Index:
    """Write a graph per shard of about ``shard_rows`` vectors.

    Takes ``vec_id`` and ``vector``. Rows go to shards by a hash of their id,
    so every row is indexed and equal vectors are spread. No rows, no shards.
    """
    width = widest(rows)
    shards = -(-rows.count() // shard_rows)

    def build(given: pa.Table) -> pa.Table:
        vectors, members = distinct(given.column("vec_id").to_numpy(), matrix(given.column("vector"), width))
        graph = Graph(vectors).build()
        counts = np.array([len(m) for m in members])
        parts = (
            vectors.astype("<f8"),
            graph.edges.astype("<i4"),
            counts.astype("<i8"),
            np.concatenate(members).astype("<i8"),
        )
        columns = [given.column("shard")[:1], pa.array([graph.entry], pa.int64())]
        columns += [pa.array([part.tobytes()]) for part in parts]
        return pa.table(columns, names=["shard", "entry", "vectors", "edges", "counts", "ids"])

    layout = "shard long, entry long, vectors binary, edges binary, counts binary, ids binary"
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, shards))).alias("shard")
    rows.select("vec_id", "vector", shard).groupBy("shard").applyInArrow(build, layout).write.parquet(folder)
    return Index(folder, width, shards)


def search_index(
    index: Index, queries: DataFrame, k: int = 10, beam: int = SEARCH_BEAM, queries_per_task: int = QUERIES_PER_TASK
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest found of each query.

    The score is the Euclidean distance of the original vectors in double
    precision; ties go to the smaller id. Rows with the query's id are its own
    and left out. Of queries with equal ids one is answered. Queries travel in
    blocks, and each block visits every shard.
    """
    width, shards = index.width, index.shards
    chunks = max(1, -(-queries.count() // queries_per_task))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                ids = part.column("vec_id").to_numpy().astype("<i8").tobytes()
                given = matrix(part.column("vector"), width).astype("<f8").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([ids]), pa.array([given])], names=["ids", "queries"])

    def visit(blocks: pa.Table, shard: pa.Table) -> pa.Table:
        found: list[tuple] = []
        for row in shard.to_pylist():
            vectors = np.frombuffer(row["vectors"], "<f8").reshape(-1, width)
            edges = np.frombuffer(row["edges"], "<i4").reshape(len(vectors), -1)
            members = np.split(np.frombuffer(row["ids"], "<i8"), np.cumsum(np.frombuffer(row["counts"], "<i8"))[:-1])
            graph = Graph(vectors, edges, row["entry"])
            for ids, given in zip(blocks.column("ids").to_pylist(), blocks.column("queries").to_pylist()):
                query_ids = np.frombuffer(ids, "<i8").tolist()
                asked = np.frombuffer(given, "<f8").reshape(-1, width)
                for start in range(0, len(asked), BATCH):
                    part = asked[start : start + BATCH]
                    near, _ = graph.search(part.astype(np.float32), beam)
                    for query, wanted, places in zip(query_ids[start : start + BATCH], part, near):
                        found += nearest(query, wanted, places[places != NONE], vectors, members, k)
        columns = zip(*found) if found else [[], [], []]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["query_id", "vec_id", "score"])

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)).cast("array<long>"))

    blocks = (
        queries.select("vec_id", "vector")
        .dropDuplicates(["vec_id"])
        .mapInArrow(pack, "ids binary, queries binary")
        .withColumn("chunk", F.pmod(F.xxhash64("ids"), F.lit(chunks)))
    )
    if shards:
        blocks = blocks.withColumn("shard", every(shards))
    else:
        blocks = blocks.withColumn("shard", F.lit(0).cast("long"))
    parts = queries.sparkSession.read.parquet(index.folder).withColumn("chunk", every(chunks))
    local = (
        blocks.groupBy("shard", "chunk")
        .cogroup(parts.groupBy("shard", "chunk"))
        .applyInArrow(visit, "query_id long, vec_id long, score double")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return local.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(
    query: int, wanted: np.ndarray, places: np.ndarray, vectors: np.ndarray, members: list[np.ndarray], k: int
) -> list[tuple]:
    """The k nearest ids among the vectors at ``places``, the query's own left out."""
    gaps = np.sqrt(((vectors[places] - wanted) ** 2).sum(axis=1))
    out: list[tuple] = []
    for gap, place in sorted(zip(gaps.tolist(), places.tolist())):
        if len(out) >= k and gap > out[-1][2]:
            break
        out += [(query, i, gap) for i in members[place][: k + 1].tolist() if i != query]
    return sorted(out, key=lambda row: (row[2], row[1]))[:k]
