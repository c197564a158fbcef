"""Approximate nearest neighbours on robust-pruned directed graphs, one per shard.

Different vectors are dealt evenly over shards. A shard's graph takes its vectors
in random order and in growing batches: a greedy beam search on the graph so far
proposes neighbours, and pruning keeps one only if no kept neighbour is nearer to
it by the factor ``alpha``, which leaves short and long edges in all directions.
Queries run a beam search on every shard; each shard's nearest are measured again
in double precision and merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hearthline.llm.blas import one_thread
from hearthline.session import cut_lineage

SHARD_ROWS = 5_000
DEGREE = 32
BUILD_BEAM = 64
BEAM = 128
ALPHA = 1.2
#: Queries that one task takes to a shard.
PAGE = 20_000
SEED = 11
MOST_TASKS = 20_000


class Graph:
    """Vectors, their out-edges (padded with -1) and the vector where searches begin."""

    def __init__(self, vectors: np.ndarray, degree: int):
        self.vectors = np.ascontiguousarray(vectors, np.float32)
        self.norms = np.einsum("ij,ij->i", self.vectors, self.vectors)
        self.edges = np.full((len(vectors), degree), -1, np.int32)
        self.entry = int(((self.vectors - self.vectors.mean(axis=0)) ** 2).sum(axis=1).argmin()) if len(vectors) else 0

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """For each query the nearest found, nearest first, and the vectors it went through; -1 fills up."""
        queries = np.ascontiguousarray(queries, np.float32)
        n, lanes = len(queries), np.arange(len(queries))
        ids = np.full((n, beam), -1, np.int64)
        far = np.full((n, beam), np.inf, np.float32)
        done = np.ones((n, beam), bool)
        seen = np.zeros((n, len(self.vectors)), bool)
        ids[:, 0], done[:, 0] = self.entry, False
        far[:, 0] = ((queries - self.vectors[self.entry]) ** 2).sum(axis=1)
        seen[:, self.entry] = True
        trail = []
        while True:
            open_far = np.where(done, np.inf, far)
            pick = open_far.argmin(axis=1)
            alive = lanes[np.isfinite(open_far[lanes, pick])]
            if not len(alive):
                break
            at = pick[alive]
            here = ids[alive, at]
            done[alive, at] = True
            step = np.full(n, -1, np.int64)
            step[alive] = here
            trail.append(step)
            near = self.edges[here].astype(np.int64)
            fresh = (near >= 0) & ~seen[alive[:, None], near]
            near[~fresh] = 0
            seen[alive[:, None], near] |= fresh
            dots = np.matmul(self.vectors[near], queries[alive][:, :, None])[:, :, 0]
            apart = self.norms[near] - 2 * dots + (queries[alive] ** 2).sum(axis=1)[:, None]
            apart[~fresh] = np.inf
            all_far = np.concatenate([far[alive], apart], axis=1)
            keep = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
            far[alive] = np.take_along_axis(all_far, keep, 1)
            ids[alive] = np.take_along_axis(np.concatenate([ids[alive], np.where(fresh, near, -1)], axis=1), keep, 1)
            done[alive] = np.take_along_axis(np.concatenate([done[alive], ~fresh], axis=1), keep, 1)
        order = np.argsort(far, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.array(trail).T

    def prune(self, point: int, candidates: np.ndarray, alpha: float) -> np.ndarray:
        """At most a row of edges: the nearest candidate, then the nearest that none kept is clearly closer to."""
        candidates = np.unique(candidates)
        candidates = candidates[(candidates >= 0) & (candidates != point)]
        if not len(candidates):
            return candidates
        own = self.vectors[candidates]
        apart = self.norms[candidates] - 2 * own @ self.vectors[point] + self.norms[point]
        order = np.argsort(apart, kind="stable")
        candidates, own, apart = candidates[order], own[order], apart[order]
        between = self.norms[candidates][:, None] - 2 * own @ own.T + self.norms[candidates][None, :]
        covered = alpha * alpha * between <= apart[None, :]
        left, kept = np.ones(len(candidates), bool), []
        for i in range(len(candidates)):
            if left[i]:
                kept.append(i)
                if len(kept) == self.edges.shape[1]:
                    break
                left &= ~covered[i]
        return candidates[kept]

    def build(self, beam: int, alpha: float) -> None:
        n = len(self.vectors)
        order = np.random.default_rng(SEED).permutation(n)
        order = np.concatenate([[self.entry], order[order != self.entry]]) if n else order
        begin = 1
        while begin < n:
            batch = order[begin:begin + min(begin, 256)]
            found, through = self.search(self.vectors[batch], beam)
            back: dict[int, list[int]] = {}
            for k, point in enumerate(batch.tolist()):
                near = self.prune(point, np.concatenate([found[k], through[k]]), alpha)
                self.edges[point, :len(near)] = near
                for other in near.tolist():
                    back.setdefault(other, []).append(point)
            for other, points in back.items():
                own = self.edges[other]
                own = own[own >= 0]
                both = np.concatenate([own, points])
                if len(both) > len(self.edges[other]):
                    both = self.prune(other, both, alpha)
                self.edges[other] = -1
                self.edges[other, :len(both)] = both
            begin += len(batch)
        if n:
            self.connect(beam)

    def reached(self) -> np.ndarray:
        """Which vectors a path leads to from the entry."""
        seen = np.zeros(len(self.vectors), bool)
        front = np.array([self.entry])
        while len(front):
            seen[front] = True
            front = np.unique(self.edges[front])
            front = front[front >= 0]
            front = front[~seen[front]]
        return seen

    def connect(self, beam: int) -> None:
        """Gives every vector that pruning has cut off an edge from one of the nearest that are reached."""
        lost = np.flatnonzero(~self.reached())
        more: dict[int, list[int]] = {}
        for first in range(0, len(lost), 256):
            part = lost[first:first + 256]
            near, _ = self.search(self.vectors[part], beam)
            for point, found in zip(part.tolist(), near):
                # Vectors with few such edges first, so that equal ones do not all hang on one.
                give = min(found[found >= 0][:16].tolist(), key=lambda c: len(more.get(c, ())))
                more.setdefault(give, []).append(point)
        if more:
            wider = np.full((len(self.vectors), max(map(len, more.values()))), -1, np.int32)
            for give, points in more.items():
                wider[give, :len(points)] = points
            self.edges = np.concatenate([self.edges, wider], axis=1)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, dim, vector``: rows with an id and a vector that is not zero and all of finite numbers."""
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                          F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    return (rows.where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
            .where(~bad).where(F.exists(v, lambda x: x != 0)).select("id", F.size("v").alias("dim"), v.alias("vector")))


def different(rows: DataFrame, most: int) -> DataFrame:
    """``dim, vector, ids``: every different vector with its smallest ids, at most ``most``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Repeats of a vector are brought together before they move.
        for batch in batches:
            found: dict[bytes, set[int]] = {}
            for i, v in zip(batch.column("id").to_pylist(), batch.column("vector").to_pylist()):
                found.setdefault((np.array(v) + 0.0).tobytes(), set()).add(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()),
                 pa.array([sorted(ids)[:most] for ids in found.values()], pa.list_(pa.int64()))], ["vector", "ids"])

    lowest = F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, most).alias("ids")
    parts = rows.select("id", "vector").mapInArrow(task, "vector binary, ids array<long>")
    salted = parts.groupBy("vector", F.pmod(F.xxhash64("ids"), F.lit(64)).alias("salt")).agg(lowest)
    return (salted.groupBy("vector").agg(lowest)
            .select((F.length("vector") / 8).cast("int").alias("dim"), "vector", "ids"))


NODES = "dim int, shard int, at int, vector binary, ids array<long>, edges array<int>, entry int"


def _built(degree: int, beam: int, alpha: float):
    def task(rows: pa.Table) -> pa.Table:
        one_thread()
        rows = rows.sort_by("vector")
        vectors = np.frombuffer(b"".join(rows.column("vector").to_pylist())).reshape(rows.num_rows, -1)
        graph = Graph(vectors, degree)
        graph.build(beam, alpha)
        edges = [e[e >= 0] for e in graph.edges]
        return pa.table({
            "dim": rows.column("dim"), "shard": rows.column("shard"),
            "at": pa.array(np.arange(rows.num_rows, dtype=np.int32)), "vector": rows.column("vector"),
            "ids": rows.column("ids"), "edges": pa.array(edges, pa.list_(pa.int32())),
            "entry": pa.array(np.full(rows.num_rows, graph.entry, np.int32))})
    return task


def build_index(vectors: DataFrame, most: int, id_col: str = "vec_id", vector_col: str = "embedding",
                shard_rows: int = SHARD_ROWS, degree: int = DEGREE, beam: int = BUILD_BEAM,
                alpha: float = ALPHA) -> tuple[DataFrame, int]:
    """Graphs over all usable vectors in stored form, one row per different vector; number of shards.

    Vectors of different lengths are in different shards. A vector is stored once
    with its ``most`` smallest ids.
    """
    nodes = cut_lineage(different(usable(vectors, id_col, vector_col), most))
    shards = max(1, -(-nodes.count() // shard_rows))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int"))
    # Cost is in building, not in bytes: ranges of whole shards, one a task, whose given number is kept.
    dealt = dealt.repartitionByRange(min(shards, MOST_TASKS), "dim", "shard")
    return cut_lineage(dealt.groupBy("dim", "shard").applyInArrow(_built(degree, beam, alpha), NODES)), shards


FOUND = "query_id long, query binary, vec_id long, score double"


def _searched(k: int, beam: int):
    def task(index: pa.Table, queries: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "query": pa.array([], pa.binary()),
                          "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not index.num_rows or not queries.num_rows:
            return empty
        one_thread()
        index = index.sort_by("at")
        exact = np.frombuffer(b"".join(index.column("vector").to_pylist())).reshape(index.num_rows, -1)
        graph = Graph(exact, max(1, max(len(e) for e in index.column("edges").to_pylist())))
        for row, own in zip(graph.edges, index.column("edges").to_pylist()):
            row[:len(own)] = own
        graph.entry = index.column("entry")[0].as_py()
        ids = index.column("ids").to_pylist()
        names, codes = queries.column("query_id").to_pylist(), queries.column("query").to_pylist()
        out = []
        for first in range(0, len(names), 256):
            own_names, own_codes = names[first:first + 256], codes[first:first + 256]
            points = np.frombuffer(b"".join(own_codes)).reshape(len(own_names), -1)
            left, width = np.arange(len(own_names)), beam
            while len(left):
                near, _ = graph.search(points[left], width)
                tied = []
                for at, found in zip(left.tolist(), near):
                    found = found[found >= 0]
                    apart = np.sqrt(((exact[found] - points[at]) ** 2).sum(axis=1))
                    # The query's own vector may be one of k + 1; all that are as near as the last one count.
                    last = np.partition(apart, k)[k] if len(apart) > k else np.inf
                    if len(found) == width < index.num_rows and apart.max() <= last:
                        tied.append(at)
                        continue
                    rows = sorted((apart[b], i) for b in np.flatnonzero(apart <= last)
                                  for i in ids[found[b]] if i != own_names[at])[:k]
                    out += [(own_names[at], own_codes[at], i, float(d)) for d, i in rows]
                # A beam that ends among equal distances may have left smaller ids out.
                left, width = np.array(tied, np.int64), min(2 * width, index.num_rows)
        if not out:
            return empty
        columns = list(zip(*out))
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "query": pa.array(columns[1], pa.binary()),
                         "vec_id": pa.array(columns[2], pa.int64()), "score": pa.array(columns[3], pa.float64())})
    return task


def nearest(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
            shard_rows: int = SHARD_ROWS, degree: int = DEGREE, beam: int = BEAM, build_beam: int = BUILD_BEAM,
            alpha: float = ALPHA, page: int = PAGE) -> DataFrame:
    """The ``k`` nearest found for every query: ``query_id, rank, vec_id, score``, Euclidean distance.

    Both tables have the id and the vector column; a query never finds its own id. Ties go to the
    smaller id, among all vectors of that distance: a beam that ends between equal distances is widened. Rows without an id, and vectors that are null, zero or hold null or
    non-finite numbers take no part; vectors of another length are no candidates.
    Repeated rows are one; one id with two vectors is two queries and two candidates.
    With no more than ``k`` candidates of a query's length in a shard all are found.
    """
    index, shards = build_index(vectors, k + 1, id_col, vector_col, shard_rows, degree, build_beam, alpha)
    asked = cut_lineage(different_queries(queries, id_col, vector_col))
    pages = max(1, -(-asked.count() // page))
    # Every page of queries goes to every shard of its length.
    sent = (asked.withColumn("page", F.pmod(F.xxhash64("query_id", "query"), F.lit(pages)).cast("int"))
            .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    held = index.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(pages - 1))))
    keys = ["dim", "shard", "page"]
    tasks = min(4 * shards * pages, MOST_TASKS)
    found = held.repartition(tasks, *keys).groupBy(*keys).cogroup(
        sent.repartition(tasks, *keys).groupBy(*keys)).applyInArrow(_searched(k, beam), FOUND)
    rank = F.row_number().over(W.partitionBy("query_id", "query").orderBy("score", "vec_id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def different_queries(queries: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``query_id, dim, query``: the usable queries, repeated rows once."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [(np.array(v) + 0.0).tobytes() for v in batch.column("vector").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("dim"), pa.array(codes, pa.binary())],
                                             ["query_id", "dim", "query"])

    return usable(queries, id_col, vector_col).mapInArrow(task, "query_id long, dim int, query binary").distinct()
