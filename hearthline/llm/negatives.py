"""Hard negatives by bounds along a spanning tree of anchors.

Anchors are taken in pages, and each page is joined to a minimum spanning tree by
Euclidean distance. For a candidate ``c``, a parent anchor ``p`` and its child ``a``,
``<c,a>`` lies within ``|a - p| * |c|`` of ``<c,p>``. Walking down the tree, a block
of candidates carries an interval of possible scores per candidate; only those
whose interval meets the child's window are scored again, which makes their
interval a point. The windows are, in a first walk, "as good as the fifth of the same
label" and, in a second, the range that the positives' scores allow.

Candidates lie in blocks by hash of their id, so a label that holds most rows is
spread over all blocks. A page meets a block in one task of bounded size, which
returns a bounded number of rows per anchor; nothing whole is gathered.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hearthline.session import cut_lineage, discard

#: Anchors of one tree and candidates of one block.
PAGE = 1_024
BLOCK = 8_192
#: Bounds are widened by this share, far above rounding.
SLACK = 1e-9
LONG = 2**63


def usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """``vec_id, label, dim, vector``: different rows with id, label and finite numbers, scaled and floored."""
    held = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").alias("label"),
                       F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    held = held.where("vec_id is not null and label is not null and v is not null and size(v) > 0").where(~bad)
    ints = F.transform("v", lambda x: F.floor(F.lit(scale) * x).cast("long"))
    return held.select("vec_id", "label", F.size("v").alias("dim"), ints.alias("vector")).distinct()


def matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parent (-1 for the first point) and edge length of every point, by Prim's rule."""
    n = len(points)
    points = points.astype(np.float64)
    parent, length = np.full(n, -1), np.zeros(n)
    best, source, left = np.full(n, np.inf), np.full(n, -1), np.ones(n, bool)
    at = 0
    for _ in range(n):
        left[at] = False
        parent[at], length[at] = source[at], best[at] if source[at] >= 0 else 0
        apart = np.sqrt(((points - points[at]) ** 2).sum(axis=1))
        nearer = left & (apart < best)
        best[nearer], source[nearer] = apart[nearer], at
        at = int(np.where(left, best, np.inf).argmin())
        if not left[at]:
            at = int(left.argmax())
    return parent, length


def walk(parent: np.ndarray) -> list[int]:
    """Parents before children, small subtrees first, so that few intervals are alive at a time."""
    children: dict[int, list[int]] = {}
    for child, own in enumerate(parent.tolist()):
        children.setdefault(own, []).append(child)
    down, stack = [], list(children.get(-1, []))
    while stack:
        at = stack.pop()
        down.append(at)
        stack += children.get(at, [])
    size = np.ones(len(parent), np.int64)
    for at in reversed(down):
        if parent[at] >= 0:
            size[parent[at]] += size[at]
    order, stack = [], sorted(children.get(-1, []), key=lambda c: -size[c])
    while stack:
        at = stack.pop()
        order.append(at)
        stack += sorted(children.get(at, []), key=lambda c: -size[c])
    return order


class Block:
    """Candidates of one block; scores are exact integers (floats while they are exact, else Python numbers)."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, points: np.ndarray):
        self.ids, self.labels = ids, labels
        self.norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1)) * (1 + SLACK)
        most = [int(np.abs(x.astype(np.float64)).max(initial=0)) for x in (vectors, points)]
        # A hundredfold sum below 2 ** 53 is exact in any order of additions.
        kind = np.float64 if 100 * most[0] * most[1] * vectors.shape[1] < 2**53 else object
        self.vectors, self.points = vectors.astype(kind), points.astype(kind)
        self.scored = 0

    def scores(self, rows: np.ndarray, at: int) -> np.ndarray:
        self.scored += len(rows)
        return self.vectors[rows] @ self.points[at]

    def intervals(self, parent: np.ndarray, length: np.ndarray, wanted):
        """Walks the tree. ``wanted(at, low, high)`` gives the rows to score again; yields ``at, rows, scores``."""
        low0, high0 = np.full(len(self.ids), -np.inf), np.full(len(self.ids), np.inf)
        waiting = np.bincount(parent[parent >= 0], minlength=len(parent))
        alive = {}
        for at in walk(parent):
            if parent[at] < 0:
                low, high = low0.copy(), high0.copy()
            else:
                above = alive[parent[at]]
                reach = length[at] * (1 + SLACK) * self.norms + 1
                low, high = above[0] - reach, above[1] + reach
                waiting[parent[at]] -= 1
                if not waiting[parent[at]]:
                    del alive[parent[at]]
            rows = wanted(at, low, high)
            found = self.scores(rows, at)
            if waiting[at]:
                exact = found.astype(np.float64)
                margin = np.abs(exact) * SLACK
                low[rows], high[rows] = exact - margin, exact + margin
                alive[at] = low, high
            yield at, rows, found


def _page(anchors: pa.Table, rows: pa.Table):
    anchors = anchors.sort_by("at")
    points = matrix(anchors.column("vector"), anchors.num_rows)
    block = Block(rows.column("vec_id").to_numpy(), rows.column("label").to_numpy(),
                  matrix(rows.column("vector"), rows.num_rows), points)
    parent, length = anchors.column("parent").to_numpy(), anchors.column("length").to_numpy()
    return anchors, block, parent, length


def _longs(values) -> pa.Array:
    """Scores as longs; what lies beyond their range takes its end."""
    return pa.array([max(-LONG, min(LONG - 1, int(v))) for v in values], pa.int64())


def _positives(most: int):
    def task(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if anchors.num_rows and rows.num_rows:
            anchors, block, parent, length = _page(anchors, rows)
            names, ids, labels = (anchors.column(c).to_pylist() for c in ("a", "vec_id", "label"))
            by_label = {v: np.flatnonzero(block.labels == v) for v in set(labels)}

            def wanted(at, low, high):
                own = by_label[labels[at]]
                own = own[block.ids[own] != ids[at]]
                if len(own) > most:
                    least = np.partition(low[own], len(own) - most)[len(own) - most]
                    own = own[high[own] >= least]
                return own

            for at, own, found in block.intervals(parent, length, wanted):
                if len(own) > most:
                    near = found >= np.sort(found)[-most]
                    own, found = own[near], found[near]
                order = sorted(range(len(own)), key=lambda k: (-found[k], block.ids[own[k]]))[:most]
                out += [(names[at], int(block.ids[own[k]]), found[k]) for k in order]
        a, numbers, found = zip(*out) if out else ((), (), ())
        return pa.table({"a": pa.array(a, pa.int64()), "positive_id": pa.array(numbers, pa.int64()),
                         "positive_score": _longs(found)})
    return task


def _negatives(most: int, low_share: int, high_share: int):
    def task(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if anchors.num_rows and rows.num_rows:
            anchors, block, parent, length = _page(anchors, rows)
            names, ids, labels, positives = (anchors.column(c).to_pylist() for c in ("a", "vec_id", "label", "positives"))
            other = {v: np.flatnonzero(block.labels != v) for v in set(labels)}
            # Whole-number ends of every positive's window, none if it is empty.
            ends = [[(p["rank"], -(-low_share * p["positive_score"] // 100), high_share * p["positive_score"] // 100)
                     for p in own or []] for own in positives]

            def wanted(at, low, high):
                own = other[labels[at]]
                own = own[block.ids[own] != ids[at]]
                meets = np.zeros(len(own), bool)
                for _, least, largest in ends[at]:
                    if least <= largest:
                        meets |= (high[own] >= least) & (low[own] <= largest)
                return own[meets]

            for at, own, found in block.intervals(parent, length, wanted):
                for rank, least, largest in ends[at] if len(own) else []:
                    inside = np.flatnonzero((found >= least) & (found <= largest))
                    if len(inside) > most:
                        inside = inside[found[inside] >= np.sort(found[inside])[-most]]
                    order = sorted(inside.tolist(), key=lambda k: (-found[k], block.ids[own[k]]))[:most]
                    out += [(names[at], rank, int(block.ids[own[k]]), found[k]) for k in order]
        a, ranks, numbers, found = zip(*out) if out else ((), (), (), ())
        return pa.table({"a": pa.array(a, pa.int64()), "rank_p": pa.array(ranks, pa.int32()),
                         "negative_id": pa.array(numbers, pa.int64()), "negative_score": _longs(found)})
    return task


def _tree(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("a")
    parent, length = spanning_tree(matrix(rows.column("vector"), rows.num_rows))
    return rows.append_column("at", pa.array(np.arange(rows.num_rows, dtype=np.int32))).append_column(
        "parent", pa.array(parent.astype(np.int32))).append_column("length", pa.array(length))


def _numbered(df: DataFrame, key: str, size: int, name: str) -> tuple[DataFrame, int]:
    parts = max(1, -(-df.count() // size))
    return df.withColumn(name, F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")), parts


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256,
         page: int = PAGE, block: int = BLOCK) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of every anchor and positive.

    Scores are inner products of ``floor(scale * x)``, higher ones first, ties to the smaller
    id. The positives are an anchor's first ``positives`` rows of its label and another
    id; a positive's negatives are the first ``negatives`` rows of other labels whose
    score is ``low`` to ``high`` hundredths of the positive's. ``anchors`` has the columns of ``rows``.

    Rows with a null id, label or vector, an empty vector, or a null or non-finite number
    take no part. Repeated rows are one; one id with several vectors or labels is several
    rows, and several anchors. Vectors of another length are no candidates. An
    anchor without positives, or a positive whose window no row meets, gives no rows;
    so does an empty table. Numbers beyond the range of a long take its end.
    """
    held = cut_lineage(usable(rows, id_col, vector_col, label_col, scale))
    asked = cut_lineage(usable(anchors, id_col, vector_col, label_col, scale).withColumn("a", F.monotonically_increasing_id()))
    dealt, blocks = _numbered(held, "vec_id", block, "block")
    paged, pages = _numbered(asked, "a", page, "page")
    schema = StructType(list(paged.schema.fields)).add("at", "integer").add("parent", "integer").add("length", "double")
    trees = cut_lineage(paged.groupBy("dim", "page").applyInArrow(_tree, schema))
    keys, tasks = ["dim", "page", "block"], min(4 * pages * blocks, 20_000)

    def meet(left: DataFrame, task, schema: str) -> DataFrame:
        left = left.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition(tasks, *keys)
        right = dealt.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(pages - 1)))).repartition(tasks, *keys)
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(task, schema)

    best = W.partitionBy("a").orderBy(F.desc("positive_score"), "positive_id")
    near = cut_lineage(meet(trees, _positives(positives), "a long, positive_id long, positive_score long")
                       .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives))
    windows = near.groupBy("a").agg(F.collect_list(F.struct("rank", "positive_score")).alias("positives"))
    found = meet(trees.join(windows, "a"), _negatives(negatives, low, high),
                 "a long, rank_p int, negative_id long, negative_score long")
    first = W.partitionBy("a", "rank_p").orderBy(F.desc("negative_score"), "negative_id")
    chosen = cut_lineage(found.withColumn("n", F.row_number().over(first)).where(F.col("n") <= negatives))
    result = cut_lineage(
        chosen.join(near.withColumnRenamed("rank", "rank_p"), ["a", "rank_p"])
        .join(asked.select("a", F.col("vec_id").alias("anchor_id")), "a")
        .select("anchor_id", "positive_id", F.col("n").cast("int").alias("rank"), "negative_id",
                "positive_score", "negative_score"))
    discard(held, asked, trees, near, chosen)
    return result
