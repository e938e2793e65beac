"""Exact top-k search by inner product: dual-tree search over cover trees.

Candidates and queries are dealt to blocks of bounded size. A task holds one
block of candidates and one of queries, builds a cover tree on each, and walks
pairs of nodes together. For a query node with centre c and covering radius r
and a candidate node with centre d and radius s no product can exceed
``<c, d> + r |d| + s |c| + r s``; the pair is pruned when that bound is below the
worst kth score among the node's queries. Blocks' results are merged by a
partial top-k per query.

Candidates take part in rounds: a small share first, by a hash of the row, then
``GROWTH`` times as many, until all have. A round compares its own candidates only
and merges what it finds with the k best so far; their kth score starts the
pruning in all blocks of the next round. A query's kth score over one share lets
about ``GROWTH * k`` rows of the next through, at any size of the table, so what
the blocks return grows with the queries and the number of rounds, which is the
logarithm of the size. The rounds only prune: every candidate is compared once,
and results are exact.

Vectors that are null, or hold a null or non-finite component, take no part;
vectors are matched with vectors of their own length only. Components become
floor(64 x). Repeated rows (equal id and vector) count once; rows of one id
never match each other, and an id's best row counts. Scores tie to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorflow.llm.common import ship
from sensorflow.session import scratch_path

K = 20
SCALE = 64
LEAF = 64
FANOUT = 4
#: Rows of a candidate block, of a query block, of the first round, and the factor
#: from round to round.
CANDIDATES, QUERIES, SEED, GROWTH = 2048, 8192, 4096, 16
#: Products of components below this are exact in doubles.
EXACT = 2.0**53


@dataclass
class Tree:
    """A cover tree: every point of node i's ``rows`` lies within ``radius[i]``
    of ``centre[i]``; ``children[i]`` split its rows, or are none at a leaf."""

    rows: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    centres: list[np.ndarray] = field(default_factory=list)
    radii: list[float] = field(default_factory=list)

    def add(self, rows: np.ndarray, centre: np.ndarray, gap: np.ndarray) -> int:
        self.rows.append(rows)
        self.children.append([])
        self.centres.append(centre)
        self.radii.append(float(gap.max(initial=0.0)))
        return len(self.rows) - 1


def cover_tree(points: np.ndarray) -> Tree:
    """Top-down construction. A node's first child is centred on the point nearest
    to its own centre; the next centres are points that no centre so far covers within half the node's
    radius, until all are covered or there are ``FANOUT``. Points go to their
    nearest centre; radii are measured."""
    tree = Tree()
    middle = points.mean(axis=0)
    todo = [tree.add(np.arange(len(points)), middle, np.linalg.norm(points - middle, axis=1))]
    while todo:
        parent = todo.pop()
        rows, radius = tree.rows[parent], tree.radii[parent]
        if len(rows) <= LEAF or radius == 0:
            continue
        own = points[rows]
        centres = [own[int(np.linalg.norm(own - tree.centres[parent], axis=1).argmin())]]
        gaps = [np.linalg.norm(own - centres[0], axis=1)]
        nearest = gaps[0]
        while len(centres) < FANOUT and nearest.max() > radius / 2:
            centres.append(own[int((nearest > radius / 2).argmax())])
            gaps.append(np.linalg.norm(own - centres[-1], axis=1))
            nearest = np.minimum(nearest, gaps[-1])
        owner = np.argmin(gaps, axis=0)
        made = [
            tree.add(rows[owner == i], at, gaps[i][owner == i])
            for i, at in enumerate(centres)
            if (owner == i).any()
        ]
        tree.children[parent] = made
        todo += made
    return tree


class Search:
    """The k best candidates of every query of a block."""

    def __init__(self, queries, query_ids, worst, candidates, candidate_ids, k: int = K) -> None:
        self.q, self.q_ids, self.c, self.c_ids, self.k = queries, query_ids, candidates, candidate_ids, k
        self.repeated = len(np.unique(candidate_ids)) < len(candidate_ids)
        self.worst = worst.copy()  # a candidate below it cannot be among the k best
        self.best: list[tuple[np.ndarray, np.ndarray]] = [
            (np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in queries
        ]
        fq, fc = queries.astype(np.float64), candidates.astype(np.float64)
        largest = np.abs(fq).max(initial=0) * np.abs(fc).max(initial=0) * max(1, fq.shape[1])
        self.fq, self.fc = (fq, fc) if largest < EXACT else (None, None)
        self.q_tree, self.c_tree = cover_tree(fq), cover_tree(fc)
        a, b = np.array(self.q_tree.centres), np.array(self.c_tree.centres)
        r, s = np.array(self.q_tree.radii), np.array(self.c_tree.radii)
        # the largest product of each pair of nodes; the last term covers rounding
        self.bound = a @ b.T
        self.bound += np.outer(r, np.linalg.norm(b, axis=1) + s) + np.outer(np.linalg.norm(a, axis=1), s)
        self.bound += 1e-9 * (1 + largest)
        self._walk()

    def _walk(self) -> None:
        q_tree, c_tree = self.q_tree, self.c_tree
        todo = [(0, 0)]
        while todo:
            q, c = todo.pop()
            if self.bound[q, c] < self.worst[q_tree.rows[q]].min():
                continue
            if not q_tree.children[q] and not c_tree.children[c]:
                self._compare(q_tree.rows[q], c_tree.rows[c])
                continue
            qs, cs = q_tree.children[q] or [q], c_tree.children[c] or [c]
            bounds = self.bound[np.ix_(qs, cs)]
            least = np.array([self.worst[q_tree.rows[i]].min() for i in qs])
            i, j = np.nonzero(bounds >= least[:, None])
            # the most promising pair is taken next, so thresholds rise early
            order = np.argsort(bounds[i, j], kind="stable")
            todo += [(qs[x], cs[y]) for x, y in zip(i[order], j[order])]

    def _compare(self, q_rows: np.ndarray, c_rows: np.ndarray) -> None:
        if self.fq is not None:
            scores = (self.fq[q_rows] @ self.fc[c_rows].T).astype(np.int64)
        else:
            scores = self.q[q_rows] @ self.c[c_rows].T
        ids = self.c_ids[c_rows]
        hopeful = (scores >= self.worst[q_rows, None]) & (ids != self.q_ids[q_rows, None])
        for row in np.flatnonzero(hopeful.any(axis=1)):
            q, good = q_rows[row], hopeful[row]
            s = np.concatenate([self.best[q][0], scores[row][good]])
            i = np.concatenate([self.best[q][1], ids[good]])
            top = np.lexsort((i, -s))
            if self.repeated:  # the best row of each id
                top = top[np.sort(np.unique(i[top], return_index=True)[1])]
            top = top[: self.k]
            self.best[q] = (s[top], i[top])
            if len(top) == self.k:
                self.worst[q] = max(self.worst[q], s[top][-1])


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.int64) for v in column])


LOWEST = np.iinfo(np.int64).min


def top_k(
    vectors: DataFrame,
    is_query,
    k: int = K,
    candidates_per_block: int = CANDIDATES,
    queries_per_block: int = QUERIES,
    seed_rows: int = SEED,
) -> DataFrame:
    """query_id, rank, vec_id, score over ``vectors`` (vec_id, embedding).

    Of each round, candidates are copied to every block of queries and queries to
    every block of candidates, in bounded blocks; pairs of rows exist only inside a
    task. Nothing but counts reaches the driver.
    """
    spark = vectors.sparkSession
    ship(spark)
    folder = scratch_path(spark, "top-k")
    infinite = (float("inf"), float("-inf"))
    whole = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & ~x.cast("double").isin(*infinite),
    )
    rows = (
        vectors.where(F.col("embedding").isNotNull() & whole & F.col("vec_id").isNotNull())
        .select(
            F.col("vec_id").cast("bigint").alias("vec_id"),
            F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE)).alias("v"),
        )
        .distinct()
    )
    # a row's place between 0 and 1; by id and vector, so the rows of a frequent id are spread
    place = F.xxhash64("vec_id", "v", F.lit(1)) / F.lit(2.0**64) + 0.5
    rows.withColumn("dim", F.size("v")).withColumn("place", place).write.parquet(f"{folder}/points")
    points = lambda: spark.read.parquet(f"{folder}/points")
    queries = points().where(is_query(F.col("vec_id"))).drop("place")
    n_points, n_queries = points().count(), queries.count()
    block = lambda n, salt: F.pmod(F.xxhash64("vec_id", "v", F.lit(salt)), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))
    q_blocks = max(1, -(-n_queries // queries_per_block))

    def search(key, q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        q, c = q.sort_values("vec_id"), c.sort_values("vec_id")
        ids = q["vec_id"].to_numpy()
        found = Search(_matrix(q["v"]), ids, q["floor"].to_numpy(), _matrix(c["v"]), c["vec_id"].to_numpy(), k)
        n = [len(s) for s, _ in found.best]
        return pd.DataFrame(
            {
                "query_id": np.repeat(ids, n),
                "vec_id": np.concatenate([i for _, i in found.best]),
                "score": np.concatenate([s for s, _ in found.best]),
            }
        )

    by = ["dim", "c", "q"]
    # the limit on the rank is pushed before the shuffle: a task hands on k rows a query
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best: DataFrame | None = None
    low, turn = 0.0, 0
    while low < 1.0:
        high = min(1.0, seed_rows * GROWTH**turn / max(1, n_points))
        if high > 1.0 / GROWTH * 4:  # a small rest is no round of its own
            high = 1.0
        upper = F.col("place") < high if high < 1.0 else F.lit(True)
        new = points().where((F.col("place") >= low) & upper) if low else points().where(upper)
        c_blocks = max(1, -(-int(n_points * (high - low)) // candidates_per_block))
        started = queries.withColumn("floor", F.lit(LOWEST))
        if best is not None:
            # the kth score so far, if there are k: it may only rise
            kth = best.groupBy(F.col("query_id").alias("vec_id")).agg(
                F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(LOWEST)).alias("floor")
            )
            started = queries.join(kth, "vec_id", "left").withColumn("floor", F.coalesce("floor", F.lit(LOWEST)))
        left = started.select("vec_id", "v", "dim", "floor").withColumn("q", block(q_blocks, 3)).withColumn("c", every(c_blocks))
        right = new.drop("place").withColumn("c", block(c_blocks, 2)).withColumn("q", every(q_blocks))
        hits = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(
            search, "query_id bigint, vec_id bigint, score bigint"
        )
        hits = hits if best is None else hits.unionByName(best.select("query_id", "vec_id", "score"))
        ranked = (
            hits.groupBy("query_id", "vec_id")
            .agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score")
        )
        if high >= 1.0:
            return ranked
        ranked.write.parquet(f"{folder}/best-{turn}")
        best = spark.read.parquet(f"{folder}/best-{turn}")
        low, turn = high, turn + 1
    raise AssertionError("unreachable")
