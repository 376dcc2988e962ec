"""Two ways to keep faces apart that cannot be similar: a tree of pivots (exact), hash tables (approximate).

Both give every face a cell and every query the cells it has to see; cells are then searched as blocks of
bounded size.  Vectors are rows of length 1 everywhere here.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modspark.operators.joins import lookup_join
from modspark.scratch import settle

# Numbers that a broadcast matrix may hold (64 MB).
MATRIX_NUMBERS = 8_000_000
MAX_TABLES, MAX_BITS, MAX_PROBES = 64, 24, 64
SEED = 20_240_101
# What looking into one more bucket costs, in faces compared; and what it costs to move a row to its task.
LOOKUP = 20
MOVE = 1000
# Rows times leaves that a task looks at together.
VISITS = 500_000


def unit_rows(column) -> np.ndarray:
    if len(column) == 0:
        return np.empty((0, 0))
    m = np.stack(column.to_numpy()).astype("float64")
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm == 0, 1.0, norm)


def reach_of(min_similarity: float) -> float:
    """The angle that a similar face may be away; similarities are compared after rounding to 6 digits."""
    return float(np.arccos(np.clip(min_similarity - 1e-6, -1.0, 1.0))) + 1e-6


def _angles(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(rows @ pivots.T, -1.0, 1.0))


def _far_apart(rows: np.ndarray, n: int) -> np.ndarray:
    """Numbers of up to ``n`` rows, each the farthest from those before it, so that every cluster gets one."""
    chosen = [0]
    nearest = _angles(rows, rows[:1])[:, 0]
    while len(chosen) < min(n, len(rows)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _angles(rows, rows[chosen[-1]:chosen[-1] + 1])[:, 0])
    return np.array(chosen)


# --- tree of pivots -----------------------------------------------------------------------------


class PivotTree:
    """Pivots on two levels.  A face belongs to the nearest pivot of the first level and, among that one's
    children, to the nearest of the second, so placing a row costs about the fourth root of the rows twice.

    ``parent`` names the first-level pivot of every leaf; the leaves of a parent stand together.
    """

    def __init__(self, sample: np.ndarray, leaves: int):
        # Copies of one face would be pivots that tell nothing apart.
        order = np.unique(np.round(sample, 9), axis=0, return_index=True)[1]
        rows = sample[np.sort(order)]
        first = max(1, math.isqrt(max(1, leaves)))
        self.tops = rows[_far_apart(rows, first)]
        nearest = _angles(rows, self.tops).argmin(axis=1)
        children = max(1, -(-leaves // len(self.tops)))
        near = [np.flatnonzero(nearest == i) for i in range(len(self.tops))]
        own = [x[_far_apart(rows[x], children)] for x in near if len(x)]
        self.tops = self.tops[[i for i, x in enumerate(near) if len(x)]]
        self.parent = np.repeat(np.arange(len(own)), [len(x) for x in own])
        self.pivots = rows[np.concatenate(own)]
        self.begin = np.searchsorted(self.parent, np.arange(len(self.tops) + 1))

    def place(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each row its leaf and the angles to the leaf's parent and to the leaf's pivot."""
        top = _angles(rows, self.tops)
        parent = top.argmin(axis=1)
        leaf, angle = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows))
        for p in np.unique(parent):
            at = np.flatnonzero(parent == p)
            a = _angles(rows[at], self.pivots[self.begin[p]:self.begin[p + 1]])
            leaf[at] = self.begin[p] + a.argmin(axis=1)
            angle[at] = a.min(axis=1)
        return leaf, top[np.arange(len(rows)), parent], angle

    def visits(self, rows: np.ndarray, bounds: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """``(row, leaf)`` for all leaves that may hold a face within ``reach`` of a row.

        ``bounds``: per leaf the smallest and largest angle of its faces to the parent and to the pivot.
        By the triangle inequality a row's angle to a pivot differs by at most ``reach`` from that of a
        similar face, and no sibling of that face's pivot is nearer to the row by more than 2 * reach.
        """
        def possible(a: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
            return (a - reach <= far[None, :]) & (a + reach >= near[None, :])

        top_near, top_far, near, far = bounds.T
        top = _angles(rows, self.tops)
        by_top = top <= top.min(axis=1, keepdims=True) + 2 * reach + 1e-9
        found_rows, found_leaves = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for p in range(len(self.tops)):
            leaves = slice(self.begin[p], self.begin[p + 1])
            at = np.flatnonzero(by_top[:, p])
            if not len(at):
                continue
            a = _angles(rows[at], self.pivots[leaves])
            may = possible(top[at, p][:, None], top_near[leaves], top_far[leaves]) & possible(a, near[leaves], far[leaves])
            may &= a <= a.min(axis=1, keepdims=True) + 2 * reach + 1e-9
            r, leaf = np.nonzero(may)
            found_rows.append(at[r])
            found_leaves.append(leaf + self.begin[p])
        return np.concatenate(found_rows), np.concatenate(found_leaves)


class TreePlan(NamedTuple):
    """``placed``: faces with ``cell``; ``leaves``: (cell, n); ``met``: (cell, q), how many queries see a leaf.

    ``visits()`` makes the queries with each ``cell`` to see: vectors are repeated, so only for a search.
    """

    placed: DataFrame
    leaves: DataFrame
    met: DataFrame
    n_queries: int
    visits: Callable[[], DataFrame]


def leaf_count(rows: int, width: int) -> int:
    """About the root of the rows, as far as the pivots fit a broadcast."""
    return max(1, min(math.isqrt(max(0, rows - 1)) + 1, MATRIX_NUMBERS // max(1, width)))


def tree_plan(q: DataFrame, c: DataFrame, min_similarity: float, leaves: int | None, width: int) -> TreePlan | None:
    """Place all faces in a tree over a sample of them; None for an empty collection.

    The sample has four rows for a leaf, those of smallest hash, and so is bounded by the broadcast.
    """
    spark = c.sparkSession
    leaves = leaves or leaf_count(c.count(), width)
    sample = c.orderBy(F.xxhash64("face_id"), "face_id").limit(4 * leaves).toPandas()
    if sample.empty:
        return None
    tree = spark.sparkContext.broadcast(PivotTree(unit_rows(sample["v"]), leaves))
    c_kind, q_kind = dict(c.dtypes), dict(q.dtypes)

    def place(batches):
        for batch in batches:
            if len(batch):
                cell, top, angle = tree.value.place(unit_rows(batch["v"]))
                yield batch.assign(cell=cell, top=top, angle=angle)

    # Written out, so that the bounds below hold for the very rows that are searched later.
    placed = settle(c.mapInPandas(place, f"face_id {c_kind['face_id']}, v {c_kind['v']}, cell long, top double, angle double"))
    stats = settle(placed.groupBy("cell").agg(
        F.min("top").alias("a"), F.max("top").alias("b"), F.min("angle").alias("c"), F.max("angle").alias("d"),
        F.count("*").alias("n"),
    ))
    n_leaves = len(tree.value.parent)
    bounds = np.tile([np.inf, -np.inf, np.inf, -np.inf], (n_leaves, 1))  # empty leaves are never seen
    for r in stats.collect():  # one row for each leaf
        bounds[r["cell"]] = r["a"], r["b"], r["c"], r["d"]
    shared = spark.sparkContext.broadcast(bounds)
    reach = reach_of(min_similarity)

    def seen(batches):
        # A few rows at once: at a low floor every row sees every leaf.
        step = max(1, VISITS // max(1, n_leaves))
        for batch in batches:
            for lo in range(0, len(batch), step):
                rows = batch.iloc[lo : lo + step]
                yield rows, *tree.value.visits(unit_rows(rows["v"]), shared.value, reach)

    def visit(batches):
        for rows, row, cell in seen(batches):
            for lo in range(0, len(row), 10_000):
                yield rows.iloc[row[lo : lo + 10_000]].assign(cell=cell[lo : lo + 10_000])

    def count(batches):
        # The leaves that queries see are counted in the task; no query leaves it.
        n = np.zeros(n_leaves + 1, dtype=np.int64)
        for rows, _, cell in seen(batches):
            n[:-1] += np.bincount(cell, minlength=n_leaves)
            n[-1] += len(rows)
        at = np.flatnonzero(n)
        yield pd.DataFrame({"cell": at, "q": n[at]})

    met = settle(q.mapInPandas(count, "cell long, q long").groupBy("cell").agg(F.sum("q").alias("q")))
    n_queries = met.filter(F.col("cell") == n_leaves).agg(F.coalesce(F.sum("q"), F.lit(0))).head()[0]
    return TreePlan(
        placed.drop("top", "angle"), stats.select("cell", "n"), met.filter(F.col("cell") < n_leaves), n_queries,
        lambda: settle(q.mapInPandas(visit, f"query_id {q_kind['query_id']}, v {q_kind['v']}, cell long")),
    )


def search_cost(plan: TreePlan) -> DataFrame:
    """One row: faces, queries, leaves, and on average per query the leaves and the faces it meets."""
    sums = _sums(plan)
    queries = F.lit(max(1, plan.n_queries))
    return sums.select(
        "faces", F.lit(plan.n_queries).cast("long").alias("queries"), "leaves", (F.col("visits") / queries).alias("leaves_per_query"),
        (F.col("met") / queries).alias("faces_per_query"), (F.col("met") / queries / F.col("faces")).alias("share"),
    )


def _sums(plan: TreePlan) -> DataFrame:
    # Both have one row for each leaf.
    return plan.leaves.join(plan.met, "cell", "left").agg(
        F.sum("n").alias("faces"), F.count("*").alias("leaves"), F.coalesce(F.sum("q"), F.lit(0)).alias("visits"),
        F.coalesce(F.sum(F.col("q") * F.col("n")), F.lit(0)).alias("met"),
    )


def grid_is_cheaper(plan: TreePlan, group_rows: int) -> bool:
    """Whether all pairs, in a grid of groups, cost less than the leaves: pairs compared and rows moved."""
    s, queries = _sums(plan).head(), plan.n_queries
    moved = queries * -(-s["faces"] // group_rows) + s["faces"] * -(-queries // group_rows)
    return queries * s["faces"] + MOVE * moved <= s["met"] + MOVE * (s["visits"] + s["faces"])


# --- hash tables --------------------------------------------------------------------------------


class HashPlan(NamedTuple):
    """``tables`` tables of ``bits`` random directions, of which a query looks into ``probes`` buckets each."""

    tables: int
    bits: int
    probes: int
    found: float  # the chance that a pair at the floor meets in one table


def flips(margins: np.ndarray, probes: int) -> np.ndarray:
    """For each row the ``probes`` cheapest sets of up to two bits to turn, as numbers to xor with.

    A bit is the likelier to differ in a similar vector, the smaller the row's distance to its plane.
    """
    bits = margins.shape[1]
    cost = margins**2
    one = np.arange(bits)
    x, y = np.triu_indices(bits, 1)
    sets = np.concatenate([[0], 1 << one, (1 << x) | (1 << y)]).astype(np.int64)
    costs = np.concatenate([np.zeros((len(margins), 1)), cost, cost[:, x] + cost[:, y]], axis=1)
    take = min(probes, len(sets))
    best = np.argpartition(costs, take - 1, axis=1)[:, :take] if take < len(sets) else np.tile(np.arange(len(sets)), (len(margins), 1))
    return sets[best]


def codes(projected: np.ndarray) -> np.ndarray:
    return (projected > 0) @ (1 << np.arange(projected.shape[1], dtype=np.int64))


def hash_plan(
    rows: int, min_similarity: float, recall: float, bits: int | None = None, trials: int = 4000
) -> HashPlan:
    """The cheapest tables that find a pair at the floor with a chance of at least ``recall``.

    The chance in one table is measured on random pairs at that angle, with the very rule that picks
    buckets.  Costs are the faces that a query meets, and ``LOOKUP`` more for every bucket.  Few faces or
    a low floor make one table with all its buckets the cheapest.  ``bits`` fixes the width instead.
    """
    rng = np.random.default_rng(SEED)
    floor = float(np.clip(min_similarity, -1.0, 1.0))
    best = None
    widest = min(MAX_BITS, max(3, math.ceil(math.log2(max(2, rows)))))
    for bits in [bits] if bits else range(2, widest + 1):
        x = rng.normal(size=(trials, bits))
        y = floor * x + math.sqrt(1 - floor**2) * rng.normal(size=(trials, bits))
        for probes in (1, 2, 4, 8, 16, 32, MAX_PROBES):
            if probes > 1 << bits:
                break
            met = (flips(x, probes) ^ codes(x)[:, None] == codes(y)[:, None]).any(axis=1).mean()
            # A lower bound of the chance, so that the promise holds beside the measuring error.
            chance = min(float(met) - 3 * math.sqrt(max(met * (1 - met), 1e-4) / trials), 1 - 1e-9)
            if chance <= 0:
                continue
            tables = max(1, math.ceil(math.log(1 - recall) / math.log(1 - chance)))
            cost = tables * probes * (rows / 2**bits + LOOKUP)
            if tables <= MAX_TABLES and (best is None or cost < best[0]):
                best = (cost, HashPlan(tables, bits, probes, chance))
    if best is None:  # a floor so low that pairs hardly differ from chance: every pair meets
        return HashPlan(1, 1, 2, 1.0)
    return best[1]


class Hashes:
    """The buckets of rows: the same directions in every task, made from a fixed seed."""

    def __init__(self, plan: HashPlan, width: int):
        self.plan = plan
        self.directions = np.random.default_rng(SEED).normal(size=(width, plan.tables * plan.bits))

    def projected(self, rows: np.ndarray) -> np.ndarray:
        return (rows @ self.directions).reshape(len(rows), self.plan.tables, self.plan.bits)

    def of_faces(self, rows: np.ndarray) -> np.ndarray:
        """A face's bucket in each table."""
        return self._in_steps(rows, codes, ())

    def of_queries(self, rows: np.ndarray) -> np.ndarray:
        """The buckets of each table that a query looks into."""
        sets = 1 + self.plan.bits * (self.plan.bits + 1) // 2
        return self._in_steps(
            rows, lambda p: codes(p)[:, None] ^ flips(p, self.plan.probes), (min(self.plan.probes, sets),)
        )

    def _in_steps(self, rows: np.ndarray, buckets: Callable, more: tuple) -> np.ndarray:
        out = np.empty((len(rows), self.plan.tables, *more), dtype=np.int32)
        step = max(1, VISITS // (self.plan.tables * self.plan.bits))
        for lo in range(0, len(rows), step):
            p = self.projected(rows[lo : lo + step])
            for t in range(self.plan.tables):
                out[lo : lo + step, t] = buckets(p[:, t])
        return out


def hash_cells(q: DataFrame, c: DataFrame, plan: HashPlan, width: int) -> tuple[DataFrame, DataFrame]:
    """``(queries, faces)`` with ``cell``: each face once for each table, each query once for each bucket."""

    def numbered(code: np.ndarray, table: int) -> np.ndarray:
        return code + (table << plan.bits)

    def of_faces(batches):
        hashes = Hashes(plan, width)
        for batch in batches:
            if len(batch):
                p = hashes.projected(unit_rows(batch["v"]))
                for t in range(plan.tables):
                    yield batch.assign(cell=numbered(codes(p[:, t]), t))

    def of_queries(batches):
        hashes = Hashes(plan, width)
        for batch in batches:
            if len(batch):
                p = hashes.projected(unit_rows(batch["v"]))
                for t in range(plan.tables):
                    seen = codes(p[:, t])[:, None] ^ flips(p[:, t], plan.probes)
                    yield batch.iloc[np.repeat(np.arange(len(batch)), seen.shape[1])].assign(cell=numbered(seen, t).ravel())

    q_kind, c_kind = dict(q.dtypes), dict(c.dtypes)
    return (
        settle(q.mapInPandas(of_queries, f"query_id {q_kind['query_id']}, v {q_kind['v']}, cell long")),
        settle(c.mapInPandas(of_faces, f"face_id {c_kind['face_id']}, v {c_kind['v']}, cell long")),
    )


def hash_grid_is_cheaper(plan: HashPlan, queries: int, faces: int, grid: tuple[int, int], group_rows: int) -> bool:
    """Whether all pairs, in a ``grid`` of (blocks of faces, parts of queries), cost less than the buckets of
    all tables, whose rows are repeated where a bucket is cut into groups."""
    buckets = 1 << plan.bits
    seen, placed = queries * plan.tables * plan.probes, faces * plan.tables
    parts, blocks = (max(1, math.ceil(n / buckets / group_rows)) for n in (queries * plan.probes, faces))
    by_cells = seen * faces // buckets + MOVE * (seen * blocks + placed * parts)
    return queries * faces + MOVE * (queries * grid[0] + faces * grid[1]) <= by_cells


# --- searching cells ----------------------------------------------------------------------------


def dealt(queries: DataFrame, faces: DataFrame, group_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``part`` and ``block``: a cell above ``group_rows`` on a side is cut by a hash of
    its rows, and every part of its queries meets every block of its faces."""

    def cut(df: DataFrame, name: str) -> DataFrame:
        pieces = F.ceil(F.col("n") / F.lit(group_rows)).cast("int")
        return df.groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") > group_rows).select("cell", pieces.alias(name))

    large = settle(cut(queries, "_parts").join(cut(faces, "_blocks"), "cell", "full"))

    def placed(df: DataFrame, key: str, own: str, own_count: str, other: str, other_count: str) -> DataFrame:
        one = F.lit(1)
        known = lookup_join(df, large, "cell", [key])
        return known.withColumn(own, F.pmod(F.xxhash64(key), F.coalesce(own_count, one)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.coalesce(other_count, one) - 1))
        ).drop("_parts", "_blocks")

    return (
        placed(queries, "query_id", "part", "_parts", "block", "_blocks"),
        placed(faces, "face_id", "block", "_blocks", "part", "_parts"),
    )
