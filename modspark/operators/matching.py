"""Jobs to notices, and faces to faces."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modspark.operators import face_index as I
from modspark.operators.joins import lookup_join
from modspark.workers import ship_library

# Query faces are sent to every task as one matrix up to this many rows and numbers (64 MB).
QUERY_LIMIT = 20_000
QUERY_NUMBERS = 8_000_000
BLOCK_ROWS = 20_000
# What a task holds at once: numbers of vectors of a side, and finds.  Similarities of a product (8 MB), pairs checked exactly.
GROUP_NUMBERS, GROUP_FINDS = 2_000_000, 4_000_000
PRODUCT, CHECKED = 2_000_000, 65_536
# Numbers of the vectors or buckets of pairs that are checked together where pairs pass by.
CACHED = 262_144
# Products of 32 bits pass a pair that is less than this below the floor; it is then compared in 64 bits.
SLACK = 1e-4


def match_jobs(
    jobs: DataFrame, notices: DataFrame, how: str = "inner", on: str = "job_id",
    spread_by: Sequence[str] = (), salts: int = 16,
) -> DataFrame:
    """Notices of submitted jobs.  ``jobs`` has one row per job; a job may have any number of
    notices, so the notices are spread when the jobs are too many to broadcast."""
    return lookup_join(notices, jobs, on, list(spread_by) or notices.columns, how, salts)


def unmatched_notices(jobs: DataFrame, notices: DataFrame, on: str = "job_id",
                      spread_by: Sequence[str] = (), salts: int = 16) -> DataFrame:
    """Notices without a submitted job: the dead-letter frame."""
    known = jobs.select(on).distinct()
    return lookup_join(notices, known, on, list(spread_by) or notices.columns, "left_anti", salts)


def face_search(
    query: DataFrame,
    collection: DataFrame,
    min_similarity: float = 0.8,
    k: int = 5,
    id_col: str = "face_id",
    vector: str = "embedding",
    exclude_self: bool = False,
    query_limit: int = QUERY_LIMIT,
    pivots: int | None = None,
    block_rows: int = BLOCK_ROWS,
    approximate: bool = False,
    recall: float = 0.95,
    hash_bits: int | None = None,
) -> DataFrame:
    """The ``k`` most similar faces at or above ``min_similarity`` (cosine) per query face.

    Result: (query_id, face_id, similarity, rank); equal similarities (6 digits) rank by face id.

    Exact by default.  Up to ``query_limit`` query faces are sent to all tasks and the collection is
    read once.  More of them meet only the leaves of a pivot tree that the triangle inequality of
    angles leaves possible; ``pivots`` sets the number of leaves, by default the root of the
    collection's rows.  Unless ``pivots`` is set, queries that would meet most leaves are instead compared
    with all faces in a grid of groups, which moves fewer rows.  ``block_rows`` bounds the faces of one matrix
    product.  With ``approximate`` both sides are hashed by random directions into as many
    tables as a pair at the floor needs to meet with a chance of ``recall`` (more similar pairs meet
    more surely); similarities of what is found are exact.  ``hash_bits`` fixes the directions of a table.
    Tables of few and large buckets are not written out: groups of both sides meet in a grid and a pair
    is found once if any table has it, the same pairs with fewer rows moved.

    In all plans a task keeps at most k faces per query before the shuffle, and no pair below the
    floor is ever emitted.  A missing vector matches nothing.
    """
    q, c, schema = _sides(query, collection, id_col, vector)
    width = q.select(F.size("v")).head()
    numbers = width[0] if width else 1
    if approximate:
        rows, queries = c.count(), q.count() if width else 0
        cells, group_rows = None, _group_rows(numbers, k)
        if queries and rows:
            plan, grid = I.hash_plan(rows, min_similarity, recall, hash_bits), _grid(c, queries, rows, numbers)
            if I.hash_grid_is_cheaper(plan, queries, rows, grid, group_rows):
                found = _search_grid(q, c, schema, plan, grid, min_similarity, k, exclude_self, numbers)
                if _repeats(q, "query_id") or _repeats(c, "face_id"):
                    found = _once(found)
                return _best(found, k if k < rows else None)
            cells = I.hash_cells(q, c, plan, numbers)
        # A pair may meet in several tables.
        return _best(_once(_search_cells(cells, c, schema, min_similarity, k, exclude_self, block_rows, numbers)), k)
    rows = min(query_limit, QUERY_NUMBERS // max(1, numbers))
    head = q.limit(rows + 1).toArrow().to_pandas()
    if len(head) <= rows:
        return _best(_search_broadcast(head, c, schema, min_similarity, k, exclude_self, block_rows), k)
    plan = I.tree_plan(q, c, min_similarity, pivots, numbers)
    cells = None
    if plan is not None:
        everything = pivots is None and I.grid_is_cheaper(plan, _group_rows(numbers, k))
        one = F.lit(0).cast("long").alias("cell")
        cells = (q.select("*", one), c.select("*", one)) if everything else (plan.visits(), plan.placed)
    return _best(_search_cells(cells, c, schema, min_similarity, k, exclude_self, block_rows, numbers), k)


def face_search_cost(
    query: DataFrame, collection: DataFrame, min_similarity: float = 0.8, id_col: str = "face_id",
    vector: str = "embedding", pivots: int | None = None,
) -> DataFrame:
    """What the exact search of two large sides would do, without doing it: one row with the faces,
    queries and leaves, and the leaves, faces and share of all faces that a query meets on average."""
    q, c, _ = _sides(query, collection, id_col, vector)
    width = q.select(F.size("v")).head()
    plan = I.tree_plan(q, c, min_similarity, pivots, width[0]) if width else None
    if plan is None:
        names = "faces long, queries long, leaves long, leaves_per_query double, faces_per_query double, share double"
        return c.sparkSession.createDataFrame([], names)
    return I.search_cost(plan)


def _sides(query: DataFrame, collection: DataFrame, id_col: str, vector: str) -> tuple[DataFrame, DataFrame, str]:
    ship_library(collection.sparkSession)
    known = F.col(vector).isNotNull()
    q = query.filter(known).select(F.col(id_col).alias("query_id"), F.col(vector).alias("v"))
    c = collection.filter(known).select(F.col(id_col).alias("face_id"), F.col(vector).alias("v"))
    return q, c, f"query_id {dict(q.dtypes)['query_id']}, face_id {dict(c.dtypes)['face_id']}, similarity double"


def _once(found: DataFrame) -> DataFrame:
    return found.groupBy("query_id", "face_id").agg(F.max("similarity").alias("similarity"))


def _repeats(df: DataFrame, key: str) -> bool:
    return bool(df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").limit(1).count())


def _best(found: DataFrame, k: int | None) -> DataFrame:
    """Ranked, the first ``k``; all with None, where no query has more: then only who reads ranks pays for them."""
    # At most k faces per query and task come together here.  They are sorted, not listed: a sort goes to
    # disk where lists would have to fit the memory, and a small k already cuts it before the shuffle.
    order = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), "face_id")
    ranked = found.withColumn("rank", F.row_number().over(order))
    if k is not None:
        ranked = ranked.filter(F.col("rank") <= k)
    return ranked.select("query_id", "face_id", "similarity", "rank")


def _group_rows(width: int, k: int) -> int:
    """Rows of a side that one task holds, so that their vectors and the at most k finds of each are bounded."""
    finds = max(GROUP_FINDS // max(1, k), math.isqrt(GROUP_FINDS))
    return max(1, min(GROUP_NUMBERS // max(1, width), finds))


def _products(q_unit: np.ndarray, c_unit: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """Products of pairs of rows, few enough at once that their vectors stay in the processor's cache."""
    out, step = np.empty(len(row)), max(1, CACHED // max(1, q_unit.shape[1]))
    for lo in range(0, len(row), step):
        at = slice(lo, lo + step)
        out[at] = np.einsum("ij,ij->i", q_unit.take(row[at], 0), c_unit.take(col[at], 0))
    return out


def _pair_finder(min_similarity: float, k: int, exclude_self: bool):
    """A function for inside tasks: the best k faces per query out of blocks of faces, one after the other."""

    def best(finds):
        ordered = finds.sort_values(["row", "similarity", "face_id"], ascending=[True, False, True])
        return ordered.groupby("row", sort=False).head(k)

    def find(q_ids, q_unit, blocks):
        import numpy as np
        import pandas as pd

        q_low = q_unit.astype("float32")
        # The lowest similarity that a query still wants: the floor, then that of its k-th face.
        least = np.full(len(q_ids), float(min_similarity))
        held = None
        for c_ids, c_unit in blocks:
            if not len(q_ids) or not len(c_ids):
                continue
            c_low = c_unit.astype("float32")
            finds = [] if held is None else [held]
            step = max(1, PRODUCT // len(c_ids))
            for lo in range(0, len(q_ids), step):
                near = q_low[lo : lo + step] @ c_low.T
                rows, cols = np.nonzero(near >= (least[lo : lo + step, None] - SLACK).astype("float32"))
                fresh = []
                for at in range(0, len(rows), CHECKED):
                    row, col = rows[at : at + CHECKED] + lo, cols[at : at + CHECKED]
                    # Rounded before the floor and the ranking, so that both agree with the result.
                    sim = np.round(_products(q_unit, c_unit, row, col), 6)
                    keep = sim >= least[row]
                    if exclude_self:
                        keep &= q_ids[row] != c_ids[col]
                    fresh.append(pd.DataFrame({"row": row[keep], "face_id": c_ids[col[keep]], "similarity": sim[keep]}))
                if fresh:
                    finds.append(best(pd.concat(fresh)))
            if finds:
                held = best(pd.concat(finds))
                full = held.groupby("row").similarity.agg(["size", "min"])
                full = full[full["size"] >= k]
                least[full.index.to_numpy()] = full["min"].to_numpy()
        if held is None:
            return pd.DataFrame({"query_id": q_ids[:0], "face_id": q_ids[:0], "similarity": np.empty(0)})
        return pd.DataFrame({"query_id": q_ids[held["row"].to_numpy()], "face_id": held["face_id"].to_numpy(),
                             "similarity": held["similarity"].to_numpy()})

    return find


def _search_broadcast(head, c, schema, min_similarity, k, exclude_self, block_rows) -> DataFrame:
    find, unit = _pair_finder(min_similarity, k, exclude_self), I.unit_rows
    shared = c.sparkSession.sparkContext.broadcast((head["query_id"].to_numpy(), unit(head["v"])))

    def scan(batches):
        ids, rows = shared.value
        blocks = (
            (batch["face_id"].to_numpy()[lo : lo + block_rows], unit(batch["v"].iloc[lo : lo + block_rows]))
            for batch in batches for lo in range(0, len(batch), block_rows)
        )
        yield find(ids, rows, blocks)

    return c.mapInPandas(scan, schema)


def _search_cells(cells, c, schema, min_similarity, k, exclude_self, block_rows, width) -> DataFrame:
    """Pairs out of ``(queries, faces)`` with cells: a task holds a group of a cell's queries and one of its faces."""
    if cells is None:
        return c.sparkSession.createDataFrame([], schema)
    find, unit = _pair_finder(min_similarity, k, exclude_self), I.unit_rows

    def pair(qs, cs):
        ids, rows = cs["face_id"].to_numpy(), unit(cs["v"])
        blocks = ((ids[lo : lo + block_rows], rows[lo : lo + block_rows]) for lo in range(0, len(ids), block_rows))
        return find(qs["query_id"].to_numpy(), unit(qs["v"]), blocks)

    keys, spark = ["cell", "block", "part"], c.sparkSession
    # Groups are small to move and long to search, so they are not put together by their bytes.
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    left, right = (side.repartition(tasks, *keys).groupBy(*keys) for side in I.dealt(*cells, _group_rows(width, k)))
    return left.cogroup(right).applyInPandas(pair, schema)


def _grid(c: DataFrame, queries: int, faces: int, width: int) -> tuple[int, int]:
    """Into how many blocks of faces, as many as a task holds, and parts of queries, which pass by, to cut."""
    side = math.isqrt(4 * c.sparkSession.sparkContext.defaultParallelism) + 1
    blocks = max(-(-faces // max(1, GROUP_NUMBERS // max(1, width))), min(side, faces))
    return blocks, min(side, queries)


def _search_grid(q, c, schema, plan, grid, min_similarity, k, exclude_self, width) -> DataFrame:
    """Pairs at the floor that any table of ``plan`` brings together, each once.  A task holds a block of faces and
    lets a part of the queries pass by, so finds are given out as they come and never add up."""
    blocks, parts = grid
    unit, tried = I.unit_rows, plan.tables * plan.probes

    def vectors(column):
        return unit(column.to_pandas())

    def finds(hashes, q_ids, q_unit, f_ids, f_unit, f_low, f_codes):
        seen, q_low = hashes.of_queries(q_unit), q_unit.astype("float32")
        least = np.float32(min_similarity - SLACK)
        q_values, f_values = (ids.to_numpy(zero_copy_only=False) for ids in (q_ids, f_ids))
        # Few enough pairs at once that their vectors stay in the processor's cache.
        step, checked = max(1, PRODUCT // len(f_low)), max(1, CACHED // max(width, tried))
        for lo in range(0, len(q_low), step):
            near = np.flatnonzero((q_low[lo : lo + step] @ f_low.T >= least).ravel())
            found = []
            for at in range(0, len(near), checked):
                row, col = np.divmod(near[at : at + checked], len(f_low))
                row += lo
                if exclude_self:
                    other = q_values[row] != f_values[col]
                    row, col = row[other], col[other]
                meet = (seen.take(row, 0) == f_codes.take(col, 0)[:, :, None]).any(axis=(1, 2))
                row, col = row[meet], col[meet]
                sim = np.round(_products(q_unit, f_unit, row, col), 6)
                keep = sim >= min_similarity
                found.append((row[keep], col[keep], sim[keep]))
            if not found:
                continue
            row, col, sim = (np.concatenate(x) for x in zip(*found, strict=True))
            if k < len(f_low):  # all that a query finds in this block is here
                table = pd.DataFrame({"row": row, "similarity": sim, "face_id": f_values[col], "at": np.arange(len(row))})
                table = table.sort_values(["row", "similarity", "face_id"], ascending=[True, False, True])
                at = table.groupby("row", sort=False).head(k)["at"].to_numpy()
                row, col, sim = row[at], col[at], sim[at]
            yield pa.RecordBatch.from_arrays(
                [q_ids.take(pa.array(row)), f_ids.take(pa.array(col)), pa.array(sim)],
                names=["query_id", "face_id", "similarity"],
            )

    def search(batches):
        hashes, cell, held, ready = I.Hashes(plan, width), None, [], None
        for batch in batches:
            cells, sides = np.asarray(batch.column("cell")), np.asarray(batch.column("side"))
            changes = np.flatnonzero((cells[1:] != cells[:-1]) | (sides[1:] != sides[:-1])) + 1
            edges = [0, *changes.tolist(), len(cells)]
            for begin, end in zip(edges[:-1], edges[1:], strict=True):
                if begin == end:
                    continue
                part = batch.slice(begin, end - begin)
                if cells[begin] != cell:
                    cell, held, ready = cells[begin], [], None
                if sides[begin] == 0:
                    held.append((part.column("face_id"), vectors(part.column("v"))))
                elif held:
                    if ready is None:
                        f_unit = np.concatenate([x[1] for x in held])
                        ids = pa.concat_arrays([x[0] for x in held])
                        ready = ids, f_unit, f_unit.astype("float32"), hashes.of_faces(f_unit)
                    yield from finds(hashes, part.column("query_id"), vectors(part.column("v")), *ready)

    def dealt(df, key, own, own_count, other, other_count):
        placed = df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(own_count))).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(other_count - 1)))
        )
        return placed.withColumn("cell", (F.col("block") * parts + F.col("part")).cast("long"))

    kinds = {"query_id": dict(q.dtypes)["query_id"], "face_id": dict(c.dtypes)["face_id"]}
    none = {name: F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()}
    kind = "array<double>" if "array<double>" in (dict(q.dtypes)["v"], dict(c.dtypes)["v"]) else dict(c.dtypes)["v"]
    v = F.col("v").cast(kind).alias("v")
    faces = dealt(c, "face_id", "block", blocks, "part", parts).select("cell", F.lit(0).alias("side"), none["query_id"], "face_id", v)
    seekers = dealt(q, "query_id", "part", parts, "block", blocks).select("cell", F.lit(1).alias("side"), "query_id", none["face_id"], v)
    return (
        faces.unionByName(seekers).repartition(blocks * parts, "cell").sortWithinPartitions("cell", "side")
        .mapInArrow(search, schema)
    )
