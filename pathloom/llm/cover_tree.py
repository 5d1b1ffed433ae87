"""Exact top-k inner products by dual-tree search over cover trees.

Vectors are dealt into cells around at most CELLS pivots (the vectors of the smallest hashes), so both
queries and data are indexed by the same top level; a cell of many vectors is split into blocks by hash,
so no block grows with the data.

First each query block meets the data blocks of its own cell, which gives every query a score that its
k-th best cannot fall below, and its block the worst of these. A query block then meets only data cells
whose bound, by centres and covering radii, reaches that worst score; the list of cells is bounded
by CELLS. Where two blocks meet, a cover tree is built over each, and pairs of nodes are visited from the
most promising on; a pair is pruned when

    q.p + |q| r_p + |p| r_q + r_q r_p

(centres q and p, covering radii r) is below the worst k-th score of the query node's queries. Scores are
integers, ties go to the smaller id, and a bound equal to the worst score prunes nothing.

Defined results: vectors that are null or hold a null or non-finite component take no part, nor do empty
ones; vectors of different lengths have no inner product, so each length is searched on its own; scaled components
and scores beyond 2 ** 62 count as that; rows of a query's own id are no candidates of it; other repeated
rows are candidates each; fewer candidates than k are all returned; of queries that repeat an id the smallest
vector counts; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathloom.llm.shared import map_arrow, written

TOP, SCALE, EVERY = 20, 64, 20
#: Cells at the top level, and vectors a block of data or of queries holds at most (on average).
CELLS, DATA_BLOCK, QUERY_BLOCK = 32, 4096, 1024
#: Stands for no score: below any score, and safe to negate.
NONE = -(1 << 63) + 1
#: The largest component and score, either sign.
MOST, MOST_SCORE = 1 << 62, 1 << 62
#: Vectors under a node that is not split further.
LEAF = 64


class CoverTree:
    """Nodes with a centre, a covering radius and the span of their vectors in `order`; children follow their parents.

    A node of radius r takes as children's centres vectors of it that are more than r / 2 from each
    other (farthest first), until they cover it by balls of r / 2 or are BRANCH; each vector goes to the
    nearest centre. So the radii fall level by level as in a cover tree, and every node holds its true
    covering radius.
    """

    BRANCH = 8

    def __init__(self, x: np.ndarray):
        self.x = x
        self.order = np.arange(len(x))
        self.centre: list[np.ndarray] = []
        self.radius: list[float] = []
        self.span: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        if len(x):
            self._node(0, len(x), x.mean(axis=0))
            todo = [0]
            while todo:
                node = todo.pop()
                made = self._split(node)
                self.children[node] = made
                todo += made

    def _node(self, i: int, j: int, centre: np.ndarray) -> int:
        d = self.x[self.order[i:j]] - centre
        self.centre.append(centre)
        self.radius.append(float(np.sqrt((d * d).sum(axis=1).max())))
        self.span.append((i, j))
        self.children.append([])
        return len(self.centre) - 1

    def _split(self, node: int) -> list[int]:
        (i, j), r = self.span[node], self.radius[node]
        if j - i <= LEAF or r == 0.0:
            return []
        members = self.x[self.order[i:j]]
        nearest = np.full(j - i, np.inf)
        owner = np.zeros(j - i, dtype=np.int64)
        pick, picks = int(((members - self.centre[node]) ** 2).sum(axis=1).argmax()), []
        while len(picks) < self.BRANCH:
            d = np.sqrt(((members - members[pick]) ** 2).sum(axis=1))
            owner[d < nearest] = len(picks)
            nearest = np.minimum(nearest, d)
            picks.append(pick)
            pick = int(nearest.argmax())
            if nearest[pick] <= r / 2:
                break
        if len(picks) < 2:
            return []
        by = np.argsort(owner, kind="stable")
        self.order[i:j] = self.order[i:j][by]
        cuts = i + np.searchsorted(owner[by], np.arange(len(picks) + 1))
        return [self._node(int(a), int(b), members[p].astype(np.float64)) for a, b, p in zip(cuts[:-1], cuts[1:], picks, strict=True) if b > a]


class Best:
    """The k best (score, smaller id first) of every query."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), NONE, dtype=np.int64)
        self.id = np.full((n, k), np.iinfo(np.int64).max, dtype=np.int64)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores (rows, candidates); candidates not to be counted have NONE."""
        some = np.flatnonzero((scores >= self.score[rows, -1][:, None]).any(axis=0))
        scores, ids = scores[:, some], ids[some]
        score = np.concatenate([self.score[rows], scores], axis=1)
        every = np.concatenate([self.id[rows], np.broadcast_to(ids, (len(rows), len(ids)))], axis=1)
        order = np.lexsort((every, -score), axis=1)[:, : self.k]
        self.score[rows], self.id[rows] = np.take_along_axis(score, order, axis=1), np.take_along_axis(every, order, axis=1)


def search(queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int = TOP) -> Best:
    """The k best of `data` for every query, where scores below a query's `floor` need not be found."""
    best = Best(len(queries), k)
    left, right = CoverTree(queries.astype(np.float64)), CoverTree(data.astype(np.float64))
    if not len(queries) or not len(data):
        return best
    norm_l, norm_r = np.array([np.sqrt(c @ c) for c in left.centre]), np.array([np.sqrt(c @ c) for c in right.centre])
    radius_l, radius_r = np.array(left.radius), np.array(right.radius)
    centre_r = np.array(right.centre)
    # Sums of 64-bit floats are exact below 2 ** 53, of 64-bit integers below 2 ** 61; beyond, Python's integers are.
    most = float(np.abs(queries).max()) * float(np.abs(data).max()) * queries.shape[1]
    kind = np.float64 if most < 2.0**53 else np.int64 if most < 2.0**60 else object
    q_of, d_of = queries.astype(kind), data.astype(kind)

    def worst(node: int) -> float:
        i, j = left.span[node]
        rows = left.order[i:j]
        return float(np.maximum(best.score[rows, -1], floor[rows]).min())

    def bound(a: int, nodes: np.ndarray) -> np.ndarray:
        reach = centre_r[nodes] @ left.centre[a] + norm_l[a] * radius_r[nodes] + norm_r[nodes] * radius_l[a] + radius_l[a] * radius_r[nodes]
        return np.maximum(reach + 1e-6 * (1 + np.abs(reach)), -MOST_SCORE)  # scores are no lower

    stack = [(float(bound(0, np.array([0]))[0]), 0, 0)]
    while stack:
        reach, a, b = stack.pop()
        if reach < worst(a):
            continue
        down_a, down_b = left.children[a], right.children[b]
        if not down_a and not down_b:
            rows, found = left.order[slice(*left.span[a])], right.order[slice(*right.span[b])]
            scores = q_of[rows] @ d_of[found].T
            scores = (np.clip(scores, -MOST_SCORE, MOST_SCORE) if kind is object else scores).astype(np.int64)
            scores[query_ids[rows][:, None] == ids[found][None, :]] = NONE
            best.add(rows, scores, ids[found])
            continue
        # The node of the larger radius is opened.
        if down_b and (not down_a or radius_r[b] >= radius_l[a]):
            reaches = bound(a, np.array(down_b))
            stack += [(float(reaches[i]), a, down_b[i]) for i in np.argsort(reaches)]
        else:
            reaches = [(float(bound(c, np.array([b]))[0]), c, b) for c in down_a]
            stack += sorted(reaches)
    return best


def quantised(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """id, v: floor(scale * x) of the vectors that take part."""
    x = F.transform(F.col(column), lambda e: e.cast("double"))
    sound = F.col(column).isNotNull() & (F.size(column) > 0) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    whole = lambda e: F.floor(F.greatest(F.least(e * scale, F.lit(float(MOST))), F.lit(-float(MOST)))).cast("long")
    return vectors.where(F.col(id_column).isNotNull() & F.coalesce(sound, F.lit(False))).select(F.col(id_column).alias("id"), F.transform(x, whole).alias("v"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def top_inner_products(vectors: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """query_id, rank, vec_id and score: the k best of `vectors` (id, v) for each of `queries` (id, v)."""
    vectors = written(vectors, "vectors")
    queries = written(queries.groupBy("id").agg(F.min("v").alias("v")), "queries")
    sizes = [r[0] for r in queries.select(F.size("v").alias("s")).distinct().orderBy("s").collect()]  # mostly one
    found = [_of_one_length(vectors, queries, size, k) for size in sizes]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return reduce(DataFrame.union, found)


def _of_one_length(vectors: DataFrame, queries: DataFrame, size: int, k: int) -> DataFrame:
    vectors, queries = vectors.where(F.size("v") == size), queries.where(F.size("v") == size)
    # At most CELLS rows, those of the smallest hashes.
    pivots = [r["v"] for r in vectors.select("v", F.xxhash64("id").alias("h")).orderBy("h", "v").limit(CELLS).collect()]
    centres = np.array(pivots, dtype=np.float64).reshape(-1, size)
    if not pivots:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def cells(df: DataFrame) -> DataFrame:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            norms = (centres**2).sum(axis=1)
            for batch in batches:
                x = _matrix(batch.column("v"), size)
                d = norms[None, :] - 2.0 * (x.astype(np.float64) @ centres.T)
                cell = d.argmin(axis=1)
                away = np.sqrt(((x - centres[cell]) ** 2).sum(axis=1))
                packed = pa.array([r.tobytes() for r in x], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(cell.astype(np.int32)), pa.array(away), packed], ["id", "cell", "away", "v"])

        return map_arrow(df, work, "id long, cell int, away double, v binary")

    def blocks(df: DataFrame, rows: int, name: str) -> tuple[DataFrame, dict[int, tuple[int, float]]]:
        """Vectors with their block, and by cell its number of blocks and covering radius (at most CELLS rows)."""
        placed = written(cells(df), name)
        known = {r["cell"]: (max(1, -(-r["n"] // rows)), r["r"]) for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("r")).collect()}
        counts = F.create_map(*[x for c, (n, _) in known.items() for x in (F.lit(c), F.lit(n))]) if known else F.create_map(F.lit(0), F.lit(1))
        return placed.withColumn("block", F.pmod(F.xxhash64("id"), F.element_at(counts, F.col("cell"))).cast("int")), known

    data, data_cells = blocks(vectors, DATA_BLOCK, "data-cells")
    asked, asked_cells = blocks(queries, QUERY_BLOCK, "query-cells")

    def meet(pairs: list[tuple[int, int]], floors: DataFrame | None) -> DataFrame:
        """Scores of the queries of a cell against the data of another, for pairs of cells; a pair of blocks is a group."""
        of_query = F.create_map(*[x for a in sorted({a for a, _ in pairs}) for x in (F.lit(a), F.array(*[F.lit(b) for c, b in pairs if c == a]))])
        of_data = F.create_map(*[x for b in sorted({b for _, b in pairs}) for x in (F.lit(b), F.array(*[F.lit(a) for a, c in pairs if c == b]))])
        data_blocks = F.create_map(*[x for c, (n, _) in data_cells.items() for x in (F.lit(c), F.lit(n))])
        query_blocks = F.create_map(*[x for c, (n, _) in asked_cells.items() for x in (F.lit(c), F.lit(n))])
        q = asked if floors is None else asked.join(floors, "id", "left")
        q = q.withColumn("floor", F.lit(NONE) if floors is None else F.coalesce("floor", F.lit(NONE)))
        q = q.select("id", "floor", "v", F.col("cell").alias("a"), F.col("block").alias("i"), F.explode(F.element_at(of_query, F.col("cell"))).alias("b"))
        q = q.select("*", F.explode(F.sequence(F.lit(0), F.element_at(data_blocks, F.col("b")) - 1)).alias("j"))
        d = data.select("id", "v", F.col("cell").alias("b"), F.col("block").alias("j"), F.explode(F.element_at(of_data, F.col("cell"))).alias("a"))
        d = d.select("*", F.explode(F.sequence(F.lit(0), F.element_at(query_blocks, F.col("a")) - 1)).alias("i"))
        key = ["a", "i", "b", "j"]

        def work(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
            if not len(q) or not len(d):
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
            x, y = (np.frombuffer(b"".join(f["v"]), dtype=np.int64).reshape(-1, size) for f in (q, d))
            ids = q["id"].to_numpy()
            best = search(x, ids, q["floor"].to_numpy(), y, d["id"].to_numpy(), k)
            row, place = np.nonzero(best.score >= np.maximum(q["floor"].to_numpy(), NONE + 1)[:, None])
            return pd.DataFrame({"query_id": ids[row], "vec_id": best.id[row, place], "score": best.score[row, place]})

        return q.groupBy(*key).cogroup(d.groupBy(*key)).applyInPandas(work, "query_id long, vec_id long, score long")

    def bounds(a: int, b: int) -> float:
        q, p, rq, rp = centres[a], centres[b], asked_cells[a][1], data_cells[b][1]
        reach = float(q @ p + np.sqrt(q @ q) * rp + np.sqrt(p @ p) * rq + rq * rp)
        return max(reach + 1e-6 * (1 + abs(reach)), -MOST_SCORE)

    first = [(a, a) for a in asked_cells if a in data_cells]
    found = None
    floors = {}
    if first:
        found = written(meet(first, None), "own-cell-scores")
        order = F.struct((-F.col("score")).alias("s"), "vec_id")
        ranked = found.groupBy("query_id").agg(F.sort_array(F.collect_list(order)).alias("best"))  # a few times k rows
        floor = ranked.select(F.col("query_id").alias("id"), F.when(F.size("best") >= k, -F.element_at("best", k)["s"]).otherwise(F.lit(NONE)).alias("floor"))
        known = asked.select("id", "cell").join(floor, "id", "left").select("id", "cell", F.coalesce("floor", F.lit(NONE)).alias("floor"))
        floor = written(known, "floors")
        floors = {r["cell"]: r["w"] for r in floor.groupBy("cell").agg(F.min("floor").alias("w")).collect()}  # at most CELLS rows
    rest = [(a, b) for a in asked_cells for b in data_cells if a != b and bounds(a, b) >= floors.get(a, NONE)]
    results = [found] if found is not None else []
    if rest:
        results.append(meet(rest, floor.select("id", "floor") if first else None))
    if not results:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    every = results[0] if len(results) == 1 else results[0].union(results[1])
    order = F.struct((-F.col("score")).alias("s"), "vec_id")
    best = every.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(order)), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("rank", "b")).select("query_id", (F.col("rank") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score"))
