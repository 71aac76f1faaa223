"""Exact k nearest neighbours of many points at once, without forming all pairs.

Copies of a point collapse first: no query needs more than k of them. The distinct points are cut
into cells by a tree of pivot values, each of which halves the widest column of what it cuts, so that
the boxes of the cells do not overlap. Each query searches its own cell, which bounds how far its
neighbours can be, and then visits only the cells whose bounding box can still hold a nearer one. Inside
a cell the points lie in small boxes; products of matrices tell which of a box's points are near enough to
count their distances. Equal distances are ordered by id.

With ``groups`` the search is keyed: rows meet only rows of the same group, and one search serves all
groups, each cut into cells by the same pivots.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.ranking import stable_hash
from ledgerlens.session import materialise

# Distinct points aimed at per cell; more points make more cells, up to ``MOST_CELLS``, then larger
# ones, which are searched in blocks. Pivots and boxes of all cells go out with every task.
CELL_ROWS = 5_000
MOST_CELLS = 16_384
# Vectors drawn for each cell, from which the pivots are taken.
CELL_SAMPLE = 16
# Queries of a cell that one task searches for and points that it searches, and queries that it takes at
# once. A usual cell is one block of each, as every block of points goes out with every block of queries.
QUERY_ROWS = 20_000
HELD_ROWS = 40_000
STEP_ROWS = 5_000
# Points of the smallest boxes.
LEAF_ROWS = 128
# Tasks for each core that searches: a cell is few bytes and much work, so parts are not merged by their size.
PARTS_PER_CORE = 8
# What rounding may add to a distance taken by products, as a share of the squares in it.
ROUNDING = 1e-12
# Rounding must never hide a point: bounds get a relative margin.
MARGIN = 1 + 1e-9


def _vector(features: list[str]):
    return F.array(*[F.col(f"`{c}`").cast("double") for c in features])


def group_key(groups: list[str]):
    """One column for the group; it is written with the rows, so that joins have a real key."""
    return F.to_json(F.struct(*[F.col(g) for g in groups])) if groups else F.lit("")


def _thin_copies(points: DataFrame, copies: int) -> DataFrame:
    """At most ``copies`` smallest ids of each distinct vector; map tasks already drop the rest."""
    # Rows are sorted by a number first: vectors are compared only where it is the same.
    by_vector = Window.partitionBy("_hash", "g", "vec").orderBy("id")
    return points.withColumn("_hash", F.xxhash64("g", "vec")).withColumn("_rn", F.row_number().over(by_vector)).where(
        F.col("_rn") <= copies
    ).drop("_rn", "_hash")


# --- boxes of a cell's points --------------------------------------------------------------------

def box_gaps(points: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distance from every point to every box."""
    gaps = np.zeros((len(points), len(lo)))
    for j in range(points.shape[1]):
        x = points[:, j, None]
        gaps += np.maximum(np.maximum(lo[None, :, j] - x, x - hi[None, :, j]), 0.0) ** 2
    return gaps


class Leaves:
    """Points, in order of their ids, in small boxes: halved at the middle of their widest column. ``columns``
    are those by which a point is first told to be too far."""

    def __init__(self, points: np.ndarray, columns: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.points, self.columns, self.first = points, columns, points[:, columns]
        self.norm = (self.first ** 2).sum(axis=1)
        self.rows, todo = [], [np.arange(len(points))] if len(points) else []
        while todo:
            rows = todo.pop()
            x = points[rows]
            lo, hi = x.min(axis=0), x.max(axis=0)
            j = int((hi - lo).argmax())
            left = x[:, j] <= lo[j] + (hi[j] - lo[j]) / 2
            if len(rows) <= leaf_rows or left.all():
                self.rows.append(rows)
            else:
                todo += [rows[left], rows[~left]]
        self.lo = np.array([points[r].min(axis=0) for r in self.rows])
        self.hi = np.array([points[r].max(axis=0) for r in self.rows])

    def search(self, asked: np.ndarray, limit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """``(d2, row)`` of the k nearest points of every query that are not beyond its limit, nearest
        first (infinite where there are fewer), and how many pairs were looked at."""
        best = np.full((len(asked), k), np.inf)
        rows = np.full((len(asked), k), len(self.points))
        if not self.rows or not len(asked):
            return best, rows, 0
        kth, first = limit.copy(), asked[:, self.columns]
        norm = (first ** 2).sum(axis=1)
        bounds = box_gaps(asked, self.lo, self.hi)
        touched = 0

        def visit(leaf: int, who: np.ndarray) -> None:
            nonlocal touched
            held = self.rows[leaf]
            touched += len(who) * len(held)
            x, p = asked[who], self.points[held]
            # Near the distance, but for rounding; what is told apart by it is measured again.
            part = norm[who, None] + self.norm[held] - 2.0 * (first[who] @ self.first[held].T)
            slack = ROUNDING * (norm[who] + self.norm[held].max())
            q, at = np.nonzero(~(part > (kth[who] * MARGIN + slack)[:, None]))
            if not len(q):
                return
            # In the order of the columns: equal distances stay equal.
            d2 = np.zeros(len(q))
            for j in range(x.shape[1]):
                d2 += (x[q, j] - p[at, j]) ** 2
            near = d2 <= kth[who[q]] * MARGIN
            q, at, d2 = q[near], at[near], d2[near]
            if not len(q):
                return
            full = np.full(part.shape, np.inf)
            full[q, at] = d2
            some = np.unique(q)
            who, full = who[some], full[some]
            near = np.concatenate([best[who], full], axis=1)
            which = np.concatenate([rows[who], np.broadcast_to(held, full.shape)], axis=1)
            order = np.lexsort((which, near), axis=1)[:, :k]
            best[who] = np.take_along_axis(near, order, axis=1)
            rows[who] = np.take_along_axis(which, order, axis=1)
            kth[who] = np.minimum(kth[who], best[who, -1])

        # The nearest boxes first, which bound the rest; then each box with all that still need it.
        seen = np.zeros(bounds.shape, dtype=bool)
        rounds = min(2, len(self.rows))
        nearest = np.argsort(bounds, axis=1, kind="stable")[:, :rounds]
        everyone = np.arange(len(asked))
        for r in range(rounds):
            seen[everyone, nearest[:, r]] = True
            order = np.argsort(nearest[:, r], kind="stable")
            leaves, start = np.unique(nearest[order, r], return_index=True)
            for leaf, who in zip(leaves.tolist(), np.split(order, start[1:])):
                who = who[bounds[who, leaf] <= kth[who] * MARGIN]
                if len(who):
                    visit(leaf, who)
        for leaf in np.argsort(bounds.min(axis=0), kind="stable").tolist():
            who = np.flatnonzero((bounds[:, leaf] <= kth * MARGIN) & ~seen[:, leaf])
            if len(who):
                visit(leaf, who)
        rows[~(best <= (limit * MARGIN)[:, None])] = len(self.points)
        best[rows == len(self.points)] = np.inf
        return best, rows, touched


# --- cells ---------------------------------------------------------------------------------------

class Pivots:
    """A tree of pivot values, each in the middle of the widest column of the vectors it parts; its leaves
    are the cells. One cell where there are no vectors.

    The part with the most vectors is parted next. The parts there are when they number the root of the
    cells are the upper ones; the cells of an upper part follow one another.
    """

    def __init__(self, sample: np.ndarray, cells: int):
        # By node: column, pivot, and the first of its two children, which is negative in a leaf.
        column, cut, child = [0], [0.0], [-1]
        open_parts, closed = ([(-len(sample), 0, np.arange(len(sample)))], []) if len(sample) else ([], [0])
        wanted, upper = math.ceil(math.sqrt(cells)), None
        while open_parts and len(open_parts) + len(closed) < cells:
            if upper is None and len(open_parts) + len(closed) >= wanted:
                upper = closed + [part[1] for part in open_parts]
            _, node, rows = heapq.heappop(open_parts)
            x = sample[rows]
            lo, hi = x.min(axis=0), x.max(axis=0)
            j = int((hi - lo).argmax())
            middle = lo[j] / 2 + hi[j] / 2
            left = x[:, j] <= middle
            if left.all() or not left.any():
                closed.append(node)
                continue
            column[node], cut[node], child[node] = j, float(middle), len(child)
            for side in (rows[left], rows[~left]):
                heapq.heappush(open_parts, (-len(side), len(child), side))
                column.append(0), cut.append(0.0), child.append(-1)
        self.upper = sorted(upper or closed + [part[1] for part in open_parts])
        self.column, self.cut, self.child = np.array(column), np.array(cut), np.array(child)
        # Leaves are numbered below one upper part after the other.
        self.number, of = np.zeros(len(child), dtype=int), []
        for i, top in enumerate(self.upper):
            todo = [top]
            while todo:
                node = todo.pop()
                if child[node] >= 0:
                    todo += [child[node], child[node] + 1]
                else:
                    self.number[node] = len(of)
                    of.append(i)
        self._upper_of_cells = np.array(of)
        self.cells = len(of)

    def cell_of(self, x: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(x), dtype=int), np.arange(len(x))
        while len(rows := rows[self.child[at[rows]] >= 0]):
            node = at[rows]
            at[rows] = self.child[node] + (x[rows, self.column[node]] > self.cut[node])
        return self.number[at]

    def upper_of_cells(self) -> np.ndarray:
        return self._upper_of_cells


def _pivots(points: DataFrame, n: int, groups: int, cell_rows: int) -> Pivots:
    """Pivots in a repeatable order, from ``CELL_SAMPLE`` sampled vectors for each cell. All groups have the
    same cells, each group its own points in them, so a group's mean size tells their number."""
    groups = max(groups, 1)
    cells = min(math.ceil(n / groups / cell_rows), max(1, MOST_CELLS // groups))
    if cells <= 1:
        return Pivots(np.zeros((0, 0)), 1)
    text = F.concat_ws(",", F.transform("vec", lambda x: x.cast("string")))
    rows = points.select("vec").distinct().orderBy(stable_hash(text, "pivot"), "vec").limit(CELL_SAMPLE * cells).collect()
    return Pivots(np.array([r.vec for r in rows], dtype=float), cells)


def _assign_cells(df: DataFrame, pivots: Pivots) -> DataFrame:
    """Adds ``cell``."""
    schema = T.StructType([*df.schema.fields, T.StructField("cell", T.IntegerType())])

    def assign(frames):
        for frame in frames:
            if len(frame):
                x = np.stack(frame["vec"].to_numpy())
                yield frame.assign(cell=pivots.cell_of(x).astype("int32"))

    return df.mapInPandas(assign, schema)


def _search(queries: DataFrame, points: DataFrame, k: int, width: int, kept: list[str]) -> DataFrame:
    """The k nearest points of the same cell, not beyond ``worst``, for every (g, cell, query) row, with the
    columns of the points that are ``kept``."""
    schema = T.StructType(
        [
            T.StructField("qkey", T.LongType()),
            T.StructField("d2", T.DoubleType()),
            *[points.schema[c] for c in kept],
        ]
    )

    def search(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or held.empty:
            return pd.DataFrame(columns=schema.names, dtype=object)
        held = held.sort_values("id", kind="stable").reset_index(drop=True)
        leaves = Leaves(np.stack(held["vec"].to_numpy()), np.arange(width))
        found = []
        for at in range(0, len(asked), STEP_ROWS):
            part = asked.iloc[at : at + STEP_ROWS]
            limit = part["worst"].to_numpy(dtype=float)
            d2, row, _ = leaves.search(
                np.stack(part["vec"].to_numpy()), np.where(np.isnan(limit), np.inf, limit), min(k, len(held)))
            q, place = np.nonzero(row < len(held))
            found.append((part["qkey"].to_numpy()[q], d2[q, place], row[q, place]))
        row = np.concatenate([f[2] for f in found])
        return pd.DataFrame(
            {
                "qkey": np.concatenate([f[0] for f in found]),
                "d2": np.concatenate([f[1] for f in found]),
                **{c: held[c].to_numpy()[row] for c in kept},
            }
        )

    # A cell with many queries or points is searched in many tasks: each of its blocks of queries meets
    # each of its blocks of points, and the best of all are picked afterwards.
    sizes = queries.groupBy("g", "cell").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("asked_in")).join(
        points.groupBy("g", "cell").agg(F.ceil(F.count("*") / HELD_ROWS).cast("int").alias("held_in")),
        ["g", "cell"],
    )
    sizes = materialise(sizes, "knn-sizes")

    def blocks(side: DataFrame, key: str, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64(key), F.col(own)).cast("int")
        others = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return side.join(sizes, ["g", "cell"]).withColumn(own, mine).withColumn(other, others)

    place = ("g", "cell", "asked_in", "held_in")
    spark = queries.sparkSession
    # No more parts than there are blocks, and as many as shuffles have where that is more than the cores need.
    n = sizes.agg(F.sum(F.col("asked_in") * F.col("held_in"))).first()[0] or 1
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = min(n, max(shuffled, PARTS_PER_CORE * spark.sparkContext.defaultParallelism))
    asked = blocks(queries.select("g", "cell", "qkey", "vec", "worst"), "qkey", "asked_in", "held_in")
    held = blocks(points.select("g", "cell", "id", "label", "vec"), "id", "held_in", "asked_in")
    asked, held = (side.repartition(n, *place).groupBy(*place) for side in (asked, held))
    return asked.cogroup(held).applyInPandas(search, schema)


def _boxes(held: DataFrame, width: int, pivots: Pivots) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """For every group the corners of each cell's box; empty cells have no box (infinite corners)."""
    corners = held.groupBy("g", "cell").agg(
        F.array(*[F.min(F.col("vec")[j]) for j in range(width)]).alias("lo"),
        F.array(*[F.max(F.col("vec")[j]) for j in range(width)]).alias("hi"),
    )
    out: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for g, cell, lo, hi in corners.collect():  # at most MOST_CELLS rows
        if g not in out:
            out[g] = tuple(np.full((pivots.cells, width), np.inf) for _ in range(2))
        out[g][0][cell], out[g][1][cell] = lo, hi
    return out


def _visits(bounded: DataFrame, pivots: Pivots, boxes: dict[str, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Other cells each query has to look into, given what its own cell offered."""
    upper = pivots.upper_of_cells()

    def open_cells(x: np.ndarray, worst: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        """Pairs (query, cell): first the boxes of the upper pivots, then those of their cells."""
        for u in np.unique(upper):
            cells = np.flatnonzero((upper == u) & np.isfinite(lo[:, 0]))
            if not len(cells):
                continue
            whole = box_gaps(x, lo[cells].min(axis=0)[None, :], hi[cells].max(axis=0)[None, :])[:, 0]
            some = np.flatnonzero(whole <= worst * MARGIN)
            if len(some):
                q, c = np.nonzero(box_gaps(x[some], lo[cells], hi[cells]) <= worst[some, None] * MARGIN)
                yield some[q], cells[c]

    def visit(frames):
        for frame in frames:
            for g, rows in frame.groupby("g"):
                if g not in boxes:
                    continue
                for at in range(0, len(rows), STEP_ROWS):
                    part = rows.iloc[at : at + STEP_ROWS]
                    limit = part["worst"].to_numpy(dtype=float)
                    limit = np.where(np.isnan(limit), np.inf, limit)
                    home = part["cell"].to_numpy()
                    for q, cell in open_cells(np.stack(part["vec"].to_numpy()), limit, *boxes[g]):
                        q, cell = q[cell != home[q]], cell[cell != home[q]]
                        yield pd.DataFrame(
                            {
                                "g": g,
                                "qkey": part["qkey"].to_numpy()[q],
                                "vec": part["vec"].to_numpy()[q],
                                "worst": part["worst"].to_numpy()[q],
                                "cell": cell.astype("int32"),
                            }
                        )

    return bounded.mapInPandas(visit, "g string, qkey long, vec array<double>, worst double, cell int")


def nearest_neighbours(
    queries: DataFrame, points: DataFrame, features: list[str], k: int,
    exclude_self: bool = False, cell_rows: int = CELL_ROWS, groups: list[str] | None = None,
    vectors: bool = True,
) -> DataFrame:
    """Adds ``neighbours`` to the queries: array of (d2, id, label, vec), nearest first; without ``vectors``,
    which are most of what is moved, of (d2, id, label).

    Both sides have ``id``, the feature columns and the ``groups``, the points also ``label``; only
    points of the query's own group count. With ``exclude_self`` a point of the query's own id does not.
    """
    groups = groups or []
    want = k + 1 if exclude_self else k
    kept = ["id", "label", "vec"] if vectors else ["id", "label"]
    keyed = queries.withColumn("_g", group_key(groups)).withColumn("_vec", _vector(features))
    held = _thin_copies(
        points.select(
            group_key(groups).alias("g"), "id", F.col("label").cast("int").alias("label"),
            _vector(features).alias("vec")),
        want)
    held = materialise(held, "knn-points")
    n, n_groups = held.agg(F.count(F.lit(1)), F.count_distinct("g")).first()
    pivots = _pivots(held, n, n_groups, cell_rows)
    asked = keyed.select(F.col("_g").alias("g"), F.col("_vec").alias("vec")).distinct().withColumn(
        "qkey", F.monotonically_increasing_id()
    )
    # Written once, so that the generated keys stay what they are.
    asked = materialise(_assign_cells(asked, pivots), "knn-queries")
    held = materialise(_assign_cells(held, pivots), "knn-cells")
    found = _search(asked.withColumn("worst", F.lit(None).cast("double")), held, want, len(features), kept)
    if pivots.cells > 1:
        found = materialise(found, "knn-own")
        bound = found.groupBy("qkey").agg(F.count(F.lit(1)).alias("n"), F.max("d2").alias("d2"))
        bounded = asked.join(bound, "qkey", "left").select(
            "g", "qkey", "vec", "cell", F.when(F.col("n") >= want, F.col("d2")).alias("worst"))
        visits = _visits(bounded, pivots, _boxes(held, len(features), pivots))
        found = found.unionByName(_search(visits, held, want, len(features), kept))
    best = Window.partitionBy("qkey").orderBy("d2", "id")
    ranked = found.withColumn("_rn", F.row_number().over(best)).where(F.col("_rn") <= want)
    lists = ranked.groupBy("qkey").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_rn", "d2", *kept))),
            lambda x: F.struct(x["d2"], *[x[c] for c in kept]),
        ).alias("neighbours")
    )
    by_vector = asked.select(
        "qkey", F.xxhash64("g", "vec").alias("_qhash"), F.col("g").alias("_qg"), F.col("vec").alias("_qvec")).join(lists, "qkey")
    same = (F.col("_hash") == F.col("_qhash")) & (F.col("_g") == F.col("_qg")) & (F.col("_vec") == F.col("_qvec"))
    hashed = keyed.withColumn("_hash", F.xxhash64("_g", "_vec"))
    joined = hashed.join(by_vector, same, "left").drop("qkey", "_hash", "_g", "_vec", "_qhash", "_qg", "_qvec")
    if not exclude_self:
        return joined
    others = F.filter("neighbours", lambda x: x["id"] != F.col("id"))
    return joined.withColumn("neighbours", F.slice(others, 1, k))


def knn_classify(
    train: DataFrame, test: DataFrame, features: list[str], k: int = 5, cell_rows: int = CELL_ROWS,
    groups: list[str] | None = None,
) -> DataFrame:
    """Adds ``score`` (share of positive neighbours) and ``prediction`` to the test rows."""
    found = nearest_neighbours(test, train, features, k, cell_rows=cell_rows, groups=groups, vectors=False)
    votes = F.aggregate("neighbours", F.lit(0.0), lambda total, x: total + x["label"])
    return (
        found.withColumn("score", votes / F.size("neighbours"))
        .withColumn("prediction", (F.col("score") > 0.5).cast("double"))
        .drop("neighbours")
    )
