"""Nearest neighbours by vantage-point trees, one per shard.

A top vantage tree, fitted on a bounded sample, deals rows to cells; a cell's rows are cut into shards by id,
and every shard builds a tree: a node measures its points' distances to a vantage point and splits them at
the median, remembering the range of distances on either side. A search skips a side if the triangle
inequality, its bound multiplied by `factor`, says that nothing there is near enough. Factor one is exact;
larger factors skip more and may miss neighbours.

The measure is the largest inner product. Inside a shard every vector gets one more coordinate that gives
all the same length (zero for queries), which turns it into Euclidean distance, a metric. Scores returned
are inner products of the original vectors in double precision, summed in order.

Across cells the same inequality decides: no product in a cell is above that with its centre plus the query's
length times the cell's radius, which is taken over all its rows. A query first searches the cell whose centre
has the largest product with it, and then, with the k-th best score from there, those cells only whose
bound reaches it. The radius is divided by `factor` there, but by CELL_FACTOR at most.

Scale: a shard has about SHARD_ROWS rows and a block about BLOCK_ROWS queries, however many there are; a
shard's tree and a block of the queries that visit its cell are searched by a task, which returns the block's
best in that shard. A cell of any size is dealt over as many shards as it needs. The best of all shards come
from a top-k per query that is cut down before its shuffle. Equal vectors are one point of a tree with
their smallest ids, so a vector that a third of all rows share costs one point of each shard. The driver holds
samples and centres of the WIDTHS most frequent lengths of vectors, of SAMPLE_BYTES each; vectors of other
lengths are one cell.

Edge cases: rows without id, and vectors that are NULL, zero or hold NULL or non-finite numbers take no part;
vectors are compared with those of the same length only; an id on several rows counts once, with its
smallest vector; ties go to the smaller id; a query with fewer candidates than k returns all; an empty
table gives no rows.
"""

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.support import broadcast_if_small, written

SHARD_ROWS = 8192
BLOCK_ROWS = 4096
LEAF = 256
SPARE = 8  # candidates beyond k that are kept until exact scores decide
FACTOR = 3.0
CELL_FACTOR = 1.25  # the most that a cell's radius is divided by
WIDTHS = 8  # lengths of vectors that get a top tree
SAMPLE_ROWS = 4096  # about, of each such length
SAMPLE_BYTES = 32 << 20
MOST_CELLS = 1024
BROADCAST_CELLS = 100_000  # rows of five numbers


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


class Tree:
    """Points in leaf order and, per node: vantage point, distance ranges, children or leaf slice."""

    FIELDS = ("points", "ids", "id_starts", "vantage", "ranges", "children", "slices", "length")

    def __init__(self, **arrays: np.ndarray) -> None:
        self.__dict__.update(arrays)

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF) -> "Tree":
        """Of rows with unique ids."""
        by_id = np.argsort(ids, kind="stable")
        ids, vectors = ids[by_id], np.ascontiguousarray(vectors[by_id])
        points, owner, counts = np.unique(vectors, axis=0, return_inverse=True, return_counts=True)
        ids = ids[np.argsort(owner.ravel(), kind="stable")]  # within a point, ascending
        id_starts = np.concatenate([[0], np.cumsum(counts)])
        squares = (points * points).sum(1)
        length = float(squares.max())
        lifted = np.column_stack([points, np.sqrt(np.maximum(length - squares, 0))])
        order: list[np.ndarray] = []
        vantage, ranges, children, slices = [], [], [], []
        random = np.random.default_rng(len(points))
        placed = 0

        def grow(members: np.ndarray) -> int:
            nonlocal placed
            node = len(vantage)
            vantage.append(lifted[members[random.integers(len(members))]])
            ranges.append((0.0, 0.0, 0.0, 0.0))
            children.append((-1, -1))
            slices.append((placed, placed + len(members)))
            if len(members) <= leaf:
                order.append(members)
                placed += len(members)
                return node
            away = np.sqrt(((lifted[members] - vantage[node]) ** 2).sum(1))
            ranked = np.argsort(away, kind="stable")
            middle = len(members) // 2
            near, far = ranked[:middle], ranked[middle:]
            ranges[node] = (away[near[0]], away[near[-1]], away[far[0]], away[far[-1]])
            children[node] = (grow(members[near]), grow(members[far]))
            return node

        grow(np.arange(len(points)))
        final = np.concatenate(order)
        starts = id_starts[:-1][final]
        sizes = counts[final]
        gathered = np.concatenate([ids[s : s + n] for s, n in zip(starts, sizes, strict=True)])
        return cls(
            points=points[final],
            ids=gathered,
            id_starts=np.concatenate([[0], np.cumsum(sizes)]),
            vantage=np.array(vantage),
            ranges=np.array(ranges),
            children=np.array(children),
            slices=np.array(slices),
            length=np.array([length]),
        )

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{name: getattr(self, name) for name in self.FIELDS})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> "Tree":
        with np.load(io.BytesIO(data)) as stored:
            return cls(**{name: stored[name] for name in cls.FIELDS})

    def search(
        self, queries: np.ndarray, k: int, factor: float, floor: np.ndarray | float = -np.inf
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """Per query the positions and products of its best points in any order, -1 where there are too
        few, and how many leaf visits that took. More than k are kept, so that exact scores can decide
        among near ties. Points below `floor` are not needed."""
        keep = k + SPARE
        floor = np.broadcast_to(floor, len(queries))
        best = np.full((len(queries), keep), -np.inf)
        where = np.full((len(queries), keep), -1)
        kth, lowest = best[:, 0].copy(), best[:, 0].copy()  # k-th best and the last kept so far
        norms = (queries * queries).sum(1) + self.length[0]
        floor = floor - 1e-9 * (1 + norms)
        lifted = np.column_stack([queries, np.zeros(len(queries))])
        visits = 0

        def reach(rows: np.ndarray) -> np.ndarray:
            """Distance of the k-th best so far, with room for rounding."""
            return np.sqrt(np.maximum(norms[rows] - 2 * np.maximum(kth[rows], floor[rows]), 0)) + 1e-9

        def visit(node: int, rows: np.ndarray) -> None:
            nonlocal visits
            if len(rows) == 0:
                return
            near, far = self.children[node]
            if near < 0:
                visits += len(rows)
                start, end = self.slices[node]
                products = queries[rows] @ self.points[start:end].T
                better = products.max(1) >= lowest[rows]
                rows, products = rows[better], products[better]
                if len(rows):
                    every = np.hstack([best[rows], products])
                    places = np.broadcast_to(np.arange(start, end), products.shape)
                    places = np.hstack([where[rows], places])
                    top = np.argpartition(every, -keep, axis=1)[:, -keep:]
                    kept = np.take_along_axis(every, top, 1)
                    best[rows], where[rows] = kept, np.take_along_axis(places, top, 1)
                    kth[rows] = np.partition(kept, SPARE, axis=1)[:, SPARE]
                    lowest[rows] = kept.min(1)
                return
            away = np.sqrt(((lifted[rows] - self.vantage[node]) ** 2).sum(1))
            near_low, near_high, far_low, far_high = self.ranges[node]
            to_near = np.maximum(0, np.maximum(near_low - away, away - near_high))
            to_far = np.maximum(0, np.maximum(far_low - away, away - far_high))
            first_near = to_near <= to_far
            visit(near, rows[first_near])
            visit(far, rows[~first_near])
            open_ = first_near & (factor * to_far <= reach(rows))
            visit(far, rows[open_])
            open_ = ~first_near & (factor * to_near <= reach(rows))
            visit(near, rows[open_])

        visit(0, np.arange(len(queries)))
        return where, best, visits


class Cells:
    """A top vantage tree over a sample of vectors: which cell a vector falls in, and the cells' centres."""

    def __init__(self, sample: np.ndarray, most: int) -> None:
        self.nodes: list[tuple] = []  # vantage point, median distance, children; a cell is ~number
        centres: list[np.ndarray] = []
        random = np.random.default_rng(len(sample))

        def grow(members: np.ndarray, share: int) -> int:
            vantage = sample[members[random.integers(len(members))]]
            away = distances(sample[members], vantage)
            middle = np.median(away)
            beyond = away > middle
            if share < 2 or not beyond.any():
                centres.append(sample[members].mean(0))
                return ~(len(centres) - 1)
            node = len(self.nodes)
            self.nodes.append(())
            near = grow(members[~beyond], share // 2)
            self.nodes[node] = (vantage, middle, near, grow(members[beyond], share - share // 2))
            return node

        self.root = grow(np.arange(len(sample)), most)
        self.centres = np.array(centres)
        self.radii = np.full(len(centres), -np.inf)  # of cells without rows

    def of(self, vectors: np.ndarray) -> np.ndarray:
        cell = np.zeros(len(vectors), np.int64)
        open_ = [(self.root, np.arange(len(vectors)))]
        while open_:
            node, rows = open_.pop()
            if node < 0:
                cell[rows] = ~node
            elif len(rows):
                vantage, middle, near, far = self.nodes[node]
                beyond = distances(vectors[rows], vantage) > middle
                open_ += [(near, rows[~beyond]), (far, rows[beyond])]
        return cell

    def first(self, queries: np.ndarray) -> np.ndarray:
        """The cell with rows that a query searches first."""
        return np.where(self.radii >= 0, queries @ self.centres.T, -np.inf).argmax(1)

    def reached(self, queries: np.ndarray, floor: np.ndarray, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Queries and the other cells that may hold products of at least `floor`."""
        lengths = np.sqrt((queries * queries).sum(1))[:, None]
        bound = queries @ self.centres.T + lengths * self.radii / factor
        room = 1e-9 * (1 + lengths * (1 + np.abs(self.centres).max() * np.sqrt(queries.shape[1]) + np.maximum(self.radii, 0)))
        near = (bound + room >= floor[:, None]) & (self.radii >= 0)
        near[np.arange(len(queries)), self.first(queries)] = False
        return np.nonzero(near)


def distances(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(((vectors - point) ** 2).sum(1))


def by_width(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Table]]:
    """The batch's rows by their column `width`."""
    table = pa.Table.from_batches([batch])
    widths = table.column("width").to_numpy()
    for width in np.unique(widths).tolist():
        yield width, table.filter(pa.array(widths == width))


def in_order_product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products over the last axis, summed from the first coordinate to the last."""
    total = np.zeros(np.broadcast_shapes(left.shape, right.shape)[:-1])
    for i in range(left.shape[-1]):
        total += left[..., i] * right[..., i]
    return total


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def with_ties(tree: Tree, queries: np.ndarray, where: np.ndarray, best: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of queries whose last point kept ties with the k-th best, so that others may tie unseen: query and
    point of the k best of all points, by exact score and smallest id."""
    kth = np.partition(best, SPARE, axis=1)[:, SPARE]
    room = 1e-9 * (1 + np.sqrt((queries * queries).sum(1) * tree.length[0]))
    tied, more = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for q in np.flatnonzero((where >= 0).all(1) & (best.min(1) >= kth - room)):
        near = np.flatnonzero(tree.points @ queries[q] >= kth[q] - room[q])
        score = in_order_product(queries[q], tree.points[near])
        near = near[np.lexsort((tree.ids[tree.id_starts[near]], -score))[:k]]
        tied.append(np.full(len(near), q))
        more.append(near)
    return np.concatenate(tied), np.concatenate(more)


def best_of_shard(
    tree: Tree, ids: np.ndarray, queries: np.ndarray, k: int, factor: float, floor: np.ndarray | float = -np.inf
) -> pa.Table:
    """Each query's k nearest in the shard, but not itself: query_id, vec_id, score. Scores below `floor` may lack."""
    where, best, _ = tree.search(queries, k + 1, factor, floor)  # one more, as a query may find itself
    row, column = np.nonzero(where >= 0)
    point = where[row, column]
    tied, more = with_ties(tree, queries, where, best, k + 1)
    settled = ~np.isin(row, tied)
    row, point = np.append(row[settled], tied), np.append(point[settled], more)
    score = in_order_product(queries[row], tree.points[point])
    start = tree.id_starts[point]
    size = np.minimum(tree.id_starts[point + 1] - start, k + 1)
    each = np.repeat(np.arange(len(row)), size)
    nth = np.arange(len(each)) - np.repeat(np.cumsum(size) - size, size)
    found, query, score = tree.ids[start[each] + nth], ids[row[each]], score[each]
    other = found != query
    found, query, score = found[other], query[other], score[other]
    order = np.lexsort((found, -score, query))
    found, query, score = found[order], query[order], score[order]
    first = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else np.zeros(0, int)
    rank = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
    kept = rank < k
    return pa.table({"query_id": query[kept], "vec_id": found[kept], "score": score[kept]})


def fitted_cells(points: DataFrame, shard_rows: int) -> dict[int, Cells]:
    """A top tree for each of the most frequent widths that fill more than a shard."""
    counts = points.groupBy("width").count().where(F.col("count") > shard_rows)
    cells = {}
    for width, count in counts.orderBy(F.desc("count"), "width").limit(WIDTHS).collect():
        rows = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * width)))
        drawn = F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, rows / count))
        # an id counts once, however many rows have it
        sample = points.where((F.col("width") == width) & drawn).groupBy("vec_id").agg(F.min("vector").alias("vector"))
        sample = sample.orderBy("vec_id").toArrow()
        if len(sample):
            most = min(-(-count // shard_rows), MOST_CELLS, max(1, len(sample) // 4))
            cells[width] = Cells(matrix(sample.column("vector")), most)
    return cells


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    factor: float = FACTOR,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Each query's k nearest vectors found, itself left out: query_id, rank (from 1), vec_id, score."""

    def prepared(df: DataFrame) -> DataFrame:
        taken = df.where(F.col(vec_id).isNotNull() & usable(F.col(vector)))
        return taken.select(
            F.col(vec_id).cast("bigint").alias("vec_id"),
            F.size(vector).alias("width"),
            F.col(vector).cast("array<double>").alias("vector"),
        )

    points, asked = prepared(vectors), prepared(queries)
    first = asked.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = written(first.withColumn("width", F.size("vector")), "vector-queries")
    cells = fitted_cells(points, shard_rows)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, table in by_width(batch):
                cell, away = np.zeros(len(table), np.int64), np.zeros(len(table))
                if width in cells:
                    rows = matrix(table.column("vector"))
                    cell = cells[width].of(rows)
                    away = np.sqrt(((rows - cells[width].centres[cell]) ** 2).sum(1))
                table = table.append_column("cell", pa.array(cell, pa.int32())).append_column("away", pa.array(away))
                yield from table.combine_chunks().to_batches()

    # rows of one id are combined before the shuffle, so no id fills a shard
    single = points.groupBy("vec_id", "width").agg(F.min("vector").alias("vector"))
    dealt = single.mapInArrow(deal, "vec_id bigint, width int, vector array<double>, cell int, away double")
    figures = dealt.groupBy("width", "cell").agg(F.count(F.lit(1)).alias("rows"), F.max("away").alias("radius"))
    parts = F.ceil(F.col("rows") / F.lit(shard_rows)).cast("int").alias("parts")
    figures = written(figures.select("width", "cell", parts, "radius"), "cells")
    for row in figures.where(F.col("width").isin(list(cells))).collect():  # a row per cell of a top tree
        cells[row["width"]].radii[row["cell"]] = row["radius"]

    def with_figures(df: DataFrame, side: DataFrame) -> DataFrame:
        small = broadcast_if_small(side, BROADCAST_CELLS)
        return df.join(side if small is None else small, ["width", "cell"])

    def grow(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("vec_id", "ascending")])
        tree = Tree.build(table.column("vec_id").to_numpy(), matrix(table.column("vector")))
        shard = [pa.array([one.as_py()], pa.int32()) for one in key]
        return pa.table([*shard, pa.array([tree.dump()], pa.binary())], ["width", "cell", "part", "tree"])

    shards = with_figures(dealt, figures.select("width", "cell", "parts")).select(
        "width", "cell", F.expr("cast(pmod(xxhash64(vec_id), parts) as int)").alias("part"), "vec_id", "vector"
    )
    grown = shards.groupBy("width", "cell", "part").applyInArrow(grow, "width int, cell int, part int, tree binary")
    trees = written(grown, "trees")
    visit = "vec_id bigint, width int, vector array<double>, floor double, cell int"

    def rows_of(table: pa.Table, row: np.ndarray, cell: np.ndarray) -> Iterator[pa.RecordBatch]:
        taken = table.select(["vec_id", "width", "vector", "floor"]).take(pa.array(row))
        yield from taken.append_column("cell", pa.array(cell, pa.int32())).combine_chunks().to_batches()

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, table in by_width(batch):
                cell = np.zeros(len(table), np.int64)
                if width in cells:
                    cell = cells[width].first(matrix(table.column("vector")))
                yield from rows_of(table, np.arange(len(table)), cell)

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, table in by_width(batch):
                for start in range(0, len(table) if width in cells else 0, 1024):
                    some = table.slice(start, 1024)
                    floor = some.column("floor").to_numpy()
                    found = cells[width].reached(matrix(some.column("vector")), floor, min(factor, CELL_FACTOR))
                    yield from rows_of(some, *found)

    keys = ["width", "cell", "part", "block"]

    def search(questions: pa.Table, tree: pa.Table) -> pa.Table:
        if not (len(questions) and len(tree)):
            empty = np.zeros(0, np.int64)
            return pa.table({"query_id": empty, "vec_id": empty, "score": np.zeros(0)})
        loaded = Tree.load(tree.column("tree")[0].as_py())
        ids, floor = questions.column("vec_id").to_numpy(), questions.column("floor").to_numpy()
        return best_of_shard(loaded, ids, matrix(questions.column("vector")), k, factor, floor)

    def searched(visits: DataFrame) -> DataFrame:
        """The best of each shard of the cells that queries visit; a tree meets each block of its visitors."""
        visits = written(visits, "visits")
        blocks = F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias("blocks")
        meant = visits.groupBy("width", "cell").agg(blocks).join(figures.drop("radius"), ["width", "cell"])
        meant = written(meant, "visited-cells")
        meeting = with_figures(trees, meant.drop("parts"))
        meeting = meeting.withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).select(*keys, "tree")
        posed = with_figures(visits, meant).withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
        posed = posed.withColumn("block", F.expr("cast(pmod(xxhash64(vec_id, 1), blocks) as int)"))
        posed = posed.select(*keys, "vec_id", "vector", "floor")
        return posed.groupBy(*keys).cogroup(meeting.groupBy(*keys)).applyInArrow(
            search, "query_id bigint, vec_id bigint, score double"
        )

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    nothing = F.lit(float("-inf"))
    found = ranked(searched(asked.withColumn("floor", nothing).mapInArrow(enter, visit)))
    if cells:
        found = written(found, "first-found")
        floors = found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
        known = asked.join(floors, "vec_id", "left").withColumn("floor", F.coalesce("floor", nothing))
        more = searched(known.mapInArrow(go_on, visit))
        found = ranked(found.drop("rank").unionByName(more))
    return found.select("query_id", "rank", "vec_id", "score")
