"""Near copies among vectors of one label, by an inverted multi-index.

Each half of the vectors has its own codebook; the two form a product grid of cells. A vector lies in the
cell of its two nearest codewords and visits the cells nearest to it in multi-sequence order, by the sum of
its halves' distances to the cells' codewords. How many it visits is settled by planting: sampled vectors
are turned in a random direction until the cosine is exactly the threshold, and enough cells are visited that
the target share of these hardest partners meets, in either's visits. Cosines of what meets are verified in
double precision, so no link below the threshold is made.

Scale: equal vectors of one label are one class, combined before the shuffle, so copies are never compared.
What first travels to the cells is a 128-bit sketch; vectors follow for the rows whose sketch has a likely
partner there. Full cells are cut into blocks, and every block of visitors meets every block of members, so
one task compares at most BLOCK times BLOCK. A pair that meets twice is counted once: by the smaller class
number's visit, or by the other's if that one never visits. A task writes each class's links and one edge to
what it is connected to, never its pairs; still, counting all links of a group of different near copies is
quadratic in that group, in blocks. Codebooks are fitted on at most about SAMPLE classes, chosen by hash;
all vectors are indexed. Codebooks (at most SIDE codewords a half) are all that goes to every task.

Edge cases: vectors that are NULL, empty, zero or hold NULL or non-finite components, and rows without
label or id, link with nothing: n_links 0, component_id their own id (NULL without id), kept true. Vectors of
different lengths are not compared. Repeated ids are vectors of their own, each with its row; a component is
named after its smallest id. With as many visits as cells (small tables), search is exact. An empty table
gives an empty result; other columns are ignored, whatever they are called.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.chosen_path import components, roots
from tierline.llm.support import run_starts, sorted_runs, written
from tierline.llm.vantage import in_order_product, matrix, usable

THRESHOLD = 0.93
RECALL = 0.99  # of partners at exactly the threshold; nearer ones are met more often
SAMPLE = 20_000
PLANTED = 2000
OCCUPANCY = 64  # classes of the largest label per cell, until a side has SIDE codewords
SIDE = 1024
BLOCK = 1024
BITS = 128  # of a sketch
SPREAD = 6.0  # standard deviations of leeway that sketches get


def codebook(points: np.ndarray, size: int, rounds: int = 10) -> np.ndarray:
    """Lloyd's algorithm from evenly spaced distinct points."""
    points = np.unique(points, axis=0)
    words = points[np.linspace(0, len(points) - 1, min(size, len(points))).astype(int)]
    for _ in range(rounds):
        own = distances(points, words).argmin(1)
        count = np.bincount(own, minlength=len(words))
        total = np.zeros_like(words)
        np.add.at(total, own, points)
        words = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], words)
    return words


def distances(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Squared distances of each point to each codeword."""
    return (points * points).sum(1)[:, None] - 2 * points @ words.T + (words * words).sum(1)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one. Scaling by a power of two first keeps squares from over- or underflowing."""
    exponent = np.frexp(np.abs(vectors).max(1, initial=0))[1]
    scaled = np.ldexp(vectors, -exponent[:, None])
    return scaled / np.sqrt((scaled * scaled).sum(1))[:, None]


@dataclass
class Grid:
    """The codebooks of vectors of one length, and how many cells one visits."""

    left: np.ndarray
    right: np.ndarray
    visits: int

    def nearest_cells(self, units: np.ndarray, most: int) -> np.ndarray:
        """Each vector's `most` nearest cells, nearest first: multi-sequence order.

        The cell of a half's i-th and the other's j-th codeword (from 0) has (i + 1)(j + 1) - 1 cells that are
        as near, so only products up to `most` can be among them.
        """
        half = units.shape[1] // 2
        sides = [distances(units[:, :half], self.left), distances(units[:, half:], self.right)]
        order = [np.argsort(side, axis=1, kind="stable")[:, :most] for side in sides]
        near = [np.take_along_axis(side, one, 1) for side, one in zip(sides, order, strict=True)]
        i, j = np.nonzero(np.outer(np.arange(near[0].shape[1]) + 1, np.arange(near[1].shape[1]) + 1) <= most)
        first = np.argsort(near[0][:, i] + near[1][:, j], axis=1, kind="stable")[:, :most]
        return order[0][:, i][np.arange(len(units))[:, None], first] * len(self.right) + order[1][:, j][
            np.arange(len(units))[:, None], first
        ]


def fitted(units: np.ndarray, side: int, threshold: float, recall: float, planted: int = PLANTED) -> Grid:
    """Codebooks of `side` words, and the visits that meet `recall` of partners planted at the threshold."""
    half = units.shape[1] // 2
    grid = Grid(codebook(units[:, :half], side), codebook(units[:, half:], side), 1)
    cells = len(grid.left) * len(grid.right)
    chance = np.random.default_rng(12)
    some = units[chance.permutation(len(units))[:planted]]
    aside = chance.normal(size=some.shape)
    aside -= (aside * some).sum(1)[:, None] * some
    length = np.sqrt((aside * aside).sum(1))[:, None]
    partner = threshold * some + math.sqrt(max(0.0, 1 - threshold**2)) * aside / np.where(length == 0, 1, length)
    most = 1
    while most < cells:  # twice as many, until enough meet; then the least of them that do
        most = min(2 * most, cells)
        mine, other = grid.nearest_cells(some, most), grid.nearest_cells(partner, most)
        met = (mine == other[:, :1]) | (other == mine[:, :1])
        rank = np.where(met.any(1), met.argmax(1), cells)
        if (rank < most).mean() >= recall:
            return Grid(grid.left, grid.right, int(np.sort(rank)[math.ceil(recall * len(rank)) - 1]) + 1)
    return Grid(grid.left, grid.right, cells)


def sketch_planes(width: int) -> np.ndarray:
    return np.random.default_rng(7).normal(size=(width, BITS))


def most_apart(threshold: float) -> int:
    """Bits in which sketches of vectors at the threshold differ at most, but for a chance of about 1e-9."""
    chance = math.acos(threshold) / math.pi
    return math.floor(BITS * chance + SPREAD * math.sqrt(BITS * chance * (1 - chance)))


PLACED = "node bigint, width int, home bigint, visits array<bigint>, low bigint, high bigint"


def _placed(grids: dict[int, Grid]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("width").to_numpy(zero_copy_only=False)
            for width in np.unique(widths):
                some = batch.filter(pa.array(widths == width))
                units = unit(matrix(pa.chunked_array([some.column("vector")])))
                grid = grids.get(int(width), Grid(np.zeros((1, width // 2)), np.zeros((1, width - width // 2)), 1))
                cells = grid.nearest_cells(units, grid.visits).astype(np.int64)
                bits = np.packbits(units @ sketch_planes(int(width)) > 0, axis=1).view(np.int64)
                visits = pa.FixedSizeListArray.from_arrays(pa.array(cells.reshape(-1)), cells.shape[1])
                columns = [some.column("node"), some.column("width"), pa.array(cells[:, 0].copy())]
                columns += [visits.cast(pa.list_(pa.int64())), pa.array(bits[:, 0].copy()), pa.array(bits[:, 1].copy())]
                yield pa.record_batch(columns, ["node", "width", "home", "visits", "low", "high"])

    return place


KEYS = ["cell", "inner", "outer"]  # a cell, a block of its members, a block of its visitors


def meetings(placed: DataFrame, block: int) -> DataFrame:
    """Members and visitors of cells, dealt into blocks that meet: KEYS, member, node, home, visits, low, high."""
    grid = ["label", "width", "at"]
    members = placed.groupBy("label", "width", F.col("home").alias("at")).agg(F.count(F.lit(1)).alias("members"))
    calls = placed.select("label", "width", F.explode("visits").alias("at")).groupBy(*grid)
    cells = members.join(calls.agg(F.count(F.lit(1)).alias("visitors")), grid).where("visitors > 1")
    cells = written(cells.withColumn("cell", F.monotonically_increasing_id()), "cells")

    def blocks(rows: str):
        return F.ceil(F.col(rows) / block).cast("int")

    def dealt(rows: DataFrame, own: str, other: str, sides: tuple[str, str], is_member: bool) -> DataFrame:
        """A row's own block by its number, and all blocks of the other side."""
        mine = F.pmod(F.xxhash64("node"), blocks(own)).cast("int").alias(sides[0])
        theirs = F.explode(F.sequence(F.lit(0), blocks(other) - 1)).alias(sides[1])
        fields = [F.lit(is_member).alias("member"), "node", "home", "visits", "low", "high"]
        return rows.join(cells, grid).select("cell", mine, theirs, *fields).select(*KEYS, "member", *fields[1:])

    at_home = placed.withColumn("at", F.col("home"))
    never = F.lit(None).cast("array<bigint>").alias("visits")  # only members' visits are asked for
    visiting = placed.select("label", "width", "node", "home", "low", "high", never, F.explode("visits").alias("at"))
    return dealt(at_home, "members", "visitors", ("inner", "outer"), True).unionByName(
        dealt(visiting, "visitors", "members", ("outer", "inner"), False)
    )


def _blocks(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of the members and of the visitors that meet, for each key of a table of whole keys."""
    starts = run_starts([table.column(key).combine_chunks() for key in KEYS])
    member = table.column("member").to_numpy()
    for begin, end in zip(starts, [*starts[1:], len(table)], strict=True):
        rows = np.arange(begin, end)
        yield rows[member[begin:end]], rows[~member[begin:end]]


def _likely(apart: int):
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with a partner whose sketch is near enough."""
        for table in sorted_runs(batches, KEYS):
            node = table.column("node").to_numpy()
            sketch = np.stack([table.column(name).to_numpy() for name in ("low", "high")], 1).view(np.uint64)
            near = np.zeros(len(table), bool)
            for members, visitors in _blocks(table):
                differ = sum(
                    np.bitwise_count(sketch[visitors, i][:, None] ^ sketch[members, i][None, :]).astype(np.int16)
                    for i in range(2)
                )
                close = (differ <= apart) & (node[visitors][:, None] != node[members][None, :])
                near[visitors[close.any(1)]] = True
                near[members[close.any(0)]] = True
            yield from table.filter(pa.array(near)).combine_chunks().to_batches()

    return mark


def cosines(left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Whether each of `left` and each of `right` are as near as the threshold, in double precision."""
    left, right = np.ascontiguousarray(unit(left)), np.ascontiguousarray(unit(right))
    cosine = left @ right.T
    a, b = np.nonzero(np.abs(cosine - threshold) < 1e-9)  # settled by sums in the order of the components
    exact = in_order_product(left[a], right[b]) / np.sqrt(in_order_product(left[a], left[a]) * in_order_product(right[b], right[b]))
    near = cosine >= threshold
    near[a, b] = exact >= threshold
    return near


def _linked(threshold: float):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each class's links within a meeting (rows of the classes linked) and what it is connected to there."""
        for table in sorted_runs(batches, KEYS):
            node, home, size = (table.column(name).to_numpy() for name in ("node", "home", "n"))
            links = np.zeros(len(table), np.int64)
            edges = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for members, visitors in _blocks(table):
                if not (len(members) and len(visitors)):
                    continue
                vectors = [matrix(table.column("vector").take(pa.array(rows))) for rows in (visitors, members)]
                v, m = np.nonzero(cosines(*vectors, threshold))
                v, m = visitors[v], members[m]
                other = node[v] != node[m]
                v, m = v[other], m[other]
                # the smaller number's visit counts; the larger one's only if the smaller never visits its home
                late = np.flatnonzero(node[v] > node[m])
                if len(late):
                    of = np.unique(m[late])
                    lists = table.column("visits").take(pa.array(of)).combine_chunks()
                    visits = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(of), -1)
                    also = (visits[np.searchsorted(of, m[late])] == home[v[late]][:, None]).any(1)
                    once = np.ones(len(v), bool)
                    once[late[also]] = False
                    v, m = v[once], m[once]
                np.add.at(links, v, size[m])
                np.add.at(links, m, size[v])
                edges.append((v, m))
            left, right = (np.concatenate(side) for side in zip(*edges, strict=True))
            number, place = np.unique(node, return_inverse=True)
            root = number[roots(len(number), place[left], place[right])][place]
            has = links > 0
            columns = [pa.array(values[has]) for values in (node, root, links)]
            yield pa.record_batch(columns, ["node", "root", "links"])

    return link


def near_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    occupancy: int = OCCUPANCY,
    block: int = BLOCK,
) -> DataFrame:
    """A row per vector: vec_id, n_links (other vectors as near as the threshold), component_id and kept."""
    good = F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.coalesce(usable(F.col(vector)), F.lit(False))
    rows = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.when(good, F.col(label).cast("string")).alias("label"),
        F.when(good, F.col(vector).cast("array<double>")).alias("vector"),
    )
    rows = written(rows, "vectors")
    classes = rows.where("vector is not null").groupBy("label", "vector").agg(
        F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("n")
    )
    numbering = [F.monotonically_increasing_id().alias("node"), F.size("vector").alias("width")]
    classes = written(classes.select("*", *numbering), "vector-classes")
    grids = _grids(classes, threshold, recall, occupancy)

    placed = classes.select("node", "width", "vector").mapInArrow(_placed(grids), PLACED)
    placed = placed.join(classes.select("node", "label"), "node")
    slim = meetings(written(placed, "vector-cells"), block)
    kinds = ", ".join(f"{name} {kind}" for name, kind in slim.dtypes)
    near = slim.repartition(*KEYS).sortWithinPartitions(*KEYS).mapInArrow(_likely(most_apart(threshold)), kinds)
    full = written(near, "likely-vectors").join(classes.select("node", "n", "vector"), "node")
    links = full.repartition(*KEYS).sortWithinPartitions(*KEYS).mapInArrow(
        _linked(threshold), "node bigint, root bigint, links bigint"
    )
    links = written(links, "vector-links")

    found = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    total = links.groupBy("node").agg(F.sum("links").alias("links"))
    known = classes.join(total, "node", "left").join(found, "node", "left")
    known = written(known.withColumn("component", F.coalesce("component", "node")), "known-vectors")
    first = written(known.groupBy("component").agg(F.min("first_id").alias("component_id")), "vector-components")
    others = F.coalesce("links", F.lit(0)) + F.col("n") - 1
    known = known.join(first, "component").select("label", "vector", others.alias("n_links"), "component_id")
    known = written(known, "classes-done")
    placed = rows.join(known, ["label", "vector"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return placed.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _grids(classes: DataFrame, threshold: float, recall: float, occupancy: int) -> dict[int, Grid]:
    """Codebooks for each length of vectors that the sample has."""
    sizes = classes.groupBy("label", "width").count().groupBy("width")
    largest = dict(sizes.agg(F.max("count")).limit(SIDE).collect())
    rows = classes.count()
    share = min(1.0, SAMPLE / max(1, rows))
    chosen = F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) <= int(share * (1 << 30))
    # the share makes it about SAMPLE rows; the limit is only a guard
    sample = classes.where(chosen).select("width", "vector").limit(2 * SAMPLE).toArrow()
    widths = sample.column("width").to_numpy()
    grids = {}
    for width in np.unique(widths):
        units = unit(matrix(sample.column("vector").filter(pa.array(widths == width))))
        units = units[np.lexsort(units.T)]  # the same whatever order they come in
        side = round(math.sqrt(largest.get(int(width), 1) / occupancy))
        grids[int(width)] = fitted(units, max(1, min(SIDE, side, len(units) // 8)), threshold, recall)
    return grids
