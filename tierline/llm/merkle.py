"""A Merkle tree per group of rows, one over the groups' roots, and a proof for every row.

Slot pivot: a node's parent is its place divided by the fanout. Conditional aggregates spread each
parent's children into one column per slot; the columns' digests, concatenated, are hashed to the parent's.
Going back down, a child's siblings are the slot columns without its own. A band of levels is built
under one exchange: rows are dealt by the band's top node, and a parent keeps its children in its
slots, so the way down opens them again and joins once a band, not once a level.

Scale: only ids and digests move, never texts. A group of any size is numbered over many tasks, and the
nodes under a band's top are at most fanout ** depth, so no task's share depends on how large a group is.
The driver learns the size of the largest group and nothing else. Bands are written, which cuts lineage.

Edge cases: NULL groups form a group, ordered first. Rows are ordered by id, NULL ids first, then by
digest, so equal ids have a defined place and rows equal in all hashed columns are interchangeable. A group
of one row has that row's digest as its root, and a single group's root is the root of all. An empty text
hashes as `0:`, unlike NULL, `-`. Texts of any length are hashed whole, where they are read. An empty
table gives an empty result. Columns that are not named are not hashed, whatever they are called.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.support import numbered, written

FANOUT = 3
DEPTH = 4  # levels of a band: 81 leaves under its top node


def digest(*values: Column) -> Column:
    """SHA-256, lowercase hex, of the values' texts: `-` for NULL, else UTF-8 bytes, `:` and the text."""
    texts = [value.cast("string") for value in values]
    marked = [F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts]
    return F.sha2(F.concat(*marked), 256)


def _band(nodes: DataFrame, fanout: int, depth: int) -> DataFrame:
    """The nodes `depth` levels higher: tree, place, size (nodes of the tree at that level) and node, a struct
    of hash, single (the tree had one node below, which is this one) and slots, the child of each slot."""
    level = nodes.withColumn("block", F.expr(f"place div {fanout**depth}")).repartition("tree", "block")
    for _ in range(depth):
        slots = [
            F.first(F.when(F.col("place") % fanout == i, F.col("node")), ignorenulls=True).alias(f"s{i}")
            for i in range(fanout)
        ]
        parents = level.groupBy("tree", "block", F.expr(f"place div {fanout}").alias("place"))
        spread = parents.agg(F.max("size").alias("size"), *slots)
        joined = F.concat_ws("", *[F.col(f"s{i}.hash") for i in range(fanout)])
        single = F.col("size") == 1
        level = spread.select(
            "tree",
            "block",
            "place",
            F.expr(f"(size + {fanout - 1}) div {fanout}").alias("size"),
            F.struct(
                F.when(single, F.col("s0.hash")).otherwise(F.sha2(joined, 256)).alias("hash"),
                single.alias("single"),
                F.array(*[f"s{i}" for i in range(fanout)]).alias("slots"),
            ).alias("node"),
        )
    return level.drop("block")


def _grown(nodes: DataFrame, largest: int, fanout: int, depth: int) -> tuple[list[DataFrame], DataFrame]:
    """The bands over the nodes, lowest first, and each tree's root as tree, hash."""
    bands, top = [], nodes
    while largest > 1:
        bands.append(written(_band(top, fanout, depth), "merkle-band"))
        top = bands[-1].withColumn("node", F.struct("node.hash"))
        largest = -(-largest // fanout**depth)
    return bands, top.select("tree", F.col("node.hash").alias("hash"))


def _opened(band: DataFrame, tops: DataFrame, fanout: int, depth: int) -> DataFrame:
    """The nodes at the bottom of a band, with what `tops` has for the node at its top. To `proof` each level
    adds the digests left and right of the node."""
    known = [name for name in tops.columns if name not in ("tree", "place", "proof")]
    level = _with_tops(band, tops)
    for _ in range(depth):
        each = level.select("*", F.posexplode("node.slots").alias("slot", "child")).where("child is not null")
        others = [F.col("node.slots")[i]["hash"] for i in range(fanout)]
        sides = {
            "left": [F.when(F.col("slot") > i, other) for i, other in enumerate(others)],
            "right": [F.when(F.col("slot") < i, other) for i, other in enumerate(others)],
        }
        step = F.struct(*[F.concat_ws("", *side).alias(name) for name, side in sides.items()])
        level = each.select(
            "tree",
            (F.col("place") * fanout + F.col("slot")).alias("place"),
            F.col("child").alias("node"),
            F.when(F.col("node.single"), F.col("proof")).otherwise(F.concat(F.array(step), "proof")).alias("proof"),
            *known,
        )
    return level


def _with_tops(nodes: DataFrame, tops: DataFrame) -> DataFrame:
    upper = tops.withColumnsRenamed({"tree": "_tree", "place": "_place"})
    same = F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("place") == F.col("_place"))
    return nodes.drop("size").join(upper, same).drop("_tree", "_place")


def _leaves(nodes: DataFrame, bands: list[DataFrame], tops: DataFrame, fanout: int, depth: int) -> DataFrame:
    """Every leaf with its proof up to the root, from `tops`: tree, proof (above the tree) and more."""
    tops = tops.withColumn("place", F.lit(0).cast("bigint"))
    if not bands:
        return _with_tops(nodes, tops)
    for band in reversed(bands[1:]):
        tops = _opened(band, tops, fanout, depth).drop("node")
    return _opened(bands[0], tops, fanout, depth)


PROOF = "array<struct<left: string, right: string>>"


def manifest(
    rows: DataFrame, group: str = "source", order: str = "doc_id", leaf: str = "leaf", fanout: int = FANOUT, depth: int = DEPTH
) -> DataFrame:
    """The rows with subroot, root and proof: for each level from the leaf to the root, the digests of its
    siblings to the left and to the right, concatenated.

    Rows should be few columns wide (ids and digests): all of them travel.
    """
    packed = rows.select(
        F.col(group).alias("tree"), F.col(order).alias("id"), F.col(leaf).alias("hash"), F.struct("*").alias("row")
    )
    placed = numbered(written(packed, "leaves"), ["tree"], ["id", "hash"], "ordered-leaves")
    nodes = placed.select("tree", "place", "size", F.struct("hash", "row").alias("node"))
    largest = placed.agg(F.max("size")).first()[0] or 0
    bands, subroots = _grown(nodes, largest, fanout, depth)
    subroots = written(subroots.withColumn("all", F.lit(0)), "subroots")

    upper = numbered(subroots, ["all"], ["tree"], "ordered-subroots")
    upper = upper.select(
        F.col("all").alias("tree"), "place", "size", F.struct("hash", F.col("tree").alias("group")).alias("node")
    )
    groups = upper.agg(F.max("size")).first()[0] or 0
    upper_bands, root = _grown(upper, groups, fanout, depth)
    root = root.select("tree", F.array().cast(PROOF).alias("proof"), F.col("hash").alias("root"))
    tops = _leaves(upper, upper_bands, root, fanout, depth).select(
        F.col("node.group").alias("tree"), "proof", F.col("node.hash").alias("subroot"), "root"
    )
    found = _leaves(nodes, bands, written(tops, "group-proofs"), fanout, depth)
    return found.select("node.row.*", "subroot", "root", "proof")


def siblings(proof: Column) -> Column:
    """All digests of a proof, concatenated level by level."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(
        proof, leaf, lambda below, step: F.sha2(F.concat(step["left"], below, step["right"]), 256)
    )
