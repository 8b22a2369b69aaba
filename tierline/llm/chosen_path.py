"""N-gram Jaccard join by chosen paths.

A document's set is its distinct shingles of five words. A run splits all sets into buckets by a token that
each set chooses with a hash all sets share, so that sets choose the same token with a probability equal
to their similarity. Buckets above SMALL are split again by the next choice, up to DEEPEST choices; the
buckets where a path ends are compared by brute force. Runs repeat with other hashes until a pair at the
threshold is met with the target recall.

Pairs are compared where they meet first: a pair's runs can be told from the two signatures (the choices of
all runs) alone, so nothing is counted twice and no pair is ever written out. Comparison has two steps. The
signatures, which are also a sketch of the similarity, tell which documents of a bucket can have a partner
there at all; only those go on, with their texts, and their shingles are compared exactly. A bucket gives
each document's number of links and the edges of a spanning forest of its links, never the links one by one.

Scale: equal word sequences are one representative from the start. A bucket too large for one task is cut
into blocks, and each pair of blocks is compared by a task of its own. Classes are the connected
components of the forest edges, found by rounds of joins over written tables.

Edge cases: words are runs of anything but white space; a text of fewer than five words has one shingle, all
its words; NULL and texts without words are alike and one class; documents of equal words are one class and
linked to each other; repeated rows each get their row; an empty table gives an empty result.
"""

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.support import run_starts, sorted_runs, text_or_empty, written

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
SMALL = 128  # representatives in a bucket that is not split again
DEEPEST = 3  # choices on a path
BLOCK = 1024  # representatives that a task compares with as many others
SPREAD = 6.0  # standard deviations of leeway that the sketch gets
WORD = r"[^\x20\x09-\x0D]+"
MIX = np.uint64(0x9E3779B97F4A7C15)  # odd; multiplies words' hashes


def runs_needed(threshold: float = THRESHOLD, recall: float = RECALL, deepest: int = DEEPEST) -> int:
    """Runs after which a pair at the threshold has met, if every path went as deep as it may."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**deepest))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, over an array of unsigned integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word of a text, from all of its bytes."""
    data = np.frombuffer(text.encode(), np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    # eight bytes at a time: word lengths differ, so each round takes the words that still have bytes
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.lib.stride_tricks.sliding_window_view(padded, 8)
    hashes = mixed((ends - starts).astype(np.uint64) * MIX)
    at, rows = starts.copy(), np.arange(len(starts))
    while len(rows):
        left = (ends[rows] - at[rows]).clip(max=8)
        chunk = np.ascontiguousarray(eights[at[rows]]).view("<u8").ravel()
        chunk &= np.where(left == 8, np.uint64(2**64 - 1), (np.uint64(1) << (left % 8 * 8).astype(np.uint64)) - np.uint64(1))
        hashes[rows] = mixed(hashes[rows] * MIX + chunk)
        at[rows] += 8
        rows = rows[at[rows] < ends[rows]]
    return hashes


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    words = word_hashes(text)
    if len(words) == 0:
        return words
    size = min(size, len(words))
    windows = len(words) - size + 1
    hashes = np.zeros(windows, np.uint64)
    for i in range(size):
        hashes = mixed(hashes * MIX + words[i : i + windows])
    return np.unique(hashes)


def signature(tokens: np.ndarray, choices: int) -> np.ndarray:
    """The token each choice falls on, as 32 bits of its hash under that choice's function."""
    found = np.empty(choices, np.uint64)
    for choice in range(choices):
        seed = np.uint64((choice + 1) * int(MIX) % 2**64)
        found[choice] = mixed(tokens + seed).min()
    return (found >> np.uint64(16)).astype(np.uint32)


def sketch_floor(threshold: float, choices: int, spread: float = SPREAD) -> int:
    """Equal choices that a pair at the threshold has, but for `spread` standard deviations."""
    return max(1, math.floor(choices * threshold - spread * math.sqrt(choices * threshold * (1 - threshold))))


def words_of(text: str) -> Column:
    """A text's words with single spaces between them."""
    return F.array_join(F.regexp_extract_all(text_or_empty(text), F.lit(WORD), F.lit(0)), " ")


def words_id(words: Column) -> Column:
    """128 bits that stand for equal words in order."""
    return F.substring(F.unhex(F.sha2(words, 256)), 1, 16)


def signed_rows(docs: DataFrame, doc_id: str, text: str, choices: int) -> DataFrame:
    """A row per document: doc_id, words_id, signature (NULL without words). Texts stay where they are."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                signature(shingles(words), choices).tobytes() if words else None
                for words in batch.column(2).to_pylist()
            ]
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.binary())]
            yield pa.record_batch(columns, ["doc_id", "words_id", "signature"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), words_of(text).alias("words"))
    rows = rows.select("doc_id", words_id(F.col("words")).alias("words_id"), "words")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(sign, f"doc_id {kind}, words_id binary, signature binary")


def path_ends(signed: DataFrame, runs: int, deepest: int, small: int) -> DataFrame:
    """The buckets each representative's paths end in: words_id, buckets, members (arrays by run, 0
    where a path ends alone).

    A path ends at a bucket of at most `small` members or after `deepest` choices. A bucket is the hash of
    its run and choices.
    """

    def bucket(depth: int) -> Column:
        # run r makes the choices number r * deepest and on, of four bytes each
        taken = F.substring(F.col("signature"), F.col("run") * (4 * deepest) + 1, F.lit(4 * depth))
        return F.xxhash64("run", F.lit(depth), taken).alias(f"bucket_{depth}")

    run = F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run")
    open_ = signed.select("words_id", "signature", run).select(
        "words_id", "run", *[bucket(depth) for depth in range(1, deepest + 1)]
    )
    ended = []
    for depth in range(1, deepest + 1):
        name = f"bucket_{depth}"
        sizes = open_.groupBy(name).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        sized = written(open_.join(sizes, name), f"paths-{depth}")
        stops = sized if depth == deepest else sized.where(F.col("members") <= small)
        ended.append(stops.select("words_id", "run", F.col(name).alias("bucket"), "members"))
        open_ = sized.where(F.col("members") > small).drop("members", name)
        if depth == deepest or open_.isEmpty():
            break
    found = reduce(DataFrame.unionByName, ended)

    def by_run(column: str) -> Column:
        of_run = [F.max(F.when(F.col("run") == r, F.col(column))) for r in range(runs)]
        return F.array(*[F.coalesce(value, F.lit(0)) for value in of_run]).alias(column.rstrip("s") + "s")

    return found.groupBy("words_id").agg(by_run("bucket"), by_run("members"))


def meetings(rows: DataFrame, block: int) -> DataFrame:
    """`rows` (with words_id, buckets, members) for each bucket they are in, and each task that compares
    them there: run, bucket, left, right (numbers of the blocks compared), side (the row's block)."""
    at = rows.withColumn("run", F.explode(F.sequence(F.lit(0), F.size("buckets") - 1))).withColumn(
        "bucket", F.element_at("buckets", F.col("run") + 1)
    )
    blocks = F.ceil(F.element_at("members", F.col("run") + 1) / F.lit(block)).cast("int")
    at = at.where("bucket <> 0").withColumn("blocks", blocks)
    at = at.withColumn("side", F.pmod(F.xxhash64("words_id", "run"), F.col("blocks")).cast("int"))
    other = at.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.select(
        *rows.columns,
        "run",
        "bucket",
        F.least("side", "other").alias("left"),
        F.greatest("side", "other").alias("right"),
        "side",
    ).drop("members")


KEYS = ["bucket", "run", "left", "right"]


def pairs_of_runs(starts: np.ndarray, size: int, most: int = 100_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows within runs of rows that begin at `starts`, about `most` at a time."""
    ends = np.repeat(np.append(starts[1:], size), np.diff(np.append(starts, size)))
    partners = ends - np.arange(size) - 1
    totals = np.cumsum(partners)
    row = 0
    while row < size:
        done = totals[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(totals, done + most, "right")))
        count = partners[row:stop]
        left = np.repeat(np.arange(row, stop), count)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
        if len(left):
            yield left, right
        row = stop


def _fixed(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    """Binary or list values of one width as rows of an array."""
    values = column.combine_chunks()
    if pa.types.is_list(values.type):
        return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)
    return np.frombuffer(b"".join(values.to_pylist()), kind).reshape(len(values), -1)


def likely_pairs(table: pa.Table, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a table of whole buckets that meet here first and whose sketches are near enough."""
    starts = run_starts([table.column(key).combine_chunks() for key in KEYS])
    buckets, signatures = _fixed(table.column("buckets"), "<i8"), _fixed(table.column("signature"), "<u4")
    run, side = table.column("run").to_numpy(), table.column("side").to_numpy()
    crossing = table.column("left").to_numpy() != table.column("right").to_numpy()
    found = []
    for left, right in pairs_of_runs(starts, len(table)):
        apart = ~crossing[left] | (side[left] != side[right])
        left, right = left[apart], right[apart]
        together = (buckets[left] == buckets[right]) & (buckets[left] != 0)
        here = together.argmax(1) == run[left]
        left, right = left[here], right[here]
        near = (signatures[left] == signatures[right]).sum(1) >= floor
        found.append((left[near], right[near]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(side) for side in zip(*found, strict=True))


def shared_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sorted sets.

    Few pairs are intersected one by one; many pairs of few sets by products of incidence matrices, a
    slice of the tokens at a time.
    """
    if len(left) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], True)) for a, b in zip(left, right, strict=True)], np.int64)
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(one) for one in sets])
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    product = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    for first in range(0, int(token[-1]) + 1, width):
        start, end = np.searchsorted(token, (first, first + width))
        incidence = np.zeros((len(sets), width), np.float32)
        incidence[owner[start:end], token[start:end] - first] = 1
        product += incidence @ incidence.T
    return product[left, right].astype(np.int64)


def linked(table: pa.Table, floor: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a table of whole buckets that are similar enough, by their shingles."""
    left, right = likely_pairs(table, floor)
    texts = table.column("words")
    run_of = np.searchsorted(run_starts([table.column(key).combine_chunks() for key in KEYS]), left, "right")
    found = []
    for begin, end in zip(*_spans(run_of), strict=True):
        a, b = left[begin:end], right[begin:end]
        rows, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        sets = [shingles(texts[int(row)].as_py()) for row in rows]
        sizes = np.array([len(one) for one in sets])
        at, bt = place[: len(a)], place[len(a) :]
        shared = shared_counts(sets, at, bt)
        union = sizes[at] + sizes[bt] - shared
        similar = shared >= threshold * union - 1e-9
        found.append((a[similar], b[similar]))
    if not found:
        return left[:0], right[:0]
    return tuple(np.concatenate(side) for side in zip(*found, strict=True))


def _spans(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values."""
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, int)
    return starts, np.append(starts[1:], len(values))[: len(starts)]


def roots(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest row that each row is connected to."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _with_partners(floor: int):
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_runs(batches, KEYS):
            left, right = likely_pairs(table, floor)
            rows = pa.array(np.unique(np.concatenate([left, right])))
            yield from table.take(rows).combine_chunks().to_batches()

    return mark


def _links(floor: int, threshold: float):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_runs(batches, KEYS):
            left, right = linked(table, floor, threshold)
            number = np.bincount(np.concatenate([left, right]), minlength=len(table))
            root = roots(len(table), left, right)
            rows = np.flatnonzero(number)
            ids = table.column("words_id")
            columns = [ids.take(pa.array(rows)), ids.take(pa.array(root[rows])), pa.array(number[rows])]
            yield from pa.table(columns, ["words_id", "root", "links"]).combine_chunks().to_batches()

    return count


def similar_texts(
    docs: DataFrame, signed: DataFrame, doc_id: str, text: str, threshold: float, recall: float, deepest: int, small: int, block: int
) -> DataFrame:
    """Links between representatives: a row per representative and bucket where it has any, with
    words_id, root (a representative it is connected to) and links."""
    runs = runs_needed(threshold, recall, deepest)
    floor = sketch_floor(threshold, runs * deepest)
    ends = path_ends(signed, runs, deepest, small)
    placed = written(ends.join(signed, "words_id"), "path-ends")
    slim = meetings(placed.drop("first_id"), block)
    kinds = ", ".join(f"{name} {kind}" for name, kind in slim.dtypes)
    near = slim.repartition(*KEYS).sortWithinPartitions(*KEYS).mapInArrow(_with_partners(floor), kinds)
    near = written(near, "likely")
    wanted = near.select("words_id").distinct().join(signed.select("words_id", "first_id"), "words_id")
    rows = docs.select(F.col(doc_id).alias("first_id"), F.col(text).alias("text"))
    words = rows.join(wanted.select("first_id").distinct(), rows["first_id"].eqNullSafe(wanted["first_id"]), "left_semi")
    words = words.select(words_of("text").alias("words")).select(words_id(F.col("words")).alias("words_id"), "words")
    words = words.join(wanted.select("words_id"), "words_id", "left_semi").dropDuplicates(["words_id"])
    full = near.join(words, "words_id")
    return full.repartition(*KEYS).sortWithinPartitions(*KEYS).mapInArrow(
        _links(floor, threshold), "words_id binary, root binary, links bigint"
    )


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b) as node, component (its smallest node).

    Rounds of large-star and small-star steps: every node's neighbours are hung on the smallest one until
    all hang on the root of their component. Only nodes with edges appear.
    """
    stars = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    while True:
        both = stars.union(stars.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = written(small.union(least).distinct(), "stars")
        inner = stars.select(F.col("u").alias("v")).distinct()
        if stars.join(inner, "v", "left_semi").isEmpty():
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _placed_rows(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    deepest: int = DEEPEST,
    small: int = SMALL,
    block: int = BLOCK,
) -> DataFrame:
    """The rows of `near_classes` with words_id, and keeper: the words_id of the text that stands for the class,
    the first of those that hold its smallest id."""
    choices = runs_needed(threshold, recall, deepest) * deepest
    rows = written(signed_rows(docs, doc_id, text, choices), "signed")
    texts = written(
        rows.groupBy("words_id").agg(
            F.min("doc_id").alias("first_id"),
            F.count(F.lit(1)).alias("n_copies"),
            F.max("signature").alias("signature"),
        ),
        "texts",
    )
    signed = texts.where("signature is not null").select("words_id", "first_id", "signature")
    links = written(similar_texts(docs, signed, doc_id, text, threshold, recall, deepest, small, block), "links")
    found = components(links.select(F.col("words_id").alias("a"), F.col("root").alias("b")))
    total = links.groupBy("words_id").agg(F.sum("links").alias("n_links"))
    known = (
        texts.drop("signature")
        .join(total, "words_id", "left")
        .join(found.withColumnRenamed("node", "words_id"), "words_id", "left")
        .withColumn("component", F.coalesce("component", "words_id"))
    )
    known = written(known, "known-texts")
    first = F.min(F.struct(F.col("first_id").isNull().alias("no_id"), "first_id", "words_id"))
    classes = known.groupBy("component").agg(
        F.min("first_id").alias("class_id"), F.sum("n_copies").alias("class_size"), first["words_id"].alias("keeper")
    )
    of_text = known.join(classes, "component").select(
        "words_id", "class_id", "class_size", F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies", "keeper"
    )
    return rows.select("doc_id", "words_id").join(of_text, "words_id")


def near_classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    deepest: int = DEEPEST,
    small: int = SMALL,
    block: int = BLOCK,
) -> DataFrame:
    """A row per document: doc_id, class_id (smallest id of its class), class_size (documents), n_links
    (different texts it is similar to) and n_copies (documents of equal words, itself included)."""
    return _placed_rows(docs, doc_id, text, threshold, recall, deepest, small, block).drop("words_id", "keeper")


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of `docs` for each class, with all its columns: one of the smallest id, or one without id where
    no row of the class has any. Rows are told apart by id and words, so equal ids share no fate."""
    placed = _placed_rows(docs, doc_id, text).select("doc_id", "words_id", "class_id", "keeper")
    placed = written(placed, "classes")
    stands = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("words_id") == F.col("keeper"))
    gone = placed.where(~stands).select("doc_id", "words_id").distinct()
    rows = docs.select(F.struct("*").alias("_row"), F.col(doc_id).alias("_id"), words_id(words_of(text)).alias("_words"))

    def same(pairs: DataFrame) -> Column:
        return rows["_id"].eqNullSafe(pairs["doc_id"]) & (rows["_words"] == pairs["words_id"])

    stays = rows.join(gone, same(gone), "left_anti")
    repeated = placed.where(stands).groupBy("doc_id", "words_id").count().where("count > 1")
    repeated = written(repeated.select("doc_id", "words_id"), "repeated-rows")
    if not repeated.isEmpty():  # an id on several rows of equal words: one stays, combined before the shuffle
        one = F.min_by("_row", F.to_json("_row")).alias("_row")
        of_many = rows.join(repeated, same(repeated), "left_semi").groupBy("_id", "_words").agg(one)
        stays = stays.join(repeated, same(repeated), "left_anti").select("_row").unionByName(of_many.select("_row"))
    return stays.select("_row.*")
