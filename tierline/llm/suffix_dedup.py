"""Removal of long repeated byte strings by bucket-pointer refinement.

A byte goes if a string of LENGTH bytes that covers it also starts anywhere else, in another document or
in the same one. Strings are put into buckets by a q-gram and refined by the buckets of later offsets: the rank
of 2n bytes at a place is that of the pair of ranks of n bytes there and n bytes further on, so each round
sorts by what the last one found.

Only some places enter buckets. Each string has an anchor, the place within it whose q-gram has the
smallest identifier, so equal strings have equal anchors. Neighbouring strings with one anchor are a block,
and a row of the first bucket table, keyed by the anchor's q-gram:

1. Buckets of one row are done: nothing there repeats. Rows equal in the whole block are done, too: all of
   their strings repeat. This settles the inside of every repeated passage without moving its text.
2. What is left are blocks that share a q-gram but differ, at the ends of passages. The different blocks
   of a bucket fetch their bytes, and the bucket is refined string by string.

Nothing goes by a weak hash. q-grams are hashed to 64 bits, where a collision only joins two buckets; whole
blocks, whose bytes never meet, are told apart by a cryptographic digest of 128 bits of their bytes; ranks in a
bucket start from the bytes themselves and are exact.

Skew: no task gets the rows of a first bucket. Buckets and their kinds of blocks are counted, combined before
the shuffle, and the counts come back to the rows by equality joins, which are broadcast where the counts are
few and split by adaptive execution where a q-gram is frequent. A bucket with more than MOST_BLOCKS different
blocks is not refined in one task; its strings are counted by their digests, combined before the shuffle.

Edge cases: NULL counts as empty; texts below LENGTH bytes lose nothing; repeated rows repeat each other;
texts of one repeated character are handled like any other; very long texts are cut into overlapping slices; an
empty table gives an empty result.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.support import broadcast_if_small, row_key, run_starts, sorted_runs, text_bytes, text_or_empty, written

LENGTH = 200
GRAM = 32
SLICE = 1 << 20  # string starts worked on at a time
PLACE = np.uint64((1 << 22) - 1)  # bits of a key that hold the place within a slice
MOST_BLOCKS = 16_384
BROADCAST_BUCKETS = 100_000
BROADCAST_KINDS = 100_000
ODD = np.uint64(0x9E3779B97F4A7C15)
FACTOR = np.uint64(0xD6E8FEB86659FD93)


def named(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Identifier of a pair of identifiers."""
    x = (x * ODD + y) * FACTOR
    x ^= x >> np.uint64(32)
    x *= FACTOR
    return x ^ (x >> np.uint64(29))


def grams_of(data: np.ndarray) -> np.ndarray:
    """Identifiers of the GRAM bytes (a power of two) at every place of `data`."""
    ids, length = data.astype(np.uint64) + np.uint64(1), 1
    while length < GRAM:
        ids = named(ids[: max(0, len(ids) - length)], ids[length:])
        length *= 2
    return ids


def digests(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """128 bits for each of the strings data[begin:end], as two integers."""
    view = memoryview(np.ascontiguousarray(data))
    found = [hashlib.blake2b(view[a:z], digest_size=16).digest() for a, z in zip(begin.tolist(), end.tolist(), strict=True)]
    return np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` values in a row, from running minima of blocks from either end."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def blocks_of(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> dict[str, np.ndarray]:
    """The blocks of strings that start in [first, last) of each text in `data`: start, strings, gram (identifier), block and more (digest), text (its number)."""
    ids = grams_of(data)
    keys = (ids & ~PLACE) | np.arange(len(ids), dtype=np.uint64)
    smallest = sliding_minimum(keys, LENGTH - GRAM + 1)
    counts = last - first
    text = np.repeat(np.arange(len(first)), counts)
    starts = np.arange(len(text)) + np.repeat(first - np.cumsum(counts) + counts, counts)
    anchor = (smallest[starts] & PLACE).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    strings = np.diff(np.append(begin, len(starts)))
    start, anchor, text = starts[begin], anchor[begin], text[begin]
    block, more = digests(data, start, start + strings + LENGTH - 1).T
    gram = ids[anchor].view(np.int64)
    return {"start": start, "strings": strings, "gram": gram, "block": block, "more": more, "text": text}


def slices(starts: np.ndarray, most: int) -> Iterator[list[tuple[int, int, int]]]:
    """Texts between consecutive `starts` in groups of about `most` string starts: (text, first, last)
    of starts, counted within the text. A longer text is cut."""
    group: list[tuple[int, int, int]] = []
    size = 0
    for text, total in enumerate(np.diff(starts)):
        at, end = 0, int(total) - LENGTH + 1
        while at < end:
            stop = min(end, at + most - size)
            group.append((text, at, stop))
            size += stop - at + LENGTH
            at = stop
            if size >= most:
                yield group
                group, size = [], 0
    if group:
        yield group


BLOCK = "row_id bigint, tag bigint, start int, strings int, gram bigint, block bigint, more bigint"


def _blocks(most: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, starts = text_bytes(batch.column("text"))
            for group in slices(starts, most):
                pieces = [whole[starts[t] + a : starts[t] + z + LENGTH - 1] for t, a, z in group]
                data = np.concatenate([*pieces, np.zeros(256, np.uint8)])
                first = np.cumsum([0] + [len(piece) for piece in pieces])[:-1]
                found = blocks_of(data, first, first + np.array([z - a for _, a, z in group]))
                owner = np.array([t for t, _, _ in group])[found["text"]]
                shift = np.array([a for _, a, _ in group])[found["text"]] - first[found["text"]]
                rows = batch.select(["row_id", "tag"]).take(pa.array(owner))
                columns = [pa.array((found["start"] + shift).astype(np.int32))]
                columns += [pa.array(found["strings"].astype(np.int32))]
                columns += [pa.array(found[name]) for name in ("gram", "block", "more")]
                names = ["row_id", "tag", "start", "strings", "gram", "block", "more"]
                yield pa.record_batch([*rows.columns, *columns], names)

    return cut


def bucketed(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks that repeat as a whole (all their strings go), and blocks that must be refined: one of each kind
    in buckets of several kinds. Blocks alone in their bucket are neither."""
    bounds = [bound(name).alias(f"{bound.__name__}_{name}") for bound in (F.min, F.max) for name in ("block", "more")]
    figures = blocks.groupBy("gram").agg(F.count(F.lit(1)).alias("rows"), *bounds)
    # written: a join right above its side's aggregation is not split where a key is frequent
    several = F.expr("min_block <> max_block or min_more <> max_more").alias("several")
    shared = written(figures.where("rows > 1").select("gram", several), "bucket-figures")
    told = written(blocks.join(shared, "gram"), "shared-grams")
    of_several = told.where("several").drop("several")
    of_kind = [F.first(name).alias(name) for name in ("row_id", "tag", "start", "strings")]
    kinds = of_several.groupBy("gram", "block", "more").agg(F.count(F.lit(1)).alias("rows"), *of_kind)
    kinds = written(kinds, "kinds")
    again = kinds.where("rows > 1").select("gram", "block", "more")
    few = broadcast_if_small(again, BROADCAST_KINDS)
    again = again if few is None else few
    repeats = told.where("not several").drop("several").unionByName(
        of_several.join(again, ["gram", "block", "more"], "left_semi")
    )
    return repeats.select("row_id", "tag", "start", "strings"), kinds.drop("block", "more", "rows")


REFINED = "row_id bigint, tag bigint, start int, strings int, gram bigint, bytes binary"


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the blocks that a text's row lists."""
    names = ["start", "strings", "gram"]
    for batch in batches:
        whole, starts = text_bytes(batch.column("text"))
        asked = batch.column("asked")
        lists = asked.flatten()
        columns = {name: lists.field(name) for name in names}
        owner = np.repeat(np.arange(len(batch)), np.diff(asked.offsets.to_numpy()))
        begin = columns["start"].to_numpy() + starts[owner]
        end = begin + columns["strings"].to_numpy() + LENGTH - 1
        cut = [whole[a:z].tobytes() for a, z in zip(begin, end, strict=True)]
        rows = batch.select(["row_id", "tag"]).take(pa.array(owner))
        out = [*rows.columns, *columns.values(), pa.array(cut, pa.binary())]
        yield pa.record_batch(out, ["row_id", "tag", *names, "bytes"])


def strings_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of the table's blocks end to end, and of each string its place there, its block's row and its
    number within the block."""
    data = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8)
    strings = table.column("strings").to_numpy().astype(np.int64)
    sizes = strings + LENGTH - 1
    first = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(table)), strings)
    number = np.arange(len(row)) - np.repeat(np.cumsum(strings) - strings, strings)
    return data, first[row] + number, row, number


def ranks(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.uint64)


def pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Two ranks, each below 2^32, as one number."""
    return (left << np.uint64(32)) | right


def string_ranks(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A number for each string of LENGTH bytes that starts at `places`: equal for equal bytes only.

    Places are bucketed by their first eight bytes; each round refines the buckets by sorting on those of a
    later offset, as many bytes on as a bucket already has in common.
    """
    if len(places) == 0:
        return np.zeros(0, np.uint64)
    eights = np.lib.stride_tricks.sliding_window_view(data, 8)
    rank, length = ranks(np.ascontiguousarray(eights).view("<u8").ravel()), 8
    while 2 * length <= LENGTH:
        rank = ranks(pairs(rank[:-length], rank[length:]))
        length *= 2
    return pairs(rank[places], rank[places + LENGTH - length])


def runs_of(row: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive strings of a block as (block's row, first string, count)."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (number[1:] != number[:-1] + 1)
    begin = np.flatnonzero(new)
    return row[begin], number[begin], np.diff(np.append(begin, len(row)))


SPAN = "row_id bigint, tag bigint, start int, strings int"


def _spans(table: pa.Table, row: np.ndarray, number: np.ndarray) -> Iterator[pa.RecordBatch]:
    owner, first, count = runs_of(row, number)
    rows = table.select(["row_id", "tag"]).take(pa.array(owner)).combine_chunks()
    start = (table.column("start").to_numpy()[owner] + first).astype(np.int32)
    out = pa.table([*rows.columns, pa.array(start), pa.array(count.astype(np.int32))], ["row_id", "tag", "start", "strings"])
    yield from out.to_batches()


def _refine(most_bytes: int):
    """Spans of strings that occur in several blocks of their bucket, which comes whole."""

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_runs(batches, ["gram"]):
            for part in parts_of(table, most_bytes):
                data, places, row, number = strings_of(part)
                _, at, rows = np.unique(string_ranks(data, places), return_inverse=True, return_counts=True)
                again = rows[at] > 1
                if again.any():
                    yield from _spans(part, row[again], number[again])

    return refine


def parts_of(table: pa.Table, most_bytes: int) -> Iterator[pa.Table]:
    """Whole buckets, about `most_bytes` at a time."""
    starts = run_starts([table.column("gram").combine_chunks()])
    total = np.cumsum(table.column("strings").to_numpy().astype(np.int64) + LENGTH)
    begin = 0
    for start, end in zip(starts, np.append(starts[1:], len(table)), strict=True):
        if total[end - 1] - (total[begin - 1] if begin else 0) >= most_bytes and start > begin:
            yield table.slice(begin, start - begin)
            begin = int(start)
    yield table.slice(begin)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of large buckets' blocks, as digest and place."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        for start in range(0, len(table), 4096):
            part = table.slice(start, 4096)
            data, places, row, number = strings_of(part)
            rows = part.select(["row_id", "tag"]).take(pa.array(row)).combine_chunks()
            place = (part.column("start").to_numpy()[row] + number).astype(np.int32)
            names = digests(data, places, places + LENGTH).T
            out = pa.table([*rows.columns, pa.array(place), *map(pa.array, names)], ["row_id", "tag", "start", "id", "more"])
            yield from out.to_batches()


def keyed_texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id and text with a key for rows of 128 bits: row_id and tag, equal for rows of equal id and text only."""
    body = text_or_empty(text)
    row_id, tag = row_key(F.col(doc_id), body)
    return docs.select(F.col(doc_id).alias("doc_id"), row_id.alias("row_id"), tag.alias("tag"), body.alias("text"))


def repeated_spans(texts: DataFrame) -> DataFrame:
    """Spans of repeated strings in keyed texts: row_id, tag, start, strings. Spans may touch and overlap."""
    long = texts.where(F.octet_length("text") >= LENGTH).select("row_id", "tag", "text")
    spans, asks = bucketed(written(long.mapInArrow(_blocks(SLICE), BLOCK), "blocks"))
    asked = asks.groupBy("row_id", "tag").agg(
        F.collect_set(F.struct("start", "strings", "gram")).alias("asked")
    )
    # texts move once for all buckets; the bytes of the blocks are few
    found = long.join(asked, ["row_id", "tag"]).dropDuplicates(["row_id", "tag"])
    blocks = written(found.mapInArrow(_fetched, REFINED), "block-bytes")
    crowded = blocks.groupBy("gram").count().where(F.col("count") > MOST_BLOCKS).select("gram")
    crowded = written(crowded, "crowded")
    few = blocks
    if not crowded.isEmpty():
        small = broadcast_if_small(crowded, BROADCAST_BUCKETS)
        large = crowded if small is None else small
        few = blocks.join(large, "gram", "left_anti")
        strings = written(
            blocks.join(large, "gram", "left_semi").mapInArrow(
                _listed, "row_id bigint, tag bigint, start int, id bigint, more bigint"
            ),
            "crowded-strings",
        )
        again = strings.groupBy("id", "more").count().where(F.col("count") > 1).select("id", "more")
        again = written(again, "crowded-repeats")
        singles = strings.join(again, ["id", "more"], "left_semi").select("row_id", "tag", "start", F.lit(1).alias("strings"))
        spans = spans.unionByName(singles)
    in_order = few.repartition("gram").sortWithinPartitions("gram")
    spans = spans.unionByName(in_order.mapInArrow(_refine(SLICE), SPAN))
    return spans


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by spans."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    begin = np.flatnonzero(new)
    return start[begin], end[np.append(begin[1:], len(start)) - 1]


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: doc_id, kept (the remaining bytes), removed (spans as arrays of start and end),
    n_bytes, n_removed, n_spans, kept_sha256."""
    texts = keyed_texts(docs, doc_id, text)
    # different spans only, told before they are gathered: an array is bounded by its text, not by its copies
    spans = repeated_spans(texts).distinct()
    per_text = spans.groupBy("row_id", "tag").agg(F.collect_list(F.struct("start", "strings")).alias("spans"))
    found = texts.join(per_text, ["row_id", "tag"], "left").select("doc_id", "text", "spans")
    kinds = "kept binary, removed array<struct<start:bigint,end:bigint>>, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    kind = T.StructType([found.schema["doc_id"], *T.StructType.fromDDL(kinds).fields])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for document, listed in zip(batch.column("text").to_pylist(), batch.column("spans"), strict=True):
                data = document.encode()
                begin = end = np.zeros(0, np.int64)
                if listed.is_valid and len(listed.values):
                    begin = listed.values.field("start").to_numpy().astype(np.int64)
                    end = begin + listed.values.field("strings").to_numpy() + LENGTH - 1
                    begin, end = merged(begin, end)
                edges = np.concatenate([[0], np.column_stack([begin, end]).ravel(), [len(data)]]).tolist()
                kept = b"".join(data[a:z] for a, z in zip(edges[0::2], edges[1::2], strict=True))
                rows.append((kept, begin, end, len(data), len(data) - len(kept), hashlib.sha256(kept).hexdigest()))
            spans_of = [[{"start": a, "end": z} for a, z in zip(r[1].tolist(), r[2].tolist(), strict=True)] for r in rows]
            pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            out = [
                batch.column("doc_id"),
                pa.array([r[0] for r in rows], pa.binary()),
                pa.array(spans_of, pa.list_(pair)),
                *[pa.array([r[i] for r in rows], pa.int64()) for i in (3, 4)],
                pa.array([len(r[1]) for r in rows], pa.int64()),
                pa.array([r[5] for r in rows], pa.string()),
            ]
            names = ["doc_id", "kept", "removed", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.record_batch(out, names)

    return found.mapInArrow(clean, kind)
