"""Harmonic packing of token sequences.

Documents become token ids and are cut into pieces. A piece's class is the number of pieces of its length
that fit a sequence: class j holds lengths in (capacity/(j+1), capacity/j]. Every sequence of class j is
filled with exactly j pieces of that class, so workers need to agree on nothing but where their pieces
start to count.

Cutting makes classes fit: a piece is kept whole if it wastes at most SLACK tokens of its share of a
sequence, else the largest length that fills one more share exactly is cut off and the rest goes on. So a
document has few pieces beyond its full sequences, and full sequences waste next to nothing.

Scale: pieces are numbered within a class by (writing task, place in the task), and the offsets of tasks
come from counts per task and class, a table of tasks x classes. A class that holds most pieces is thus
numbered by all tasks at once. A class leaves at most j-1 pieces over. All leftovers together, fewer than
LEFTOVER_BOUND pieces for any input, are packed by best fit in one task.

Edge cases: NULL text counts as empty; a document always has its end token, so an empty one is a piece of
length 1; repeated rows are documents of their own; very long texts are cut into full sequences; an empty
table gives no pieces.
"""

import os
import re
import unicodedata
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tierline.llm.support import broadcast_if_small, text_or_empty, written

CAPACITY = 2048
END_ID = 1
SLACK = 8
CACHED_WORDS = 1_000_000
PART_BYTES = 2_000_000
ENCODED_WORDS = 8192  # words the tokenizer takes at a time: its results are large
BROADCAST_OFFSETS = 200_000


def leftover_bound(capacity: int = CAPACITY) -> int:
    """Most pieces that classes can leave over."""
    return sum(j - 1 for j in {capacity // length for length in range(1, capacity + 1)})


def cut(tokens: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[int]:
    """Lengths of a document's pieces, in order."""
    pieces = [capacity] * (tokens // capacity)
    left = tokens % capacity
    while left:
        share = capacity // (capacity // left)  # the longest of its class
        piece = left if share - left <= slack else capacity // (capacity // left + 1)
        pieces.append(piece)
        left -= piece
    return pieces


# Below LATIN_END, this module splits and lower-cases as the tokenizer does, character by character; texts
# with anything above go to the tokenizer whole.
LATIN_END = 0x250
_LATIN = [chr(c) for c in range(LATIN_END)]
_LETTERS = re.escape("".join(c for c in _LATIN if unicodedata.category(c)[0] == "L"))
_NUMBERS = re.escape("".join(c for c in _LATIN if unicodedata.category(c)[0] == "N"))
_SPACES = "\t-\r \x85\xa0"
# fixed: the tokenizer's own contractions
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+")
_ABOVE = re.compile(f"[^\\0-{chr(LATIN_END - 1)}]")


class WordIds:
    """Token ids of texts, with the ids of words kept from text to text.

    Gives what the tokenizer gives for the whole text (tests compare), several times faster, because
    words recur. Ids are little-endian 32-bit, as bytes.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"\A(?!)")
        self.words: dict[str, bytes] = {}

    def _encoded(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", one.ids).tobytes() for one in found]

    def ids(self, texts: list[str]) -> list[bytes]:
        split = [None if self._whole(text) else _WORD.findall(text.lower()) for text in texts]
        met = set().union(*(words for words in split if words is not None))
        if len(self.words) + len(met) > CACHED_WORDS:
            self.words.clear()
        new = list(met - self.words.keys())
        for at in range(0, len(new), ENCODED_WORDS):
            some = new[at : at + ENCODED_WORDS]
            self.words.update(zip(some, self._encoded(some), strict=True))
        known = self.words.__getitem__
        return [
            self._encoded([text])[0] if words is None else b"".join(map(known, words))
            for text, words in zip(texts, split, strict=True)
        ]

    def _whole(self, text: str) -> bool:
        above = not text.isascii() and _ABOVE.search(text) is not None
        return above or self.special.search(text) is not None


_loaded: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One per Python worker, which outlives its tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the threads here
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


def parts_of(texts: pa.Array, most_bytes: int = PART_BYTES) -> Iterator[list[str]]:
    """The texts in runs of about `most_bytes`, so that their words fit in memory."""
    part: list[str] = []
    size = 0
    for text in texts:
        part.append(text.as_py())
        size += len(part[-1])
        if size >= most_bytes:
            yield part
            part, size = [], 0
    yield part


def pieces(docs: DataFrame, tokenizer: str, doc_id: str, text: str, capacity: int, with_ids: bool) -> DataFrame:
    """Documents cut into pieces: doc_id, start, length, ids_crc32, doc_tokens, class, task, place and,
    if asked for, ids."""
    kind = dict(docs.select(doc_id).dtypes)[doc_id]
    extra = ", ids array<int>" if with_ids else ""

    def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer)
        end = array("I", [END_ID]).tobytes()
        task = TaskContext.get().partitionId()
        next_place: dict[int, int] = {}
        for batch in batches:
            columns: list[list] = [[] for _ in range(9 if with_ids else 8)]
            documents = (ids for part in parts_of(batch.column(1)) for ids in encoder.ids(part))
            for row, ids in enumerate(documents):
                ids += end
                tokens, start = len(ids) // 4, 0
                for length in cut(tokens, capacity):
                    part = ids[4 * start : 4 * (start + length)]
                    j = capacity // length
                    place = next_place.get(j, 0)
                    next_place[j] = place + 1
                    values = (row, start, length, zlib.crc32(part), tokens, j, task, place, part)
                    for column, value in zip(columns, values):  # ids are held if asked for
                        column.append(value)
                    start += length
            types = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.int64()]
            names = ["start", "length", "ids_crc32", "doc_tokens", "class", "task", "place"]
            arrays = [batch.column(0).take(pa.array(columns[0], pa.int64()))]
            arrays += [pa.array(c, t) for c, t in zip(columns[1:8], types[1:], strict=True)]
            if with_ids:
                ids_of = [memoryview(part).cast("I").tolist() for part in columns[8]]
                arrays.append(pa.array(ids_of, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.record_batch(arrays, ["doc_id", *names])

    texts = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    schema = (
        f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "class int, task int, place bigint"
    )
    return texts.mapInArrow(cut_batches, schema + extra)


def best_fit(lengths: list[int], capacity: int) -> list[int]:
    """Sequence of each length, longest placed first into the fullest sequence that takes it."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    free: list[tuple[int, int]] = []
    found, count = [0] * len(lengths), 0
    for i in order:
        at = bisect_left(free, (lengths[i], -1))
        room, sequence = free.pop(at) if at < len(free) else (capacity, count)
        count += sequence == count
        found[i] = sequence
        insort(free, (room - lengths[i], sequence))
    return found


def pack(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    `tokenizer` is the path of a tokenizer file. `start` counts within the document, `offset` within the
    sequence.
    """
    made = written(pieces(docs, tokenizer, doc_id, text, capacity, with_ids), "pieces")
    per_task = made.groupBy("class", "task").agg(F.count(F.lit(1)).alias("count"))
    earlier = Window.partitionBy("class").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    of_class = per_task.select(
        "class",
        "task",
        F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"),
        F.sum("count").over(Window.partitionBy("class")).alias("in_class"),
    )
    # full sequences of the classes before, a row per class
    classes = per_task.groupBy("class").agg(F.floor(F.sum("count") / F.col("class")).alias("full"))
    lower = Window.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    first = classes.select(
        "class",
        F.coalesce(F.sum("full").over(lower), F.lit(0)).alias("first"),
        F.sum("full").over(Window.partitionBy()).alias("full_sequences"),
    )
    offsets = written(of_class.join(first, "class"), "piece-offsets")
    small = broadcast_if_small(offsets, BROADCAST_OFFSETS)
    numbered = (
        made.join(offsets if small is None else small, ["class", "task"])
        .withColumn("number", F.col("before") + F.col("place"))
        .withColumn("in_full", F.col("number") < F.col("in_class") - F.col("in_class") % F.col("class"))
    )
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    full = numbered.where("in_full").select(
        *kept, (F.col("first") + F.floor(F.col("number") / F.col("class"))).cast("bigint").alias("sequence_id"), "number"
    )
    place = (F.col("class") * F.lit(1 << 40) + F.col("number")).alias("number")
    rest = numbered.where("not in_full").select(*kept, "full_sequences", place)

    def fill(group: pa.Table) -> pa.Table:
        group = group.sort_by("number")
        placed = best_fit(group.column("length").to_pylist(), capacity)
        sequences = pc.add(pa.array(placed, pa.int64()), group.column("full_sequences"))
        return group.drop_columns("full_sequences").append_column("sequence_id", sequences)

    kinds = dict(rest.dtypes) | {"sequence_id": "bigint"}
    names = [*kept, "number", "sequence_id"]
    filled = rest.groupBy("full_sequences").applyInArrow(fill, ", ".join(f"{n} {kinds[n]}" for n in names))
    everything = full.select(*kept, "sequence_id", "number").unionByName(filled)
    earlier = Window.partitionBy("sequence_id").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset")
    return everything.select(*kept, "sequence_id", offset)
