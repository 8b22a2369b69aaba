"""Token counts without token ids.

Pieces are counted once for every distinct pre-token of the corpus; documents are reduced to pre-token
frequencies; the two are joined and summed. No id is ever materialised.

A pre-token is a run of spaces with what follows it up to the next space. No piece of the vocabulary
holds a space behind another character (checked when the model is loaded), so no merge crosses from one
pre-token into the next and their counts add up to the text's.

Scale: pre-tokens are combined per batch before they are shuffled. The most frequent ones, short and at
most HEAD whatever the corpus, go to every task, which settles most of each document where it is read; only
the others, none of them frequent, travel to the join. A long pre-token is an ordinary join key.

Edge cases: NULL text counts as empty and has no tokens; a document of spaces, one pre-token of any length
and control characters are counted as the library does; repeated rows each get their row; an empty table
gives an empty result.
"""

from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.support import row_key, text_or_empty, written

HEAD = 400_000  # pre-tokens sent to every task: below 30 MB at HEAD_LENGTH characters
HEAD_LENGTH = 32
LEVELS = 16  # classes of use per doubling
LIMIT = 4096  # tokens of a document above which it is marked
SPACE = "▁"  # how the model writes a space; the same character in a text counts as one
PRE_TOKEN = regex.compile(f"[ {SPACE}]+[^ {SPACE}]*")


@cache
def load(model: str) -> sentencepiece.SentencePieceProcessor:
    """The model, checked for what splitting relies on."""
    found = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces = (found.id_to_piece(i) for i in range(found.get_piece_size()))
    crossing = [piece for piece in pieces if SPACE in piece.lstrip(SPACE)]
    if crossing:
        raise ValueError(f"pieces that cross pre-tokens: {crossing[:5]}")
    return found


def pre_tokens(text: str) -> list[str]:
    """The text's pre-tokens, each without its first space. The model puts a space before a text."""
    if not text:
        return []
    if "  " in text or SPACE in text or text[0] == " ":
        return [found[1:] for found in PRE_TOKEN.findall(" " + text)]
    return text.split(" ")


def piece_counts(model: sentencepiece.SentencePieceProcessor, found: list[str]) -> list[int]:
    """Pieces of each pre-token. The library gives nothing for "", which stands for a lone space."""
    counts = [len(ids) for ids in model.encode(found, num_threads=1)]
    lone = len(model.encode("a ")) - len(model.encode("a"))
    return [lone if token == "" else count for token, count in zip(found, counts, strict=True)]


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter[str] = Counter()
        for text in batch.column(0).to_pylist():
            counts.update(pre_tokens(text))
        yield pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["token", "uses"])


def pre_token_pieces(texts: DataFrame, model: str) -> DataFrame:
    """Every distinct pre-token of a one-column frame of texts: token, uses, pieces."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = load(model)
        for batch in batches:
            pieces = pa.array(piece_counts(loaded, batch.column(0).to_pylist()), pa.int64())
            yield pa.record_batch([batch.column(0), batch.column(1), pieces], ["token", "uses", "pieces"])

    distinct = texts.mapInArrow(_distinct, "token string, uses bigint")
    summed = distinct.groupBy("token").agg(F.sum("uses").alias("uses"))
    return summed.mapInArrow(counted, "token string, uses bigint, pieces bigint")


def token_counts(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: doc_id, n_bytes, n_tokens."""
    spark = docs.sparkSession
    body = text_or_empty(text)
    pieces = written(pre_token_pieces(docs.select(body.alias("text")), model), "pre-tokens")
    short = pieces.where(F.char_length("token") <= HEAD_LENGTH)
    # a few hundred classes of use tell the cut: whole classes, the most used first, while they fit
    level = F.floor(F.log2("uses") * LEVELS).cast("int")
    room, cut = HEAD, None
    for row in short.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        room -= row["count"]
        if room < 0:
            break
        cut = row["level"]
    head_rows = short.where(F.lit(False) if cut is None else level >= cut).select("token", "pieces").toArrow()
    head = spark.sparkContext.broadcast(head_rows.to_pydict())
    known: dict[str, int] = {}

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per document with the sum over known pre-tokens, and a row per other pre-token."""
        if not known:
            known.update(zip(head.value["token"], head.value["pieces"], strict=True))
        for batch in batches:
            sums, rows, tokens, uses = [], [], [], []
            for row, document in enumerate(batch.column("text").to_pylist()):
                total = 0
                for token, count in Counter(pre_tokens(document)).items():
                    each = known.get(token)
                    if each is None:
                        rows.append(row)
                        tokens.append(token)
                        uses.append(count)
                    else:
                        total += each * count
                sums.append(total)
            keys = batch.select(["high", "low", "doc_id", "n_bytes"])
            # a key that no pre-token has, another for each document
            own = pa.array([f"- {row} {low}" for row, low in enumerate(batch.column("low").to_pylist())])
            names = [*keys.schema.names, "token", "uses", "known"]
            none = pa.nulls(len(sums), pa.int64())
            yield pa.record_batch([*keys.columns, own, none, pa.array(sums, pa.int64())], names)
            rest = keys.take(pa.array(rows, pa.int64()))
            none = pa.nulls(len(rows), pa.int64())
            columns = [pa.array(tokens, pa.string()), pa.array(uses, pa.int64()), none]
            yield pa.record_batch([*rest.columns[:2], none, none, *columns], names)

    high, low = row_key(F.col(doc_id), body)  # rows that repeat an id are told apart by their text
    rows = docs.select(
        high.alias("high"),
        low.alias("low"),
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.octet_length(body).cast("bigint").alias("n_bytes"),
        body.alias("text"),
    )
    kind = "high bigint, low bigint, doc_id bigint, n_bytes bigint, token string, uses bigint, known bigint"
    frequencies = rows.mapInArrow(reduced, kind)
    joined = frequencies.join(pieces.select("token", "pieces"), "token", "left")
    per_text = joined.groupBy("high", "low").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_bytes").alias("n_bytes"),
        F.sum(F.coalesce("known", F.col("uses") * F.col("pieces"))).alias("tokens"),
        F.count("known").alias("rows"),
    )
    # rows equal in id and text are summed together and come apart again
    each = F.explode(F.array_repeat(F.expr("tokens div rows"), F.col("rows").cast("int")))
    return per_text.select("doc_id", "n_bytes", each.alias("n_tokens"))
