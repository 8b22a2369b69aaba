"""A query per operator, with production parameters, over its whole table."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.chosen_path import near_classes
from tierline.llm.exact_dedup import exact_groups
from tierline.llm.mixing import mixed_sizes
from tierline.llm.merkle import digest, folded, manifest, siblings
from tierline.llm.multi_index import near_vectors
from tierline.llm.packing import pack
from tierline.llm.preference import TRAINED_ROLE, format_preferences
from tierline.llm.suffix_dedup import without_repeats
from tierline.llm.support import numbered, written
from tierline.llm.toxicity import THRESHOLD, fit, is_held_out, toxicity_scores
from tierline.llm.token_counts import LIMIT, token_counts
from tierline.llm.turn_repair import damaged, repaired
from tierline.llm.url_filter import judge_urls
from tierline.llm.vantage import nearest

Query = Callable[[SparkSession, str], DataFrame]

# the list the pages are judged by (fixed by the query's contract)
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


NEIGHBOURS = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_vantage_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), NEIGHBOURS)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixed_sizes(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
        "rate",
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = judge_urls(table(spark, sf_dir, "pages"), rules)
    return judged.select("page.page_id", "host", "path", "rule", "verdict")


def mismatched_replies(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns of every conversation: up to its last reply, and the same with the last reply of
    the next conversation by id that has one (none after the last). A conversation without a reply is on
    both sides as it is, so that its row has a prompt and no completions."""
    reply = turns.where(F.col("role") == TRAINED_ROLE).groupBy("conv_id").agg(
        F.max(F.struct("turn", "text")).alias("last")
    )
    reply = written(reply, "last-replies")
    in_order = numbered(reply.select(F.lit(0).alias("all"), "conv_id"), ["all"], ["conv_id"], "replying")
    in_order = written(in_order.select("conv_id", "place"), "replying-in-order")
    before = in_order.select(F.col("conv_id").alias("pair_id"), (F.col("place") + 1).alias("place"))
    following = before.join(in_order, "place").join(reply, "conv_id")
    own = reply.select(F.col("conv_id").alias("pair_id"), F.col("last.turn").alias("turn"))
    other = following.select("pair_id", F.col("last.text").alias("text")).join(own, "pair_id")
    other = other.select("pair_id", "turn", F.lit(TRAINED_ROLE).alias("role"), "text")
    columns = [F.col("conv_id").alias("pair_id"), "turn", "role", "text"]
    ended = turns.join(reply.select("conv_id", F.col("last.turn").alias("end")), "conv_id", "left")
    chosen = ended.where("end is null or turn <= end").select(columns)
    return chosen, ended.where("end is null or turn < end").select(columns).unionByName(other)


def op5_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen, rejected = mismatched_replies(table(spark, sf_dir, "conversations"))
    return format_preferences(chosen, rejected)


def op6_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack(table(spark, sf_dir, "documents"), tokenizer)


def op7_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = without_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity_scores(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc.doc_id",
        is_held_out(F.col("doc.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    text = F.col("text")
    hit = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & text.contains("\n")
    altered = F.when(hit, digest(*fields, F.replace(text, F.lit("\n"), F.lit("")))).alias("altered")
    found = manifest(docs.select("doc_id", "source", digest(*fields, text).alias("leaf"), altered))
    again = found.withColumn("folded_root", folded(F.coalesce("altered", "leaf"), F.col("proof")))
    return again.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return repaired(damaged(turns), turns)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_vantage_points,
        op2_mixing,
        op3_exact_dedup,
        op4_url_filter,
        op5_preference_pairs,
        op6_harmonic_packing,
        op7_chosen_path,
        op8_suffix_dedup,
        op9_toxicity,
        op10_token_counts,
        op11_merkle_manifest,
        op12_multi_index,
        op13_turn_repair,
    )
}
