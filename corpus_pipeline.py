"""A training corpus from the table of documents, in five stages.

Each stage takes what its predecessor kept, as Parquet that was written and read again, and all but the last
return rows of documents with their columns. Toxic documents go; of equal texts one stays; of each
class of similar texts one stays; sources are mixed to their target weights, which repeats and drops
documents; what is left is packed into sequences. `run` removes a stage's input and intermediate files as soon
as the stage's result is written.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tierline.llm.chosen_path import near_dedup
from tierline.llm.exact_dedup import exact_dedup
from tierline.llm.mixing import mix
from tierline.llm.packing import pack
from tierline.llm.support import settled
from tierline.llm.toxicity import fit, non_toxic

TOKENIZER = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return non_toxic(docs, fit(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# the linear classifier, the hash of the draw and the tokenizer have no SQL form
ORACLE_SQL = None


def kept_by(spark: SparkSession, sf_dir: str, stages: list) -> DataFrame:
    """What the stages keep of the documents; of the files they wrote, only this result is left."""
    if not stages:
        return spark.read.parquet(f"{sf_dir}/documents.parquet")
    *earlier, (name, stage) = stages
    return settled(spark, f"stage-{name}", lambda: stage(spark, kept_by(spark, sf_dir, earlier), sf_dir))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the whole table of documents to packed pieces."""
    return STAGES[-1][1](spark, kept_by(spark, sf_dir, STAGES[:-1]), sf_dir)
