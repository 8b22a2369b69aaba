"""Mixing sources to target weights.

Sizes are summed per source, a repetition rate is derived for each source, and every document is
emitted floor(rate) times plus once more with probability equal to the fraction. The draw is a hash
of the document's id, so reruns and retried tasks agree. DataFrame functions only.

Skew: sums are combined before the shuffle. The table of rates has a row per source; it is broadcast
after a check of its size, and beyond that joined with the documents under a salted key, so a hot
source is dealt over many tasks. Sources are numbered, and their sizes and weights summed up, range by range;
the driver sees two totals and the level.

Edge cases: a NULL text has size 0; a NULL source is a source of its own and comes last; documents of
size 0 follow their source's rate; a source of size 0 has target 0 and rate 0; repeated rows are drawn
as one; documents without an id are drawn by their content; very long texts are counted in place, once;
extra columns of any name and type are kept in a struct of their own; an empty table gives an empty mix.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.support import broadcast_if_small, running_sums, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5  # of all sizes
CAP = 2.0  # times its own size, for any source
SEED = 20_240_229
BROADCAST_SOURCES = 20_000  # rows of the rate table: a name and three numbers each
SALTS = 64


def word_count(text: Column) -> Column:
    """Number of words (runs of anything but ASCII white space); 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_rates(
    sized: DataFrame,
    source: str = "source",
    size: str = "size",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
) -> DataFrame:
    """A row per source: source, source_size, target and rate (target over size).

    Sources in code point order, NULL last, take the weights in turn. They share `share` times all
    sizes by weight; none gets more than `cap` times its own size, and what it can't take is shared
    again. With sources ordered by the level (target over weight) at which they stop, those that stop
    come first, so the level of the rest follows from running sums.
    """
    totals = sized.groupBy(F.col(source).cast("string").alias("source")).agg(
        F.sum(size).cast("bigint").alias("source_size")
    )
    counted = totals.select(F.col("source").isNull().alias("none"), "*", F.lit(1).alias("one"))
    in_turn = running_sums(written(counted, "mix-totals"), ["none", "source"], ["one"], "mix-in-turn")
    turn = F.col("before_one") % len(weights) + 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int"))
    weighed = in_turn.withColumn("weight", weight).withColumn("most", cap * F.col("source_size"))
    stops = weighed.withColumn("stop", F.col("most") / F.col("weight"))
    stops = running_sums(stops, ["stop", "none", "source"], ["most", "weight"], "mix-stops")
    whole = stops.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    left = F.lit(share * (whole["size"] or 0)) - F.col("before_most")
    open_weight = F.lit(whole["weight"] or 0.0) - F.col("before_weight")
    levels = stops.select("stop", (left / open_weight).alias("level")).where("level <= stop")
    first_open = levels.agg(F.min(F.struct("stop", "level")).alias("least")).first()["least"]
    target = F.col("most")
    if first_open is not None:  # else every source stops at its cap
        is_open = F.col("stop") >= first_open["stop"]
        target = F.when(is_open, F.col("weight") * first_open["level"]).otherwise(target)
    return stops.select(
        "source",
        "source_size",
        target.alias("target"),
        F.when(F.col("source_size") > 0, F.least(target / F.col("source_size"), F.lit(cap)))
        .otherwise(F.lit(0.0))
        .alias("rate"),
    )


def copies(rate: Column, doc_id: Column, content: Column, seed: int = SEED) -> Column:
    """How often a document is emitted: floor(rate), plus one by its own draw."""
    drawn = F.xxhash64(F.lit(seed), doc_id.cast("string"), F.when(doc_id.isNull(), content.cast("string")))
    uniform = drawn.bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))
    whole = F.floor(rate)
    return (whole + F.when(uniform < rate - whole, 1).otherwise(0)).cast("bigint")


def with_rates(rows: DataFrame, rates: DataFrame, salt: Column, source: str = "source") -> DataFrame:
    """`rows` with their source's figures as a struct column `_rate`.

    Beyond BROADCAST_SOURCES sources the rates are repeated for every salt, and the rows of a source
    are dealt over the salts.
    """
    figures = rates.select(F.struct("*").alias("_rate"))
    same = rows[source].cast("string").eqNullSafe(F.col("_rate.source"))
    small = broadcast_if_small(figures, BROADCAST_SOURCES)
    if small is not None:
        return rows.join(small, same, "left")
    salted = figures.withColumn("_side", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(SALTS)).cast("int"))
    same = dealt[source].cast("string").eqNullSafe(F.col("_rate.source"))
    return dealt.join(salted, same & (F.col("_salt") == F.col("_side")), "left").drop("_salt", "_side")


def mixed_sizes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED
) -> DataFrame:
    """What the mix takes of every document, without moving texts: doc_id, source, size, copies,
    source_size, target, rate."""
    sized = written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            word_count(F.col(text)).alias("size"),
            F.when(F.col(doc_id).isNull(), F.xxhash64(text)).alias("content"),
        ),
        "mix-sizes",
    )
    rates = written(source_rates(sized), "mix-rates")
    rated = with_rates(sized, rates, F.col("doc_id").cast("string"))
    return rated.select(
        "doc_id",
        "source",
        "size",
        copies(F.col("_rate.rate"), F.col("doc_id"), F.col("content"), seed).alias("copies"),
        F.col("_rate.source_size").alias("source_size"),
        F.col("_rate.target").alias("target"),
        F.col("_rate.rate").alias("rate"),
    )


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED
) -> DataFrame:
    """The mix itself: the rows of `docs`, all their columns, each as often as it is taken."""
    sized = docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    rates = written(source_rates(sized), "mix-rates")
    rows = docs.select(
        F.struct("*").alias("_row"),
        F.col(source).cast("string").alias("_source"),
        F.col(doc_id).alias("_id"),
        F.when(F.col(doc_id).isNull(), F.xxhash64(text)).alias("_content"),
    )
    rated = with_rates(rows, rates, F.coalesce(F.col("_id").cast("string"), F.col("_content").cast("string")), "_source")
    times = copies(F.col("_rate.rate"), F.col("_id"), F.col("_content"), seed)
    repeated = rated.select("_row", F.explode(F.array_repeat(F.lit(0), times.cast("int"))))
    return repeated.select("_row.*")
