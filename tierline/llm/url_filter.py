"""URL filtering by a list of rules, behind a blocked Bloom filter.

A rule is a host, a path and a verdict. It fits a URL whose host is the rule's or a subdomain of it and
whose path starts with the rule's. The key of a rule is host and path put together. Of a URL's host the
suffixes of as many labels as listed hosts have are tried first, against a filter of the listed hosts and then
the hosts themselves; only those that are listed go on, with the path's prefixes of the lengths that occur
under that host. Their keys are probed in the filter of all keys. A key's block of a filter is chosen by one
hash and its bits in it by another; keys that find all their bits set are possible hits and go to an exact
hash join with the list, which drops false positives. Everything is DataFrame functions.

Skew: each distinct pair of host and path is judged once, so a hot URL is one row per task. The verdicts are
written before they meet the rows again, so that adaptive execution can split a hot URL (or all NULL ones)
over tasks there. The filters and the list are broadcast after a check of their rows and bytes; beyond it
a filter is joined by block and the list by key.

Edge cases: a NULL URL or one without `://` has empty host and path, fits no rule and is allowed; of
several fitting rules the longest key wins, then the longer host, then block over allow; repeated URLs get
the same answer; an empty list allows everything; a NULL in a rule makes it fit nothing; URLs and rules may be
of any length; columns of the pages named like those of the result stay apart, within `page`.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.support import broadcast_if_small, written

WORDS = 8  # 64-bit words of a block: one cache line of 512 bits
BITS = 6  # set per key
KEYS_PER_BLOCK = 32  # about 16 bits for each key
BROADCAST_BLOCKS = 100_000  # rows of 72 bytes
BROADCAST_RULES = 100_000
BROADCAST_BYTES = 64 << 20  # of the rules' hosts and paths
OTHERWISE = "allow"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(blocks)).cast("int")


def bits_of(key: Column) -> Column:
    """The key's positions in its block, one taken from each nine bits of a hash."""
    hashed = F.xxhash64(key, F.lit(2))
    return F.array(*[F.shiftrightunsigned(hashed, 9 * i).bitwiseAND(F.lit(511)) for i in range(BITS)])


def _word_masks(bits: Column) -> Column:
    """An array of WORDS longs with the bits set."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(WORDS - 1)),
        lambda word: F.aggregate(
            bits,
            F.lit(0).cast("bigint"),
            lambda mask, bit: F.when(
                F.shiftright(bit, 6) == word,
                mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(F.lit(63)).cast("int"))),
            ).otherwise(mask),
        ),
    )


def bloom_filter(keys: DataFrame, blocks: int, key: str = "key") -> DataFrame:
    """The filter as a row per block that holds anything: block, words."""
    masks = keys.select(block_of(F.col(key), blocks).alias("block"), _word_masks(bits_of(F.col(key))).alias("m"))
    words = [F.bit_or(F.col("m")[i]) for i in range(WORDS)]
    return masks.groupBy("block").agg(F.array(*words).alias("words"))


def possible_hits(candidates: DataFrame, filter_: DataFrame, blocks: int, key: str = "key") -> DataFrame:
    """The candidates whose bits are all set."""
    small = broadcast_if_small(filter_, BROADCAST_BLOCKS)
    probed = candidates.withColumn("block", block_of(F.col(key), blocks)).join(
        filter_ if small is None else small, "block"
    )
    set_ = F.forall(
        bits_of(F.col(key)),
        lambda bit: F.call_function(
            "getbit",
            F.element_at(F.col("words"), (F.shiftright(bit, 6) + 1).cast("int")),
            bit.bitwiseAND(F.lit(63)).cast("int"),
        )
        == 1,
    )
    return probed.where(set_).drop("block", "words")


def listed_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) as rule_host, rule_path, labels, path_length and one verdict, block first."""
    whole = rules.where("host is not null and path is not null and verdict is not null")
    keyed = whole.select(ascii_lower(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    return keyed.groupBy("rule_host", "rule_path").agg(
        F.max("verdict").alias("verdict"),
        F.size(F.split("rule_host", r"\.")).alias("labels"),
        F.char_length("rule_path").alias("path_length"),
    )


def probed(candidates: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The candidates whose `key` a filter of `keys` lets pass."""
    blocks = max(1, -(-keys.count() // KEYS_PER_BLOCK))
    return possible_hits(candidates, written(bloom_filter(keys, blocks, key), "url-bloom"), blocks, key)


def url_verdicts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct (host, path) of `urls` that a rule fits: host, path, rule, verdict."""
    listed = written(listed_rules(rules), "url-rules")
    parts = urls.select("host", "path").distinct()
    # a small number per row; n different ones need a list of n * n / 2 labels
    labels = sorted(row["labels"] for row in listed.select("labels").distinct().collect())
    if not labels:
        return parts.where("false").select("host", "path", F.lit("").alias("rule"), F.lit("").alias("verdict"))
    sizes = F.octet_length("rule_host") + F.octet_length("rule_path")
    count, size = listed.agg(F.count(F.lit(1)), F.sum(sizes)).first()
    few = count <= BROADCAST_RULES and size <= BROADCAST_BYTES

    def exact(side: DataFrame) -> DataFrame:
        return F.broadcast(side) if few else side.hint("shuffle_hash")

    tried = parts.withColumn("host_labels", F.split("host", r"\.")).withColumn(
        "labels", F.explode(F.array(*[F.lit(number) for number in labels]))
    )
    suffix = F.array_join(F.slice("host_labels", -F.col("labels"), F.col("labels")), ".")
    suffixes = tried.where("size(host_labels) >= labels").select("host", "path", suffix.alias("rule_host"))
    under = written(listed.select("rule_host", "path_length").distinct(), "url-hosts")
    hosts = probed(suffixes, under.select("rule_host").distinct(), "rule_host").join(exact(under), "rule_host")
    rule_path = F.substring(F.col("path"), F.lit(1), F.col("path_length"))
    candidates = (
        hosts.where("char_length(path) >= path_length")
        .withColumn("rule_path", rule_path)
        .withColumn("key", F.concat("rule_host", "rule_path"))
    )
    hits = probed(candidates, listed.select(F.concat("rule_host", "rule_path").alias("key")), "key")
    found = hits.join(exact(listed.select("rule_host", "rule_path", "verdict")), ["rule_host", "rule_path"])
    order = F.struct(F.char_length("key"), F.char_length("rule_host"), "verdict")
    best = found.groupBy("host", "path").agg(F.max_by(F.struct("key", "verdict"), order).alias("best"))
    return best.select("host", "path", F.col("best.key").alias("rule"), F.col("best.verdict").alias("verdict"))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """The rows of `pages` as a struct `page`, with host, path, rule (NULL if none fits) and verdict."""
    rows = pages.select(
        F.struct("*").alias("page"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path")
    )
    # written: a join right above its side's aggregation is not split where a URL is frequent
    verdicts = written(url_verdicts(rows, rules), "url-verdicts")
    judged = rows.join(verdicts, ["host", "path"], "left")
    return judged.select(
        "page", "host", "path", "rule", F.coalesce("verdict", F.lit(OTHERWISE)).alias("verdict")
    )


def allowed_pages(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """The pages whose URL is not blocked, with all their columns."""
    return judge_urls(pages, rules, url).where("verdict = 'allow'").select("page.*")
