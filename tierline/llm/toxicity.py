"""Toxicity by weak supervision.

Many weak voters look at a text: lexicon voters fire on a word or on the beginning of a word, pattern
voters on how the text is written. A generative label model takes their votes as noisy signs of a hidden
label, estimates by expectation-maximisation how often each fires for either label, how voters of the same
label hang together, and gives every text a posterior label. A linear classifier is trained on these
posteriors and scores all texts.

Known labels are used to find lexicon candidates, to start the label model and as a weak prior in it.
Candidates are counted over all labelled rows that may teach. The label model and the classifier are fitted
on a bounded sample, SAMPLE of those rows with the smallest hashes of their ids; its votes are all that the
driver sees. Scoring covers every text whole. Labels, ids and other columns are no inputs.

Scale: a scan finds the labelled texts, another the sample, a third scores; up to BROADCAST_LABELS labels
are sent to the texts, beyond that a shuffled join brings them together. Copies of a text and candidates are
combined before the shuffle, so no group can be hot. The lexicon sent to tasks has at most VOTERS entries.

Edge cases: NULL and empty texts have no votes and get the score of a text without any; labels that are
NULL, other than 0 or 1, or without a document teach nothing, and of contradicting labels of one id 1 counts; without
labels of both kinds every score is the share of label 1 (0 without labels); repeated rows get equal
scores; an empty table gives an empty result.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.support import broadcast_if_small, text_or_empty, written

SAMPLE = 20_000  # labelled rows the model is fitted on, at most
BROADCAST_LABELS = 500_000  # labels that may teach: an id and a number each
CANDIDATES = 2048  # words and beginnings that could become lexicon voters
VOTERS = 384  # lexicon voters, at most
CORRELATED = 0.3  # from here on, voters of a label count as related
COVER = 3  # lexicon voters wanted for each text labelled toxic
LEAST_TEXTS = 3  # texts with label 1 that a candidate must occur in
LEAST_LIFT = 4.0  # times as common among label 1 as among label 0
STEMS = (3, 4, 5, 6)  # lengths of word beginnings
HELD_OUT = 2  # remainder by 4 of the id's checksum that never teaches
THRESHOLD = 0.3
CACHED_WORDS = 100_000  # in a task: how each word votes
COUNTED_TEXTS = 4096  # whose units are counted at a time
WORD = re.compile(r"[^\W\d_]+")


def units(word: str) -> set[str]:
    """What a lexicon voter can fire on: the word itself, and its beginnings (marked by a star)."""
    return {word} | {word[:n] + "*" for n in STEMS if len(word) >= n}


def patterns(text: str, words: int) -> tuple[int, ...]:
    """Votes of the pattern voters, 1 or 0."""
    letters = max(1, len(text))
    upper = sum(map(str.isupper, text)) / letters
    marks = text.count("!") + text.count("?")
    second = len(SECOND_PERSON.findall(text))
    return (
        int(upper > 0.3 and letters > 20),
        int("!!" in text or "??" in text),
        int(marks > 2 + words / 50),
        int(second > 1 + words / 30),
        int(STARRED.search(text) is not None),
        int(RUN.search(text) is not None),
    )


SECOND_PERSON = re.compile(r"\b(?:you|your|du|dein|dich|tu|toi|vous|usted|vos)\b", re.IGNORECASE)
STARRED = re.compile(r"\b\w\*{2,}\w?\b")  # masked words
RUN = re.compile(r"(\w)\1{4,}")  # stretched words
PATTERNS = 6


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == HELD_OUT, F.lit(False))


@dataclass
class Voters:
    """Lexicon voters by unit, with how to find their votes in a text."""

    lexicon: list[str]

    @cached_property
    def _number(self) -> dict[str, int]:
        return {unit: number for number, unit in enumerate(self.lexicon)}

    @cached_property
    def _of_word(self) -> dict[str, tuple[int, ...]]:
        return {}

    def votes(self, text: str) -> tuple[set[int], int, tuple[int, ...]]:
        """Lexicon voters that fire, how many words made one fire, and the pattern votes."""
        counts = Counter(WORD.findall(text.lower()))
        fired: set[int] = set()
        hits = 0
        known, number = self._of_word, self._number
        for word, count in counts.items():
            found = known.get(word)
            if found is None:
                found = tuple(number[unit] for unit in units(word) if unit in number)
                if len(known) >= CACHED_WORDS:
                    known.clear()
                known[word] = found
            if found:
                fired.update(found)
                hits += count
        return fired, hits, patterns(text, counts.total())


def _candidates(texts: DataFrame) -> list[str]:
    """Units that are much commoner among label 1, the most telling first. Of different (text, toxic)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (batch.slice(at, COUNTED_TEXTS) for batch in batches for at in range(0, batch.num_rows, COUNTED_TEXTS))
        for part in parts:
            of: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
            for text, toxic in zip(part.column(0), part.column(1).to_pylist(), strict=True):
                found: set[str] = set()
                for word in set(WORD.findall(text.as_py().lower())):
                    found |= units(word)
                of[toxic].update(found)
            names = list(of[0].keys() | of[1].keys())
            columns = [pa.array(names, pa.string())]
            columns += [pa.array([of[label][name] for name in names], pa.int64()) for label in (1, 0)]
            yield pa.record_batch(columns, ["unit", "toxic", "clean"])

    totals = texts.agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("all")).first()
    toxic, clean = totals["toxic"] or 0, (totals["all"] or 0) - (totals["toxic"] or 0)
    if not (toxic and clean):
        return []
    counted = texts.mapInArrow(count, "unit string, toxic bigint, clean bigint")
    summed = counted.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    lift = (F.col("toxic") / toxic) / ((F.col("clean") + 0.5) / clean)
    telling = summed.withColumn("lift", lift).where(
        (F.col("toxic") >= min(LEAST_TEXTS, toxic)) & (F.col("lift") >= LEAST_LIFT)
    )
    ordered = telling.orderBy(F.desc(F.col("toxic") * F.log("lift")), "unit").limit(CANDIDATES)
    return [row["unit"] for row in ordered.select("unit").collect()]


def _votes_of_sample(sample: DataFrame, lexicon: list[str]) -> tuple[np.ndarray, ...]:
    """Labels and votes of the sample: label, lexicon votes (rows x voters), hits, pattern votes."""
    voters = Voters(lexicon)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [voters.votes(text) for text in batch.column(0).to_pylist()]
            columns = [
                batch.column(1).cast(pa.int64()),
                pa.array([sorted(fired) for fired, _, _ in found], pa.list_(pa.int32())),
                pa.array([hits for _, hits, _ in found], pa.int64()),
                pa.array([list(pattern) for _, _, pattern in found], pa.list_(pa.int32())),
            ]
            yield pa.record_batch(columns, ["toxic", "fired", "hits", "pattern"])

    kind = "toxic bigint, fired array<int>, hits bigint, pattern array<int>"
    rows = sample.select("text", "toxic").mapInArrow(vote, kind).toArrow()
    votes = np.zeros((len(rows), len(lexicon)), bool)
    for row, fired in enumerate(rows.column("fired").to_pylist()):
        votes[row, fired] = True
    pattern = np.array(rows.column("pattern").to_pylist(), bool).reshape(len(rows), PATTERNS)
    return rows.column("toxic").to_numpy(), votes, rows.column("hits").to_numpy(), pattern


def choose_voters(labels: np.ndarray, votes: np.ndarray, most: int = VOTERS, cover: int = COVER) -> list[int]:
    """Candidates that together cover the texts of label 1 several times, fewest first.

    The next voter is the one that fires on most texts still short of cover, less those of label 0.
    """
    toxic = votes[labels == 1].astype(np.float32)
    clean = votes[labels == 0].sum(0)
    short = np.full(len(toxic), cover, np.float32)
    chosen: list[int] = []
    while len(chosen) < most:
        gain = (short > 0).astype(np.float32) @ toxic - 2.0 * clean
        gain[chosen] = -np.inf
        best = int(gain.argmax())
        if gain[best] <= 0:
            break
        chosen.append(best)
        short -= toxic[:, best]
    return chosen


def label_model(labels: np.ndarray, votes: np.ndarray, rounds: int = 20, prior: float = 1.0) -> np.ndarray:
    """Posterior probability of label 1 for every row of a vote matrix (True: fires, False: abstains).

    Rates at which a voter fires for either hidden label start from the known labels, which stay in as
    `prior` of a row each, and are refined from the posteriors. Voters that hang together more than the
    label explains share their weight: one that fires counts by the sum of its correlations with those
    that fire beside it, one that abstains by the sum over all.
    """
    x = votes.astype(np.float32)
    posterior = labels.astype(np.float64) * 0.9 + 0.05
    for _ in range(rounds):
        soft = (posterior + prior * labels) / (1 + prior)
        share = soft.mean().clip(1e-4, 1 - 1e-4)
        rates, spread = [], np.zeros((x.shape[1], x.shape[1]), np.float32)
        for weight in (soft.astype(np.float32), (1 - soft).astype(np.float32)):
            rate = ((weight @ x + 0.1) / (weight.sum() + 0.2)).clip(1e-6, 1 - 1e-6)
            rates.append(rate)
            spread += (x * weight[:, None]).T @ x - weight.sum() * np.outer(rate, rate)
        scale = np.sqrt(np.diag(spread).clip(1e-9))
        together = (spread / np.outer(scale, scale)).clip(0, 1)
        together[together < CORRELATED] = 0  # chance, and that long texts have more of everything
        fires = ((x * np.log(rates[0] / rates[1])) / (x @ together).clip(1)).sum(1)
        abstains = (1 - x) @ (np.log((1 - rates[0]) / (1 - rates[1])) / together.sum(1).clip(1))
        logit = np.log(share / (1 - share)) + fires + abstains
        posterior = 1 / (1 + np.exp(-logit.clip(-30, 30)))
    return posterior


def features(votes: np.ndarray, hits: np.ndarray, pattern: np.ndarray) -> np.ndarray:
    """Inputs of the classifier: the votes, whether and how often the lexicon fires, the patterns."""
    return np.column_stack([votes, votes.any(1), np.log1p(hits), pattern]).astype(np.float32)


def train_linear(x: np.ndarray, target: np.ndarray, steps: int = 25, ridge: float = 0.5) -> np.ndarray:
    """Logistic regression on soft targets by Newton steps; the last weight is the intercept."""
    x = np.column_stack([x, np.ones(len(x), x.dtype)])
    weights = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ weights).clip(-30, 30)))
        gradient = x.T @ (p - target) + penalty * weights
        curvature = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curvature, gradient)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return weights


@dataclass
class ToxicityModel:
    """A lexicon and the linear classifier over its votes."""

    lexicon: list[str]
    weights: list[float]

    def score(self, votes: tuple[set[int], int, tuple[int, ...]]) -> float:
        fired, hits, pattern = votes
        n = len(self.lexicon)
        logit = self.weights[-1] + sum(self.weights[i] for i in fired)
        logit += self.weights[n] * bool(fired) + self.weights[n + 1] * math.log1p(hits)
        logit += sum(w for w, fires in zip(self.weights[n + 2 : -1], pattern, strict=True) if fires)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE
) -> ToxicityModel:
    """A model from labels (doc_id, toxic) of documents that are not held out."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    one_each = usable.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("bigint").alias("toxic"))
    one_each = written(one_each, "toxicity-labels")
    ids = written(one_each.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows), "toxicity-ids")
    texts = docs.select(F.col(doc_id).alias("_id"), text_or_empty(text).alias("text"))
    few = broadcast_if_small(one_each, BROADCAST_LABELS)
    labelled = texts.join(one_each if few is None else few, "_id").select("text", "toxic")
    candidates = _candidates(written(labelled.distinct(), "toxicity-texts"))  # copies of a text teach once
    # of an id on several rows one text teaches, combined before the shuffle: at most a row per sampled id
    one_text = texts.join(F.broadcast(ids), "_id").groupBy("_id").agg(
        F.min(F.struct(F.sha2("text", 256), "text")).alias("least"), F.max("toxic").alias("toxic")
    )
    sample = written(one_text.select("least.text", "toxic"), "toxicity-sample")
    if not candidates:
        known = sample.agg(F.avg("toxic")).first()[0] or 0.0
        share = min(max(float(known), 1e-12), 1 - 1e-12)
        return ToxicityModel([], [0.0] * (2 + PATTERNS) + [math.log(share / (1 - share))])
    known, votes, _, _ = _votes_of_sample(sample, candidates)
    lexicon = [candidates[i] for i in choose_voters(known, votes)]
    known, votes, hits, pattern = _votes_of_sample(sample, lexicon)
    posterior = label_model(known, np.column_stack([votes, pattern]))
    weights = train_linear(features(votes, hits, pattern), posterior)
    return ToxicityModel(lexicon, weights.tolist())


def toxicity_scores(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """The rows of `docs` as a struct `doc`, each with its score."""
    voters = Voters(model.lexicon)
    row = docs.select(F.struct("*").alias("doc"), text_or_empty(text).alias("text"))

    def score(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts:
            scores = [model.score(voters.votes(one.as_py())) for one in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(scores, pa.float64())], ["doc", "score"])

    return row.mapInArrow(score, T.StructType([row.schema["doc"], T.StructField("score", T.DoubleType())]))


def non_toxic(docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that score below the threshold, with all their columns."""
    return toxicity_scores(docs, model, text).where(F.col("score") < threshold).select("doc.*")
