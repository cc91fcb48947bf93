"""Toxicity from confirmed toxic examples and unlabelled text: a non-negative positive-unlabelled risk, in numpy.

With P the confirmed examples, U unlabelled text and the share ``prior`` of toxic text in U, the risk of a classifier is
prior * loss(P as toxic) + max(0, loss(U as clean) - prior * loss(P as clean)): the last difference estimates the loss on
clean text without any clean label, and is kept from going below zero, where it would only reward overfitting.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.arrow import annotate, slices, values

WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5, 6, 7)  # letters: inflected words share what they begin with
LEAST_DOCUMENTS = 6     # a feature counts if so many confirmed toxic documents have it
MOST_FEATURES = 200_000  # of those that pass, the ones with the strongest sign; bounds the model's memory
LEAST_PURITY = 0.4      # estimated share of toxic texts among those that have a feature, over all texts
MOST_POSITIVE = 3_000   # documents to fit on
MOST_UNLABELLED = 8_000
MOST_BROADCAST = 2_000_000  # ids of confirmed documents, 8 bytes each; more are joined by a shuffle
STEPS = 400
RATE = 0.05
DECAY = 1e-4


def features(words: set[str]) -> set[str]:
    """The words themselves and, marked by ``^``, what they begin with."""
    return words | {"^" + w[:n] for w in words for n in BEGINNINGS if len(w) > n}


class Known:
    """Numbers of the known features of texts; a word's are looked up once and kept, up to ``KEPT`` words."""

    KEPT = 300_000

    def __init__(self, number: dict[str, int]):
        self.number, self.of_word = number, {}

    def __call__(self, text: str) -> set[int]:
        words = set(WORD.findall(text.lower()))
        if new := words.difference(self.of_word):
            if len(self.of_word) + len(new) > self.KEPT:
                self.of_word, new = {}, words
            for w in new:
                self.of_word[w] = tuple(self.number[f] for f in features({w}) if f in self.number)
        return set().union(*map(self.of_word.__getitem__, words))


@dataclass
class Classifier:
    """A logistic model on the presence of words and beginnings of words."""

    number: dict[str, int]
    weights: np.ndarray
    bias: float

    def scorer(self):
        known, weights = Known(self.number), self.weights

        def score(texts: list[str]) -> np.ndarray:
            total = [self.bias + weights[sorted(known(t))].sum() for t in texts]
            return 1 / (1 + np.exp(-np.clip(np.array(total, np.float64), -500, 500)))
        return score


def counted(df: DataFrame) -> DataFrame:
    """``feature``, ``p`` and ``u``: of the texts of ``df`` (text, confirmed) how many confirmed and how many in all have it.

    Counted over all texts: each task adds its texts up before the shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, list[int]] = {}
        held: dict[str, list[int]] = {}
        of_word: dict[str, tuple[str, ...]] = {}

        def out() -> pa.RecordBatch:
            both = [held, words]
            return pa.RecordBatch.from_pydict({
                "feature": pa.array([f for x in both for f in x], pa.string()),
                "p": pa.array([n[0] for x in both for n in x.values()], pa.int64()),
                "u": pa.array([n[1] for x in both for n in x.values()], pa.int64())})
        for batch in batches:
            for part in slices(batch, "text"):
                for text, toxic in zip(values(part, "text", ""), part.column("confirmed").to_pylist()):
                    own = set(WORD.findall(text.lower()))
                    begun: set[str] = set()
                    for w in own:
                        if w not in of_word:
                            if len(of_word) > Known.KEPT:
                                of_word = {}
                            of_word[w] = tuple(features({w}) - {w})
                        begun.update(of_word[w])
                    for counts, found in ((words, own), (held, begun)):
                        for f in found:
                            if (n := counts.get(f)) is None:
                                n = counts[f] = [0, 0]
                            n[0] += toxic
                            n[1] += 1
                if len(words) + len(held) > 300_000:
                    yield out()
                    words, held = {}, {}
        yield out()

    return (df.select("text", "confirmed").mapInArrow(run, "feature string, p bigint, u bigint").groupBy("feature")
            .agg(F.sum("p").alias("p"), F.sum("u").alias("u")))


def telling_features(df: DataFrame, prior: float, least: int = LEAST_DOCUMENTS, most: int = MOST_FEATURES) -> list[str]:
    """Features of the texts of ``df`` (text, confirmed) that at least ``least`` confirmed ones have and that are a sign of
    toxic text by the counts of all texts. No more than ``most``, those with the strongest sign; ties in alphabetical order.

    By Bayes, of the texts with a feature prior * P(feature | confirmed) / P(feature | all) are toxic. That share, with one
    clean text more, is the strength of the sign, so few texts count for less than many.
    """
    all_p, all_u = df.agg(F.count(F.when(F.col("confirmed"), 1)), F.count(F.lit(1))).first()
    purity = prior * (F.col("p") / max(1, all_p)) / ((F.col("u") + 1) / max(1, all_u))
    found = counted(df).where(F.col("p") >= least).where(purity >= LEAST_PURITY)
    return [r["feature"] for r in found.orderBy(F.desc(purity), "feature").limit(most).select("feature").collect()]


def present(df: DataFrame, number: dict[str, int]) -> list[np.ndarray]:
    """The numbers of the features that the texts of ``df``, a bounded sample, have."""
    shared = df.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                found = [np.array(sorted(known(t)), "<i4").tobytes() for t in values(part, "text", "")]
                yield pa.RecordBatch.from_pydict({"ids": pa.array(found, pa.binary())})

    rows = df.select("doc_id", "text").orderBy("doc_id").select("text").mapInArrow(run, "ids binary").collect()
    return [np.frombuffer(r["ids"], "<i4") for r in rows]


def fit_weights(positive: list[np.ndarray], unlabelled: list[np.ndarray], size: int, prior: float, steps: int = STEPS,
                rate: float = RATE, decay: float = DECAY) -> tuple[np.ndarray, float]:
    """Full-batch descent (Adam) on the non-negative risk with the logistic loss; deterministic."""
    docs = positive + unlabelled
    n_pos, n_all = len(positive), len(docs)
    doc = np.repeat(np.arange(n_all), [len(d) for d in docs])
    word = np.concatenate(docs) if docs else np.zeros(0, np.int64)
    is_pos = np.arange(n_all) < n_pos
    theta, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    theta[size] = np.log(prior / (1 - prior))
    for step in range(1, steps + 1):
        z = np.bincount(doc, weights=theta[word], minlength=n_all) + theta[size]
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        softplus = np.logaddexp(0, z)
        clean_risk = softplus[~is_pos].mean() - prior * softplus[is_pos].mean()
        if clean_risk >= 0:
            slope = np.where(is_pos, (-prior * (1 - p) - prior * p) / n_pos, p / max(1, n_all - n_pos))
        else:  # step back from where the estimate has gone below zero
            slope = np.where(is_pos, prior * p / n_pos, -p / max(1, n_all - n_pos))
        grad = np.append(np.bincount(word, weights=slope[doc], minlength=size), slope.sum())
        grad[:size] += decay * theta[:size]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return theta[:size], float(theta[size])


def learn(df: DataFrame, toxic: DataFrame, prior: float, least: int = LEAST_DOCUMENTS,
          most_positive: int = MOST_POSITIVE, most_unlabelled: int = MOST_UNLABELLED,
          most_broadcast: int = MOST_BROADCAST) -> Classifier:
    """A classifier from the texts of ``df`` (doc_id, text), of which those whose doc_id is in ``toxic`` are confirmed.

    Features are counted over all confirmed texts and all texts, and those that are no sign of toxic text left out. Weights
    are fitted on at most ``most_positive`` confirmed texts and ``most_unlabelled`` texts of any kind, those first in the
    order of their ids' hashes; that is the only sample.
    Without a confirmed text every score is ``prior``.

    The confirmed ids are counted and broadcast up to ``most_broadcast``, which spares a shuffle of all texts; more are
    joined by one, with the same result.
    """
    ids = toxic.select("doc_id").where("doc_id IS NOT NULL").distinct()
    small = F.broadcast(ids) if ids.count() <= most_broadcast else ids
    prior = min(max(prior, 1e-3), 0.999)
    marked = df.select("doc_id", "text").join(small.withColumn("confirmed", F.lit(True)), "doc_id", "left")
    marked = marked.select("text", F.coalesce("confirmed", F.lit(False)).alias("confirmed"))
    number = {f: i for i, f in enumerate(telling_features(marked, prior, least))}

    def first(rows: DataFrame, n: int) -> DataFrame:
        # At most n ids, a table of known size.
        some = rows.select("doc_id").where("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        return df.select("doc_id", "text").join(F.broadcast(some.distinct()), "doc_id", "left_semi")

    found = present(first(ids, most_positive), number)
    if not found:
        return Classifier({}, np.zeros(0), float(np.log(prior / (1 - prior))))
    rest = present(first(df, most_unlabelled), number)
    weights, bias = fit_weights(found, rest, len(number), prior)
    return Classifier(number, weights, bias)


def score(df: DataFrame, model: Classifier) -> DataFrame:
    """``df`` with ``score``, from 0 to 1, higher for text like the confirmed toxic examples.

    Whole texts, one by one; a null text counts as empty and gets the bias alone. A column of that name is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        scores = shared.value.scorer()
        return lambda part: {"score": scores(values(part, "text", ""))}

    return annotate(df, "text", "score double", make)
