"""Toxicity by a factorization machine over hashed terms.

The score of a text is a bias, a weight for each term it holds and, for every pair of terms,
the inner product of their factors: an insult next to a mention of a group can weigh more
than both alone. All pairs cost no more than the terms, since the sum over pairs is half the
squared sum of the factors less the sum of their squares.

The machine is fitted on a bounded sample of labelled texts. Terms are words and beginnings of
words, hashed to buckets; the buckets whose presence tells most about the label in the sample become the features, and
frequent ones that tell something only next to another. That leaves out the mass of terms that occur once.
Scoring reads whole texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.frames import crc_mod, pick, text_bytes
from assayer.sources.scratch import Scratch

SAMPLE = 6000  # labelled rows of each class, at most
BUCKETS = 1 << 20
FEATURES = 2048
FREQUENT = 512  # terms whose pairs are looked at
PAIRED = 256  # of these, features for the sake of their pairs, at most
LEAST = 5  # rows of the sample with a term
ALONE = 8  # log-likelihood ratio of a term by itself
CHANCE = 6  # that of a pair, beyond the logarithm of the number of pairs
FACTORS = 8
BEGINS = (4, 5, 6)
MOST_WORDS = 500_000
_WORD = re.compile(r"\w+")


def words(text: bytes) -> set[str]:
    return set(_WORD.findall(text.decode("utf-8", "replace").lower()))


def buckets(word: str) -> list[int]:
    """The bucket of a word and those of its beginnings, which its inflected forms share."""
    begins = [f"{word[:n]}-" for n in BEGINS if len(word) > n]
    return [zlib.crc32(term.encode()) % BUCKETS for term in (word, *begins)]


def terms(text: bytes) -> set[int]:
    return {bucket for word in words(text) for bucket in buckets(word)}


@dataclass
class Machine:
    """``place`` maps a bucket to its feature; ``bias``, ``weights`` and ``factors`` are the machine's."""

    place: dict[int, int]
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, features: list[int]) -> float:
        rows_ = self.factors[features]
        total = rows_.sum(axis=0)
        logit = self.bias + self.weights[features].sum() + 0.5 * float((total**2 - (rows_**2).sum(axis=0)).sum())
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))

    def score_text(self, text: bytes, known: dict[str, tuple[int, ...]]) -> float:
        """``known`` keeps the features of words already seen; most words have none."""
        found: set[int] = set()
        if len(known) > MOST_WORDS:
            known.clear()
        for word in words(text):
            features = known.get(word)
            if features is None:
                features = known[word] = tuple(f for b in buckets(word) if (f := self.place.get(b)) is not None)
            found.update(features)
        return self.score(sorted(found))


def ratio(toxic: Column, clean: Column, n1: int, n0: int) -> Column:
    """The log-likelihood ratio between a term's presence and the label, from the rows that hold it."""
    n, seen = n1 + n0, toxic + clean

    def part(observed: Column, expected: Column) -> Column:
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    held = part(toxic, seen * (n1 / n)) + part(clean, seen * (n0 / n))
    return held + part(n1 - toxic, (n - seen) * (n1 / n)) + part(n0 - clean, (n - seen) * (n0 / n))


def candidates(learned: DataFrame, features: int = FEATURES, frequent: int = FREQUENT) -> tuple[list[int], list[int]]:
    """Terms of ``learned(terms, toxic)`` that tell of the label by themselves, and those present and absent most often."""
    sizes = dict(learned.groupBy("toxic").count().collect())
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return [], []
    counted = learned.select(F.explode("terms").alias("term"), "toxic").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")
    )
    seen = F.col("toxic") + F.col("clean")
    counted = counted.where(seen >= LEAST).select(
        "term", ratio(F.col("toxic"), F.col("clean"), n1, n0).alias("ratio"), F.least(seen, n1 + n0 - seen).alias("spread")
    )
    counted = Scratch(learned.sparkSession).stage(counted, "counted")
    alone = counted.where(F.col("ratio") > ALONE).orderBy(F.desc("ratio"), "term").limit(features)
    often = counted.where(F.col("spread") >= LEAST).orderBy(F.desc("spread"), "term").limit(frequent)
    return [r["term"] for r in alone.collect()], [r["term"] for r in often.collect()]


def presence(documents: list[np.ndarray], chosen: list[int]) -> np.ndarray:
    """A row for each document, with 1 where it holds a chosen term."""
    place = {term: i for i, term in enumerate(chosen)}
    x = np.zeros((len(documents), len(chosen)), np.float32)
    for i, held in enumerate(documents):
        x[i, [place[t] for t in held.tolist() if t in place]] = 1
    return x


def _told(toxic: np.ndarray, all_toxic: np.ndarray, clean: np.ndarray, all_clean: np.ndarray) -> np.ndarray:
    """Log-likelihood ratios between presence and label, from the rows with a term and all rows of each label."""
    out = np.zeros(toxic.shape)
    seen, n = toxic + clean, np.maximum(all_toxic + all_clean, 1)
    for held, every in ((toxic, all_toxic), (clean, all_clean)):
        for observed, column in ((held, seen), (every - held, n - seen)):
            expected = column * (every / n)
            out += observed * np.log(np.maximum(observed, 1e-9) / np.maximum(expected, 1e-9))
    return out


def add_pairs(documents: list[np.ndarray], labels: np.ndarray, alone: list[int], often: list[int], most: int = PAIRED) -> list[int]:
    """``alone``, and up to ``most`` terms that tell of the label only next to another term, or next to its absence.

    Of each frequent term the log-likelihood ratio with the label is taken apart for the documents
    with and without a partner. Chance reaches a ratio of r in a share exp(-r) of the pairs, so what is asked for grows
    with their number. The partner becomes a feature too.
    """
    rest = sorted(set(often) - set(alone))
    partners = alone + rest
    if not rest:
        return alone
    x, toxic = presence(documents, partners), labels.astype(bool)
    with_partner, without = [], []  # rows with the term and all rows, of the toxic ones and of the others
    for rows_ in (x[toxic], x[~toxic]):
        held = rows_[:, len(alone) :]
        both, partner, term = held.T @ rows_, rows_.sum(axis=0)[None, :], held.sum(axis=0)[:, None]
        with_partner += [both, partner]
        without += [term - both, len(rows_) - partner]
    told = _told(*with_partner) + _told(*without)
    own = np.arange(len(rest))
    told[own, len(alone) + own] = 0  # a term is no partner of itself
    best = told.argmax(axis=1)
    value = told[own, best]
    asked = CHANCE + np.log(told.size)
    added: list[int] = []
    for i in np.argsort(-value, kind="stable").tolist():
        if value[i] <= asked or len(added) >= most:
            break
        added += [t for t in (rest[i], partners[int(best[i])]) if t not in added and t not in alone]
    return alone + added


def fit(
    documents: list[np.ndarray],
    labels: np.ndarray,
    chosen: list[int],
    factors: int = FACTORS,
    epochs: int = 60,
    says: np.ndarray | None = None,
) -> Machine:
    """Log-loss with Adagrad on mini-batches, with weight decay; the bias absorbs the share of the classes.

    ``documents`` are arrays of terms, of which the ``chosen`` ones become features; ``says`` weighs the documents: how many labelled ones each stands for.
    """
    says = np.ones(len(labels)) if says is None or not len(says) else says / says.mean()
    place = {bucket: i for i, bucket in enumerate(chosen)}
    rate = min(max(float((says * labels).mean()) if len(labels) else 0.0, 1e-3), 1 - 1e-3)
    rng = np.random.default_rng(7)
    bias, weights = float(np.log(rate / (1 - rate))), np.zeros(len(chosen))
    machine = Machine(place, bias, weights, rng.normal(0, 0.01, (len(chosen), factors)))
    if not chosen:
        return machine
    x = presence(documents, chosen)
    squares = [1e-6, np.full(len(chosen), 1e-6), np.full((len(chosen), factors), 1e-6)]
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
            xb, yb, say = x[part], labels[part], says[part]
            total = xb @ machine.factors
            pairs = 0.5 * (total**2 - xb @ machine.factors**2).sum(axis=1)
            logit = np.clip(machine.bias + xb @ machine.weights + pairs, -30, 30)
            error = say * (1 / (1 + np.exp(-logit)) - yb) / len(part)
            steps = [
                float(error.sum()),
                xb.T @ error + 1e-5 * machine.weights,
                xb.T @ (error[:, None] * total) - machine.factors * (xb.T @ error)[:, None] + 1e-4 * machine.factors,
            ]
            squares = [s + g**2 for s, g in zip(squares, steps)]
            moves = [0.2 * g / np.sqrt(s) for s, g in zip(squares, steps)]
            machine.bias -= moves[0]
            machine.weights -= moves[1]
            machine.factors -= 0.1 * moves[2]
    return machine


def sample(docs: DataFrame, labels: DataFrame, most: int) -> tuple[DataFrame, dict[int, float]]:
    """``id, toxic, content, terms`` of up to ``most`` labelled training rows of each class, by hash of the id, and the
    weight of each class.

    A row weighs as many labels of its class as there are for each one taken, so that the weighted
    classes have the shares of all usable labels, whatever ``most`` is. The ids are chosen before the texts are touched, so that the texts of the sample alone are joined.
    Repeated rows of one id and text are taken once.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    usable = pick(labels, "doc_id", "toxic").select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int"))
    usable = usable.where("id is not null and toxic in (0, 1)").where(crc_mod(F.col("id"), 5) != 0)
    counts = dict(usable.groupBy("toxic").count().collect())
    chosen = None
    for label in (0, 1):
        part = usable.where(F.col("toxic") == label).orderBy(F.xxhash64("id"), "id").limit(most)
        chosen = part if chosen is None else chosen.union(part)
    chosen = scratch.stage(chosen, "chosen")
    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), text_bytes(F.col("text")).alias("text"))
    # ``chosen`` has 2 * most rows of two numbers at most.
    joined = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select(
        "doc_id", "toxic", F.xxhash64("text").alias("content"), "text"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [sorted(terms(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "toxic", "content")), pa.array(held, pa.list_(pa.int32()))],
                ["id", "toxic", "content", "terms"],
            )

    found = joined.mapInArrow(run, "id long, toxic int, content long, terms array<int>")
    found = scratch.stage(found, "found")
    # Ids that repeat with other texts can be more than the ids chosen. The first rows by hash are 2 * most keys.
    key = ["id", "toxic", "content"]
    first = found.select(*key).distinct().orderBy(F.xxhash64("id"), *key).limit(2 * most)
    learned = found.join(F.broadcast(first), key, "left_semi").dropDuplicates(key)
    says = {label: n / min(n, most) for label, n in counts.items()}
    return scratch.stage(learned, "learned"), says


def learn(learned: DataFrame, says: dict[int, float], features: int = FEATURES, factors: int = FACTORS) -> Machine:
    """The machine of a sample. Terms are counted by Spark; of the sample, the terms that may be chosen reach the driver."""
    alone, often = candidates(learned, features)
    wanted = F.lit(sorted({*alone, *often})).cast("array<int>")
    narrow = learned.select("id", "toxic", "content", F.array_intersect("terms", wanted).alias("terms"))
    table = narrow.orderBy(F.xxhash64("id"), "id", "toxic", "content").toArrow()
    marks = table.column("toxic").to_numpy().astype(float)
    documents = [np.array(t, np.int64) for t in table.column("terms").to_pylist()]
    weights = np.array([says[int(m)] for m in marks], float)
    return fit(documents, marks, add_pairs(documents, marks, alone, often), factors, says=weights)


def score_toxicity(
    docs: DataFrame, labels: DataFrame, most: int = SAMPLE, features: int = FEATURES, factors: int = FACTORS
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs(doc_id, text)``.

    Learns from at most ``most`` rows of each class of ``labels(doc_id, toxic)`` whose
    ``crc32`` of the id modulo 5 is not 0, weighted to the shares that the classes have in all of them; labels that are null or neither 0 nor 1 are not
    used; rows that repeat an id, its text and its label are learned from once. Texts may be of any length. Null and empty texts hold no term and get the
    score of the bias. Without labels of both classes every text gets the share of the class.
    Other columns are ignored; an empty table gives an empty result.
    """
    learned, says = sample(docs, labels, most)
    machine = docs.sparkSession.sparkContext.broadcast(learn(learned, says, features, factors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            scores = [machine.value.score_text(t, known) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "score"],
            )

    narrow = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"),
        (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"),
        text_bytes(F.col("text")).alias("text"),
    )
    scored = narrow.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
