"""Language identification with error-correcting output codes.

Every language has a codeword of bits, chosen so that codewords differ in many bits. For each
bit a binary classifier over hashed byte n-grams says on which side a text lies. Decoding sums,
over the bits of a codeword, the classifier's loss times the bit's weight, and takes the
codeword with the smallest sum; some wrong bits do no harm. A text is ambiguous when the
second codeword is nearly as close.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayer.llm.frames import crc_mod, pick, text_bytes
from assayer.sources.scratch import Scratch

PER_LANGUAGE = 400  # labelled rows of each language, at most
SAMPLE = 8000  # labelled rows in all, at most
BUCKETS = 1 << 12
UNKNOWN = "und"
AMBIGUOUS = 0.8  # share of the nearest codeword below which a text is ambiguous

_LETTER = re.compile(r"[^\W\d_]")
# ASCII letters in lower case and all bytes of other characters; anything else separates.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_AT_ONCE = 1 << 20


def features(text: bytes) -> np.ndarray:
    """Square roots of the shares of the hashed byte pairs and triples of the whole text."""
    folded = b" " + b" ".join(text.translate(_FOLD).split()) + b" "
    counts = np.zeros(BUCKETS)
    for i in range(0, len(folded), _AT_ONCE):
        b = np.frombuffer(folded[i : i + _AT_ONCE + 2], np.uint8).astype(np.uint32)
        last = min(len(b) - 2, _AT_ONCE)
        pairs = b[:-1] * np.uint32(257) + b[1:]
        triples = pairs[:-1] * np.uint32(65599) + b[2:]
        for grams, end in ((pairs, min(len(pairs), _AT_ONCE)), (triples, max(last, 0))):
            places = (grams[:end] * np.uint32(2654435761)) >> np.uint32(20)
            counts += np.bincount(places, minlength=BUCKETS)
    total = counts.sum()
    return np.sqrt(counts / total).astype(np.float32) if total else counts.astype(np.float32)


def codewords(n: int, bits: int) -> np.ndarray:
    """``n`` rows of +1 and -1, grown one by one: of many random words the one farthest from the others."""
    rng = np.random.default_rng(11)
    words = rng.choice([-1, 1], (1, bits))
    while len(words) < n:
        options = rng.choice([-1, 1], (256, bits))
        far = ((options[:, None, :] != words[None]).sum(axis=2)).min(axis=1)
        words = np.vstack([words, options[int(far.argmax())]])
    return words


@dataclass
class Model:
    """``weights`` has a column for each bit and a last row of biases; ``trust`` weighs the bits."""

    languages: list[str]
    words: np.ndarray
    weights: np.ndarray
    trust: np.ndarray

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For rows of features, the best language's number and its share among all codewords."""
        margins = x @ self.weights[:-1] + self.weights[-1]
        losses = np.logaddexp(0, -margins[:, None, :] * self.words[None]) @ self.trust
        shares = np.exp(losses.min(axis=1, keepdims=True) - losses)
        shares /= shares.sum(axis=1, keepdims=True)
        best = losses.argmin(axis=1)
        return best, shares[np.arange(len(best)), best]


def fit(x: np.ndarray, languages: list[str], rounds: int = 150) -> Model:
    """Logistic classifiers of all bits at once, by Adagrad on the whole sample."""
    names = sorted(set(languages))
    bits = max(15, 4 * int(np.ceil(np.log2(max(2, len(names))))) + 1)
    words = codewords(max(1, len(names)), bits)
    weights = np.zeros((BUCKETS + 1, bits))
    if len(names) < 2:
        return Model(names, words, weights, np.ones(bits))
    numbers = {name: i for i, name in enumerate(names)}
    rows = np.array([numbers[name] for name in languages])
    wanted = words[rows].astype(np.float32)
    # Every language has the same say, however many rows it has.
    say = (1 / np.bincount(rows))[rows][:, None] / len(names)
    x1 = np.hstack([x, np.ones((len(x), 1), np.float32)])
    squares = np.full_like(weights, 1e-8)
    for _ in range(rounds):
        margins = x1 @ weights
        push = -wanted / (1 + np.exp(np.clip(wanted * margins, -30, 30))) * say
        slope = x1.T @ push + 1e-6 * weights
        squares += slope**2
        weights -= slope / np.sqrt(squares)
    right = ((x1 @ weights * wanted > 0) * say).sum(axis=0)
    trust = np.clip(np.log(np.maximum(right, 0.5) / np.maximum(1 - right, 0.02)), 0.05, None)
    return Model(names, words, weights, trust / trust.mean())


def first_rows(usable: DataFrame, per_language: int, most: int) -> DataFrame:
    """``id, lang`` of the first ``per_language`` ids of each language by hash, and of ``most`` in all.

    A frequent language has all but a few ids set aside by a bound on the hash before any are gathered:
    four times as many as wanted are left, and some more so that chance leaves none short.
    """
    # Languages come in turn, so that those past the first ``most`` would have no row: a table of ``most`` rows.
    sizes = usable.groupBy("lang").agg(F.approx_count_distinct("id").alias("ids")).orderBy("lang").limit(most)
    part = F.xxhash64("id") / F.lit(2.0**64) + 0.5  # in the order of the hash, from 0 to 1
    near = usable.join(F.broadcast(sizes), "lang").where(part * F.col("ids") <= 4 * per_language + 64)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))
    firsts = near.select("id", "lang").distinct().withColumn("place", place).where(F.col("place") <= per_language)
    return firsts.orderBy("place", "lang").limit(most).select("id", "lang")


def sample(docs: DataFrame, per_language: int, most: int) -> tuple[np.ndarray, list[str]]:
    """Features and languages of labelled training rows, the first ones of each language by hash of the id."""
    narrow = pick(docs, "doc_id", "lang").select(F.col("doc_id").cast("long").alias("id"), F.col("lang").cast("string"))
    usable = narrow.where("lang is not null and id is not null").where(crc_mod(F.col("id"), 3) != 1)
    chosen = Scratch(docs.sparkSession).stage(first_rows(usable, per_language, most), "chosen")
    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), text_bytes(F.col("text")).alias("text"))
    # ``chosen`` has ``most`` rows of an id and a language at most.
    joined = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("id", "text", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                features(t).astype(np.float16).tobytes() if known(t) else None for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(found, pa.binary()), batch.column("lang")], ["id", "x", "lang"]
            )

    found = joined.mapInArrow(run, "id long, x binary, lang string").where("x is not null")
    rows = found.orderBy(F.xxhash64("id"), "id", "lang", "x").limit(most).collect()
    x = np.array([np.frombuffer(r["x"], np.float16) for r in rows], np.float32).reshape(-1, BUCKETS)
    return x, [r["lang"] for r in rows]


def known(text: bytes) -> bool:
    """Whether the text has a letter."""
    return _LETTER.search(text.decode("utf-8", "replace")) is not None


def identify_languages(
    docs: DataFrame, per_language: int = PER_LANGUAGE, most: int = SAMPLE, columns: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous, letterless`` for each row of ``docs(doc_id, text,
    lang)``, and the named other columns, of which ``text`` may be one.

    Learns from at most ``per_language`` rows of each language and ``most`` in all, of those
    with a ``lang`` whose ``crc32`` of the id modulo 3 is not 1; a rare language past ``most``
    languages is not learned. Null, empty and letterless texts are ``und`` with score 0, as is
    every text when no language can be learned; ``letterless`` tells these apart. Repeated rows come back as often; other columns
    are ignored; an empty table gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(*sample(docs, per_language, most)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [t or b"" for t in part.column("text").to_pylist()]
                names: list[str] = [UNKNOWN] * len(texts)
                scores, unsure = np.zeros(len(texts)), np.zeros(len(texts), bool)
                lettered = [known(t) for t in texts]
                usable = [k for k, has in enumerate(lettered) if has] if model.value.languages else []
                if usable:
                    best, share = model.value.decode(np.array([features(texts[k]) for k in usable]))
                    for k, number in zip(usable, best.tolist()):
                        names[k] = model.value.languages[number]
                    scores[usable], unsure[usable] = share, share < AMBIGUOUS
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(names), pa.array(scores), pa.array(unsure)]
                    + [pa.array([not has for has in lettered], pa.bool_()), *[part.column(c) for c in columns]],
                    ["doc_id", "held_out", "lang_pred", "score", "ambiguous", "letterless", *columns],
                )

    others = [c for c in columns if c != "text"]
    narrow = pick(docs, "doc_id", "text", *others).select(
        F.col("doc_id").cast("long"),
        (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"),
        F.col("text").cast("string").cast("binary").alias("text"),
        *others,
    )
    types = {f.name: f.dataType.simpleString() for f in narrow.schema}
    result = narrow.mapInArrow(
        run,
        "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean, letterless boolean"
        + "".join(f", {c} {types[c]}" for c in columns),
    )
    return result.withColumn("text", F.col("text").cast("string")) if "text" in columns else result
