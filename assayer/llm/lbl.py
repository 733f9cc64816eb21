"""Language-model scores: a log-bilinear model trained with noise-contrastive estimation.

The model predicts from the vectors of the two tokens before: the context's vectors are
multiplied by a matrix for each place and summed, and a token's score is the product with its
own vector and bias. The vocabulary grows with the cube root of the training tokens, and its
output is factored: the most frequent words, the end of the text, the class of all other words
and the classes of less frequent words of the vocabulary are predicted first, then the word
among its class. Classes are about as large as there are classes, so a token is normalised over
a few times the root of the vocabulary. A word outside it has the probability of its class times
its smoothed share in the class, from counts over all training texts, so every token of every
text has a probability and they sum to one. Such words share a vector as context. The token
before has a vector of its own, the one before that the vector of its class, so that contexts
repeat, and are trained and normalised once.

Training compares the tokens of the corpus with noise from the unigram distribution, for a
class and for a word among its class. A start on a bounded sample gives common parameters; then
every partition goes on over all of its training tokens, and the results are averaged, weighted
by tokens. Scoring normalises fully, with batched matrix products for distinct contexts.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.frames import Workspace, crc_mod, pick, rows, text_bytes

GROWTH = 16  # words of the vocabulary for each unit of the cube root of the training tokens
CLASS = 128  # words of a class, and of those predicted without one, at least
KNOWN = 200_000  # words whose counts go to every task, at least; the others are looked up by a join
LONGEST = 256  # bytes of a word that stands for itself; a longer one is told by its SHA-256
FACTORS = 16
NOISE = 8
SHARED = 64  # noise tokens drawn for a batch
INNER = 4  # noise words drawn for each word of a class
BATCH = 2048
MOST_WEIGHT = 4  # a row that stands for more occurrences is split
SAMPLE = 400  # texts of the start
_END = b""
_COUNTED = 1_000_000
_BLOCK = 100_000
_PART = 4096  # parameters in a row


def words_of(text: bytes) -> list[bytes]:
    """The words of a text. A long word is named by a blank, which no word holds, and its digest."""
    return [w if len(w) <= LONGEST else b" " + hashlib.sha256(w).digest() for w in text.lower().split()]


@dataclass
class Model:
    """Outputs are numbered: 0 the end, also before a text, 1 a word outside the vocabulary, then the most
    frequent words, from ``first_class`` the classes, and from ``top`` the words of the classes, ``width`` of
    each, the last one's fewer. Contexts have the same numbers.

    ``vectors`` are the contexts', ``mixers`` the matrix of each place, ``targets`` the outputs', bias last.
    ``noise`` is the unigram probability of each of the first ``top`` outputs, then of each word among its class.
    """

    tokens: dict[bytes, int]
    first_class: int
    top: int
    width: int
    noise: np.ndarray
    vectors: np.ndarray
    mixers: np.ndarray
    targets: np.ndarray
    squares: np.ndarray  # of past slopes, which Adagrad divides by

    def number(self, words: list[bytes]) -> np.ndarray:
        get = self.tokens.get
        return np.array([get(w, 1) for w in words] + [0], np.int64)

    def far(self) -> np.ndarray:
        """The number that each output has as the token before the last one."""
        return self.classes(np.arange(len(self.targets)))

    def classes(self, outputs: np.ndarray) -> np.ndarray:
        """The first prediction for each output: itself, or its class."""
        return np.where(outputs < self.top, outputs, self.first_class + (outputs - self.top) // self.width)

    def words_in(self, of_class: int) -> slice:
        first = self.top + (of_class - self.first_class) * self.width
        return slice(first, min(first + self.width, len(self.targets)))

    def predicted(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        # Rows are taken, which is several times faster than an index and gives the same.
        mixed = self.vectors.take(first, axis=0) @ self.mixers[0] + self.vectors.take(second, axis=0) @ self.mixers[1]
        return np.concatenate([mixed, np.ones((len(mixed), 1), np.float32)], axis=1)

    def log_among(self, mixed: np.ndarray, outputs: slice) -> np.ndarray:
        """Natural logarithms of the probabilities of some outputs among themselves, a row for each context."""
        return mixed @ self.targets[outputs].T - self.log_sum(mixed, outputs)[:, None]

    def log_sum(self, mixed: np.ndarray, outputs: slice) -> np.ndarray:
        """What the scores of some outputs are normalised by."""
        scores = mixed @ self.targets[outputs].T
        most = scores.max(axis=1)
        scores -= most[:, None]
        return np.log(np.exp(scores, out=scores).sum(axis=1)) + most

    def log_probabilities(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Natural logarithms for all outputs, a row for each context; classes have those of their words together."""
        mixed = self.predicted(first, second)
        found = [self.log_among(mixed, slice(0, self.top))]
        for c in range(self.first_class, self.top):
            found.append(found[0][:, c : c + 1] + self.log_among(mixed, self.words_in(c)))
        return np.concatenate(found, axis=1)

    def train(self, triples: np.ndarray, weights: np.ndarray, rng: np.random.Generator, rate: float = 0.1) -> None:
        """One pass of noise-contrastive estimation over weighted (first, second, token) rows, by Adagrad."""
        times = np.where(np.arange(len(self.noise)) < self.top, NOISE, INNER)
        log_noise = np.log(times * self.noise).astype(np.float32)
        # Noise is drawn by the distribution function: of the first outputs, then of each class in turn.
        over_top, over_words = np.cumsum(self.noise[: self.top]), np.cumsum(self.noise[self.top :])
        n_words = len(over_words)
        # The noise of a batch is shared by its rows, so that it takes one matrix product.
        scale = np.float32(NOISE / SHARED)
        squares = self._parts(self.squares)  # views, so that later calls go on from here
        order = np.repeat(np.arange(len(triples)), np.ceil(weights / MOST_WEIGHT).astype(np.int64))
        weights = (weights / np.ceil(weights / MOST_WEIGHT)).astype(np.float32)
        order = rng.permutation(order)
        for start in range(0, len(order), BATCH):
            part = order[start : start + BATCH]
            first, second, token = triples[part].T
            weight = weights[part] / weights[part].sum()
            mixed = self.predicted(first, second)
            among = self.classes(token)
            drawn = np.minimum(np.searchsorted(over_top, rng.random(SHARED) * over_top[-1], "right"), self.top - 1)
            wanted, noise = self.targets.take(among, axis=0), self.targets.take(drawn, axis=0)
            score = np.einsum("ij,ij->i", mixed, wanted)
            other = mixed @ noise.T
            # The logit of "from the corpus" is the score less that of all draws.
            pull = (_sigmoid(score - log_noise[among]) - 1) * weight
            push = _sigmoid(other - log_noise[drawn]) * (weight * scale)[:, None]
            to_mixed = pull[:, None] * wanted + push @ noise
            places, parts = [among, drawn], [pull[:, None] * mixed, push.T @ mixed]
            inner = np.flatnonzero(token >= self.top)
            if len(inner):
                word, mine = token[inner], mixed[inner]
                low = (word - self.top) // self.width * self.width
                high = np.minimum(low + self.width, n_words)
                # The probabilities of the words of a class sum to one.
                below = np.where(low > 0, over_words[low - 1], 0)
                points = below[:, None] + rng.random((len(inner), INNER)) * (over_words[high - 1] - below)[:, None]
                wrong = np.clip(np.searchsorted(over_words, points, "right"), low[:, None], high[:, None] - 1) + self.top
                right, others = self.targets.take(word, axis=0), self.targets.take(wrong, axis=0)
                drag = (_sigmoid(np.einsum("ij,ij->i", mine, right) - log_noise[word]) - 1) * weight[inner]
                shove = _sigmoid((others @ mine[:, :, None])[:, :, 0] - log_noise[wrong]) * weight[inner][:, None]
                to_mixed[inner] += drag[:, None] * right + (shove[:, None, :] @ others)[:, 0]
                places += [word, wrong.ravel()]
                parts += [drag[:, None] * mine, (shove[:, :, None] * mine[:, None, :]).reshape(-1, mine.shape[1])]
            back = to_mixed[:, :-1]
            steps = [
                _summed(np.concatenate([first, second]), np.concatenate([back @ self.mixers[0].T, back @ self.mixers[1].T])),
                (slice(None), np.stack([self.vectors.take(x, axis=0).T @ back for x in (first, second)])),
                _summed(np.concatenate(places), np.concatenate(parts)),
            ]
            for values, square, (at, slope) in zip((self.vectors, self.mixers, self.targets), squares, steps):
                square[at] += slope**2
                values[at] -= np.float32(rate) * slope / np.sqrt(square[at])

    def parameters(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in (self.vectors, self.mixers, self.targets)])

    def _parts(self, flat: np.ndarray) -> list[np.ndarray]:
        shapes = [p.shape for p in (self.vectors, self.mixers, self.targets)]
        cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
        return [p.reshape(s) for p, s in zip(np.split(flat, cuts), shapes)]

    def with_parameters(self, flat: np.ndarray, squares: np.ndarray) -> Model:
        """A model of its own with these numbers."""
        parts = self._parts(np.array(flat, np.float32))
        return Model(
            self.tokens, self.first_class, self.top, self.width, self.noise, *parts, np.array(squares, np.float32)
        )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    out = np.minimum(np.maximum(x, -30), 30)
    np.exp(np.negative(out, out=out), out=out)
    out += 1
    return np.reciprocal(out, out=out)


def _summed(places: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places, and the rows of ``parts`` summed for each."""
    distinct, which = np.unique(places, return_inverse=True)
    # Column by column: what is at work at a time stays in the processor's cache.
    summed = np.empty((len(distinct), parts.shape[1]), np.float32)
    for i, column in enumerate(np.ascontiguousarray(parts.T)):
        summed[:, i] = np.bincount(which, column, len(distinct))
    return distinct, summed


def start(words: list[bytes], counts: np.ndarray, factors: int = FACTORS, width: int = CLASS) -> Model:
    """Small random vectors, and the unigram distribution as bias.

    ``words`` are the vocabulary from the most frequent word down; ``counts`` those of the end, of all words outside
    the vocabulary together, and of each word.
    """
    rng, width = np.random.default_rng(3), max(width, int(np.ceil(np.sqrt(len(words)))))
    head = counts[: 2 + width]
    inner = counts[2 + width :] + 0.1
    firsts = np.arange(0, len(inner), width)
    in_class = np.add.reduceat(inner, firsts) if len(inner) else inner
    sizes = np.diff(np.append(firsts, len(inner)))
    of_top = np.concatenate([head + 0.1, in_class])
    noise = np.concatenate([of_top / of_top.sum(), inner / np.repeat(in_class, sizes)])
    first_class, top, n = len(head), len(of_top), len(noise)
    tokens = {w: i + 2 if i < width else i + 2 + len(firsts) for i, w in enumerate(words)}
    vectors = rng.normal(0, 0.1, (n, factors)).astype(np.float32)
    mixers = np.stack([np.eye(factors, dtype=np.float32)] * 2) * np.float32(0.5)
    targets = np.concatenate([rng.normal(0, 0.1, (n, factors)), np.log(noise)[:, None]], axis=1).astype(np.float32)
    size = vectors.size + mixers.size + targets.size
    return Model(tokens, first_class, top, width, noise, vectors, mixers, targets, np.full(size, 1e-6, np.float32))


def triples(numbered: list[np.ndarray], far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (first, second, token) rows of some texts, and how often each occurs; ``far`` numbers the first."""
    contexts, tokens = _contexts(numbered, far)
    size = len(far)
    found, n = np.unique(contexts * size + tokens, return_counts=True)
    return np.stack([found // size**2, found // size % size, found % size], axis=1), n


# --- corpus counts -----------------------------------------------------------------


def count_words(texts: DataFrame) -> DataFrame:
    """``word, n`` over ``texts(text)``; the empty word is the end of a text. Each task counts first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(counted.keys(), pa.binary()), pa.array(counted.values(), pa.int64())], ["word", "n"]
            )
            counted.clear()
            return out

        for batch in batches:
            for text in batch.column("text").to_pylist():
                counted.update(words_of(text))
                counted[_END] += 1
                if len(counted) > _COUNTED:
                    yield flush()
        yield flush()

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int) -> dict[bytes, int]:
    """The counts of the ``most`` most frequent words. Of the words of the lowest count some are taken, by hash:
    a bound on the hash leaves few more than wanted, so that no task sorts all words of that count."""
    usable = counts.where(F.octet_length("word") > 0)
    total, edge, share = 0, 0, 0.0
    by_count = usable.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n"))
    for n, words in by_count.toLocalIterator():
        if total + words > most:
            room = most - total
            edge, share = n, (room + 10 * room**0.5 + 100) / words
            break
        total += words
    found = usable.where(F.col("n") > edge).select("word", "n")
    if edge and room:
        hashed = F.xxhash64("word")
        near = usable.where((F.col("n") == edge) & (hashed.cast("double") < (min(share, 1.0) - 0.5) * 2.0**64))
        found = found.unionAll(near.orderBy(hashed, "word").limit(room).select("word", "n"))
    table = found.toArrow()
    return dict(zip(table.column("word").to_pylist(), table.column("n").to_pylist()))


# --- training ------------------------------------------------------------------------


def fit(texts: DataFrame, model: Model, sample: int, rounds: int = 1) -> Model:
    """Noise-contrastive estimation over ``texts(doc_id, text)``, from a start on ``sample`` texts; ``rounds``
    times all partitions train from the mean of the round before."""
    first = texts.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    model = averaged(first, model, (0.1, 0.1, 0.05))
    for _ in range(rounds):
        model = averaged(texts, model, (0.05,))
    return model


def averaged(texts: DataFrame, model: Model, rates: tuple[float, ...]) -> Model:
    """Each partition trains a copy of the model on its texts, block by block; the mean by tokens, of the
    parameters and of Adagrad's squares. Parameters travel in parts, which are summed as they arrive."""
    shared, far = texts.sparkSession.sparkContext.broadcast(model), model.far()
    names, kinds = ["place", "tokens", "summed"], [pa.int64(), pa.float64(), pa.list_(pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value.with_parameters(shared.value.parameters(), shared.value.squares)
        held: list[np.ndarray] = []
        tokens = waiting = 0
        rng = np.random.default_rng(17)

        def step() -> None:
            rows_, weights = triples(held, far)
            for rate in rates:
                own.train(rows_, weights, rng, rate)
            held.clear()

        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.append(own.number(words_of(text)))
                tokens += len(held[-1])
                waiting += len(held[-1])
                if waiting > _BLOCK:
                    step()
                    waiting = 0
        if held:
            step()
        if tokens:
            flat = np.concatenate([own.parameters(), own.squares])
            for i in range(0, len(flat), _PART):
                summed = flat[i : i + _PART] * float(tokens)
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((i, tokens, summed), kinds)], names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            for i, place in enumerate(batch.column("place").to_pylist()):
                values = batch.column("summed")[i].values.to_numpy(zero_copy_only=False)
                total = totals.setdefault(place, [0.0, np.zeros(len(values))])
                total[0] += batch.column("tokens")[i].as_py()
                total[1] += values
        for place, (tokens, summed) in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((place, tokens, summed), kinds)], names)

    schema = "place long, tokens double, summed array<double>"
    total = texts.select("text").mapInArrow(run, schema).repartition("place").mapInArrow(add, schema)
    found = total.orderBy("place").toArrow()
    if not found.num_rows:
        return model
    tokens = found.column("tokens")[0].as_py()
    return model.with_parameters(*np.split(found.column("summed").combine_chunks().flatten().to_numpy() / tokens, 2))


# --- scoring -------------------------------------------------------------------------


def score_texts(
    docs: DataFrame,
    vocabulary: int | None = None,
    known: int = KNOWN,
    factors: int = FACTORS,
    sample: int = SAMPLE,
    rounds: int = 1,
    width: int = CLASS,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row of
    ``docs(doc_id, text)``, scores as log10 probabilities.

    Tokens are words between white space, with A-Z in lower case, and the end of the text.
    Learns from the texts whose ``crc32`` of the id modulo 10 is not 0; ``n_known`` counts the
    tokens seen there, ``train_tokens`` all tokens there. ``base_score`` is that of the smoothed
    unigram counts, ``score`` that of the model. ``vocabulary`` words are predicted; without it,
    ``GROWTH`` times the cube root of the training tokens. A null text is empty and has its end alone.
    A text or word may have any length. Repeated rows count as often and come back as often; other
    columns are ignored; an empty table gives an empty result.
    """
    spark, work = docs.sparkSession, Workspace(docs.sparkSession)
    texts = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"),
        (crc_mod(F.col("doc_id"), 10) == 0).alias("held_out"),
        text_bytes(F.col("text")).alias("text"),
    )
    learned = texts.where(~F.col("held_out"))
    counts = work.stage(count_words(learned), "counts")
    all_tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    ends = counts.where(F.octet_length("word") == 0).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    most = int(GROWTH * all_tokens ** (1 / 3)) if vocabulary is None else vocabulary
    table = frequent(counts, max(known, most))
    chosen = sorted(table, key=lambda w: (-table[w], w))[:most]
    in_vocabulary = [table[w] for w in chosen]
    rare_tokens = all_tokens - ends - sum(in_vocabulary)
    rare_words = distinct - (ends > 0) - len(chosen)
    model = start(chosen, np.array([ends, rare_tokens, *in_vocabulary], float), factors, width)
    model = fit(learned, model, sample, rounds)
    model.squares = model.squares[:0]
    shared = spark.sparkContext.broadcast((model, table, ends))

    scored = work.stage(
        texts.select("doc_id", "held_out", "text").mapInArrow(
            _scoring(shared),
            "doc_id long, held_out boolean, n_tokens long, n_known long, known_logs double, n_rare long, "
            "rare_logs double, model_log double, others array<binary>, times array<long>, row long",
        ),
        "scored",
    )
    # Words outside the table are looked up by a join, each once for a row. None of them is frequent.
    asked = scored.where(F.size("others") > 0).select("row", F.explode(F.arrays_zip("others", "times")).alias("x"))
    found = (
        asked.select("row", F.col("x.others").alias("word"), F.col("x.times").alias("times"))
        .join(counts, "word", "left")
        .select("row", "times", F.coalesce("n", F.lit(0)).alias("n"))
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("seen"),
            F.sum(F.col("times") * F.log10(F.col("n") + 0.1)).alias("logs"),
        )
    )
    base = float(np.log10(all_tokens + 0.1 * (distinct + 1)))
    rare = float(np.log10(rare_tokens + 0.1 * (rare_words + 1)))
    seen, logs = F.coalesce("seen", F.lit(0)), F.coalesce("logs", F.lit(0.0))
    return scored.drop("others", "times").join(found, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + seen).alias("n_known"),
        F.lit(all_tokens).cast("long").alias("train_tokens"),
        (F.col("known_logs") + logs - F.col("n_tokens") * base).alias("base_score"),
        (F.col("model_log") + F.col("rare_logs") + logs - F.col("n_rare") * rare).alias("score"),
    )


def _scoring(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        model, table, ends = shared.value
        # A word is looked up once, for its place in the table; the place behind the last one is for all others.
        places = {word: i for i, word in enumerate(table)}
        find, absent = places.get, len(table)
        logs = np.append(np.log10(np.fromiter(table.values(), float, absent) + 0.1), 0)
        numbers = np.append(model.number(list(table))[:-1], 1)
        end_log, row, far = float(np.log10(ends + 0.1)), TaskContext.get().partitionId() << 40, model.far()
        out, found, waiting = [], [], 0

        def flush() -> pa.RecordBatch:
            sizes = np.array([len(at) for at in found])
            ends_at = np.cumsum(sizes + 1)
            starts = ends_at - sizes - 1
            inside = np.ones(ends_at[-1], bool)
            inside[ends_at - 1] = False
            at = np.concatenate(found)
            ids, known, word_logs = (np.zeros(len(inside), t) for t in (np.int64, np.int64, float))
            ids[inside], known[inside], word_logs[inside] = numbers.take(at), at < absent, logs.take(at)
            rare = (ids == 1) & inside
            contexts, tokens = _contexts(np.split(ids, ends_at[:-1]), far)
            sums = [
                np.add.reduceat(values, starts)
                for values in (known, word_logs, rare.astype(np.int64), word_logs * rare, _model_logs(model, contexts, tokens))
            ]
            n_known, known_logs, n_rare, rare_logs, model_log = sums
            doc_ids, held, others, times, rows_ = zip(*out)
            columns = [
                doc_ids, held, sizes + 1, n_known + (ends > 0), known_logs + end_log, n_rare, rare_logs, model_log,
                others, times, rows_,
            ]
            done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _SCORED.types)], _SCORED.names)
            out.clear()
            found.clear()
            return done

        for batch in batches:
            for doc_id, held_out, text in rows(batch, "doc_id", "held_out", "text"):
                words = words_of(text)
                at = np.array([find(w, absent) for w in words], np.int64)
                others = Counter(words[k] for k in np.flatnonzero(at == absent).tolist())
                found.append(at)
                out.append((doc_id, held_out, list(others), list(others.values()), row))
                row += 1
                waiting += len(at) + 1
                if waiting > _BLOCK:
                    yield flush()
                    waiting = 0
        if out:
            yield flush()

    return run


_SCORED = pa.schema(
    [
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("known_logs", pa.float64()), ("n_rare", pa.int64()), ("rare_logs", pa.float64()),
        ("model_log", pa.float64()), ("others", pa.list_(pa.binary())), ("times", pa.list_(pa.int64())),
        ("row", pa.int64()),
    ]
)


def _contexts(numbered: list[np.ndarray], far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The context of every token of some texts, as one number, and the tokens."""
    padded = np.concatenate([np.concatenate(([0, 0], ids)) for ids in numbered])
    codes = far[padded[:-2]] * len(far) + padded[1:-1]
    inside = np.ones(len(codes), bool)
    at = 0
    for ids in numbered[:-1]:
        at += len(ids) + 2
        inside[at - 2 : at] = False
    return codes[inside], np.concatenate(numbered)


def _model_logs(model: Model, contexts: np.ndarray, outputs: np.ndarray) -> np.ndarray:
    """The log10 probability of each output; a context that occurs often is mixed and normalised once."""
    distinct, which = np.unique(contexts, return_inverse=True)
    mixed = np.empty((len(distinct), model.targets.shape[1]), np.float32)
    among = model.classes(outputs)
    sums = np.empty(len(distinct), np.float32)
    for i in range(0, len(distinct), 2048):
        some = slice(i, i + 2048)
        mixed[some] = model.predicted(*np.divmod(distinct[some], len(model.targets)))
        sums[some] = model.log_sum(mixed[some], slice(0, model.top))
    out = np.einsum("ij,ij->i", mixed.take(which, axis=0), model.targets.take(among, axis=0)) - sums[which]
    # Words of one class are normalised together, in pieces of bounded size.
    inner = np.flatnonzero(outputs >= model.top)
    inner = inner[np.argsort(among[inner], kind="stable")]
    edges = np.searchsorted(among[inner], np.arange(model.first_class, model.top + 1))
    for c, (a, b) in enumerate(zip(edges, edges[1:]), model.first_class):
        for i in range(a, b, 2048):
            mine = inner[i : min(i + 2048, b)]
            own = mixed.take(which[mine], axis=0)
            out[mine] += np.einsum("ij,ij->i", own, model.targets.take(outputs[mine], axis=0)) - model.log_sum(own, model.words_in(c))
    return out.astype(float) / np.log(10)
