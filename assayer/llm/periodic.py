"""Periodic runs of words, as the maximal pairs of each text.

A run is a stretch with a smallest period that no neighbouring word extends. Two equal stretches
of a text that start ``p`` words apart, differ in the word before them and in the word after
them, form a maximal pair; when they are longer than ``p`` they overlap, and together they are a
maximal stretch of period ``p``. So runs need no extension word by word:

1. Words become numbers, and the suffixes of all texts of a batch are sorted by doubling the
   compared length. A suffix that no other one of its text equals leaves the sorting early.
2. Suffixes whose common beginning is too short for any run are cut apart; what hangs together
   is a cluster, a subtree of the LCP-interval tree. A cluster goes when all its positions have
   one left word, since none of its pairs is left-maximal, or when its positions lie too far
   apart for its longest common beginning.
3. The others go through the tree bottom-up. A node keeps its positions in order, each in the
   class of its left word. Where two children meet, neighbouring positions of different children
   and classes are a maximal pair; it is a run when the distance suits the length. Only neighbours
   need a look: a stretch of at least twice its smallest period cannot occur again at less than that
   period, so the pair of a run is never parted by a third position of its node.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.frames import pick, text_bytes

#: Words that are sorted together; a longer text is sorted by itself.
WORDS_AT_ONCE = 1 << 18

Run = tuple[int, int, int]
Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


def least_pair(exponent: int, length: int) -> int:
    """The shortest common beginning that any run has: over all periods, of what each asks for."""
    return min(max(length - p, (exponent - 1) * p) for p in range(1, length + 1))


class Suffixes:
    """The suffixes of numbered texts, laid one after the other, that share a beginning with another one of their text.

    ``order`` has their places, sorted, and ``common`` how many numbers each shares with the one before it.
    """

    def __init__(self, numbers: np.ndarray, starts: np.ndarray) -> None:
        n = len(numbers)
        lengths = np.diff(np.append(starts, n))
        text = np.repeat(np.arange(len(starts)), lengths)
        ends = np.repeat(starts + lengths, lengths)
        # A rank is the place of a suffix's group among all sorted ones, so that splitting a group leaves the others.
        place, key = np.arange(n), text * (int(numbers.max(initial=0)) + 1) + numbers
        self.ranks: list[np.ndarray] = []
        rank, width = np.zeros(n, np.int32), 0
        slots = place
        while len(place):
            by = np.lexsort((key, rank[place])) if width else np.argsort(key, kind="stable")
            place = place[by]
            key, old = key[by], rank[place]
            first = np.ones(len(place), bool)
            first[1:] = (key[1:] != key[:-1]) | (old[1:] != old[:-1])
            rank = rank.copy()
            rank[place] = slots[np.maximum.accumulate(np.where(first, np.arange(len(place)), 0))]
            self.ranks.append(rank)
            width = max(1, 2 * width)
            alone = first & np.append(first[1:], True)
            place, slots = place[~alone], slots[~alone]
            after = place + width
            inside = after < ends[place]
            key = np.where(inside, rank[np.minimum(after, n - 1)].astype(np.int64) + 1, 0)
        self.ends, self.n = ends, n
        order = np.empty(n, np.int64)
        order[rank] = np.arange(n)
        self.order = order
        self.common = self._common(order)

    def _common(self, order: np.ndarray) -> np.ndarray:
        """Numbers that each suffix shares with the one before, halving the compared length."""
        shared = np.zeros(self.n, np.int64)
        at = np.flatnonzero(self.ranks[0][order[1:]] == self.ranks[0][order[:-1]]) + 1 if self.n else shared
        a, b = order[at - 1], order[at]
        met = np.zeros(len(at), np.int64)
        for k in reversed(range(len(self.ranks))):
            inside = np.flatnonzero(np.maximum(a, b) + met < np.minimum(self.ends[a], self.ends[b]))
            # A group of this width holds whole stretches: one that its text's end cuts off stands alone.
            same = inside[self.ranks[k][a[inside] + met[inside]] == self.ranks[k][b[inside] + met[inside]]]
            met[same] += 1 << k
        shared[at] = met
        return shared


def clusters(suffixes: Suffixes, left: np.ndarray, exponent: int, length: int) -> Iterator[tuple[list[int], list[int]]]:
    """Neighbouring suffixes with a long enough common beginning: their places, and the common lengths between them."""
    joined = suffixes.common >= least_pair(exponent, length)
    starts = np.flatnonzero(joined & ~np.append(False, joined[:-1])) - 1
    if not len(starts):
        return
    ends = np.flatnonzero(joined & ~np.append(joined[1:], False)) + 1
    sizes = ends - starts
    which = np.repeat(np.arange(len(starts)), sizes)
    inner = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    places = suffixes.order[starts[which] + inner]
    common = np.where(inner > 0, suffixes.common[starts[which] + inner], 0)
    offsets = np.cumsum(sizes) - sizes
    longest = np.maximum.reduceat(common, offsets)
    classes = left[places]
    mixed = np.minimum.reduceat(classes, offsets) != np.maximum.reduceat(classes, offsets)
    by = np.lexsort((places, which))
    gaps = np.diff(places[by], prepend=0)
    gaps[offsets] = np.iinfo(np.int64).max
    nearest = np.minimum.reduceat(gaps, offsets)
    for i in np.flatnonzero(mixed & ((exponent - 1) * nearest <= longest)):
        a, b = offsets[i], offsets[i] + sizes[i]
        yield places[a:b].tolist(), common[a + 1 : b].tolist()


def maximal_pairs(
    places: Sequence[int], common: Sequence[int], left: Sequence[int], exponent: int, length: int
) -> list[Run]:
    """``(start, length, period)`` of the pairs that suit, from one subtree of the LCP-interval tree, bottom-up.

    ``common[i]`` lies between ``places[i]`` and ``places[i + 1]``. The smaller child's positions enter the larger one's list.
    """

    found: list[Run] = []

    def meet(one: list[int], other: list[int], shared: int) -> list[int]:
        few, many = sorted((one, other), key=len)
        members = set(few)
        reach = shared // (exponent - 1)
        for x in few:
            insort(many, x)
        for x in few:
            at = bisect_left(many, x)
            for a, b in ((at - 1, at), (at, at + 1)):
                if 0 <= a and b < len(many) and (many[a] in members) != (many[b] in members):
                    period = many[b] - many[a]
                    if period <= reach and shared + period >= length and left[many[a]] != left[many[b]]:
                        found.append((many[a], shared + period, period))
        return many

    # Open nodes from the root down: the common length with the next node, and the positions.
    open_nodes: list[tuple[int, list[int]]] = []
    for place, shared in zip(places, [*common, 0]):
        node = [place]
        while open_nodes and open_nodes[-1][0] >= shared:
            depth, sibling = open_nodes.pop()
            node = meet(sibling, node, depth)
        open_nodes.append((shared, node))
    return found


def runs_of_texts(texts: Sequence[Sequence[bytes]], exponent: int, length: int) -> list[list[Run]]:
    """``(start, length, period)`` of all runs of each text, by start, then period."""
    found: list[dict[tuple[int, int], int]] = [{} for _ in texts]
    known: dict[bytes, int] = {}
    numbers = np.array([known.setdefault(w, len(known)) for words in texts for w in words], np.int64)
    sizes = np.array([len(words) for words in texts], np.int64)
    filled = np.flatnonzero(sizes)
    if not len(filled):
        return [[] for _ in texts]
    starts = (np.cumsum(sizes) - sizes)[filled]
    # The class of a position is its left word; the first position of a text has a class of its own.
    left = np.append(-1, numbers[:-1])
    left[starts] = -1
    text_at = np.repeat(filled, sizes[filled])
    offset = np.zeros(len(texts), np.int64)
    offset[filled] = starts
    classes = None
    for places, common in clusters(Suffixes(numbers, starts), left, exponent, length):
        classes = left.tolist() if classes is None else classes
        which = int(text_at[places[0]])
        start = int(offset[which])
        for first, long, period in maximal_pairs(places, common, classes, exponent, length):
            at = first - start, long
            found[which][at] = min(period, found[which].get(at, period))
    return [sorted((start, long, p) for (start, long), p in runs.items()) for runs in found]


def collapsed(words: Sequence[bytes], runs: Sequence[Run]) -> list[bytes]:
    """``words`` without those that lie in a run, beyond its first period."""
    if not runs:
        return list(words)
    edges = np.zeros(len(words) + 1, np.int64)
    for start, long, period in runs:
        edges[start + period] += 1
        edges[start + long] -= 1
    kept = np.flatnonzero(np.cumsum(edges)[:-1] == 0)
    return [words[i] for i in kept.tolist()]


def _groups(batch: pa.RecordBatch, rewrite: Rewrite | None) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Rows' ids and words, in groups of bounded size; words are what lies between ASCII white space."""
    ids: list = []
    texts: list[list[bytes]] = []
    size = 0
    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
        words = text.as_py().split()
        words = rewrite(doc_id, words) if rewrite else words
        if texts and size + len(words) > WORDS_AT_ONCE:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(doc_id)
        texts.append(words)
        size += len(words)
    if texts:
        yield ids, texts


def find_runs(docs: DataFrame, exponent: int = 4, length: int = 6, rewrite: Rewrite | None = None) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for each row of ``docs(doc_id, text)``.

    ``runs`` has a struct ``start, length, period`` in words for each stretch of at least ``length`` words
    and ``exponent`` times its smallest period that no neighbouring word extends, by start, then period.
    ``collapsed`` is the text's words, joined by one space, without those that a run repeats. Words lie
    between ASCII white space; ``rewrite`` may change the words of a row before they are searched.

    Null, empty and blank texts have no words and no runs. Texts of any length are searched whole, one
    longer than ``WORDS_AT_ONCE`` words by itself, in memory that grows with its words. Runs do not cross
    texts. Ties cannot occur: of one stretch only the smallest period counts. Repeated rows and null ids
    come back as often as they occur; other columns are ignored; an empty table gives an empty result.
    """
    if exponent < 3 or length < 2:
        raise ValueError("exponent must be 3 or more and length 2 or more")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
        names = ("start", "length", "period")
        for batch in batches:
            for ids, texts in _groups(batch, rewrite):
                found = runs_of_texts(texts, exponent, length)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array([len(words) for words in texts], pa.int64()),
                        pa.array([[dict(zip(names, r)) for r in runs] for runs in found], spans),
                        pa.array([b" ".join(collapsed(w, r)) for w, r in zip(texts, found)], pa.binary()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    narrow = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), text_bytes(F.col("text")).alias("text"))
    found = narrow.mapInArrow(
        run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
    )
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def describe_runs(found: DataFrame) -> DataFrame:
    """Digests of ``find_runs``: the run of the greatest exponent and SHA-256 of all runs and of the collapsed text.

    Exponents are compared exactly, by cross products; ties go to the smallest start, then period.
    """

    def stronger(best, run):
        more, less = run["length"] * best["period"], best["length"] * run["period"]
        earlier = (run["start"] < best["start"]) | (
            (run["start"] == best["start"]) & (run["period"] < best["period"])
        )
        return F.when((more > less) | ((more == less) & earlier), run).otherwise(best)

    first = F.get("runs", F.lit(0))
    best = F.aggregate("runs", first, stronger)
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
