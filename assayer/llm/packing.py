"""Mixture-controlled packing of tokenized documents into windows, by deficit round-robin.

Each source is a queue of tokens, in the order of the written token table. A window visits
the sources in turn; each gives its share of what is left to fill, and what rounding withholds
from it in one window is owed in the next. These deficits depend on the place in the stream
alone, so ``Schedule.taken`` gives the tokens that a source has handed out by any place, and
every task cuts its own documents without waiting for others: deficits carry over between
windows and partitions without a task that sees all windows.

Documents are tokenized once. The ids are written with the running position in the queue of
the partition; the positions of whole partitions come from one small table.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayer.llm.frames import pick, rows
from assayer.sources.scratch import Scratch

_SCALE = 1 << 16
LONG_SPACE = 4096
_LONG_SPACE = re.compile(rf"\s{{{LONG_SPACE}}}")
# How byte-level vocabularies split a text into words, and what may change how they merge.
_WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
_OPTIONS = (
    "dropout",
    "unk_token",
    "continuing_subword_prefix",
    "end_of_word_suffix",
    "byte_fallback",
    "ignore_merges",
)


class Encoder:
    """Token ids of whole texts as the tokenizer file gives them, as bytes.

    A byte-level BPE vocabulary whose merges are in the order of their ids, and whose every token
    encodes to itself, has one way to merge a word: always the two neighbours whose joint token has
    the least id. The merge encoder works by that rule and is several times faster than the library
    of the file. It is used only where a vocabulary is shown to be of that kind; otherwise, and for texts with
    special tokens or very long white space, the library encodes."""

    def __init__(self, tokenizer_json: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.merging = merge_encoder(tokenizer_json)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, text: str) -> bool:
        """Whether the merge encoder can take the text: its splitting has no depth for endless white space."""
        if any(s in text for s in self.special):
            return False
        return len(text) < LONG_SPACE or _LONG_SPACE.search(text) is None

    def encode(self, texts: list[str]) -> list[bytes]:
        kind = {2: "H", 4: "I"}[self.dtype.itemsize]
        if self.merging is None:
            found = self._library(texts)
        else:
            found = [self.merging.encode_ordinary(t) if self._plain(t) else self._library([t])[0] for t in texts]
        return [array(kind, ids).tobytes() for ids in found]


def merge_encoder(tokenizer_json: str) -> tiktoken.Encoding | None:
    """An encoder of the same ids by the ranks of the vocabulary, or nothing if that is not certain."""
    from tokenizers import Tokenizer

    parts = json.loads(tokenizer_json)
    model, split = parts["model"], parts["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not any(model.get(option) for option in _OPTIONS) and not parts["normalizer"]
    if not plain or (split.get("type"), split.get("use_regex"), split.get("add_prefix_space")) != ("ByteLevel", True, False):
        return None
    letter = {c: i for i, c in enumerate(_byte_letters())}
    added = {t["content"] for t in parts["added_tokens"]}
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in added}
    merged = [vocabulary.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    if None in merged or any(a >= b for a, b in zip(merged, merged[1:])):
        return None
    single = sorted(i for t, i in vocabulary.items() if len(t) == 1)
    if not all(c in letter for t in vocabulary for c in t) or sorted(single + merged) != sorted(vocabulary.values()):
        return None
    bare = {**parts, "pre_tokenizer": None, "post_processor": None, "decoder": None, "added_tokens": []}
    alone = Tokenizer.from_str(json.dumps(bare)).encode_batch_fast(list(vocabulary), add_special_tokens=False)
    if len(single) != 256 or max(single) > min(merged, default=256) or any(
        e.ids != [i] for e, i in zip(alone, vocabulary.values())
    ):
        return None
    ranks = {bytes(letter[c] for c in t): i for t, i in vocabulary.items()}
    return tiktoken.Encoding("merges", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it can be seen, or one from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b if b in seen else next(other)) for b in range(256)]


_encoders: dict[int, Encoder] = {}


def _encoder(tokenizer_json: str) -> Encoder:
    key = hash(tokenizer_json)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(tokenizer_json)
    return _encoders[key]


class Schedule:
    """How many tokens each source has given when the first ``n`` places are filled.

    ``totals`` are the tokens in each queue. ``weights`` are target proportions, the totals
    themselves if not given. When a queue is empty, the others share its part from there on.
    Windows have ``size`` places; what does not fill the last one is cut into powers of two,
    so that nothing is padded.
    """

    def __init__(self, totals: list[int], weights: list[float] | None = None, size: int = 1024) -> None:
        self.size, self.total = size, sum(totals)
        share = [float(w) for w in (totals if weights is None else weights)]
        if any(w < 0 for w in share):
            raise ValueError("weights must not be negative")
        top = sum(share) or 1.0
        wanted = [max(1, round(w / top * _SCALE)) if w else 0 for w in share]
        given, start = [0] * len(totals), 0
        self.phases: list[tuple[int, list[int], list[int]]] = []
        while start < self.total:
            left = [t - g for t, g in zip(totals, given)]
            open_ = [w if n else 0 for w, n in zip(wanted, left)]
            if not any(open_):  # only queues without a target are left
                open_ = [1 if n else 0 for n in left]
            low, high = 1, self.total - start
            while low < high:
                middle = (low + high + 1) // 2
                if all(c <= n for c, n in zip(self._shares(middle, open_), left)):
                    low = middle
                else:
                    high = middle - 1
            self.phases.append((start, list(given), open_))
            given = [g + c for g, c in zip(given, self._shares(low, open_))]
            start += low
        full = self.total // size
        tail, at = [], full * size
        for bit in range(size.bit_length() - 1, -1, -1):
            if (self.total - full * size) >> bit & 1:
                at += 1 << bit
                tail.append(at)
        self._full, self._tail = full, np.array([full * size, *tail], np.int64)

    @staticmethod
    def _shares(places, weights: list[int]) -> list:
        """The cascade: each source takes its share of what the sources before it have left."""
        rest, out = sum(weights), []
        for weight in weights:
            taken = places * weight // rest if rest else places * 0
            out.append(taken)
            places, rest = places - taken, rest - weight
        return out

    @property
    def windows(self) -> int:
        return self._full + len(self._tail) - 1

    def bound(self, window: np.ndarray) -> np.ndarray:
        """The place at which a window begins."""
        after = self._tail[np.clip(window - self._full, 0, len(self._tail) - 1)]
        return np.where(window <= self._full, np.minimum(window, self._full) * self.size, after)

    def taken(self, places: np.ndarray) -> np.ndarray:
        """Tokens given by each source (rows) at each place (columns)."""
        out = np.zeros((len(self.phases[0][1]) if self.phases else 0, len(places)), np.int64)
        for i, (start, given, weights) in enumerate(self.phases):
            end = self.phases[i + 1][0] if i + 1 < len(self.phases) else self.total + 1
            inside = (places >= start) & (places < end)
            if inside.any():
                shares = self._shares(places[inside] - start, weights)
                for k, share in enumerate(shares):
                    out[k, inside] = given[k] + share
        return out

    def _window_before(self, source: int, position: int) -> int:
        """The last window that begins when the source has given ``position`` tokens or fewer."""
        low, high = 0, self.windows
        while low < high:
            middle = (low + high + 1) // 2
            if self.taken(self.bound(np.array([middle])))[source, 0] <= position:
                low = middle
            else:
                high = middle - 1
        return low

    def cuts(self, source: int, first: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the source's tokens ``[first, end)``: window numbers, the source's first token in each
        and that token's offset in the window."""
        low = self._window_before(source, first)
        high = self._window_before(source, end - 1) + 1
        # Windows without a token of the source lie before one with the same begin; the last counts.
        numbers = np.arange(low, high + 1)
        taken = self.taken(self.bound(numbers))
        offsets = np.zeros(len(numbers), np.int64)
        offsets[:-1] = (taken[:source, 1:] - taken[:source, :-1]).sum(axis=0)
        return numbers, taken[source], offsets


def tokenize(docs: DataFrame, tokenizer_json: str, end_id: int = 0) -> DataFrame:
    """``doc_id, source, part, start, n, ids``: each document's ids with ``end_id`` after them, and its
    place among the tokens of its source in the partition. To be written before it is used twice."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(shared.value), TaskContext.get().partitionId()
        end, width, running = encoder.dtype.type(end_id).tobytes(), encoder.dtype.itemsize, {}
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                piece = batch.slice(i, 500)
                ids = [x + end for x in encoder.encode(piece.column("text").to_pylist())]
                sources, starts = piece.column("source").to_pylist(), []
                for source, x in zip(sources, ids):
                    starts.append(running.get(source, 0))
                    running[source] = starts[-1] + len(x) // width
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        piece.column("source"),
                        pa.array([part] * len(ids), pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array([len(x) // width for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["doc_id", "source", "part", "start", "n", "ids"],
                )

    narrow = pick(docs, "doc_id", "text", "source").select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.col("source").cast("string"),
    )
    return narrow.mapInArrow(run, "doc_id long, source string, part long, start long, n long, ids binary")


def pack(
    docs: DataFrame,
    tokenizer_json: str,
    size: int = 1024,
    targets: Mapping[str, float] | None = None,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of all documents of ``docs(doc_id, text, source)`` in windows of ``size`` tokens.

    A row is a piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, and
    ``source``; with ``with_ids`` also ``ids``. ``targets`` are token proportions by source; by
    default those of the corpus. A source without a target is packed after the others. A null
    text counts as empty and is its end token alone; null sources form one queue; repeated rows
    are packed as often; a null id stays null; other columns are ignored; an empty table gives
    no pieces. Texts may be of any length. The number of sources must be moderate: each has a place in every window.
    """
    from tokenizers import Tokenizer

    wide = Tokenizer.from_str(tokenizer_json).get_vocab_size() > 1 << 16
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    tokens = scratch.stage(tokenize(docs, tokenizer_json, end_id), "tokens")
    parts = scratch.stage(tokens.groupBy("source", "part").agg(F.sum("n").alias("n")), "parts")
    totals = sorted(
        (tuple(r) for r in parts.groupBy("source").agg(F.sum("n")).collect()), key=lambda r: (r[0] is None, r[0] or "")
    )
    weights = None if targets is None else [targets.get(name, 0.0) for name, _ in totals]
    schedule = spark.sparkContext.broadcast(Schedule([n for _, n in totals], weights, size))
    number = {name: i for i, (name, _) in enumerate(totals)}
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = scratch.stage(
        parts.select("source", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases"
    ).select(F.col("source").alias("s"), F.col("part").alias("p"), "base")
    placed = tokens.join(bases, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p"))).select(
        "doc_id", "source", (F.col("base") + F.col("start")).alias("first"), "n", "ids"
    )
    columns = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"
    return placed.mapInArrow(_cutting(schedule, number, wide, with_ids), columns + ", ids array<int>" * with_ids)


def _cutting(schedule, number: dict[str | None, int], wide: bool, with_ids: bool) -> Callable:
    stored = np.dtype("<u4" if wide else "<u2")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = schedule.value
        for batch in batches:
            ranges: dict[str | None, tuple[int, int]] = {}
            for source, first, n in rows(batch, "source", "first", "n"):
                low, high = ranges.get(source, (first, first + n))
                ranges[source] = (min(low, first), max(high, first + n))
            cuts = {source: plan.cuts(number[source], *ends) for source, ends in ranges.items()}
            found: list[tuple[np.ndarray, ...]] = []
            sums: list[int] = []
            parts: list[np.ndarray] = []
            for source, first, n, stored_ids in rows(batch, "source", "first", "n", "ids"):
                ids = np.frombuffer(stored_ids, stored).astype("<u4")
                raw = memoryview(ids.tobytes())
                windows, begins, offsets = cuts[source]
                at = int(np.searchsorted(begins, first, "right")) - 1
                to = int(np.searchsorted(begins, first + n, "left"))
                low = np.maximum(begins[at:to], first)
                length = np.minimum(begins[at + 1 : to + 1], first + n) - low
                real = np.flatnonzero(length > 0)  # some windows have no token of the source
                low, length, place = low[real], length[real], at + real
                found.append((low - first, length, windows[place], offsets[place] + low - begins[place]))
                spans = list(zip((low - first).tolist(), (low - first + length).tolist()))
                sums += [zlib.crc32(raw[4 * a : 4 * b]) for a, b in spans]
                if with_ids:
                    parts += [ids[a:b].astype(np.int32) for a, b in spans]
            if not found:
                continue
            start, length, window, offset = (np.concatenate(c) for c in zip(*found))
            row = pa.array(np.repeat(np.arange(batch.num_rows), [len(f[0]) for f in found]))
            doc_id, n, source = (batch.column(c).take(row) for c in ("doc_id", "n", "source"))
            columns = [doc_id, start, length, pa.array(sums, pa.int64()), n, window, offset, source]
            if with_ids:
                columns.append(pa.array(parts, pa.list_(pa.int32())))
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names[: len(arrays)])

    return run


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, ids`` from the pieces of ``pack(..., with_ids=True)``; a group holds one window."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("ids"))
