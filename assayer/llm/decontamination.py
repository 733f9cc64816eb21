"""Benchmark decontamination with broadcast n-gram sets.

The benchmark's windows are broadcast in slices of bounded size; the texts are scanned once
for each slice, which is one pass for a benchmark of usual size. A window of a text is a
candidate when all its words occur in the slice and its hash is among those of the slice;
a candidate is a hit only when its words are equal.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.frames import pick, rows, text_bytes
from assayer.sources.scratch import Scratch

WINDOW = 10
SLICE_BYTES = 4 << 20

# Digits, letters and all bytes of non-ASCII characters make words; A-Z become lower case.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)
_BASE = 0x9E3779B97F4A7C15


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass
class Slice:
    """Windows of some benchmark items: word numbers, and items by window, sorted hashes by length."""

    numbers: dict[bytes, int]
    items: dict[int, dict[bytes, tuple[str, ...]]]
    hashes: dict[int, np.ndarray]


def build_slice(items: list[tuple[str, bytes]], window: int = WINDOW) -> Slice:
    numbers: dict[bytes, int] = {}
    found: dict[int, dict[bytes, set[str]]] = defaultdict(lambda: defaultdict(set))
    for name, text in items:
        ids = np.array([numbers.setdefault(w, len(numbers)) for w in words(text)], np.int32)
        length = min(window, len(ids))
        for i in range(len(ids) - length + 1 if length else 0):
            found[length][ids[i : i + length].tobytes()].add(name)
    hashes = {
        n: np.unique(_hashed(np.frombuffer(b"".join(same), np.int32).reshape(-1, n))) for n, same in found.items()
    }
    return Slice(numbers, {n: {k: tuple(v) for k, v in same.items()} for n, same in found.items()}, hashes)


def _hashed(windows: np.ndarray) -> np.ndarray:
    total = np.zeros(len(windows), np.uint64)
    for column in windows.T:
        total = total * np.uint64(_BASE) + column.astype(np.uint64) + np.uint64(1)
    return total


def scan(text: list[bytes], part: Slice) -> tuple[np.ndarray, set[str]]:
    """Which words lie in an occurrence of a window of the slice, and the items concerned."""
    hit, items = np.zeros(len(text), bool), set()
    get = part.numbers.get
    ids = np.array([get(w, -1) for w in text], np.int32)
    unknown = np.concatenate(([0], np.cumsum(ids < 0)))
    for length, known in part.hashes.items():
        if length > len(ids):
            continue
        starts = np.flatnonzero(unknown[length:] == unknown[:-length])
        total = np.zeros(len(starts), np.uint64)
        for k in range(length):
            total = total * np.uint64(_BASE) + ids[starts + k].astype(np.uint64) + np.uint64(1)
        place = np.minimum(np.searchsorted(known, total), len(known) - 1)
        for start in starts[known[place] == total].tolist():
            if names := part.items[length].get(ids[start : start + length].tobytes()):
                hit[start : start + length] = True
                items.update(names)
    return hit, items


def cleaned(text: bytes, hit: np.ndarray) -> bytes:
    """``text`` without each maximal run of hit words, from its first word to its last."""
    spans, kept, at = [m.span() for m in _WORD.finditer(text.translate(_FOLD))], [], 0
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    for first, end in edges.reshape(-1, 2).tolist():
        kept.append(text[at : spans[first][0]])
        at = spans[end - 1][1]
    return b"".join([*kept, text[at:]])


def _slices(benchmark: DataFrame, window: int, slice_bytes: int) -> Iterator[Slice]:
    """The benchmark by hash, so that no more than about ``slice_bytes`` reach the driver at a time."""
    narrow = pick(benchmark, "item_id", "text").select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        text_bytes(F.col("text")).alias("text"),
    )
    size = narrow.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    count = -(-size // slice_bytes) or 1
    for i in range(count):
        part = narrow.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == i)
        yield build_slice([(r[0], bytes(r[1])) for r in part.toLocalIterator()], window)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    slice_bytes: int = SLICE_BYTES,
    keep_text: bool = False,
    columns: tuple[str, ...] = (),
) -> DataFrame:
    """For each row of ``docs(doc_id, text)``: ``doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated, items``; with ``keep_text`` also ``clean_text``, without the hit spans; and the
    named other columns, of which ``text`` may be one.

    ``items`` are the distinct ids, as text and sorted, of the items of ``benchmark(item_id,
    text)`` of which a window occurs. An item shorter than a window is one window; an item
    without words is none. A null text has no words, a null item id counts as the empty
    text. Repeated rows of either table change nothing; other columns are ignored; with an
    empty benchmark no text is contaminated.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    others = [c for c in columns if c != "text"]
    state = pick(docs, "doc_id", "text", *others).select(
        F.col("doc_id").cast("long"),
        F.col("text").cast("string").cast("binary").alias("text"),
        F.lit(None).cast("binary").alias("hit"),
        F.array().cast("array<string>").alias("items"),
        *others,
    )
    types = {f.name: f.dataType.simpleString() for f in state.schema}
    previous = None
    for part in _slices(benchmark, window, slice_bytes):
        if previous is not None:
            state = scratch.stage(state.mapInArrow(_marking(previous, others), state.schema), "marked")
        previous = spark.sparkContext.broadcast(part)
    text = ", clean_text binary" if keep_text else ""
    result = state.mapInArrow(
        _reporting(previous, keep_text, columns),
        "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
        f"items array<string>{text}" + "".join(f", {c} {types[c]}" for c in columns),
    )
    if "text" in columns:
        result = result.withColumn("text", F.col("text").cast("string"))
    return result.withColumn("clean_text", F.col("clean_text").cast("string")) if keep_text else result


def _scanned(batch: pa.RecordBatch, part: Slice) -> Iterator[tuple]:
    for doc_id, text, hit, items in rows(batch, "doc_id", "text", "hit", "items"):
        text = text or b""
        found = words(text)
        marks, names = scan(found, part)
        if hit is not None:
            marks |= np.unpackbits(np.frombuffer(hit, np.uint8), count=len(found)).astype(bool)
        yield doc_id, text, marks, sorted(names.union(items))


def _marking(part, others: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(hit, items) for _, _, hit, items in _scanned(batch, part.value)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text"),
                    pa.array([np.packbits(hit).tobytes() for hit, _ in found], pa.binary()),
                    pa.array([items for _, items in found], pa.list_(pa.string())),
                    *[batch.column(c) for c in others],
                ],
                ["doc_id", "text", "hit", "items", *others],
            )

    return run


def _reporting(part, keep_text: bool, others: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, hit, items in _scanned(batch, part.value):
                n = int(hit.sum())
                digest = hashlib.sha256(",".join(items).encode()).hexdigest()
                row = [doc_id, len(hit), n, len(items), digest, n > 0, items]
                out.append(row + [cleaned(text, hit) if n else text] * keep_text)
            types = [pa.int64()] * 4 + [pa.string(), pa.bool_(), pa.list_(pa.string())] + [pa.binary()] * keep_text
            names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "clean_text"]
            columns = list(zip(*out)) or [()] * len(types)
            arrays = [pa.array(c, t) for c, t in zip(columns, types)] + [batch.column(c) for c in others]
            yield pa.RecordBatch.from_arrays(arrays, [*names[: len(types)], *others])

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW) -> DataFrame:
    """``doc_id, text`` without contaminated documents, or with ``remove="spans"`` without the hit spans."""
    if remove == "spans":
        found = find_contamination(docs, benchmark, window, keep_text=True)
        return found.select("doc_id", F.col("clean_text").alias("text"))
    if remove != "documents":
        raise ValueError("remove must be 'documents' or 'spans'")
    found = find_contamination(docs, benchmark, window, keep_text=True)
    return found.where(~F.col("contaminated")).select("doc_id", F.col("clean_text").alias("text"))
