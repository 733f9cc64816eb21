"""Removal of long repeated byte strings, by hashes around sampled anchors.

A string of ``length`` bytes is judged through its anchor: the place in it whose q-gram has the
smallest hash. Equal strings have equal anchors, and neighbouring strings mostly share theirs, so
one suffix in about sixty stands for all of them. The anchors are grouped and the groups refined by
content hashes, in place of bucket-pointer refinement, which sorts buckets by those of later offsets:

1. by the q-gram at the anchor. A q-gram that occurs once ends the search.
2. by the identifier of the run, which is all that the strings of this anchor cover. A run
   that occurs twice is repeated as a whole; the strings of the other runs of a bucket with
   several runs are open.
3. open runs by the identifiers of blocks of offsets around the anchor: what all strings of a
   block share (inner), and all that they cover (outer). An outer identifier that occurs twice
   settles its block; an inner one with a single outer one is settled as well.
4. the blocks still open by the identifier of each string.

Every refinement reuses the groups of the one before and counts by key with partial aggregation.
No bucket is gathered, so that a passage in a third of all documents costs no task more than
others. Identifiers have 128 bits.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.frames import Workspace, pick, rows, text_bytes

LENGTH = 200
BLOCK = 16
_STRINGS = 1 << 17  # begins looked at together; bounds the memory for long texts
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)


def gram_length(length: int) -> int:
    """Short enough for an anchor to hold for many strings, long enough to be rare by chance."""
    return max(1, length * 3 // 8)


@functools.cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    table = np.random.default_rng(5).integers(0, 1 << 64, 256, dtype=np.uint64)
    return table, run(_BASE), run(pow(_BASE, -1, 1 << 64))


def gram_hashes(text: np.ndarray, gram: int) -> np.ndarray:
    """A rolling polynomial hash of the q-gram at each place, mixed."""
    n = len(text)
    table, powers, inverses = _powers(_STRINGS + LENGTH * 8 if n <= _STRINGS + LENGTH * 8 else n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(table[text] * powers[:n], out=sums[1:])
    out = (sums[gram:] - sums[:-gram]) * inverses[: n - gram + 1]
    out ^= out >> np.uint64(32)
    out *= _MIX
    return out ^ (out >> np.uint64(29))


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbouring keys, from prefix and suffix minima of blocks."""
    filled = np.concatenate([keys, np.full(-len(keys) % width, ~np.uint64(0))]).reshape(-1, width)
    before = np.minimum.accumulate(filled, axis=1).ravel()
    after = np.minimum.accumulate(filled[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(keys) - width + 1
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def anchors(text: bytes, length: int = LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """First begin, last begin, anchor and q-gram hash of each run of strings with a common anchor."""
    gram, places = gram_length(length), np.uint64(2 * _STRINGS - 1)
    for at in range(0, len(text) - length + 1, _STRINGS):
        part = np.frombuffer(text, np.uint8)[at : at + _STRINGS + length - 1]
        hashes = gram_hashes(part, gram)
        # The leftmost of equal hashes counts: the low bits hold the place.
        keys = (hashes & ~places) | np.arange(len(hashes), dtype=np.uint64)
        chosen = (window_minima(keys, length - gram + 1) & places).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(chosen)) + 1))
        last = np.concatenate((first[1:] - 1, [len(chosen) - 1]))
        anchor = chosen[first]
        yield first + at, last + at, anchor + at, hashes[anchor]


def _idents(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """128-bit identifiers of strings, as two longs."""
    found = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, parts)), "<i8").reshape(-1, 2)
    return found[:, 0], found[:, 1]


def _batch(columns: dict[str, object]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))


def _find_anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                found = []
                for doc_id, t, text in rows(batch.slice(i, 200), "doc_id", "t", "text"):
                    for first, last, anchor, gram in anchors(text, length):
                        ends = (last + length).tolist()
                        c1, c2 = _idents([text[a:b] for a, b in zip(first.tolist(), ends)])
                        found.append((doc_id, t, first, last, anchor, gram.view(np.int64), c1, c2))
                if not found:
                    continue
                sizes = [len(f[2]) for f in found]
                out = {
                    "doc_id": pa.array(np.repeat([f[0] or 0 for f in found], sizes), pa.int64(),
                                       mask=np.repeat([f[0] is None for f in found], sizes)),
                    "t": np.repeat([f[1] for f in found], sizes),
                }
                for k, name in enumerate(("first", "last", "anchor", "gram", "c1", "c2"), 2):
                    out[name] = np.concatenate([f[k] for f in found])
                yield _batch(out)

    return run


_PLACE = "doc_id long, t long, first long, last long, anchor long"


def _contexts():
    """The bytes of open runs, cut from their documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, runs in rows(batch, "text", "runs"):
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "c1": r["c1"],
                            "c2": r["c2"],
                            "n": r["n"],
                            "low": r["anchor"] - r["last"],
                            "high": r["anchor"] - r["first"],
                            "bytes": text[r["first"] : r["end"]],
                        }
                        for r in runs
                    ],
                    pa.schema([(c, pa.int64()) for c in ("c1", "c2", "n", "low", "high")] + [("bytes", pa.binary())]),
                )

    return run


def _refine_blocks(length: int, block: int):
    """For every block of offsets that a run touches: inner and outer identifier. An offset is the
    distance from a string's begin to the anchor; ``high`` is that of the run's first string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            inner: list[bytes] = []
            outer: list[bytes] = []
            for c1, c2, n, low, high, text in rows(batch, "c1", "c2", "n", "low", "high", "bytes"):
                for number in range(low // block, high // block + 1):
                    near, far = number * block, number * block + block - 1
                    a, b = max(low, near), min(high, far)
                    out.append((c1, c2, n, a, b))
                    mark = number.to_bytes(4, "little")
                    inner.append(mark + text[high - near : high - far + length])
                    outer.append(mark + a.to_bytes(4, "little") + b.to_bytes(4, "little") + text[high - b : high - a + length])
            if out:
                columns = dict(zip(("c1", "c2", "n", "low", "high"), (np.array(c, np.int64) for c in zip(*out))))
                columns["i1"], columns["i2"] = _idents(inner)
                columns["o1"], columns["o2"] = _idents(outer)
                yield _batch(columns)

    return run


def _refine_strings(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            whole: list[bytes] = []
            wanted = ("c1", "c2", "occurrences", "top", "low", "high", "bytes")
            for c1, c2, n, top, low, high, text in rows(batch, *wanted):
                for offset in range(low, high + 1):
                    out.append((c1, c2, n, offset))
                    whole.append(offset.to_bytes(4, "little") + text[top - offset : top - offset + length])
            if out:
                columns = dict(zip(("c1", "c2", "n", "offset"), (np.array(c, np.int64) for c in zip(*out))))
                columns["k1"], columns["k2"] = _idents(whole)
                yield _batch(columns)

    return run


def repeat_spans(docs: DataFrame, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """``doc_id, t, spans``: the byte ranges ``(start, end)``, not yet merged, that strings of ``length``
    bytes cover which also start elsewhere, for each document with some; ``t`` is the ``xxhash64``
    of the text, which tells documents apart that share an id."""
    work = Workspace(docs.sparkSession)
    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), text_bytes(F.col("text")).alias("text"))
    texts = texts.where(F.octet_length("text") >= length).select("doc_id", F.xxhash64("text").alias("t"), "text")

    every = work.stage(
        texts.mapInArrow(_find_anchors(length), f"{_PLACE}, gram long, c1 long, c2 long"), "anchors"
    )
    grams = work.stage(every.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), "grams")
    kept = work.stage(every.join(grams, "gram", "left_semi"), "kept")
    work.drop(every, grams)

    runs = work.stage(
        kept.groupBy("gram", "c1", "c2").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "t", "first", "last", "anchor")).alias("at")
        ),
        "runs",
    )
    whole = kept.join(runs.where("n > 1").select("c1", "c2"), ["c1", "c2"], "left_semi").select(
        "doc_id", "t", F.col("first").alias("start"), (F.col("last") + length).alias("end")
    )

    # Buckets with several runs, of which one occurs once: that one is open, the others are its partners.
    several = runs.groupBy("gram").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least"))
    several = several.where("k > 1 and least = 1").select("gram")
    wanted = (
        runs.join(several, "gram", "left_semi")
        .select(
            F.col("at.doc_id").alias("id"),
            F.col("at.t").alias("tt"),
            F.struct(
                "c1", "c2", "n", "at.first", "at.last", "at.anchor", (F.col("at.last") + length).alias("end")
            ).alias("run"),
        )
        .groupBy("id", "tt")
        .agg(F.collect_list("run").alias("runs"))  # at most one run for each place of the document
    )
    wanted = work.stage(wanted, "wanted")
    # Repeated rows of a document would cut the same bytes again; the runs are distinct, so are the bytes.
    contexts = work.stage(
        texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("t") == F.col("tt")))
        .select("text", "runs")
        .mapInArrow(_contexts(), "c1 long, c2 long, n long, low long, high long, bytes binary")
        .dropDuplicates(["c1", "c2"]),
        "contexts",
    )
    work.drop(wanted)

    blocks = contexts.mapInArrow(
        _refine_blocks(length, block),
        "c1 long, c2 long, n long, low long, high long, i1 long, i2 long, o1 long, o2 long",
    )
    blocks = work.stage(blocks, "blocks")
    outer = work.stage(
        blocks.groupBy("i1", "i2", "o1", "o2").agg(
            F.sum("n").alias("occurrences"), F.min(F.struct("c1", "c2", "low", "high")).alias("of")
        ),
        "outer",
    )
    settled = blocks.where("n = 1").join(
        outer.where("occurrences > 1").select("i1", "i2", "o1", "o2"), ["i1", "i2", "o1", "o2"], "left_semi"
    )
    unsettled = outer.groupBy("i1", "i2").agg(F.count(F.lit(1)).alias("k"), F.min("occurrences").alias("least"))
    unsettled = unsettled.where("k > 1 and least = 1").select("i1", "i2")
    strings = (
        outer.join(unsettled, ["i1", "i2"], "left_semi")
        .select("of.c1", "of.c2", "of.low", "of.high", "occurrences")
        .join(contexts.select("c1", "c2", F.col("high").alias("top"), "bytes"), ["c1", "c2"])
        .mapInArrow(_refine_strings(length), "c1 long, c2 long, n long, offset long, k1 long, k2 long")
    )
    strings = work.stage(strings, "strings")
    twice = strings.groupBy("k1", "k2").agg(F.sum("n").alias("n")).where("n > 1").select("k1", "k2")
    single = strings.where("n = 1").join(twice, ["k1", "k2"], "left_semi")
    offsets = settled.select("c1", "c2", "low", "high").union(
        single.select("c1", "c2", F.col("offset").alias("low"), F.col("offset").alias("high"))
    )
    partly = offsets.join(runs.where("n = 1").select("c1", "c2", "at"), ["c1", "c2"]).select(
        "at.doc_id",
        "at.t",
        (F.col("at.anchor") - F.col("high")).alias("start"),
        (F.col("at.anchor") - F.col("low") + length).alias("end"),
    )
    spans = whole.union(partly).distinct().groupBy("doc_id", "t").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    spans = work.stage(spans, "spans")
    work.drop(kept, runs, contexts, blocks, outer, strings)
    return spans


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Overlapping and adjacent ranges joined."""
    out: list[list[int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *[place for span in spans for place in span], len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    here = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_t"))
    spans = spans.select(F.col("doc_id").alias("_id"), F.col("t").alias("_t"), F.col("spans").alias("_spans"))
    hashed = docs.withColumn("_text_hash", F.xxhash64(text_bytes(F.col("text"))))
    return hashed.join(spans, here, "left").drop("_text_hash", "_id", "_t")


def find_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for each row of ``docs(doc_id, text)``.

    Every byte is removed that lies in a string of ``length`` bytes that also starts anywhere
    else, in the same document or another. Strings are judged on the texts as given. Null
    texts count as empty; texts shorter than ``length`` stay whole; a repeated row is another
    document, so its copies lose what they share. Null ids are kept. Other columns are ignored;
    an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, spans in rows(batch, "doc_id", "text", "_spans"):
                found = merged(spans)
                kept = kept_bytes(text, found)
                digest = hashlib.sha256(kept).hexdigest()
                out.append((doc_id, len(text), len(text) - len(kept), len(found), digest))
            columns = list(zip(*out)) or [()] * 5
            types = [pa.int64()] * 4 + [pa.string()]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    narrow = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), text_bytes(F.col("text")).alias("text"))
    return _with_spans(narrow, repeat_spans(docs, length)).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH, columns: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``text`` without its repeated bytes, and the named other columns of ``docs``.

    Half characters at the edges of a removed range are dropped; a null text stays null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in rows(batch, "text", "_spans"):
                cut = merged(spans)
                kept = kept_bytes(text.encode(), cut).decode("utf-8", "ignore") if cut else text
                texts.append(kept)
            names = [n for n in batch.schema.names if n != "_spans"]
            arrays = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(arrays, names)

    narrow = pick(docs, "doc_id", "text", *columns).withColumn("doc_id", F.col("doc_id").cast("long"))
    joined = _with_spans(narrow, repeat_spans(docs, length))
    return joined.mapInArrow(run, narrow.schema)
