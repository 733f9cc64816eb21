"""SimHash near-duplicates by multi-index hashing over small Hamming balls.

A code is cut into two segments. Two codes that differ in two bits or fewer meet in a point
that each reaches by changing at most one bit of one segment: at one code if the other is in
its ball already, else halfway. So every code enters the ball of radius 1 of each segment
into the table of matches. The key of the table keeps the other segment as well. With the
segment alone as key, the codes of a frequent segment would meet in pairs, and near copies
make such segments; with the whole point as key at most 65 codes can meet at all, whatever
the data. Fetched matches are linked to the smallest code of the point after their complete
distance has been verified, which keeps every component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayer.llm.components import components
from assayer.llm.frames import pick, text_bytes
from assayer.sources.scratch import Scratch

BITS = 64
SEGMENTS = ((0, 32), (32, 64))
_AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The majority bits of the hashes of all shingles, repeats included; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle or None], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    hash64 = xxhash.xxh64_intdigest
    set_in = np.zeros(BITS, np.int64)
    for i in range(0, len(starts), _AT_ONCE):
        part = zip(starts[i : i + _AT_ONCE].tolist(), ends[i : i + _AT_ONCE].tolist())
        hashes = np.array([hash64(line[a:b], seed) for a, b in part], np.dtype("<u8"))
        set_in += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, columns: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``code``, the fingerprint as a signed long, and the named other columns for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.array([fingerprint(t, shingle, seed) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(codes.view(np.int64), pa.int64()), *[batch.column(c) for c in columns]],
                ["doc_id", "code", *columns],
            )

    narrow = pick(docs, "doc_id", "text", *columns).select(
        F.col("doc_id").cast("long"), text_bytes(F.col("text")).alias("text"), *columns
    )
    others = "".join(f", {f.name} {f.dataType.simpleString()}" for f in narrow.schema if f.name in columns)
    return narrow.mapInArrow(run, f"doc_id long, code long{others}")


def links(codes: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links ``(a, b)`` with ``a > b`` that join all distinct codes of ``max_bits`` or fewer differing bits."""
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2: balls of radius 1 prove no more")
    code = F.col("code")
    bits = [1 << bit for low, high in SEGMENTS for bit in range(low, high)]
    flips = [F.lit(b - (1 << BITS) if b >> (BITS - 1) else b).cast("long") for b in [0, *bits]]
    points = codes.select("code", F.explode(F.array(*[code.bitwiseXOR(flip) for flip in flips])).alias("point"))
    least = F.min("code").over(Window.partitionBy("point"))
    met = points.withColumn("least", least).where("code > least")
    if max_bits == 1:  # only a code's own point proves one bit
        met = points.join(codes.select(F.col("code").alias("least")), F.col("point") == F.col("least")).where("code <> least")
    far = F.bit_count(code.bitwiseXOR(F.col("least")))
    return met.where(far <= max_bits).select(
        F.greatest("code", "least").alias("a"), F.least("code", "least").alias("b")
    ).distinct()


def _rooted(codes: DataFrame, max_bits: int, scratch: Scratch) -> DataFrame:
    """``codes`` with ``root``, the smallest code of the component."""
    linked = components(links(codes.select("code"), max_bits), scratch)
    return scratch.stage(
        codes.join(linked, codes["code"] == linked["node"], "left").select(
            *[codes[c] for c in codes.columns], F.coalesce("root", "code").alias("root")
        ),
        "rooted",
    )


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, seed: int = 42) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``docs(doc_id, text)``.

    ``component_id`` is the smallest id reachable over links of at most ``max_bits`` bits.
    Null, empty and blank texts have fingerprint zero and are linked like others. Repeated
    rows are one code and come back as often. A null id comes back as null and is never a
    component's name, unless all ids of the component are null. Other columns are ignored;
    an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession)
    prints = scratch.stage(fingerprints(docs, shingle, seed), "prints")
    codes = scratch.stage(prints.groupBy("code").agg(F.min("doc_id").alias("first_id")), "codes")
    rooted = _rooted(codes, max_bits, scratch)
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = scratch.stage(rooted.join(names, "root").select("code", "component_id"), "named")
    return prints.join(named, "code").select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id"
    )


def first_rows(docs: DataFrame, key: str, shingle: int = 3, max_bits: int = 2, seed: int = 42) -> DataFrame:
    """``key`` of one row of each component of ``docs(doc_id, text, key)``: of the rows with the smallest
    id, where null comes last, the one with the smallest key. Components are those of ``near_duplicates``,
    told apart by their codes, so rows of different components may share an id or have none."""
    scratch = Scratch(docs.sparkSession)
    prints = scratch.stage(fingerprints(docs, shingle, seed, (key,)), "prints")
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", key)
    codes = scratch.stage(prints.groupBy("code").agg(F.min(at).alias("first")), "codes")
    firsts = _rooted(codes, max_bits, scratch).groupBy("root").agg(F.min("first").alias("first"))
    return scratch.stage(firsts.select(F.col(f"first.{key}").alias(key)), "firsts")
