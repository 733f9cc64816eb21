"""Exact top-k by inner product over an impact-ordered index, score at a time.

Vectors are cut into index blocks. In a block, a dimension's posting list is sorted by value,
its impact, which is quantised into segments. A query meets, in every dimension, the segments
in falling order of contribution: from the top for a positive weight, from the bottom for a
negative one. Segments are processed in rounds of falling contribution over all dimensions,
and each adds its guaranteed contribution to the accumulators of its postings. After a round
the contribution of every posting not yet met is bounded; the search stops only when the k-th
guaranteed score proves that the postings left outside cannot belong to the result. The
vectors that may belong to it are scored again, exactly.

The best k of every block and query are merged with a window by query.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.llm.frames import pick, rows
from assayer.sources.scratch import Scratch

BLOCK = 16384
QUERIES = 256
STEP = 16  # width of a segment in integer units
ROUNDS = 8
#: Accumulated contributions are exact up to this; where they could pass it, all vectors of a block are scored.
EXACT = 1 << 52
#: Scores and their bounds stay below this, so that they fit a long.
MOST = 1 << 61


class Index(NamedTuple):
    """``order[d]`` holds the places of the block's vectors by falling value in dimension ``d``,
    ``falling[d]`` their quantised impacts in that order, negated so that they rise."""

    ids: np.ndarray
    vectors: np.ndarray
    order: np.ndarray
    falling: np.ndarray


def build_index(ids: np.ndarray, vectors: np.ndarray, step: int = STEP) -> Index:
    order = np.ascontiguousarray(np.argsort(-vectors, axis=0, kind="stable").T.astype(np.int32))
    return Index(ids, vectors, order, segments(vectors, order, step))


def segments(vectors: np.ndarray, order: np.ndarray, step: int) -> np.ndarray:
    return np.ascontiguousarray(-(np.take_along_axis(vectors.T, order, axis=1) // step))


def search(index: Index, query: np.ndarray, k: int, own: int | None, step: int = STEP) -> list[tuple[int, int]]:
    """The ``(score, vec_id)`` of the best ``k`` vectors of the block; ties to smaller ids."""
    ids, vectors, order, falling = index
    size, dims = vectors.shape
    # A segment's guaranteed contribution, above the least that the dimension can contribute.
    low, high = -falling[:, -1] * step, -falling[:, 0] * step + step - 1
    positive = query >= 0
    floor = np.where(positive, query * low, query * high)
    slack = np.abs(query) * (step - 1)
    most = np.abs(query) * (high - low)
    top = int(most.max()) if dims else 0
    rounds = ROUNDS if int(np.abs(query).max(initial=0)) * int(np.abs(falling).max(initial=0) + 1) * step * 4 * dims < EXACT else 0
    sums = np.full(size, floor.sum(), np.int64)
    met = np.zeros(dims, np.int64)  # postings processed, from the dimension's own end
    allowed = max(4 * k, size >> 6)
    banned = ids == own if own is not None else np.zeros(size, bool)
    possible = np.flatnonzero(~banned)
    for turn in range(1, rounds + 1):
        bar = top * (ROUNDS - turn) // ROUNDS
        places, gains, rest = [], [], slack.copy()
        for d in np.flatnonzero(query):
            weight, floor_d = int(query[d]), int(floor[d])
            # Levels that guarantee more than the bar form one run at the dimension's end.
            if weight > 0:
                need = (bar + floor_d) // weight  # value must exceed this
                end = int(np.searchsorted(falling[d], -(need // step), "left"))
                new = slice(int(met[d]), max(int(met[d]), end))
                gain = falling[d, new] * (-step * weight) - floor_d
                left = -falling[d, new.stop] * step + step - 1 if new.stop < size else None
            else:
                need = -((bar + floor_d) // -weight)  # value must be below this
                end = size - int(np.searchsorted(falling[d], -(need // step), "right"))
                new = slice(size - max(int(met[d]), end), size - int(met[d]))
                gain = (step - 1 - falling[d, new] * step) * weight - floor_d
                left = -falling[d, new.start - 1] * step if new.start > 0 else None
            places.append(order[d, new])
            gains.append(gain)
            met[d] += new.stop - new.start
            if met[d] < size:
                rest[d] = max(int(slack[d]), weight * int(left) - floor_d)
        if places:
            flat = np.concatenate(places)
            sums += np.bincount(flat, np.concatenate(gains), size).astype(np.int64)
        if len(possible) <= k and turn < ROUNDS:
            break
        # Guaranteed scores are sums; nothing can rise above them by more than the rest.
        bound = int(rest.sum())
        if len(possible) > k:
            proven = np.partition(sums[possible], -k)[-k]
            possible = possible[sums[possible] + bound >= proven]
        if len(possible) <= allowed or bar == 0:
            break
    scores = vectors[possible] @ query
    best = np.lexsort((ids[possible], -scores))[:k]
    return [(int(scores[i]), int(ids[possible[i]])) for i in best]


def quantised(embedding: Column) -> Column:
    """``floor(1024 * x)`` of each component; null for vectors with a null or non-finite component,
    or one so large that a score might not fit a long."""
    values = F.transform(embedding, lambda x: F.floor(x.cast("double") * 1024).cast("long"))
    most = F.sqrt(F.lit(float(MOST)) / F.greatest(F.size(embedding), F.lit(1)))
    bad = F.exists(
        embedding,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) * 1024 > most),
    )
    return F.when(F.coalesce(bad, F.lit(True)), F.lit(None)).otherwise(values)


def _packed(vectors: DataFrame, size: int, indexed: bool, step: int) -> DataFrame:
    """Rows in blocks, each at most ``size`` rows of one partition and one dimension."""

    def block(dim: int, ids: list[int], values: list) -> pa.RecordBatch:
        found = np.array(values, np.int64).reshape(len(ids), dim)
        row = [dim, len(ids), np.array(ids, np.int64).tobytes(), found.tobytes()]
        if indexed:
            index = build_index(np.array(ids, np.int64), found, step)
            row += [index.order.tobytes()]
        kinds = [pa.int32(), pa.int64()] + [pa.binary()] * (len(row) - 2)
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for vec_id, values in rows(batch, "vec_id", "v"):
                ids, found = held.setdefault(len(values), ([], []))
                ids.append(vec_id)
                found.append(values)
                if len(ids) == size:
                    yield block(len(values), *held.pop(len(values)))
        for dim, (ids, found) in held.items():
            yield block(dim, ids, found)

    names = ["dim", "n", "ids", "vectors"] + ["ordering"] * indexed
    schema = "dim int, n long, ids binary, vectors binary" + ", ordering binary" * indexed
    return vectors.mapInArrow(run, schema)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, block: int = BLOCK, queries: int = QUERIES, step: int = STEP
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best rows of ``vectors(vec_id, embedding)``.

    ``is_query`` is a condition on ``vec_id``. Candidates are all rows but the query's own. Scores
    are inner products of the vectors in 1/1024, rounded down; ties go to the smaller id, and rows that
    repeat an id count each. Null vectors, vectors with null or non-finite components and rows without
    an id take no part; nor do vectors with a component of more than ``sqrt(2 ** 61 / n) / 1024``, ``n``
    being their length, whose scores might not fit a long. Vectors of different length do not meet. Of
    rows that repeat a query's id the least vector asks, and the others are candidates. Other columns
    are ignored; no queries or no candidates give no rows.

    Queries and rows meet block by block. Each pair of blocks is a task's work of bounded size.
    """
    scratch = Scratch(vectors.sparkSession)
    usable = scratch.stage(
        pick(vectors, "vec_id", "embedding")
        .select(F.col("vec_id").cast("long"), quantised(F.col("embedding")).alias("v"))
        .where("vec_id is not null and v is not null"),
        "vectors",
    )
    blocks = scratch.stage(
        _packed(usable, block, True, step).withColumn("block", F.monotonically_increasing_id()), "index"
    )
    asked = usable.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = scratch.stage(_packed(asked, queries, False, step), "queries").select(
        "dim", F.col("ids").alias("query_ids"), F.col("vectors").alias("query_vectors"), F.col("n").alias("n_queries")
    )
    # Every block of queries goes to every index block: the block numbers are a narrow list.
    numbers = blocks.select("block", "dim")
    pairs = asked.join(numbers, "dim").drop("dim").repartition("block").join(blocks, "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                size, dim = row["n"], row["dim"]
                vectors_here = np.frombuffer(row["vectors"], np.int64).reshape(size, dim)
                ordering = np.frombuffer(row["ordering"], np.int32).reshape(dim, size)
                index = Index(
                    np.frombuffer(row["ids"], np.int64), vectors_here, ordering, segments(vectors_here, ordering, step)
                )
                names = np.frombuffer(row["query_ids"], np.int64)
                asked_here = np.frombuffer(row["query_vectors"], np.int64).reshape(len(names), dim)
                # One more than asked for, since one of them may be the query's own row.
                found = [
                    (int(name), vec_id, score, int(query @ query))
                    for name, query in zip(names, asked_here)
                    for score, vec_id in search(index, query, k + 1, None, step)
                ]
                columns = list(zip(*found)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score", "own_score"]
                )

    near = pairs.mapInArrow(run, "query_id long, vec_id long, score long, own_score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    # Rows of the query's id and own score look alike; one of them is its own.
    own = (F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own_score"))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    best = best.withColumn("own", own).withColumn("owned", F.sum(own.cast("int")).over(upto))
    others = best.where(~(F.col("own") & (F.col("owned") == 1)))
    rank = (F.col("place") - F.least("owned", F.lit(1))).cast("int")
    return others.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
