"""Shards of indivisible groups by best-fit-decreasing bin packing.

Documents of equal texts are a group and stay together. Groups, sorted by size, each enter the shard with
the least room that still holds them; rooms are kept in a balanced tree. Either the capacity of a shard is
given, and the shards are as few as this finds, or their number is given: then the capacity is searched, the
smallest for which best fit needs no more shards, so that shards get near equal sizes.

Packing sees items, not rows. A group of at least a grain is an item. The many smaller ones travel in parcels,
chosen by the hash of their text; the rest of a parcel is an item too. A grain is a small share of a shard, so
items are as many as shards allow and not as many as texts, at any size of the data. With a given number of
shards all items are packed in one task, which is bounded by the parameters. With a given capacity shards grow
with the data: parcels are dealt to regions of bounded size, each packed by a task of its own; this costs one
partly filled shard for each region at most.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.llm.frames import Workspace, pick, text_bytes
from assayer.llm.ranking import PLACE, offsets, ordered, rank
from assayer.operators.duplicates import PLACE as ROW
from assayer.operators.duplicates import with_place

#: A shard holds about so many grains.
FINENESS = 256
#: Shards of a region, where regions are packed apart.
REGION = 256
#: Rows that may join with one copy of a parcel.
PER_KEY = 1 << 20

Tree = tuple | None


def _height(tree: Tree) -> int:
    return tree[0] if tree else 0


def _node(left: Tree, key: tuple[int, int], right: Tree) -> Tree:
    return max(_height(left), _height(right)) + 1, left, key, right


def _balanced(left: Tree, key: tuple[int, int], right: Tree) -> Tree:
    """A node whose sides differ by one level at most, from sides that differ by two."""
    if _height(left) > _height(right) + 1:
        _, a, top, b = left
        if _height(b) > _height(a):
            _, b, middle, c = b
            return _node(_node(a, top, b), middle, _node(c, key, right))
        return _node(a, top, _node(b, key, right))
    if _height(right) > _height(left) + 1:
        _, b, top, c = right
        if _height(b) > _height(c):
            _, a, middle, b = b
            return _node(_node(left, key, a), middle, _node(b, top, c))
        return _node(_node(left, key, b), top, c)
    return _node(left, key, right)


def put(tree: Tree, key: tuple[int, int]) -> Tree:
    """``tree`` with ``key``, which it must not have yet."""
    if not tree:
        return _node(None, key, None)
    _, left, at, right = tree
    return _balanced(put(left, key), at, right) if key < at else _balanced(left, at, put(right, key))


def take(tree: Tree, least: tuple[int, int]) -> tuple[tuple[int, int] | None, Tree]:
    """The smallest key of at least ``least``, and the tree without it."""
    if not tree:
        return None, None
    _, left, at, right = tree
    if at < least:
        found, right = take(right, least)
        return found, _balanced(left, at, right) if found else tree
    found, fewer = take(left, least)
    if found:
        return found, _balanced(fewer, at, right)
    if not right:
        return at, left
    following, right = take(right, at)
    return at, _balanced(left, following, right)


def best_fit(sizes: Sequence[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The bin of each of ``sizes``, which descend; None if more than ``most`` bins are needed.

    Each enters the bin with the least room that holds it, of equal ones the first, or else a new bin.
    What is larger than ``capacity`` has a bin of its own.
    """
    rooms: Tree = None
    bins, used = [], 0
    for size in sizes:
        found, rooms = take(rooms, (size, -1))
        if not found:
            found, used = (capacity, used), used + 1
            if most is not None and used > most:
                return None
        room, at = found
        bins.append(at)
        if room > size:
            rooms = put(rooms, (room - size, at))
    return bins


def even_bins(sizes: Sequence[int], count: int) -> list[int]:
    """The bin of each of ``sizes``, which descend, in ``count`` bins of near equal sizes.

    What is larger than an even share of all that follows has a bin of its own. The others are packed with
    the smallest capacity that suffices, found by halving.
    """
    rest, own = sum(sizes), 0
    while own < min(count - 1, len(sizes)) and sizes[own] * (count - own) >= rest:
        rest -= sizes[own]
        own += 1
    sizes, count = sizes[own:], count - own
    if not sizes:
        return list(range(own))
    low, step = max(-(-rest // count), sizes[0]), 1
    found = best_fit(sizes, low, count)
    if found is None:
        bad, good = low, low
        while found is None:
            bad, good, step = good, good + step, 4 * step
            found = best_fit(sizes, good, count)
        while good - bad > 1:
            middle = (good + bad) // 2
            better = best_fit(sizes, middle, count)
            if better is None:
                bad = middle
            else:
                good, found = middle, better
    return [*range(own), *[own + b for b in found]]


def _described(docs: DataFrame, columns: Sequence[str]) -> DataFrame:
    narrow = pick(docs, "doc_id", "text", *columns)
    data = text_bytes(F.col("text"))
    return narrow.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.sha2(data, 256).alias("_group"),
        *columns,
    )


def _parcel(parcels: int) -> Column:
    return F.pmod(F.xxhash64("_group"), F.lit(parcels))


def _packed(items: DataFrame, shards: int | None, capacity: int | None) -> DataFrame:
    """``region, parcel, group, bin`` for the items of each region."""

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values(["bytes", "parcel", "group"], ascending=[False, True, True], na_position="last")
        sizes = batch["bytes"].tolist()
        bins = best_fit(sizes, capacity) if shards is None else even_bins(sizes, shards)
        return batch[["region", "parcel", "group"]].assign(bin=bins)

    return items.groupBy("region").applyInPandas(run, "region long, parcel long, group string, bin long")


def _items(groups: DataFrame, parcels: int, regions: int, grain: int) -> DataFrame:
    """``region, parcel, group, bytes``: groups of at least a grain, and of each parcel the rest, without group."""
    own = F.when(F.col("bytes") >= grain, F.col("_group"))
    placed = groups.select(_parcel(parcels).alias("parcel"), own.alias("group"), "bytes")
    summed = placed.groupBy("parcel", "group").agg(F.sum("bytes").alias("bytes"))
    return summed.select(F.pmod(F.xxhash64("parcel"), F.lit(regions)).alias("region"), "*")


def shard_groups(
    docs: DataFrame,
    shards: int | None = None,
    capacity: int | None = None,
    columns: Sequence[str] = (),
    fineness: int = FINENESS,
    per_key: int = PER_KEY,
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` and the named other columns for each row of ``docs(doc_id, text)``.

    Give either the number of ``shards``, which get near equal sizes, or the ``capacity`` in bytes of a shard.
    A size is the UTF-8 bytes of a text and one more. Rows of equal texts share a shard; null counts as empty.
    A group that is larger than an even share, or than the capacity, has a shard of its own, and with it alone
    a shard may pass the capacity. Slots count the rows of a shard from 0, by ``doc_id``, null first.

    Ties in size go by parcel and text hash. Repeated rows come back as often and take slots beside each other.
    Very long texts are hashed where they are read and are not moved. Other columns are ignored, whatever
    their names. An empty table gives an empty result. Some shards may stay empty where groups are few.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    if min(n for n in (shards, capacity, fineness) if n is not None) < 1:
        raise ValueError("shards, capacity and fineness must be positive")
    work = Workspace(docs.sparkSession)
    named = {f"_kept_{i}": c for i, c in enumerate(columns)}
    rows = _described(docs, columns).toDF("doc_id", "size", "text_crc32", "_group", *named)
    rows = work.stage(rows, "rows")
    sums = rows.groupBy("_group").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    groups = work.stage(sums, "groups")
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]

    about = shards or max(1, -(-total // capacity))
    parcels, regions = about * fineness, 1 if shards else -(-about // REGION)
    grain = max(1, total // parcels)
    items = _items(groups, parcels, regions, grain)
    bins = work.stage(_packed(items, shards, capacity), "bins")

    # Bins are numbered on from region to region.
    widths = bins.groupBy("region").agg((F.max("bin") + 1).alias("width"))
    before = Window.orderBy("region").rowsBetween(Window.unboundedPreceding, -1)
    firsts = widths.select("region", F.coalesce(F.sum("width").over(before), F.lit(0)).alias("first"))
    numbered = bins.join(F.broadcast(firsts) if regions == 1 else firsts, "region")
    shard = (F.col("first") + F.col("bin")).cast("int")
    alone = F.col("group").isNotNull()
    by_parcel = numbered.groupBy("parcel").agg(
        F.max(F.when(~alone, shard)).alias("shard"),
        F.map_from_entries(F.collect_list(F.when(alone, F.struct("group", shard.alias("shard"))))).alias("own"),
    )
    # A parcel with very many rows is copied, and its rows are dealt to the copies.
    heavy = groups.groupBy(_parcel(parcels).alias("parcel")).agg(F.expr(f"(sum(rows) - 1) div {per_key} + 1").alias("copies"))
    assigned = work.stage(by_parcel.join(heavy, "parcel"), "assigned")
    several = assigned.where("copies > 1").select("parcel", "copies")
    placed = with_place(rows, work).withColumn("parcel", _parcel(parcels)).join(several, "parcel", "left")
    copy = F.pmod(F.xxhash64(*ROW), F.coalesce(F.col("copies"), F.lit(1)))
    copies = assigned.select("parcel", "shard", "own", F.explode(F.expr("sequence(0, copies - 1)")).alias("copy"))
    found = placed.withColumn("copy", copy).drop("copies").join(copies, ["parcel", "copy"])
    found = found.withColumn("shard", F.coalesce(F.try_element_at("own", F.col("_group")), F.col("shard")))
    sharded = work.stage(found.select("doc_id", "size", "text_crc32", "shard", *ROW, *named), "sharded")

    put_in_order = ordered(sharded, ["shard", "doc_id", *ROW], work)
    starts = work.stage(offsets(put_in_order, ["shard"]), "offsets")
    return put_in_order.join(starts, ["shard", *PLACE]).select(
        "doc_id", "size", "text_crc32", "shard", rank().alias("slot"), *[F.col(c).alias(name) for c, name in named.items()]
    )
