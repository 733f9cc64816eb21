"""A Merkle manifest of a dataset, with a proof for every row, found by pointer jumping.

Rows are leaves. The leaves of a group, in order, are hashed in runs of ``fan`` to nodes, these again,
until one subroot is left; the subroots of all groups are hashed to the root in the same way.

A proof needs the siblings on the way from a leaf to the root. Each node above the leaves first holds the
segment to its parent: what stands left and right of it in its run. A self-join on the node that a segment
ends in doubles the distance: the two segments are concatenated, and the node points where the other one
did. After as many rounds as the depth has binary digits all nodes reach the root; then each leaf takes
the path of the node above it, with its own siblings in front.

Ranks, runs and paths are DataFrames throughout. Leaves are put in order by ranges, so that a group may
hold most of the rows. At distance ``d`` a node has ``fan ** d`` nodes below it that join with it; beyond
``per_key`` of them they are dealt to as many copies of it as that takes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.frames import Workspace, pick
from assayer.llm.ranking import PLACE, offsets, ordered, rank

FAN = 8
#: Rows that may join with one copy of a node.
PER_KEY = 4096
#: The tree over the subroots; the groups' trees count from 0.
TOP = -1
_PATH = "array<struct<left:string,right:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value, so that no two rows read alike."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    return digest(F.concat(*[encoded(v) for v in values]))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path make."""
    return F.aggregate(path, leaf, lambda below, step: digest(F.concat(step["left"], below, step["right"])))


def siblings(path: Column) -> Column:
    """All digests of a proof in one text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def runs(nodes: DataFrame, level: int, fan: int, *more: str) -> DataFrame:
    """The nodes of the next level: ``tree, level, idx, n, members, digest``. A run has ``fan`` members at most.

    ``n`` is how many nodes the tree has on the level; a tree with one node has come to its root.
    """
    member = F.struct("idx", "digest", *more)
    gathered = nodes.groupBy("tree", "n", F.expr(f"idx div {fan}").alias("up")).agg(
        F.sort_array(F.collect_list(member)).alias("members")
    )
    return gathered.select(
        "tree",
        F.lit(level).alias("level"),
        F.col("up").alias("idx"),
        F.expr(f"(n + {fan - 1}) div {fan}").alias("n"),
        "members",
        digest(F.array_join("members.digest", "")).alias("digest"),
    )


def _step() -> Column:
    """What stands left and right of the member at ``pos`` of its run."""
    digests, pos = F.col("members.digest"), F.col("pos")
    left = F.array_join(F.slice(digests, F.lit(1), pos), "")
    return F.struct(left.alias("left"), F.array_join(F.slice(digests, pos + 2, F.size(digests)), "").alias("right"))


def _node(tree: Column, level: Column, idx: Column) -> Column:
    return F.struct(
        tree.cast("int").alias("tree"), level.cast("int").alias("level"), idx.cast("long").alias("idx")
    )


def links(nodes: DataFrame, fan: int) -> DataFrame:
    """``node, up, path`` for each member of a run: the node above it, and the step there."""
    members = nodes.select("*", F.posexplode("members").alias("pos", "member"))
    return members.select(
        _node(F.col("tree"), F.col("level") - 1, F.col("idx") * fan + F.col("pos")).alias("node"),
        _node(F.col("tree"), F.col("level"), F.col("idx")).alias("up"),
        F.array(_step()).cast(_PATH).alias("path"),
    )


def jump(linked: DataFrame, root: Column, widest: int, fan: int, per_key: int, work: Workspace) -> DataFrame:
    """``linked`` with all pointers moved to ``root``, and the whole paths there.

    ``widest`` is the number of all leaves; with the distance it bounds what joins with one node.
    """
    paths, distance = work.stage(linked, "paths"), 1
    while not paths.where(F.col("up") != root).isEmpty():
        copies = -(-min(fan**distance, widest) // per_key)
        salt = F.pmod(F.xxhash64("node"), F.lit(copies)).cast("int")
        # Other nodes cannot be that far above a node that has a path.
        far = paths.where((F.col("node.tree") == TOP) | (F.col("node.level") > distance))
        far = far.select(
            F.col("node").alias("up"),
            F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("salt"),
            F.col("up").alias("next"),
            F.col("path").alias("rest"),
        )
        near = paths.where(F.col("up") != root).withColumn("salt", salt)
        moved = near.join(far, ["up", "salt"]).select("node", F.col("next").alias("up"), F.concat("path", "rest").alias("path"))
        further = work.stage(paths.where(F.col("up") == root).union(moved), "paths")
        work.drop(paths)
        paths, distance = further, 2 * distance
    return paths


@dataclass(frozen=True)
class Manifest:
    """``root``: the digest of the whole dataset, None without rows. ``groups``: ``<group>, subroot, n``.
    ``proofs``: each leaf's row with ``leaf, subroot, path``; ``folded(leaf, path)`` is the root."""

    root: str | None
    groups: DataFrame
    proofs: DataFrame


def manifest(
    leaves: DataFrame, group: str, order: str, fan: int = FAN, per_key: int = PER_KEY, work: Workspace | None = None
) -> Manifest:
    """The tree over ``leaves``, which have ``group``, ``order``, ``leaf`` (a digest) and other columns to keep.

    A group's leaves ascend by ``order``, nulls first; ties go by their digests, and leaves equal in both are
    alike. Groups ascend bytewise, null first, and null is a group of its own. Repeated rows are leaves
    as often as they occur. Without leaves there is no root, and the tables are empty.
    """
    if fan < 2:
        raise ValueError("a run needs two members or more")
    work = work or Workspace(leaves.sparkSession)
    kept = [c for c in leaves.columns if c not in (group, "leaf")]
    placed = ordered(work.stage(leaves, "leaves"), [group, order, "leaf"], work)
    starts = work.stage(offsets(placed, [group]), "offsets")

    # Groups are numbered in their order; these numbers are their places in the tree over the subroots.
    sizes = ordered(starts.groupBy(group).agg(F.sum("_rows").alias("n")), [group], work)
    trees = sizes.join(offsets(sizes, []), PLACE).select(
        F.col(group).alias("_group"), "n", rank().cast("int").alias("tree")
    )
    trees = work.stage(trees, "trees")
    count, most, total = trees.agg(F.count(F.lit(1)), *[F.coalesce(f("n"), F.lit(0)) for f in (F.max, F.sum)]).first()

    # Joined with the small table first, so that the leaves are joined once.
    named = starts.join(trees, F.col(group).eqNullSafe(F.col("_group"))).select(
        *[F.col(c).alias(f"{c}_at") for c in PLACE], "_group", "tree", "n", "_first", "_before"
    )
    same = [placed[c] == named[f"{c}_at"] for c in PLACE]
    numbered = placed.join(named, [*same, placed[group].eqNullSafe(named["_group"])]).select(
        "tree", "n", rank().alias("idx"), F.col("leaf").alias("digest"), group, *kept
    )

    floor = work.stage(runs(numbered, 1, fan, group, *kept), "level")
    # A tree of one leaf has that leaf for its subroot, on level 0, not the hash of its run.
    alone = (F.col("n") == 1) & (F.size("members") == 1)
    lone = floor.where(alone).select("tree", F.lit(0).alias("level"), F.col("members")[0]["digest"].alias("digest"))
    tops = lone.union(floor.where((F.col("n") == 1) & ~alone).select("tree", "level", "digest"))
    levels, wide = [floor], -(-most // fan)
    while wide > 1:
        level = work.stage(runs(levels[-1].where("n > 1"), len(levels) + 1, fan), "level")
        tops = tops.union(level.where("n = 1").select("tree", "level", "digest"))
        levels.append(level)
        wide = -(-wide // fan)
    tops = work.stage(tops, "subroots")

    above, wide = [], count
    nodes = tops.select(F.lit(TOP).alias("tree"), F.lit(count).alias("n"), F.col("tree").cast("long").alias("idx"), "digest")
    while wide > 1:
        above.append(work.stage(runs(nodes, len(above) + 1, fan), "top"))
        nodes, wide = above[-1], -(-wide // fan)

    last = above[-1] if above else tops.withColumn("idx", F.lit(0))
    found = last.select("tree", "level", "idx", "digest").first()
    root = _node(*[F.lit(found[c]) for c in ("tree", "level", "idx")]) if found else None
    groups = trees.join(tops, "tree").select(F.col("_group").alias(group), F.col("digest").alias("subroot"), "n")

    linked = [links(level, fan) for level in [*levels[1:], *above[1:]]]
    if above:
        # Below the tree over the subroots stand the groups' own top nodes.
        subroot = tops.select(
            F.col("tree").cast("long").alias("idx"), _node(F.col("tree"), F.col("level"), F.lit(0)).alias("own")
        )
        first = links(above[0], fan).withColumn("idx", F.col("node.idx"))
        linked.append(first.join(subroot, "idx").select(F.col("own").alias("node"), "up", "path"))

    none = F.array().cast(_PATH)
    carriers = floor.join(tops.select("tree", F.col("level").alias("height"), F.col("digest").alias("subroot")), "tree")
    alone = F.col("height") == 0
    carriers = carriers.withColumn("at", _node(F.col("tree"), F.when(alone, 0).otherwise(1), F.col("idx")))
    if linked:
        paths = jump(reduce(DataFrame.union, linked), root, total, fan, per_key, work)
        carriers = carriers.join(paths.select(F.col("node").alias("at"), "path"), "at", "left")
        rest = F.coalesce(F.col("path"), none)
    else:
        rest = none
    member = F.posexplode("members").alias("pos", "member")
    rows = carriers.select("members", "subroot", alone.alias("alone"), rest.alias("rest"), member)
    own = F.when(F.col("alone"), none).otherwise(F.array(_step()).cast(_PATH))
    proofs = rows.select(
        *[F.col("member")[c].alias(c) for c in (group, *kept)],
        F.col("member")["digest"].alias("leaf"),
        "subroot",
        F.concat(own, F.col("rest")).alias("path"),
    )
    return Manifest(found["digest"] if found else None, groups, proofs)


def tampered_proofs(
    docs: DataFrame,
    columns: Sequence[str],
    group: str,
    order: str,
    changed: Mapping[str, Column],
    where: Column,
    fan: int = FAN,
    per_key: int = PER_KEY,
) -> DataFrame:
    """``order, leaf, subroot, root, proof_sha256, folded_root, verified`` for each row of ``docs``.

    A leaf is the digest of ``columns``, nulls told apart from all values. ``changed`` has the values that some
    columns have when the rows ``where`` points at are checked; each row is checked against its proof as it is then.

    Null ids come first in their group. Empty and very long texts are hashed whole, where they are read. Repeated
    rows each have a leaf and a proof. Columns not named are ignored; an empty table gives an empty result.
    """
    work = Workspace(docs.sparkSession)
    narrow = pick(docs, *dict.fromkeys([*columns, group, order]))
    leaf = leaf_digest(*[F.col(c) for c in columns])
    now = F.when(where, leaf_digest(*[changed.get(c, F.col(c)) for c in columns])).otherwise(leaf)
    leaves = narrow.select(group, order, leaf.alias("leaf"), now.alias("checked"))
    made = manifest(leaves, group, order, fan, per_key, work)
    root = F.lit(made.root).cast("string")
    checked = made.proofs.withColumn("folded_root", folded(F.col("checked"), F.col("path")))
    return checked.select(
        order,
        "leaf",
        "subroot",
        root.alias("root"),
        digest(siblings(F.col("path"))).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )
