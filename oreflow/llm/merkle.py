"""Merkle manifest of a table: every row proves by its siblings' digests that it belongs to one root."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from oreflow.llm.common import Workspace

ARITY = 8
#: A level of a path: what a node's digest is put between before it is digested again.
#: Digests are kept as bytes, 32 each, and one after the other; what is digested is their hex text.
PATH = "array<struct<left: binary, right: binary>>"


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts one after the other, as lower-case hex."""
    return F.sha2(F.concat(*[p.cast("binary") for p in parts]), 256)


def shown(digests: Column) -> Column:
    """Digests as lower-case hex."""
    return F.lower(F.hex(digests))


def leaf(*values: Column) -> Column:
    """Digest of a row: ``-`` for each null, else the value's length in UTF-8 bytes, ``:`` and the value."""
    texts = [v.cast("string") for v in values]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def siblings(place: Column, arity: int = ARITY) -> Column:
    """The places of a node's run, its own among them: the last bit flipped, or the slots shifted round."""
    if arity == 2:
        return F.array(place, place.bitwiseXOR(F.lit(1).cast("long")))
    slot = F.pmod(place, F.lit(arity))
    return F.transform(F.sequence(F.lit(0), F.lit(arity - 1)), lambda s: place - slot + F.pmod(slot + s, F.lit(arity)))


def numbered(rows: DataFrame, tree: str, order: Sequence[str], work: Workspace) -> DataFrame:
    """Adds ``place`` (from 0, within ``tree``) and ``n`` (rows of the tree) by ``order``; nulls come first.

    Rows are sorted into ranges, written, and counted by range: a place is the row's number in its
    range less that of its tree's first row there, plus the rows of the tree in earlier ranges.  Ranges
    are cut within a tree too, so one tree may hold all rows; only a row a range and tree is summed.
    """
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    spread = rows.repartitionByRange(tree, *order, "_row").sortWithinPartitions(tree, *order, "_row").drop("_row")
    sorted_ = work.keep(spread.withColumn("_at", F.monotonically_increasing_id()), "sorted")
    marked = sorted_.withColumn("_range", F.shiftright("_at", 33))
    ranges = marked.groupBy(tree, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(tree).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = work.keep(
        ranges.select(
            F.col(tree).alias("_tree"),
            F.col("_range").alias("_r"),
            (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_base"),
            F.sum("_rows").over(Window.partitionBy(tree)).alias("n"),
        ),
        "ranges",
    )
    same = F.col(tree).eqNullSafe(F.col("_tree")) & (F.col("_range") == F.col("_r"))
    out = marked.join(ranges, same).withColumn("place", F.col("_at") + F.col("_base"))
    return out.select(*[c for c in rows.columns if c != "_row"], "place", "n")


@dataclass
class Trees:
    """Trees over leaves.  ``tops``: ``tree, subroot``; ``levels``: for each node below a root ``tree, place,
    n, own, left, right``, lowest level first; ``ends``: the roots that stand on each level."""

    tops: DataFrame
    levels: list[DataFrame]
    ends: list[DataFrame]


def grown(leaves: DataFrame, work: Workspace, arity: int = ARITY) -> Trees:
    """Trees over ``leaves`` (``tree``, ``place``, ``n``, ``digest`` as bytes), all trees level by level together.

    On each level a node asks for the places of its run (``siblings``) and an equijoin on tree and
    place answers; places from ``n`` on do not exist.  The answers, in order of place, are what
    stands left and right of the node; the row in slot 0 of a run emits the parent.  A run is never
    longer than ``arity``, so the busiest key of any step has that many rows, whatever the tree's size.
    """
    height, nodes, levels, ends = 0, leaves, [], []
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > arity**height:
        height += 1
    for _ in range(height):
        going = nodes.where("n > 1")
        ends.append(nodes.where("n = 1"))
        asks = going.select("tree", "place", "n", F.explode(siblings(F.col("place"), arity)).alias("other"))
        held = going.select(F.col("tree").alias("_tree"), F.col("place").alias("_place"), "digest")
        met = asks.where("other < n").join(held, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("other") == F.col("_place")))
        runs = met.groupBy("tree", "place", "n").agg(F.sort_array(F.collect_list(F.struct("other", "digest"))).alias("run"))
        joined = lambda keep: F.unhex(
            F.array_join(F.transform(F.filter("run", keep), lambda x: F.hex(x["digest"])), "")
        )
        level = runs.select(
            "tree",
            "place",
            "n",
            joined(lambda x: x["other"] == F.col("place")).alias("own"),
            joined(lambda x: x["other"] < F.col("place")).alias("left"),
            joined(lambda x: x["other"] > F.col("place")).alias("right"),
        )
        levels.append(work.keep(level, "level"))
        nodes = levels[-1].where(F.col("place") % arity == 0).select(
            "tree",
            F.floor(F.col("place") / arity).cast("long").alias("place"),
            F.ceil(F.col("n") / arity).cast("long").alias("n"),
            F.unhex(digest(shown(F.col("own")), shown(F.col("right")))).alias("digest"),
        )
    ends.append(nodes.where("n = 1"))
    tops = ends[0]
    for end in ends[1:]:
        tops = tops.unionByName(end)
    return Trees(tops.select("tree", F.col("digest").alias("subroot")), levels, ends)


def paths(trees: Trees, above: DataFrame, work: Workspace, arity: int = ARITY) -> DataFrame:
    """``tree, place, subroot, path`` for every leaf: what stands beside it and its ancestors, lowest first.

    ``above`` has ``tree, subroot, path`` for the roots.  From the top down every node takes on its
    parent's path, so a level is joined with one an ``arity``-th its size.
    """
    out = None
    for level, end in zip([*trees.levels, None][::-1], trees.ends[::-1], strict=True):
        ending = end.select("tree", "place").join(
            above.select(F.col("tree").alias("_tree"), "subroot", "path"), F.col("tree").eqNullSafe(F.col("_tree"))
        ).select("tree", "place", "subroot", "path")
        if level is not None:
            step = F.array(F.struct("left", "right")).cast(PATH)
            below = level.select("tree", "place", F.floor(F.col("place") / arity).cast("long").alias("up"), step.alias("step"))
            top = out.select(F.col("tree").alias("_tree"), F.col("place").alias("_place"), "subroot", F.col("path").alias("rest"))
            joined = below.join(top, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("up") == F.col("_place")))
            joined = joined.select("tree", "place", "subroot", F.concat("step", "rest").alias("path"))
            ending = joined.unionByName(ending)
        # The lowest level is the widest; it goes on to what asks for it without being written.
        out = ending if level is not None and level is trees.levels[0] else work.keep(ending, "paths")
    return out


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf's digest leads to along its path."""
    return F.aggregate(path, start, lambda at, step: digest(shown(step["left"]), at, shown(step["right"])))


def proof(path: Column) -> Column:
    """Digest of all siblings' digests along a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(shown(step["left"]), shown(step["right"]))), ""))


def manifest(
    rows: DataFrame,
    work: Workspace,
    leaf: Column,
    tree: str = "lang",
    order: str = "doc_id",
    extra: dict[str, Column] | None = None,
    arity: int = ARITY,
) -> DataFrame:
    """``order, tree, leaf, subroot, root, path`` and the columns of ``extra`` for each row of ``rows``.

    The rows of a value of ``tree`` are the leaves of one tree, in ascending ``order``; the roots of the trees, in
    ascending ``tree`` (null first, strings by bytes), are the leaves of the upper one, whose root is
    that of the whole table.  While a level has several nodes, every ``arity`` of them that follow each
    other become the digest of theirs; the last run may have fewer, even one.  A tree with one leaf has
    that as its root.  ``path`` leads from the leaf to the root of all (``folded``, ``proof``).

    A null tree is a tree of its own; rows with null ``order`` come first; rows with equal ``order`` go
    by their leaf, so that repeated rows change no digest by the order they are read in.  No row,
    no root: an empty table gives an empty result.  Columns of ``rows`` not named are left out.
    """
    extra = extra or {}
    named = rows.select(
        F.col(tree).alias("tree"), F.col(order).alias("_order"), F.unhex(leaf).alias("digest"), *[c.alias(f"_x_{k}") for k, c in extra.items()]
    )
    read = work.keep(named, "leaves")
    leaves = work.keep(numbered(read, "tree", ["_order", "digest"], work), "numbered")
    work.drop(read)
    trees = grown(leaves.select("tree", "place", "n", "digest"), work, arity)
    tops = work.keep(trees.tops, "tops")
    upper = numbered(tops.withColumn("_all", F.lit(0)), "_all", ["tree"], work)
    upper = work.keep(upper.select(F.lit("").alias("tree"), "place", "n", F.col("subroot").alias("digest"), F.col("tree").alias("_t")), "upper")
    crown = grown(upper.select("tree", "place", "n", "digest"), work, arity)
    root = crown.tops.first()
    root = root.subroot if root else None
    start = crown.tops.select("tree", "subroot", F.array().cast(PATH).alias("path"))
    over = paths(crown, start, work, arity).select(F.col("place").alias("_p"), "path")
    named_tops = upper.join(over, F.col("place") == F.col("_p"))
    above = work.keep(named_tops.select(F.col("_t").alias("tree"), F.col("digest").alias("subroot"), "path"), "above")
    ways = paths(trees, above, work, arity).withColumnsRenamed({"tree": "_tree", "place": "_place"})
    met = leaves.join(ways, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("place") == F.col("_place")))
    return met.select(
        F.col("_order").alias(order),
        F.col("tree").alias(tree),
        shown(F.col("digest")).alias("leaf"),
        shown(F.col("subroot")).alias("subroot"),
        F.lit(root and root.hex()).cast("string").alias("root"),
        "path",
        *[F.col(f"_x_{k}").alias(k) for k in extra],
    )
