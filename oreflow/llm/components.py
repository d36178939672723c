"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from oreflow.llm.common import Workspace


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of a batch: a link to the smallest member for each other one."""
    for batch in batches:
        a, b = (np.asarray(batch.column(i)) for i in (0, 1))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        parent = list(range(len(nodes)))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist(), strict=True):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        roots = np.fromiter((root(x) for x in range(len(nodes))), np.int64, len(nodes))
        child = roots != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[roots[child]]), pa.array(nodes[child])], names=["a", "b"])


def components(links: DataFrame, work: Workspace) -> DataFrame:
    """``node``, ``component`` for every node with a link; the component is its smallest node.

    ``links`` has ``a`` and ``b``, longs without nulls.  Every batch is first reduced to a forest by
    union-find.  Then each node hooks onto the smallest node next to it and the links are
    rewritten between the hooks, until none is left; the smallest node of a component never moves.
    Where many links lead to few nodes, as among copies, that takes a few rounds; a long chain of rising
    nodes is shortened by what lies in one batch each time, so a chain over very many batches takes
    many rounds.  All steps are joins and sums by key, so no component is ever in one task.
    """
    forest = "a long, b long"
    edges = work.keep(
        links.where("a <> b").mapInArrow(_forest, forest).distinct(), "links"
    )
    hooks: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("m"))
        hook = work.keep(near.select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "hooks")
        hooks.append(hook)
        left = hook.select(F.col("node").alias("a"), F.col("component").alias("ca"))
        right = hook.select(F.col("node").alias("b"), F.col("component").alias("cb"))
        moved = edges.join(left, "a").join(right, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        after = work.keep(moved.where("a <> b").mapInArrow(_forest, forest).distinct(), "links")
        work.drop(edges)
        edges = after
    if not hooks:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = hooks[-1]
    for hook in hooks[-2::-1]:
        later = out.select(F.col("node").alias("component"), F.col("component").alias("final"))
        out = hook.join(later, "component", "left").select(
            "node", F.coalesce("final", "component").alias("component")
        )
    return work.keep(out, "components") if len(hooks) > 1 else out
