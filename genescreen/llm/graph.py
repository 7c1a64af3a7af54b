"""Connected components over a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genescreen.llm.common import stored

#: Links that a task contracts at once, 16 bytes each.
PIECE = 500_000


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of links (a, b) that isn't the smallest one reachable over them, and that smallest one."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b, root = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if np.array_equal(low, high):
            break
        np.minimum.at(root, high, low)
        while not np.array_equal(root, root[root]):
            root = root[root]
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that join the same nodes as those of the batches, by pieces of about PIECE links, each turned into stars."""
    held: list[pa.RecordBatch] = []

    def joined() -> pa.RecordBatch:
        a, b = (np.concatenate([x.column(c).to_numpy(zero_copy_only=False) for x in held]) for c in ("a", "b"))
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in stars(a, b)], ["a", "b"])

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= PIECE:
            yield joined()
            held = []
    if held:
        yield joined()


def _settled(links: DataFrame) -> bool:
    """Are the links stars: does each node that points to another one do so once, and nothing point to it?"""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(links.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    return ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 or (out = 1 and into = 1)").isEmpty()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Smallest node reachable from each node of (a, b) links, as (node, root); nodes without a link are absent.

    Tasks of about PIECE links each turn these into stars. Until they are stars as a whole, a round takes a large-star and a small-star
    step (Kiveris et al. 2014) over all links, each a grouped minimum and a join. A node with very many neighbours is only ever
    aggregated map-side or joined, never gathered in one task. Each step is written to the shared folder before another one reads it
    twice. An empty table gives an empty one; a = b is ignored.
    """
    links = stored(links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b"))
    for _ in range(most_rounds):
        n_tasks = -(-max(1, links.count()) // PIECE)
        links = stored(links.coalesce(n_tasks).mapInArrow(_contracted, "a long, b long"))
        if n_tasks == 1 or _settled(links):
            break
        # large-star: each node's larger neighbours point to the smallest of its neighbours and itself
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small-star: each node and its smaller neighbours point to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        links = stored(large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("x")).select("x.*").where("a <> b").distinct())
    else:
        raise RuntimeError("the components did not settle")
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
