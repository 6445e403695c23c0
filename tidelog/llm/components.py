"""Connected components of a link table, without a driver or a task ever holding them all."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.sources.scratch import durable


def local_roots(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Smallest node of each node's component, for links u-v between nodes 0 to n-1."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[u], root[v])
        before = root.copy()
        np.minimum.at(root, root[u], low)
        np.minimum.at(root, root[v], low)
        while True:  # shorten chains to their end
            shorter = root[root]
            if np.array_equal(shorter, root):
                break
            root = shorter
        if np.array_equal(before, root):
            return root


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each batch as stars: (member, smallest member)."""
    for batch in batches:
        a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = local_roots(index[: len(a)], index[len(a) :], len(nodes))
        member = root != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[member]), pa.array(nodes[root[member]])], names=["u", "v"]
        )


def _shape(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """node, component for every node of `links` (two long columns); component: its smallest node.

    Alternates large-star and small-star steps until every component is one star.  Both are a
    minimum per node, combined on the map side, and an equi-join that adaptive execution may
    split at a hub.  Each step is written to the shared folder: lineage stays short and a lost
    executor costs one step.  Self-links, repeated links and nulls do no harm.
    """
    a, b = (F.col(links.columns[i]).cast("long") for i in (0, 1))
    both = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    stars = durable(
        both.where("u <> v").mapInArrow(_contract, "u long, v long").distinct()
    )
    shape = None
    while (now := _shape(stars)) != shape:
        shape = now
        # Large star: greater neighbours move to the smallest neighbour.
        around = stars.union(stars.select("v", "u"))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            around.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = durable(moved.union(lower.select("u", F.col("m").alias("v"))).distinct())
    members = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.union(centres)
