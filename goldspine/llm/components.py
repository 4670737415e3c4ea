"""Connected components of a graph given by its links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from goldspine.sinks.staging import stage

_PAIR = "a long, b long"


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's links as one star for each of its components: fewer, with the same components."""
    for batch in batches:
        ends = np.concatenate([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
        if not len(ends):
            continue
        names, index = np.unique(ends, return_inverse=True)
        a, b = index[: batch.num_rows], index[batch.num_rows :]
        label = np.arange(len(names))
        while True:
            low = np.minimum(label[a], label[b])
            before = label.copy()
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            label = label[label]
            if (label == before).all():
                break
        others = np.flatnonzero(label != np.arange(len(names)))
        yield pa.RecordBatch.from_arrays([pa.array(names[others]), pa.array(names[label[others]])], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable, for every node with a link.

    ``links`` has the longs ``a`` and ``b``. Rounds of alternately hanging every
    larger, and every smaller, neighbour on the smallest one; a graph becomes
    stars in a number of rounds that grows with the logarithm of its size, none
    if it is stars already. Each round is written, so a lost executor costs no
    earlier round.
    """
    both = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars = stage(both.mapInArrow(_local, _PAIR).distinct(), "stars")
    while not _settled(stars):
        # Every neighbour above a node hangs on the least of the node and its neighbours.
        around = stars.select("a", "b").unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = stage(around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "stars")
        # Every node and its neighbours below hang on the least of them.
        lowest = stage(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = stage(small.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct(), "stars")
    nodes = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _settled(stars: DataFrame) -> bool:
    """Whether every node hangs on one other at most, and on none that hangs itself."""
    hangs = stars.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    holds = stars.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    nodes = hangs.unionByName(holds).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()
