"""Connected components of a graph given by its links."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from goldspine.sinks.staging import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: Links that one task contracts at once, of 16 bytes each.
PIECE_LINKS = 1 << 21


def least_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes of the links ``a, b`` in order, place in them of the least node that each is connected with)."""
    names, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = index[: len(a)], index[len(a) :]
    label = np.arange(len(names))
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        label = label[label]
        if (label == before).all():
            return names, label


def _stars(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """The links as one star for each of their components."""
    names, label = least_labels(a, b)
    hung = np.flatnonzero(label != np.arange(len(names)))
    return pa.RecordBatch.from_arrays([pa.array(names[hung]), pa.array(names[label[hung]])], names=["a", "b"])


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        rows += batch.num_rows
        if rows >= PIECE_LINKS:
            yield _stars(*map(np.concatenate, zip(*held)))
            held, rows = [], 0
    if rows:
        yield _stars(*map(np.concatenate, zip(*held)))


def _contract_in_tasks(links: DataFrame) -> DataFrame:
    """The links as stars, those of a task contracted together; distinct links bring as many rows as they are or fewer."""
    real = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    return stage(real.mapInArrow(_contracted, "a long, b long"), "component-links")


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``links`` (longs ``a``, ``b``): the least node it is connected with.

    Links are contracted inside tasks first. If no more than ``PIECE_LINKS`` are
    left, one task ends it. Else each node joins the one of least draw among
    itself and its neighbours, and the links between those that were joined go
    on. Draws are new in each round, so a round leaves a fixed share of the nodes
    (half of a long chain) and all rounds together move a fixed multiple of the
    links. The rounds' choices are then followed back, the last one first.
    """
    edges, rounds = _contract_in_tasks(links), []
    while edges.count() > PIECE_LINKS:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        draw = {c: F.xxhash64(F.lit(len(rounds)), c) for c in ("a", "b")}
        least = both.groupBy("a").agg(F.min_by("b", draw["b"]).alias("b"))
        chosen = stage(least.select(F.col("a").alias("node"), F.when(draw["b"] < draw["a"], F.col("b")).otherwise(F.col("a")).alias("to")), "component-rounds")
        rounds.append(chosen)
        moved = edges.join(chosen, F.col("a") == F.col("node")).select(F.col("to").alias("a"), "b")
        edges = _contract_in_tasks(moved.join(chosen, F.col("b") == F.col("node")).select("a", F.col("to").alias("b")))
    stars = stage(edges.coalesce(1).mapInArrow(_contracted, "a long, b long"), "component-stars")
    labels = stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
    if not rounds:
        return labels
    for chosen in reversed(rounds):
        reached = labels.withColumnRenamed("node", "to")
        labels = chosen.join(reached, "to", "left").select("node", F.coalesce("component", "to").alias("component"))
        labels = stage(labels, "component-labels")
    least = labels.groupBy("component").agg(F.min("node").alias("least"))
    return labels.join(least, "component").select("node", F.col("least").alias("component"))
