"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, partitions, skewed_lookup, tidy

LOCAL_LINKS = 1 << 20  #: links that a task contracts at once, 16 bytes each


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node that isn't the least of its component, and that least node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = np.arange(len(nodes))
    x, y = at[: len(a)], at[len(a) :]
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while True:  # shortcut
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, label):
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a task, replaced by stars that connect the same nodes."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def emit() -> pa.RecordBatch:
        u, v = forest(np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held]))
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    n = 0
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        n += batch.num_rows
        if n > LOCAL_LINKS:
            yield emit()
            held, n = [], 0
    if n:
        yield emit()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and root, the least node of its component, for every node of links but those linked to themselves only.

    A written table. Works on written tables of links throughout, so nothing is gathered anywhere; tasks contract their
    links first, which takes dense groups down to stars. Rounds end when nothing changes, or when LOCAL_LINKS links are
    left at most, which one task finishes.
    """
    n = partitions(links.sparkSession)
    links = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).filter("u <> v")
    links = links.repartition(n, F.least("u", "v"), F.pmod(F.xxhash64(F.greatest("u", "v")), F.lit(64))).mapInArrow(tidy(_contract), "u long, v long")
    links = materialize(links.distinct(), "links")
    state = None
    while True:
        new = links.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if new[0] <= LOCAL_LINKS:
            links = materialize(links.repartition(1).mapInArrow(tidy(_contract), "u long, v long"), "components")
        if new == state or new[0] <= LOCAL_LINKS:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = new
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # The centre of a star has as many links as its component has nodes: what each node meets is looked up.
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("deg")), "large-least")
        large = skewed_lookup(both.filter("v > u"), least, "u", "deg", F.col("v")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = materialize(large, "large-star")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("deg")), "small-least")
        small = skewed_lookup(large, least, "u", "deg", F.col("v")).select("u", "v", "m")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(small.select("u", F.col("m").alias("v"))).distinct()
        links = materialize(small, "small-star")
