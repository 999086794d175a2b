"""Connected components and pair cells, shared by the near-duplicate operators.

``components`` alternates large-star and small-star steps, each one aggregate
and one join, with every step written to the shared folder. Minima are
combined map-side, and the joins read two exchanges, so that adaptive
execution can split the edges of a node that holds much of the graph.

``spread`` cuts cells (sets of rows whose pairs are to be compared) into
blocks; every pair of blocks becomes a sub-cell of bounded size, so no task
holds a whole hot cell. ``run_cells`` streams sub-cells, one at a time, to a
function over Arrow tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import stage_table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over distinct edges (u > v); large: larger neighbours move to the minimum."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = stage_table(both.groupBy("u").agg(F.min("v").alias("low"))
                        .select(F.col("u").alias("center"), F.least("u", "low").alias("low")), "least")
    joined = both.join(least, F.col("u") == F.col("center"))
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        out = joined.select(F.explode(F.array(F.struct(F.col("u").alias("u")), F.struct(F.col("v").alias("u")))).alias("x"),
                            F.col("low").alias("v")).select("x.u", "v")
    return stage_table(out.where("u <> v").distinct(), "edges")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b); component is its smallest node.

    Loops and repeated edges are allowed; edges with a null end are ignored.
    """
    edges = stage_table(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = _star(_star(edges, large=True), large=False)
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots).distinct()


def named(classes: DataFrame) -> DataFrame:
    """``classes`` (node, first_id, component) with ``least``, the component's smallest id, and ``stays``.

    ``stays`` marks the class that represents the component: the one of the
    smallest id, or of the smallest node where no row has an id (least is null).
    """
    least = classes.groupBy("component").agg(F.min("first_id").alias("least")).withColumnRenamed("component", "_component")
    out = classes.join(least, F.col("component") == F.col("_component")).drop("_component")
    return out.withColumn("stays", F.when(F.col("least").isNull(), F.col("node") == F.col("component"))
                          .otherwise(F.col("first_id").eqNullSafe(F.col("least"))))


def spread(rows: DataFrame, cell: str, split_by: str, weight: Column, block_weight: int, block_rows: int) -> DataFrame:
    """``rows`` once per sub-cell that needs them: adds block, low, high (low <= high).

    A cell of more than ``block_rows`` rows or ``block_weight`` total weight is
    cut into blocks by a hash of ``split_by``. Sub-cell (low, high) holds two
    blocks; pairs across them (within it, for low = high) are its own.
    """
    sizes = (rows.groupBy(cell).agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("w"))
             .select(F.col(cell).alias("_cell"),
                     F.greatest(F.ceil(F.col("n") / block_rows), F.ceil(F.col("w") / block_weight)).cast("int").alias("_blocks"))
             .where("_blocks > 1"))
    rows = rows.join(stage_table(sizes, "cells"), F.col(cell) == F.col("_cell"), "left")
    blocks = F.coalesce("_blocks", F.lit(1))
    return (rows.withColumn("block", F.pmod(F.xxhash64(F.lit(17), F.col(split_by)), blocks).cast("int"))
            .withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn("low", F.least("block", "_other")).withColumn("high", F.greatest("block", "_other"))
            .drop("_cell", "_blocks", "_other"))


def run_cells(rows: DataFrame, cell: str, work: Callable, schema: str) -> DataFrame:
    """``work`` on the Arrow table of each sub-cell, one at a time; yields its record batches."""
    keys = (cell, "low", "high")

    def run(batches):
        import pyarrow as pa

        held: list = []
        key = None
        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
            start, n = 0, batch.num_rows
            for i in range(n + 1):
                here = tuple(c[i] for c in cols) if i < n else key
                if here != key:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    if held:
                        out = work(pa.Table.from_batches(held))
                        if out is not None:
                            yield out
                    held, start, key = [], i, here
            if n > start:
                held.append(batch.slice(start))
        if held:
            out = work(pa.Table.from_batches(held))
            if out is not None:
                yield out

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def linked(links, nodes, copies):
    """From a symmetric boolean matrix without diagonal: links by copies, and the smallest node linked through it."""
    import numpy as np

    counts = links.astype(np.float64) @ copies.astype(np.float64)
    roots = nodes.copy()
    open_ = links.any(axis=1)
    for i in np.flatnonzero(open_):
        if not open_[i]:
            continue
        member = np.zeros(len(nodes), bool)
        member[i] = True
        front = member
        while front.any():
            front = links[front].any(axis=0) & ~member
            member |= front
        open_ &= ~member
        roots[member] = nodes[member].min()
    return counts.astype(np.int64), roots
