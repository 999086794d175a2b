"""Operator 3: exact near-duplicate join of embeddings by pivots and the triangle inequality.

Vectors of one label are compared as points on the unit sphere, where a
cosine of at least ``threshold`` is a distance of at most
``r = sqrt(2 - 2 * threshold)``. Pivots, drawn per label from a bounded
sample, partition the space: a vector's home is its nearest pivot's cell. For
a neighbour at home with pivot ``q`` the triangle inequality gives
``d(x, q) <= d(x, p) + 2 r`` (and, sharper, a distance of at most ``r`` to the
plane between ``p`` and ``q``), so ``x`` is replicated to the cells of earlier
pivots that satisfy both, and to no other. Cells then join independently, in
block pairs when they are large, by exact double-precision products. A cell
returns one row per linked vector, never the pairs. Pivots only steer: any
choice gives the same links.

Exact copies (same label and components) are one class with a count.

Pivots are the only thing sent to every task: at most ``MAX_LABELS`` labels
times ``MAX_PIVOTS``. Labels beyond that, or with few vectors, are one cell.

Edge cases: a null label, a null vector, null or non-finite components and
zero vectors link with nothing; vectors of different lengths never link;
repeated rows are copies; a null id takes no part in choosing the smallest;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm import graph
from contrail.llm.common import stage_table
from contrail.llm.graph import linked

THRESHOLD = 0.98
#: Bounds of the pivot sample.
MAX_LABELS, MAX_PIVOTS, PER_PIVOT = 256, 64, 1000
BLOCK_VECTORS = 1024
#: Slack on distances, far above rounding and far below any distance that matters.
SLACK = 1e-9

VECTORS = "vec_id long, space string, vec_key binary, vector binary"
PLACED = "space string, vec_key binary, node long, copies long, vector binary, pivot int, home boolean"
LINKS = "node long, vec_key binary, links long, root long"


def _valid_vectors(batches):
    """Rows with a usable vector: id, space (label and length), content key, components as doubles."""
    import hashlib

    import pyarrow as pa

    for batch in batches:
        out: list[tuple] = []
        for vec, label, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            if label is None or not value.is_valid or not len(value) or value.values.null_count:
                continue
            x = value.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
            top = np.abs(x).max()
            if not np.isfinite(top) or top == 0:
                continue
            space = f"{len(x)}:{label}"
            raw = x.tobytes()
            out.append((vec, space, hashlib.blake2b(space.encode() + b"\0" + raw, digest_size=16).digest(), raw))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.string(), pa.binary(), pa.binary()))],
            names=["vec_id", "space", "vec_key", "vector"])


def unit(raw: list[bytes]) -> np.ndarray:
    """Stored vectors of one length as unit rows; scaled first, so that squares neither overflow nor vanish."""
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _pivots(classes: DataFrame, max_labels: int, max_pivots: int, per_pivot: int) -> dict[str, np.ndarray]:
    """Pivots by space, for the largest spaces: a bounded sample drawn by content hash."""
    spark = classes.sparkSession
    large = (classes.groupBy("space").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > per_pivot)
             .orderBy(F.desc("n"), "space").limit(max_labels).collect())
    if not large:
        return {}
    wanted = [(r.space, r.n, min(max_pivots, math.ceil(r.n / per_pivot))) for r in large]
    names = spark.createDataFrame(wanted, "wanted_space string, n long, k int")
    drawn = classes.join(F.broadcast(names), F.col("space") == F.col("wanted_space")).withColumn(
        "draw", F.pmod(F.xxhash64("vec_key"), F.col("n")))
    sample = drawn.where(F.col("draw") < 4 * F.col("k")).select("space", "k", "draw", "vec_key", "vector").collect()
    out: dict[str, list] = {}
    for r in sorted(sample, key=lambda r: (r.space, r.draw, bytes(r.vec_key))):
        if len(got := out.setdefault(r.space, [])) < r.k:
            got.append(bytes(r.vector))
    return {space: unit(raw) for space, raw in out.items() if len(raw) > 1}


def _place(pivots, radius: float):
    """Each vector in its home cell, and in the earlier cells where a neighbour may live."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            spaces = np.array(batch.column(0).to_pylist(), dtype=object)
            rows, cells, homes = [], [], []
            for space in dict.fromkeys(spaces):
                at = np.flatnonzero(spaces == space)
                p = pivots.value.get(space)
                if p is None:
                    rows.append(at)
                    cells.append(np.zeros(len(at), np.int32))
                    homes.append(np.ones(len(at), bool))
                    continue
                x = unit([batch.column(4)[int(i)].as_py() for i in at])
                far = np.sqrt(np.maximum(2 - 2 * (x @ p.T), 0))
                home = far.argmin(axis=1)
                near = far[np.arange(len(at)), home][:, None]
                apart = np.sqrt(np.maximum(2 - 2 * (p @ p.T), 0))[home]
                may = (far <= near + 2 * radius + SLACK) & (far**2 - near**2 <= 2 * radius * apart + SLACK)
                may &= np.arange(len(p))[None, :] < home[:, None]
                i, q = np.nonzero(may)
                rows += [at, at[i]]
                cells += [home.astype(np.int32), q.astype(np.int32)]
                homes += [np.ones(len(at), bool), np.zeros(len(i), bool)]
            if not rows:
                continue
            part = batch.take(pa.array(np.concatenate(rows)))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(np.concatenate(cells)), pa.array(np.concatenate(homes))],
                names=["space", "vec_key", "node", "copies", "vector", "pivot", "home"])

    return run


def _compare(threshold: float):
    def work(t):
        import pyarrow as pa

        if t.num_rows < 2:
            return None
        x = unit(t.column("vector").to_pylist())
        home = t.column("home").to_numpy()
        links = (x @ x.T >= threshold) & (home[:, None] | home[None, :])
        np.fill_diagonal(links, False)
        if t.column("low")[0] != t.column("high")[0]:
            block = t.column("block").to_numpy()
            links &= block[:, None] != block[None, :]
        has = links.any(axis=1)
        if not has.any():
            return None
        counts, roots = linked(links, t.column("node").to_numpy(), t.column("copies").to_numpy())
        keep = pa.array(np.flatnonzero(has))
        return pa.RecordBatch.from_arrays([
            t.column("node").take(keep).combine_chunks(), t.column("vec_key").take(keep).combine_chunks().cast(pa.binary()),
            pa.array(counts[has]), pa.array(roots[has])], names=["node", "vec_key", "links", "root"])

    return work


def links(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", label_col: str = "label",
          vector_col: str = "embedding", max_labels: int = MAX_LABELS, max_pivots: int = MAX_PIVOTS,
          per_pivot: int = PER_PIVOT, block_vectors: int = BLOCK_VECTORS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (smallest id reachable by links), kept."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    valid = rows.mapInArrow(_valid_vectors, VECTORS)
    classes = stage_table(
        valid.groupBy("vec_key").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"),
                                     F.first("space").alias("space"), F.first("vector").alias("vector"))
        .select("space", "vec_key", F.coalesce("first_id", F.xxhash64("vec_key")).alias("node"), "first_id", "copies", "vector"),
        "vectors")
    pivots = spark.sparkContext.broadcast(_pivots(classes, max_labels, max_pivots, per_pivot))
    radius = math.sqrt(max(2 - 2 * threshold, 0))
    placed = stage_table(classes.drop("first_id").mapInArrow(_place(pivots, radius), PLACED)
                         .withColumn("cell", F.concat_ws("/", "pivot", "space")).drop("space", "pivot"), "placed")
    cells = graph.spread(placed, "cell", "vec_key", F.lit(1), block_vectors, block_vectors)
    found = stage_table(graph.run_cells(cells, "cell", _compare(threshold), LINKS), "links")
    parts = graph.components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "_node")
    counted = found.groupBy("vec_key").agg(F.sum("links").alias("links")).withColumnRenamed("vec_key", "_key")
    parted = stage_table(
        classes.select("vec_key", "node", "first_id", "copies").join(counted, F.col("vec_key") == F.col("_key"), "left").drop("_key")
        .join(parts, F.col("node") == F.col("_node"), "left")
        .select(F.col("vec_key").alias("_key"), "node", "first_id",
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "node").alias("component")), "parts")
    per_class = stage_table(graph.named(parted).select("_key", "n_links", "least", "stays"), "per_class")
    keyed = stage_table(valid.select(F.col("vec_id").alias("_id"), "vec_key"), "keys")
    found = keyed.join(per_class, F.col("vec_key") == F.col("_key"))
    known = found.where("_id is not null").groupBy("_id").agg(F.max("n_links").alias("n_links"), F.min("least").alias("component"))
    out = rows.select("vec_id").where("vec_id is not null").join(known, F.col("vec_id") == F.col("_id"), "left")
    component = F.coalesce("component", "vec_id")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                     (component == F.col("vec_id")).alias("kept"))
    # Rows without an id are found by their vectors; those without a usable one link with nothing.
    nameless = found.where("_id is null").select(
        F.col("_id").alias("vec_id"), "n_links", F.col("least").alias("component_id"),
        (F.col("least").isNull() & F.col("stays")).alias("kept"))
    unusable = rows.where("vec_id is null").count() - keyed.where("_id is null").count()
    null = F.lit(None).cast("long")
    alone = spark.range(unusable).select(null.alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
                                         null.alias("component_id"), F.lit(True).alias("kept"))
    return out.union(nameless).union(alone)
