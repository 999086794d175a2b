"""Operator 4: n-gram Jaccard self-join by MinHash banding, verified on full n-gram sets.

Rows and bands are chosen for a target recall at the threshold. Every text is
hashed to its set of five-word shingles; the minima of keyed hashes form
bands, and texts shuffle on their band hashes. Members of a bucket hang on its
smallest member, and the connected components of these stars are the
candidate cells. Within a cell (cut into block pairs when it is large) the
full shingle sets decide: the exact intersection of every pair of texts is
computed by matrix products over frequent shingles and pair counts over rare
ones. What leaves a cell is one row per linked text: its number of links and
the smallest text reachable, never the pairs.

Exact copies are one class with a count. Two rows link if their texts' sets
have a Jaccard similarity of at least the threshold.

Scale: only band hashes (about 300 bytes a text) of all texts shuffle; full
sets are built for candidates alone, and shipped once per block pair.

Edge cases: null texts and texts without a word link with nothing; a text of
one to four words is one shingle; a null id takes no part in choosing the
smallest id, and rows of one id and different texts count as linked through
the id; repeated rows are copies; an empty table gives an empty result; extra
columns are kept by ``deduplicate`` and ignored by ``links``.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm import graph
from contrail.llm.common import (
    mix64,
    stage_table,
    text_bytes,
    text_chunks,
    window_hashes,
    word_bounds,
    word_hashes,
)
from contrail.llm.graph import linked

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
#: Hash functions that a signature may use.
MAX_HASHES = 192
#: A list of ids is broadcast up to this many bytes, and shuffled beyond.
BROADCAST_BYTES = 16_000_000
#: Shingles, and texts, in a block of a cell.
BLOCK_SHINGLES, BLOCK_TEXTS = 1_000_000, 1024

SIGNED = "doc_id long, text_key binary, n_shingles long, bands array<long>"
LINKS = "node long, text_key binary, links long, root long"


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows whose bands reach ``recall`` at ``threshold`` within ``max_hashes``."""
    best = None
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-threshold**rows))
        if bands * rows <= max_hashes:
            best = bands, rows
    if best is None:
        raise ValueError("recall needs more hashes than max_hashes")
    return best


def _shingles(column, words: int):
    """Runs of whole texts: (first text, last text, shingle hashes, bounds per text)."""
    for a, b in text_chunks(column):
        data, offsets = text_bytes(column.slice(a, b - a))
        starts, ends, first = word_bounds(data, offsets)
        hashes, bounds = window_hashes(word_hashes(data, starts, ends), first, words)
        yield a, b, hashes, bounds


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int) -> DataFrame:
    """Band hashes of every row with a word (schema ``SIGNED``)."""
    keys = np.random.default_rng(97).integers(0, 2**63, (bands, rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for a, b, hashes, bounds in _shingles(batch.column(2), words):
                has = np.flatnonzero(np.diff(bounds))
                if not len(has):
                    continue
                out = np.empty((len(has), bands), np.uint64)
                for i in range(bands):
                    h = np.full(len(has), i + 1, np.uint64)
                    for key in keys[i]:
                        h = mix64(h + np.minimum.reduceat(hashes * key, bounds[has]))
                    out[:, i] = h
                part = batch.slice(a, b - a).take(pa.array(has))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1).cast(pa.binary()), pa.array(np.diff(bounds)[has]),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(has) + 1, dtype=np.int32) * bands),
                                             pa.array(out.reshape(-1).view(np.int64)))],
                    names=["doc_id", "text_key", "n_shingles", "bands"])

    return docs.select(F.col(id_col).cast("long"), _text_key(F.col(text_col)), text_col).mapInArrow(run, SIGNED)


def intersections(codes: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    """n x n counts of shared codes; ``codes`` are distinct within an owner."""
    order = np.argsort(codes, kind="stable")
    codes, owners = codes[order], owners[order]
    heads = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    freq = np.diff(np.concatenate([heads, [len(codes)]]))
    counts = np.zeros((n, n), np.int32)
    flat = counts.reshape(-1)
    dense = max(8, n // 32)
    for f in np.unique(freq):
        if f < 2 or f > dense:
            continue
        at = heads[freq == f]
        i, j = np.triu_indices(f, 1)
        step = max(1, 1_000_000 // len(i))
        for k in range(0, len(at), step):
            members = owners[at[k:k + step, None] + np.arange(f)]
            np.add.at(flat, (members[:, i].astype(np.int64) * n + members[:, j]).reshape(-1), 1)
    counts += counts.T.copy()
    heavy = np.flatnonzero(freq > dense)
    for k in range(0, len(heavy), 2048):
        cols = heavy[k:k + 2048]
        lens = freq[cols]
        column = np.repeat(np.arange(len(cols)), lens)
        at = np.repeat(heads[cols], lens) + np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
        has = np.zeros((n, len(cols)), np.float32)
        has[owners[at], column] = 1
        counts += (has @ has.T).astype(np.int32)
    return counts


def _verify(threshold: float):
    """Work on one sub-cell: exact Jaccard of its pairs."""
    ratio = Fraction(str(threshold)).limit_denominator(10_000)
    over, under = ratio.numerator, ratio.numerator + ratio.denominator

    def work(t):
        import pyarrow as pa

        n = t.num_rows
        if n < 2:
            return None
        sets = [np.frombuffer(s, np.uint64) for s in t.column("shingles").to_pylist()]
        sizes = np.array([len(s) for s in sets], np.int64)
        shared = intersections(np.concatenate(sets), np.repeat(np.arange(n), sizes), n).astype(np.int64)
        links = shared * under >= over * (sizes[:, None] + sizes[None, :])
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
            t.column("node").take(keep).combine_chunks(), t.column("text_key").take(keep).combine_chunks().cast(pa.binary()),
            pa.array(counts[has]), pa.array(roots[has])], names=["node", "text_key", "links", "root"])

    return work


def _small(df: DataFrame, bytes_per_row: int) -> DataFrame:
    """``df`` (a written table) with a broadcast hint if it is proven small."""
    return F.broadcast(df) if df.count() * bytes_per_row <= BROADCAST_BYTES else df


def _candidate_sets(docs: DataFrame, candidates: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """Shingle sets (sorted hashes) of the candidate texts, from one row of each."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _text_key(F.col(text_col)).alias("text_key"),
                       F.col(text_col).alias("text"))
    lean = candidates.select("text_key", F.col("first_id").alias("_id"), "node", "cell", "copies")
    lean = _small(lean.withColumnRenamed("text_key", "_key"), 64)
    rows = rows.join(lean, (F.col("text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for a, b, hashes, bounds in _shingles(batch.column(4), words):
                sets = [np.unique(hashes[x:y]) for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.binary()), part.column(1), part.column(2), part.column(3),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["text_key", "node", "cell", "copies", "n_shingles", "shingles"])

    sets = rows.select("text_key", "node", "cell", "copies", "text").mapInArrow(
        run, "text_key binary, node long, cell long, copies long, n_shingles long, shingles binary")
    return sets.dropDuplicates(["text_key"])


def _links(docs, id_col, text_col, words, threshold, recall):
    """(signed rows, classes with node, first id and copies, links per text) as written tables."""
    bands, rows = choose_bands(threshold, recall)
    signed = stage_table(signatures(docs, id_col, text_col, words, bands, rows), "signed")
    classes = stage_table(
        signed.groupBy("text_key").agg(
            F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"),
            F.max("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
        .withColumn("node", F.coalesce("first_id", F.xxhash64("text_key"))), "classes")
    buckets = classes.select("node", F.explode("bands").alias("bucket"))
    shared = stage_table(
        buckets.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select(F.col("bucket").alias("shared_bucket"), "leader"), "buckets")
    stars = buckets.join(shared, F.col("bucket") == F.col("shared_bucket")).select(
        F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    cells = graph.components(stars).withColumnsRenamed({"node": "_node", "component": "cell"})
    candidates = stage_table(
        classes.drop("bands").join(cells, F.col("node") == F.col("_node")).drop("_node"), "candidates")
    sets = stage_table(_candidate_sets(docs, candidates, id_col, text_col, words), "sets")
    spread = graph.spread(sets, "cell", "text_key", F.col("n_shingles"), BLOCK_SHINGLES, BLOCK_TEXTS)
    found = stage_table(graph.run_cells(spread, "cell", _verify(threshold), LINKS), "links")
    return signed, classes, found


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
          threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, class_id (smallest id reachable by links), n_links, kept.

    A class without any id has a null class_id; there, the rows of the text that stands for it are kept.
    """
    signed, classes, found = _links(docs, id_col, text_col, words, threshold, recall)
    per_class = _per_class(classes, found)
    named = per_class.select(F.col("text_key").alias("_key"), "n_links", "least", "stays")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _text_key(F.col(text_col)).alias("text_key"))
    out = rows.join(named, F.col("text_key") == F.col("_key"), "left")
    class_id = F.when(F.col("_key").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    kept = F.when(F.col("_key").isNull(), True).when(F.col("least").isNull(), F.col("stays")).otherwise(
        F.col("doc_id").eqNullSafe(F.col("least")))
    return out.select("doc_id", class_id.alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                      kept.alias("kept"))


def _per_class(classes: DataFrame, found: DataFrame) -> DataFrame:
    """text_key, node, first_id, copies, n_links, component, least, stays of every class, written."""
    parts = graph.components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))).withColumnRenamed(
        "node", "_node")
    counted = found.groupBy("text_key").agg(F.sum("links").alias("links")).withColumnRenamed("text_key", "_key")
    out = (classes.drop("bands", "n_shingles").join(counted, F.col("text_key") == F.col("_key"), "left").drop("_key")
           .join(parts, F.col("node") == F.col("_node"), "left").drop("_node"))
    return stage_table(graph.named(stage_table(out.select(
        "text_key", "node", "first_id", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component")), "parts")), "per_class")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``docs`` with one row of every class: the smallest id's. Rows without a word are classes of their own."""
    signed, classes, found = _links(docs, id_col, text_col, words, threshold, recall)
    stays = _per_class(classes, found).select(
        F.col("text_key").alias("_key"), F.col("first_id"), "stays")
    # What goes, as (text, id): rows of a class that is not first, and copies that are not the first.
    ids = signed.groupBy("text_key", "doc_id").agg(F.count(F.lit(1)).alias("n_rows"))
    verdict = ids.join(stays, F.col("text_key") == F.col("_key")).select(
        F.col("text_key").alias("_key"), F.col("doc_id").alias("_id"), "n_rows",
        (F.col("stays") & F.col("doc_id").eqNullSafe(F.col("first_id"))).alias("stays"))
    special = stage_table(verdict.where("not stays or n_rows > 1"), "verdict")
    columns = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"),
                       _text_key(F.col(text_col)).alias("text_key"), F.col(id_col).cast("long").alias("doc_id"))
    rows = held.join(_small(special, 48), (F.col("text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    single = rows.where("stays is null").select("_row")
    repeated = rows.where("stays").dropDuplicates(["text_key", "doc_id"]).select("_row")
    return single.union(repeated).select(*[F.col("_row").getField(c).alias(c) for c in columns])
