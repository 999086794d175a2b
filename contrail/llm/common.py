"""Helpers shared by the training-data operators: word rule, batch hashing, tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.session import work_path

#: A word is a run of characters other than space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_KEYS = np.random.default_rng(20240131).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words (null: 0), evaluated in the JVM."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def stage_table(df: DataFrame, *parts: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts lineage like ``checkpoint()``, but keeps column pruning for readers
    that need a few of the columns.
    """
    spark = df.sparkSession
    path = work_path(spark, "llm", *parts)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int, step: np.uint64 = _STEP) -> np.ndarray:
    out = np.full(n, step, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Arrow string column -> (bytes, offsets from 0); nulls are empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offs[0]:offs[-1]], offs - offs[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray):
    """(starts, ends, first word of each text with a closing entry), in bytes."""
    inside = ~_SPACE[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    begin[cuts] = inside[cuts]
    starts = np.flatnonzero(begin)
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    heads = cuts[cuts > 0] - 1
    stop[heads] = inside[heads]
    ends = np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: a keyed polynomial over its bytes, finalised."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    total = int(lens.sum())
    firsts = np.cumsum(lens) - lens
    at = np.arange(total) - np.repeat(firsts, lens)
    powers = _powers(int(lens.max()))
    terms = _BYTE_KEYS[data[np.repeat(starts, lens) + at]] * powers[at]
    return mix64(np.add.reduceat(terms, firsts) + lens.astype(np.uint64))


def window_hashes(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``width``-word windows of each text, with their bounds.

    A text with fewer words, but at least one, has a single window: all of it.
    Windows never cross texts. Returns (hashes, first window of each text).
    """
    counts = np.diff(first)
    n = len(words)
    acc = np.zeros(n, np.uint64)
    factors = _powers(width, np.uint64(0xD6E8FEB86659FD93))
    for j in range(min(width, n)):
        acc[:n - j] += words[j:] * factors[j]
    windows = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(windows)])
    total = int(bounds[-1])
    pos = np.arange(total) - np.repeat(bounds[:-1], windows) + np.repeat(first[:-1], windows)
    out = acc[pos]
    for k in np.flatnonzero((counts > 0) & (counts < width)):
        few = words[first[k]:first[k + 1]]
        out[bounds[k]] = (few * factors[:len(few)]).sum(dtype=np.uint64) + np.uint64(len(few))
    return mix64(out), bounds


def text_chunks(batch_column, limit: int = 1_000_000):
    """Cut a text column into runs of whole texts of about ``limit`` bytes each."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch_column), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for k, size in enumerate(sizes):
        if k > begin and held + size > limit:
            yield begin, k
            begin, held = k, 0
        held += int(size)
    if len(sizes) > begin:
        yield begin, len(sizes)
