"""Operator 6: interpolated modified Kneser-Ney bigram model, counted in Spark.

Training texts are hashed to words per task; each task aggregates its word
pairs and ships them to the shard of the first word's hash, as one compact
blob per shard (first words, run lengths, second words, counts). A shard sums
its pairs, which are complete there, and writes sorted hash arrays to the
shared folder: pair hashes with counts, and contexts with their total and
their numbers of followers seen once, twice and more often. It passes each
second word's number of distinct predecessors and its count on to that word's
shard, which writes the sorted word arrays. The driver sees a few numbers per
shard: counts of counts for the discounts, tokens and words.

Scoring maps the arrays into memory (pages are shared by the workers of a
host and dropped under pressure) and looks up the distinct pairs of a run of
texts by binary search, in sorted order, so the model may exceed memory.

Tokens: A-Z in lower case; words, then one end per text. An unseen word has
the probability that the discounts leave over, spread evenly over the words
and one unknown.

Edge cases: null and empty texts are one end; a null id counts as the text ''
when texts are split into training and held out; with no training text every
probability is 1; repeated rows count as often as they occur; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import os
import struct

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import mix64, text_bytes, text_chunks, word_bounds, word_hashes
from contrail.session import work_path

#: Tokens whose pairs a task aggregates before it ships them, and characters of text per shard.
FLUSH_TOKENS, CHARS_PER_SHARD = 4_000_000, 20_000_000

START, END = np.uint64(0x5B1D3C7E9F2A4861), np.uint64(0xC2A7E4198D5F3B60)
SHIPPED = "shard int, kind int, blob binary"
STATS = "kind int, n1 long, n2 long, n3 long, n4 long, total long, size long"
_PAIRS, _WORDS, _STATS = 0, 1, 2

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def token_runs(column, limit: int = 1_000_000):
    """Runs of whole texts: (first text, last text, token hashes, bounds); each text closes with END."""
    for a, b in text_chunks(column, limit):
        data, offsets = text_bytes(column.slice(a, b - a))
        data = _LOWER[data]
        starts, ends, first = word_bounds(data, offsets)
        bounds = first + np.arange(len(first))
        tokens = np.full(bounds[-1], END, np.uint64)
        mask = np.ones(len(tokens), bool)
        mask[bounds[1:] - 1] = False
        tokens[mask] = word_hashes(data, starts, ends)
        yield a, b, tokens, bounds


def previous(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The token before each one; START at the head of a text."""
    out = np.empty_like(tokens)
    out[1:] = tokens[:-1]
    out[bounds[:-1]] = START
    return out


def pair_hash(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix64(u * np.uint64(0x9E3779B97F4A7C15) + w)


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of the hash, so their arrays in order are sorted as a whole."""
    return (((h >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int32)


def _sum_pairs(u, w, c):
    """Distinct pairs, sorted by their hash: (hash, u, w, summed counts)."""
    g = pair_hash(u, w)
    order = np.argsort(g, kind="stable")
    g = g[order]
    head = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    at = order[head]
    return g[head], u[at], w[at], np.add.reduceat(c[order].astype(np.int64), head)


def _blob(*arrays) -> bytes:
    import zstandard

    parts = [zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes()) for a in arrays]
    return struct.pack(f"<{len(parts)}q", *map(len, parts)) + b"".join(parts)


def _unblob(blob: bytes, *types):
    import zstandard

    lens = struct.unpack_from(f"<{len(types)}q", blob)
    at, out = 8 * len(types), []
    for n, t in zip(lens, types, strict=True):
        out.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[at:at + n]), t))
        at += n
    return out


def _batch(rows):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                       pa.array([r[2] for r in rows], pa.binary())], names=["shard", "kind", "blob"])


def _ship_pairs(shards: int, flush_tokens: int):
    """Word pairs of the task's texts, summed, one blob per shard and flush."""

    def flush(held):
        u, w = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        _, u, w, c = _sum_pairs(u, w, np.ones(len(u), np.int64))
        order = np.lexsort((w, u))
        u, w, c = u[order], w[order], c[order]
        cuts = np.searchsorted(shard_of(u, shards), np.arange(shards + 1))
        for s in range(shards):
            a, b = cuts[s], cuts[s + 1]
            if b > a:
                head = np.flatnonzero(np.concatenate([[True], u[a + 1:b] != u[a:b - 1]]))
                runs = np.diff(np.concatenate([head, [b - a]])).astype(np.uint32)
                yield _batch([(s, _PAIRS, _blob(u[a:b][head], runs, w[a:b], c[a:b].astype(np.uint32)))])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for _, _, tokens, bounds in token_runs(batch.column(0)):
                held.append((previous(tokens, bounds), tokens))
                size += len(tokens)
                if size >= flush_tokens:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return run


def _save(path: str, array: np.ndarray) -> None:
    """Write an array; a retried task replaces the file by the same content at once."""
    import uuid

    if "://" in path:
        import pyarrow.fs as pafs

        fs, at = pafs.FileSystem.from_uri(path)
        part = f"{at}.{uuid.uuid4().hex}"
        with fs.open_output_stream(part) as f:
            f.write(np.ascontiguousarray(array))
        fs.move(part, at)
        return
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        f.write(np.ascontiguousarray(array))
    os.replace(part, path)


def _map(path: str, dtype) -> np.ndarray:
    """A saved array, mapped into memory; one on remote storage is first copied to an unlinked local file."""
    import tempfile

    if "://" not in path:
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
    import shutil

    import pyarrow.fs as pafs

    fs, at = pafs.FileSystem.from_uri(path)
    with tempfile.TemporaryFile() as local:
        with fs.open_input_stream(at) as f:
            shutil.copyfileobj(f, local)
        return np.memmap(local, dtype, "r") if local.tell() else np.zeros(0, dtype)


def _per_shard(batches):
    """(shard, blobs by kind) of rows sorted by shard."""
    shard, held = None, {}
    for batch in batches:
        for s, kind, blob in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if s != shard:
                if held:
                    yield shard, held
                shard, held = s, {}
            held.setdefault(kind, []).append(blob)
    if held:
        yield shard, held


def _stats(kind: int, counts: np.ndarray, total: int) -> bytes:
    return struct.pack("<7q", kind, *(int((counts == k).sum()) for k in (1, 2, 3, 4)), int(total), len(counts))


def _sum_shard(folder: str, shards: int):
    """Write a shard's pair and context arrays; pass on its second words and numbers."""

    def run(batches):
        for shard, held in _per_shard(batches):
            parts = [_unblob(b, np.uint64, np.uint32, np.uint64, np.uint32) for b in held[_PAIRS]]
            u = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
            w, c = (np.concatenate([p[k] for p in parts]) for k in (2, 3))
            del parts, held
            g, u, w, c = _sum_pairs(u, w, c)
            _save(f"{folder}/pairs-{shard}", g)
            _save(f"{folder}/pair_counts-{shard}", c.astype(np.uint32))
            yield _batch([(-1 - shard, _STATS, _stats(_PAIRS, c, c.sum()))])
            del g
            order = np.argsort(u, kind="stable")
            su, sc = u[order], c[order]
            head = np.flatnonzero(np.concatenate([[True], su[1:] != su[:-1]]))
            sums = [np.add.reduceat(x.astype(np.int64), head) for x in (sc, sc == 1, sc == 2, sc >= 3)]
            _save(f"{folder}/contexts-{shard}", su[head])
            _save(f"{folder}/context_counts-{shard}", np.stack(sums, axis=1).astype(np.uint64))
            order = np.argsort(w, kind="stable")
            sw, sc = w[order], c[order]
            head = np.flatnonzero(np.concatenate([[True], sw[1:] != sw[:-1]]))
            before = np.diff(np.concatenate([head, [len(sw)]])).astype(np.uint32)
            seen = np.add.reduceat(sc, head).astype(np.uint64)
            sw = sw[head]
            cuts = np.searchsorted(shard_of(sw, shards), np.arange(shards + 1))
            for s in range(shards):
                a, b = cuts[s], cuts[s + 1]
                if b > a:
                    yield _batch([(s, _WORDS, _blob(sw[a:b], before[a:b], seen[a:b]))])

    return run


def _sum_words(folder: str):
    """Write a shard's word arrays; return all numbers."""

    def run(batches):
        import pyarrow as pa

        out = []
        for shard, held in _per_shard(batches):
            out += [struct.unpack("<7q", b) for b in held.get(_STATS, ())]
            if _WORDS in held:
                parts = [_unblob(b, np.uint64, np.uint32, np.uint64) for b in held[_WORDS]]
                w, before, seen = (np.concatenate([p[k] for p in parts]) for k in range(3))
                order = np.argsort(w, kind="stable")
                w = w[order]
                head = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
                before = np.add.reduceat(before[order].astype(np.uint64), head)
                seen = np.add.reduceat(seen[order], head)
                _save(f"{folder}/words-{shard}", w[head])
                _save(f"{folder}/word_counts-{shard}", np.stack([before, seen], axis=1))
                out.append(struct.unpack("<7q", _stats(_WORDS, before, before.sum())))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], pa.int32() if k == 0 else pa.int64()) for k in range(7)],
                names=["kind", "n1", "n2", "n3", "n4", "total", "size"])

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and at least 3; 0.5 where counts of counts do not define them."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    raw = [k - (k + 1) * y * b / a if a else 0.5 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(d if 0 < d < k else 0.5 for k, d in zip((1, 2, 3), raw, strict=True))


def train(texts: DataFrame, text_col: str = "text", flush_tokens: int = FLUSH_TOKENS,
          chars_per_shard: int = CHARS_PER_SHARD) -> dict:
    """Count ``texts`` and write the arrays. Returns the model: folder, shards, totals and discounts."""
    spark = texts.sparkSession
    chars = texts.agg(F.sum(F.length(text_col))).first()[0] or 0
    shards = max(1, -(-chars // chars_per_shard))
    folder = work_path(spark, "llm", "model")
    local = folder.removeprefix("file:")
    if local.startswith("/"):
        folder = "/" + local.lstrip("/")
        os.makedirs(folder, exist_ok=True)
    pairs = texts.select(text_col).mapInArrow(_ship_pairs(shards, flush_tokens), SHIPPED)
    words = (pairs.repartition(shards, "shard").sortWithinPartitions("shard")
             .mapInArrow(_sum_shard(folder, shards), SHIPPED))
    stats = (words.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(_sum_words(folder), STATS)
             .groupBy("kind").agg(*[F.sum(c).alias(c) for c in ("n1", "n2", "n3", "n4", "total", "size")]).collect())
    by_kind = {r.kind: r for r in stats}
    pair, word = by_kind.get(_PAIRS), by_kind.get(_WORDS)
    return {
        "folder": folder, "shards": shards,
        "tokens": pair.total if pair else 0, "words": word.size if word else 0, "pairs": word.total if word else 0,
        "pair_discounts": discounts(pair.n1, pair.n2, pair.n3, pair.n4) if pair else (0.5,) * 3,
        "word_discounts": discounts(word.n1, word.n2, word.n3, word.n4) if word else (0.5,) * 3,
        "word_left": _left(word) if word else 1.0,
    }


def _left(word) -> float:
    """Probability that the discounts take from the words, over all predecessors."""
    d = discounts(word.n1, word.n2, word.n3, word.n4)
    many = word.size - word.n1 - word.n2
    return (d[0] * word.n1 + d[1] * word.n2 + d[2] * many) / word.total


class Arrays:
    """Sorted arrays of one kind, mapped shard by shard on first use."""

    def __init__(self, folder: str, keys: str, values: str, dtype, width: int, shards: int):
        self.folder, self.names, self.dtype, self.width, self.shards = folder, (keys, values), dtype, width, shards
        self.open: dict[int, tuple] = {}

    def shard(self, s: int):
        if s not in self.open:
            keys, values = (f"{self.folder}/{name}-{s}" for name in self.names)
            try:
                self.open[s] = _map(keys, np.uint64), _map(values, self.dtype).reshape(-1, self.width)
            except FileNotFoundError:  # no key fell into this shard
                self.open[s] = np.zeros(0, np.uint64), np.zeros((0, self.width), self.dtype)
        return self.open[s]

    def find(self, keys: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """Values of ``keys`` (0 where missing); keys of a shard stand together, in order."""
        out = np.zeros((len(keys), self.width), np.float64)
        cuts = np.searchsorted(shard, np.arange(self.shards + 1))
        for s in np.flatnonzero(np.diff(cuts)):
            have, values = self.shard(int(s))
            if not len(have):
                continue
            want = keys[cuts[s]:cuts[s + 1]]
            at = np.minimum(np.searchsorted(have, want), len(have) - 1)
            hit = have[at] == want
            out[cuts[s]:cuts[s + 1]][hit] = values[at[hit]]
        return out


def _discount(c: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.where(c <= 0, 0.0, np.where(c < 2, d[0], np.where(c < 3, d[1], d[2])))


def _score(model: dict):
    n, v, shards = model["tokens"], model["words"], model["shards"]

    def run(batches):
        import pyarrow as pa

        pairs = Arrays(model["folder"], "pairs", "pair_counts", np.uint32, 1, shards)
        contexts = Arrays(model["folder"], "contexts", "context_counts", np.uint64, 4, shards)
        words = Arrays(model["folder"], "words", "word_counts", np.uint64, 2, shards)
        d = np.array(model["pair_discounts"])
        for batch in batches:
            for a, b, tokens, bounds in token_runs(batch.column(2)):
                vocabulary, at = np.unique(np.concatenate([tokens, [START]]), return_inverse=True)
                shard = shard_of(vocabulary, shards)
                before, seen = words.find(vocabulary, shard).T
                alone = (before - _discount(before, model["word_discounts"])) / max(model["pairs"], 1)
                alone += model["word_left"] / (v + 1)
                total, *few = contexts.find(vocabulary, shard).T
                left = (d[0] * few[0] + d[1] * few[1] + d[2] * few[2]) / np.maximum(total, 1)
                left[total == 0] = 1.0
                base = np.log10((seen + 0.5) / (n + 0.5 * (v + 1)))
                w, u = at[:-1], previous(at[:-1].astype(np.uint64), bounds).astype(np.int64)
                u[bounds[:-1]] = at[-1]
                code, which = np.unique(u * len(vocabulary) + w, return_inverse=True)
                cu, cw = code // len(vocabulary), code % len(vocabulary)
                g = pair_hash(vocabulary[cu], vocabulary[cw])
                order = np.lexsort((g, shard[cu]))
                count = np.empty(len(code))
                count[order] = pairs.find(g[order], shard[cu][order])[:, 0]
                p = (count - _discount(count, model["pair_discounts"])) / np.maximum(total[cu], 1) + left[cu] * alone[cw]
                sums = [np.add.reduceat(x, bounds[:-1]) for x in
                        (np.log10(p)[which], base[w], (seen > 0)[w].astype(np.int64))]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.diff(bounds)), pa.array(sums[2]),
                     pa.array(np.full(b - a, n, np.int64)), pa.array(sums[1]), pa.array(sums[0])],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def held_out(id_col: Column, folds: int = 5, fold: int = 1) -> Column:
    """True for rows whose id's CRC-32 falls into the held-out fold."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds == fold


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """n_tokens, n_known, train_tokens, base_score and score (log10) of every text."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), text_col).mapInArrow(
        _score(model), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def train_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the training folds of ``docs`` and score all of it."""
    texts = docs.where(~held_out(F.col(id_col))).select(F.coalesce(text_col, F.lit("")).alias("text"))
    return score(docs, train(texts), id_col, text_col)
