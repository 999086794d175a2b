"""Operator 13: alignment of two tokenizers over exactly deduplicated texts.

Rows are grouped by their full text, so that each distinct text is tokenized
and aligned once, however many copies it has; a copy is one unit of weight in
the pair counts. Two token sequences that spell the same bytes cut these bytes
at two sets of offsets. Between neighbours of the union of both sets lies
exactly one link (an A and a B token whose ranges overlap); offsets in both
sets end the groups.

Distinct texts are worked on in blocks of about ``BLOCK_BYTES``, the rows of
the table ``blocks``: the sorted distinct id pairs of the block with their
weighted counts, and for each text its measures and its links as numbers into
these pairs. The corpus-wide count of a pair is one aggregate over the blocks'
pairs. It goes back to the blocks, not to the texts: each block asks for each
of its pairs once. A pair that every block holds (a space, a comma) is salted
by the block, ``BLOCKS_PER_SALT`` blocks a salt, with the counts repeated per
salt. The highest counts per B id are broadcast: no more rows than that
tokenizer has ids.

Measures return to the rows by the text's SHA-256. Texts with at least a
thousandth of all rows, so a thousand texts at most, are broadcast; all others
are joined by a shuffle, and rows without tokens take no part in a join.

Edge cases: null and empty texts, and those whose A or B tokens spell other
bytes than a space and the text (for instance texts that hold U+2581), have
zeros and an empty hash; ids of any type, null and repeated ids and repeated
rows stay rows of their own (each counts); an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm import piece_codec
from contrail.llm.common import stage_table

BLOCK_BYTES = 4_000_000
#: Blocks that share one copy of the counts.
BLOCKS_PER_SALT = 1000
#: Marked words that a task holds.
MAX_CHUNKS = 200_000
#: Texts with one of so many parts of all rows are joined by a broadcast.
HOT_PARTS = 1000

MEASURES = ("n_a", "n_b", "n_groups", "n_links")
_TEXT = ("struct<key: binary, copies: long, n_a: long, n_b: long, n_groups: long, n_links: long, "
         "groups_sha256: string, links: binary>")
BLOCKS = f"block long, pairs array<long>, weights array<long>, texts array<{_TEXT}>"
PER_TEXT = ("key binary, copies long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
            "count_sum long, groups_sha256 string")


def byte_level_values() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable Latin-1 is itself, the rest counts on from 256."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteTokens:
    """Side A: a byte-level file of the ``tokenizers`` library, special tokens' strings being plain text.

    With a rank file of the same vocabulary, texts within the range where both
    libraries' letter classes agree take the faster encoder.
    """

    def __init__(self, tokenizer_json: str, ranks_file: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(tokenizer_json)
        self.own.encode_special_tokens = True
        self.fast = None
        if ranks_file:
            import base64
            import re

            import tiktoken

            with open(ranks_file, "rb") as f:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            self.other = re.compile("[\U00030000-\U0010ffff]")

    def _plain(self, text: str) -> bool:
        return self.fast is not None and not self.other.search(text)

    def encode(self, text: str) -> np.ndarray:
        if self._plain(text):
            return np.array(self.fast.encode_ordinary(text), np.int32)
        return np.array(self.own.encode(text, add_special_tokens=False).ids, np.int32)

    def spells(self, text: str) -> bool:
        """Whether tokens of the right length are sure to spell the text: ranks merge bytes that stand side by side."""
        return self._plain(text)

    def token_bytes(self) -> list[bytes]:
        value = byte_level_values()
        vocabulary = self.own.get_vocab(with_added_tokens=True)
        out = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            out[i] = bytes(map(value.__getitem__, token)) if all(c in value for c in token) else token.encode()
        return out


class PieceTokens:
    """Side B: a SentencePiece model, which puts a space in front of a text itself."""

    def __init__(self, model_file: str, by_chunk: bool):
        self.table = piece_codec.ChunkTable(model_file, by_chunk, MAX_CHUNKS)

    def encode(self, text: str) -> np.ndarray:
        return piece_codec.unpack(self.table.encode(text)).astype(np.int32)

    def spells(self, text: str) -> bool:
        """Whether tokens of the right length are sure to spell the text: marked words do, but for a marker as such."""
        return self.table.by_chunk and piece_codec.MARKER not in text

    def token_bytes(self) -> list[bytes]:
        model = self.table.model
        return [bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(piece_codec.MARKER, " ").encode()
                for i, piece in enumerate(map(model.id_to_piece, range(model.get_piece_size())))]


class Aligner:
    """Aligns blocks of texts; ``a`` and ``b`` encode, and give the bytes of their tokens."""

    def __init__(self, a, b):
        self.a, self.b = a, b
        self.bytes_a, self.bytes_b = a.token_bytes(), b.token_bytes()
        self.lens_a, self.lens_b = (np.array(list(map(len, x))) for x in (self.bytes_a, self.bytes_b))
        # Ids as text: within a group, at the end of its A ids, and at its end.
        self.written = [f"{i}{end}" for n, ends in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;"))
                        for i in range(n) for end in ends]

    def tokens(self, text: str | None):
        """Ids of both sides, or None where one of them does not spell a space and the text."""
        if not text:
            return None
        raw = b" " + text.encode()
        a, b = self.a.encode(" " + text), self.b.encode(text)
        for side, ids, lens, spelled in ((self.a, a, self.lens_a, self.bytes_a), (self.b, b, self.lens_b, self.bytes_b)):
            if lens[ids].sum() != len(raw):
                return None
            if not side.spells(text) and b"".join(map(spelled.__getitem__, ids.tolist())) != raw:
                return None
        return a, b

    def block(self, texts: list[str], copies: list[int]):
        """(pairs, weights, per text: key, copies, measures, hash of the groups, links) of a block."""
        both = [self.tokens(t) for t in texts]
        held = [k for k, ids in enumerate(both) if ids is not None]
        keys = [hashlib.sha256(t.encode()).digest() for t in texts]
        rows = [{"key": key, "copies": n, **dict.fromkeys(MEASURES, 0), "groups_sha256": "", "links": b""}
                for key, n in zip(keys, copies, strict=True)]
        if not held:
            return [], [], rows
        ids_a, ids_b = (np.concatenate([both[k][side] for k in held]) for side in (0, 1))
        first_a, first_b = (np.cumsum([0] + [len(both[k][side]) for k in held]) for side in (0, 1))
        # Both sides spell the same bytes, so offsets may run on through all texts. One flag a byte for each side's ends.
        ends_a, ends_b = np.cumsum(self.lens_a[ids_a]), np.cumsum(self.lens_b[ids_b])
        at_a, at_b = (np.zeros(ends_a[-1] + 1, bool) for _ in range(2))
        at_a[ends_a] = at_b[ends_b] = True
        links, groups = np.flatnonzero(at_a | at_b), at_a & at_b
        until_a, until_b = (np.cumsum(x, dtype=np.int32) for x in (at_a, at_b))  # tokens that end at a byte or before
        stops = ends_a[first_a[1:] - 1]
        n_links = np.diff(np.searchsorted(links, stops, "right"), prepend=0)
        pair = (ids_a.astype(np.int64)[until_a[links - 1]] << 32) | ids_b[until_b[links - 1]]
        hashes, n_groups = self._group_hashes(ids_a, ids_b, ends_a, ends_b, first_a, first_b, groups, until_a, until_b)
        del at_a, at_b, groups, until_a, until_b, ends_a, ends_b
        pairs, which = np.unique(pair, return_inverse=True)
        which = which.reshape(-1)
        weights = np.zeros(len(pairs), np.int64)
        own, counts = np.unique(np.repeat(np.arange(len(held)), n_links) * len(pairs) + which, return_counts=True)
        text, own = own // len(pairs), own % len(pairs)
        np.add.at(weights, own, counts * np.array(copies, np.int64)[held][text])
        bounds = np.searchsorted(text, np.arange(len(held) + 1))
        for j, k in enumerate(held):
            part = slice(bounds[j], bounds[j + 1])
            rows[k].update(n_a=len(both[k][0]), n_b=len(both[k][1]), n_groups=int(n_groups[j]), n_links=int(n_links[j]),
                           groups_sha256=hashes[j], links=pack_links(own[part], counts[part]))
        return pairs, weights, rows

    def _group_hashes(self, ids_a, ids_b, ends_a, ends_b, first_a, first_b, groups, until_a, until_b):
        """SHA-256 of ``a1,a2|b1;a3|b2,b3``, and the number of groups, of every text; ``groups`` flags their ends."""
        until = np.cumsum(groups, dtype=np.int32)
        places = np.flatnonzero(groups)
        # The A ids of a group come first: an A id follows the B ids of earlier groups, a B id also the A ids of its own.
        before_b = np.concatenate([[0], until_b[places]])
        after_a = until_a[places]
        out = np.empty(len(ids_a) + len(ids_b), np.int32)
        out[np.arange(len(ids_a)) + before_b[until[ends_a - 1]]] = 2 * ids_a + groups[ends_a]
        out[np.arange(len(ids_b)) + after_a[until[ends_b - 1]]] = 2 * (len(self.lens_a) + ids_b) + groups[ends_b]
        cuts = (first_a + first_b).tolist()
        hashes = [hashlib.sha256("".join(map(self.written.__getitem__, out[s:e].tolist()))[:-1].encode()).hexdigest()
                  for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
        return hashes, np.diff(until[ends_a[first_a[1:] - 1]], prepend=0)


def pack_links(pairs: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted numbers of pairs with their counts, compressed."""
    import zstandard

    steps = np.diff(pairs, prepend=0)
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate([steps, counts]).astype("<u4").tobytes())


def unpack_links(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    both = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), "<u4").astype(np.int64).reshape(2, -1)
    return np.cumsum(both[0]), both[1]


def _blocks(aligner, block_bytes: int):
    """Rows of ``BLOCKS`` from (text, copies); ``aligner`` makes the Aligner in the task."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        align = aligner()
        base, done = TaskContext.get().partitionId() << 32, 0
        text = pa.struct([("key", pa.binary()), ("copies", pa.int64()), *((k, pa.int64()) for k in MEASURES),
                          ("groups_sha256", pa.string()), ("links", pa.binary())])
        held: tuple[list, list] = ([], [])
        size = 0

        def flush():
            nonlocal held, size, done
            pairs, weights, rows = align.block(*held)
            out = pa.RecordBatch.from_arrays(
                [pa.array([base + done], pa.int64()), pa.array([pairs], pa.list_(pa.int64())),
                 pa.array([weights], pa.list_(pa.int64())), pa.array([rows], pa.list_(text))],
                names=["block", "pairs", "weights", "texts"])
            held, size, done = ([], []), 0, done + 1
            return out

        for batch in batches:
            for value, copies in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                held[0].append(value.as_py())
                held[1].append(copies)
                size += len(held[0][-1])
                if size >= block_bytes:
                    yield flush()
        if held[0]:
            yield flush()

    return run


def _measure(batches):
    """Rows of ``PER_TEXT`` from (texts, values): ``values`` are the pairs' counts times two, plus one for the highest."""
    import pyarrow as pa

    names = ("key", "copies", *MEASURES, "n_best", "count_sum", "groups_sha256")
    types = (pa.binary(), *[pa.int64()] * 7, pa.string())
    for batch in batches:
        for texts, values in zip(batch.column(0), batch.column(1), strict=True):
            rows = texts.as_py()
            values = np.zeros(0, np.int64) if not values.is_valid else values.values.to_numpy(zero_copy_only=False)
            for row in rows:
                row["n_best"] = row["count_sum"] = 0
                if row["links"]:
                    own, counts = unpack_links(row["links"])
                    row["n_best"] = int((counts * (values[own] & 1)).sum())
                    row["count_sum"] = int((counts * (values[own] >> 1)).sum())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in zip(names, types, strict=True)],
                                             names=list(names))


def text_key(text):
    """SHA-256 of a text with characters, else null."""
    return F.when(F.length(text) > 0, F.unhex(F.sha2(text.cast("binary"), 256)))


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair (A id times 2**32, plus B id), n (links that hold it, copies counted) and is_best (the most of its B id)."""
    counts = stage_table(blocks.select(F.explode(F.arrays_zip("pairs", "weights")).alias("x"))
                         .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.weights").alias("n")), "pair_counts")
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = counts.groupBy(b.alias("_b")).agg(F.max("n").alias("most"))  # a row per B id at most
    return counts.join(F.broadcast(most), b == F.col("_b")).select("pair", "n", (F.col("n") == F.col("most")).alias("is_best"))


def aligned_blocks(docs: DataFrame, aligner, text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The written table ``BLOCKS`` of the distinct texts of ``docs``."""
    texts = docs.select(F.col(text_col).alias("text")).where("length(text) > 0")
    distinct = texts.groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    return stage_table(distinct.mapInArrow(_blocks(aligner, block_bytes), BLOCKS), "blocks")


def align(docs: DataFrame, tokenizer_json: str, model_file: str, ranks_file: str | None = None, pattern: str | None = None,
          id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
          blocks_per_salt: int = BLOCKS_PER_SALT) -> DataFrame:
    """doc_id and the measures of each row's text.

    n_a, n_b (tokens), n_groups, n_links, n_best (links whose pair has the
    highest count of its B id), count_sum (of the links' pair counts), all
    long, and groups_sha256.
    """
    by_chunk = piece_codec.separable(model_file)

    def aligner():
        return Aligner(ByteTokens(tokenizer_json, ranks_file, pattern), PieceTokens(model_file, by_chunk))

    blocks = aligned_blocks(docs, aligner, text_col, block_bytes)
    salts = max(1, -(-blocks.count() // blocks_per_salt))
    counts = pair_counts(blocks).select("pair", (F.col("n") * 2 + F.col("is_best").cast("long")).alias("value"),
                                        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    asked = blocks.select("block", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt"),
                          F.explode("pairs").alias("pair"))
    # A block's distinct pairs, so no more than its bytes.
    answers = (asked.join(counts.hint("merge"), ["pair", "salt"]).groupBy("block")
               .agg(F.sort_array(F.collect_list(F.struct("pair", "value"))).alias("found")))
    answers = answers.select(F.col("block").alias("_block"), F.col("found.value").alias("values"))
    per_text = stage_table(blocks.join(answers.hint("merge"), F.col("block") == F.col("_block"), "left")
                           .select("texts", "values").mapInArrow(_measure, PER_TEXT), "per_text")
    rows = stage_table(docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("_key")), "rows")
    hot = per_text.where(F.col("copies") * HOT_PARTS >= rows.count())
    cold = per_text.join(F.broadcast(hot.select("key")), "key", "left_anti")
    numbers = [*MEASURES, "n_best", "count_sum"]
    held = rows.where("_key is not null")
    joined = [held.join(F.broadcast(hot), F.col("_key") == F.col("key")),
              held.join(F.broadcast(hot.select("key")), F.col("_key") == F.col("key"), "left_anti")
                  .join(cold.hint("merge"), F.col("_key") == F.col("key"))]
    none = rows.where("_key is null").select("doc_id", *[F.lit(0).cast("long").alias(c) for c in numbers],
                                             F.lit("").alias("groups_sha256"))
    out = [x.select("doc_id", *numbers, "groups_sha256") for x in joined]
    return out[0].unionByName(out[1]).unionByName(none)
