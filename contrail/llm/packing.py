"""Operator 2: sum-of-squares online packing of tokenized documents into windows.

Each document becomes its token ids followed by an end id. Whole windows of a
long document stand alone; the rest (less than a window) is placed online at
the fill level that keeps the sum of squared counts of partially filled
windows smallest. The counts are held in a level array (one entry per fill
level), so a placement is one vectorised look at the levels. When a task's
rows end, or when more windows are open than fit in memory, the open windows
are completed by cutting the emptiest ones into the gaps of the fullest, which
leaves one padded window per task at most.

Packing runs where the rows are read: no shuffle. Sequence ids are unique
across tasks (task number times 2**40 plus a counter).

Edge cases: a null or empty text is the end id alone; null, repeated ids and
repeated rows are packed as rows of their own; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
SEQUENCES = ("sequence_id long, input_ids array<int>, n_tokens long, "
             "pieces array<struct<doc_id: long, start: long, length: long, doc_tokens: long, offset: long>>")
#: Windows that a task holds open before it completes them by cutting.
MAX_OPEN = 8192


class Window:
    """A sequence under construction: pieces of (doc, start, ids, doc_tokens)."""

    __slots__ = ("fill", "pieces")

    def __init__(self):
        self.fill, self.pieces = 0, []

    def add(self, piece) -> None:
        self.pieces.append(piece)
        self.fill += len(piece[2])


class LevelPacker:
    """Sum-of-squares placement into windows of ``size`` tokens."""

    def __init__(self, size: int, max_open: int = MAX_OPEN):
        self.size, self.max_open, self.n_open = size, max_open, 0
        self.counts = np.zeros(size + 1, dtype=np.int64)
        self.levels: list[list[Window]] = [[] for _ in range(size + 1)]

    def add(self, doc, ids: np.ndarray) -> Iterator[Window]:
        """Place a document; yields the windows that it fills."""
        whole = len(ids) // self.size * self.size
        for start in range(0, whole, self.size):
            w = Window()
            w.add((doc, start, ids[start:start + self.size], len(ids)))
            yield w
        if whole == len(ids):
            return
        piece = (doc, whole, ids[whole:], len(ids))
        n = len(ids) - whole
        level = self._level(n)
        if level:
            window = self.levels[level].pop()
            self.counts[level] -= 1
            self.n_open -= 1
        else:
            window = Window()
        window.add(piece)
        if window.fill == self.size:
            yield window
            return
        self.levels[window.fill].append(window)
        self.counts[window.fill] += 1
        self.n_open += 1
        if self.n_open > self.max_open:
            yield from self.complete(keep=True)

    def _level(self, n: int) -> int:
        """Level whose use changes the sum of squared counts least; the fullest on ties."""
        c = self.counts
        last = self.size - n
        change = 2 * c[n:self.size + 1].copy()  # level h moves to h + n; a filled window leaves the array
        change[last] = -1
        change[1:] -= 2 * c[1:last + 1] - 1
        change[1:][c[1:last + 1] == 0] = np.iinfo(np.int64).max
        return int(last - np.argmin(change[::-1]))

    def complete(self, keep: bool = False) -> Iterator[Window]:
        """Fill open windows from the emptiest ones, cutting pieces; ``keep`` holds the last one open."""
        open_ = [w for level in reversed(self.levels) for w in level]
        self.levels = [[] for _ in range(self.size + 1)]
        self.counts[:] = 0
        self.n_open = 0
        i, j = 0, len(open_) - 1
        while i < j:
            full, donor = open_[i], open_[j]
            doc, start, ids, total = donor.pieces.pop()
            take = min(self.size - full.fill, len(ids))
            donor.fill -= take
            if take < len(ids):
                donor.pieces.append((doc, start, ids[:-take], total))
            full.add((doc, start + len(ids) - take, ids[-take:], total))
            if not donor.fill:
                j -= 1
            if full.fill == self.size:
                yield full
                i += 1
        if i == j:
            if keep:
                self.levels[open_[i].fill].append(open_[i])
                self.counts[open_[i].fill] += 1
                self.n_open = 1
            else:
                yield open_[i]


def encoder(tokenizer_json: str, ranks_file: str | None, pattern: str | None):
    """Texts -> token ids, as the ``tokenizers`` file defines them.

    With a rank file of the same vocabulary, plain texts take the faster
    byte-pair encoder; texts with a special token's string, or characters
    outside the range where both libraries' letter classes agree, take the
    file's own.
    """
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_json)

    def plain(text: str) -> np.ndarray:
        return np.array(own.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    if not ranks_file:
        return plain
    import base64
    import re

    import tiktoken

    with open(ranks_file, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    special = [t.content for t in own.get_added_tokens_decoder().values()]
    special = re.compile("|".join([*map(re.escape, special), "[\U00030000-\U0010ffff]"]))

    def encode(text: str) -> np.ndarray:
        if special.search(text):
            return plain(text)
        return np.array(fast.encode_ordinary(text), dtype=np.uint32)

    return encode


def pack(docs: DataFrame, tokenizer_json: str, ranks_file: str | None = None, pattern: str | None = None,
         size: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
         sequences: bool = False) -> DataFrame:
    """Pieces of documents in windows of ``size`` tokens (schema ``PIECES``).

    With ``sequences``, one row per window instead: its ids, and its pieces
    in order (schema ``SEQUENCES``). A window is as long as its ids; a reader
    pads it to ``size`` unless its length is a power of two.
    """

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encode = encoder(tokenizer_json, ranks_file, pattern)
        packer = LevelPacker(size)
        ids_so_far = TaskContext.get().partitionId() << 40

        def rows(windows):
            nonlocal ids_so_far
            out = []
            for w in windows:
                at, pieces = 0, []
                for doc, start, ids, total in w.pieces:
                    pieces.append((doc, start, ids, total, at))
                    at += len(ids)
                out.append((ids_so_far, at, pieces))
                ids_so_far += 1
            return out

        def table(done):
            if sequences:
                return pa.RecordBatch.from_pylist([{
                    "sequence_id": s, "n_tokens": n,
                    "input_ids": np.concatenate([p[2] for p in pieces]).astype(np.int32),
                    "pieces": [{"doc_id": d, "start": b, "length": len(x), "doc_tokens": t, "offset": o}
                               for d, b, x, t, o in pieces]} for s, n, pieces in done], schema=schema)
            flat = [(d, b, len(x), zlib.crc32(x.astype("<u4").tobytes()), t, s, o)
                    for s, _, pieces in done for d, b, x, t, o in pieces]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*flat, strict=True)], schema=schema)

        if sequences:
            piece = pa.struct([(k, pa.int64()) for k in ("doc_id", "start", "length", "doc_tokens", "offset")])
            schema = pa.schema([("sequence_id", pa.int64()), ("input_ids", pa.list_(pa.int32())),
                                ("n_tokens", pa.int64()), ("pieces", pa.list_(piece))])
        else:
            schema = pa.schema([(k, pa.int64()) for k in ("doc_id", "start", "length", "ids_crc32",
                                                          "doc_tokens", "sequence_id", "offset")])
        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            done = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.concatenate([encode(text.as_py() or ""), end])
                done += packer.add(doc, ids)
                if len(done) >= 2048:
                    yield table(rows(done))
                    done = []
            if done:
                yield table(rows(done))
        done = list(packer.complete())
        if done:
            yield table(rows(done))

    return docs.select(id_col, text_col).mapInArrow(run, SEQUENCES if sequences else PIECES)
