"""Operator 11: SentencePiece encoding and decoding through a distinct-chunk table.

Where no piece of a model goes on over a whitespace marker, and none holds a
line feed beside other characters, a text's segmentation is that of its marked
words: stretches of spaces with the word behind them, and line feeds with the
word behind them. Each task keeps a table of the distinct marked words it has
met, has the library segment each of them once, and joins their ids back by
position. Tables live in the tasks that read the texts, so nothing shuffles,
and no word list of the whole corpus, which grows with it, is shipped anywhere.

A table that grows beyond ``MAX_CHUNKS`` words starts anew (words are then
segmented again), and words of over ``LONG_CHUNK`` characters are segmented
where they stand, so a task's memory does not depend on its texts. Models that
do not meet the condition (:func:`separable`) have whole texts segmented by the
library.

Ids travel as ``ids``, little-endian unsigned 32-bit integers in one binary
value per text; :func:`unpack` gives an array.

Edge cases: a null or empty text has the begin and end ids alone (none without
``add_ids``) and decodes to an empty text; ids of any type, null and repeated
ids and repeated rows stay rows of their own; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import text_chunks

MARKER = "▁"
#: Distinct marked words that a task holds, and the length up to which a word is held.
MAX_CHUNKS, LONG_CHUNK = 500_000, 128
_CHUNK = re.compile(r"(?:\x20+|\n)[^\x20\n]*")


def _processor(model_file: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_file)


def separable(model_file: str) -> bool:
    """Whether marked words of a text segment alone: see the module's text.

    Asks for texts that are taken as they are behind one marker, for bytes as
    a fallback (else neighbouring unknown characters make one token), and that
    no piece joins a marker to what precedes it, or a line feed to anything.
    """
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(model_file, "rb") as f:
        model.ParseFromString(f.read())
    normalizer = model.normalizer_spec
    as_is = (not normalizer.precompiled_charsmap and normalizer.add_dummy_prefix and normalizer.escape_whitespaces
             and not normalizer.remove_extra_whitespaces and not model.denormalizer_spec.precompiled_charsmap)
    if not as_is or model.trainer_spec.treat_whitespace_as_suffix or not model.trainer_spec.byte_fallback:
        return False
    return not any(MARKER in p.piece.lstrip(MARKER) or "\n" in p.piece for p in model.pieces)


class ChunkTable:
    """Ids of texts, each distinct marked word segmented once."""

    def __init__(self, model_file: str, by_chunk: bool, max_chunks: int = MAX_CHUNKS):
        self.model, self.by_chunk, self.max_chunks = _processor(model_file), by_chunk, max_chunks
        self.ids: dict[str, bytes] = {}

    def _segment(self, texts: list[str]) -> list[bytes]:
        from array import array

        return [array("I", ids).tobytes() for ids in self.model.encode(texts, num_threads=1)]

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, without begin and end."""
        if not self.by_chunk:
            return self._segment([text])[0]
        if not text:
            return b""
        chunks = _CHUNK.findall(" " + text.replace(MARKER, " "))
        missing = list(set(chunks).difference(self.ids))
        if missing:
            if len(self.ids) + len(missing) > self.max_chunks:
                self.ids = {}
                missing = list(set(chunks))
            # A line feed in front keeps the library's own marker apart: it is the first token, the feed the second.
            self.ids.update(zip(missing, (ids[8:] for ids in self._segment(["\n" + c for c in missing])), strict=True))
        out = b"".join(map(self.ids.__getitem__, chunks))
        if len(self.ids) > self.max_chunks:
            self.ids = {}
        for chunk in missing:
            if len(chunk) > LONG_CHUNK:
                self.ids.pop(chunk, None)
        return out


def unpack(ids: bytes):
    """The ids of one text as a numpy array."""
    import numpy as np

    return np.frombuffer(ids, "<u4")


def n_tokens(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", add_ids: bool = True,
           max_chunks: int = MAX_CHUNKS) -> DataFrame:
    """doc_id and ids of every whole text; with ``add_ids``, between the model's begin and end ids."""
    by_chunk = separable(model_file)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        table = ChunkTable(model_file, by_chunk, max_chunks)
        head, tail = ((np.array([i], "<u4").tobytes() for i in (table.model.bos_id(), table.model.eos_id()))
                      if add_ids else (b"", b""))
        for batch in batches:
            for a, b in text_chunks(batch.column(1)):
                part = batch.slice(a, b - a)
                ids = [head + table.encode(t or "") + tail for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the text that the library's ``decode(ids)`` gives, as ``decoded``."""

    def run(batches):
        import pyarrow as pa

        model = _processor(model_file)
        for batch in batches:
            for a, b in text_chunks(batch.column(1)):
                part = batch.slice(a, b - a)
                texts = [model.decode(unpack(ids).tolist()) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                 names=["doc_id", "ids", "decoded"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids binary, decoded string")


def digest(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the decoded text."""
    return decoded.select("doc_id", n_tokens(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
