"""SentencePiece encoding by marked words equals the library on whole texts."""
import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import SF, edge_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from contrail.llm import piece_codec
from contrail.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
AWKWARD = ["", " ", "  ", "\n", "\n\n a", " \n", "a  b   c", "▁", "a▁b", "▁▁ ▁x", "tab\there", "\r\n \r", "();\r\n\r",
           "<s> </s> <unk>", "\x00 \x00", "x" * 5000, "naïve 日本 🙂🙂 \U000e0041", "<0x0A>", "  　 a"]


def whole(text):
    return np.array(LIBRARY.encode(text or "", add_bos=True, add_eos=True), "<u4").tobytes()


def test_the_model_qualifies():
    assert piece_codec.separable(MODEL)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\r\t▁abcé()<>;{}日"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text(text):
    table = piece_codec.ChunkTable(MODEL, True)
    assert list(piece_codec.unpack(table.encode(text))) == LIBRARY.encode(text)


@pytest.mark.parametrize("max_chunks", [1, 3, 1000])
def test_tables_that_start_anew(max_chunks):
    table = piece_codec.ChunkTable(MODEL, True, max_chunks)
    for text in AWKWARD * 2:
        assert list(piece_codec.unpack(table.encode(text))) == LIBRARY.encode(text)
        assert len(table.ids) <= max_chunks


def test_whole_texts_where_words_do_not_separate():
    table = piece_codec.ChunkTable(MODEL, False)
    assert [list(piece_codec.unpack(table.encode(t))) for t in AWKWARD] == [LIBRARY.encode(t) for t in AWKWARD]


def check(docs, got):
    want = sorted((str(r.doc_id), len(ids := whole(r.text)) // 4, hashlib.sha256(ids).hexdigest(),
                   hashlib.sha256(LIBRARY.decode(np.frombuffer(ids, "<u4").tolist()).encode()).hexdigest())
                  for r in docs.select("doc_id", "text").collect())
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == want


def test_query(spark):
    check(spark.read.parquet(f"{SF}/documents.parquet"), QUERIES["op11_sentencepiece_codec"](spark, SF))


def test_awkward_rows(spark):
    rows = [(f"id{i}", t) for i, t in enumerate(AWKWARD)]
    for docs in (edge_docs(spark), edge_docs(spark).limit(0), spark.createDataFrame(rows, "doc_id string, text string")):
        docs = docs.withColumn("ids", docs["text"]).withColumn("decoded", docs["text"])
        check(docs, piece_codec.digest(piece_codec.decode(piece_codec.encode(docs, MODEL), MODEL)))


def test_round_trip_without_begin_and_end(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(AWKWARD) if "▁" not in t], "doc_id long, text string")
    back = piece_codec.decode(piece_codec.encode(docs, MODEL, add_ids=False), MODEL)
    assert {r.doc_id: r.decoded for r in back.collect()} == {r.doc_id: r.text for r in docs.collect()}
