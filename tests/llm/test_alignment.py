"""Alignment of two tokenizers equals a plain rule over all token pairs."""
import hashlib
from collections import Counter

import public_tokenizers
import sentencepiece
from helpers import SF, edge_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from contrail.llm import alignment
from contrail.llm.queries import QUERIES

A, RANKS, B = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))
FAST = (A, B, RANKS, public_tokenizers.PATTERN)
own = Tokenizer.from_file(A)
own.encode_special_tokens = True
VOCABULARY = {i: t for t, i in own.get_vocab().items()}
pieces = sentencepiece.SentencePieceProcessor(model_file=B)
VALUE = alignment.byte_level_values()


def plain_tokens(text):
    """[(id, start, end)] of both sides, or two empty lists."""
    raw = b" " + (text or "").encode()
    a = [(i, bytes(VALUE[c] for c in VOCABULARY[i])) for i in own.encode(" " + (text or ""), add_special_tokens=False).ids]
    b = []
    for i in pieces.encode(text or ""):
        p = pieces.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()))
    if not text or any(b"".join(x for _, x in side) != raw for side in (a, b)):
        return [], []
    out = []
    for side in (a, b):
        at, spans = 0, []
        for i, x in side:
            spans.append((i, at, at + len(x)))
            at += len(x)
        out.append(spans)
    return out


def plain_links(a, b):
    out, j = [], 0
    for i, s, e in a:
        while b[j][2] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][1] < e:
            out.append((i, b[k][0]))
            k += 1
    return out


def plain(rows):
    """Expected result of (doc_id, text) rows."""
    tokens = {t: plain_tokens(t) for _, t in rows}
    links = {t: plain_links(*x) for t, x in tokens.items()}
    counts = Counter(p for _, t in rows for p in links[t])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for doc, t in rows:
        a, b = tokens[t]
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, low = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(i) for i, s, x in side if low <= s and x <= e) for side in (a, b))
                          if len(ends) < 400 else None)
            low = e
        if len(ends) >= 400:
            groups = quick_groups(a, b, set(ends))
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((str(doc), len(a), len(b), len(ends), len(links[t]),
                    sum(counts[p] == most[p[1]] for p in links[t]), sum(counts[p] for p in links[t]), sha))
    return sorted(out)


def quick_groups(a, b, ends):
    parts = []
    for side in (a, b):
        own, held = [], []
        for i, _, e in side:
            held.append(str(i))
            if e in ends:
                own.append(",".join(held))
                held = []
        parts.append(own)
    return ["|".join(x) for x in zip(*parts, strict=True)]


def rows_of(df):
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows_of(QUERIES["op13_tokenizer_alignment"](spark, SF)) == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_awkward_rows(spark):
    docs = edge_docs(spark)
    docs = docs.withColumnsRenamed({"node": "copies", "size": "key"})
    want = plain([(r.doc_id, r.text) for r in docs.collect()])
    # Small blocks with a salt each, and one block.
    for size, per_salt in ((1000, 1), (10**9, 1000)):
        assert rows_of(alignment.align(docs, *FAST, block_bytes=size, blocks_per_salt=per_salt)) == want
    assert rows_of(alignment.align(docs.limit(0), *FAST)) == []


def test_copies_hot_texts_and_special_strings(spark):
    texts = ["hot text of many copies"] * 400 + ["<|endoftext|> and <s> are text", "a▁b spells other bytes", "▁", "  two  spaces ",
                                                 "naïve 日本語 🙂", "\U00031234 beyond", "hot text", "a", "\n", None, ""]
    rows = [(f"id{i}", t) for i, t in enumerate(texts)] + [(None, "hot text"), ("id1", texts[1])]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(5)
    assert rows_of(alignment.align(docs, *FAST)) == plain(rows)
    assert rows_of(alignment.align(docs, A, B)) == plain(rows)


aligner = alignment.Aligner(alignment.ByteTokens(A, RANKS, public_tokenizers.PATTERN), alignment.PieceTokens(B, True))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\r\tabcé'’s123<|>{}日"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_both_encoders_of_any_text(text):
    assert aligner.a.encode(" " + text).tolist() == own.encode(" " + text, add_special_tokens=False).ids
    a, b = plain_tokens(text)
    got = aligner.tokens(text)
    assert ([], []) == (a, b) if got is None else [x.tolist() for x in got] == [[i for i, _, _ in x] for x in (a, b)]
