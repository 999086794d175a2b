"""Periodic runs, their digests and the planted tails equal plain rules."""
import hashlib
import zlib

import numpy as np
import pytest
from helpers import LONG, SF, edge_docs, words
from hypothesis import given, settings
from hypothesis import strategies as st

from contrail.llm import periodic_runs as P
from contrail.llm.queries import QUERIES


def plain_runs(w):
    """Every run of the words ``w`` by trying each period at each place."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if n >= max(6, 4 * q) and not any(all(w[x] == w[x + d] for x in range(i, i + n - d)) for d in range(1, q)):
                out.append((i, n, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def of_words(w):
    number = {}
    codes = np.array([number.setdefault(x, len(number)) for x in w], np.int64)
    start, length, period = P.runs(codes, np.zeros(len(w), np.int64))
    return list(zip(start.tolist(), length.tolist(), period.tolist(), strict=True))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=70))
def test_small_alphabets(w):
    assert of_words(w) == plain_runs(w)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abcdefgh"), min_size=1, max_size=9), st.integers(1, 8)), max_size=7))
def test_nested_repetitions(parts):
    w = [x for unit, times in parts for x in unit * times]
    w = w + ["z"] + w + w[: len(w) // 2]
    assert of_words(w) == plain_runs(w)


@pytest.mark.parametrize("period", [1, 2, 4, 5, 6, 14, 15, 16, 44, 45, 46, 134, 135, 136, 137, 300])
def test_every_level_and_least_length(period):
    unit = [f"u{i}" for i in range(period)]
    for n in (max(6, 4 * period) - 1, max(6, 4 * period), 5 * period + 7):
        w = ["x", *(unit * 8)[:n], "y"] if n <= 8 * period else ["x", *unit * n][:n + 1]
        want = [(1, n, period)] if n >= max(6, 4 * period) else []
        assert of_words(w) == want


def test_runs_end_with_their_text():
    codes = np.zeros(11, np.int64)
    assert [x.tolist() for x in P.runs(codes, np.repeat([0, 1], [5, 6]))] == [[5], [6], [1]]
    assert [x.tolist() for x in P.runs(np.zeros(14, np.int64), np.repeat([0, 1], 7))] == [[0, 7], [7, 7], [1, 1]]


def planted(doc_id, w):
    if doc_id is None or not w:
        return w
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    w = planted(doc_id, words(text))
    found = plain_runs(w) if len(w) < 3000 else of_words(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (str(doc_id), len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


def check(docs, got):
    want = [expected(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(str, ((str(r[0]), *r[1:]) for r in got.collect()))) == sorted(map(str, want))
    return want


def test_query(spark):
    want = check(spark.read.parquet(f"{SF}/documents.parquet"), QUERIES["op12_periodic_runs"](spark, SF))
    assert sum(row[1] > 0 for row in want) >= 8


def test_awkward_rows(spark):
    more = [(1000 + i, t) for i in range(30) for t in ("a b " * 9, "w " * 40 + "end", "one\x85two \x1c three\x0bfour " * 5)]
    for docs in (edge_docs(spark), edge_docs(spark).limit(0), spark.createDataFrame(more, "doc_id long, text string"),
                 spark.createDataFrame([(f"id{i}", "a b c " * (i % 7)) for i in range(40)], "doc_id string, text string")):
        docs = docs.withColumn("runs", docs["text"]).withColumn("h", docs["text"]).withColumn("words", docs["text"])
        check(docs, P.digest(P.find_runs(P.planted(docs))))


def test_long_texts_of_few_words():
    # Every level is reached; n log n work.
    n = 300_000
    assert of_words(["same"] * n) == [(0, n, 1)]
    unit = LONG.split()[:n // 10]
    assert of_words(unit * 5) == [(0, 5 * len(unit), min(len(unit), 997 * 31))]
