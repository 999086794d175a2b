"""Near-duplicate joins against all pairs on small tables."""
import random

import numpy as np
import pytest
from helpers import SF, closure, edge_docs, jaccard, shingles

from contrail.llm import embedding_join, graph, ngram_join
from contrail.llm.queries import QUERIES


def brute_docs(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    links, pairs = [0] * len(sets), []
    for i in range(len(sets)):
        for j in range(i):
            if jaccard(sets[i][1], sets[j][1]) >= 0.8:
                links[i] += 1
                links[j] += 1
                pairs.append((sets[i][0], sets[j][0]))
    return links, pairs


def check_docs(docs, out):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if r.doc_id is not None]
    links, pairs = brute_docs(rows)
    low = closure([d for d, _ in rows], pairs)
    want = sorted((d, low[d], n, d == low[d]) for (d, _), n in zip(rows, links, strict=True))
    assert sorted((r.doc_id, r.class_id, r.n_links, r.kept) for r in out.collect() if r.doc_id is not None) == want
    return want


def test_ngram_join_matches_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert any(n for *_, n, _ in check_docs(docs, QUERIES["op4_ngram_jaccard_join"](spark, SF)))


def test_ngram_join_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", 3)
    rng = random.Random(5)
    base = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(40):
        w = list(base)
        for _ in range(rng.randrange(5)):
            w[rng.randrange(len(w))] = f"z{rng.randrange(9)}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_docs(docs, ngram_join.links(docs))


def test_ngram_join_edge_rows(spark):
    docs = edge_docs(spark)
    check_docs(docs.where("doc_id is not null"), ngram_join.links(docs))
    assert ngram_join.links(docs).count() == docs.count()
    assert ngram_join.links(docs.limit(0)).count() == 0


def test_deduplicate_keeps_one_of_each_class(spark):
    docs = edge_docs(spark)
    out = ngram_join.deduplicate(docs)
    assert out.columns == docs.columns
    ids = sorted((r.doc_id for r in out.collect()), key=lambda x: (x is None, x))
    assert ids == [0, 1, 2, 3, 4, 5, 7, 9, 10, 11, None]
    assert ngram_join.deduplicate(docs.limit(0)).count() == 0


def test_bands_reach_the_recall():
    bands, rows = ngram_join.choose_bands()
    assert bands * rows <= ngram_join.MAX_HASHES
    assert 1 - (1 - 0.8**rows) ** bands >= ngram_join.RECALL


def test_intersections_count_shared_codes():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 200)).astype(np.uint64)) for _ in range(60)]
    got = ngram_join.intersections(np.concatenate(sets), np.repeat(np.arange(60), [len(s) for s in sets]), 60)
    for i in range(60):
        for j in range(i):
            assert got[i, j] == got[j, i] == len(np.intersect1d(sets[i], sets[j]))


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)], [(9, 9)], [],
    [(i, i * 7 % 101) for i in range(100)]])
def test_components(spark, edges):
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a != b]
    assert got == closure({x for e in real for x in e}, real)


def check_vectors(rows, out):
    usable = [(i, lab, np.array(v, float)) for i, lab, v in rows
              if lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, pairs = {i: 0 for i, *_ in rows}, []
    for k, (i, lab, v) in enumerate(usable):
        for j, other, w in usable[:k]:
            if lab == other and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.98:
                links[i] += 1
                links[j] += 1
                pairs.append((i, j))
    low = closure([r[0] for r in rows], pairs)
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in out.collect()) == sorted(
        (i, links[i], low[i], low[i] == i) for i, *_ in rows)


def test_embedding_join_matches_all_pairs(spark):
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_vectors(rows, QUERIES["op3_embedding_near_dups"](spark, SF))


def test_embedding_join_with_many_pivots_and_blocks(spark):
    rng = np.random.default_rng(11)
    centers = rng.normal(size=(12, 8))
    rows = [(i, i % 2, (centers[i % 12] + rng.normal(size=8) * 0.12).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    check_vectors(rows, embedding_join.links(df, per_pivot=15, block_vectors=8))


def test_embedding_join_edge_rows(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(1, 1, one), (2, 1, one), (3, 2, one), (4, None, one), (5, 1, None), (6, 1, []), (7, 1, [0.0, 0.0, 0.0]),
            (8, 1, [1.0, None, 3.0]), (9, 1, [float("nan"), 1.0, 1.0]), (10, 1, [float("inf"), 1.0, 1.0]),
            (11, 1, [2.0, 4.0, 6.0]), (12, 1, [1.0, 2.0]), (13, 1, [1e300, 2e300, 3e300]), (14, 1, [1e-300, 2e-300, 3e-300])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_join.links(df).collect()}
    assert got[1] == got[2] == got[11] == got[13] == got[14] == (4, 1)
    assert all(got[i] == (0, i) for i in (3, 4, 5, 6, 7, 8, 9, 10, 12))
    assert embedding_join.links(df.limit(0)).count() == 0


def test_null_ids_name_no_class(spark):
    """Texts and vectors without an id link, but a class is named by its smallest real id."""
    docs, vectors, want = [], [], []
    rng = np.random.default_rng(9)
    for k in range(12):  # hashes of either sign
        base = [f"g{k}w{i}" for i in range(60)]
        docs += [(10 * k + 1, " ".join(base)), (10 * k + 2, " ".join(base + ["end"])), (None, " ".join([*base, "other"]))]
        v = rng.normal(size=16)
        vectors += [(10 * k + 1, k, v.tolist()), (10 * k + 2, k, (v + 0.001).tolist()), (None, k, (v - 0.001).tolist())]
        want += [(10 * k + 1, 10 * k + 1, 2, True), (10 * k + 2, 10 * k + 1, 2, False), (None, 10 * k + 1, 2, False)]
    # Without any id: a pair of near-copies keeps one of them, and single rows stay.
    base = [f"n{i}" for i in range(60)]
    docs += [(None, " ".join(base)), (None, " ".join([*base, "more"])), (None, "one text of its own kind here"), (None, None)]
    v = rng.normal(size=16)
    vectors += [(None, 99, v.tolist()), (None, 99, (v + 0.001).tolist()), (None, 98, v.tolist()), (None, 97, None)]
    want += [(None, None, 1, True), (None, None, 1, False), (None, None, 0, True), (None, None, 0, True)]
    order = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0, r[2], r[3])
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    got = [(r.doc_id, r.class_id, r.n_links, r.kept) for r in ngram_join.links(docs).collect()]
    assert sorted(got, key=order) == sorted(want, key=order)
    assert ngram_join.deduplicate(docs).count() == sum(r[3] for r in want)
    vectors = spark.createDataFrame(vectors, "vec_id long, label int, embedding array<double>")
    got = [(r.vec_id, r.component_id, r.n_links, r.kept) for r in embedding_join.links(vectors).collect()]
    assert sorted(got, key=order) == sorted(want, key=order)
