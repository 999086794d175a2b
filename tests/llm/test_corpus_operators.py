"""Mixing, packing, personal data, quality, secrets, scoring and counting against plain rules."""
import datetime
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import SF, WORD, edge_docs, repeated, words
from tokenizers import Tokenizer

from contrail.llm import language_model, mixing, packing, pii, quality, secrets, token_counts
from contrail.llm.queries import QUERIES, RANKS, TOKENIZER


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text, r.source) for r in docs.collect()]


def check_mix(rows, out):
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len(words(t))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    budget, capped = 1.5 * sum(size.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = budget - sum(2 * size[s] for s in capped)
        over = [s for s in free if left * weight[s] / sum(weight[x] for x in free) > 2 * size[s]]
        if not over:
            break
        capped |= set(over)
    target = {s: 2 * size[s] if s in capped else left * weight[s] / sum(weight[x] for x in free) for s in order}
    got = {r.doc_id: r for r in out.collect()}
    taken = defaultdict(int)
    for d, t, s in rows:
        r = got[d]
        assert (r.size, r.source_size) == (len(words(t)), size[s]) and math.isclose(r.target, target[s])
        assert 0 <= r.taken <= 2 * r.size and (r.position is None) == (r.taken == 0)
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in order)


def test_mix_meets_targets(spark, rows):
    out = QUERIES["op1_mix_sources"](spark, SF)
    check_mix(rows, out)
    positions = [r.position for r in out.collect() if r.position is not None]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1


def test_mix_caps_and_reshares(spark):
    rows = [(i, "a b c " * (1 if i < 3 else 50), None if i % 5 == 0 else f"s{i % 5 % 3}") for i in range(40)]
    check_mix(rows, mixing.mix_plan(spark.createDataFrame(rows, "doc_id long, text string, source string")))


def test_mix_positions_follow_the_schedule(spark):
    rows = [(i, "w " * 10, "ab"[i % 2]) for i in range(2000)]
    plan = mixing.mix_plan(spark.createDataFrame(rows, "doc_id long, text string, source string"),
                           schedules=(((0, 2), (1, 0)), ((0, 0), (0.5, 0), (1, 4))), budget=1.0)
    by = {s: sorted(r.position for r in plan.collect() if r.position is not None and r.doc_id % 2 == s) for s in (0, 1)}
    assert abs(np.mean(by[0]) - 1 / 3) < 0.03  # density 2 (1 - t)
    assert min(by[1]) >= 0.5 and abs(np.mean(by[1]) - 5 / 6) < 0.03


def test_mixed_documents_repeat_whole_rows(spark, docs, rows):
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    uses = Counter(r.doc_id for r in out.collect())
    assert max(uses.values()) <= 2
    target = {r.doc_id: r.target for r in mixing.mix_plan(docs).collect()}
    total = defaultdict(int)
    for d, t, s in rows:
        total[s] += uses[d] * len(words(t))
    for d, _, s in rows:
        assert abs(total[s] - target[d]) <= max(len(words(t)) for _, t, x in rows if x == s)


def check_pack(rows, pieces):
    tok = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    want = {d: tok.encode(t or "", add_special_tokens=False).ids + [0] for d, t in rows}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    for d, ids in want.items():
        at = 0
        for p in sorted(by_doc.pop(d), key=lambda p: p.start):
            part = np.array(ids[p.start:p.start + p.length], "<u4")
            assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(part.tobytes())
            at += p.length
        assert at == len(ids)
    assert not by_doc
    padding = total = 0
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert 0 < at <= 1024
        total += at
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    return padding / total


def test_pack_holds_each_id_once(spark, rows):
    assert check_pack([r[:2] for r in rows], QUERIES["op2_pack_sum_of_squares"](spark, SF).collect()) < 0.02


def test_pack_edge_rows(spark):
    args = public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    texts = [*edge_docs(spark).where("doc_id is not null").select("text").distinct().collect()]
    odd = ["<|endoftext|> here", "ab\U0003134a\U000e0041x", "it's 12345  \n\n  x", "é" * 3000]
    rows = [(i, t) for i, t in enumerate([r.text for r in texts] + odd)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_pack(rows, packing.pack(df, *args).collect())
    assert packing.pack(df.limit(0), *args).count() == 0
    seqs = packing.pack(df, *args, sequences=True).collect()
    assert all(len(s.input_ids) == s.n_tokens == sum(p.length for p in s.pieces) for s in seqs)


def test_level_packer_minimises_squares_and_bounds_open_windows():
    rng = np.random.default_rng(1)
    packer, out = packing.LevelPacker(64, max_open=50), []
    for d in range(3000):
        n = int(rng.integers(1, 200))
        before = packer.counts.copy()
        rest = n % 64
        if rest:
            def after(h):
                c = before.copy()
                c[h] -= h > 0
                if h + rest < 64:
                    c[h + rest] += 1
                return (c[1:64] ** 2).sum()
            level = packer._level(rest)
            assert after(level) == min(after(h) for h in range(0, 65 - rest) if h == 0 or before[h])
        out += packer.add(d, np.full(n, d, np.uint32))
        assert packer.n_open <= 50
    out += packer.complete()
    assert sum(w.fill for w in out) == sum(len(p[2]) for w in out for p in w.pieces)
    assert sum(w.fill < 64 for w in out) <= 1


def test_quality_matches_plain_rules(spark, rows):
    got = {r.doc_id: r for r in QUERIES["op9_quality_rules"](spark, SF).collect()}
    check_quality(rows, got)


def check_quality(rows, got):
    for d, t, *_ in rows:
        w, t = words(t), t or ""
        lines = [x for x in t.split("\n") if WORD.search(x)]
        r, rep = got[d], repeated(w)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), rep), d
        assert r.base_failed == (len(w) < 20 or 100 * rep > 30 * len(w)) and (not r.base_failed or not r.kept)


def test_quality_edge_rows_and_filter(spark):
    df = edge_docs(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    out = quality.measure(df)
    check_quality(rows, {r.doc_id: r for r in out.collect()})
    kept = quality.filtered(df)
    assert kept.columns == df.columns and kept.count() == out.where("kept").count()
    assert quality.measure(df.limit(0)).count() == 0


def plain_spans(t):
    rules = [("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
             ("access", r"AKIA[A-Z0-9]+"), ("hex", r"[0-9a-f]+")]
    out = []
    for k, (name, p) in enumerate(rules):
        for m in re.finditer(p, t, re.ASCII):
            n = len(m.group(2)) if k == 0 else m.end() - m.start()
            if n >= (8, 16, 32)[k]:
                out.append((m.start(), k, m.end(), name))
    return sorted(out)


SECRETS = ["password: secret: abcdefgh", "API_KEY='abcdefgh1' apikey=x token==abcdefghi", "AKIAAKIA1 AKIAABCDEFGHIJKL é AKIA",
           "é" * 5 + "f" * 32 + " " + "a" * 31, "ſecret=abcdefghij toKen = \"abcdefgh", "-----BEGIN RSA PRIVATE KEY-----\nx",
           "ghp_" + "a" * 36, None, ""]


def check_secrets(rows, got):
    for d, t, *_ in rows:
        base = plain_spans(t or "")
        r = got[d]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x[1] == k for x in base) for k in range(3)), d
        text = ",".join(f"{n}:{s}:{e}" for s, _, e, n in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_secrets_match_plain_rules(spark, rows):
    check_secrets(rows, {r.doc_id: r for r in QUERIES["op10_secret_ledger"](spark, SF).collect()})


def test_ledger_scans_unseen_pairs_only(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    first = [(i, t) for i, t in enumerate(SECRETS)] + [(50, SECRETS[0])]
    second = first + [(60, "token=" + "q" * 20), (61, SECRETS[1])]
    a = spark.createDataFrame(first, "doc_id long, text string")
    b = spark.createDataFrame(second, "doc_id long, text string")
    check_secrets(first, {r.doc_id: r for r in secrets.digest(secrets.scan(a, ledger)).collect()})
    n = secrets.read_ledger(spark, ledger).count()
    assert n == len({t or "" for _, t in first})
    check_secrets(second, {r.doc_id: r for r in secrets.digest(secrets.scan(b, ledger)).collect()})
    assert secrets.read_ledger(spark, ledger).count() == n + 1
    assert secrets.scan(a, ledger, rule_version="2").count() == len(first)
    assert secrets.read_ledger(spark, ledger, "2").count() == n
    assert secrets.scan(a.limit(0), ledger).count() == 0
    spans = {r.doc_id: r.spans for r in secrets.digest(secrets.scan(a, ledger)).collect()}
    assert spans[5].startswith("pem:0:") and spans[6].startswith("token:0:")


def test_ledger_is_asked_before_texts_are_shipped(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    a = spark.createDataFrame([(1, "password=abcdefgh1"), (2, "plain"), (3, None)], "doc_id long, text string")
    b = a.union(spark.createDataFrame([(4, "plain"), (5, "token: 12345678"), (6, "token: 12345678")], "doc_id long, text string"))
    assert sorted(str(r.text) for r in secrets.unseen_texts(a, ledger).collect()) == ["None", "password=abcdefgh1", "plain"]
    secrets.scan_unseen(a, ledger)
    assert secrets.unseen_texts(a, ledger) is None
    assert [r.text for r in secrets.unseen_texts(b, ledger).collect()] == ["token: 12345678"] * 2
    # Two runs at once append the same blobs; each path still comes once.
    version = f"{ledger}/rule_version={secrets.RULE_VERSION}"
    spark.read.parquet(version).write.mode("append").parquet(f"{version}_copy")
    spark.read.parquet(f"{version}_copy").write.mode("append").parquet(version)
    assert secrets.read_ledger(spark, ledger).count() == 3
    found = {r.doc_id: len(r.spans) for r in secrets.scan(b, ledger).collect()}
    assert found == {1: 1, 2: 0, 3: 0, 4: 0, 5: 1, 6: 1} and secrets.scan(b, ledger).count() == 6


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def iban_ok(s):
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def pseudonyms(spark, texts, **kw):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, _row string")
    return [r.text for r in pii.pseudonymise(df, **kw).orderBy("doc_id").collect()]


VALID = ["ann.lee-9@mail.example.com", "10.0.255.1", "4111111111111111", "4111-1111-1111-1111", "+1 (743) 555-3824",
         "123-45-6789", "GB82 WEST 1234 5698 7654 32", "1999-12-31", "2024/02/29", "05.11.1967", "12/31/2005"]


def shape(s):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", s)))


def test_pseudonyms_keep_format_and_validity(spark):
    out = pseudonyms(spark, [f"see {v}, {v} end" for v in VALID])
    for v, t in zip(VALID, out, strict=True):
        first, second = re.fullmatch(r"see (.*), (.*) end", t).groups()
        assert first == second != v, v
        if v != "10.0.255.1":
            assert shape(first) == shape(v)
    fresh = [re.fullmatch(r"see (.*), .* end", t).group(1) for t in out]
    assert fresh[0].endswith("@mail.example.com") and fresh[4].startswith("+1 (")
    assert all(int(x) <= 255 for x in fresh[1].split(".")) and luhn(fresh[2]) and luhn(fresh[3])
    assert iban_ok(fresh[6])
    for v, form in zip(fresh[7:], ("%Y-%m-%d", "%Y/%m/%d", "%d.%m.%Y", "%m/%d/%Y"), strict=True):
        assert datetime.datetime.strptime(v, form).year // 100 in (19, 20)
    area, group, serial = map(int, fresh[5].split("-"))
    assert 0 < area < 900 and area != 666 and group and serial


def test_invalid_and_clean_texts_stay(spark):
    same = ["4111111111111112", "000-12-3456", "GB83 WEST 1234 5698 7654 32", "2023-02-29", "version 4.0.", "300.1.1.1", None, "",
            "mail @ home", "1 2 3", "words only", "x" * 50_000, "9" * 50_000]
    assert pseudonyms(spark, same) == same


def test_pseudonyms_are_one_to_one_and_keyed(spark):
    days = [(datetime.date(1999, 12, 1) + datetime.timedelta(k)).isoformat() for k in range(60)]
    ips = [f"10.0.{k // 250}.{k % 250}" for k in range(500)]
    names = [f"user{k}@example.org" for k in range(300)]
    for values in (days, ips, names):
        a = pseudonyms(spark, values)
        assert len(set(a)) == len(values) and a == pseudonyms(spark, values) != pseudonyms(spark, values, key="other")


def test_permutations_cover_their_range(spark):
    from pyspark.sql import functions as F

    n = F.lit(12).cast("long"), F.lit(7).cast("long")
    got = [r[0] for r in spark.range(84).select(pii.permute_rank(F.col("id"), *n, "k", "t")).collect()]
    assert sorted(got) == list(range(84)) and got != sorted(got)
    two = [r[0] for r in spark.range(100).select(pii.permute_text(F.lpad(F.col("id").cast("string"), 2, "0"), "k", "t")).collect()]
    assert len(set(two)) == 100


def test_pii_counts_and_edges(spark):
    df = edge_docs(spark)
    out = pii.pseudonymise(df, counts=True)
    assert out.columns == df.columns + [f"n_{k}" for k in pii.KINDS]
    assert sorted(map(str, out.select(*df.columns).collect())) == sorted(map(str, df.collect()))
    assert pii.pseudonymise(df.limit(0)).count() == 0


def kneser_ney(train, texts):
    """Dictionaries in place of arrays."""
    pairs, follow, before = Counter(), defaultdict(Counter), defaultdict(set)
    for w in train:
        for u, v in zip(["<s>"] + w, w, strict=False):
            pairs[u, v] += 1
            follow[u][v] += 1
            before[v].add(u)
    count = Counter(x for w in train for x in w)
    n, v = sum(count.values()), len(count)
    cont = {w: len(b) for w, b in before.items()}
    d2 = language_model.discounts(*[sum(c == k for c in pairs.values()) for k in (1, 2, 3, 4)])
    d1 = language_model.discounts(*[sum(c == k for c in cont.values()) for k in (1, 2, 3, 4)])

    def cut(c, d):
        return 0 if not c else d[min(c, 3) - 1]

    total = sum(cont.values())
    left1 = sum(cut(c, d1) for c in cont.values()) / total if total else 1.0
    out = []
    for w in texts:
        score = base = 0.0
        for u, x in zip(["<s>"] + w, w, strict=False):
            c = cont.get(x, 0)
            p = ((c - cut(c, d1)) / total if total else 0) + left1 / (v + 1)
            if u in follow:
                whole = sum(follow[u].values())
                c2 = follow[u][x]
                p = (c2 - cut(c2, d2)) / whole + sum(cut(k, d2) for k in follow[u].values()) / whole * p
            score += math.log10(p)
            base += math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1)))
        out.append((len(w), sum(x in count for x in w), n, base, score))
    return out


def check_lm(rows, got):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = [words((t or "").translate(lower)) + ["</s>"] for _, t in rows]
    held = [zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows]
    want = kneser_ney([w for w, h in zip(tokens, held, strict=True) if not h], tokens)
    for (d, _), h, (n, known, total, base, score) in zip(rows, held, want, strict=True):
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(r.score, score, rel_tol=1e-9, abs_tol=1e-9)


def test_language_model_matches_dictionaries(spark, rows):
    got = {r.doc_id: r for r in QUERIES["op6_kneser_ney_scores"](spark, SF).collect()}
    check_lm([r[:2] for r in rows], got)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_in_many_shards(spark, rows, monkeypatch):
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    texts = df.where(~language_model.held_out(df.doc_id)).select("text")
    model = language_model.train(texts, flush_tokens=1000, chars_per_shard=20_000)
    assert model["shards"] > 10
    check_lm([r[:2] for r in rows], {r.doc_id: r for r in language_model.score(df, model).collect()})


def test_language_model_edge_rows(spark):
    df = edge_docs(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = [(r.doc_id, r.text) for r in df.collect()]
    check_lm(rows, {r.doc_id: r for r in language_model.train_and_score(df).collect()})
    assert language_model.train_and_score(df.limit(0)).count() == 0
    assert language_model.train_and_score(edge_docs(spark)).count() == edge_docs(spark).count()


def plain_tokens(word, scores):
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(word)
    for i in range(1, len(word) + 1):
        for k in range(i - 1, -1, -1):
            s = scores.get(word[k:i])
            if s is not None and best[k][0] + s > best[i][0]:
                best[i] = best[k][0] + s, best[k][1] + 1
    return best[-1][1]


@pytest.mark.parametrize("max_nodes", [token_counts.MAX_NODES, 50])
def test_token_counts_match_plain_search(spark, rows, max_nodes):
    scores = token_counts.piece_scores(public_tokenizers.path(RANKS))
    rows = rows[:25]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r.doc_id: r for r in token_counts.count_tokens(df, public_tokenizers.path(RANKS), max_nodes=max_nodes).collect()}
    for d, t, _ in rows:
        w = words(t)
        assert (got[d].n_words, got[d].n_tokens) == (len(w), sum(plain_tokens(b" " + x.encode(), scores) for x in w))


def test_token_counts_edge_rows(spark):
    df = edge_docs(spark)
    out = {r.doc_id: r for r in token_counts.count_tokens(df, public_tokenizers.path(RANKS)).collect()}
    assert out[0].n_tokens == out[1].n_tokens == out[2].n_tokens == 0 and out[10].n_tokens > 0
    assert token_counts.count_tokens(df.limit(0), public_tokenizers.path(RANKS)).count() == 0


def test_pipeline_stages(spark, docs):
    import corpus_pipeline
    from contrail.llm import ngram_join

    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = corpus_pipeline.stage_table(stage(spark, frame, SF), "test", name)
        assert frame.columns == docs.columns
        if name == "quality_rules":
            assert {r.doc_id for r in frame.collect()} == {r.doc_id for r in quality.measure(docs).where("kept").collect()}
        if name == "ngram_jaccard":
            assert ngram_join.links(frame).where("not kept").count() == 0
    seqs = corpus_pipeline.STAGES[-1][1](spark, frame, SF).collect()
    uses = Counter(r.doc_id for r in frame.collect())
    held = Counter(p.doc_id for s in seqs for p in s.pieces if p.start == 0)
    assert held == uses and corpus_pipeline.run(spark, SF).count() == len(seqs)
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_values_followed_by_words_and_numbers(spark):
    values = {"ES9121000418450200051332": "iban", "GB82 WEST 1234 5698 7654 32": "iban", "31/01/1999": "date",
              "01/31/1999": "date", "2024-01-31": "date", "+1 555 123 4567": "phone"}
    rows = [(i, f"see {v}{after}", v, after, kind) for i, (v, kind, after) in enumerate(
        (v, k, a) for v, k in values.items() for a in ("", " EUR 500", " 2024", " ABCD", "."))]
    rows.append((99, "at 2024-01-31T12:00 on", "2024-01-31", "T12:00 on", "date"))
    df = spark.createDataFrame(rows, "doc_id long, text string, v string, after string, kind string")
    fresh = defaultdict(set)
    for r in pii.pseudonymise(df, counts=True).collect():
        assert r[f"n_{r.kind}"] == 1 and r.text.endswith(r.after), r
        fresh[r.v].add(r.text.removeprefix("see ").removeprefix("at ").removesuffix(r.after))
    assert all(len(x) == 1 and x != {v} for v, x in fresh.items()), fresh


def test_days_before_months_stay_apart(spark):
    days = [datetime.date(1999, 1, 1) + datetime.timedelta(k) for k in range(730)]
    rows = [(i, d.strftime(f), f) for i, (d, f) in enumerate((d, f) for d in days for f in ("%m/%d/%Y", "%d/%m/%Y") if f[1] == "m" or d.day > 12)]
    out = [r.text for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string, form string")).collect()]
    assert len(set(out)) == len(rows)
