"""Operator 12: periodic runs of words by recursive frequency splitting.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical), of at least ``max(6, 4 q)`` words, that no neighbouring word
extends with that period. Each of its words occurs at least four times in it,
so a word that occurs less often within its segment (at first, a text) is in
no run: it splits the segment. The parts are counted anew until no word is too
rare, and parts of under six words go. Segments of many texts are split
together, one sort for all of them a round; only changed segments come into the
next round.

Surviving segments are scanned for lags, at k = 5, 15, 45, ... words: the lag
of a place is the distance to where its k words stand next in the segment. A
run of period q with k/3 < q <= k has the lag q at each of its places but the
last q + k - 1: k words recur there, and no sooner (k >= q words that recur
sooner would give the run a smaller period, by the theorem of Fine and Wilf).
For the same reason, a longest stretch of places with one lag is all of a run,
so that its start, length and smallest period need no further comparison.
Names of k words are exact ranks of three names of k/3 words. The work grows
as n log n per level, also on texts of one repeated word.

Texts are scanned where they are read, about a million bytes (or one longer
text) at a time; nothing shuffles.

Edge cases: null and empty texts, and texts without words, have no runs and an
empty collapsed text; ids of any type, null and repeated ids and repeated rows
stay rows of their own; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import WORD, text_chunks

#: Least occurrences of a word in a run, and least words of a run.
LEAST, SHORTEST = 4, 6
#: Words whose recurrence gives the lags of the first level; the next ones take three times as many.
FIRST_WORDS = 5

RUN = "struct<start: long, length: long, period: long>"


def surviving(codes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Places, in order, of the words that may be in runs.

    ``text`` numbers the text of each word. Stretches of consecutive places
    (within a text) are segments of at least ``SHORTEST`` words, in which every
    word occurs at least ``LEAST`` times. A rare word, or the end of a text,
    lies between two segments.
    """
    place, segment, done = np.arange(len(codes)), text, []
    width = int(codes.max(initial=0)) + 1
    while len(place):
        # Number the segments from 0; the short ones go.
        head = np.flatnonzero(np.concatenate([[True], (segment[1:] != segment[:-1]) | (place[1:] != place[:-1] + 1)]))
        sizes = np.diff(np.append(head, len(place)))
        stays = np.repeat(sizes >= SHORTEST, sizes)
        segment, place = np.repeat(np.arange(len(sizes)), sizes)[stays], place[stays]
        _, which, counts = np.unique(segment * width + codes[place], return_inverse=True, return_counts=True)
        rare = counts[which] < LEAST
        changed = np.zeros(len(sizes), bool)
        changed[segment[rare]] = True
        again = changed[segment]
        done.append(place[~again])
        place, segment = place[again & ~rare], segment[again & ~rare]
    return np.sort(np.concatenate(done)) if done else place


def _ranks(*names: np.ndarray) -> np.ndarray:
    """Numbers that are equal where all of ``names`` are."""
    out = names[0]
    for more in names[1:]:
        out = np.unique(out * (int(more.max(initial=0)) + 1) + more, return_inverse=True)[1].reshape(-1)
    return out


def _longer(names: np.ndarray, at: np.ndarray, ends: np.ndarray, k: int, times: int):
    """From names of ``k`` words to those of ``times * k`` words, at the places whose segment holds so many."""
    fits = np.flatnonzero(at + times * k <= ends)
    return _ranks(*(names[fits + j * k] for j in range(times))), at[fits], ends[fits]


def _runs_of_level(names: np.ndarray, at: np.ndarray, ends: np.ndarray, k: int, low: int):
    """(start, length, period) of the runs with periods in (low, k]; ``names`` of the k words at the places ``at``."""
    order = np.argsort(names, kind="stable")
    lag = np.zeros(len(at), np.int64)
    same = names[order][1:] == names[order][:-1]
    here, there = order[:-1][same], order[1:][same]
    lag[here] = np.where(ends[here] == ends[there], at[there] - at[here], 0)
    lag[(lag <= low) | (lag > k)] = 0
    new = np.concatenate([[True], (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)])
    head = np.flatnonzero(new)
    sizes = np.diff(np.append(head, len(at)))
    period = lag[head]
    length = sizes - 1 + k + period
    found = (period > 0) & (length >= np.maximum(SHORTEST, 4 * period))
    return np.stack([at[head][found], length[found], period[found]])


def runs(codes: np.ndarray, text: np.ndarray):
    """Every run of the words ``codes``; ``text`` numbers the text of each word, in order.

    Returns arrays (start, length, period), sorted by start, then period;
    starts are places in ``codes``.
    """
    place = surviving(codes, text)
    head = np.flatnonzero(np.concatenate([np.ones(min(1, len(place)), bool), (place[1:] != place[:-1] + 1)
                                          | (text[place[1:]] != text[place[:-1]])]))
    sizes = np.diff(np.append(head, len(place)))
    ends = np.repeat(place[head] + sizes, sizes)  # of the segment, exclusive
    found = [np.zeros((3, 0), np.int64)]
    k, low = FIRST_WORDS, 0
    names, at, ends = _longer(codes[place], place, ends, 1, FIRST_WORDS)
    while len(at):
        found.append(_runs_of_level(names, at, ends, k, low))
        # A period above k needs a segment of more than 4 k words.
        head = np.flatnonzero(np.concatenate([[True], ends[1:] != ends[:-1]]))
        long = np.repeat(ends[head] - at[head] > 4 * k, np.diff(np.append(head, len(at))))
        names, at, ends = _longer(names[long], at[long], ends[long], k, 3)
        low, k = k, 3 * k
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _scan(texts: list[bytes]):
    """Runs (start, length, period) and kept words, joined by a space, of each text."""
    words = [t.split() for t in texts]  # at the six ASCII spaces
    first = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for ws in words for w in ws), np.int64, int(first[-1]))
    start, length, period = runs(codes, np.repeat(np.arange(len(texts)), np.diff(first)))
    bounds = np.searchsorted(start, first)
    out = []
    for k, own in enumerate(words):
        a, b = bounds[k], bounds[k + 1]
        if a == b:
            out.append(([], b" ".join(own)))
            continue
        own_runs = list(zip((start[a:b] - first[k]).tolist(), length[a:b].tolist(), period[a:b].tolist(), strict=True))
        change = np.zeros(len(own) + 1, np.int64)
        np.add.at(change, [s + q for s, _, q in own_runs], 1)
        np.add.at(change, [s + n for s, n, _ in own_runs], -1)
        kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
        out.append((own_runs, b" ".join([own[i] for i in kept.tolist()])))
    return out


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, runs (start, length, period; in words, by start, then period) and the collapsed text.

    ``collapsed`` keeps the words that no run contains after its first period, joined by one space.
    """

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))
        for batch in batches:
            for a, b in text_chunks(batch.column(1)):
                part = batch.slice(a, b - a)
                found = _scan([(t or "").encode() for t in part.column(1).to_pylist()])
                spans = [[{"start": s, "length": n, "period": q} for s, n, q in own] for own, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(spans, kind), pa.array([t.decode() for _, t in found], pa.string())],
                    names=["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, runs array<{RUN}>, collapsed string")


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text, of which a tenth has a periodic tail.

    With h the CRC-32 of the id as text, g = h div 10 and n words: where h is
    divisible by 10, word i from a = g mod n on becomes word
    a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8). Other rows, and those
    without an id or a word, keep their text.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), h.alias("h"),
                       F.when(h % 10 == 0, F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0))).alias("words"))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    a = F.expr("div(h, 10) % size(words)").cast("int")
    rows = rows.select("doc_id", "text", "words", "h", F.when(n > 0, n).alias("n"), F.when(n > 0, a).alias("a"), g.alias("g"))
    rows = rows.withColumn("p", (F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8))).cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    cycle = F.slice("words", F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(cycle, times)), F.lit(1), F.col("n") - F.col("a"))
    made = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of the greatest length/period, and SHA-256 of all runs and of the collapsed text."""
    def better(best: Column, r: Column) -> Column:
        # length/period compared crosswise; runs come by start, then period, so the first of equals stays.
        more = r["length"] * best["period"] > best["length"] * r["period"]
        return F.when(best.isNull() | more, r).otherwise(best)

    line = F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    best = F.aggregate("runs", F.lit(None).cast(RUN), better)
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(F.array_join(F.transform(line, lambda s: F.concat(s, F.lit("\n"))), "").cast("binary"), 256)
                        .alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                       F.expr("div(1000 * best.length, best.period)").alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")
