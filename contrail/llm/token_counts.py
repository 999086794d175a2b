"""Operator 7: token counts by dynamic programming over a trie of distinct pre-tokens.

A pre-token is a space and a word. Its tokenization is the best path of a
unigram model over a public byte-level vocabulary, whose scores follow Zipf's
law in the rank of a merge (single bytes get the lowest score, so every text
has a path). Each task inserts its distinct pre-tokens into a trie. A node
holds the best forward score of its prefix and the number of tokens on that
path; it depends on the prefix alone, so prefixes that words share are scored
once, and the node where a word ends holds its count. Documents then add up
the counts of their words.

Counting runs where the rows are read: no shuffle. A task starts a new trie
when its nodes pass a bound; counts do not depend on what the trie holds.

Edge cases: null and empty texts have no words and no tokens; a word of any
length is one path; null and repeated ids stay rows of their own; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import text_bytes, text_chunks, word_bounds, word_hashes

#: Nodes and counted words that a task holds before it starts anew.
MAX_NODES, MAX_WORDS = 600_000, 2_000_000
_OFFSET = 2.7


def piece_scores(ranks_file: str) -> dict[bytes, float]:
    """Log scores of the vocabulary's pieces, by rank."""
    import base64

    with open(ranks_file, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    worst = -math.log(len(ranks) + _OFFSET)
    return {piece: worst if len(piece) == 1 else -math.log(max(rank - 256, 0) + _OFFSET) for piece, rank in ranks.items()}


class Trie:
    """Forward scores and token counts of prefixes; children are keyed by (node, byte)."""

    def __init__(self, scores: dict[bytes, float], max_nodes: int = MAX_NODES):
        self.scores, self.max_nodes = scores, max_nodes
        self.tails = {piece[k:] for piece in scores for k in range(len(piece))}
        self.clear()

    def clear(self) -> None:
        self.children: dict[int, int] = {}
        self.best, self.tokens = [0.0], [0]

    def count(self, word: bytes) -> int:
        """Tokens on the best path of ``word``; prefixes already in the trie are not scored again."""
        if len(self.best) > self.max_nodes:
            self.clear()
        children, best, tokens, scores, tails = self.children, self.best, self.tokens, self.scores, self.tails
        node, path = 0, [0]
        for i, byte in enumerate(word):
            key = node << 8 | byte
            child = children.get(key)
            if child is None:
                top, n, start = -math.inf, 0, i
                while start >= 0 and (tail := word[start:i + 1]) in tails:
                    piece = scores.get(tail)
                    if piece is not None and best[path[start]] + piece > top:
                        top, n = best[path[start]] + piece, tokens[path[start]] + 1
                    start -= 1
                child = children[key] = len(best)
                best.append(top)
                tokens.append(n)
            path.append(child)
            node = child
        return tokens[node]


def _count(ranks_file: str, max_nodes: int, max_words: int):
    def run(batches):
        import pyarrow as pa

        trie = Trie(piece_scores(ranks_file), max_nodes)
        counted: dict[int, int] = {}
        for batch in batches:
            for a, b in text_chunks(batch.column(1)):
                data, offsets = text_bytes(batch.column(1).slice(a, b - a))
                starts, ends, first = word_bounds(data, offsets)
                words, at, which = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
                if len(counted) > max_words:
                    counted.clear()
                raw = data.tobytes()
                counts = np.empty(len(words), np.int64)
                missing = []
                for k, h in enumerate(words.tolist()):
                    n = counted.get(h)
                    if n is None:
                        missing.append((raw[starts[at[k]]:ends[at[k]]], k, h))
                    else:
                        counts[k] = n
                for word, k, h in sorted(missing):
                    counts[k] = counted[h] = trie.count(b" " + word)
                sums = np.concatenate([[0], np.cumsum(counts[which])])
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(first)), pa.array(sums[first[1:]] - sums[first[:-1]])],
                    names=["doc_id", "n_words", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, ranks_file: str, id_col: str = "doc_id", text_col: str = "text",
                 max_nodes: int = MAX_NODES, max_words: int = MAX_WORDS) -> DataFrame:
    """doc_id, n_words, n_tokens of every whole text."""
    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(
        _count(ranks_file, max_nodes, max_words), "doc_id long, n_words long, n_tokens long")
