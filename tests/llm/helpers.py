"""Plain-Python rules that the operators are held against, and awkward rows."""
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"

LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(30_000))
EDGE_TEXTS = [None, "", " \t\n ", "one", "one two three", "a b c d e", "a b c d e", LONG, LONG + " tail",
              "naïve   café x y\nline\n\nline\r\nline", "x" * 20_000, "same words " * 200]


def edge_docs(spark):
    """Null, empty, very long, repeated and tied rows, with columns of clashing names."""
    rows = [(i, t, None if i % 4 == 3 else f"src{i % 3}", "clash", i) for i, t in enumerate(EDGE_TEXTS)]
    rows += [rows[5], rows[5], (None, "null id text of several words here", "src0", None, None)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, source string, size string, node long").repartition(3)


def words(text):
    return WORD.findall(text or "")


def shingles(text, k=5):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def jaccard(a, b):
    both = len(a & b)
    return both / (len(a) + len(b) - both) if both else 0.0


def closure(ids, pairs):
    """Smallest id reachable from each id."""
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def repeated(w, width=8):
    seen = Counter(tuple(w[i:i + width]) for i in range(len(w) - width + 1))
    return len({j for i in range(len(w) - width + 1) if seen[tuple(w[i:i + width])] > 1 for j in range(i, i + width)})
