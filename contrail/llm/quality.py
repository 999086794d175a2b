"""Operator 9: quality rules as one projection compiled from a threshold table.

``RULES`` names ratios of length, symbols, stop words and lines with their
allowed range and the least number of words from which a rule applies.
``assessment`` compiles measures and rules into one expression over the whole
text, for a single projection or filter: no user functions and no shuffle.

Repeated 8-word windows are found inside the row: each window is hashed, and
only texts in which a hash occurs twice sort their windows to see which words
they cover.

Edge cases: null and empty texts have no words and fail the base rule; lines
without a word are never duplicates; null or repeated ids stay rows of their
own; an empty table gives an empty result; extra columns stay in ``filtered``
and are ignored by ``measure``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in is that with for as on was be by it "
    "le la les de un une et des en que "
    "der die das und zu ist den von nicht "
    "el los y las se").split()
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high`` for texts of at least ``from_words`` words."""

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None
    from_words: int = 20


#: The threshold table. Numerators and denominators name measures.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", low=3.0, high=10.0),
    Rule("symbol_ratio", "n_symbols", "n_words", high=0.1),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", high=0.4),
    Rule("repeated_neighbour_ratio", "n_same_neighbours", "n_words", high=0.3),
    Rule("upper_case_ratio", "n_upper", "word_chars", high=0.5),
    Rule("stop_word_ratio", "n_stop_words", "n_words", low=0.01, from_words=100),
)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(inner) > 0, F.split(inner, SPACE_RUN)).otherwise(F.array().cast("array<string>"))


def _covered(starts: Column, width: int) -> Column:
    """Words covered by windows of ``width`` at the sorted ``starts``."""
    steps = F.transform(starts, lambda x, k: F.when(k == 0, F.lit(width)).otherwise(
        F.least(F.lit(width), x - F.get(starts, k - 1))))
    return F.aggregate(steps, F.lit(0), lambda a, x: a + x)


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words inside ``width``-word windows that occur twice or more in ``words``."""
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (width - 1)),
                         lambda i: F.xxhash64(F.slice(words, i, F.lit(width))))

    def cover(h: Column) -> Column:
        by_hash = F.sort_array(F.transform(h, lambda x, k: F.struct(x.alias("h"), k.alias("k"))))
        starts = _let(by_hash, lambda s: F.sort_array(F.transform(F.filter(s, lambda x, k: (
            F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False))
            | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False)))), lambda x: x["k"])))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            _let(starts, lambda s: _covered(s, width)))

    return F.when(F.size(words) > width, _let(hashes, cover)).otherwise(F.lit(0))


def _rule(rule: Rule, m: Column) -> Column:
    over, base = m[rule.numerator].cast("double"), m[rule.denominator]
    ok = F.lit(True)
    if rule.low is not None:
        ok = ok & (over >= F.lit(rule.low) * base)
    if rule.high is not None:
        ok = ok & (over <= F.lit(rule.high) * base)
    return (m["n_words"] < rule.from_words) | ok


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words",
            "n_same_neighbours", "n_upper")


def assessment(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """One struct of the measures, base_failed, failed_rules and kept.

    Words, lines and measures are each bound once, as lambda variables, so that
    a filter on a field does not evaluate them again for every rule.
    """
    text = F.coalesce(text, F.lit(""))
    over_words = _let(_words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        repeated_words(w).cast("long").alias("n_repeat_words"),
        F.size(F.filter(w, lambda x: x.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.filter(w, lambda x, k: (k > 0) & (x == F.get(w, k - 1)))).cast("long").alias("n_same_neighbours")))
    over_lines = _let(F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0), lambda n: F.struct(
        F.size(n).cast("long").alias("n_lines"),
        (F.size(n) - F.size(F.array_distinct(n))).cast("long").alias("n_dup_lines")))

    def without(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, pattern, "")).cast("long")

    parts = F.struct(over_words.alias("w"), over_lines.alias("l"), without(SPACE_RUN).alias("word_chars"),
                     (F.length(text) - without(r"[#*$%&|<>]+")).alias("n_symbols"),
                     (F.length(text) - without(r"[A-ZÀ-ÖØ-Þ]+")).alias("n_upper"))
    flat = _let(parts, lambda p: F.struct(*[
        p["w"][k].alias(k) for k in ("n_words", "n_repeat_words", "n_stop_words", "n_same_neighbours")],
        *[p["l"][k].alias(k) for k in ("n_lines", "n_dup_lines")],
        *[p[k].alias(k) for k in ("word_chars", "n_symbols", "n_upper")]))

    def verdict(m: Column) -> Column:
        failed = F.filter(F.array(*[F.when(~_rule(r, m), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
        base_failed = (m["n_words"] < 20) | (m["n_repeat_words"] * 100 > m["n_words"] * 30)
        return F.struct(*[m[k].alias(k) for k in MEASURES], base_failed.alias("base_failed"), failed.alias("failed_rules"),
                        (~base_failed & (F.size(failed) == 0)).alias("kept"))

    return _let(flat, verdict)


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text",
            keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Measures, base verdict, failed rules and ``kept`` per row, beside the columns ``keep``."""
    return docs.select(*[F.col(c) for c in keep], assessment(F.col(text_col), rules).alias("_m")).select(*keep, "_m.*")


def filtered(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep."""
    return docs.where(assessment(F.col(text_col), rules)["kept"])
