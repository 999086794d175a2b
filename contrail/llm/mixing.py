"""Operator 1: mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time ``t`` in [0, 1], a
piecewise linear curve given by (time, weight) knots. The integral of a
schedule is the source's overall weight. Sources share a word budget by these
weights; a source whose target would pass ``cap`` times its size stops there
and the excess is shared again by weight among the others, until no target is
above its cap. The cumulative demand of a source at time ``t`` is its target
times the schedule's normalised integral; inverting it gives each document
(and each repetition of it) a training position. Documents are then
range-sorted by position.

Scale: one scan of the texts gives (id, source, size, key). The place of a
document within its source is a prefix sum over the order of a hash key, done
in two levels: sums of (source, key prefix) buckets, a window over these few
thousand sums, then a window inside each bucket. No task sees a whole source,
so a source with a third of all rows is split like any other.

Edge cases: a null or empty text has size 0, is taken 0 times and has no
position; a null source is a source of its own, ordered last; null or
repeated ids are kept as rows of their own (ties in key order are broken by
size and text hash); an empty table gives an empty result. Columns other than
the ids, source and text are ignored, and names are qualified internally.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import stage_table, word_count

Schedule = Sequence[tuple[float, float]]

#: Schedules by source rank, repeating; their integrals are 3, 1 and 2.
DEFAULT_SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 4.0), (1.0, 2.0)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 1.0), (1.0, 3.0)),
)
#: Hex digits of the order key that name a prefix-sum bucket (4096 buckets a source).
BUCKET_DIGITS = 3


def _segments(schedule: Schedule) -> list[tuple[float, float, float, float, float]]:
    """(start, length, weight at start, weight at end, integral before) of each segment."""
    out, total = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
        if t1 <= t0 or min(w0, w1) < 0:
            raise ValueError("schedule times must rise and weights must not be negative")
        out.append((float(t0), float(t1 - t0), float(w0), float(w1), total))
        total += (w0 + w1) / 2 * (t1 - t0)
    if total <= 0:
        raise ValueError("a schedule needs a positive integral")
    return out


def _integral(schedule: Schedule) -> float:
    *_, (_, length, w0, w1, before) = _segments(schedule)
    return before + (w0 + w1) / 2 * length


def _by_rank(rank: Column, values: Sequence) -> Column:
    out = F.lit(values[-1])
    for k, v in reversed(list(enumerate(values[:-1]))):
        out = F.when(rank % len(values) == k, F.lit(v)).otherwise(out)
    return out


def _position(rank: Column, share: Column, schedules: Sequence[Schedule]) -> Column:
    """Time at which the normalised integral of the source's schedule reaches ``share``."""
    by_schedule = []
    for schedule in schedules:
        area = share * F.lit(_integral(schedule))
        expr = F.lit(None).cast("double")
        for t0, length, w0, w1, before in reversed(_segments(schedule)):
            rest = area - F.lit(before)
            slope = (w1 - w0) / length
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0)))
            here = F.when(root + F.lit(w0) > 0, F.lit(t0) + F.lit(2.0) * rest / (root + F.lit(w0))).otherwise(F.lit(t0))
            expr = here if before + (w0 + w1) / 2 * length >= _integral(schedule) else F.when(
                area < F.lit(before + (w0 + w1) / 2 * length), here).otherwise(expr)
        by_schedule.append(expr)
    out = by_schedule[-1]
    for k, expr in reversed(list(enumerate(by_schedule[:-1]))):
        out = F.when(rank % len(schedules) == k, expr).otherwise(out)
    return out


def source_targets(sizes: DataFrame, schedules: Sequence[Schedule] = DEFAULT_SCHEDULES,
                   budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per source key: source, source_rank, source_size, target.

    The windows run over one row per source. Sorted by cap over weight, source
    ``i`` is capped exactly if the budget left by the sources before it would
    lift it to its cap; the first one that is not gives the common level.
    """
    everywhere = Window.orderBy("source")
    s = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
         .withColumn("source_rank", F.row_number().over(everywhere) - 1))
    s = s.withColumn("weight", _by_rank(F.col("source_rank"), [_integral(x) for x in schedules]))
    s = s.withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    fill = Window.orderBy(F.col("most") / F.col("weight"), "source_rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = fill.rowsBetween(0, Window.unboundedFollowing)
    whole = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = (s.withColumn("total", F.sum("source_size").over(whole) * F.lit(float(budget)))
         .withColumn("level", (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
                     / F.sum("weight").over(onward)))
    open_level = F.when(F.col("level") * F.col("weight") < F.col("most"), F.col("level"))
    s = s.withColumn("level", F.first(open_level, ignorenulls=True).over(whole))
    target = F.least(F.col("most"), F.coalesce(F.col("level") * F.col("weight"), F.col("most")))
    return s.select("source", "source_rank", "source_size", target.alias("target"))


def _placed(rows: DataFrame, lean: DataFrame, schedules, budget, cap, bucket_digits: int) -> DataFrame:
    """``rows`` (source, size, order_key, tie, ...) with target, words wanted and words before.

    ``lean`` holds (source, size, order_key) of the same rows, so that the
    totals need no second scan of the texts.
    """
    targets = source_targets(lean, schedules, budget, cap).withColumnRenamed("source", "_of")
    bucket = F.substring("order_key", 1, bucket_digits)
    in_source = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (lean.withColumn("bucket", bucket).groupBy("source", "bucket")
               .agg(F.sum("size").alias("bucket_size"))
               .withColumn("bucket_start", F.coalesce(F.sum("bucket_size").over(in_source), F.lit(0)))
               .drop("bucket_size"))
    plan = (offsets.join(targets, F.col("source") == F.col("_of")).drop("_of")
            .withColumnsRenamed({"source": "plan_source", "bucket": "plan_bucket"}))
    in_bucket = (Window.partitionBy("source", "bucket").orderBy("order_key", "size", "tie")
                 .rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.withColumn("bucket", bucket).withColumn(
        "words_before", F.coalesce(F.sum("size").over(in_bucket), F.lit(0)))
    # The join's keys are the window's, so rows are shuffled once for both.
    out = placed.join(plan, (F.col("source") == F.col("plan_source")) & (F.col("bucket") == F.col("plan_bucket")))
    return (out.withColumn("words_before", F.col("words_before") + F.col("bucket_start"))
            .withColumn("wanted", F.floor(F.col("target") + 0.5))
            .withColumn("passes", F.when(F.col("source_size") > 0, F.expr("wanted div source_size")).otherwise(F.lit(0)))
            .withColumn("rest", F.col("wanted") - F.col("passes") * F.col("source_size"))
            .drop("plan_source", "plan_bucket", "bucket_start", "bucket"))


def _source_key(source_col: str) -> Column:
    """The source as a key that is never null and sorts by code point, the null source last."""
    return F.coalesce(F.concat(F.lit("+"), F.col(source_col).cast("string")), F.lit("-")).alias("source")


def _order_key(id_col: str) -> Column:
    return F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))


def mix_plan(docs: DataFrame, schedules: Sequence[Schedule] = DEFAULT_SCHEDULES, budget: float = 1.5,
             cap: float = 2.0, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
             bucket_digits: int = BUCKET_DIGITS) -> DataFrame:
    """Per document: size, source_size, target, taken (words, with repeats), position of its first use.

    Rows come range-sorted by position; documents that are not used come last.
    """
    sized = stage_table(docs.select(
        F.col(id_col).alias("doc_id"), _source_key(source_col), word_count(F.col(text_col)).alias("size"),
        _order_key(id_col).alias("order_key"), F.xxhash64(text_col).alias("tie")), "mix")
    p = _placed(sized, sized.select("source", "size", "order_key"), schedules, budget, cap, bucket_digits)
    part = F.greatest(F.least(F.col("rest") - F.col("words_before"), F.col("size")), F.lit(0))
    p = p.withColumn("taken", F.col("passes") * F.col("size") + part)
    share = F.col("words_before") / F.col("target")
    p = p.withColumn("position", F.when(F.col("taken") > 0, _position(F.col("source_rank"), share, schedules)))
    return (p.select("doc_id", "size", "source_size", "target", "taken", "position")
            .orderBy(F.col("position").asc_nulls_last(), "doc_id"))


def mix_documents(docs: DataFrame, schedules: Sequence[Schedule] = DEFAULT_SCHEDULES, budget: float = 1.5,
                  cap: float = 2.0, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                  bucket_digits: int = BUCKET_DIGITS) -> DataFrame:
    """The mixed corpus: whole documents, repeated as the mix asks, in training order.

    A document is in the last, partial pass over its source if its middle word
    is. Returns the columns of ``docs``, one row per use.
    """
    columns = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
                       _source_key(source_col), word_count(F.col(text_col)).alias("size"),
                       _order_key(id_col).alias("order_key"), F.xxhash64(text_col).alias("tie"))
    lean = stage_table(held.select("source", "size", "order_key"), "mix")
    p = _placed(held, lean, schedules, budget, cap, bucket_digits).where("size > 0")
    last = F.when(F.col("words_before") * 2 + F.col("size") < F.col("rest") * 2, 1).otherwise(0)
    p = p.withColumn("uses", (F.col("passes") + last).cast("int")).where("uses > 0")
    p = p.withColumn("use", F.explode(F.sequence(F.lit(1), F.col("uses"))))
    share = ((F.col("use") - 1) * F.col("source_size") + F.col("words_before")) / F.col("target")
    p = p.withColumn("position", _position(F.col("source_rank"), F.least(share, F.lit(1.0)), schedules))
    return p.orderBy("position", "order_key", "use").select(*[F.col("row").getField(c).alias(c) for c in columns])
