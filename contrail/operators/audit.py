"""Set-based audits over landed pages.

What an ingest loop checks page by page (response class, missing offsets,
fetched versus announced totals, what to request next) is expressed here as
Spark jobs over the landed table, so it runs for any number of pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions.jsonpath import top_level
from contrail.operators.joins import replicated_product
from contrail.operators.parse import page_items, parse_pages, total_count
from contrail.schemas import Entity

# Texts that mark a throttled response in the ``Error`` field.
RATE_LIMIT_TEXTS = ("Account Over Queries Per Second Limit", "Gateway Timeout")
# A processing error with this description means "no data".
NOT_FOUND_TEXT = "semantically incorrect"

# Pages of a group that one window orders when ranges of missing offsets are looked for.
PAGES_PER_WINDOW = 4096
# Offsets generated per task when expanding announced totals into pages.
OFFSETS_PER_CHUNK = 4096


def classify_pages(pages: DataFrame, entity: Entity, raw: str = "raw_data") -> DataFrame:
    """Add ``status`` and ``detail`` to each page.

    status: ``malformed`` (not a JSON object), ``processing_error`` (``ProcessingErrors``
    present; detail = its type), ``not_found`` (processing error whose
    description says the request was semantically incorrect),
    ``rate_limited`` (``Error`` names a throttling condition), ``error``
    (``error`` or another ``Error``), ``ok`` (the entity's list is present),
    ``empty`` (valid JSON without the list).
    """
    r = F.col(raw)
    top = top_level(r)  # the only full parse of the page

    def member(key: str) -> Column:
        return F.try_element_at(top, F.lit(key))
    perr = member("ProcessingErrors")
    perr_type = F.get_json_object(perr, "$.ProcessingError.Type")
    perr_desc = F.get_json_object(perr, "$.ProcessingError.Description")
    upper_err = member("Error")
    lower_err = member("error")
    throttled = F.lit(False)
    for text in RATE_LIMIT_TEXTS:
        throttled = throttled | F.coalesce(upper_err.contains(text), F.lit(False))
    listed = F.get_json_object(member(entity.resource), f"$.{entity.container}.{entity.list_key}")
    status = (
        F.when(top.isNull(), F.lit("malformed"))
        .when(perr.isNotNull() & F.coalesce(perr_desc.contains(NOT_FOUND_TEXT), F.lit(False)),
              F.lit("not_found"))
        .when(perr.isNotNull(), F.lit("processing_error"))
        .when(throttled, F.lit("rate_limited"))
        .when(upper_err.isNotNull() | lower_err.isNotNull(), F.lit("error"))
        .when(listed.isNotNull(), F.lit("ok"))
        .otherwise(F.lit("empty")))
    detail = (F.when(perr.isNotNull(), perr_type)
              .when(upper_err.isNotNull(), upper_err)
              .when(lower_err.isNotNull(), lower_err))
    return pages.withColumn("status", status).withColumn("detail", detail)


def split_quarantine(pages: DataFrame, entity: Entity) -> tuple[DataFrame, DataFrame]:
    """(pages to parse, pages to quarantine) by :func:`classify_pages`."""
    c = classify_pages(pages, entity)
    good = c.where(F.col("status") == "ok").drop("status", "detail")
    return good, c.where(F.col("status") != "ok")


def announced_totals(pages: DataFrame, entity: Entity, group: list[str]) -> DataFrame:
    """Per group: ``total`` = largest announced ``Meta.TotalCount`` (partial aggregation)."""
    return pages.groupBy(*group).agg(F.max(total_count("raw_data", entity)).alias("total"))


def expected_offsets(totals: DataFrame, group: list[str], step: int) -> DataFrame:
    """Every offset ``0, step, ...`` below each group's ``total``.

    Two-level expansion: chunk starts first, redistributed by (group,
    chunk), then the offsets of each chunk, so one group announcing a huge
    total is expanded by many tasks.
    """
    span = step * OFFSETS_PER_CHUNK
    t = totals.where(F.col("total") > 0)
    chunks = t.select(*group, "total", F.explode(
        F.sequence(F.lit(0).cast("long"), (F.col("total") - 1).cast("long"),
                   F.lit(span).cast("long"))).alias("chunk"))
    chunks = chunks.repartition(*[F.col(c) for c in group], F.col("chunk"))
    last = F.least(F.col("chunk") + F.lit(span - step), F.col("total") - 1)
    return chunks.select(*group, F.explode(
        F.sequence(F.col("chunk"), last.cast("long"), F.lit(step).cast("long"))).alias("offset"))


def page_gaps(pages: DataFrame, entity: Entity, group: list[str], step: int | None = None
              ) -> DataFrame:
    """Offsets announced by ``TotalCount`` but not landed, per group (also the resume set).

    A group whose pages announce no total has one row with a NULL offset:
    how much of it is missing is unknown.
    """
    step = step or entity.page_size
    landed = pages.select(*group, F.col("offset").cast("long").alias("offset"))
    totals = announced_totals(pages, entity, group)
    unknown = totals.where(F.col("total").isNull()).select(*group, F.lit(None).cast("long").alias("offset"))
    expected = expected_offsets(totals, group, step)
    return expected.join(landed, [*group, "offset"], "left_anti").unionByName(unknown)


def page_gap_ranges(pages: DataFrame, entity: Entity, group: list[str], step: int | None = None) -> DataFrame:
    """Stretches of announced offsets that are not landed: group, ``first``, ``last`` (offsets), ``pages``.

    The offsets of :func:`page_gaps`, found from the landed ones: each gap
    lies between two landed neighbours, before the first or behind the last
    one, so no announced offset is generated and a total of any size costs no
    more than the pages landed. Offsets off the step or beyond the total are
    no neighbours. A group without a total has one row of nulls.

    Neighbours are found in two levels, so that a group with most of the pages
    is ordered by many tasks: windows over ``PAGES_PER_WINDOW`` consecutive
    places, then one over the ends of these.
    """
    step = step or entity.page_size
    totals = announced_totals(pages, entity, group)
    o = F.col("offset")
    # One row per offset and total, whatever was landed again; what is joined are distinct offsets.
    landed = pages.select(*group, F.col("offset").cast("long").alias("offset")).distinct()
    landed = (landed.join(totals.withColumnsRenamed({g: f"_{g}" for g in group}),
                          [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group]).drop(*[f"_{g}" for g in group])
              .where((o >= 0) & (o < F.col("total")) & (F.pmod(o, F.lit(step)) == 0)))
    landed = landed.withColumn("_part", (o / (step * PAGES_PER_WINDOW)).cast("long"))
    inner = (landed.withColumn("next", F.lead("offset").over(Window.partitionBy(*group, "_part").orderBy("offset")))
             .where(F.col("next") > o + step)
             .select(*group, (o + step).alias("first"), (F.col("next") - step).alias("last")))
    parts = landed.groupBy(*group, "_part").agg(
        F.min("offset").alias("low"), F.max("offset").alias("high"), F.max("total").alias("total"))
    ordered = Window.partitionBy(*group).orderBy("_part")
    end = F.col("total") - 1 - F.pmod(F.col("total") - 1, F.lit(step))  # the last announced offset
    outer = parts.select(*group, "low", "high", F.lag("high").over(ordered).alias("before"),
                         F.lead("low").over(ordered).alias("next"), end.alias("end"))
    behind = outer.select(*group, (F.col("high") + step).alias("first"),
                          F.coalesce(F.col("next") - step, F.col("end")).alias("last"))
    head = outer.where("before is null").select(*group, F.lit(0).cast("long").alias("first"), (F.col("low") - step).alias("last"))
    none = totals.join(parts.select(*group).distinct().withColumnsRenamed({g: f"_{g}" for g in group}),
                       [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group], "left_anti")
    empty = none.where("total > 0").select(*group, F.lit(0).cast("long").alias("first"), end.alias("last"))
    unknown = totals.where("total is null").select(*group, *[F.lit(None).cast("long").alias(c) for c in ("first", "last")])
    ranges = inner.unionByName(behind).unionByName(head).unionByName(empty).where("first <= last").unionByName(unknown)
    return ranges.withColumn("pages", ((F.col("last") - F.col("first")) / step + 1).cast("long"))


def page_audit(pages: DataFrame, entity: Entity, group: list[str]) -> DataFrame:
    """Per group: pages landed, items fetched, items announced, items missing, complete flag.

    An offset landed more than once counts once, with the most items that it
    came with; pages without an offset count each. Without an announced total,
    missing is NULL and the group is not complete.
    """
    n_items = F.coalesce(F.size(page_items("raw_data", entity)), F.lit(0))
    per_offset = pages.groupBy(*group, "offset").agg(
        F.when(F.col("offset").isNull(), F.count(F.lit(1))).otherwise(F.lit(1)).alias("n"),
        F.when(F.col("offset").isNull(), F.sum(n_items)).otherwise(F.max(n_items)).alias("items"),
        F.max(total_count("raw_data", entity)).alias("total"))
    per_group = per_offset.groupBy(*group).agg(
        F.sum("n").cast("long").alias("pages"), F.sum("items").cast("long").alias("fetched"), F.max("total").alias("announced"))
    missing = F.when(F.col("announced").isNotNull(), F.greatest(F.col("announced") - F.col("fetched"), F.lit(0)))
    return per_group.select(*group, "pages", "fetched", "announced",
                            missing.alias("missing"),
                            F.coalesce(F.col("fetched") >= F.col("announced"), F.lit(False)).alias("complete"))


def item_key_bitmaps(pages: DataFrame, entity: Entity, group: list[str], key: Column) -> DataFrame:
    """Mergeable sets of the item keys of landed pages: group, ``bucket``, ``bits``.

    ``key`` gives the number of an ``item`` (``parse_pages``): a whole number,
    of which each has a bit; items without one are left out. Bitmaps of more
    landings, days or groups are merged with :func:`merged_bitmaps`, so a key
    that many pages hold counts once over any span.
    """
    items = parse_pages(pages, entity, keep=group).select(*group, key.cast("long").alias("_key")).where("_key is not null")
    return items.groupBy(*group, F.bitmap_bucket_number("_key").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_key")).alias("bits"))


def merged_bitmaps(bitmaps: DataFrame, group: list[str]) -> DataFrame:
    """Bitmaps of the coarser ``group``."""
    return bitmaps.groupBy(*group, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def page_audit_distinct(bitmaps: DataFrame, totals: DataFrame, group: list[str]) -> DataFrame:
    """Per group: ``fetched`` distinct item keys, ``announced``, ``missing`` and ``complete``.

    ``bitmaps`` from :func:`item_key_bitmaps`, at ``group`` or finer; ``totals``
    (``announced_totals``) lists every group, also those without an item.
    """
    counts = merged_bitmaps(bitmaps, group).groupBy(*group).agg(F.sum(F.bitmap_count("bits")).alias("n"))
    counts = counts.withColumnsRenamed({g: f"_{g}" for g in group})
    rows = totals.join(counts, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group], "left")
    fetched = F.coalesce("n", F.lit(0)).cast("long")
    return rows.select(*group, fetched.alias("fetched"), F.col("total").alias("announced"),
                       F.when(F.col("total").isNotNull(), F.greatest(F.col("total") - fetched, F.lit(0))).alias("missing"),
                       F.coalesce(fetched >= F.col("total"), F.lit(False)).alias("complete"))


def request_plan(codes: DataFrame, blocks: DataFrame, landed: DataFrame, blocks_rows: int,
                 code_col: str = "airport_code", block_col: str = "block") -> DataFrame:
    """(code, block) pairs still to request: every code x every block, minus what landed.

    ``blocks`` is a small measured set (the blocks of one day), replicated to
    the codes; ``landed`` holds (code, block) of pages already stored.
    """
    wanted = replicated_product(codes.select(code_col).distinct(),
                                blocks.select(block_col), blocks_rows)
    have = landed.select(code_col, block_col).distinct()
    return wanted.join(have, [code_col, block_col], "left_anti")


def first_seen_codes(items: DataFrame, code: Column, order: dict[str, Column]) -> DataFrame:
    """Distinct non-empty codes with the ``order`` values where each was first seen.

    An aggregate, not a sort of everything: the caller orders by the
    returned columns only if it needs a list.
    """
    first = F.min(F.struct(*[c.alias(n) for n, c in order.items()])).alias("_f")
    out = items.where(code.isNotNull() & (code != "")).groupBy(code.alias("code")).agg(first)
    return out.select("code", *[F.col("_f")[n].alias(n) for n in order])
