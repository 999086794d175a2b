"""Page parsing: list-or-object extraction, ``posexplode`` and leaf conversions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from contrail.functions.jsonpath import deep_get, parse_list
from contrail.schemas import NAME_ENTRY, Entity

# The preferred language of names given in several languages.
PREFERRED_LANGUAGE = "EN"


def page_items(raw: Column | str, entity: Entity) -> Column:
    """``array<item>`` of a page; a single object counts as a one-item list; bad page → NULL."""
    return parse_list(deep_get(raw, entity.resource, entity.container, entity.list_key),
                      entity.item)


def total_count(raw: Column | str, entity: Entity) -> Column:
    """``Meta.TotalCount`` of a page as BIGINT (NULL when missing or not a number)."""
    return deep_get(raw, entity.resource, "Meta", "TotalCount").try_cast("long")


def parse_pages(bronze: DataFrame, entity: Entity, keep: list[str] | None = None) -> DataFrame:
    """One row per item: ``keep`` columns, ``pos`` (index in its page) and ``item`` struct.

    NULL, empty, malformed or error pages yield no rows (``posexplode`` of
    NULL). Narrow per-row work, no shuffle.
    """
    keep = keep if keep is not None else [c for c in bronze.columns if c != "raw_data"]
    return bronze.select(*keep, F.posexplode(page_items("raw_data", entity)).alias("pos", "item"))


def name_of(text: Column) -> Column:
    """Name from a ``Names.Name`` value kept as raw JSON text.

    Object ``{"@LanguageCode": .., "$": ..}`` → its ``$``; list of such →
    the English entry, else the first; plain text → itself.
    """
    entries = F.from_json(text, ArrayType(NAME_ENTRY))
    preferred = F.filter(entries, lambda e: F.upper(e["@LanguageCode"]) == PREFERRED_LANGUAGE)
    structured = F.ltrim(text).startswith("{") | F.ltrim(text).startswith("[")
    return F.when(structured, F.coalesce(F.try_element_at(preferred, F.lit(1))["$"],
                                         F.try_element_at(entries, F.lit(1))["$"])
                  ).otherwise(text)


def to_double(text: Column) -> Column:
    """A number sent as JSON number or quoted text → DOUBLE; anything else → NULL."""
    return text.try_cast("double")
