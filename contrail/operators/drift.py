"""Schema drift: what the items of landed pages hold against what is declared.

Items are parsed as VARIANT, so nothing that a page sends is lost to a declared
schema. One pass lists the members of an item and of its declared objects; the
types met at each path are merged by ``schema_of_variant_agg``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from contrail.functions.jsonpath import deep_get
from contrail.schemas import Entity

# Types that a declared leaf may have, by the end of its path; the others are texts.
_LEAF_TYPES = {"Names.Name": ["STRING", "OBJECT", "ARRAY", "VARIANT"], "Coordinate.Latitude": ["STRING", "DECIMAL", "BIGINT", "DOUBLE", "VARIANT"],
               "Coordinate.Longitude": ["STRING", "DECIMAL", "BIGINT", "DOUBLE", "VARIANT"]}


def declared_paths(item: StructType, prefix: str = "") -> dict[str, list[str]]:
    """Types that each path of an item may have: objects, their members and so on."""
    out: dict[str, list[str]] = {}
    for f in item.fields:
        path = prefix + f.name
        if isinstance(f.dataType, StructType):
            out[path] = ["OBJECT"]
            out |= declared_paths(f.dataType, f"{path}.")
        else:
            out[path] = next((t for end, t in _LEAF_TYPES.items() if path.endswith(end)), ["STRING"])
    return out


def variant_items(pages: DataFrame, entity: Entity, group: list[str]) -> DataFrame:
    """``group`` and ``item``, each item of the pages as VARIANT; a single object is one item, a bad page none."""
    text = deep_get("raw_data", entity.resource, entity.container, entity.list_key)
    listed = F.when(F.ltrim(text).startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    parsed = pages.select(*group, F.try_parse_json(listed).alias("_items"))
    return parsed.select(*group, F.explode(F.try_variant_get("_items", "$", "array<variant>")).alias("item"))


def item_members(items: DataFrame, entity: Entity, group: list[str]) -> DataFrame:
    """``group``, ``path`` and ``value`` (VARIANT) of the members of each item and of its declared objects."""
    objects = [p for p, types in declared_paths(entity.item).items() if types == ["OBJECT"]]
    parts = F.array(F.struct(F.lit("").alias("prefix"), F.col("item").alias("object")), *[
        F.struct(F.lit(f"{p}.").alias("prefix"), F.try_variant_get("item", f"$.{p}", "variant").alias("object")) for p in objects])
    rows = items.select(*group, F.explode(parts).alias("_part")).select(*group, "_part.prefix", "_part.object")
    rows = rows.where("object is not null")
    members = rows.sparkSession.tvf.variant_explode(F.col("object").outer())
    return rows.lateralJoin(members).select(*group, F.concat("prefix", "key").alias("path"), "value")


def schema_drift(pages: DataFrame, entity: Entity, group: list[str]) -> DataFrame:
    """Departures from the declared item per ``group`` (say, the ingestion date).

    Columns: ``path``; ``status``: ``unknown`` (a member that is not
    declared), ``type`` (another type than declared) or ``missing`` (declared,
    in no item of the group); ``observed``, the merged type (VARIANT where
    types conflict, null if missing); ``items`` that hold the member. Members
    of unknown objects are not listed. A JSON null is no other type.
    """
    declared = declared_paths(entity.item)
    items = variant_items(pages, entity, group)
    seen = item_members(items, entity, group).groupBy(*group, "path").agg(
        F.schema_of_variant_agg("value").alias("observed"), F.count(F.lit(1)).alias("items"))
    kind = F.regexp_extract("observed", "^[A-Z]+", 0)
    allowed = F.create_map(*[x for p, types in declared.items() for x in (F.lit(p), F.array(*map(F.lit, [*types, "VOID"])))])
    types = F.try_element_at(allowed, F.col("path"))
    status = F.when(types.isNull(), "unknown").when(~F.array_contains(types, kind), "type")
    found = seen.withColumn("status", status).where("status is not null")
    # One row per group and declared path: what a group lacks is what its list of seen paths does not hold.
    lists = seen.groupBy(*group).agg(F.collect_set("path").alias("_paths"))
    absent = lists.select(*group, F.explode(F.array_except(F.array(*map(F.lit, declared)), F.col("_paths"))).alias("path"))
    missing = absent.select(*group, "path", F.lit(None).cast("string").alias("observed"), F.lit(0).cast("long").alias("items"),
                            F.lit("missing").alias("status"))
    return found.select(missing.columns).unionByName(missing)
