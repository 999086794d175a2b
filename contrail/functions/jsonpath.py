"""JSON helpers over landed page text (all JVM-side, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_path(*keys: str) -> str:
    return "$." + ".".join(keys)


def deep_get(raw: Column | str, *keys: str, default: Column | None = None) -> Column:
    """Value at ``keys`` as JSON text (objects/arrays) or scalar text; ``default`` when missing."""
    got = F.get_json_object(_col(raw), json_path(*keys))
    return got if default is None else F.coalesce(got, default)


def parse_list(text: Column | str, item_type: DataType) -> Column:
    """Parse a list-or-single-object JSON text into ``array<item_type>`` (NULL if malformed).

    ``from_json`` with an array schema already reads a root object as a
    one-item array, so no text rewriting (and no second scan) is needed.
    """
    return F.from_json(_col(text), ArrayType(item_type))


def top_level(raw: Column | str) -> Column:
    """``map<string,string>`` of a JSON object's top-level members (values as raw JSON text).

    One parse of the document; NULL when it is not a JSON object.
    """
    return F.from_json(_col(raw), "map<string,string>")
