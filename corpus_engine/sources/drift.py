"""Fields that responses have and no schema names, and how often each field comes in which type.

A page's items are read as variants, which keep whatever is there. At every object that the schema declares, the item's own fields
are taken as a map, so declared and unknown ones are told apart within the row; nothing is parsed twice and no row leaves its task but
as counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpus_engine import schemas

FIELDS = "map<string,variant>"
RESPONSES = {
    "search": schemas.SEARCH_RESPONSE, "videos": schemas.VIDEO_RESPONSE, "channels": schemas.CHANNEL_RESPONSE,
    "threads": schemas.THREAD_RESPONSE, "replies": schemas.REPLY_RESPONSE, "playlists": schemas.PLAYLIST_RESPONSE,
}


def declared_objects(item: T.StructType, at: str = "") -> dict[str, list[str]]:
    """Path of every object that a schema declares, the item itself being the empty path, with its fields."""
    out = {at: item.fieldNames()}
    for f in item.fields:
        if isinstance(f.dataType, T.StructType):
            out |= declared_objects(f.dataType, f"{at}.{f.name}" if at else f.name)
    return out


def _fields(item: Column, path: str) -> Column:
    """The fields of the object at a path as a map; null where there is no object."""
    return F.try_variant_get(item, f"$.{path}" if path else "$", FIELDS)


def _named(fields: Column, path: str) -> Column:
    """Fields as (path, value) pairs; none where there are none."""
    prefix = f"{path}." if path else ""
    pairs = F.transform(F.map_entries(fields), lambda e: F.struct(F.concat(F.lit(prefix), e["key"]).alias("path"), e["value"].alias("value")))
    return F.coalesce(pairs, F.array().cast("array<struct<path:string,value:variant>>"))


def variant_items(pages: DataFrame) -> DataFrame:
    """The items of pages with a text response, as ``item``; pages that are no JSON or have no list of items have none."""
    items = F.try_variant_get(F.try_parse_json("response"), "$.items", "array<variant>")
    return pages.select(*[c for c in pages.columns if c != "response"], F.posexplode(items).alias("pos", "item"))


def field_inventory(pages: DataFrame, kind: str) -> DataFrame:
    """``path``, ``type``, ``declared`` and ``n_items``: every field of every declared object of a kind's items.

    An unknown object or list is one field; its type says what is inside. Counts are added up in the tasks first.
    """
    known = declared_objects(RESPONSES[kind]["items"].dataType.elementType)
    item = F.col("item")
    found = F.concat(*[_named(_fields(item, path), path) for path in known])
    rows = variant_items(pages).select(F.explode(found).alias("f")).select("f.path", F.schema_of_variant("f.value").alias("type"))
    declared = [f"{path}.{name}" if path else name for path, names in known.items() for name in names]
    return rows.groupBy("path", "type").agg(F.count(F.lit(1)).alias("n_items")).select(
        "path", "type", F.col("path").isin(declared).alias("declared"), "n_items")


def unknown_fields(items: DataFrame, kind: str) -> DataFrame:
    """Adds ``unknown`` to rows of :func:`variant_items`: a map from path to JSON text of what the kind's schema does not name.

    Null where an item has nothing unknown, so the column costs little where nothing drifts.
    """
    known = declared_objects(RESPONSES[kind]["items"].dataType.elementType)
    item = F.col("item")

    def rest(path: str, names: list[str]) -> Column:
        return F.map_filter(_fields(item, path), lambda k, _: ~k.isin(names))

    parts = F.concat(*[_named(rest(path, names), path) for path, names in known.items()])
    texts = F.map_from_entries(F.transform(parts, lambda e: F.struct(e["path"], F.to_json(e["value"]))))
    return items.withColumn("unknown", F.when(F.size(parts) > 0, texts))
