"""ArcGIS FeatureSet decoder (road-weather stations)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions.values import is_object


def arcgis_item_array(value: Column) -> Column:
    """Items of one ArcGIS document as ``array<struct<attrs, geom>>`` (variants).

    An object with a ``features`` list gives one item per feature with its
    ``attributes`` and ``geometry`` (missing ones are empty); a top-level
    JSON array gives its elements as attributes without geometry; anything
    else (other objects, bad JSON) gives no items."""
    doc = F.try_parse_json(value)

    def objects(arr):                       # items that are not objects are skipped
        return F.filter(arr, is_object)

    feats = objects(F.try_variant_get(doc, "$.features", "array<variant>"))
    bare = objects(F.try_variant_get(doc, "$", "array<variant>"))
    empty = F.parse_json(F.lit("{}"))
    from_feats = F.transform(feats, lambda f: F.struct(
        F.try_variant_get(f, "$.attributes", "variant").alias("attrs"),
        # a feature always carries a geometry object ({} when missing)
        F.coalesce(F.try_variant_get(f, "$.geometry", "variant"), empty).alias("geom"),
        F.lit(False).alias("bare")))
    from_bare = F.transform(bare, lambda a: F.struct(
        a.alias("attrs"),
        # a bare item has no geometry of its own; its own "_geom" key, if
        # any, is what the coordinate fallback reads
        F.try_variant_get(a, "$._geom", "variant").alias("geom"),
        F.lit(True).alias("bare")))
    return F.coalesce(from_feats, from_bare,
                      F.array().cast("array<struct<attrs:variant,geom:variant,bare:boolean>>"))


def arcgis_explode(docs: DataFrame, value_col: str = "value") -> DataFrame:
    """One row per ArcGIS item: the document's other columns plus ``pos``
    (0-based position in the document), ``attrs`` and ``geom``."""
    keep = [c for c in docs.columns if c != value_col]
    return (docs.select(*keep, F.posexplode(arcgis_item_array(F.col(value_col)))
                        .alias("pos", "item"))
            .select(*keep, "pos", F.col("item.attrs").alias("attrs"),
                    F.col("item.geom").alias("geom"), F.col("item.bare").alias("bare")))


def arcgis_item_count(value: Column) -> Column:
    """Number of items in a document (the poller's "attempted" count)."""
    return F.size(arcgis_item_array(value))
