"""GeoJSON FeatureCollection decoder (work zones)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions.values import is_object


def geojson_features(value: Column) -> Column:
    """``features`` of a FeatureCollection as ``array<variant>`` (items that
    are not objects skipped); null when the document is not valid JSON or
    has no ``features`` list."""
    feats = F.try_variant_get(F.try_parse_json(value), "$.features", "array<variant>")
    return F.filter(feats, is_object)


def geojson_problem(value: Column) -> Column:
    """Why a document is unusable (null when it is fine): invalid JSON with
    its first 400 characters, or an unexpected payload shape."""
    doc = F.try_parse_json(value)
    return (F.when(doc.isNull(), F.concat(
        F.lit("invalid JSON; first 400 chars: "), F.substring(value, 1, 400)))
        .when(geojson_features(value).isNull(), F.concat(
            F.lit("unexpected payload structure: "),
            F.coalesce(F.schema_of_variant(doc), F.lit("?")))))


def geojson_explode(docs: DataFrame, value_col: str = "value") -> DataFrame:
    """One row per feature (``pos``, ``feature`` variant)."""
    keep = [c for c in docs.columns if c != value_col]
    feats = geojson_features(F.col(value_col))
    return docs.select(*keep, F.posexplode(feats).alias("pos", "feature"))


class FeedPayloadError(RuntimeError):
    """A snapshot document is not a usable FeatureCollection."""


def problem_kind(value: Column) -> Column:
    """``ok``, ``invalid_json`` or ``unexpected_shape`` for each document."""
    doc = F.try_parse_json(value)
    return (F.when(doc.isNull(), F.lit("invalid_json"))
            .when(F.try_variant_get(doc, "$.features", "array<variant>").isNull(),
                  F.lit("unexpected_shape"))
            .otherwise(F.lit("ok")))


def validate_geojson(docs: DataFrame, value_col: str = "value", fail: bool = True) -> DataFrame:
    """Documents with their problem (null when fine).  With ``fail`` the
    first bad document raises :class:`FeedPayloadError` carrying the reason
    (and a 400-character snippet for bad JSON); only that one row is
    fetched."""
    checked = docs.withColumn("problem", geojson_problem(F.col(value_col)))
    if fail:
        bad = checked.where(F.col("problem").isNotNull()).select("problem").first()
        if bad is not None:
            raise FeedPayloadError(bad[0])
    return checked
