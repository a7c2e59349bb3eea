"""Geometry expressions: great-circle distance, geofence, line endpoints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadlake.functions.arrays import let
from roadlake.schemas import EARTH_RADIUS_KM


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km between two points given in degrees."""
    lat1, lon1, lat2, lon2 = (c if isinstance(c, Column) else F.lit(float(c))
                              for c in (lat1, lon1, lat2, lon2))
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    a = (F.pow(F.sin(dlat / 2), 2) +
         F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) *
         F.pow(F.sin(dlon / 2), 2))
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def within_radius(lat: Column, lon: Column, center_lat: float,
                  center_lon: float, radius_km: float,
                  require_coords: bool = False) -> Column:
    """Geofence predicate: kept when the radius is <= 0, when coordinates are
    missing (unless ``require_coords``), or when the distance <= radius."""
    if radius_km is None or radius_km <= 0:
        return F.lit(True)
    missing = lat.isNull() | lon.isNull()
    inside = haversine_km(F.lit(float(center_lat)), F.lit(float(center_lon)),
                          lat, lon) <= float(radius_km)
    if require_coords:
        return ~missing & inside
    return missing | inside


def _pos_ok(p: Column, accept_altitude: bool) -> Column:
    n = F.size(p)
    return (n >= 2) if accept_altitude else (n == 2)


def line_endpoints(geom_type: Column, coords_variant: Column,
                   accept_altitude: bool = False) -> Column:
    """First and last positions of a LineString / MultiLineString.

    Returns ``struct(begin_lat, begin_lon, end_lat, end_lon)``.  LineString:
    first and last position; MultiLineString: first position of the first
    line and last position of the last line (an empty first line leaves the
    begin unset).  A position that is not exactly ``[lon, lat]`` stops the
    extraction: what was set before it stays, the rest is null.  Other types
    and empty coordinates give nulls.  ``accept_altitude`` lets 3-D
    positions through (their first two numbers are used).
    """
    is_line = geom_type == "LineString"
    is_multi = geom_type == "MultiLineString"

    def parts(v):                           # positions are typed once chosen, a cast of all of them is slow
        return F.try_variant_get(v, "$", "array<variant>")

    def filled(arr):
        return F.coalesce(F.size(arr) > 0, F.lit(False))

    def ends(items):
        # the first of the first line and the last of the last one; a LineString is its only line
        lines = F.struct(F.when(is_line, items).when(is_multi, parts(F.get(items, 0))).alias("first"),
                         F.when(is_line, items).when(is_multi, parts(F.try_element_at(items, F.lit(-1)))).alias("last"))
        return let(lines, lambda x: F.struct(
            filled(items).alias("has"), filled(x["first"]).alias("first_has"), filled(x["last"]).alias("last_has"),
            F.try_variant_get(F.get(x["first"], 0), "$", "array<double>").alias("begin"),
            F.try_variant_get(F.try_element_at(x["last"], F.lit(-1)), "$", "array<double>").alias("end")))

    def checked(e):
        begin_ok = e["has"] & e["first_has"] & F.coalesce(_pos_ok(e["begin"], accept_altitude), F.lit(False))
        failed = e["has"] & e["first_has"] & ~begin_ok
        end_ok = e["has"] & ~failed & e["last_has"] & F.coalesce(_pos_ok(e["end"], accept_altitude), F.lit(False))
        return F.struct(F.when(begin_ok, e["begin"]).alias("begin"), F.when(end_ok, e["end"]).alias("end"))

    found = F.when(is_line | is_multi, let(parts(coords_variant), lambda items: let(ends(items), checked)))
    return let(found, lambda x: F.struct(
        F.get(x["begin"], 1).alias("begin_lat"), F.get(x["begin"], 0).alias("begin_lon"),
        F.get(x["end"], 1).alias("end_lat"), F.get(x["end"], 0).alias("end_lon")))
