"""Service areas: city geofences as GeoJSON features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The geometry types of GeoJSON, and how deep their positions lie.
DEPTHS = {
    "Point": 0,
    "MultiPoint": 1,
    "LineString": 1,
    "MultiLineString": 2,
    "Polygon": 2,
    "MultiPolygon": 3,
}
COLLECTION = "GeometryCollection"
# Collections within collections, the outermost included; deeper ones are refused.
NESTED = 5


def service_area(systems: DataFrame, system_id: str | None = None) -> DataFrame:
    """``system_id, geofence_geojson, geometry`` (variant).

    Malformed text, an unknown type, and coordinates that do not fit the type fail the query.
    """
    cities = systems if system_id is None else systems.where(F.col("id") == system_id)
    parsed = F.parse_json("geofence_geojson")
    return cities.select(
        F.col("id").alias("system_id"),
        "geofence_geojson",
        F.when(is_geometry(parsed), parsed)
        .otherwise(F.raise_error(F.concat(F.lit("not a GeoJSON geometry: "), F.col("geofence_geojson"))))
        .alias("geometry"),
    )


def is_geometry(parsed: Column, nested: int = NESTED) -> Column:
    """Whether a variant has a geometry's type and coordinates of that type's shape.

    Positions have two numbers or more, lines two positions or more, and rings four or more
    of which the first and last are equal. Every member of a collection must be a geometry,
    which may be a collection again, up to ``nested`` of them within each other.
    """
    kind = F.try_variant_get(parsed, "$.type", "string")
    fits = F.lit(False)
    if nested:
        members = F.try_variant_get(parsed, "$.geometries", "array<variant>")
        whole = F.forall(members, lambda member: member.isNotNull() & is_geometry(member, nested - 1))
        fits = (kind == COLLECTION) & members.isNotNull() & whole
    for name, depth in DEPTHS.items():
        shape = "array<" * (depth + 1) + "double" + ">" * (depth + 1)
        coordinates = F.try_variant_get(parsed, "$.coordinates", shape)
        fits = fits | ((kind == name) & coordinates.isNotNull() & _every(coordinates, depth, name))
    return F.coalesce(fits, F.lit(False))


def _every(part: Column, depth: int, kind: str) -> Column:
    """Whether the coordinates ``depth`` levels above their positions have the shape of ``kind``."""
    if depth == 0:
        return (F.size(part) >= 2) & F.forall(part, lambda number: number.isNotNull())
    inside = F.forall(part, lambda item: item.isNotNull() & _every(item, depth - 1, kind))
    if depth == 1 and kind.endswith("Polygon"):
        return inside & (F.size(part) >= 4) & (F.element_at(part, 1) == F.element_at(part, -1))
    if depth == 1 and kind.endswith("LineString"):
        return inside & (F.size(part) >= 2)
    return inside


def feature_collection(features: DataFrame) -> DataFrame:
    """One row, ``value``: the FeatureCollection text of all cities, in the order of their ids."""
    feature = F.to_json(
        F.struct(
            F.lit("Feature").alias("type"),
            F.struct("geofence_geojson").alias("properties"),
            F.col("geometry"),
        )
    )
    ordered = F.array_sort(F.collect_list(F.struct("system_id", feature.alias("feature"))))
    return features.agg(ordered.alias("all")).select(
        F.concat(
            F.lit('{"type":"FeatureCollection","features":['),
            F.array_join(F.col("all.feature"), ","),
            F.lit("]}"),
        ).alias("value")
    )
