"""Citizen report normalisation: seven document shapes → one schema.

Each document is a variant.  The shape is the first matching key-presence
test; every unified field is then a ``CASE`` over the shape, so a whole
batch is normalised by one projection that Catalyst compiles, with no
Python per row.  A key holding JSON null counts as present, as ``key in
dict`` does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicflow.functions.common import to_double
from civicflow.functions.geo import make_point

# The document shapes, first hit wins.  Each entry is
# (shape number, keys that must all be present, field → JSON path).
# Fields: external_id, ts (date field), category, commune, quartier, status.
SHAPES = (
    (1, ("event",), {"external_id": "$.event.id", "ts": "$.event.timestamp",
                     "category": "$.event.payload.type", "commune": "$.event.payload.commune",
                     "quartier": "$.event.payload.quartier"}),
    (2, ("request_id",), {"external_id": "$.request_id", "ts": "$.created_at", "category": "$.type",
                          "commune": "$.city", "quartier": "$.district", "status": "$.status"}),
    (3, ("id", "date"), {"external_id": "$.id", "ts": "$.date", "category": "$.category",
                         "status": "$.state"}),
    (4, ("_id", "type_demande"), {"external_id": "$._id", "ts": "$.date_creation",
                                  "category": "$.type_demande", "status": "$.statut",
                                  "commune": "$.localisation.commune",
                                  "quartier": "$.localisation.quartier"}),
    (5, ("ref",), {"external_id": "$.ref", "ts": "$.date_signalement", "category": "$.service_type",
                   "status": "$.status"}),
    (6, ("_id", "service"), {"external_id": "$._id", "ts": "$.event_date", "category": "$.service",
                             "commune": "$.location.commune"}),
    (7, ("created",), {"ts": "$.created", "category": "$.type_demande"}),
)
# shape 3 carries a "lat,lon" text point; shape 5 a "quartier - commune" text
GEO_SHAPE, GEO_PATH = 3, "$.geo"
PLACE_SHAPE, PLACE_PATH, PLACE_SEPARATOR = 5, "$.localisation", " - "


def has_key(doc: Column, key: str) -> Column:
    return F.try_variant_get(doc, f"$.{key}", "variant").isNotNull()


def shape(doc: Column) -> Column:
    """1..7 for the known shapes, 0 for none (such documents are dropped)."""
    expr = None
    for number, keys, _ in SHAPES:
        test = None
        for k in keys:
            test = has_key(doc, k) if test is None else test & has_key(doc, k)
        expr = F.when(test, F.lit(number)) if expr is None else expr.when(test, F.lit(number))
    return expr.otherwise(F.lit(0))


def _text(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, path, "string")


def _kind(doc: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(doc, path, "variant"))


def field(doc: Column, shape_col: Column, name: str) -> Column:
    """One unified text field, taken from the path of the document's shape."""
    expr = None
    for number, _, paths in SHAPES:
        if name not in paths:
            continue
        value = _text(doc, paths[name])
        expr = F.when(shape_col == number, value) if expr is None else expr.when(shape_col == number, value)
    if name == "commune" or name == "quartier":
        place = _text(doc, PLACE_PATH)
        parts = F.split(place, PLACE_SEPARATOR, -1)
        usable = (_kind(doc, PLACE_PATH) == "STRING") & place.contains(PLACE_SEPARATOR)
        part = parts[1] if name == "commune" else parts[0]
        expr = expr.when((shape_col == PLACE_SHAPE) & usable, part)
    return expr


def date_field(doc: Column, shape_col: Column) -> Column:
    """The shape's date field as a variant (normalised by ``normalize_date``)."""
    expr = None
    for number, _, paths in SHAPES:
        value = F.try_variant_get(doc, paths["ts"], "variant")
        expr = F.when(shape_col == number, value) if expr is None else expr.when(shape_col == number, value)
    return expr


def geo_lat_lon(doc: Column, shape_col: Column) -> tuple[Column, Column]:
    """``"lat,lon"`` text → (lat, lon); both NULL unless exactly two numbers."""
    text = _text(doc, GEO_PATH)
    parts = F.split(text, ",", -1)
    usable = ((shape_col == GEO_SHAPE) & (_kind(doc, GEO_PATH) == "STRING")
              & (F.size(parts) == 2))
    lat = F.when(usable, to_double(parts[0]))
    lon = F.when(usable, to_double(parts[1]))
    both = lat.isNotNull() & lon.isNotNull()
    return F.when(both, lat), F.when(both, lon)


def category(doc: Column, shape_col: Column) -> Column:
    """Category, lower-cased; a non-text category becomes NULL."""
    expr = None
    for number, _, paths in SHAPES:
        value = F.when(_kind(doc, paths["category"]) == "STRING", F.lower(_text(doc, paths["category"])))
        expr = F.when(shape_col == number, value) if expr is None else expr.when(shape_col == number, value)
    return expr


def field_columns(doc: Column, shape_col: Column) -> list[Column]:
    """Unified fields of a document whose shape is already a column.

    The date stays a variant (``ts_value``); ``normalize_date`` runs on it in
    a following projection so its type tests read one column, not a CASE.
    """
    lat, lon = geo_lat_lon(doc, shape_col)
    return [
        field(doc, shape_col, "external_id").alias("external_id"),
        date_field(doc, shape_col).alias("ts_value"),
        category(doc, shape_col).alias("category"),
        field(doc, shape_col, "commune").alias("commune"),
        field(doc, shape_col, "quartier").alias("quartier"),
        field(doc, shape_col, "status").alias("status"),
        lat.alias("lat"),
        lon.alias("lon"),
    ]


def point_of(lon: Column, lat: Column) -> Column:
    """CASE WHEN lat and lon NOT NULL THEN point ELSE NULL."""
    return make_point(lon, lat)
