"""Well-known binary geometries as GeoJSON text.

Both byte orders, the extended form with an SRID, Z and M (read and left
out), collections in collections; as binary or as hexadecimal text.  What does
not decode whole gives NULL.  Regions are a dimension table, so their rows go
through Arrow batches of a small Python decoder.
"""

from __future__ import annotations

import json
import struct
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# tasks need no copy of the package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# fixed values: type codes of the format, and the flags of its extended form
TYPES = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection"}
_Z, _M, _SRID = 0x80000000, 0x40000000, 0x20000000


class _Reader:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, form: str) -> tuple:
        out = struct.unpack_from(form, self.data, self.at)
        self.at += struct.calcsize(form)
        return out

    def geometry(self, depth: int = 0) -> dict:
        order = {0: ">", 1: "<"}[self.take("B")[0]]
        code, = self.take(f"{order}I")
        width = 2 + bool(code & _Z) + bool(code & _M)
        if code & _SRID:
            self.take(f"{order}I")
        code &= 0x0FFFFFFF
        width += (code // 1000 in (1, 2)) + 2 * (code // 1000 == 3)
        kind = TYPES[code % 1000]

        def count() -> int:
            n, = self.take(f"{order}I")
            # each thing that follows takes some bytes: no list longer than the text
            if n > len(self.data):
                raise ValueError("count beyond the end")
            return n

        def position() -> list[float]:
            return list(self.take(f"{order}{width}d")[:2])

        def line() -> list:
            return [position() for _ in range(count())]

        if kind == "Point":
            p = position()
            # an empty point is one of NaN
            return {"type": "MultiPoint", "coordinates": []} if p[0] != p[0] and p[1] != p[1] else {"type": kind, "coordinates": p}
        if kind == "LineString":
            return {"type": kind, "coordinates": line()}
        if kind == "Polygon":
            return {"type": kind, "coordinates": [line() for _ in range(count())]}
        if depth > 32:
            raise ValueError("nested too deeply")
        parts = [self.geometry(depth + 1) for _ in range(count())]
        if kind == "GeometryCollection":
            return {"type": kind, "geometries": parts}
        if any(p["type"] not in (kind.removeprefix("Multi"), "MultiPoint") for p in parts):
            raise ValueError("parts of another type")
        return {"type": kind, "coordinates": [p["coordinates"] for p in parts if p["coordinates"]]}


def decoded(data: bytes | None) -> str | None:
    """GeoJSON text of one geometry; None if it does not decode whole."""
    if data is None:
        return None
    reader = _Reader(data)
    try:
        found = reader.geometry()
    except (struct.error, KeyError, ValueError, IndexError):
        return None
    return json.dumps(found) if reader.at == len(data) else None


def with_geojson(source: DataFrame, column: str = "wkb") -> DataFrame:
    """``source`` with ``geojson`` in place of ``column``, binary or hexadecimal text."""
    value = F.col(column)
    if dict(source.dtypes)[column] == "string":
        # NULL for text that is not hexadecimal
        value = F.when(value.rlike("^(?:[0-9A-Fa-f]{2})*$"), F.unhex(value))
    rest = [c for c in source.columns if c != column]

    def run(batches):
        for batch in batches:
            texts = pa.array([decoded(v) for v in batch.column(0).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], texts], names=[*rest, "geojson"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields if f.name != column], "geojson string"])
    return source.select(value.alias(column), *rest).mapInArrow(run, schema)
