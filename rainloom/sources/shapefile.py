"""Polygons from shapefiles (.shp and .dbf): a Spark data source.

    spark.dataSource.register(Shapefile); spark.read.format("shapefile").option("field", "Cat_Name").load(path)

gives basin and rings, as the zonal operators take them."""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader

FIELD = "Cat_Name"
# fixed values of the format: shape types that are polygons, with and without z and m
POLYGONS = (5, 15, 25)


def read_names(path: str, column: str) -> list[str | None]:
    """One attribute of every record of a .dbf file."""
    with open(path, "rb") as f:
        head = f.read(32)
        n, header_size, record_size = struct.unpack("<IHH", head[4:12])
        fields, at = {}, 1
        while (raw := f.read(32))[:1] not in (b"\r", b""):
            fields[raw[:11].split(b"\0")[0].decode()] = (at, raw[16])
            at += raw[16]
        if column not in fields:
            raise ValueError(f"{path} has no field {column!r}; it has {', '.join(fields)}")
        start, size = fields[column]
        f.seek(header_size)
        return [f.read(record_size)[start : start + size].decode(errors="replace").strip() or None for _ in range(n)]


def read_rings(path: str) -> Iterator[list[list[tuple[float, float]]]]:
    """The rings of every record of a .shp file; none for null shapes."""
    with open(path, "rb") as f:
        if struct.unpack(">i", f.read(100)[:4])[0] != 9994:
            raise ValueError(f"{path} is no shapefile")
        while head := f.read(8):
            body = f.read(2 * struct.unpack(">ii", head)[1])
            kind = struct.unpack_from("<i", body)[0]
            if kind == 0:
                yield []
                continue
            if kind not in POLYGONS:
                raise ValueError(f"{path} has shapes of type {kind}, not polygons")
            parts, points = struct.unpack_from("<ii", body, 36)
            starts = [*struct.unpack_from(f"<{parts}i", body, 44), points]
            xy = struct.unpack_from(f"<{2 * points}d", body, 44 + 4 * parts)
            corners = list(zip(xy[::2], xy[1::2], strict=True))
            yield [corners[a : b - (corners[a] == corners[b - 1])] for a, b in zip(starts, starts[1:], strict=False)]


def write(path: str, rings: dict[str, list[list[tuple[float, float]]]], field: str = FIELD) -> None:
    """Polygons by name as a .shp file and its .dbf of one attribute: some thousands of polygons, as a person draws them."""
    box = lambda corners: [f(c[k] for c in corners) for f in (min, max) for k in (0, 1)]
    records, everything = [], [c for own in rings.values() for ring in own for c in ring]
    for number, own in enumerate(rings.values(), 1):
        closed = [ring + ring[:1] for ring in own]
        corners = [c for ring in closed for c in ring]
        starts = [sum(map(len, closed[:k])) for k in range(len(closed))]
        body = struct.pack(f"<i4d2i{len(starts)}i", POLYGONS[0], *box(corners), len(starts), len(corners), *starts) + b"".join(struct.pack("<2d", *c) for c in corners)
        records.append(struct.pack(">2i", number, len(body) // 2) + body)
    names = [n.encode() for n in rings]
    width = max(map(len, names), default=1)
    with open(path, "wb") as f:
        f.write(struct.pack(">7i", 9994, *[0] * 5, (100 + sum(map(len, records))) // 2) + struct.pack("<2i8d", 1000, POLYGONS[0], *(box(everything) if everything else [0.0] * 4), *[0.0] * 4) + b"".join(records))
    with open(f"{os.path.splitext(path)[0]}.dbf", "wb") as f:
        f.write(struct.pack("<4BIHH20x", 3, 100, 1, 1, len(names), 65, 1 + width) + struct.pack("<11sc4xB15x", field.encode(), b"C", width) + b"\r")
        f.write(b"".join(b" " + n.ljust(width) for n in names) + b"\x1a")


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.base, self.field = os.path.splitext(options["path"])[0], options.get("field", FIELD)

    def read(self, partition) -> Iterator[tuple]:
        for name, rings in zip(read_names(f"{self.base}.dbf", self.field), read_rings(f"{self.base}.shp"), strict=True):
            if rings:
                yield name, [[{"x": x, "y": y} for x, y in ring] for ring in rings]


class Shapefile(DataSource):
    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> str:
        return "basin string, rings array<array<struct<x:double,y:double>>>"

    def reader(self, schema) -> _Reader:
        return _Reader(dict(self.options))
