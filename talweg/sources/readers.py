"""Sources: typed CSV, GeoJSON, GeoParquet, GeoPackage, shapefiles, OSM JSON, strict JSON, JSON inside HTML."""

from __future__ import annotations

import json
import math
import sqlite3
import struct
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from talweg.functions.geometry import decode_wkb


def exists(spark: SparkSession, path: str) -> bool:
    """Asked of Spark's own file systems, so that any store will do."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p))


def read_csv(spark: SparkSession, path: str, schema: str, columns: list[str] | None = None) -> DataFrame:
    """CSV with a header and an explicit schema, never inferred; columns prunes the scan."""
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return df.select(*columns) if columns else df


def read_csv_text(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Every column as text; empty fields are empty strings, nothing is taken for missing."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(schema).option("header", True).option("nullValue", "\x00").option("emptyValue", "").csv(path).fillna("")


def read_optional(spark: SparkSession, path: str, schema: str, kind: str = "parquet") -> DataFrame:
    """The table, or an empty one of the schema where there is none."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).format(kind).load(path)


def read_preferred(spark: SparkSession, choices: list[tuple[str, str]], schema: str | None = None) -> DataFrame:
    """The first of (format, path) that exists. A broken preferred file is an error; the next is not tried."""
    for kind, path in choices:
        if exists(spark, path):
            return read_geojson(spark, path, schema or "") if kind == "geojson" else spark.read.format(kind).load(path)
    raise FileNotFoundError(", ".join(p for _, p in choices))


def read_glob(spark: SparkSession, pattern: str, schema: str, kind: str = "csv") -> DataFrame:
    """All files of a pattern with the file each row is from."""
    return spark.read.schema(schema).option("header", True).format(kind).load(pattern).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))


def read_geojson(spark: SparkSession, path: str, properties: str, with_geometry: bool = True) -> DataFrame:
    """Features: properties (a schema) as columns, geometry as kind and the JSON of its coordinates."""
    feature = f"struct<properties:struct<{_struct(properties)}>,geometry:struct<type:string,coordinates:string>>"
    raw = spark.read.option("multiLine", True).schema(f"features array<{feature}>").json(path).select(F.explode("features").alias("f"))
    geometry = [F.col("f.geometry.type").alias("geometry_type"), F.col("f.geometry.coordinates").alias("coordinates")] if with_geometry else []
    return raw.select("f.properties.*", *geometry)


def _struct(schema: str) -> str:
    return ",".join(":".join(x.split(None, 1)) for x in schema.split(",")) if schema else "_none:string"


def point_columns(coordinates: Column) -> list[Column]:
    p = F.from_json(coordinates, "array<double>")
    return [F.get(p, 0).alias("lon"), F.get(p, 1).alias("lat")]


def line_points(coordinates: Column) -> Column:
    return F.transform(F.from_json(coordinates, "array<array<double>>"), lambda p: F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y")))


def polygon_rings(coordinates: Column) -> Column:
    return F.transform(F.from_json(coordinates, "array<array<array<double>>>"), lambda r: F.transform(r, lambda p: F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y"))))


@F.udf(StructType([StructField("kind", StringType()), StructField("coordinates", StringType())]), useArrow=True)
def wkb_geometry(raw: bytes) -> tuple[str, str] | None:
    """Kind and JSON coordinates of well-known binary; broken or missing geometry is null."""
    try:
        kind, coordinates = decode_wkb(bytes(raw))
    except (TypeError, struct.error, KeyError, IndexError, ValueError):
        return None
    return kind, json.dumps(coordinates)


def read_geoparquet(spark: SparkSession, path: str, columns: list[str] | None = None, geometry: str = "geometry") -> DataFrame:
    """Parquet with well-known binary: the other columns, and g as wkb_geometry gives it. Without geometry in columns it is not read."""
    df = spark.read.parquet(path)
    if columns is not None:
        df = df.select(*columns)
    return df.withColumn("g", wkb_geometry(F.col(geometry))).drop(geometry) if geometry in df.columns else df


def osm_ways(spark: SparkSession, path: str) -> DataFrame:
    """Ways of an OSM answer with at least two points: id, tags, points."""
    raw = spark.read.option("multiLine", True).schema("elements array<struct<type:string,id:bigint,lat:double,lon:double,tags:map<string,string>,geometry:array<struct<lat:double,lon:double>>>>").json(path).select(F.explode("elements").alias("e"))
    return raw.filter("e.type = 'way' AND size(e.geometry) >= 2").select(F.col("e.id").alias("osm_id"), F.col("e.tags").alias("tags"), F.transform("e.geometry", lambda p: F.struct(p["lon"].alias("x"), p["lat"].alias("y"))).alias("points"))


def osm_nodes(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("multiLine", True).schema("elements array<struct<type:string,id:bigint,lat:double,lon:double,tags:map<string,string>>>").json(path).select(F.explode("elements").alias("e"))
    return raw.filter("e.type = 'node' AND e.lat IS NOT NULL AND e.lon IS NOT NULL").select(F.col("e.id").alias("osm_id"), F.col("e.tags").alias("tags"), F.col("e.lon").alias("lon"), F.col("e.lat").alias("lat"))


def json_in_html(html: Column, variable: str, schema: str) -> Column:
    """The JSON that a script assigns to a variable."""
    return F.from_json(F.regexp_extract(html, rf"(?s)(?:const|let|var)\s+{variable}\s*=\s*(\[.*?\]|\{{.*?\}})\s*;", 1), schema)


def strict_json(text: str):
    """JSON without repeated keys, NaN or infinity."""

    def pairs(items):
        found = dict(items)
        if len(found) != len(items):
            raise ValueError("repeated key")
        return found

    def constant(name):
        raise ValueError(f"{name} is not JSON")

    value = json.loads(text, object_pairs_hook=pairs, parse_constant=constant)
    stack = [value]
    while stack:
        x = stack.pop()
        if isinstance(x, float) and not math.isfinite(x):
            raise ValueError("number out of range")
        stack += list(x.values()) if isinstance(x, dict) else x if isinstance(x, list) else []
    return value


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


# --- file formats that Spark does not read -----------------------------------------------------------------------------
class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    """One task per file; paths are a folder, a pattern or a file on a file system that every executor mounts."""

    suffix, rows = "", None

    def __init__(self, options: dict, schema: StructType):
        self.options, self.names = dict(options), schema.fieldNames()

    def partitions(self) -> list[_File]:
        p = Path(self.options["path"])
        return [_File(str(x)) for x in sorted(p.glob(f"*{self.suffix}") if p.is_dir() else p.parent.glob(p.name))]

    def read(self, part: _File) -> Iterator[tuple]:
        for row in type(self).rows(part.path, self.options):
            yield tuple(row.get(n) for n in self.names)


def _gpkg_rows(path: str, options: dict) -> Iterator[dict]:
    """Rows of a layer; `geometry` is well-known binary without the package's own header."""
    db = sqlite3.connect(f"file:{path}?mode=ro", uri=True)
    try:
        layer = options.get("layer") or db.execute("SELECT table_name FROM gpkg_contents WHERE data_type = 'features' ORDER BY 1").fetchone()[0]
        column = db.execute("SELECT column_name FROM gpkg_geometry_columns WHERE table_name = ?", (layer,)).fetchone()[0]
        quoted = layer.replace('"', '""')
        cursor = db.execute(f'SELECT * FROM "{quoted}"')  # noqa: S608
        names = [d[0] for d in cursor.description]
        for values in cursor:
            row = dict(zip(names, values))
            raw = row.pop(column)
            if raw is not None:
                if raw[:2] != b"GP":
                    raise ValueError("not a GeoPackage geometry")
                row["geometry"] = None if raw[3] & 0x10 else raw[8 + (0, 32, 48, 48, 64)[(raw[3] >> 1) & 7] :]
            yield row
    finally:
        db.close()


def _shape_rows(path: str, options: dict) -> Iterator[dict]:
    """Rows of a shapefile and its table; `geometry` is well-known binary (points, lines, polygons)."""
    from talweg.functions.geometry import encode_wkb, ring_area

    shp, dbf = Path(path).read_bytes(), Path(path).with_suffix(".dbf").read_bytes()
    (count,), (head, size) = struct.unpack_from("<I", dbf, 4), struct.unpack_from("<HH", dbf, 8)
    fields, at = [], 32
    while dbf[at] != 0x0D:
        fields.append((dbf[at : at + 11].split(b"\0")[0].decode(), chr(dbf[at + 11]), dbf[at + 16], dbf[at + 17]))
        at += 32
    at = 100
    for i in range(count):
        (words,) = struct.unpack_from(">I", shp, at + 4)
        body, at = shp[at + 8 : at + 8 + 2 * words], at + 8 + 2 * words
        row, place = {}, head + i * size + 1
        for name, kind, n, digits in fields:
            text = dbf[place : place + n].decode(options.get("encoding", "utf-8"), "replace").strip().strip("\0")
            place += n
            row[name] = (None if not text or set(text) == {"*"} else float(text) if digits or "e" in text.lower() else int(text)) if kind in "NF" else (text or None)
        (kind,) = struct.unpack_from("<I", body)
        if kind % 10 == 1:
            row["geometry"] = encode_wkb("Point", struct.unpack_from("<2d", body, 4))
        elif kind % 10 in (3, 5):
            n_parts, n_points = struct.unpack_from("<II", body, 36)
            starts = [*struct.unpack_from(f"<{n_parts}I", body, 44), n_points]
            flat = struct.unpack_from(f"<{2 * n_points}d", body, 44 + 4 * n_parts)
            parts = [[flat[2 * k : 2 * k + 2] for k in range(a, b)] for a, b in zip(starts, starts[1:])]
            if kind % 10 == 3:
                row["geometry"] = encode_wkb("MultiLineString", parts)
            else:
                polygons: list = []
                for ring in parts:  # shells run clockwise, holes follow their shell
                    if ring_area(ring) <= 0 or not polygons:
                        polygons.append([ring])
                    else:
                        polygons[-1].append(ring)
                row["geometry"] = encode_wkb("MultiPolygon", polygons)
        yield row


class GeoPackage(DataSource):
    """spark.read.format("geopackage").schema(...).load(path): option layer."""

    @classmethod
    def name(cls) -> str:
        return "geopackage"

    def reader(self, schema: StructType) -> DataSourceReader:
        return type("R", (_Reader,), {"suffix": ".gpkg", "rows": staticmethod(_gpkg_rows)})(self.options, schema)


class Shapefile(DataSource):
    """spark.read.format("shapefile").schema(...).load(path): option encoding."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def reader(self, schema: StructType) -> DataSourceReader:
        return type("R", (_Reader,), {"suffix": ".shp", "rows": staticmethod(_shape_rows)})(self.options, schema)


def register(spark: SparkSession) -> None:
    for source in (GeoPackage, Shapefile):
        spark.dataSource.register(source)
