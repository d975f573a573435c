"""Sinks: whole-table writes that appear at once, GeoJSON, manifests, reports, and staged publication."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Parquet (snappy) or CSV with a header, by Spark's commit protocol: readers see all of it or nothing."""
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.option("compression", "snappy").parquet(path)


def write_file(path: str, data: bytes) -> None:
    """A driver-side file, replaced in one step."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    handle, temporary = tempfile.mkstemp(dir=target.parent, prefix=f".{target.name}.")
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(data)
        os.replace(temporary, target)
    except BaseException:
        Path(temporary).unlink(missing_ok=True)
        raise


def write_single_csv(df: DataFrame, path: str) -> None:
    """A published table of bounded size as one CSV file."""
    write_file(path, df.toPandas().to_csv(index=False).encode())


def rounded_point(lon: Column, lat: Column, digits: int = 5) -> Column:
    return F.array(F.round(lon, digits), F.round(lat, digits))


def rounded_rings(rings: Column, digits: int = 5) -> Column:
    return F.transform(rings, lambda r: F.transform(r, lambda p: F.array(F.round(p["x"], digits), F.round(p["y"], digits))))


def features(df: DataFrame, kind: str, coordinates: Column, properties: list[str]) -> DataFrame:
    """One GeoJSON feature per row, as text; null coordinates give a null geometry."""
    geometry = F.when(coordinates.isNotNull(), F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")))
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), geometry.alias("geometry")), {"ignoreNullFields": "false"}).alias("value"))


def write_geojson_lines(feature_rows: DataFrame, path: str) -> None:
    """Newline-delimited features, one file per task: for any number of rows."""
    feature_rows.write.mode("overwrite").text(path)


def write_geojson(feature_rows: DataFrame, path: str) -> int:
    """One FeatureCollection, for layers of bounded size; rows pass through the driver one by one."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    handle, temporary = tempfile.mkstemp(dir=target.parent, prefix=f".{target.name}.")
    n = 0
    with os.fdopen(handle, "w") as f:
        f.write('{"type":"FeatureCollection","features":[')
        for row in feature_rows.toLocalIterator():
            f.write(("," if n else "") + row[0])
            n += 1
        f.write("]}")
    os.replace(temporary, target)
    return n


def file_hash(path: str) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        for block in iter(lambda: f.read(1 << 20), b""):
            digest.update(block)
    return digest.hexdigest()


def file_hashes(spark, pattern: str) -> DataFrame:
    """(path, sha256) of files, hashed by the executors."""
    return spark.read.format("binaryFile").load(pattern).select("path", F.sha2("content", 256).alias("sha256"))


def write_manifest(path: str, manifest: dict) -> None:
    write_file(path, (json.dumps(manifest, sort_keys=True, indent=2, allow_nan=False) + "\n").encode())


def write_report(report: DataFrame, path: str) -> dict[str, int]:
    """A Markdown table of checks, counts first; returns the counts."""
    rows = report.orderBy("dataset", "check_name").collect()  # a row per check
    counts = {s: sum(r["status"] == s for r in rows) for s in ("PASS", "WARN", "FAIL")}
    lines = ["# Audit", "", ", ".join(f"{k}: {v}" for k, v in counts.items()), "", "| dataset | check | status |", "|-|-|-|"]
    write_file(path, ("\n".join([*lines, *(f"| {r['dataset']} | {r['check_name']} | {r['status']} |" for r in rows)]) + "\n").encode())
    return counts


def promote(stage: str, target: str, backup: str, names: list[str], validate: Callable[[Path], None], manifest: str = "manifest.json") -> None:
    """Publishes staged files: validated, old ones backed up, copies checked by hash, the manifest last; on any failure the old ones return."""
    source, goal, saved = Path(stage), Path(target), Path(backup)
    if len({source.resolve(), goal.resolve(), saved.resolve()}) < 3 or any(Path(n).is_absolute() or ".." in Path(n).parts for n in [*names, manifest]):
        raise ValueError("stage, target and backup must be different folders, and names must stay inside them")
    validate(source)
    saved.mkdir(parents=True)
    order = [*[n for n in names if n != manifest], manifest]
    before = {n for n in order if (goal / n).exists()}
    for n in before:
        (saved / n).parent.mkdir(parents=True, exist_ok=True)
        shutil.copy2(goal / n, saved / n)
    try:
        for n in order:
            write_file(str(goal / n), (source / n).read_bytes())
            if file_hash(str(goal / n)) != file_hash(str(source / n)):
                raise OSError(f"{n} was not copied whole")
    except BaseException:
        for n in order:
            if n in before:
                write_file(str(goal / n), (saved / n).read_bytes())
            else:
                (goal / n).unlink(missing_ok=True)
        raise


def choropleth_html(title: str, geojson: str, value: str, colours: list[str], bounds: list[float]) -> str:
    """A page that draws a GeoJSON layer by classes of a value."""
    data = json.dumps({"bounds": bounds, "colours": colours, "value": value})
    safe = title.replace("&", "&amp;").replace("<", "&lt;")
    return (
        f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{safe}</title></head><body><h1>{safe}</h1><svg id='map' width='800' height='800'></svg>"
        f"<script>const layer={geojson.replace('</', '<\\/')};const style={data};"
        "const pts=[];const walk=c=>typeof c[0]==='number'?pts.push(c):c.forEach(walk);layer.features.forEach(f=>f.geometry&&walk(f.geometry.coordinates));"
        "const xs=pts.map(p=>p[0]),ys=pts.map(p=>p[1]),x0=Math.min(...xs),y1=Math.max(...ys),k=780/Math.max(Math.max(...xs)-x0,y1-Math.min(...ys),1e-9);"
        "const svg=document.getElementById('map');const draw=(r,v)=>{const p=document.createElementNS('http://www.w3.org/2000/svg','polygon');"
        "p.setAttribute('points',r.map(q=>[(q[0]-x0)*k+10,(y1-q[1])*k+10]).join(' '));let i=style.bounds.findIndex(b=>v<=b);p.setAttribute('fill',v==null?'#ccc':style.colours[i<0?style.bounds.length:i]);svg.appendChild(p)};"
        "layer.features.forEach(f=>{if(!f.geometry)return;const v=f.properties[style.value],g=f.geometry;(g.type==='Polygon'?[g.coordinates]:g.coordinates).forEach(p=>draw(p[0],v))});</script></body></html>"
    )
