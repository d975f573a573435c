"""The road graph: building it from lines, bridges, components, fastest paths and what is reached."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from talweg.functions.geo import planar_m, snap
from talweg.operators.spatial import cell, self_pairs
from talweg.operators.stages import cut, numbered

# Speeds in km/h by road class, bridge speed and reach, snapping grid.
SPEEDS = {"motorway": 90.0, "trunk": 70.0, "primary": 55.0}
OTHER_SPEED, BRIDGE_SPEED, BRIDGE_M, GRID_M = 50.0, 35.0, 350.0, 15.0
#: Components of fewer nodes do not carry catchments.
COMPONENT_FLOOR = 1000
#: Edges up to which a graph is shipped whole to every task that gives the nodes of paths.
SHIPPED_EDGES = 20_000_000


def speed(road: Column) -> Column:
    out = F.lit(OTHER_SPEED)
    for name, value in SPEEDS.items():
        out = F.when(road == name, value).otherwise(out)
    return out


def vertices(lines: DataFrame, grid: float = GRID_M) -> DataFrame:
    """lines (line, road, points array<struct<x,y>>) as rows (line, road, pos, x, y), snapped to the grid."""
    rows = lines.select("line", "road", F.posexplode("points").alias("pos", "p"))
    return rows.select("line", "road", "pos", snap(F.col("p.x"), grid).alias("x"), snap(F.col("p.y"), grid).alias("y"))


def build_graph(lines: DataFrame, grid: float = GRID_M) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges): nodes (node, x, y) numbered from 0 in the order a line's two ends, then its other vertices are first met;
    edges (u, v, km, hours, is_bridge), u < v, the fastest of parallel ones; vertices that snap together make no edge.
    """
    points = vertices(lines, grid)
    last = F.max("pos").over(Window.partitionBy("line"))
    met = points.withColumn("turn", F.when(F.col("pos") == 0, 0).when(F.col("pos") == last, 1).otherwise(F.col("pos") + 1))
    first = met.groupBy("x", "y").agg(F.min(F.struct("line", "turn")).alias("met"))
    nodes = cut(numbered(first, "met", "node").select("node", "x", "y"))
    step = Window.partitionBy("line").orderBy("pos")
    pieces = points.withColumns({"nx": F.lead("x").over(step), "ny": F.lead("y").over(step)}).filter("nx IS NOT NULL AND NOT (x = nx AND y = ny)")
    a = nodes.select(F.col("node").alias("a"), "x", "y")
    b = nodes.select(F.col("node").alias("b"), F.col("x").alias("nx"), F.col("y").alias("ny"))
    km = planar_m(F.col("x"), F.col("y"), F.col("nx"), F.col("ny")) / 1000
    edges = pieces.join(a, ["x", "y"]).join(b, ["nx", "ny"]).select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"), km.alias("km"), (km / speed(F.col("road"))).alias("hours"))
    return nodes, edges.groupBy("u", "v").agg(F.min("hours").alias("hours"), F.min_by("km", "hours").alias("km")).select("u", "v", "km", "hours", F.lit(False).alias("is_bridge"))


def add_bridges(lines: DataFrame, nodes: DataFrame, edges: DataFrame, reach: float = BRIDGE_M, grid: float = GRID_M) -> DataFrame:
    """edges with bridges between line ends within reach that no edge joins."""
    points = vertices(lines, grid)
    last = F.max("pos").over(Window.partitionBy("line"))
    ends = points.withColumn("last", last).filter("pos = 0 OR pos = last").select("x", "y").distinct().join(nodes, ["x", "y"])
    pairs = self_pairs(ends, "node", reach).join(edges.select(F.col("u").alias("a"), F.col("v").alias("b")), ["a", "b"], "left_anti")
    km = F.col("dist_m") / 1000
    return edges.unionByName(pairs.select(F.col("a").alias("u"), F.col("b").alias("v"), km.alias("km"), (km / BRIDGE_SPEED).alias("hours"), F.lit(True).alias("is_bridge")))


#: Links of a block whose components one task finds.
BLOCK_LINKS = 500_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The components of the links (u, v) of one task, as (node, root): root is the smallest node of its component."""
    held = [x for x in batches if x.num_rows]
    if not held:
        return
    links = pa.Table.from_batches(held)
    names = pc.unique(pa.chunked_array([*links["u"].chunks, *links["v"].chunks]))
    names = names.take(pc.array_sort_indices(names))
    a, b = (pc.index_in(links[x].combine_chunks(), value_set=names).to_numpy() for x in ("u", "v"))
    root = np.arange(len(names))
    while len(a):
        a, b = root[a], root[b]
        low, high = np.minimum(a, b), np.maximum(a, b)
        a, b = low[low != high], high[low != high]
        np.minimum.at(root, b, a)
        while (root[root] != root).any():
            root = root[root]
    yield pa.record_batch({"node": names, "root": names.take(pa.array(root))})


def _starred(pairs: DataFrame) -> DataFrame:
    """(node, component) of the nodes of pairs (u > v). Star contraction; each round is cut off."""
    before = None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = cut(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        now = pairs.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == before:
            break
        before = now
    ends = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.union(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _labels(pairs: DataFrame) -> DataFrame:
    """(node, component) of the nodes of pairs (u > v).

    Links are dealt by node into blocks of bounded size, each contracted by one task; then only the roots of blocks that
    share a node are linked, and these links are contracted likewise. Any blocks give the same result. Where neighbours
    have no near numbers, blocks take little away: links that do not halve are left to the star contraction.
    """
    n = pairs.count()
    kind = dict(pairs.dtypes)["u"]
    roots = cut(pairs.repartitionByRange(max(1, math.ceil(n / BLOCK_LINKS)), "v", "u").mapInArrow(_contract, f"node {kind}, root {kind}"))
    own = cut(roots.groupBy("node").agg(F.min("root").alias("component"), F.max("root").alias("most")))
    shared = own.filter("component <> most").select("node", "component")
    links = cut(roots.join(shared, "node").filter("root <> component").select(F.col("root").alias("u"), F.col("component").alias("v")).distinct())
    own, left = own.select("node", "component"), links.count()
    if not left:
        return own
    moved = (_labels if 2 * left <= n else _starred)(links).filter("node <> component").select(F.col("node").alias("component"), F.col("component").alias("to"))
    moved = F.broadcast(moved) if left <= FEW else moved
    return own.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))


def components(nodes: DataFrame, edges: DataFrame, node: str = "node") -> DataFrame:
    """(node, component): component is the smallest node that can be reached."""
    labels = _labels(cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v")))
    ids = nodes.select(F.col(node).alias("node"))
    return ids.join(labels, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def clusters(points: DataFrame, key: str, radius: float) -> DataFrame:
    """(node, component) of points (key, x, y) that are within the radius of each other, linked on: the smallest key that can be reached.

    Points in one narrow cell are all within the radius, so cells are linked, not points: two cells by any two of their
    places that are near enough. Copies at a place count once. Points without a place are alone.
    """
    size = 0.7 * radius  # the diagonal of a cell is below the radius
    finite = lambda c: F.col(c).isNotNull() & (F.abs(c) < float("inf"))
    slim = points.select(F.col(key).alias("node"), "x", "y")
    placed = slim.filter(finite("x") & finite("y")).select("node", "x", "y", *cell(F.col("x"), F.col("y"), size))
    places = cut(placed.groupBy("cx", "cy", "x", "y").agg(F.min("node").alias("node")))
    heads = cut(places.groupBy("cx", "cy").agg(F.min("node").alias("head")))
    here = places.select("cx", "cy", "x", "y")
    steps = F.array(*[F.struct(F.lit(i).cast("long").alias("i"), F.lit(j).cast("long").alias("j")) for i in range(3) for j in range(-2, 3) if (i, j) > (0, 0)])
    there = here.select(F.col("cx").alias("ox"), F.col("cy").alias("oy"), F.col("x").alias("rx"), F.col("y").alias("ry"), F.explode(steps).alias("s")).withColumns({"cx": F.col("ox") + F.col("s.i"), "cy": F.col("oy") + F.col("s.j")}).drop("s")
    met = here.join(there, ["cx", "cy"]).filter(planar_m(F.col("rx"), F.col("ry"), F.col("x"), F.col("y")) <= radius).select("cx", "cy", "ox", "oy").distinct()
    links = met.join(heads, ["cx", "cy"]).join(heads.select(F.col("cx").alias("ox"), F.col("cy").alias("oy"), F.col("head").alias("other")), ["ox", "oy"])
    labels = components(heads.select(F.col("head").alias("node")), links.select(F.col("head").alias("u"), F.col("other").alias("v")))
    named = heads.join(labels, F.col("head") == F.col("node")).select("cx", "cy", "component")
    alone = slim.filter(~(F.coalesce(finite("x"), F.lit(False)) & F.coalesce(finite("y"), F.lit(False))))
    return placed.join(named, ["cx", "cy"]).select("node", "component").unionByName(alone.select("node", F.col("node").alias("component")))


def component_sizes(labels: DataFrame) -> DataFrame:
    return labels.groupBy("component").agg(F.count("*").alias("size"))


def main_component(labels: DataFrame) -> DataFrame:
    """The largest component; of equal ones that with the smallest label."""
    return component_sizes(labels).orderBy(F.desc("size"), "component").limit(1)


def snap_candidates(points: DataFrame, nodes: DataFrame, labels: DataFrame, radius: float) -> DataFrame:
    """(point columns, component, node, dist_m): the nearest node of each component within the radius, inclusive; ties to the smaller node."""
    from talweg.operators.spatial import radius_join

    near = radius_join(points, nodes.join(labels, "node"), radius)
    keys = [c for c in points.columns]
    return near.groupBy(*keys, F.col("r_component").alias("component")).agg(F.min(F.struct("dist_m", F.col("r_node").alias("node"))).alias("s")).select(*keys, "component", F.col("s.node").alias("node"), F.col("s.dist_m").alias("dist_m"))


#: Origins (or hubs) in a block: a task forms the pairs of two blocks, so many rows at a time.
BLOCK_PLACES, BATCH_PAIRS = 4096, 500_000


def compatible_pairs(origins: DataFrame, hubs: DataFrame) -> DataFrame:
    """(origin, hub, component, u, v, origin_m, hub_m): of the components both can snap to, that with the smallest sum of feeders; ties by nodes, then label.

    There is a row for nearly every origin and hub. A block of origins meets every block of hubs, with all candidates of
    either, so that a pair is decided where it is formed and no pairs are shuffled; blocks grow in number, not in size.
    """
    names = ["origin", "hub", "component", "u", "v", "origin_m", "hub_m"]
    types = dict(origins.dtypes) | {"u": dict(origins.dtypes)["node"], "v": dict(hubs.dtypes)["node"], "hub": dict(hubs.dtypes)["hub"], "origin_m": "double", "hub_m": "double"}

    def blocks(df: DataFrame, key: str, out: str) -> DataFrame:
        slim = cut(df.select(F.col(key).alias("id"), "component", "node", F.col("dist_m").cast("double").alias("m")))
        n, tasks = slim.select("id").distinct().count(), slim.sparkSession.sparkContext.defaultParallelism
        size = max(1, min(BLOCK_PLACES, math.ceil(n / math.sqrt(tasks))))
        count = max(1, math.ceil(n / size))
        return cut(slim.groupBy(F.pmod(F.xxhash64("id"), F.lit(count)).alias("block")).agg(F.collect_list(F.struct("id", "component", "node", "m")).alias(out)).repartitionByRange(count, "block").select(out))

    def places(rows: pa.ListScalar):
        fields = [rows.values.field(f).to_numpy(zero_copy_only=False) for f in ("id", "component", "node", "m")]
        ids, at = np.unique(fields[0], return_inverse=True)
        return ids, at, *fields[1:]

    def pairs(batches):
        for batch in batches:
            for left, right in zip(batch.column(0), batch.column(1)):
                (o, oi, oc, ou, om), (h, hi, hc, hv, hm) = places(left), places(right)
                shared, step = np.intersect1d(oc, hc), max(1, BATCH_PAIRS // len(h))
                for at in range(0, len(o), step):
                    n = min(step, len(o) - at)
                    total = np.full((n, len(h)), np.inf)
                    a_row, b_row = np.full((n, len(h)), -1), np.full((n, len(h)), -1)
                    for c in shared:  # in their order, so that of full ties the smaller label stays
                        b = np.flatnonzero(hc == c)
                        for a in np.flatnonzero((oc == c) & (oi >= at) & (oi < at + n)):
                            # several candidates of one hub in a component come one layer after another
                            order = b[np.argsort(hi[b], kind="stable")]
                            layer = np.arange(len(order)) - np.searchsorted(hi[order], hi[order])
                            for k in range(layer.max() + 1):
                                b_k = order[layer == k]
                                i, j, s = oi[a] - at, hi[b_k], om[a] + hm[b_k]
                                was, tied = total[i, j], a_row[i, j]
                                better = (s < was) | ((s == was) & ((tied < 0) | (ou[a] < ou[tied]) | ((ou[a] == ou[tied]) & (hv[b_k] < hv[b_row[i, j]]))))
                                total[i, j[better]], a_row[i, j[better]], b_row[i, j[better]] = s[better], a, b_k[better]
                    i, j = np.nonzero(a_row >= 0)
                    a, b = a_row[i, j], b_row[i, j]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (o[i + at], h[j], oc[a], ou[a], hv[b], om[a], hm[b])], names)

    met = blocks(origins, "origin", "a").crossJoin(blocks(hubs, "hub", "b").hint("shuffle_replicate_nl"))
    return met.mapInArrow(pairs, ", ".join(f"{c} {types[c]}" for c in names))


class Csr:
    """An undirected graph as arrays: neighbours of node i are at start[i]:start[i + 1]."""

    def __init__(self, u, v, hours, km, bridge):
        names = np.unique(np.concatenate([u, v]))
        a, b = np.searchsorted(names, u), np.searchsorted(names, v)
        src, dst = np.concatenate([a, b]), np.concatenate([b, a])
        order = np.lexsort((dst, src))
        self.names, self.dst = names, dst[order].astype(np.int32)
        self.hours, self.km, self.bridge = (np.concatenate([x, x])[order] for x in (hours, km, bridge))
        self.start = np.searchsorted(src[order], np.arange(len(names) + 1))

    def arrays(self) -> tuple:
        return self.names, self.start, self.dst, self.hours, self.km, self.bridge


def dijkstra(arrays: tuple, source: int, targets: set[int] | None = None, limit: float = float("inf")) -> tuple[dict[int, float], dict[int, tuple[int, int]]]:
    """Hours from the source by node, and (node before, edge) on the fastest path. Stops when all targets are settled, or beyond the limit."""
    names, start, dst, hours, _, _ = arrays
    at = int(np.searchsorted(names, source))
    if at == len(names) or names[at] != source:
        return {}, {}
    done, before, best = {}, {}, {at: 0.0}
    heap, left = [(0.0, at)], None if targets is None else set(targets)
    while heap:
        d, i = heapq.heappop(heap)
        if i in done or d > limit:
            continue
        done[i] = d
        if left is not None:
            left.discard(i)
            if not left:
                break
        for e in range(start[i], start[i + 1]):
            j = int(dst[e])
            nd = d + float(hours[e])
            if j not in done and nd <= limit and (j not in best or nd < best[j] or (nd == best[j] and i < before[j][0])):
                best[j], before[j] = nd, (i, e)
                heapq.heappush(heap, (nd, j))
    return done, before


def _shipped(edges: DataFrame):
    """The graph as a broadcast of bounded size; larger graphs are searched block by block, without the nodes of paths."""
    n = edges.count()
    if n > SHIPPED_EDGES:
        raise ValueError(f"{n} edges are too many to ship; ask without nodes")
    e = edges.select("u", "v", "hours", "km", "is_bridge").toPandas()
    return edges.sparkSession.sparkContext.broadcast(Csr(e.u.to_numpy(), e.v.to_numpy(), e.hours.to_numpy(float), e.km.to_numpy(float), e.is_bridge.to_numpy(bool)).arrays())


PATHS = "u long, v long, hours double, km double, bridges long, bridge_km double, max_bridge_m double, steps long, nodes array<long>"


#: Nodes of a block when a graph is searched block by block; slots that the sources are dealt to; messages that may be broadcast.
BLOCK_NODES, SLOTS, FEW = 150_000, 8, 500_000
_SUMS = "km double, bridges long, bridge_km double, longest double, steps long"
_ZERO = (0.0, 0, 0.0, 0.0, 0)


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    """The arcs of a block as one row: those inside as arrays by node, those to other blocks by their ends."""
    here = int(pdf["block"].iloc[0])
    pdf = pdf.sort_values(["x", "y", "h", "km"], kind="stable").drop_duplicates(["x", "y"])
    names = np.unique(pdf["x"].to_numpy())
    inside, across = pdf[pdf["to"] == here], pdf[pdf["to"] != here]
    src = np.searchsorted(names, inside["x"].to_numpy())
    arrays = {"names": names, "start": np.searchsorted(src, np.arange(len(names) + 1)), "dst": np.searchsorted(names, inside["y"].to_numpy()), "h": inside["h"].to_numpy(), "km": inside["km"].to_numpy(), "br": inside["br"].to_numpy()}
    arrays |= {"ax": np.searchsorted(names, across["x"].to_numpy()), "ay": across["y"].to_numpy(), "ato": across["to"].to_numpy(), "ah": across["h"].to_numpy(), "akm": across["km"].to_numpy(), "abr": across["br"].to_numpy()}
    return pd.DataFrame({"block": [here]} | {k: [np.ascontiguousarray(v, _PACKED[k]).tobytes()] for k, v in arrays.items()})


_PACKED = {"names": "i8", "start": "i8", "dst": "i4", "h": "f8", "km": "f8", "br": "?", "ax": "i8", "ay": "i8", "ato": "i8", "ah": "f8", "akm": "f8", "abr": "?"}


def _added(sums: tuple, km: float, bridge: bool) -> tuple:
    x, n, b, most, steps = sums
    return (x + km, n + 1, b + km, max(most, km), steps + 1) if bridge else (x + km, n, b, most, steps + 1)


def _settle(names: list, start: list, dst: list, h: list, km: list, br: list, seeds: list, limit: float, summed: bool) -> tuple[list, dict, dict]:
    """(nodes in the order they are settled, hours, sums) of a block, from seeds (node, hours, node before, whether the last edge took time, sums).

    Of equally fast ways the one over the smallest node before counts. An edge that adds no time yields to one that does;
    of several such the one of fewest steps counts, so that sums can't run in circles.
    """
    best, via, done, order, heap = {}, {}, set(), [], []
    for at, d, before, took, sums in seeds:
        rank = (0, before) if took else (1, sums[4], before)
        if at not in best or d < best[at] or (d == best[at] and rank < via[at][0]):
            best[at], via[at] = d, (rank, -1, sums)
            heapq.heappush(heap, (d, 0 if took else sums[4], at))  # of equal hours what took time comes first, then fewer steps
    total = {}
    while heap:
        d, _, i = heapq.heappop(heap)
        if i in done:
            continue
        done.add(i)
        order.append(i)
        if summed:
            _, e, back = via.pop(i)
            total[i] = back if e < 0 else _added(total[back], km[e], br[e])
        for e in range(start[i], start[i + 1]):
            j = dst[e]
            if j in done:
                continue
            nd, old = d + h[e], best.get(j)
            if nd > limit:
                continue
            if old is not None and (nd > old or (nd == old and not summed)):
                continue
            if not summed:
                heapq.heappush(heap, (nd, 0, j))
            else:
                rank = (0, names[i]) if nd > d else (1, total[i][4] + 1, names[i])
                if nd == old and rank >= via[j][0]:
                    continue
                if old is None or nd < old or rank[0]:
                    heapq.heappush(heap, (nd, rank[1] if rank[0] else 0, j))
                elif via[j][0][0]:
                    heapq.heappush(heap, (nd, 0, j))
                via[j] = (rank, e, i)
            best[j] = nd
    return order, best, total


def _searched(edges: DataFrame, sources: DataFrame, limit: float = float("inf"), summed: bool = False) -> DataFrame:
    """(u, node, hours, km, bridges, bridge_km, longest, steps) of the nodes within the limit of each source; sums only if asked for.

    For graphs of any size. Nodes are dealt by number into blocks of bounded size, each of which one task searches from
    what its neighbours know; only nodes with edges to other blocks are exchanged, until none gets faster. Any blocks give
    the same result; rounds are few where neighbours have near numbers, as a path then changes blocks seldom.
    """
    has = lambda c, other: F.col(c) if c in edges.columns else F.lit(other)
    e = edges.select("u", "v", F.col("hours").cast("double").alias("h"), has("km", 0.0).cast("double").alias("km"), has("is_bridge", False).alias("br")).filter("h IS NOT NULL AND NOT isnan(h)")
    arcs = cut(e.select(F.col("u").alias("x"), F.col("v").alias("y"), "h", "km", "br").union(e.select(F.col("v").alias("x"), F.col("u").alias("y"), "h", "km", "br")))
    if not arcs.filter("h < 0").isEmpty():
        raise ValueError("negative hours")
    nodes = arcs.select("x").distinct()
    count = max(1, math.ceil(nodes.count() / BLOCK_NODES))
    bounds = sorted(set(nodes.approxQuantile("x", [i / count for i in range(1, count)], 0.02 / count))) if count > 1 else []
    block = lambda c: F.size(F.filter(F.array(*[F.lit(int(b)) for b in bounds]).cast("array<bigint>"), lambda b: b <= F.col(c))).cast("long")
    packed = arcs.withColumns({"block": block("x"), "to": block("y")}).groupBy("block").applyInPandas(_pack, "block long, " + ", ".join(f"{k} binary" for k in _PACKED))
    packed = cut(packed)
    sources = cut(sources.select(F.col("u").cast("long").alias("u")).distinct())
    told = [r.u for r in sources.limit(SLOTS + 1).collect()]
    slot = F.array_position(F.array(*[F.lit(u) for u in told]), F.col("u")) if 0 < len(told) <= SLOTS else F.pmod(F.xxhash64("u"), F.lit(SLOTS))
    tasks = 2 * edges.sparkSession.sparkContext.defaultParallelism

    columns = ["u", "slot", "block", "node", "before", "hours", "took", *[c.split()[0] for c in _SUMS.split(", ")]]

    def run(last: bool):
        def search(batches):
            for pdf in batches:
                for row in pdf.itertuples():
                    a = {k: np.frombuffer(getattr(row, k), t) for k, t in _PACKED.items()}
                    parts, by_source = [a[k].tolist() for k in ("names", "start", "dst", "h", "km", "br")], {}
                    for s in row.seeds:
                        i = int(np.searchsorted(a["names"], s["node"]))
                        if i < len(a["names"]) and a["names"][i] == s["node"]:
                            by_source.setdefault(s["u"], []).append((i, s["hours"], s["before"], s["took"], (s["km"], s["bridges"], s["bridge_km"], s["longest"], s["steps"])))
                    for u, seeds in by_source.items():
                        order, best, total = _settle(*parts, seeds, limit, summed)
                        if last:
                            at = np.array(order, "i8")
                            sums = zip(*[total[i] for i in order]) if summed else [[0.0], [0], [0.0], [0.0], [0]]
                            out = {"u": u, "node": a["names"][at], "hours": [best[i] for i in order]}
                            out |= {k: np.array(x, "f8" if k in ("km", "bridge_km", "longest") else "i8") if summed else x[0] for k, x in zip(("km", "bridges", "bridge_km", "longest", "steps"), sums)}
                            yield pd.DataFrame(out)
                            continue
                        rows = []
                        for i, y, to, h, km, br in zip(*[a[k].tolist() for k in ("ax", "ay", "ato", "ah", "akm", "abr")]):
                            if i in best and best[i] + h <= limit:
                                rows.append((u, int(row.slot), to, y, parts[0][i], best[i] + h, best[i] + h > best[i], *(_added(total[i], km, br) if summed else _ZERO)))
                        yield pd.DataFrame(rows, columns=columns)

        return search

    messages = cut(sources.select("u", slot.cast("long").alias("slot"), block("u").alias("block"), F.col("u").alias("node"), F.lit(None).cast("long").alias("before"), F.lit(0.0).alias("hours"), F.lit(True).alias("took"), *[F.lit(z).alias(c.split()[0]) for z, c in zip((0.0, 0, 0.0, 0.0, 0), _SUMS.split(", "))]).select("u", "slot", "block", "node", "before", "hours", "took", *[F.col(c.split()[0]).cast(c.split()[1]) for c in _SUMS.split(", ")]))
    kinds = ", ".join(f"{c} {t}" for c, t in messages.dtypes)
    seeds = lambda df, n: (F.broadcast if n <= FEW else lambda x: x)(df.withColumn("before", F.coalesce("before", F.lit(-(2**63)))).groupBy("block", "slot").agg(F.collect_list(F.struct("u", "node", "before", "hours", "took", "km", "bridges", "bridge_km", "longest", "steps")).alias("seeds")))
    changed, known = messages, sources.count()
    while count > 1:
        active = changed.select("u", "block").distinct()
        todo = messages.join(active, ["u", "block"], "left_semi")
        sent = cut(packed.join(seeds(todo, known), "block").repartition(tasks, "block", "slot").mapInPandas(run(False), kinds))
        old = messages.select("u", "node", "before", *[F.col(c).alias(f"old_{c}") for c in ("hours", "took", "km", "bridges", "bridge_km", "longest", "steps")])
        same = F.lit(True)
        for c in ("hours", "took", "km", "bridges", "bridge_km", "longest", "steps"):
            same = same & F.col(c).eqNullSafe(F.col(f"old_{c}"))
        changed = cut(sent.join(old, ["u", "node", "before"], "left").filter(~same).select(*messages.columns))
        if changed.isEmpty():
            break
        messages = cut(messages.join(changed, ["u", "node", "before"], "left_anti").select(*messages.columns).unionByName(changed))
        known = messages.count()
    found = packed.join(seeds(messages, known), "block").repartition(tasks, "block", "slot").mapInPandas(run(True), f"u long, node long, hours double, {_SUMS}")
    start = sources.select("u", F.col("u").alias("node"), F.lit(0.0).alias("hours"), *[F.lit(0).cast(c.split()[1]).alias(c.split()[0]) for c in _SUMS.split(", ")])
    return found.filter("node <> u").unionByName(start)


def fastest_paths(edges: DataFrame, pairs: DataFrame, with_nodes: bool = True) -> DataFrame:
    """PATHS for the pairs (u, v): kilometres and bridges are those of the path of least time. No path: nulls; u = v: zeros.

    Without nodes the graph is searched block by block. With them there is one search per distinct source, over a graph
    that is shipped whole; sources are spread over tasks.
    """
    if not with_nodes:
        found = _searched(edges, pairs.select("u"), summed=True).select("u", F.col("node").alias("v"), "hours", "km", "bridges", "bridge_km", (1000 * F.col("longest")).alias("max_bridge_m"), "steps", F.lit(None).cast("array<long>").alias("nodes"))
        return pairs.select(F.col("u").cast("long"), F.col("v").cast("long")).distinct().join(found, ["u", "v"], "left")
    graph = _shipped(edges)

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        names, _, _, _, km, bridge = arrays = graph.value
        source, rows = int(pdf["u"].iloc[0]), []
        wanted = [int(v) for v in pdf["v"]]
        index = {v: int(np.searchsorted(names, v)) for v in wanted}
        known = {v: i for v, i in index.items() if i < len(names) and names[i] == v}
        hours, before = dijkstra(arrays, source, set(known.values()))
        sums = {}  # km, bridges, their km, the longest and steps, each from the node before: settled earlier
        for i in hours:
            if i not in before:
                sums[i] = (0.0, 0, 0.0, 0.0, 0)
                continue
            j, e = before[i]
            x, n, b, most, steps = sums[j]
            d = float(km[e])
            sums[i] = (x + d, n + 1, b + d, max(most, d), steps + 1) if bridge[e] else (x + d, n, b, most, steps + 1)
        for v in wanted:
            i = known.get(v)
            if v == source:
                rows.append((source, v, 0.0, 0.0, 0, 0.0, 0.0, 0, [source]))
            elif i is None or i not in hours:
                rows.append((source, v, None, None, None, None, None, None, None))
            else:
                path = [i]
                while path[-1] in before:
                    path.append(before[path[-1]][0])
                x, n, b, most, steps = sums[i]
                rows.append((source, v, hours[i], x, n, b, 1000 * most, steps, [int(names[x]) for x in path[::-1]]))
        return pd.DataFrame(rows, columns=["u", "v", "hours", "km", "bridges", "bridge_km", "max_bridge_m", "steps", "nodes"]).astype({"bridges": "Int64", "steps": "Int64"})

    return pairs.select("u", "v").distinct().groupBy("u").applyInPandas(search, PATHS)


def reached(edges: DataFrame, sources: DataFrame, limit: float) -> DataFrame:
    """(u, node, hours) of the nodes within the limit of each source, inclusive."""
    return _searched(edges, sources, limit).select("u", "node", "hours")


def relaxed_hours(edges: DataFrame, sources: DataFrame, rounds: int | None = None) -> DataFrame:
    """(u, node, hours) of all nodes by repeated relaxation, until no path gets faster, for graphs of any size.

    A round relaxes whole blocks of nodes. If `rounds` are given, a round follows one more edge, by DataFrame operations
    only; that they do not suffice is an error. So are negative hours.
    """
    if rounds is None:
        return all_hours(edges, sources)
    both = edges.select("u", "v", "hours").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"), "hours")).withColumnsRenamed({"u": "x", "v": "y", "hours": "h"})
    both = cut(both.filter("h IS NOT NULL AND NOT isnan(h)"))
    if not both.filter("h < 0").isEmpty():
        raise ValueError("negative hours")
    best = cut(sources.select("u", F.col("u").alias("node"), F.lit(0.0).alias("hours")).distinct())
    front, done = best, 0
    while True:
        step = front.join(both, F.col("node") == F.col("x")).groupBy("u", F.col("y").alias("node")).agg(F.min(F.col("hours") + F.col("h")).alias("hours"))
        old = best.select("u", "node", F.col("hours").alias("old"))
        front = cut(step.join(old, ["u", "node"], "left").filter("old IS NULL OR hours < old").select("u", "node", "hours"))
        if front.isEmpty():
            return best
        if done == rounds:
            raise ValueError(f"paths still get faster after {rounds} rounds")
        best, done = cut(best.unionByName(front).groupBy("u", "node").agg(F.min("hours").alias("hours"))), done + 1


def all_hours(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """(u, node, hours) of all nodes."""
    return reached(edges, sources, float("inf"))


def reach_counts(hours: DataFrame, thresholds: list[float], feeder_hours: Column | None = None) -> DataFrame:
    """(u, threshold, nodes): how many nodes are within each threshold, inclusive."""
    values = sorted(set(thresholds))
    if not values or len(values) != len(thresholds) or any(not (0 < t < float("inf")) for t in values):
        raise ValueError("thresholds must be finite, positive and distinct")
    total = F.col("hours") + (F.lit(0.0) if feeder_hours is None else feeder_hours)
    table = hours.groupBy("u").agg(*[F.count_if(total <= t).alias(f"t{i}") for i, t in enumerate(values)])
    return table.select("u", F.explode(F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"t{i}").alias("nodes")) for i, t in enumerate(values)])).alias("s")).select("u", "s.*")


def catchments(points: DataFrame, buffer_m: float = 8000.0, tolerance_m: float = 500.0) -> DataFrame:
    """points (u, x, y) -> (u, ring, area_m2): the convex hull of each catchment, widened and simplified."""
    from talweg.functions.geometry import buffer_convex, convex_hull, ring_area, simplify_ring

    def outline(pdf: pd.DataFrame) -> pd.DataFrame:
        ring = simplify_ring(buffer_convex(convex_hull(pdf[["x", "y"]].to_numpy()), buffer_m), tolerance_m)
        return pd.DataFrame({"u": [int(pdf["u"].iloc[0])], "ring": [[list(p) for p in ring]], "area_m2": [abs(ring_area(ring))]})

    # only a few outer points of each cell row matter for a hull: extremes are kept before the points of a source meet
    band = F.floor(F.col("y") / 1000)
    ends = points.groupBy("u", band.alias("band"), "y").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    slim = ends.select("u", "y", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("x"))
    return slim.groupBy("u").applyInPandas(outline, "u long, ring array<array<double>>, area_m2 double")


def quality_tier(bridges: Column, max_bridge_m: Column, origin_km: Column, target_km: Column, same_node: Column, zero: Column) -> Column:
    """network_exact: no bridge, feeders up to 25 km; modelled_connectivity: bridges up to 350 m, feeders up to 50 km; else low_confidence."""
    exact = (bridges == 0) & (origin_km <= 25) & (target_km <= 25)
    modelled = (max_bridge_m <= BRIDGE_M) & (origin_km <= 50) & (target_km <= 50)
    return F.when(~zero & same_node, "low_confidence").when(exact, "network_exact").when(modelled, "modelled_connectivity").otherwise("low_confidence")


def graph_faults(nodes: DataFrame, edges: DataFrame, labels: DataFrame) -> DataFrame:
    """(fault, n): self-loops, non-positive weights, kilometres that differ from the nodes' distance, long bridges, edges between components, unknown nodes."""
    ends = nodes.select("node", "x", "y").join(labels.select("node", "component"), "node", "full")
    a, b = (ends.select(F.col("node").alias(k), F.col("x").alias(f"{k}x"), F.col("y").alias(f"{k}y"), F.col("component").alias(f"c{k}")) for k in ("u", "v"))
    full = edges.join(a, "u", "left").join(b, "v", "left")
    km = planar_m(F.col("ux"), F.col("uy"), F.col("vx"), F.col("vy")) / 1000
    checks = {
        "self_loop": F.col("u") == F.col("v"),
        "bad_weight": ~((F.col("hours") > 0) & (F.col("km") > 0)),
        "wrong_km": F.abs(F.col("km") - km) > 1e-9,
        "long_bridge": F.col("is_bridge") & (F.col("km") > BRIDGE_M / 1000 + 1e-9),
        "split_component": F.col("cu") != F.col("cv"),
        "unknown_node": F.col("ux").isNull() | F.col("vx").isNull(),
    }
    row = full.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in checks.items()])
    return row.select(F.explode(F.array(*[F.struct(F.lit(k).alias("fault"), F.col(k).alias("n")) for k in checks])).alias("s")).select("s.*")
