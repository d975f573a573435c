"""Spatial joins without an R-tree: both sides are dealt into grid cells, so that each join is an equi-join on the cell.

Every join below shuffles by cell. Cells that many rows share are split by their count or by Spark's skew join; nothing is
broadcast unless Spark finds it small.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from talweg.functions.geo import planar_m, segment_m
from talweg.operators.stages import cut


def cell(x: Column, y: Column, size: float) -> list[Column]:
    return [F.floor(x / size).alias("cx"), F.floor(y / size).alias("cy")]


#: Pairs that a task compares about, and pairs of a cell beyond which it is split.
TASK_PAIRS, CELL_PAIRS = 20_000_000, 2_000_000


def _around(df: DataFrame, size: float, reach: int = 1) -> DataFrame:
    """Each row once for every cell within reach of its own."""
    near = F.array(*[F.struct(F.lit(i).cast("long").alias("i"), F.lit(j).cast("long").alias("j")) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1)])
    cx, cy = cell(F.col("x"), F.col("y"), size)
    return df.withColumn("__n", F.explode(near)).withColumns({"cx": cx + F.col("__n.i"), "cy": cy + F.col("__n.j")}).drop("__n")


def radius_join(left: DataFrame, right: DataFrame, radius: float) -> DataFrame:
    """Pairs (left.*, r.*, dist_m) within the radius, inclusive. Both have x and y; right's columns get the prefix r_."""
    near = _around(left, radius)
    far = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns], *cell(F.col("x"), F.col("y"), radius))
    # the rows that meet in a cell are counted first: tasks are as many as the work asks for, and full cells are split
    met = cut(_around(left.select("x", "y"), radius).groupBy("cx", "cy").agg(F.count("*").alias("n")).join(far.groupBy("cx", "cy").agg(F.count("*").alias("m")), ["cx", "cy"]).filter("cx IS NOT NULL AND cy IS NOT NULL"))
    total = met.agg(F.sum(F.col("n") * F.col("m").cast("double"))).first()[0] or 0.0
    tasks = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / TASK_PAIRS))
    split = met.select("cx", "cy", F.least("n", F.ceil(F.col("n") * F.col("m").cast("double") / CELL_PAIRS)).cast("int").alias("__s")).filter("__s > 1")
    near = near.join(split, ["cx", "cy"], "left").withColumn("__p", F.pmod(F.xxhash64(*left.columns), F.coalesce("__s", F.lit(1))).cast("int")).drop("__s")
    far = far.join(split, ["cx", "cy"], "left").withColumn("__p", F.explode(F.sequence(F.lit(0), F.coalesce("__s", F.lit(1)) - 1))).drop("__s")
    pairs = near.repartition(tasks, "cx", "cy", "__p").join(far, ["cx", "cy", "__p"]).withColumn("dist_m", planar_m(F.col("x"), F.col("y"), F.col("r_x"), F.col("r_y")))
    return pairs.filter(F.col("dist_m") <= radius).drop("cx", "cy", "__p")


def self_pairs(points: DataFrame, key: str, radius: float) -> DataFrame:
    """(a, b, dist_m) of points within the radius, a < b."""
    slim = points.select(F.col(key).alias("id"), "x", "y")
    return radius_join(slim, slim, radius).filter("id < r_id").select(F.col("id").alias("a"), F.col("r_id").alias("b"), "dist_m")


def _placed(c: str = "") -> Column:
    """Whether a row has a place: both coordinates, neither NaN."""
    return F.col(f"{c}x").isNotNull() & ~F.isnan(f"{c}x") & F.col(f"{c}y").isNotNull() & ~F.isnan(f"{c}y")


def nearest(left: DataFrame, right: DataFrame, key: str, order: str, size: float, k: int = 1, by: str | None = None) -> DataFrame:
    """left.* with the k nearest right rows (of each value of `by`): rank, r_ columns and dist_m; ties by `order`.

    A left join: a left row that finds nothing, for want of a place or of right rows, stays once (once for every value of
    `by`) with nulls. Right rows without a place are never found. Left rows are told apart by number, so `key` may repeat;
    it names no part of the search.

    Rings of cells around each left place are searched, twice as wide for places that are not yet settled: one is settled
    when its k-th distance is within the ring. The first cells are no wider than `size`, and narrower where that would
    hold many right rows; copies at one place are searched once. A ring that is wider than all of the right side settles the rest, and none
    wider is tried; only places with fewer than k right rows, or far away from all of them, come so far.
    """
    far = right.filter(_placed()).select(*[F.col(c).alias(f"r_{c}") for c in right.columns])
    # of right rows of one kind at one place only the first k can be found; left rows at one place find the same
    kind_of = [f"r_{by}"] if by else []
    near = far.withColumn("__r", F.row_number().over(Window.partitionBy("r_x", "r_y", *kind_of).orderBy(f"r_{order}"))).filter(F.col("__r") <= k).drop("__r")
    kinds = right.select(F.col(by).alias("__by")).distinct() if by else None  # a value of `by` is a kind of facility: few
    if by:
        kinds = cut(kinds.withColumn("__k", F.row_number().over(Window.orderBy("__by"))))
        near = near.join(F.broadcast(kinds), F.col(f"r_{by}").eqNullSafe(F.col("__by"))).drop("__by")
    else:
        near = near.withColumn("__k", F.lit(1))
    near = cut(near)
    places = left.filter(_placed()).select("x", "y").distinct().withColumn("__id", F.monotonically_increasing_id())
    todo = cut(places.crossJoin(F.broadcast(kinds.select("__k"))) if by else places.withColumn("__k", F.lit(1)))
    keys, found = ["__id", "__k"], None
    window = Window.partitionBy(*keys).orderBy("dist_m", f"r_{order}")
    ends = todo.select("x", "y").union(near.select("r_x", "r_y")).agg(*[f(c) for c in ("x", "y") for f in (F.min, F.max)]).first()
    extent = max(ends[1] - ends[0], ends[3] - ends[2]) if ends[0] is not None else 0.0
    # the first cells hold a few right rows of a kind each, however many there are
    held = near.groupBy("__k", *cell(F.col("r_x"), F.col("r_y"), size)).count().agg(F.avg("count")).first()[0] or 1.0
    width, tasks = size * min(1.0, (3 * k / held) ** 0.5), int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while not todo.isEmpty():
        placed = near.withColumns({"cx": F.floor(F.col("r_x") / width), "cy": F.floor(F.col("r_y") / width)})
        # dealt to a fixed number of tasks: the rows that meet are many more than those that are dealt
        pairs = _around(todo, width).repartition(tasks, "cx", "cy", "__k").join(placed, ["cx", "cy", "__k"]).drop("cx", "cy")
        ranked = pairs.withColumn("dist_m", planar_m(F.col("x"), F.col("y"), F.col("r_x"), F.col("r_y")))
        if width < extent:
            ranked = ranked.filter(F.col("dist_m") <= width)
        ranked = ranked.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
        if width < extent:
            ranked = ranked.withColumn("__full", F.max("rank").over(Window.partitionBy(*keys))).filter(F.col("__full") == k).drop("__full")
        ranked = cut(ranked)
        found = ranked if found is None else found.unionByName(ranked)
        if width >= extent:
            break
        todo = cut(todo.join(ranked.select(*keys).distinct(), keys, "left_anti"))
        width *= 2
    rows = left
    if by:
        rows = rows.join(F.broadcast(kinds), F.lit(True), "left")
    if found is None:
        empty = [F.lit(None).cast(t).alias(c) for c, t in [("dist_m", "double"), ("rank", "int"), *far.dtypes]]
        return rows.select(*left.columns, *empty) if not by else rows.select(*left.columns, *[F.col("__by").alias(c) if c == f"r_{by}" else e for (c, _), e in zip([("", ""), ("", ""), *far.dtypes], empty)])
    found = found.drop("__id").withColumnsRenamed({"x": "__x", "y": "__y", "__k": "__kf"})
    same = (F.col("x") == F.col("__x")) & (F.col("y") == F.col("__y"))
    joined = rows.join(found, same & (F.col("__k") == F.col("__kf")) if by else same, "left")
    kind = {f"r_{by}": F.coalesce(f"r_{by}", "__by")} if by else {}
    return joined.withColumns(kind).select(*left.columns, *far.columns, "dist_m", "rank")


def knn_small(left: DataFrame, right: DataFrame, key: str, order: str, k: int, by: str | None = None, distance: Column | None = None) -> DataFrame:
    """k nearest by comparing with all of a right side that is known to be small (a facility roster), which is broadcast."""
    far = F.broadcast(right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns]))
    pairs = left.crossJoin(far).withColumn("dist", planar_m(F.col("x"), F.col("y"), F.col("r_x"), F.col("r_y")) if distance is None else distance)
    window = Window.partitionBy(key, *([f"r_{by}"] if by else [])).orderBy("dist", f"r_{order}")
    return pairs.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def inside_ring(x: Column, y: Column, ring: Column) -> Column:
    """Ray casting: whether the point is inside the ring (array of struct x, y; closed or not)."""
    n = F.size(ring)

    def crossing(i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, (i + 1) % n)
        slope = (b["x"] - a["x"]) * (y - a["y"]) / (b["y"] - a["y"]) + a["x"]
        return F.when((a["y"] > y) != (b["y"] > y), F.when(x < slope, 1).otherwise(0)).otherwise(0)

    count = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda s, i: s + crossing(i))
    return F.when(n < 3, F.lit(False)).otherwise(count % 2 == 1)


def inside_polygon(x: Column, y: Column, rings: Column) -> Column:
    """Inside the first ring and outside its holes."""
    holes = F.slice(rings, 2, F.greatest(F.size(rings) - 1, F.lit(0)))
    return inside_ring(x, y, F.get(rings, 0)) & ~F.exists(holes, lambda h: inside_ring(x, y, h))


def polygon_cells(polygons: DataFrame, size: float) -> DataFrame:
    """Each polygon (column rings) once for every cell its bounding box touches."""
    xs, ys = F.transform(F.get("rings", 0), lambda p: p["x"]), F.transform(F.get("rings", 0), lambda p: p["y"])
    span = lambda v: F.sequence(F.floor(F.array_min(v) / size), F.floor(F.array_max(v) / size))
    return polygons.withColumns({"__xs": span(xs), "__ys": span(ys)}).withColumn("cx", F.explode("__xs")).withColumn("cy", F.explode("__ys")).drop("__xs", "__ys")


def points_in_polygons(points: DataFrame, polygons: DataFrame, size: float, how: str = "inner") -> DataFrame:
    """points (x, y) with the polygon each lies in; polygon columns get the prefix p_. how: inner or left."""
    tiles = polygon_cells(polygons, size)
    tiles = tiles.select("cx", "cy", *[F.col(c).alias(f"p_{c}") for c in polygons.columns])
    placed = points.withColumns({"cx": F.floor(F.col("x") / size), "cy": F.floor(F.col("y") / size)})
    condition = (placed["cx"] == tiles["cx"]) & (placed["cy"] == tiles["cy"]) & inside_polygon(F.col("x"), F.col("y"), F.col("p_rings"))
    return placed.join(tiles, condition, how).drop("cx", "cy", "p_rings")


def distance_to_rings(x: Column, y: Column, rings: Column) -> Column:
    """Distance from the nearest edge of a polygon's rings, or of lines."""
    def edge(ring: Column) -> Column:
        return F.array_min(F.transform(F.sequence(F.lit(0), F.size(ring) - 2), lambda i: segment_m(x, y, F.get(ring, i)["x"], F.get(ring, i)["y"], F.get(ring, i + 1)["x"], F.get(ring, i + 1)["y"])))

    return F.array_min(F.transform(F.filter(rings, lambda r: F.size(r) > 1), edge))


def nearest_segment(points: DataFrame, segments: DataFrame, key: str, order: str, reach: float) -> DataFrame:
    """points with the nearest segment (ax, ay, bx, by) within reach: s_ columns and dist_m; ties by `order`. Points at one place are searched once; `key` names a point."""
    places = cut(points.filter(_placed()).select("x", "y").distinct())
    x0, x1, y0, y1 = places.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    if x0 is None:
        x0 = x1 = y0 = y1 = 0.0
    # a segment farther away than reach from the box of all points is near none
    near = segments.filter((F.least("ax", "bx") <= x1 + 2 * reach) & (F.greatest("ax", "bx") >= x0 - 2 * reach) & (F.least("ay", "by") <= y1 + 2 * reach) & (F.greatest("ay", "by") >= y0 - 2 * reach))
    low = lambda a, b: F.floor((F.least(a, b) - reach) / reach)
    high = lambda a, b: F.floor((F.greatest(a, b) + reach) / reach)
    tiles = near.withColumn("cx", F.explode(F.sequence(low("ax", "bx"), high("ax", "bx")))).withColumn("cy", F.explode(F.sequence(low("ay", "by"), high("ay", "by"))))
    tiles = tiles.select("cx", "cy", F.struct(F.col(order).alias("order"), *[F.col(c).alias(f"s_{c}") for c in segments.columns]).alias("s"))
    placed = places.withColumns({"cx": F.floor(F.col("x") / reach), "cy": F.floor(F.col("y") / reach)})
    dist = segment_m(F.col("x"), F.col("y"), F.col("s.s_ax"), F.col("s.s_ay"), F.col("s.s_bx"), F.col("s.s_by"))
    found = placed.join(tiles, ["cx", "cy"]).withColumn("dist_m", dist).filter(F.col("dist_m") <= reach)
    best = found.groupBy("x", "y").agg(F.min_by("s", F.struct("dist_m", "s.order")).alias("s"), F.min("dist_m").alias("dist_m"))
    return points.join(best, ["x", "y"]).select(*points.columns, *[F.col(f"s.s_{c}").alias(f"s_{c}") for c in segments.columns], "dist_m")


def box_overlaps(left: DataFrame, right: DataFrame, size: float) -> DataFrame:
    """Pairs of axis-parallel boxes (x0, y0, x1, y1) with the area they share; right's columns get the prefix r_."""
    span = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / size), F.floor(F.col(b) / size)))
    tile = lambda df: df.withColumn("cx", span("x0", "x1")).withColumn("cy", span("y0", "y1"))
    far = tile(right).select("cx", "cy", *[F.col(c).alias(f"r_{c}") for c in right.columns])
    pairs = tile(left).join(far, ["cx", "cy"])
    w, h = F.least("x1", "r_x1") - F.greatest("x0", "r_x0"), F.least("y1", "r_y1") - F.greatest("y0", "r_y0")
    # a pair that shares several cells counts in the first of them
    first = (F.col("cx") == F.greatest(F.floor(F.col("x0") / size), F.floor(F.col("r_x0") / size))) & (F.col("cy") == F.greatest(F.floor(F.col("y0") / size), F.floor(F.col("r_y0") / size)))
    return pairs.filter(first & (w > 0) & (h > 0)).withColumn("area", w * h).drop("cx", "cy")
