"""Points in polygons with native expressions.

A polygon is covered by the cells of a quadtree: it starts with the few cells of
its own size, and a cell with many edges is cut in four until few are left. A cell
without edges lies inside as a whole, or is left out; a border cell keeps the edges
that touch it and whether its reference point is inside. Points are listed under
their cell of each size in use, and meet the cover in an equality join. A point in
a border cell is inside if the way to the reference point crosses the outline an
even number of times, or odd, as that point is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from areapulse.session import stage

#: Edges that a border cell may keep, and how often a cell is cut for that.
CELL_EDGES = 16
MOST_CUTS = 16
#: Where in its cell a reference point lies; no outline has corners there.
REFERENCE = (0.5176380902050415, 0.4721359549995794)
CELL = ["_level", "_cx", "_cy"]
BOX = ["_x0", "_x1", "_y0", "_y1"]
#: Cells that the border cells of few polygons may be cut into at once, so that most points meet none, and how fine.
FINE_CELLS = 1 << 16
FINEST = 6
#: Polygons that a task covers.
POLYGONS_AT_ONCE = 4096


def edges(ring: Column) -> Column:
    """Array of (x1, y1, x2, y2), closing the ring."""
    following = F.concat(F.slice(ring, 2, F.size(ring) - 1), F.slice(ring, 1, 1))
    return F.zip_with(ring, following, lambda a, b: F.struct(
        a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
    ))


def on_outline(x: Column, y: Column, ring_edges: Column) -> Column:
    def touches(e: Column) -> Column:
        area = (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
        in_x = (x >= F.least(e["x1"], e["x2"])) & (x <= F.greatest(e["x1"], e["x2"]))
        in_y = (y >= F.least(e["y1"], e["y2"])) & (y <= F.greatest(e["y1"], e["y2"]))
        return (area == 0) & in_x & in_y

    return F.exists(ring_edges, touches)


def boxed_polygons(polygons: DataFrame) -> DataFrame:
    """Edges and bounding box of polygons (code, name, and ``ring`` or ``rings``).

    ``rings`` holds the outer rings of all parts and the holes, in any order.
    """
    rings = F.col("rings") if "rings" in polygons.columns else F.array("ring")
    points = F.flatten(rings)

    def bound(axis: str, function) -> Column:
        return function(F.transform(points, lambda p: p[axis]))

    return polygons.select(
        F.col("code").alias("polygon_code"), F.col("name").alias("polygon_name"), F.flatten(F.transform(rings, edges)).alias("_edges"),
        bound("x", F.array_min).alias("_x0"), bound("x", F.array_max).alias("_x1"),
        bound("y", F.array_min).alias("_y0"), bound("y", F.array_max).alias("_y1"),
    )


def _crossings(x: Column, y: Column, to_x: Column, to_y: Column, ring_edges: Column) -> Column:
    """How often the way from a point along its row, then along the other point's column, crosses edges."""
    def crosses(e: Column) -> Column:
        in_row = (e["y1"] > y) != (e["y2"] > y)
        at = F.try_divide((e["x2"] - e["x1"]) * (y - e["y1"]), e["y2"] - e["y1"]) + e["x1"]
        row = F.when(in_row & ((x < at) != (to_x < at)), 1).otherwise(0)
        in_column = (e["x1"] > to_x) != (e["x2"] > to_x)
        up = F.try_divide((e["y2"] - e["y1"]) * (to_x - e["x1"]), e["x2"] - e["x1"]) + e["y1"]
        return row + F.when(in_column & ((y < up) != (to_y < up)), 1).otherwise(0)

    return F.aggregate(ring_edges, F.lit(0), lambda total, e: total + crosses(e))


def _touching(ring_edges: Column, x0: Column, y0: Column, size: Column) -> Column:
    """The edges that come into a cell or touch it: their box does, and the corners are not all on one side of them."""
    x1, y1 = x0 + size, y0 + size

    def touches(e: Column) -> Column:
        boxes = (
            (F.least(e["x1"], e["x2"]) <= x1) & (F.greatest(e["x1"], e["x2"]) >= x0)
            & (F.least(e["y1"], e["y2"]) <= y1) & (F.greatest(e["y1"], e["y2"]) >= y0)
        )
        sides = [(e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"]) for x in (x0, x1) for y in (y0, y1)]
        return boxes & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)

    return F.filter(ring_edges, touches)


def _with_cell(cells: DataFrame, around: Column, reference: Column) -> DataFrame:
    """Cells (``_level``, ``_cx``, ``_cy``) with the edges of ``around`` that touch them, and ``_in``: whether ``_rx``, ``_ry`` is inside."""
    size = F.pow(F.lit(2.0), -F.col("_level"))
    # sizes and corners are columns first: in the tests of the edges they would be made again for each of them
    placed = cells.withColumn("_size", size).withColumns({
        "_left": F.col("_cx") * F.col("_size"), "_low": F.col("_cy") * F.col("_size"),
        "_rx": (F.col("_cx") + REFERENCE[0]) * F.col("_size"), "_ry": (F.col("_cy") + REFERENCE[1]) * F.col("_size"),
    }).withColumn("_edges", _touching(around, F.col("_left"), F.col("_low"), F.col("_size")))
    return placed.withColumn("_in", reference).select("polygon_code", "polygon_name", *CELL, "_edges", "_rx", "_ry", "_in", *BOX)


def _cut(parents: DataFrame, times: int = 1) -> DataFrame:
    """The cells that border cells fall into when cut in four ``times`` times."""
    per = 1 << times
    at = F.explode(F.sequence(F.lit(0), F.lit(per * per - 1)))
    children = parents.withColumnsRenamed({"_edges": "_outline", "_rx": "_px", "_ry": "_py", "_in": "_pin"}).withColumn("_q", at).withColumns({
        "_level": F.col("_level") + times, "_cx": F.col("_cx") * per + F.col("_q") % per,
        "_cy": F.col("_cy") * per + F.floor(F.col("_q") / per),
    })
    way = _crossings(F.col("_rx"), F.col("_ry"), F.col("_px"), F.col("_py"), F.col("_outline"))
    return _with_cell(children, F.col("_outline"), F.col("_pin") != (way % 2 == 1))


def _fine(cells: DataFrame) -> DataFrame:
    """A stored cover whose border cells are cut as fine as their number allows; many stay as they are."""
    border = F.size("_edges") > 0
    count = cells.where(border).count()
    times = min(FINEST, max(0, (FINE_CELLS // max(1, count)).bit_length() - 1) // 2)
    if not count or not times:
        return cells
    cut = _cut(cells.where(border), times).where(border | F.col("_in"))
    return stage(cells.sparkSession, cells.where(~border).unionByName(cut), "fine_cells")


def cover(polygons: DataFrame, cell_edges: int = CELL_EDGES, most_cuts: int = MOST_CUTS) -> DataFrame:
    """The stored cells that cover polygons: full ones without ``_edges``, border ones with at most ``cell_edges``.

    More edges than that stay only where they meet closer than the smallest cells.
    """
    spark = polygons.sparkSession
    # a small file holds many polygons, which are work for more than the one task that reads it
    tasks = max(1, -(-polygons.count() // POLYGONS_AT_ONCE))
    boxed = boxed_polygons(polygons.repartition(tasks, "code", "name")).withColumnRenamed("_edges", "_outline")
    extent = F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0"), F.lit(1e-9))
    level = (-F.ceil(F.log2(extent))).cast("int")
    per = F.pow(F.lit(2.0), F.col("_level"))

    def cells(low: str, high: str) -> Column:
        return F.sequence(F.floor(F.col(low) * per), F.floor(F.col(high) * per))

    roots = boxed.withColumn("_level", level).withColumn("_cx", F.explode(cells("_x0", "_x1"))).withColumn("_cy", F.explode(cells("_y0", "_y1")))
    crossed = F.aggregate(F.col("_outline"), F.lit(0), lambda total, e: total + F.when(
        ((e["y1"] > F.col("_ry")) != (e["y2"] > F.col("_ry")))
        & (F.col("_rx") < F.try_divide((e["x2"] - e["x1"]) * (F.col("_ry") - e["y1"]), e["y2"] - e["y1"]) + e["x1"]), 1).otherwise(0))
    open_cells = stage(spark, _with_cell(roots, F.col("_outline"), crossed % 2 == 1), "polygon_cells")
    done = []
    for cut in range(most_cuts + 1):
        crowded = F.size("_edges") > cell_edges
        if cut == most_cuts or not open_cells.where(crowded).limit(1).count():
            done.append(open_cells)
            break
        done.append(open_cells.where(~crowded))
        open_cells = stage(spark, _cut(open_cells.where(crowded)), "polygon_cells")
    every = reduce(DataFrame.union, done)
    return every.where((F.size("_edges") > 0) | F.col("_in"))


def points_in_polygons(points: DataFrame, polygons: DataFrame, key: str, x: str, y: str, cell_edges: int = CELL_EDGES) -> DataFrame:
    """(key, polygon_code, polygon_name) for every point within a polygon; points on an outline are not."""
    cells = _fine(cover(polygons, cell_edges))
    # a fixed number of sizes, the powers of two between the smallest and the largest polygon's cells
    levels = sorted(r["_level"] for r in cells.select("_level").distinct().collect())
    per = F.pow(F.lit(2.0), F.col("_level"))
    placed = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        key, F.col(x).alias("_x"), F.col(y).alias("_y"), F.explode(F.array(*map(F.lit, levels)).cast("array<int>")).alias("_level")
    ).withColumns({"_cx": F.floor(F.col("_x") * per), "_cy": F.floor(F.col("_y") * per)})
    px, py, own = F.col("_x"), F.col("_y"), F.col("_edges")
    way = _crossings(px, py, F.col("_rx"), F.col("_ry"), own)
    within = F.col("_in") != (way % 2 == 1)
    # what lies within a polygon lies within its box, which costs little to see
    boxed = (px > F.col("_x0")) & (px < F.col("_x1")) & (py > F.col("_y0")) & (py < F.col("_y1"))
    return (
        placed.join(cells, CELL)
        .where(boxed & F.when(F.size(own) == 0, F.col("_in")).otherwise(within & ~on_outline(px, py, own)))
        .select(key, "polygon_code", "polygon_name")
    )


def assign_units(dim: DataFrame, polygons: DataFrame) -> DataFrame:
    """Label, type and codes of places taken from the polygon they lie in.

    Where polygons overlap, the lowest code is taken.
    """
    found = (
        points_in_polygons(dim, polygons, "spatial_key", "lon", "lat")
        .groupBy("spatial_key")
        .agg(F.min(F.struct("polygon_code", "polygon_name")).alias("_unit"))
    )
    name, code, hit = F.col("_unit.polygon_name"), F.col("_unit.polygon_code"), F.col("_unit").isNotNull()
    return dim.join(found, "spatial_key", "left").withColumns({
        "spatial_label": F.coalesce(name, F.col("spatial_label")),
        "spatial_type": F.when(hit, "emd").otherwise(F.col("spatial_type")),
        "code": F.coalesce(code, F.col("code")),
        "emd_code": F.coalesce(code, F.col("emd_code")),
        "emd_name": F.coalesce(name, F.col("emd_name")),
    }).select(*dim.columns)
