"""Region clip through a quadtree cover.

Every region is covered by square cells of several sizes.  A cell within the region
holds no edge, and a point in it needs no arithmetic; a cell on the border holds the
few edges that touch it, and whether a reference point of the cell lies inside.  A point's
own place is told from there by the edges on the way to the reference point, so nothing
outside its cell matters.  Points and cells meet by an equi-join on the cell, which
fixes longitude and latitude; a region is looked at by points near its border or inside it only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltatlas.operators.spatial import BROADCAST_ROWS
from voltatlas.session import checkpointed

# A cell is cut into 4 x 4; after so many cuts it stays as it is.
CUT_BITS, MOST_CUTS = 2, 14
# Edges of a border cell that is not cut further, and the share of a region's extent below which none is: edges that
# lie on one another cannot be told apart by cutting.
LEAF_EDGES, FINEST = 32, 4096
# Where in its cell the reference point lies, in shares of its width and height: no number that vertices have.
_AT_X, _AT_Y = math.sqrt(2) - 1, math.pi - 2.5


@dataclass(frozen=True)
class Cover:
    """``cells`` (region, _key, _rx, _ry, _par, _edges; ``_edges`` NULL within the region), the square they cut, and the cuts they come from."""

    cells: DataFrame
    west: float
    south: float
    side: float
    cuts: list[int]
    small: bool

    def keys(self, x: Column, y: Column) -> Column:
        """The cells a point lies in, one for each size that occurs."""
        return F.array(*[_key(c, *_place(x, y, self.west, self.south, _size(self.side, c))) for c in self.cuts])


def _size(side: float, cut: int) -> float:
    return side / (1 << CUT_BITS * cut)


def _place(x: Column, y: Column, west: float, south: float, size: float) -> tuple[Column, Column]:
    return F.floor((x - west) / size).cast("long"), F.floor((y - south) / size).cast("long")


def _key(cut: int, ix: Column, iy: Column) -> Column:
    bits = CUT_BITS * MOST_CUTS
    return F.lit(cut << 2 * bits).cast("long").bitwiseOR(F.shiftleft(ix, bits)).bitwiseOR(iy)


def _steps(e: Column, x: Column, y: Column, rx: Column, ry: Column) -> Column:
    """How often the edge is crossed on the way from (x, y) level to rx, and from there upright to ry.

    Every comparison is half open, as if all points lay a hair to the north, so a vertex counts once.
    """
    at_x = (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]
    level = ((e["y1"] > y) != (e["y2"] > y)) & ((x < at_x) != (rx < at_x))
    at_y = (e["y2"] - e["y1"]) * (rx - e["x1"]) / F.nullif(e["x2"] - e["x1"], F.lit(0.0)) + e["y1"]
    upright = ((e["x1"] > rx) != (e["x2"] > rx)) & ((y < at_y) != (ry < at_y))
    return F.coalesce(level, F.lit(False)).cast("int") + F.coalesce(upright, F.lit(False)).cast("int")


def _touches(e: Column, west: Column, south: Column, size: float) -> Column:
    """Whether the edge may touch the cell; only edges that surely do not are left out."""
    slack = size * 1e-6
    east, north = west + size, south + size
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    side = lambda x, y: dx * (y - e["y1"]) - dy * (x - e["x1"])
    corners = [side(x, y) for x in (west, east) for y in (south, north)]
    near = (F.abs(dx) + F.abs(dy)) * slack
    return (
        (F.greatest(e["x1"], e["x2"]) >= west - slack) & (F.least(e["x1"], e["x2"]) <= east + slack)
        & (F.greatest(e["y1"], e["y2"]) >= south - slack) & (F.least(e["y1"], e["y2"]) <= north + slack)
        & (F.least(*corners) <= near) & (F.greatest(*corners) >= -near)
    )


def _edges(regions: DataFrame, region: str, polygons: str) -> DataFrame:
    """Edges of all rings, with the longer side of the region's box."""
    points = F.flatten(F.flatten(polygons))
    extent = lambda k: F.array_max(F.transform(points, lambda p: p[k])) - F.array_min(F.transform(points, lambda p: p[k]))
    rings = regions.select(region, F.greatest(extent("x"), extent("y")).alias("_extent"), F.explode(F.flatten(polygons)).alias("ring"))
    pairs = F.zip_with(
        "ring", F.slice("ring", F.lit(2), F.size("ring")),
        lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")),
    )
    rows = rings.select(region, "_extent", F.explode(pairs).alias("e"))
    return rows.where("e.x2 IS NOT NULL AND (e.x1 <> e.x2 OR e.y1 <> e.y2)")


def cover_regions(regions: DataFrame, region: str = "region", polygons: str = "polygons", leaf_edges: int = LEAF_EDGES) -> Cover | None:
    """The cover of all regions together; None if they have no edges.

    Edges go down the tree as rows: a step gives each of them to those of 16
    smaller cells that it touches, and sums the crossings between the reference points of
    a cell and of its parts.  Cells that no edge touches are inside or gone; border cells are
    cut until they hold ``leaf_edges`` edges and are no larger than the region (so
    a small region does not weigh on a large cell), or are small beside it.  No region is ever one row.
    """
    state = checkpointed(_edges(regions, region, polygons))
    box = state.agg(*[f(g(f"e.{k}1", f"e.{k}2")) for k in "xy" for f, g in ((F.min, F.least), (F.max, F.greatest))]).first()
    if box[0] is None:
        return None
    # A power of two around everything, with an empty margin where the first reference point lies.
    side = 2.0 ** math.ceil(math.log2(max(box[1] - box[0], box[3] - box[2], 1e-9) * 1.5))
    west, south = (math.floor(low / side * 16) * side / 16 - side / 16 for low in (box[0], box[2]))
    state = state.select(region, "_extent", "e", *[F.lit(0).cast("long").alias(c) for c in ("ix", "iy")], F.lit(0).alias("par"))
    found, cuts, count = [], [], 0
    for cut in range(1, MOST_CUTS + 1):
        size, above = _size(side, cut), _size(side, cut - 1)
        part = F.explode(F.sequence(F.lit(0), F.lit((1 << 2 * CUT_BITS) - 1))).alias("k")
        rows = state.select("*", part)
        kx = F.shiftleft("ix", CUT_BITS) + F.col("k").bitwiseAND(F.lit((1 << CUT_BITS) - 1))
        ky = F.shiftleft("iy", CUT_BITS) + F.shiftright("k", CUT_BITS)
        rows = rows.withColumns({"kx": kx, "ky": ky})
        cx, cy = west + F.col("kx") * size, south + F.col("ky") * size
        # The whole square's reference point is its corner, outside of all regions.
        up_x, up_y = (F.lit(west), F.lit(south)) if cut == 1 else (west + (F.col("ix") + _AT_X) * above, south + (F.col("iy") + _AT_Y) * above)
        steps = _steps(F.col("e"), cx + _AT_X * size, cy + _AT_Y * size, up_x, up_y)
        rows = rows.withColumns({"hit": _touches(F.col("e"), cx, cy, size), "steps": steps})
        cells = rows.groupBy(region, "kx", "ky").agg(
            ((F.max("par") + F.sum("steps")) % 2).cast("int").alias("now"), F.sum(F.col("hit").cast("int")).alias("n"), F.max("_extent").alias("_x")
        )
        leaf = F.lit(True) if cut == MOST_CUTS else (F.col("n") <= leaf_edges) & (F.lit(size) <= F.col("_x")) | (F.lit(size * FINEST) <= F.col("_x"))
        cells = checkpointed(cells.where("n > 0 OR now = 1").select(region, "kx", "ky", "now", "n", leaf.alias("leaf")))
        border = cells.where("n > 0").select(region, "kx", "ky", "now", "leaf")
        below = rows.where("hit").select(region, "_extent", "e", "kx", "ky").join(border, [region, "kx", "ky"])
        below = checkpointed(below)
        base = [region, _key(cut, F.col("kx"), F.col("ky")).alias("_key"),
                (west + (F.col("kx") + _AT_X) * size).alias("_rx"), (south + (F.col("ky") + _AT_Y) * size).alias("_ry")]
        within = cells.where("n = 0").select(*base, F.lit(1).alias("_par"), F.lit(None).cast("array<struct<x1:double,y1:double,x2:double,y2:double>>").alias("_edges"))
        leaves = below.where("leaf").groupBy(region, "kx", "ky", "now").agg(F.collect_list("e").alias("_edges"))
        found.append(within.unionByName(leaves.select(*base, F.col("now").alias("_par"), "_edges")))
        done, weight, still = cells.agg(
            F.count(F.when(F.col("leaf") | (F.col("n") == 0), 1)), F.sum(F.when(F.col("leaf") | (F.col("n") == 0), F.greatest("n", F.lit(1)))),
            F.count(F.when(~F.col("leaf") & (F.col("n") > 0), 1)),
        ).first()
        if done:
            cuts.append(cut)
            count += weight
        if not still:
            break
        state = below.where("not leaf").select(region, "_extent", "e", F.col("kx").alias("ix"), F.col("ky").alias("iy"), F.col("now").alias("par"))
    cells = found[0]
    for more in found[1:]:
        cells = cells.unionByName(more)
    return Cover(cells, west, south, side, cuts, count <= BROADCAST_ROWS)


def clip_by_cover(points: DataFrame, cover: Cover | None, region: str = "region", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Points inside a region (even-odd rule), once per region that holds them.

    A point looks up one cell for each size in the cover.  Cells are sent to every
    task only when they and their edges were counted to be few; otherwise the same
    equi-join shuffles, and points are not grouped afterwards.
    Points without coordinates lie nowhere.
    """
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    if cover is None or not cover.cuts:
        return points.where(F.lit(False)).withColumn(region, F.lit(None).cast("string"))
    cells = F.broadcast(cover.cells) if cover.small else cover.cells
    hit = points.withColumn("_key", F.explode(cover.keys(x, y))).join(cells, "_key")
    steps = F.aggregate("_edges", F.col("_par"), lambda n, e: n + _steps(e, x, y, F.col("_rx"), F.col("_ry")))
    inside = F.col("_edges").isNull() | (steps % 2 == 1)
    return hit.where(inside).drop("_key", "_rx", "_ry", "_par", "_edges")
