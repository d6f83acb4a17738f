"""Radius join and region clip as equi-joins on grid cells."""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltatlas.functions.geometry import EARTH_RADIUS_M, haversine_m
from voltatlas.operators.ranking import STATION_LIMIT, rank_by_distance, top_per_group
from voltatlas.session import scratch_dir

# Base cells are 0.1 degrees high and at least as wide as high (11 km), so the
# largest search radius reaches one cell to each side.  Every level cuts a
# cell into 2 x 2; the finest are about 0.3 m.
BASE_DEG = 0.1
BASE_ROWS = 1800
LEVELS = 15
_FINE = 1 << LEVELS
# Bits of a level in grids stored before the levels of 2 x 2: 8 x 8.
_OLD_BITS = 3

# Stations per base cell up to which a candidate is compared with the whole cell.
LEAF_ROWS = 128
# Stations per cell of a grid, and stations up to which the candidates of one place share a list.
NEAR_ROWS = 8
PLACE_ROWS = 256
# Rows of a lookup table that may be sent to every task.
BROADCAST_ROWS = 100_000


def _base_columns(base_row: Column) -> Column:
    """Number of base cells around the globe in this row."""
    south = base_row * BASE_DEG - 90
    edge = F.greatest(F.abs(south), F.abs(south + BASE_DEG))
    return F.greatest(F.lit(1), F.floor(F.cos(F.radians(edge)) * 360 / BASE_DEG)).cast("long")


def _with_fine_cell(df: DataFrame, lat: Column, lon: Column) -> DataFrame:
    """Add the finest cell as ``_fr``, ``_fc``; coarser cells are these shifted right."""
    row = F.least(F.floor((lat + 90) / BASE_DEG * _FINE), F.lit(BASE_ROWS * _FINE - 1)).cast("long")
    rows = df.withColumn("_fr", row)
    around = _base_columns(F.shiftright("_fr", LEVELS)) * _FINE
    share = F.pmod(lon + 180, F.lit(360.0)) / 360
    return rows.withColumn("_fc", F.least(F.floor(share * around), around - 1).cast("long"))


def _cell(row: Column, col: Column) -> Column:
    return F.shiftleft(row, 32).bitwiseOR(col)


def _leaf(level: Column, cell: Column) -> Column:
    """Level and cell as one number; the cells of all levels stay below 2**60."""
    return F.shiftleft(level.cast("long"), 60).bitwiseOR(cell)


def _cell_at(level: int, bits: int = 1) -> Column:
    shift = LEVELS - bits * level
    return _cell(F.shiftright("_fr", shift), F.shiftright("_fc", shift))


def _edges(cell: Column, factor: Column) -> tuple[Column, Column, Column, Column]:
    """South and west edge of a cell (west from the date line on), its height and width, in degrees."""
    row, col = F.shiftright(cell, 32), cell.bitwiseAND(F.lit(0xFFFFFFFF))
    height, width = F.lit(BASE_DEG) / factor, F.lit(360.0) / (_base_columns(F.floor(row / factor).cast("long")) * factor)
    return row * height - 90, col * width, height, width


def _places(cells: DataFrame, level: int, bits: int) -> DataFrame:
    """Cells of candidates, ``_at``, as circles around their middle: ``_place, _lat, _lon, _slack``, and ``_reach`` from anywhere within."""
    south, west, height, width = _edges(F.col("_at"), F.lit(float(1 << bits * level)))
    lat, half = south + height / 2, width / 2
    corner = F.greatest(haversine_m(lat, F.lit(0.0), south, half), haversine_m(lat, F.lit(0.0), south + height, half))
    return cells.withColumns(
        {"_place": _leaf(F.lit(level), F.col("_at")), "_lat": lat, "_lon": west + half - 180, "_slack": corner * 1.000001 + 0.001}
    )


def _covering_cells(df: DataFrame, lat: Column, lon: Column, radius: Column) -> DataFrame:
    """One row per base cell that the circle may touch, as ``_cell``."""
    angle = F.degrees(radius / EARTH_RADIUS_M) * 1.000001 + 1e-9
    first = F.greatest(F.lit(0), F.floor((lat - angle + 90) / BASE_DEG)).cast("long")
    last = F.least(F.lit(BASE_ROWS - 1), F.floor((lat + angle + 90) / BASE_DEG)).cast("long")
    # Half the width of the circle in longitude; near a pole it is everything.
    half = F.when(
        F.abs(lat) + angle >= 90, F.lit(180.0)
    ).otherwise(
        F.least(
            F.lit(180.0),
            F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians(angle)) / F.cos(F.radians(lat)))))
            * 1.000001 + 1e-9,
        )
    )
    rows = df.withColumns({"_half": half, "_row": F.explode(F.sequence(first, F.greatest(first, last)))})
    rows = rows.withColumn("_around", _base_columns(F.col("_row")))
    place = lambda x: F.floor((x + 180) / 360 * F.col("_around")).cast("long")
    west = place(lon - F.col("_half"))
    east = F.least(place(lon + F.col("_half")), west + F.col("_around") - 1)
    cols = rows.withColumn("_col", F.explode(F.sequence(west, east)))
    return cols.withColumn("_cell", _cell(F.col("_row"), F.pmod("_col", "_around"))).drop(
        "_half", "_row", "_around", "_col"
    )


def _counts(cells: DataFrame, level: int) -> DataFrame:
    return cells.groupBy(_cell_at(level).alias("_cell")).count()


def _lookup(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


@dataclass(frozen=True)
class StationGrid:
    """Stations filed by cell in buckets, with the counts of cells, for any number of candidate tables.

    ``stations`` is a table bucketed by ``_leaf``, which tells cell and level; ``counts`` holds ``_level, _cell, count``
    for base cells and for the parts of crowded ones; ``crowded`` the number of crowded cells of each level.
    """

    stations: DataFrame
    counts: DataFrame
    crowded: dict[int, int]
    leaf_rows: int
    limit: int
    bits: int = 1

    @property
    def depth(self) -> int:
        """Levels of crowded cells: stations lie at this level at most."""
        return max(self.crowded, default=-1) + 1

    def counts_at(self, level: int) -> DataFrame:
        return self.counts.where(F.col("_level") == level).select("_cell", "count")

    def crowded_at(self, level: int) -> DataFrame:
        cells = self.counts_at(level).where(F.col("count") > self.leaf_rows).select("_cell")
        return _lookup(cells, self.crowded.get(level, 0))


_GRID = "buckets int, leaf_rows long, row_limit int, crowded map<int, long>, columns string, bits int"
_COUNTS = "_cell long, count long, _level int"


def _grid_name(path: str) -> str:
    return "station_grid_" + hashlib.md5(path.encode()).hexdigest()


def open_grid(spark: SparkSession, path: str) -> StationGrid:
    """The grid that ``RadiusJoin.store`` wrote under ``path``, in this session or an earlier one."""
    row = spark.read.schema(_GRID).parquet(f"{path}/grid").first()
    name = _grid_name(path)
    by = f"CLUSTERED BY (_leaf) SORTED BY (_leaf) INTO {row.buckets} BUCKETS"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({row.columns}) USING parquet {by} LOCATION '{path}/stations'")
    counts = spark.read.schema(_COUNTS).parquet(f"{path}/counts")
    return StationGrid(spark.table(name), counts, dict(row.crowded), row.leaf_rows, row.row_limit, row.bits or _OLD_BITS)


@dataclass(frozen=True)
class RadiusJoin:
    """Stations within each candidate's radius.

    ``candidate`` and ``station`` are the unique key columns.  Both tables
    bring ``lat``/``lon`` columns under the given names.
    """

    candidate: str
    station: str
    radius: str = "radius_m"
    c_lat: str = "lat"
    c_lon: str = "lon"
    s_lat: str = "station_lat"
    s_lon: str = "station_lon"
    limit: int | None = STATION_LIMIT
    leaf_rows: int = LEAF_ROWS

    def run(self, candidates: DataFrame, stations: DataFrame | StationGrid) -> DataFrame:
        """Candidate and station columns with ``dist_m`` and ``rank_by_dist``.

        Of stations with a crowded cell the parts are counted first; a grid
        stored before is used as it is, and its stations are not shuffled.
        """
        if isinstance(stations, DataFrame):
            cells = self._cells(stations)
            base = None if self.limit is None else self._base_counts(cells, scratch_dir(cells.sparkSession, "cells"))
            full = 0 if base is None else base.where(F.col("count") > self.leaf_rows).count()
            if full == 0:
                spread = _covering_cells(candidates, F.col(self.c_lat), F.col(self.c_lon), F.col(self.radius).cast("double"))
                right = cells.withColumn("_cell", _cell_at(0)).drop("_fr", "_fc")
                return self._ranked(spread.join(right, "_cell").drop("_cell"))
            stations = self._filed(cells, base, scratch_dir(cells.sparkSession, "counts"))
        return self._ranked(self._pairs(candidates, stations))

    def store(self, stations: DataFrame, path: str, buckets: int | None = None) -> StationGrid:
        """File stations under ``path``: a new folder that readers know once its last part, ``grid``, is there.

        ``buckets`` should be the number of shuffle partitions of the joins to come, which is its default.
        Stations without a place are left out.
        """
        if self.limit is None:
            raise ValueError("a grid holds what can rank within a limit; without one, join the stations as they are")
        spark, cells = stations.sparkSession, self._cells(stations)
        base = self._base_counts(cells, f"{path}/base")
        grid = self._filed(cells, base, f"{path}/counts")
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        filed = grid.stations.repartition(buckets, "_leaf").write.bucketBy(buckets, "_leaf").sortBy("_leaf")
        filed.option("compression", "zstd").option("path", f"{path}/stations").saveAsTable(_grid_name(path))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in grid.stations.schema)
        row = spark.createDataFrame([(buckets, grid.leaf_rows, self.limit, grid.crowded, columns, grid.bits)], _GRID)
        row.coalesce(1).write.parquet(f"{path}/grid")
        return open_grid(spark, path)

    def _cells(self, stations: DataFrame) -> DataFrame:
        return _with_fine_cell(stations, F.col(self.s_lat).cast("double"), F.col(self.s_lon).cast("double"))

    def _ranked(self, pairs: DataFrame) -> DataFrame:
        near = pairs.withColumn(
            "dist_m", haversine_m(self.c_lat, self.c_lon, self.s_lat, self.s_lon)
        ).where(F.col("dist_m") <= F.col(self.radius))
        return rank_by_distance(near, [self.candidate], "dist_m", [self.station], self.limit)

    def _base_counts(self, cells: DataFrame, path: str) -> DataFrame:
        """Stations in each base cell, written: however many stations there are, the globe has some six million of these."""
        _counts(cells.where("_fr is not null and _fc is not null"), 0).write.parquet(path)
        return cells.sparkSession.read.schema("_cell long, count long").parquet(path)

    # A crowded cell is cut until its parts are small.  Candidates of one place, a cell
    # too, share the list of stations that may be among anybody's nearest ``limit`` there;
    # a place is cut until its list is short.

    def _filed(self, cells: DataFrame, base: DataFrame, path: str) -> StationGrid:
        """The grid, its counts written under ``path`` and its stations still to be."""
        spark, leaf_rows = cells.sparkSession, min(self.leaf_rows, max(NEAR_ROWS, self.limit))
        full = F.col("count") > leaf_rows
        base = base.withColumn("_level", F.lit(0))
        crowded_base = base.where(full).count()
        # Finer counts exist only below crowded base cells; of one spot no more count than can rank.
        if crowded_base:
            below = cells.withColumn("_cell", _cell_at(0)).join(_lookup(base.where(full).select("_cell"), crowded_base), "_cell", "left_semi")
            spots = below.groupBy(self.s_lat, self.s_lon, "_fr", "_fc").agg(F.least(F.count(F.lit(1)), F.lit(self.limit)).alias("_n"))
            finer = [F.struct(F.lit(v).alias("_level"), _cell_at(v).alias("_cell")) for v in range(1, LEVELS + 1)]
            deep = spots.select("_n", F.explode(F.array(*finer)).alias("f")).groupBy("f._level", "f._cell").agg(F.sum("_n").alias("count"))
            base = base.unionByName(deep)
        base.select("_cell", "count", "_level").write.partitionBy("_level").parquet(path)
        counts = spark.read.schema(_COUNTS).parquet(path)
        levels = counts.where(full & (F.col("_level") < LEVELS)).groupBy("_level").count().collect()
        crowded = {r["_level"]: r["count"] for r in levels}

        # Stations on one spot are equally far from everybody, so only the
        # first ``limit`` of them by key can ever be among the nearest.
        stations = top_per_group(
            cells.where("_fr is not null and _fc is not null"), [self.s_lat, self.s_lon], [F.asc(self.station)], self.limit, "_same"
        ).drop("_same")
        grid = StationGrid(cells, counts, crowded, leaf_rows, self.limit)
        leaf = _leaf_of({v: (grid.crowded_at(v), crowded.get(v, 0)) for v in range(grid.depth)}, 1)
        return replace(grid, stations=leaf(stations, "_leaf").drop("_fr", "_fc"))

    def _pairs(self, candidates: DataFrame, grid: StationGrid) -> DataFrame:
        """Candidates with the stations that may be among their nearest: as near as the last that ranks in a list."""
        if self.limit is None or self.limit > grid.limit:
            raise ValueError(f"the grid was stored for the nearest {grid.limit}")
        reach, names = F.col(self.radius).cast("double"), [c for c in candidates.columns if c != "_cell"]
        placed = _with_fine_cell(candidates.select(*[F.col(f"`{c}`") for c in names]), F.col(self.c_lat).cast("double"), F.col(self.c_lon).cast("double"))
        placed = placed.where(F.col("_fr").isNotNull() & F.col("_fc").isNotNull() & ~F.isnan(reach))
        lists, cut = self._lists(placed.select("_fr", "_fc", reach.alias("_reach")), grid)
        stations = [c for c in grid.stations.columns if c != "_leaf"]
        part = F.pmod(F.xxhash64(self.station, self.s_lat, self.s_lon), F.ceil(F.col("_total") / PLACE_ROWS))
        rows = lists.join(grid.stations, "_leaf").select("_place", part.alias("_part"), F.struct(*[F.col(f"`{c}`") for c in stations]).alias("_s"))
        near = rows.groupBy("_place", "_part").agg(F.collect_list("_s").alias("_near")).drop("_part")
        dist = lambda s: haversine_m(self.c_lat, self.c_lon, s[self.s_lat], s[self.s_lon])
        met = _leaf_of(cut, grid.bits)(placed, "_place").drop("_fr", "_fc").join(near, "_place").drop("_place")
        met = met.withColumn("_near", F.transform("_near", lambda s: F.struct(dist(s).alias("d"), s.alias("s"))))
        # The last that ranks; a little more, as distances are taken again for the ranks.
        last = F.get(F.array_sort(F.transform("_near", lambda x: x["d"])), F.lit(self.limit - 1)) * 1.000001 + 0.001
        met = met.withColumn("_last", F.least(F.col(self.radius).cast("double") * 1.000001 + 0.001, last))
        met = met.withColumn("_s", F.explode(F.filter("_near", lambda x: x["d"] <= F.col("_last"))))
        return met.select(*[F.col(f"`{c}`") for c in names], *[F.col("_s.s")[c].alias(c) for c in stations])

    def _lists(self, cells: DataFrame, grid: StationGrid) -> tuple[DataFrame, dict[int, tuple[DataFrame, int]]]:
        """``_place, _total, _leaf``: the cells of stations that the candidates of a place may need, and how many stations
        they hold; and, of each level, the places that were cut on, with their number."""
        spark, bits = cells.sparkSession, grid.bits
        path = scratch_dir(spark, "places")
        cells.write.parquet(f"{path}/candidates")
        cells = spark.read.schema(cells.schema).parquet(f"{path}/candidates")
        asks = replace(self, candidate="_place", radius="_reach", c_lat="_lat", c_lon="_lon")
        at = _places(cells.groupBy(_cell_at(0, bits).alias("_at")).agg(F.max("_reach").alias("_reach")), 0, bits)
        active = _covering_cells(at, F.col("_lat"), F.col("_lon"), F.col("_reach") + F.col("_slack"))
        active = active.join(grid.counts_at(0), "_cell").withColumn("_level", F.lit(0))
        cut: dict[int, tuple[DataFrame, int]] = {}
        for v in range(LEVELS // bits + 1):
            kept = asks._drop_hopeless(active, bits).withColumn("_total", F.sum("count").over(Window.partitionBy("_place")))
            kept = kept.select("_place", "_at", "_bound", "_total", "_cell", "_level", "count")
            # Once a list is short, its cells are those by which the stations are filed.
            kept = kept.join(grid.crowded_at(v).withColumns({"_level": F.lit(v), "_full": F.lit(1)}), ["_level", "_cell"], "left")
            crowd = F.max("_full").over(Window.partitionBy("_place")).isNotNull()
            kept = kept.withColumn("_open", ((F.col("_total") > PLACE_ROWS) | crowd) & F.lit(v < LEVELS // bits)).drop("_full")
            kept.write.parquet(f"{path}/lists/step={v:02d}")
            kept = spark.read.schema(kept.schema).parquet(f"{path}/lists/step={v:02d}").where("_open")
            full = kept.select(F.col("_at").alias("_cell")).distinct()
            if not (n := full.count()):
                break
            cut[v] = full, n
            within = cells.withColumn("_up", _cell_at(v, bits)).join(_lookup(full.withColumnRenamed("_cell", "_up"), n), "_up", "left_semi")
            within = within.groupBy("_up", _cell_at(v + 1, bits).alias("_at")).agg(F.max("_reach").alias("_reach"))
            if v < grid.depth:
                parts = grid.counts_at(v + 1).select(F.col("_cell").alias("_child"), F.col("count").alias("_n"))
                parts = parts.withColumn("_parent", self._parent_of(F.col("_child"), bits)).join(
                    grid.crowded_at(v).withColumnRenamed("_cell", "_parent"), "_parent", "left_semi"
                )
                opened = kept.join(parts, (F.col("_level") == v) & (F.col("_cell") == F.col("_parent")), "left")
                kept = opened.select(
                    "_at", "_bound", F.coalesce("_child", "_cell").alias("_cell"), F.coalesce("_n", "count").alias("count"),
                    F.when(F.col("_child").isNotNull(), v + 1).otherwise(F.col("_level")).alias("_level"),
                )
            below = kept.select(F.col("_at").alias("_up"), "_bound", "_cell", "count", "_level").join(within, "_up").drop("_up")
            active = _places(below.withColumn("_bound", F.least("_bound", "_reach")), v + 1, bits)
        lists = spark.read.schema(kept.schema).parquet(f"{path}/lists").where("not _open")
        return lists.select("_place", "_total", _leaf(F.col("_level"), F.col("_cell")).alias("_leaf")), cut

    @staticmethod
    def _parent_of(cell: Column, bits: int) -> Column:
        row, col = F.shiftright(cell, 32), cell.bitwiseAND(F.lit(0xFFFFFFFF))
        return _cell(F.shiftright(row, bits), F.shiftright(col, bits))

    def _drop_hopeless(self, active: DataFrame, bits: int = 1) -> DataFrame:
        """Remove cells farther than the radius, or than ``limit`` surely nearer stations.

        Cells of one candidate, counted from the one whose far side is nearest,
        hold ``limit`` stations by some distance; nothing beyond it can rank.
        The distance is kept as ``_bound``: of a cell's parts only those within it are shuffled.
        Of a place, whose candidates lie within ``_slack`` of its point, what holds for all of them is kept.
        """
        slack = F.col("_slack") if "_slack" in active.columns else F.lit(0.0)
        bound = F.col("_bound") if "_bound" in active.columns else F.col(self.radius).cast("double")
        south, west, height, width = _edges(F.col("_cell"), F.pow(F.lit(float(1 << bits)), F.col("_level")))
        lat, lon = F.col(self.c_lat).cast("double"), F.col(self.c_lon).cast("double")
        east_gap = F.pmod(F.lit(180.0) + lon - west, F.lit(360.0))
        inside = east_gap <= width
        gap = F.when(inside, F.lit(0.0)).otherwise(F.least(east_gap - width, F.lit(360.0) - east_gap))
        reach = F.least(
            F.lit(180.0),
            F.when(inside, F.greatest(east_gap, width - east_gap)).otherwise(gap + width),
        )
        off = F.greatest(F.lit(0.0), south - lat, lat - (south + height))
        across = F.when(gap >= 90, F.lit(0.0)).otherwise(
            F.degrees(F.asin(F.sin(F.radians(gap)) * F.cos(F.radians(lat))))
        )
        least = F.radians(F.greatest(off, across)) * EARTH_RADIUS_M * 0.999999 - 0.001
        most = F.greatest(
            haversine_m(lat, F.lit(0.0), south, reach), haversine_m(lat, F.lit(0.0), south + height, reach)
        ) * 1.000001 + 0.001
        bounded = active.withColumns({"_least": least - slack, "_most": most + slack, "_bound": bound}).where("_least <= _bound")
        mine = Window.partitionBy(self.candidate)
        nearest_first = mine.orderBy("_most", "_level", "_cell")
        held = bounded.withColumn("_held", F.sum("count").over(nearest_first))
        enough = F.min(F.when(F.col("_held") >= self.limit, F.col("_most"))).over(mine)
        kept = held.withColumn("_bound", F.least("_bound", enough)).where("_least <= _bound")
        return kept.drop("_least", "_most", "_held")


def _leaf_of(cut: dict[int, tuple[DataFrame, int]], bits: int):
    """What adds the cell that a row lies in once cells have been cut: at the first level where its cell is not among ``cut``."""

    def add(df: DataFrame, name: str) -> DataFrame:
        df = df.withColumn("_level", F.lit(0))
        for v, (cells, rows) in cut.items():
            hit = df.join(_lookup(cells.select(F.col("_cell").alias("_full")), rows), _cell_at(v, bits) == F.col("_full"), "left")
            df = hit.withColumn("_level", F.col("_level") + F.col("_full").isNotNull().cast("int")).drop("_full")
        leaf = F.lit(None).cast("long")
        for v in range(max(cut, default=-1) + 2):
            leaf = F.when(F.col("_level") == v, _leaf(F.lit(v), _cell_at(v, bits))).otherwise(leaf)
        return df.withColumn(name, leaf).drop("_level")

    return add


# ------------------------------------------------------------------- clip

BAND_DEG = 0.05
EDGES_PER_ARRAY = 2048


def region_edges(regions: DataFrame, region: str, polygons: str) -> DataFrame:
    """Ring edges of every region with the region's bounding box in x."""
    points = F.flatten(F.flatten(polygons))
    xs = F.transform(points, lambda p: p["x"])
    rings = regions.select(
        region, F.array_min(xs).alias("_xmin"), F.array_max(xs).alias("_xmax"),
        F.explode(F.flatten(polygons)).alias("ring"),
    )
    edges = F.zip_with(
        "ring", F.slice("ring", F.lit(2), F.size("ring")),
        lambda a, b: F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
        ),
    )
    rows = rings.select(region, "_xmin", "_xmax", F.explode(edges).alias("e"))
    return rows.where("e.x2 IS NOT NULL AND e.y1 <> e.y2")


def _band(lat: Column) -> Column:
    return F.floor(lat / BAND_DEG)


def clip_to_regions(
    points: DataFrame,
    regions: DataFrame,
    key: str,
    region: str = "region",
    polygons: str = "polygons",
    lat: str = "lat",
    lon: str = "lon",
    edges_per_array: int = EDGES_PER_ARRAY,
) -> DataFrame:
    """Points inside a region, once per region that holds them (even-odd rule).

    Region edges are filed by latitude band as short arrays; a point reads the
    arrays of its band and counts crossings in place.  While a band fits in
    one array per region no point is shuffled.
    """
    edges = region_edges(regions, region, polygons)
    low, high = F.least("e.y1", "e.y2"), F.greatest("e.y1", "e.y2")
    banded = edges.withColumn("_band", F.explode(F.sequence(_band(low), _band(high))))
    shape = banded.groupBy(region, "_band").count().agg(
        F.max("count").alias("most"), F.sum("count").alias("edges")
    ).first()
    parts = max(1, math.ceil((shape.most or 0) / edges_per_array))
    part = F.pmod(F.xxhash64("e"), F.lit(parts))
    filed = banded.groupBy(region, "_band", "_xmin", "_xmax", part.alias("_part")).agg(
        F.collect_list("e").alias("_edges")
    )
    filed = F.broadcast(filed) if (shape.edges or 0) <= BROADCAST_ROWS else filed
    x, y = F.col(lon), F.col(lat)
    hit = points.withColumn("_band", _band(y)).join(filed, "_band").where(x.between(F.col("_xmin"), F.col("_xmax")))
    crossings = F.size(
        F.filter(
            "_edges",
            lambda e: ((e["y1"] > y) != (e["y2"] > y))
            & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]),
        )
    )
    counted = hit.withColumn("_n", crossings).drop("_edges", "_band", "_xmin", "_xmax")
    if parts == 1:
        return counted.where("_n % 2 = 1").drop("_n", "_part")
    odd = (
        counted.groupBy(key, region).agg(F.sum("_n").alias("_n")).where("_n % 2 = 1").select(key, region)
    )
    return points.join(odd, key)
