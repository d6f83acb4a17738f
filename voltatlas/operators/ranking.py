"""Top-N per stratum, top-k per group, latest row per key."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltatlas.functions.points import in_range, point_lon_lat, search_radius_m
from voltatlas.operators.numbering import number_rows
from voltatlas.sources.tables import candidate_cells

# Size of a candidate run, its strata, station hits per candidate.
TOP_CANDIDATES = 50
STRATA = (1, 2, 3)
STATION_LIMIT = 10

# Up to this limit Spark keeps only the top rows of each group before the
# shuffle; the value is the default of spark.sql.optimizer.windowGroupLimitThreshold.
GROUP_LIMIT_ROWS = 1000
SALTS = 256


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int, rank: str = "rn") -> DataFrame:
    """First ``n`` rows of each group in ``order``, numbered from 1.

    ``order`` must end in a unique column.  Small ``n`` is cut on the map side;
    for a large ``n`` a salted first round does the same, so a hot group is
    never sorted whole in one task.  Beyond some 100,000 rows per group number
    the rows with ``number_rows`` and filter.
    """
    if n > GROUP_LIMIT_ROWS:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
        first = F.row_number().over(Window.partitionBy(*group, "_salt").orderBy(*order))
        df = salted.withColumn("_first", first).where(F.col("_first") <= n).drop("_salt", "_first")
    number = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(rank, number).where(F.col(rank) <= n)


def stratified_candidates(
    cells: DataFrame,
    total: int = TOP_CANDIDATES,
    strata: Sequence[int] = STRATA,
    tie: str = "h3_r7",
) -> DataFrame:
    """Best cells of each degree of urbanisation, then the best ``total`` of all.

    Cells are picked before their coordinates are checked, so a bad point text
    makes the result smaller; it is not replaced.
    """
    per_stratum = math.ceil(total / len(strata))
    typed = candidate_cells(cells).withColumn("degurba", F.col("degurba").try_cast("int"))
    ranked = top_per_group(
        typed.where(F.col("degurba").isin(list(strata))),
        ["degurba"], [F.desc("macro_score"), F.asc(tie)], per_stratum,
    )
    placed = ranked.withColumn("p", point_lon_lat("cell_center_wkt_4326", "sql"))
    return (
        placed.where(in_range("p.lon", "p.lat"))
        .select(
            "region_code", "region", "h3_r7", "degurba",
            F.col("p.lon").alias("lon"), F.col("p.lat").alias("lat"),
            "kring_area_m2", "macro_score", search_radius_m("kring_area_m2").alias("radius_m"),
        )
        .orderBy(F.desc("macro_score"), F.asc(tie))
        .limit(total)
    )


def rank_by_distance(
    df: DataFrame,
    group: list[str],
    distance: str,
    ties: list[str],
    limit: int | None = STATION_LIMIT,
    out: str = "rank_by_dist",
    ranges: int | None = None,
) -> DataFrame:
    """1-based rank by distance in each group, missing distances last.

    ``limit=None`` ranks every row, also of a group too large for one task.
    """
    if limit is not None:
        order = [F.asc_nulls_last(distance), *[F.asc(t) for t in ties]]
        return top_per_group(df, group, order, limit, out)
    order = [F.col(distance).isNull(), F.col(distance), *[F.col(t) for t in ties]]
    return number_rows(df, order, group, out, ranges)


def last_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The row with the largest ``order`` of each key; NULL keys are one key.

    Every task keeps one row per key before the shuffle, so a hot key costs
    no more than a rare one.
    """
    w = Window.partitionBy(*key).orderBy(*[F.desc_nulls_last(o) for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def debug_rows(df: DataFrame, order: list[str], rows: int = 10, enabled: bool = True) -> DataFrame:
    """First rows in a stated order, when the debug switch is on; at least one."""
    return df.orderBy(*order).limit(max(1, rows)) if enabled else df
