"""Where a video was taken."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake import fixed
from framelake.functions import keys

#: Cells of level n are 180 / 2**n degrees wide; the finest are of about 10 m.
WIDEST, LEVELS = 180.0, 21


def region_cells(regions: DataFrame) -> DataFrame:
    """Per cell of a level the regions that reach into it. A region has cells of one level, the finest whose cells are no smaller: four at most."""
    wide = F.greatest(F.col("lat_hi") - F.col("lat_lo"), F.col("lon_hi") - F.col("lon_lo"))
    level = F.when(wide > 0, F.least(F.greatest(F.floor(F.log2(WIDEST / wide)), F.lit(0)), F.lit(LEVELS))).otherwise(LEVELS).cast("int")
    area = (F.col("lat_hi") - F.col("lat_lo")) * (F.col("lon_hi") - F.col("lon_lo"))
    cell = F.lit(WIDEST) / F.expr("shiftleft(1L, level)")

    def span(lo: str, hi: str):
        first, last = (F.floor(F.col(c) / cell).cast("long") for c in (lo, hi))
        return F.explode(F.when(first <= last, F.sequence(first, last)))
    return (regions.withColumn("level", level).withColumn("_area", area)
            .withColumn("cell_lat", span("lat_lo", "lat_hi")).withColumn("cell_lon", span("lon_lo", "lon_hi"))
            .groupBy("level", "cell_lat", "cell_lon")
            .agg(F.collect_list(F.struct("_area", "region", "lat_lo", "lat_hi", "lon_lo", "lon_hi")).alias("_regions")))


def locate(points: DataFrame, regions: DataFrame) -> DataFrame:
    """Add `location`: the smallest half-open box around (lat, lon), ties to the first name.

    `Unknown` without coordinates, `Oversea` outside every region. Regions lie in a hierarchy of cells, each in up to four of its own size, so
    small and large ones go together; a point looks up its cell in every level that has regions and meets one row there. The adaptive planner
    broadcasts the cells of a level if they have turned out few, and otherwise splits crowded cells of the point side.
    """
    cells = region_cells(regions)
    levels = sorted(r.level for r in cells.select("level").distinct().collect())  # LEVELS + 1 at most
    found = points.withColumn("_best", F.lit(None).cast("struct<_area:double,region:string>"))
    for level in levels:
        at = {f"_{c}": F.floor(F.col(c) / (WIDEST / (1 << level))).cast("long") for c in ("lat", "lon")}
        here = cells.filter(F.col("level") == level).select(F.col("cell_lat").alias("_lat"), F.col("cell_lon").alias("_lon"), "_regions")
        around = F.filter("_regions", lambda r: (F.col("lat") >= r["lat_lo"]) & (F.col("lat") < r["lat_hi"])
                          & (F.col("lon") >= r["lon_lo"]) & (F.col("lon") < r["lon_hi"]))
        best = F.array_min(F.transform(around, lambda r: F.struct(r["_area"].cast("double").alias("_area"), r["region"].alias("region"))))
        found = (found.withColumns(at).join(here, ["_lat", "_lon"], "left")
                 .withColumn("_best", F.array_min(F.array_compact(F.array("_best", best)))).drop("_lat", "_lon", "_regions"))
    location = (F.when(F.col("lat").isNull() | F.col("lon").isNull(), F.lit(fixed.UNKNOWN))
                .otherwise(F.coalesce(F.col("_best.region"), F.lit(fixed.OVERSEA))))
    return found.withColumn("location", location).drop("_best")


def attach_location(videos: DataFrame, sidecar: DataFrame, regions: DataFrame) -> DataFrame:
    """Location of each video (`url`) through the coordinates of the sidecar with the same file stem."""
    known = sidecar.select("stem", "lat", "lon")
    joined = videos.withColumn("stem", keys.file_stem(F.col("url"))).join(known, "stem", "left")
    return locate(joined, regions).drop("stem")
