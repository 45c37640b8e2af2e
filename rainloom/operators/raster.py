"""Grids: coordinates, coarsening, masks of polygons and zonal statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry

# fixed value: a warning, with its date and basin
NO_DATA = "No valid data | Date: %s | Basin: %s"
#: Rows and columns of a block of cells, and bytes of an encoded mask up to which it is broadcast.
SIDE, BROADCAST = 64, 64 << 20


def grid_coordinates(cells: DataFrame, rows: int, x_left: float, y_bottom: float, cell: float) -> DataFrame:
    """Adds x and y of the cells' centres to cells (row, col); row 0 is the northern one."""
    return cells.withColumns({"x": F.lit(x_left) + (F.col("col") + 0.5) * cell, "y": F.lit(y_bottom) + (F.lit(rows) - F.col("row") - 0.5) * cell})


def coarsening_factor(cell: float, new_cell: float, tolerance: float = 1e-6) -> int:
    """How many cells make one; ValueError unless it is a whole number of at least 1."""
    factor = round(new_cell / cell)
    if factor < 1 or abs(new_cell / cell - factor) > tolerance:
        raise ValueError(f"{new_cell} is no whole multiple of {cell}")
    return factor


def coarsen(grid: DataFrame, factor: int, rows: int, cols: int) -> DataFrame:
    """Means of blocks of factor x factor cells, missing ones left out; cells beyond whole blocks are dropped.

    A block's x and y are those of its centre."""
    whole = grid.where((F.col("row") < rows // factor * factor) & (F.col("col") < cols // factor * factor))
    keys = [F.floor(F.col("row") / factor).cast("int").alias("row"), F.floor(F.col("col") / factor).cast("int").alias("col")]
    return whole.groupBy(*keys).agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.avg(geometry.missing(F.col("z"))).alias("z"))


def _tile(grid: DataFrame, across: int = SIDE) -> float:
    """The side of tiles that hold about across x across cells."""
    r = grid.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.count(F.lit(1)).alias("n")).first()
    if not r.n or r.x0 is None or r.y0 is None:
        return 1.0
    wide, high = r.x1 - r.x0, r.y1 - r.y0
    return across * ((wide * high / r.n) ** 0.5 if wide and high else max(wide, high) / r.n) or 1.0


def _tiles(low: Column, high: Column, side: float) -> Column:
    return F.sequence(F.floor(low / side), F.floor(high / side))


def polygon_mask(grid: DataFrame, polygons: DataFrame, tile: float | None = None) -> DataFrame:
    """basin, row, col of the cells whose centre lies in a polygon (basin, rings), by the even-odd rule, so holes are rings too.

    Scanlines are the cells' ys. An edge and the scanlines it may cross meet by an equality join on bands of tiles; a polygon's
    crossings of a scanline, sorted, are the intervals of x that are inside; intervals and cells meet by an equality join on
    scanline and tile. Polygons of the same name count as one; a cell may lie in several basins. tile: the side of tiles, some
    64 cells unless given."""
    side = float(tile or _tile(grid))
    own = polygons.withColumn("polygon", F.monotonically_increasing_id()).select("polygon", "basin", F.explode("rings").alias("ring"))
    after = F.concat(F.slice("ring", 2, F.size("ring")), F.slice("ring", 1, 1))  # a ring may or may not repeat its first corner
    edges = own.select("polygon", "basin", F.explode(F.arrays_zip(F.col("ring").alias("a"), after.alias("b"))).alias("e"))
    edges = edges.select("polygon", "basin", F.col("e.a.x").alias("ax"), F.col("e.a.y").alias("ay"), F.col("e.b.x").alias("bx"), F.col("e.b.y").alias("by")).where("ay <> by")
    banded = edges.withColumn("band", F.explode(_tiles(F.least("ay", "by"), F.greatest("ay", "by"), side)))
    lines = grid.select("y").distinct().withColumn("band", F.floor(F.col("y") / side))
    at = F.col("ax") + (F.col("y") - F.col("ay")) * F.try_divide(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))
    crossings = banded.join(lines, "band").where((F.col("ay") > F.col("y")) != (F.col("by") > F.col("y"))).select("polygon", "basin", "y", at.alias("at"))
    sorted_ = crossings.groupBy("polygon", "basin", "y").agg(F.array_sort(F.collect_list("at")).alias("at"))
    pairs = F.expr("transform(sequence(0, cast(size(at) div 2 as int) - 1), k -> struct(get(at, 2 * k) AS low, get(at, 2 * k + 1) AS high))")
    inside = sorted_.select("basin", "y", F.explode(pairs).alias("i")).select("basin", "y", "i.*").where("low < high")
    inside = inside.withColumn("tile", F.explode(_tiles(F.col("low"), F.col("high"), side)))
    cells = grid.select("row", "col", "x", "y").withColumn("tile", F.floor(F.col("x") / side))
    return cells.join(inside, ["y", "tile"]).where("x >= low AND x < high").select("basin", "row", "col").distinct()


def _block(name: str) -> Column:
    return F.floor(F.col(name) / SIDE).cast("int")


def _bit(column: Column) -> Column:
    return F.pmod(column, F.lit(SIDE)).cast("int")


def mask_blocks(mask: DataFrame) -> DataFrame:
    """brow, bcol, basin, bits: a mask (basin, row, col) as bitmaps, a row for each block and basin, with a long for each line of the block."""
    line = mask.groupBy(_block("row").alias("brow"), _block("col").alias("bcol"), "basin", _bit(F.col("row")).alias("line")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), _bit(F.col("col")))).alias("bits"))
    lines = line.groupBy("brow", "bcol", "basin").agg(F.map_from_entries(F.collect_list(F.struct("line", "bits"))).alias("of"))
    return lines.select("brow", "bcol", "basin", F.transform(F.sequence(F.lit(0), F.lit(SIDE - 1)), lambda k: F.coalesce(F.try_element_at("of", k), F.lit(0).cast("long"))).alias("bits"))


def _encoded(values: DataFrame, v: Column) -> DataFrame:
    """date, brow, bcol, at, v: the cells of a block that lie in one batch, as an array of places and one of values. Nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            day, row, col = (batch.column(c).cast(pa.int32()).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("date", "row", "col"))
            own = batch.column("v").to_numpy(zero_copy_only=False)
            order = np.lexsort((col // SIDE, row // SIDE, day))
            day, row, col = day[order], row[order], col[order]
            keys = np.stack([day, row // SIDE, col // SIDE])
            edge = np.concatenate([[0], np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1])[: len(day) and None]
            offsets = pa.array(np.append(edge, len(day)), pa.int32())
            arrays = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in ((row % SIDE * SIDE + col % SIDE).astype(np.int32), own[order].astype(float))]
            yield pa.RecordBatch.from_arrays([pa.array(keys[0][edge], pa.int32()).cast(pa.date32()), *(pa.array(k[edge], pa.int32()) for k in keys[1:]), *arrays], ["date", "brow", "bcol", "at", "v"])

    solid = values.where("date IS NOT NULL AND row IS NOT NULL AND col IS NOT NULL")
    return solid.select("date", "row", "col", v.alias("v")).mapInArrow(run, "date date, brow int, bcol int, at array<int>, v array<double>")


def _partial(joined: DataFrame) -> DataFrame:
    """date, basin, total, n of each block's cells in the basin's bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, n = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for k in range(batch.num_rows):
                if batch.column("basin")[k].is_valid:
                    bits = np.unpackbits(batch.column("bits")[k].values.to_numpy().view(np.uint8), bitorder="little").astype(bool)
                    v = batch.column("v")[k].values.to_numpy(zero_copy_only=False)[bits[batch.column("at")[k].values.to_numpy()]]
                    v = v[~np.isnan(v)]
                    total[k], n[k] = v.sum(), len(v)
            yield pa.RecordBatch.from_arrays([batch.column("date"), batch.column("basin"), pa.array(total), pa.array(n)], ["date", "basin", "total", "n"])

    return joined.mapInArrow(run, "date date, basin string, total double, n long")


def zonal_sums(values: DataFrame, mask: DataFrame, column: str = "rainfall", broadcast: int = BROADCAST) -> DataFrame:
    """date, basin, total, n: sums and numbers of values of each basin's cells, and a row without basin for every date.

    The mask becomes bitmaps of 64 x 64 cells, some 560 bytes for each block and basin. Where these are few enough they are broadcast:
    cells are summed where they lie, and sums of days and basins are all that is shuffled. Else cells are packed by block where
    they lie, and what is shuffled is a row for each block and date."""
    v, blocks = geometry.missing(F.col(column).cast("double")), mask_blocks(mask)
    if blocks.count() * (8 * SIDE + 48) <= broadcast:
        placed = values.select("date", _block("row").alias("brow"), _block("col").alias("bcol"), _bit(F.col("row")).alias("line"), _bit(F.col("col")).alias("bit"), v.alias("v"))
        met = placed.join(F.broadcast(blocks), ["brow", "bcol"], "left")
        # a cell of a block outside the basin counts for no basin
        hit = F.expr("shiftright(bits[line], bit) & 1L") == 1
        return met.groupBy("date", F.when(hit, F.col("basin")).alias("basin")).agg(F.coalesce(F.sum("v"), F.lit(0.0)).alias("total"), F.count("v").alias("n"))
    met = _encoded(values, v).join(blocks, ["brow", "bcol"], "left")
    return _partial(met).groupBy("date", "basin").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def zonal_of_sums(sums: DataFrame, basins: DataFrame) -> DataFrame:
    """date, basin, mean, n_valid from zonal_sums, which may be of several parts of a field: every date has every basin."""
    # basins are a map's names: some hundreds, which also become columns
    names = F.array(*[F.lit(r.basin) for r in basins.select("basin").distinct().orderBy("basin").collect()]).cast("array<string>")
    parts = sums.groupBy("date", "basin").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    own = F.collect_list(F.when(F.col("basin").isNotNull(), F.struct("basin", F.struct("total", "n").alias("s"))))
    every = parts.groupBy("date").agg(F.map_from_entries(own).alias("of")).select("date", "of", F.explode(names).alias("basin"))
    s = F.try_element_at("of", F.col("basin"))
    return every.select("date", "basin", F.try_divide(s["total"], s["n"]).alias("mean"), F.coalesce(s["n"], F.lit(0)).alias("n_valid"))


def zonal_mean(values: DataFrame, mask: DataFrame, basins: DataFrame | None = None, column: str = "rainfall") -> DataFrame:
    """date, basin, mean, n_valid: unweighted means of a basin's cells, null where all are missing.

    Every date has every basin, those without cells too if basins (basin) names them."""
    return zonal_of_sums(zonal_sums(values, mask, column), mask if basins is None else basins)


def warnings(zonal: DataFrame) -> DataFrame:
    """The dates and basins without a valid cell, as text."""
    return zonal.where("n_valid = 0").select(F.format_string(NO_DATA, F.col("date").cast("string"), "basin").alias("warning"))


def tidy(zonal: DataFrame) -> DataFrame:
    """Small values as 0 and the rest to two decimals."""
    return zonal.withColumn("mean", geometry.flush_round(F.col("mean")))


def annual_sums(zonal: DataFrame) -> DataFrame:
    """basin, year, total: yearly sums rounded up; a year without values sums to 0."""
    return zonal.groupBy("basin", F.year("date").alias("year")).agg(F.ceil(F.coalesce(F.sum("mean"), F.lit(0.0))).cast("double").alias("total"))


def monthly_climatology(zonal: DataFrame) -> DataFrame:
    """basin, month, mean over years of the month's sums; a month without values sums to 0."""
    sums = zonal.groupBy("basin", F.year("date").alias("year"), F.month("date").alias("month")).agg(F.coalesce(F.sum("mean"), F.lit(0.0)).alias("s"))
    return sums.groupBy("basin", "month").agg(F.avg("s").alias("mean"))


def polygons_of(spark: SparkSession, rings: dict[str, list[list[tuple[float, float]]]]) -> DataFrame:
    return spark.createDataFrame([(name, own) for name, own in rings.items()], "basin string, rings array<array<struct<x:double,y:double>>>")
