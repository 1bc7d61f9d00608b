"""Tables landed so that later reads open only the files they need.

By date: a folder for each day, month or year. By place: a folder for each tile of the world,
and within it rows in the order of their cell along a Z-order curve, so that a file and each
row group of it covers few cells. Reads give the rows that the plain filters give; folders are
left out by partition filters, and row groups by the filters that are pushed to the scan.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seepline import vocab
from seepline.operators import filters

DAY, TILE, CELL = "landed_day", "tile", "cell"
#: bits of a cell's row and column; a cell is about 20 m high
BITS = 20
#: bits of a tile's row and column; a tile is about 2.8 degrees high
TILE_BITS = 6
#: runs of cells that a circle or box is covered by, at most
RANGES = 48
_SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


# --- by date -------------------------------------------------------------------


def land_by_date(df: DataFrame, path: str, column: str = "activitystartdate", unit: str = "month") -> None:
    """Write ``df`` with a folder for each ``unit`` (day, month or year) of ``column``. Rows
    without a date have a folder of their own. Rebalancing splits a hot month over files."""
    placed = df.withColumn(DAY, F.trunc(F.col(column).cast("date"), unit) if unit != "day" else F.col(column).cast("date"))
    placed.hint("rebalance", DAY).sortWithinPartitions(DAY, column).write.partitionBy(DAY).parquet(path)


def landed_dates(
    spark: SparkSession, path: str, low: str, high: str, column: str = "activitystartdate", unit: str = "month"
) -> DataFrame:
    """Rows from ``low`` to ``high``, as ``portal_dates`` gives them; only folders of the range are read."""

    def begin(day: str) -> Column:
        date = F.lit(day).cast("date")
        return date if unit == "day" else F.trunc(date, unit)

    rows = spark.read.parquet(path).where(F.col(DAY).cast("date").between(begin(low), begin(high)))
    return filters.portal_dates(rows, low, high, column).drop(DAY)


# --- by place ------------------------------------------------------------------


def _spread(c: Column) -> Column:
    """A zero between any two bits."""
    for shift, mask in _SPREAD:
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask))
    return c


def cell_of(lat: Column, lon: Column) -> Column:
    """The cell of a point, NULL without one. Longitudes go round the world."""
    size = 1 << BITS
    east = F.pmod(lon.cast("double") + 180.0, F.lit(360.0))
    x = F.least(F.floor(east / 360.0 * size).cast("long"), F.lit(size - 1))
    y = F.greatest(F.lit(0), F.least(F.floor((lat.cast("double") + 90.0) / 180.0 * size).cast("long"), F.lit(size - 1)))
    # no number is no place
    known = lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat.cast("double")) & ~F.isnan(lon.cast("double"))
    return F.when(known, _spread(x).bitwiseOR(F.shiftleft(_spread(y), 1)))


def _tile(cell: Column) -> Column:
    return F.shiftright(cell, 2 * (BITS - TILE_BITS))


def land_by_place(df: DataFrame, path: str, lat: str = "latitude", lon: str = "longitude") -> None:
    """Write ``df`` with a folder for each tile, rows in the order of their cells. Files are
    ranges of cells, so that a tile with most of the rows is many files; rows without
    coordinates have a folder of their own."""
    placed = df.withColumn(CELL, cell_of(F.col(lat), F.col(lon))).withColumn(TILE, _tile(F.col(CELL)))
    # cells that hold very many rows, and rows without one, are dealt by their other columns
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    placed.repartitionByRange(F.col(CELL), spread).sortWithinPartitions(TILE, CELL).write.partitionBy(TILE).parquet(path)


def _angle(lat1: float, lat2: float, turn: float) -> float:
    """Great-circle angle, all in radians."""
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin(turn / 2) ** 2
    return 2 * math.asin(math.sqrt(min(1.0, h)))


def _distance(lat: float, lon: float, box: tuple[float, float, float, float]) -> float:
    """The least angle, in radians, from a point to a box of degrees (south, west, north, east)."""
    south, west, north, east = box
    offset = (lon - west) % 360.0
    here = math.radians(lat)
    if offset <= east - west:
        return abs(here - math.radians(min(max(lat, south), north)))
    best = math.inf
    for side in (west, east):
        turn = math.radians(abs((lon - side + 180.0) % 360.0 - 180.0))
        ends = [math.radians(south), math.radians(north)]
        # where the side, carried on to the poles, is nearest or farthest
        turned = math.atan2(math.sin(here), math.cos(here) * math.cos(turn))
        for at in (turned, turned - math.pi, turned + math.pi):
            if ends[0] < at < ends[1]:
                ends.append(at)
        best = min(best, *(_angle(here, at, turn) for at in ends))
    return best


def _cover(meets, inside, most: int) -> list[tuple[int, int]]:
    """Runs of cells, first and last, that hold every box which ``meets``: squares of the curve
    are quartered, the largest first, while there are few; those ``inside`` stay whole."""
    squares, done = [(0, 0)], []  # level and number along the curve
    for level in range(BITS):
        if len(done) + 4 * len(squares) > 2 * most and level > 2:
            break
        nexts = []
        for _, number in squares:
            for quarter in range(4 * number, 4 * number + 4):
                box = _box(level + 1, quarter)
                if meets(box):
                    (done if inside(box) else nexts).append((level + 1, quarter))
        squares = nexts
    runs = sorted((n << 2 * (BITS - k), ((n + 1) << 2 * (BITS - k)) - 1) for k, n in [*squares, *done])
    out: list[list[int]] = []
    for a, b in runs:
        if out and a == out[-1][1] + 1:
            out[-1][1] = b
        else:
            out.append([a, b])
    while len(out) > most:  # over the smallest gap
        k = min(range(1, len(out)), key=lambda i: out[i][0] - out[i - 1][1])
        out[k - 1][1] = out[k][1]
        del out[k]
    return [(a, b) for a, b in out]


def _box(level: int, number: int) -> tuple[float, float, float, float]:
    x = y = 0
    for i in range(level):
        x |= (number >> (2 * i) & 1) << i
        y |= (number >> (2 * i + 1) & 1) << i
    wide, high = 360.0 / (1 << level), 180.0 / (1 << level)
    return -90 + y * high, -180 + x * wide, -90 + (y + 1) * high, -180 + (x + 1) * wide


def circle_cells(lat: float, lon: float, miles: float, most: int = RANGES) -> list[tuple[int, int]]:
    """Runs of cells that hold every point within ``miles`` of a point."""
    reach = miles / vocab.EARTH_RADIUS_MILES * (1 + 1e-9) + 1e-9

    def inside(box):
        # the farthest point of a box is as near as the point opposite its farthest point
        return math.pi - _distance(-lat, lon + 180.0, box) <= reach * (1 - 1e-6)

    return _cover(lambda box: _distance(lat, lon, box) <= reach, inside, most)


def box_cells(west: float, south: float, east: float, north: float, most: int = RANGES) -> list[tuple[int, int]]:
    """Runs of cells that hold every point of a box; longitudes may be given beyond 180."""
    if west > east or south > north:
        return []
    south, north = (min(max(x, -90.0), 90.0) for x in (south, north))
    turned = [(max(west + k, -180.0), min(east + k, 180.0)) for k in (-360.0, 0.0, 360.0)]
    spans = [(w, e) for w, e in turned if w <= e]

    def meets(box):
        return box[0] <= north and box[2] >= south and any(box[1] <= e and box[3] >= w for w, e in spans)

    def inside(box):
        return box[0] >= south and box[2] <= north and any(box[1] >= w and box[3] <= e for w, e in spans)

    return _cover(meets, inside, most)


def _in_cells(spark: SparkSession, path: str, runs: list[tuple[int, int]]) -> DataFrame:
    rows = spark.read.parquet(path)
    if not runs:
        return rows.where(F.lit(False))
    shift = 2 * (BITS - TILE_BITS)
    tiles = reduce(lambda a, b: a | b, [F.col(TILE).between(a >> shift, b >> shift) for a, b in runs])
    cells = reduce(lambda a, b: a | b, [F.col(CELL).between(a, b) for a, b in runs])
    return rows.where(tiles & cells)


def landed_radius(spark: SparkSession, path: str, distance: float, unit: str, lat: float, lon: float) -> DataFrame:
    """Stations within a great-circle distance, as ``portal_radius`` gives them."""
    runs = circle_cells(lat, lon, distance * vocab.MILES_PER_UNIT[unit])
    return filters.portal_radius(_in_cells(spark, path, runs), distance, unit, lat, lon).drop(CELL, TILE)


def landed_bbox(spark: SparkSession, path: str, west: float, south: float, east: float, north: float) -> DataFrame:
    """Stations in a box of degrees, as ``portal_bbox`` gives them."""
    return filters.portal_bbox(_in_cells(spark, path, box_cells(west, south, east, north)), west, south, east, north).drop(CELL, TILE)
