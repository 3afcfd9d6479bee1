"""Hierarchical cells.

``H3`` ids are handled by bit arithmetic where that is enough (parents). Points are put on
``grid`` cells, a square grid whose parents are integer divisions; its ids are *not* H3 ids.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Resolution at which a grid cell is one degree wide.
DEGREE = 3


def h3_parent(cell: Column, resolution: int) -> Column:
    """Parent of an H3 cell (15 hexadecimal digits): the resolution's bits set, the finer digits all ones."""
    number = F.conv(cell, 16, 10).cast("long")
    ones = (1 << ((15 - resolution) * 3)) - 1
    out = number.bitwiseAND(F.lit(~(15 << 52))).bitwiseOR(F.lit(resolution << 52)).bitwiseOR(F.lit(ones))
    return F.lower(F.hex(out))


def _steps(c: Column, offset: int, resolution: Column) -> Column:
    return F.floor((c + offset) * F.pow(F.lit(2.0), resolution - DEGREE)).cast("long")


def _name(resolution: Column, row: Column, column: Column) -> Column:
    return F.concat_ws("-", resolution.cast("string"), row.cast("string"), column.cast("string"))


def grid_cell(lat: Column, lon: Column, resolution: Column) -> Column:
    """Name of the grid cell of a point: resolution, row, column."""
    return _name(resolution, _steps(lat, 90, resolution), _steps(lon, 180, resolution))


def _part(cell: Column, k: int) -> Column:
    return F.split_part(cell, F.lit("-"), F.lit(k)).cast("long")


def grid_parent(cell: Column, resolution: Column) -> Column:
    finer = (_part(cell, 1) - resolution).cast("int")
    return _name(resolution, F.call_function("shiftright", _part(cell, 2), finer), F.call_function("shiftright", _part(cell, 3), finer))


def grid_centre(cell: Column) -> tuple[Column, Column]:
    """Latitude and longitude of a cell's centre."""
    width = F.pow(F.lit(2.0), DEGREE - _part(cell, 1))
    return (_part(cell, 2) + 0.5) * width - 90, (_part(cell, 3) + 0.5) * width - 180


def grid_boundary(cell: Column) -> Column:
    """The corners of a cell as (lat, lon), from the south-west round by the south-east."""
    lat, lon = grid_centre(cell)
    half = F.pow(F.lit(2.0), DEGREE - _part(cell, 1)) / 2
    return F.array(*(F.struct((lat + y * half).alias("lat"), (lon + x * half).alias("lon")) for y, x in ((-1, -1), (-1, 1), (1, 1), (1, -1))))


def viewport_zoom(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Zoom that shows a box: 7 less the binary logarithm of its larger span, from 4 to 7."""
    span = F.greatest(east - west, north - south)
    return F.greatest(F.lit(4.0), F.least(F.lit(7.0), 7 - F.log2(span)))
