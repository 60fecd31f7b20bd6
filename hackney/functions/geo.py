"""Grid, distance and heading expressions over longitude/latitude columns.

Coordinates arrive as FLOAT columns.  Comparisons and arithmetic widen them
to DOUBLE against DOUBLE literals (``F.lit`` of a Python float is DOUBLE,
whereas a SQL literal such as ``74.05`` would be DECIMAL), which is what
places e.g. -73.7f just outside the box.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The NYC bounding box and its grid.
LON_EAST = -73.7
LON_WEST = -74.05
LAT_NORTH = 41.0
LAT_SOUTH = 40.5
DELTA_LON = 0.0014          # cell width in degrees of longitude
DELTA_LAT = 0.00125         # cell height in degrees of latitude
GRID_COLUMNS = 250          # cells per grid row
DEGREE_LENGTH_KM = 110.25   # planar length of one degree

NOT_IN_AREA = -1


def _d(x: float) -> Column:
    return F.lit(float(x))


def in_nyc(lon: Column, lat: Column) -> Column:
    """True when the point lies in the box, edges included."""
    return ((lon >= _d(LON_WEST)) & (lon <= _d(LON_EAST))
            & (lat >= _d(LAT_SOUTH)) & (lat <= _d(LAT_NORTH)))


def grid_x(lon: Column) -> Column:
    """Grid column of a longitude, counted east from the west edge (NULL
    instead of an overflow error for a coordinate far outside any grid)."""
    return F.floor((_d(abs(LON_WEST)) - F.abs(lon)) / _d(DELTA_LON)).try_cast("int")


def grid_y(lat: Column) -> Column:
    """Grid row of a latitude, counted south from the north edge."""
    return F.floor((_d(LAT_NORTH) - lat) / _d(DELTA_LAT)).try_cast("int")


def cell_id(x: Column, y: Column) -> Column:
    return x + F.lit(GRID_COLUMNS) * y


def grid_cell(lon: Column, lat: Column) -> Column:
    """Cell id of a point; not range-checked (see :func:`area_cell`)."""
    return cell_id(grid_x(lon), grid_y(lat))


def area_cell(lon: Column, lat: Column) -> Column:
    """Cell id when the point is inside the box, else -1."""
    return F.when(in_nyc(lon, lat), grid_cell(lon, lat)).otherwise(F.lit(NOT_IN_AREA))


def cell_center_lon(cell: Column) -> Column:
    """Longitude (FLOAT) of a cell's centre."""
    x = cell % F.lit(GRID_COLUMNS)
    west_dist = _d(abs(LON_WEST)) - x * _d(DELTA_LON) - _d(DELTA_LON) / 2
    return west_dist.cast("float") * F.lit(-1.0).cast("float")


def cell_center_lat(cell: Column) -> Column:
    """Latitude (FLOAT) of a cell's centre."""
    x = cell % F.lit(GRID_COLUMNS)
    y = ((cell - x) / F.lit(GRID_COLUMNS)).cast("int")
    return (_d(LAT_NORTH) - y * _d(DELTA_LAT) - _d(DELTA_LAT) / 2).cast("float")


def planar_distance(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Distance in km on a flat projection.

    The coordinate differences are taken in FLOAT.  The cosine is applied to
    the latitude value as given, i.e. degrees read as radians; that is the
    defined measure and is kept.
    """
    dlat = (lat1 - lat2).cast("double")
    dlon = (lon1 - lon2).cast("double") * F.cos(lat2.cast("double"))
    return _d(DEGREE_LENGTH_KM) * F.sqrt(dlat * dlat + dlon * dlon)


def heading(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Integer angle of the way from point 1 to point 2, in -1..359.

    ``trunc(degrees(atan2(dlat, dlon * cos(lat1)))) + 179``, cosine of the
    latitude value read as radians.  A zero-length way where that cosine is
    negative has ``dlon * cos = -0.0``; IEEE ``atan2(+0, -0)`` is pi, but
    Spark's ``atan2`` folds -0.0 into +0.0, so that case is set to 359.
    """
    cos1 = F.cos(lat1.cast("double"))
    dlat = (lat2 - lat1).cast("double")
    dlon = (lon2 - lon1).cast("double") * cos1
    angle = F.degrees(F.atan2(dlat, dlon)).cast("int") + F.lit(179)
    zero_west = (lon1 == lon2) & (lat1 == lat2) & (cos1 < 0)
    return F.when(zero_west, F.lit(359)).otherwise(angle)
