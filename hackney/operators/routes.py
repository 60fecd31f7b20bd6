"""Grid cells on the straight way between pickup and dropoff.

The walk is a native higher-order fold (``aggregate`` over a step
sequence), no Python UDF.  Folds are interpreted rather than codegen'd, so
each distinct endpoint-cell pair is walked once:

* ``cell_traffic``: count trips per pair (partial aggregation, so a hot pair
  costs one row per task), walk each pair, explode, sum per cell.
* ``trip_route_cells``: walk the distinct pairs, equi-join the trips to the
  walks (one row a pair) on the four cell coordinates, and ``posexplode``
  after the join, so that a walk's cells are not shuffled.  The number of distinct pairs has no small proven
  bound (up to cells squared), so the join is sort-merge, never broadcast;
  AQE's skew handling splits the trip side of a pair that dominates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.functions.geo import GRID_COLUMNS, grid_x, grid_y, in_nyc

# The walk's tolerances.
SLOPE_EPSILON = 0.00000001   # added to the column span before dividing
BAND = 0.05                  # |y - row| below this takes a diagonal step

PAIR = ["x1", "y1", "x2", "y2"]


def _d(x: float) -> Column:
    return F.lit(float(x))


def walk_cells(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Array of cell ids visited walking from cell (x1,y1) to (x2,y2).

    The walk starts at whichever end has the smaller column.  With ``s`` the
    slope ``dy / (dx + 1e-8)`` and ``c`` the current column offset, the ideal
    row is ``(c + 0.5) * s + startY -/+ 0.5`` (rising/otherwise).  Rising:
    within 0.05 of the current row step diagonally, below it step a column,
    else step a row.  Otherwise: within 0.05 step diagonally (row up), then,
    with the new row, step a column if the ideal row is above it, else a row
    up.  The walk stops once the column is >= the end column and the row
    equals the end row; ``dx + |dy| + 1`` steps always suffice (each step
    moves at least one unit toward the end; see tests).
    """
    swap = x1 > x2
    sx, sy = F.when(swap, x2).otherwise(x1), F.when(swap, y2).otherwise(y1)
    ex, ey = F.when(swap, x1).otherwise(x2), F.when(swap, y1).otherwise(y2)
    slope = (ey - sy).cast("double") / ((ex - sx).cast("double") + _d(SLOPE_EPSILON))
    rising = slope > _d(0.0)
    n_steps = (ex - sx) + F.abs(ey - sy) + F.lit(1)
    g = F.lit(GRID_COLUMNS)

    def step(acc: Column, _i: Column) -> Column:
        # The state holds the current cell and the cells visited before it;
        # a step appends the current cell and moves, so the next position is
        # evaluated once per step.
        x, y = acc["x"], acc["y"]
        base = (x - sx).cast("double") + _d(0.5)
        # rising branch
        yr = base * slope + sy.cast("double") - _d(0.5)
        band_r = (yr > y.cast("double") - _d(BAND)) & (yr < y.cast("double") + _d(BAND))
        below = yr < y.cast("double")
        rx = F.when(band_r | below, x + 1).otherwise(x)
        ry = F.when(band_r | ~below, y + 1).otherwise(y)
        # flat / falling branch: optional diagonal, then a second step
        yf = base * slope + sy.cast("double") + _d(0.5)
        band_f = (yf > y.cast("double") - _d(BAND)) & (yf < y.cast("double") + _d(BAND))
        fx1 = F.when(band_f, x + 1).otherwise(x)
        fy1 = F.when(band_f, y - 1).otherwise(y)
        above = yf > fy1.cast("double")
        fx = F.when(above, fx1 + 1).otherwise(fx1)
        fy = F.when(above, fy1).otherwise(fy1 - 1)
        going = (x < ex) | (y != ey)
        moved = F.struct(F.when(rising, rx).otherwise(fx).alias("x"),
                         F.when(rising, ry).otherwise(fy).alias("y"),
                         F.concat(acc["cells"], F.array(x + g * y)).alias("cells"))
        return F.when(going, moved).otherwise(acc)

    init = F.struct(sx.alias("x"), sy.alias("y"),
                    F.array().cast("array<int>").alias("cells"))
    return F.aggregate(F.sequence(F.lit(1), n_steps), init, step,
                       lambda acc: F.concat(acc["cells"], F.array(acc["x"] + g * acc["y"])))


def with_endpoints(trips: DataFrame, keep: tuple[str, ...] = ("seq", "key")) -> DataFrame:
    """Trips whose pickup and dropoff both lie in the box, with endpoint
    cell coordinates ``x1, y1, x2, y2``."""
    def part(loc, i):   # gridded as FLOAT, whatever the input width
        return F.get(F.col(loc), i).cast("float")
    p0, p1 = part("pickup_location", 0), part("pickup_location", 1)
    d0, d1 = part("dropoff_location", 0), part("dropoff_location", 1)
    inside = in_nyc(p0, p1) & in_nyc(d0, d1)
    return (trips.where(inside)
                 .select(*keep, grid_x(p0).alias("x1"), grid_y(p1).alias("y1"),
                         grid_x(d0).alias("x2"), grid_y(d1).alias("y2")))


def trip_route_cells(trips: DataFrame, keep: tuple[str, ...] = ("seq", "key")) -> DataFrame:
    """``keep`` + ``pos`` + ``cell``: one row per cell on each trip's way.

    The trip endpoints feed two branches (distinct pairs, and the join), so
    they are checkpointed once into the shared checkpoint folder: one pass
    over the source, and a lineage cut that a lost executor cannot undo.
    """
    ends = with_endpoints(trips, keep).checkpoint(eager=True)
    # The outer form, as the inner one adds a filter on the walk's size, which
    # Catalyst pushes below the distinct: a walk per trip.  No walk is empty.
    walks = (_spread(ends.select(*PAIR).distinct())
             .select(*PAIR, walk_cells(*[F.col(c) for c in PAIR]).alias("_walk")))
    return (ends.join(walks.hint("merge"), on=PAIR, how="inner")
                .select(*keep, F.posexplode_outer("_walk").alias("pos", "cell")))


def _spread(pairs: DataFrame) -> DataFrame:
    """Pairs are few bytes but long walks: a set number of partitions, which
    AQE does not merge by size.  By a hash of the pair: a repartition on the
    grouping's own columns would be dropped as done already."""
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.repartition(n, F.xxhash64(*PAIR))


def cell_traffic(trips: DataFrame) -> DataFrame:
    """``cell, trips``: number of trips whose way passes each cell."""
    pairs = (with_endpoints(trips, keep=())
             .groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n")))
    walked = _spread(pairs).select(F.explode(walk_cells(*[F.col(c) for c in PAIR])).alias("cell"), "n")
    return walked.groupBy("cell").agg(F.sum("n").alias("trips"))
