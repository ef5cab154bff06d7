"""Nearest neighbours on a 2-D map, and the competence surface that they give.

Points are counted in the cells of a pyramid of grids, every level halving the cells' sides.  A query starts with the one cell at the top and goes down level by
level.  Its cells, in order of their farthest corner, hold ``k`` points once their counts add up to ``k``; the farthest corner reached then bounds the
k-th distance, and every cell whose nearest edge lies beyond it is dropped.  At the finest level only the cells that the k-th distance reaches are
left, wherever the points are dense or missing, and only their points are paired with the query.
"""

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeline.sources.tables import stored

#: Levels of at most 4 ** COARSE cells are broadcast: their number of rows is bounded by the level.
COARSE = 7
#: Relative room for rounding in the bounds; too many cells cost a little, too few would lose a neighbour.
SLACK = 1 + 1e-9


def _cell(value: Column, low: float, width: float, level: int) -> Column:
    side = 1 << level
    return F.least(F.greatest(F.floor((value - low) / width * side), F.lit(0)), F.lit(side - 1)).cast("long")


def _gap(q: Column, cell: Column, low: float, width: float, level: int) -> tuple[Column, Column]:
    """Least and largest distance along one axis between a query and the points of a cell."""
    side = width / (1 << level)
    a, b = low + cell * side, low + (cell + 1) * side
    return F.greatest(a - q, q - b, F.lit(0.0)), F.greatest(F.abs(q - a), F.abs(q - b))


def pyramid(points: DataFrame, x: str, y: str, k: int) -> tuple[DataFrame, list[DataFrame], tuple]:
    """(points with their finest cell, counts per cell of every level, (left, bottom, width)) of points with a count ``n``."""
    points = stored(points, "map-points")
    box = points.agg(F.min(x), F.max(x), F.min(y), F.max(y), F.count("*")).first()
    low_x, low_y = box[0] or 0.0, box[2] or 0.0
    width = max((box[1] or 0.0) - low_x, (box[3] or 0.0) - low_y) or 1.0
    deepest = max(0, math.ceil(math.log(max(1, box[4] / k), 4)))  # about k points in a cell
    placed = points.withColumns({"__cx": _cell(F.col(x), low_x, width, deepest), "__cy": _cell(F.col(y), low_y, width, deepest)})
    up = placed.groupBy("__cx", "__cy").agg(F.sum("n").alias("__n")).withColumn("__up", F.explode(F.sequence(F.lit(0), F.lit(deepest))))
    shifted = [F.call_function("shiftright", F.col(c), F.col("__up")).alias(c) for c in ("__cx", "__cy")]
    cells = stored(up.groupBy((F.lit(deepest) - F.col("__up")).alias("__level"), *shifted).agg(F.sum("__n").alias("__n")), "map-cells")
    return placed, [cells.where(F.col("__level") == level).drop("__level") for level in range(deepest + 1)], (low_x, low_y, width)


def knn_pairs(queries: DataFrame, points: DataFrame, key: str, x: str, y: str, k: int) -> DataFrame:
    """(key, distance2, and the columns of the points) of the ``k`` nearest points of every query, all at the k-th distance included.

    ``points`` are distinct places with the number ``n`` of points there, so places that many share cost one row; both sides have columns ``x`` and ``y``.
    Rows without a place have no part in it; with fewer than ``k`` points all are neighbours.
    """
    points = points.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    queries = queries.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(key, F.col(x).alias("__qx"), F.col(y).alias("__qy"))
    placed, levels, (low_x, low_y, width) = pyramid(points, x, y, k)
    kept = queries.withColumns({"__cx": F.lit(0).cast("long"), "__cy": F.lit(0).cast("long")})
    for level, cells in enumerate(levels):
        if level:
            half = F.array(F.lit(0), F.lit(1))
            kept = kept.withColumn("__i", F.explode(half)).withColumn("__j", F.explode(half))
            kept = kept.withColumns({"__cx": F.col("__cx") * 2 + F.col("__i"), "__cy": F.col("__cy") * 2 + F.col("__j")}).drop("__i", "__j")
        near_x, far_x = _gap(F.col("__qx"), F.col("__cx"), low_x, width, level)
        near_y, far_y = _gap(F.col("__qy"), F.col("__cy"), low_y, width, level)
        kept = kept.join(F.broadcast(cells) if level <= COARSE else cells, ["__cx", "__cy"])
        kept = kept.withColumns({"__near": near_x * near_x + near_y * near_y, "__far": far_x * far_x + far_y * far_y})
        mine = Window.partitionBy(key)  # the cells of one query that its k-th distance can reach
        nearest_first = mine.orderBy("__far", "__cx", "__cy").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        kept = kept.withColumn("__sum", F.sum("__n").over(nearest_first))
        kept = kept.withColumn("__bound", F.min(F.when(F.col("__sum") >= k, F.col("__far"))).over(mine))
        kept = kept.where(F.col("__bound").isNull() | (F.col("__near") <= F.col("__bound") * SLACK)).select(key, "__qx", "__qy", "__cx", "__cy")
        if level % 4 == 3:
            kept = stored(kept, "map-queries")
    pairs = kept.join(placed, ["__cx", "__cy"]).drop("__cx", "__cy")
    dx, dy = F.col("__qx") - F.col(x), F.col("__qy") - F.col(y)
    pairs = pairs.withColumn("distance2", dx * dx + dy * dy).drop("__qx", "__qy")
    closer = Window.partitionBy(key).orderBy("distance2").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return pairs.withColumn("__upto", F.sum("n").over(closer)).withColumn(
        "__kth", F.min(F.when(F.col("__upto") >= k, F.col("distance2"))).over(Window.partitionBy(key))).where(
        F.col("__kth").isNull() | (F.col("distance2") <= F.col("__kth"))).drop("__upto", "__kth")


def lattice(spark, side: int) -> DataFrame:
    """Centres of side x side squares of the unit box: cell, x, y."""
    df = spark.range(side * side).withColumnRenamed("id", "cell")
    centre = lambda c: (c + F.lit(0.5)) / F.lit(float(side))
    return df.select("cell", centre(F.pmod("cell", F.lit(side))).alias("x"), centre(F.floor(F.col("cell") / side)).alias("y"))


def competence_surface(df: DataFrame, x: str, y: str, correct: str, queries: DataFrame, key: str, k: int) -> DataFrame:
    """Per query place: its number of neighbours, the share of right ones, and the distance of the farthest.

    The neighbours are the ``k`` nearest rows, with all rows at the k-th distance.  Rows without a place or a verdict are left out; a query without any
    neighbour has no row.  Rows at one place are counted together before anything is paired.
    """
    known = df.where(F.col(correct).isNotNull()).groupBy(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).agg(
        F.count("*").alias("n"), F.sum(F.col(correct).cast("long")).alias("hits"))
    return knn_pairs(queries, known, key, "x", "y", k).groupBy(key).agg(
        F.sum("n").alias("neighbours"), (F.sum("hits") / F.sum("n")).alias("accuracy"), F.sqrt(F.max("distance2")).alias("radius"))
