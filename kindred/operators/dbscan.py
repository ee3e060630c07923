"""Density clustering on distinct weighted points."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.fixed import DBSCAN_EPS, DBSCAN_MIN_SAMPLES
from kindred.operators.components import components
from kindred.operators.order_stats import with_position
from kindred.sources.staging import cut

# A column with more values than this is not tested for gaps.
GAP_VALUES = 64
# Columns by whose cells adjoining cells are looked up; each multiplies the probes by three.
GRID_COLUMNS = 2


def _column_kinds(points: DataFrame, eps: float) -> tuple[list[int], list[int]]:
    """Columns whose values all lie more than eps apart, and the others, widest first.

    Neighbours agree on every column of the first kind, so those make an exact
    join key.  Columns of 0/1 features are of this kind for small eps.
    """
    cells = points.select(F.posexplode("vector").alias("c", "v")).groupBy("c", "v").agg(F.count("*").alias("n"))
    per = cells.groupBy("c").agg(F.count("*").alias("values"), (F.max("v") - F.min("v")).alias("width"))
    few = cells.join(per.where(F.col("values") <= GAP_VALUES), "c")  # 64 values per column
    step = F.col("v") - F.lag("v").over(Window.partitionBy("c").orderBy("v"))
    gaps = few.select("c", step.alias("step")).groupBy("c").agg(F.min("step").alias("gap"))
    rows = per.join(gaps, "c", "left").select("c", "width", "gap", "values").collect()  # one per column
    apart = sorted(r.c for r in rows if r["values"] == 1 or (r.gap is not None and r.gap > eps))
    others = sorted((r for r in rows if r.c not in set(apart)), key=lambda r: (-r.width, r.c))
    return apart, [r.c for r in others]


def _squared_distance(a: str, b: str) -> Column:
    parts = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(parts, F.lit(0.0), lambda total, v: total + v)


def _cells(points: DataFrame, eps: float) -> tuple[DataFrame, DataFrame]:
    """Points with the cell they lie in and its weight, and the pairs of cells that adjoin.

    A cell holds points with equal gap columns that lie in one cube whose diagonal is eps, so
    they are all neighbours.  It is named by its first point.  ``(cell, other)`` lists, in both
    directions, the cells that may hold neighbours of each other.
    """
    apart, others = _column_kinds(points, eps)
    width = eps / math.sqrt(max(1, len(others))) * (1 - 1e-9)
    reach = math.ceil(eps / width)
    v = F.col("vector")
    dealt = points.select(
        "pid",
        "vector",
        "weight",
        F.array(*[F.element_at(v, c + 1) for c in apart]).cast("array<double>").alias("key"),
        F.array(*[F.floor(F.element_at(v, c + 1) / width) for c in others]).cast("array<bigint>").alias("index"),
    )
    cells = cut(dealt.groupBy("key", "index").agg(F.min("pid").alias("cell"), F.sum("weight").alias("mass")))
    placed = dealt.join(cells, ["key", "index"]).select("pid", "vector", "weight", "cell", "mass")

    grid = [f"g{i}" for i in range(min(GRID_COLUMNS, len(others)))]
    coarse = cells.select("cell", "key", "index", *[F.floor(F.col("index")[i] / reach).alias(g) for i, g in enumerate(grid)])
    probes = coarse
    for g in grid:
        probes = probes.withColumn(g, F.explode(F.array(*[F.col(g) + d for d in (-1, 0, 1)])))
    targets = coarse.select(F.col("cell").alias("other"), "key", F.col("index").alias("other_index"), *grid)
    steps = F.zip_with("index", "other_index", lambda x, y: F.greatest(F.abs(x - y) - 1, F.lit(0)))
    least = F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, x: total + x * x)
    beside = probes.join(targets, ["key", *grid]).where((F.col("cell") != F.col("other")) & (least <= (eps / width) ** 2))
    return placed, beside.select("cell", "other")


def dbscan(
    points: DataFrame, *, eps: float = DBSCAN_EPS, min_samples: int = DBSCAN_MIN_SAMPLES
) -> DataFrame:
    """``(pid, cluster)``; noise is -1.

    ``points(pid, vector, weight)`` holds distinct points with the number of rows
    each stands for, the point itself included in its own neighbourhood.  Clusters
    are numbered by their first core point; a border point joins the first cluster
    it touches.

    A cell of weight ``min_samples`` or more is all core and one node of the graph: its points are
    not compared with each other, and two such cells are linked if a point of one has a
    neighbour in the other.  Only the points of lighter cells list their neighbours.
    """
    points = cut(points.select("pid", "vector", "weight"))
    placed, beside = (cut(df) for df in _cells(points, eps))
    is_close = _squared_distance("vector", "q_vector") <= eps * eps

    def met(left: DataFrame, right: DataFrame, value: str) -> DataFrame:
        """Rows of ``left`` with ``q``, a value of each neighbour in adjoining cells of ``right``."""
        near = right.select(F.col("cell").alias("other"), F.col("vector").alias("q_vector"), F.col(value).alias("q"))
        return left.join(beside, "cell").join(near, "other").where(is_close)

    is_dense = F.col("mass") >= min_samples
    light = placed.where(~is_dense)
    around = met(light, placed, "weight").groupBy("pid").agg(F.sum("q").alias("_around"))
    found = light.join(around, "pid", "left").where(F.col("mass") + F.coalesce("_around", F.lit(0)) >= min_samples)
    core = cut(
        placed.where(is_dense)
        .select("pid", "vector", "cell", F.col("cell").alias("node"), F.lit(True).alias("dense"))
        .unionByName(found.select("pid", "vector", "cell", F.col("pid").alias("node"), F.lit(False).alias("dense")))
    )
    dense, single = core.where("dense"), core.where("not dense")
    ahead = beside.where("cell < other")
    reached = dense.select(F.col("cell").alias("other"), F.col("vector").alias("q_vector"))
    across = dense.select("cell", "vector").join(ahead, "cell").join(reached, (ahead["other"] == reached["other"]) & is_close, "left_semi")
    same_cell = Window.partitionBy("cell")  # fewer than min_samples rows
    edges = (
        across.select(F.col("cell").alias("a"), F.col("other").alias("b"))
        .union(met(single, core, "node").select("node", "q"))
        .union(single.select("node", F.min("node").over(same_cell)))
        .distinct()
    )
    labelled = components(core.select(F.col("node").alias("pid")).distinct(), edges)
    named = cut(core.join(labelled.withColumnRenamed("pid", "node"), "node").select("pid", "vector", "cell", "component"))
    weak = light.join(core.select("pid"), "pid", "left_anti")
    own = named.groupBy("cell").agg(F.min("component").alias("component"))
    border = (
        met(weak, named, "component").select("pid", F.col("q").alias("component"))
        .union(weak.join(own, "cell").select("pid", "component"))
        .groupBy("pid")
        .agg(F.min("component").alias("component"))
    )
    numbers = with_position(named.select("component").distinct(), "component", "cluster")
    told = named.select("pid", "component").unionByName(border).join(numbers, "component").select("pid", "cluster")
    return points.select("pid").join(told, "pid", "left").select("pid", F.coalesce("cluster", F.lit(-1)).alias("cluster"))
