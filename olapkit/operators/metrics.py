"""Metric time series: (host, metric, timestamp in seconds, value), one value per key."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from olapkit.operators.skew import salted_join

SERIES = ["host", "metric"]
DAY = 86_400
# Slots generated by one task at a time when a grid is filled.
GRID_CHUNK = 100_000


def parse_metric_lines(lines: DataFrame, column: str = "line") -> tuple[DataFrame, DataFrame]:
    """``host/.metric value epoch`` lines as (points, rejected lines)."""
    fields = F.split(column, " ")
    name = F.split(F.get(fields, 0), "/.")
    parsed = lines.select(
        F.col(column).alias("_line"),
        F.get(name, 0).alias("host"),
        F.get(name, 1).alias("metric"),
        F.get(fields, 2).try_cast("int").alias("timestamp"),
        F.get(fields, 1).try_cast("double").alias("value"),
        ((F.size(fields) == 3) & (F.size(name) == 2)).alias("_shaped"),
    )
    good = (
        F.col("_shaped")
        & (F.col("metric") != "")
        & F.col("timestamp").isNotNull()
        & F.col("value").isNotNull()
    )
    good = F.coalesce(good, F.lit(False))
    points = parsed.filter(good).drop("_line", "_shaped")
    return points, parsed.filter(~good).select(F.col("_line").alias(column))


def parse_stat_lines(
    lines: DataFrame, names: Sequence[str], ts: Column, column: str = "line"
) -> DataFrame:
    """Comma-separated numbers as float columns after ``ts``; other lines are skipped."""
    cells = F.split(column, ",")
    values = [F.trim(F.get(cells, i)).try_cast("float").alias(n) for i, n in enumerate(names)]
    typed = lines.filter(F.size(cells) == len(names)).select(ts.alias("ts"), *values)
    whole = F.lit(True)
    for n in names:
        whole = whole & F.col(n).isNotNull()
    return typed.filter(whole)


def metric_ids(points: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The distinct (host, metric) pairs, added to the known ones."""
    found = points.select(*SERIES)
    return (found if known is None else known.select(*SERIES).unionByName(found)).distinct()


def fetch(points: DataFrame, host: str, metric: str, start: int, end: int) -> DataFrame:
    """One series in [start, end], by time."""
    return (
        points.filter(
            (F.col("host") == host)
            & (F.col("metric") == metric)
            & F.col("timestamp").between(start, end)
        )
        .select("timestamp", "value")
        .orderBy("timestamp")
    )


def infer_step(points: DataFrame) -> DataFrame:
    """Per series the smallest gap between neighbouring points, at least 1 second.

    Gaps are found inside each day, which holds at most 86400 distinct seconds
    whatever the size of the series, and then between the last and first points
    of neighbouring days. A series of one point has step 1.
    """
    times = points.select(*SERIES, F.col("timestamp").cast("long").alias("t")).distinct()
    days = times.withColumn("_day", F.floor(F.col("t") / DAY))
    in_day = Window.partitionBy(*SERIES, "_day").orderBy("t")
    per_day = (
        days.withColumn("_gap", F.col("t") - F.lag("t").over(in_day))
        .groupBy(*SERIES, "_day")
        .agg(F.min("_gap").alias("_gap"), F.min("t").alias("_first"), F.max("t").alias("_last"))
    )
    by_day = Window.partitionBy(*SERIES).orderBy("_day")
    gap = F.least("_gap", F.col("_first") - F.lag("_last").over(by_day))
    return (
        per_day.withColumn("_gap", gap)
        .groupBy(*SERIES)
        .agg(F.greatest(F.coalesce(F.min("_gap"), F.lit(1)), F.lit(1)).alias("step"))
    )


def resample(points: DataFrame, steps: DataFrame | int) -> DataFrame:
    """Each series on a grid of its step, from its first point on.

    A slot shows the newest value since the slot before it, else null: a value is
    used once. ``steps`` is (host, metric, step), or one step in seconds for all.
    The points are read twice: for the spans, one row for each series, and for the values.
    """
    t = F.col("timestamp").cast("long")
    spans = points.groupBy(*SERIES).agg(F.min(t).alias("start"), F.max(t).alias("end"))
    if isinstance(steps, DataFrame):
        stepped = spans.join(steps, SERIES)
    else:
        stepped = spans.withColumn("step", F.lit(steps).cast("long"))
    grids = stepped.withColumn("slots", F.ceil((F.col("end") - F.col("start")) / F.col("step")) + 1)
    slot = F.ceil((t - F.col("start")) / F.col("step"))
    values = (
        salted_join(points, grids.select(*SERIES, "start", "step"), SERIES)
        .withColumn("slot", slot)
        .groupBy(*SERIES, "slot")
        .agg(F.max_by("value", t).alias("value"))
    )
    # Pieces of a long grid are spread over tasks before their slots are made.
    pieces = grids.select(
        *SERIES,
        "start",
        "step",
        "slots",
        F.explode(
            F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / GRID_CHUNK))
        ).alias("_piece"),
    ).repartition(*SERIES, "_piece")
    first = F.col("_piece") * GRID_CHUNK
    last = F.least(first + GRID_CHUNK, F.col("slots")) - 1
    grid = pieces.select(
        *SERIES, "start", "step", F.explode(F.sequence(first, last)).alias("slot")
    )
    return grid.join(values, [*SERIES, "slot"], "left").select(
        *SERIES, (F.col("start") + F.col("slot") * F.col("step")).alias("timestamp"), "value"
    )


def _paths(ids: DataFrame) -> DataFrame:
    """Dotted names as arrays of parts; ``.`` and ``/`` both separate."""
    name = F.concat_ws("/", "host", "metric")
    return ids.select(F.split(name, "[./]").alias("parts")).distinct()


def metric_tree(ids: DataFrame) -> DataFrame:
    """Every node of the name tree: (path, depth, is_leaf, children)."""
    steps = _paths(ids).select(
        "parts", F.explode(F.sequence(F.lit(1), F.size("parts"))).alias("depth")
    )
    node = F.array_join(F.slice("parts", F.lit(1), F.col("depth")), ".")
    edges = steps.select(
        node.alias("path"), "depth", F.get("parts", F.col("depth")).alias("child")
    ).distinct()
    return edges.groupBy("path", "depth").agg(F.count("child").alias("children")).select(
        "path", "depth", (F.col("children") == 0).alias("is_leaf"), "children"
    )


def glob_part(part: str) -> str:
    """One level of a pattern as a regular expression: ``*`` and ``{a,b}``."""
    out = []
    for piece in re.split(r"(\*|\{[^{}]*\})", part):
        if piece == "*":
            out.append("[^.]*")
        elif piece.startswith("{"):
            out.append("(?:" + "|".join(re.escape(p) for p in piece[1:-1].split(",")) + ")")
        else:
            out.append(re.escape(piece))
    return "".join(out)


def find(ids: DataFrame, pattern: str) -> DataFrame:
    """Nodes whose path matches a dotted pattern, level by level: (path, is_leaf)."""
    levels = [glob_part(p) for p in re.split("[.]", pattern)]
    wanted = "^" + r"\.".join(levels)
    paths = _paths(ids).filter(F.array_join("parts", ".").rlike(wanted + r"(?:\.|$)"))
    depth = len(levels)
    nodes = paths.filter(F.size("parts") >= depth).select(
        F.array_join(F.slice("parts", 1, depth), ".").alias("path"),
        (F.size("parts") == depth).alias("_ends"),
    )
    return (
        nodes.groupBy("path")
        .agg(F.min("_ends").alias("is_leaf"))
        .filter(F.col("path").rlike(wanted + "$"))
    )
