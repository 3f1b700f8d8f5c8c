"""Joins and scans that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def skew_join(rows: DataFrame, per_key: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` to a table with at most one row per key, in a form that adaptive execution can split.

    It splits a partition that is far larger than others, whatever key fills it, and gives each part the
    key's row; how large is up to ``spark.sql.adaptive.skewJoin.*``. That takes plain shuffles on
    both sides. ``per_key`` mostly comes out of an aggregate by the key and would be joined where it
    is, so the join is on the key as a struct, which no table is partitioned by. Null keys meet.
    """
    right = per_key.withColumnRenamed(key, "__key")
    same = F.struct(F.col(key).alias("key")) == F.struct(F.col("__key").alias("key"))
    return rows.join(right, same, how).drop("__key")


def running(
    points: DataFrame, keys: list[str], position: str, chunk: int, value: Column, kind: str, out: str,
    before: bool = False,
) -> DataFrame:
    """Running ``sum`` or ``max`` of ``value`` per key in order of ``position``, with the point itself or,
    if ``before``, without it.

    A plain window would sort all points of a key in one task. Here each task scans ``chunk``
    consecutive positions, a window over one row per chunk carries the result across, and
    an equi-join brings it back. ``position`` is an integer, unique within a key.
    """
    fold = {"sum": F.sum, "max": F.max}[kind]
    parted = points.withColumn("__chunk", F.floor(F.col(position) / F.lit(chunk))).withColumn(
        "__value", value
    )
    inside = Window.partitionBy(*keys, "__chunk").orderBy(position)
    frame = inside.rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    local = parted.withColumn("__local", fold("__value").over(frame))
    across = Window.partitionBy(*keys).orderBy("__chunk")
    carried = (
        parted.groupBy(*keys, "__chunk")
        .agg(fold("__value").alias("__total"))
        .withColumn(
            "__carry", fold("__total").over(across.rowsBetween(Window.unboundedPreceding, -1))
        )
        .drop("__total")
    )
    if kind == "sum":
        total = F.coalesce(F.col("__local"), F.lit(0)) + F.coalesce(F.col("__carry"), F.lit(0))
    else:
        total = F.greatest("__local", "__carry")
    return (
        local.join(carried, [*keys, "__chunk"])
        .withColumn(out, total)
        .drop("__chunk", "__value", "__local", "__carry")
    )
