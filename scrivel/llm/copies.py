"""Rows that are alike: counted before they are numbered, and one of each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrivel.llm.landing import landed

#: Copies of one row that a task writes out at once.
COPIES = 100_000


def written_out(rows: DataFrame, keys: list[str], before: str, copies: str, nth: str = "nth", most: int | None = None) -> DataFrame:
    """Each row as often as ``copies`` says, with ``nth`` counted on from ``before`` + 1 in place of both.

    Very many copies are written out by several tasks; ``keys`` tell the rows apart.
    """
    most = most or COPIES
    step = F.lit(most)
    blocks = rows.withColumn("__low", F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1, step)))
    dealt = blocks.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, "__low")
    last = F.least(F.col("__low") + step, F.col(copies)) - 1
    each = dealt.withColumn("__i", F.explode(F.sequence("__low", last)))
    return each.withColumn("__nth", F.col(before) + F.col("__i") + 1).drop("__low", "__i", before, copies).withColumnRenamed("__nth", nth)


def one_of_each(rows: DataFrame, key: str) -> DataFrame:
    """One row, any, of those that have a ``key`` in common, which is never null.

    Only keys are counted; rows whose key is their own stay where they are, and the others meet in sums that tasks
    begin with.
    """
    keys = landed(rows.groupBy(key).agg(F.count("*").alias("__n")).filter("__n > 1").select(key), "alike")
    if keys.isEmpty():
        return rows
    names = [F.col(f"`{c}`") for c in rows.columns]
    several = rows.join(keys, key, "left_semi").select(*names)
    first = several.groupBy(key).agg(F.first(F.struct(*names)).alias("__row")).select("__row.*")
    return rows.join(keys, key, "left_anti").select(*names).unionByName(first)
