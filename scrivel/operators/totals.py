"""Income, expense and net totals of a ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrivel.functions.amounts import EXPENSE, INCOME, signed_number


def signed_amount(amount: Column, way: Column) -> Column:
    """Amount with ``+`` or ``-`` by direction; without a direction, or empty, as it is."""
    sign = F.when(way == INCOME, "+").when(way == EXPENSE, "-").otherwise("")
    return F.when(amount != "", F.concat(sign, amount)).otherwise("")


def totals(
    ledger: DataFrame, *by: str, amount: str = "金额", way: str = "收支方向"
) -> DataFrame:
    """Count and exact ``income``, ``expense``, ``net``, over all rows or per ``by``.

    Amounts that are no numbers and rows without direction add nothing. Sums are decimal, so
    they do not depend on the order in which partitions arrive.
    """
    number = signed_number(F.col(amount))
    total = lambda word: F.coalesce(
        F.sum(F.when(F.col(way) == word, number)), F.lit(0).cast("decimal(38,6)")
    )
    summed = ledger.groupBy(*by).agg(
        F.count("*").alias("n_records"),
        total(INCOME).alias("income"),
        total(EXPENSE).alias("expense"),
    )
    return summed.withColumn("net", F.col("income") - F.col("expense"))


def formatted_totals(summed: DataFrame) -> DataFrame:
    """Totals as texts with thousands separators and two decimals."""
    return summed.withColumns({c: F.format_number(c, 2) for c in ("income", "expense", "net")})
