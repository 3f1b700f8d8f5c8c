"""Column sets and files of ledgers, transactions and rosters."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrivel.operators.elements import cards, note_or
from scrivel.operators.statements import LEDGER_COLUMNS
from scrivel.operators.totals import signed_amount

# The columns of a transaction table and of a roster file, in order.
TRANSACTION_COLUMNS = (
    "交易时间", "对方名称", "收支方向", "金额", "余额", "付款银行", "付款账号", "收款银行",
    "收款账号", "交易卡号", "转账附言", "银行交易类型",
)
ROSTER_COLUMNS = ("序号", "姓名", "备注")

# A byte order mark in front of the first column name starts every file with it.
_BOM = "﻿"


def transaction_table(records: DataFrame, *keys: str) -> DataFrame:
    """The twelve columns of a transaction table, amounts signed by direction."""
    signed = signed_amount(F.col("金额"), F.col("收支方向"))
    return records.withColumn("金额", signed).select(*keys, *TRANSACTION_COLUMNS)


def ledger_table(ledger: DataFrame, *keys: str) -> DataFrame:
    """Priority columns first, other ones after them in their order, '' for what is missing.

    The columns are those of the ledger, whatever values it has; select fewer beforehand to leave some out.
    """
    ranked = [c for c in LEDGER_COLUMNS if c in ledger.columns]
    columns = ranked + [c for c in ledger.columns if c not in ranked and c not in keys]
    return ledger.select(*keys, *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns))


def found_names(entries: DataFrame, order: tuple[str, ...], columns: list[str], extras: str, most: int) -> list[str]:
    """Columns with a value and keys of ``extras``, in the order in which the entries, in ``order``, show them first.

    Tasks keep one place for each kind of entry, told by its columns and a key of its map; a table of more than ``most`` names is refused.
    """
    order_of = [F.col(f"`{c}`") for c in order]
    given = [F.col(f"`{c}`").isNotNull().cast("int").alias(f"__given{i}") for i, c in enumerate(columns)]
    # One row for each key of the map, or one without a key: the columns of an entry stand beside it as marks, not in rows of their own.
    keys = F.posexplode_outer(F.map_keys(F.col(f"`{extras}`"))).alias("__nth", "__key")
    marks = [f"__given{i}" for i in range(len(columns))]
    marked = entries.select(F.struct(*order_of).alias("__first"), *given, keys)
    kinds = marked.groupBy(*marks, "__nth", "__key").agg(F.min("__first").alias("__first"))
    before = [sum((F.col(m) for m in marks[:i]), F.lit(0)) for i in range(len(columns) + 1)]
    name = lambda shown, name, at: F.struct(F.when(shown, name).alias("__name"), at.alias("__at"))
    shown = [name(F.col(m) > 0, F.lit(c), before[i]) for i, (m, c) in enumerate(zip(marks, columns, strict=True))]
    shown.append(name(F.col("__key").isNotNull(), F.col("__key"), before[-1] + F.col("__nth")))
    seen = kinds.select("__first", F.inline(F.array(*shown))).filter(F.col("__name").isNotNull())
    places = seen.groupBy("__name").agg(F.min(F.struct("__first", "__at")).alias("__place"))
    names = [r["__name"] for r in places.orderBy("__place").limit(most + 1).collect()]
    if len(names) > most:
        raise ValueError(f"more than {most} columns")
    return names


def entry_table(
    entries: DataFrame, order: tuple[str, ...], keys: tuple[str, ...] = (), extras: str = "extras", most: int = 1000
) -> DataFrame:
    """A table with a column for every key that any entry has: the priority ones first, the others as they are seen first in ``order``,
    '' for what is missing.

    An entry has the columns that are not null, and what its map ``extras`` holds; a column goes before a map's value of its
    name. ``keys`` are put in front as they are, ``order`` is left out unless it is among them. Finding the names takes a
    job over the entries, so the columns are those of the entries at that time. Without entries there are no columns beside ``keys``.
    """
    columns = [c for c in entries.columns if c not in (*order, *keys, extras)]
    names = found_names(entries, order, columns, extras, most)
    if clash := set(names) & set(keys):
        raise ValueError(f"entries have keys named as columns: {sorted(clash)}")
    ranked = [c for c in LEDGER_COLUMNS[:-1] if c in names]
    ranked += [c for c in names if c not in ranked]
    extra = lambda name: F.try_element_at(F.col(f"`{extras}`"), F.lit(name))
    value = lambda name: F.coalesce(*([F.col(f"`{name}`")] if name in columns else []), extra(name), F.lit(""))
    return entries.select(*(F.col(f"`{c}`") for c in keys), *(value(name).alias(name) for name in ranked))


def _sorted(table: DataFrame, order: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    """The table in that order, files following each other; and its columns without those that only order it."""
    columns = [c for c in table.columns if c not in order]
    return (table.orderBy(*order) if order else table), columns


def csv_lines(table: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """The lines of a CSV file as ``value``, in partitions that follow each other; the first one is the header with the byte order mark."""
    options = {"escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows, columns = _sorted(table, order)
    spark = table.sparkSession
    names = spark.range(1, numPartitions=1).select(*(F.lit(c).alias(f"c{i}") for i, c in enumerate(columns)))
    header = names.select(F.concat(F.lit(_BOM), F.to_csv(F.struct("*"), options)).alias("value"))
    line = F.to_csv(F.struct(*(F.col(f"`{c}`") for c in columns)), options)
    return header.unionAll(rows.select(line.alias("value")))


def write_csv(table: DataFrame, path: str, order: tuple[str, ...] = ()) -> None:
    """UTF-8 CSV, one file in parts: joined in order of their names they have one byte order mark and one header.

    Values are quoted where they have to be. Rows come in the order of the columns ``order``, such as the path of the image; these are not
    written. The parts are there once Spark has committed all of them.
    """
    csv_lines(table, order).write.mode("overwrite").text(path)


def write_json(table: DataFrame, path: str, order: tuple[str, ...] = ()) -> None:
    """JSON lines; non-ASCII text stays as it is, null fields are written out. ``order`` as in :func:`write_csv`."""
    rows, columns = _sorted(table, order)
    rows.select(*columns).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def roster_csv_rows(found: DataFrame) -> DataFrame:
    return cards(found).select(
        F.col("n").alias(ROSTER_COLUMNS[0]),
        F.col("name").alias(ROSTER_COLUMNS[1]),
        note_or("").alias(ROSTER_COLUMNS[2]),
    )


# The heading of a roster's text, with places for section, cohort, time and number of cards.
ROSTER_HEADING = """# {season} - {cohort}

> 抓取时间: {taken_at}
> 总人数: {n_cards}人

## 学员名单

| 序号 | 姓名 | 备注 |
|------|------|------|
"""

# Fixed value: a row of its table.
ROSTER_ROW = "| {n} | {name} | {note} |"


def _filled(template: str, **values: Column) -> Column:
    """The template with its places taken by values, which are not looked into."""
    pieces = re.split(r"\{(\w+)\}", template)
    return F.concat(*(values[p] if i % 2 else F.lit(p) for i, p in enumerate(pieces)))


def markdown_line(n: Column, name: Column, note: Column) -> Column:
    return _filled(ROSTER_ROW, n=n.cast("string"), name=name, note=note)


def roster_markdown(found: DataFrame, taken_at: Column | None = None) -> DataFrame:
    """Add ``markdown``: title, time, head count and a numbered table, one text per section."""
    now = F.date_format(F.current_timestamp() if taken_at is None else taken_at, "yyyy-MM-dd HH:mm:ss")
    note = lambda c: F.when(c["note"] != "", c["note"]).otherwise(F.lit("-"))
    line = lambda c, i: F.concat(markdown_line(i + 1, c["name"], note(c)), F.lit("\n"))
    n_cards = F.col("n_cards").cast("string")
    head = _filled(ROSTER_HEADING, season=F.col("season"), cohort=F.col("cohort"), taken_at=now, n_cards=n_cards)
    return found.withColumn("markdown", F.concat(head, F.array_join(F.transform("cards", line), "")))


def roster_json(found: DataFrame, taken_at: Column | None = None) -> DataFrame:
    """The fields of a roster document: section, count, students and time."""
    now = F.current_timestamp() if taken_at is None else taken_at
    return found.select(
        "season",
        "cohort",
        F.col("n_cards").alias("count"),
        F.col("cards").alias("students"),
        F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("scraped_at"),
    )
