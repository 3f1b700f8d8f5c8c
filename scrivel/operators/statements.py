"""Bank statements: table cells and text lines to ledger rows.

Rows of one document are never gathered. What a document's rows have in common, its header and whether
any row fits it, is found from five of them at most, and every row then meets it in a join.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrivel.functions.amounts import (
    clean_amount,
    direction,
    find_amounts,
    find_date,
    parse_date,
    residual_text,
)
from scrivel.functions.charclass import strip
from scrivel.operators.skew import skew_join

# Words that tell what a header cell stands for.
HEADER_WORDS = {
    "日期": ("日期", "交易日期", "记账日期", "时间", "交易时间"),
    "金额": ("金额", "交易金额", "发生额", "借方金额", "贷方金额", "收入", "支出", "借方", "贷方"),
    "余额": ("余额", "账户余额", "可用余额"),
    "对方": ("对方", "对方户名", "对方账户", "交易对方", "收款人", "付款人", "对方名称", "对手"),
    "摘要": ("摘要", "备注", "用途", "交易摘要", "交易类型", "附言"),
}

# The ledger columns, in order of priority.
LEDGER_COLUMNS = ("日期", "方向", "金额", "对方", "余额", "摘要", "对方/摘要", "原始数据")

POSITION = ("page", "table_no", "row_no")


def clean_cells(rows: DataFrame) -> DataFrame:
    """Strip all cells, read null as '', and drop rows without any text."""
    cells = F.transform("cells", lambda c: F.coalesce(strip(c), F.lit("")))
    # A filter would be pushed below the strip and strip once more.
    filled = F.explode(F.filter(F.array(cells), lambda row: F.exists(row, lambda c: c != "")))
    return rows.select(*(filled.alias(c) if c == "cells" else F.col(f"`{c}`") for c in rows.columns))


def header_map(cells: Column) -> Column:
    """Position of each ledger column among header cells, null where no word fits.

    A cell may serve several columns; of several fitting cells the last one counts.
    """

    def last_hit(words: tuple[str, ...]) -> Column:
        # A word that holds another one of its column fits only where that one does.
        short = [w for w in words if not any(v != w and v in w for v in words)]
        fits = lambda c: reduce(or_, (F.contains(c, F.lit(w)) for w in short))
        return F.array_max(F.transform(cells, lambda c, i: F.when(fits(c), i)))

    return F.struct(*(last_hit(words).alias(key) for key, words in HEADER_WORDS.items()))


def _is_empty(found: Column) -> Column:
    return F.coalesce(*(found[key] for key in HEADER_WORDS)).isNull()


def document_facts(rows: DataFrame, position: tuple[str, ...] = POSITION) -> DataFrame:
    """One row per document: ``header`` map, null if there is none, its position ``at``, and ``fits``, whether any
    row after it is wide enough for it.

    The header is the first row if any word fits it, else the second one if that fits. The widest row after it is
    among the three widest, since two are before it at most. So each task keeps the first two and
    the three widest rows per document before the shuffle, and long documents cost no more than short
    ones. ``rows`` are cleaned already.
    """
    at = F.struct(*position)
    none = F.lit(None).cast("array<string>")
    places = F.array(
        F.struct(F.lit(True).alias("early"), F.lit(0).alias("rank"), F.col("cells").alias("cells")),
        F.struct(F.lit(False).alias("early"), (-F.size("cells")).alias("rank"), none.alias("cells")),
    )
    each = rows.select("doc_id", *position, F.explode(places).alias("p")).select("doc_id", *position, "p.*")
    best = Window.partitionBy("doc_id", "early").orderBy("rank", *position)
    kept = (
        each.withColumn("nth", F.row_number().over(best))
        .filter(F.col("nth") <= 3)
        .select(
            "doc_id", "early", "nth", at.alias("at"), (-F.col("rank")).alias("size"),
            F.when(F.col("nth") <= 2, header_map(F.col("cells"))).alias("found"),
        )
    )
    first = lambda n, c: F.max(F.when(F.col("early") & (F.col("nth") == n), F.col(c)))
    wide = F.collect_list(F.when(~F.col("early"), F.struct("at", "size")))
    both = kept.groupBy("doc_id").agg(
        *(first(n, c).alias(f"{c}{n}") for n in (1, 2) for c in ("at", "found")), wide.alias("wide")
    )
    use1 = ~_is_empty(F.col("found1"))
    use2 = F.col("found2").isNotNull() & ~_is_empty(F.col("found2"))
    found = both.select(
        "doc_id",
        F.when(use1, F.col("found1")).when(use2, F.col("found2")).alias("header"),
        F.when(use1, F.col("at1")).when(use2, F.col("at2")).otherwise(F.col("at1")).alias("at"),
        "wide",
    )
    fits = F.exists("wide", lambda w: (w["at"] > F.col("at")) & (w["size"] > _width(F.col("header"))))
    return found.select("doc_id", "header", "at", (F.col("header").isNotNull() & fits).alias("fits"))


def header_maps(rows: DataFrame, position: tuple[str, ...] = POSITION) -> DataFrame:
    return document_facts(rows, position).select("doc_id", "header", "at")


def _width(header: Column) -> Column:
    return F.greatest(*(header[key] for key in HEADER_WORDS))


def _is_data(position: tuple[str, ...]) -> Column:
    """Rows after the header that are wide enough for it; all rows after the first without one."""
    header = F.col("header")
    return (F.struct(*position) > F.col("at")) & (
        header.isNull() | (F.size("cells") > _width(header))
    )


def _table_columns() -> dict[str, Column]:
    """Ledger columns out of ``cells`` and ``header``."""
    header, cells = F.col("header"), F.col("cells")
    known = ~_is_empty(header)
    cell = {key: F.get(cells, header[key]) for key in HEADER_WORDS}
    return cell | {
        "日期": F.when(known, parse_date(cell["日期"])),
        "方向": direction(cell["金额"]),
        "金额": F.when(known, clean_amount(cell["金额"])),
        "原始数据": F.when(~known, F.array_join(cells, " | ")),
    }


def table_ledger(rows: DataFrame, position: tuple[str, ...] = POSITION) -> DataFrame:
    """Rows of table cells to ledger rows.

    Rows up to the header are dropped, and so are rows too short for it. Documents without a header
    give their rows, but for the first, as ``原始数据``.
    """
    filled = clean_cells(rows)
    joined = skew_join(filled, document_facts(filled, position), "doc_id")
    columns = _table_columns()
    names = ("日期", "方向", "金额", "对方", "余额", "摘要", "原始数据")
    return joined.filter(_is_data(position)).select(
        "doc_id", *position, *(columns[n].alias(n) for n in names)
    )


def text_lines(pages: DataFrame) -> DataFrame:
    """Stripped, non-blank lines of page texts, with ``line_no`` from 1 within the page."""
    rest = [c for c in pages.columns if c != "text"]
    return (
        pages.select(*rest, F.posexplode(F.split("text", "\n")).alias("at", "line"))
        .select(*rest, (F.col("at") + 1).alias("line_no"), strip(F.col("line")).alias("raw"))
        .filter(F.col("raw") != "")
    )


def dated_lines(lines: DataFrame, amount_form: str | None = None) -> DataFrame:
    """Keep the lines with a date or an amount and add both."""
    raw = F.col("raw")
    amounts = find_amounts(raw) if amount_form is None else find_amounts(raw, amount_form)
    return lines.withColumns({"date": find_date(raw), "amounts": amounts}).filter(
        F.col("date").isNotNull() | (F.size("amounts") > 0)
    )


def _text_columns() -> dict[str, Column]:
    """Ledger columns out of ``raw``, ``date`` and ``amounts``."""
    amounts = F.col("amounts")
    first, second = F.get(amounts, F.lit(0)), F.get(amounts, F.lit(1))
    amount = F.when(first.isNotNull(), clean_amount(first))
    return {
        "日期": parse_date(F.col("date")),
        "方向": direction(amount),
        "金额": amount,
        "余额": F.when(second.isNotNull(), clean_amount(second)),
        "对方/摘要": residual_text(F.col("raw"), F.col("date"), amounts),
    }


def text_ledger(pages: DataFrame, amount_form: str | None = None) -> DataFrame:
    """Page texts to ledger rows; no shuffle."""
    found = dated_lines(text_lines(pages), amount_form)
    rest = [c for c in found.columns if c not in ("raw", "date", "amounts")]
    return found.select(*rest, *(c.alias(n) for n, c in _text_columns().items()))


def statement_ledger(
    rows: DataFrame,
    pages: DataFrame,
    position: tuple[str, ...] = POSITION,
    amount_form: str | None = None,
) -> DataFrame:
    """Ledger of each document from its tables, or from its text where tables give nothing.

    Tables count if they have a header and at least one row fits it. Table rows and pages meet the document's facts
    in one join, before any text is split into lines, and become ledger rows in one pass.
    """
    filled = clean_cells(rows)
    facts = document_facts(filled, position)
    both = filled.unionByName(pages, allowMissingColumns=True)
    joined = skew_join(both, facts, "doc_id", "left")
    fits, is_table = F.coalesce("fits", F.lit(False)), F.col("cells").isNotNull()
    kept = joined.filter(F.when(is_table, fits & _is_data(position)).otherwise(~fits))
    # A table row stands for one line that is not looked at.
    lines = F.when(is_table, F.array(F.lit(None).cast("string"))).otherwise(F.split("text", "\n"))
    split = kept.select(
        "doc_id", *position, "cells", "header", F.posexplode(lines).alias("nth", "line")
    ).withColumn("raw", strip(F.col("line")))
    amounts = find_amounts(F.col("raw")) if amount_form is None else find_amounts(F.col("raw"), amount_form)
    # Lines without text are dropped by an array without any: a filter would be pushed below the strip and both searches, and do them again.
    read = F.struct("raw", find_date(F.col("raw")).alias("date"), amounts.alias("amounts"))
    read = F.inline(F.when(is_table | (F.col("raw") != ""), F.array(read)))
    dated = split.select("doc_id", *position, "cells", "header", "nth", read).filter(
        is_table | F.col("date").isNotNull() | (F.size("amounts") > 0)
    )
    table, text = _table_columns(), _text_columns()
    pick = lambda name: F.when(is_table, table.get(name, F.lit(None).cast("string"))).otherwise(
        text.get(name, F.lit(None).cast("string"))
    )
    names = [n for n in LEDGER_COLUMNS if n != "原始数据"]
    return dated.select(
        "doc_id",
        *position,
        F.when(~is_table, F.col("nth") + 1).alias("line_no"),
        *(pick(n).alias(n) for n in names),
    )
