"""Queries of the statement job. Inputs are printed from orders and customers and parsed back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrivel.functions.amounts import find_amounts, find_date, parse_date
from scrivel.llm.landing import landed
from scrivel.operators import statements
from scrivel.plans.tables import dealt, payments, statement_pages, statement_rows, table
from scrivel.sinks.tables import entry_table, ledger_table


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statement_rows(payments(spark, sf_dir), table(spark, sf_dir, "customer"))


def text_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statements.text_ledger(statement_pages(payments(spark, sf_dir))).drop("line_no")


def dated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = dealt(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = statements.dated_lines(statements.text_lines(pages))
    return found.select(
        "doc_id",
        F.col("line_no").cast("bigint").alias("line_no"),
        "raw",
        "date",
        F.array_join("amounts", ";").alias("amounts"),
    )


def ungrouped_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of lines that print one number with separators and one without."""
    o = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice")
    line = F.concat_ws(
        " ", F.lit("of"), price.cast("decimal(18,2)").cast("string"), F.format_number(price, 2)
    )
    return o.select("o_orderkey", F.array_join(find_amounts(line), ";").alias("amounts"))


def parsed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates found in printed lines, and impossible ones that must come back as they are."""
    p = payments(spark, sf_dir).withColumn("line", F.concat_ws(" ", F.lit("on"), "day", F.lit("x")))
    odd = F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-02-30"))
    return p.select(
        "o_orderkey",
        parse_date(find_date(F.col("line"))).alias("day"),
        parse_date(odd).alias("odd"),
        parse_date(F.date_format("o_orderdate", "MM-dd-yy")).alias("month_first"),
    )


def header_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = statements.clean_cells(_rows(spark, sf_dir))
    found = statements.header_maps(rows)
    words = statements.HEADER_WORDS
    return found.select(
        "doc_id", *(F.col(f"header.{key}").cast("bigint").alias(key) for key in words)
    )


def table_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statements.table_ledger(_rows(spark, sf_dir)).drop("table_no", "row_no")


def _printed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Tables and texts of all customers; no table row of the last kind fits its header."""
    paid = payments(spark, sf_dir)
    rows = statement_rows(paid, table(spark, sf_dir, "customer"), last_kind_fits=False)
    return rows, statement_pages(paid)


def statement_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = statements.statement_ledger(*_printed(spark, sf_dir))
    return ledger.drop("table_no", "row_no", "line_no")


def ledger_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger as written out: fixed order, absent values empty."""
    ledger = statements.statement_ledger(*_printed(spark, sf_dir))
    ledger = ledger.drop("table_no", "row_no", "line_no")
    return ledger_table(ledger, "doc_id", "page")


def ledger_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same entries with a key of their own each, named after the payment's priority; columns are those found.

    Finding them takes a job of its own, so the entries are written and read back instead of being parsed twice.
    """
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page"), "o_orderpriority", "o_orderstatus")
    ledger = statements.statement_ledger(*_printed(spark, sf_dir)).drop("table_no", "row_no", "line_no")
    extras = F.when(F.col("page") % 3 > 0, F.create_map("o_orderpriority", "o_orderstatus")).alias("extras")
    entries = ledger.join(orders, "page").select(*ledger.columns, extras)
    return entry_table(landed(entries, "ledger"), ("doc_id", "page"), ("doc_id", "page"))


# --- the same results in SQL ---

_PAID = """
SELECT o_orderkey, o_custkey, c_name, o_orderpriority,
       strftime(o_orderdate, '%Y-%m-%d') AS day,
       CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
         WHEN 1 THEN year(o_orderdate) || '年' || month(o_orderdate) || '月' || day(o_orderdate) || '日'
         WHEN 2 THEN year(o_orderdate) || '/' || month(o_orderdate) || '/' || day(o_orderdate)
         ELSE strftime(o_orderdate, '%y-%m-%d') END AS printed_day,
       CASE WHEN o_orderstatus = 'F' THEN '-' ELSE '+' END || printf('%.2f', o_totalprice) AS amount,
       CASE WHEN o_orderstatus = 'F' THEN '-' ELSE '+' END || format('{:,.2f}', o_totalprice)
         AS printed_amount,
       CASE WHEN o_orderstatus = 'F' THEN '支出' ELSE '收入' END AS way,
       format('{:,.2f}', c_acctbal) AS printed_balance, printf('%.2f', c_acctbal) AS balance,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS nth
FROM orders JOIN customer ON o_custkey = c_custkey
"""

_TEXT = f"""
SELECT o_custkey AS doc_id, o_orderkey AS page, day AS "日期", way AS "方向", amount AS "金额",
       balance AS "余额", c_name AS "对方/摘要" FROM ({_PAID})
"""

_TABLE = f"""
SELECT o_custkey AS doc_id, o_orderkey AS page, day AS "日期", way AS "方向", amount AS "金额",
       c_name AS "对方", printed_balance AS "余额", o_orderpriority AS "摘要",
       NULL::VARCHAR AS "原始数据"
FROM ({_PAID}) WHERE o_custkey % 4 IN (0, 1) OR (o_custkey % 4 = 3 AND o_orderkey % 10 <> 0)
"""

_RAW = f"""
SELECT o_custkey AS doc_id, o_orderkey AS page, NULL AS "日期", NULL AS "方向", NULL AS "金额",
       NULL AS "对方", NULL AS "余额", NULL AS "摘要",
       concat_ws(' | ', printed_day, printed_amount, c_name, printed_balance, o_orderpriority)
         AS "原始数据"
FROM ({_PAID}) WHERE o_custkey % 4 = 2 AND nth > 1
"""

_BOTH = f"""
SELECT doc_id, page, "日期", "方向", "金额", "对方", "余额", "摘要", NULL::VARCHAR AS "对方/摘要"
FROM ({_TABLE}) WHERE doc_id % 4 < 2
UNION ALL
SELECT doc_id, page, "日期", "方向", "金额", NULL, "余额", NULL, "对方/摘要"
FROM ({_TEXT}) WHERE doc_id % 4 >= 2
"""

_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")

_AMOUNT = r"[+-]?[0-9]{1,3}(?:,[0-9]{3})*(?:\.[0-9]{2})"
_LONG = r"[0-9]{4}[-/年][0-9]{1,2}[-/月][0-9]{1,2}日?"
_SHORT = r"[0-9]{2}[-/][0-9]{1,2}[-/][0-9]{1,2}"

QUERIES = {
    "statement_text": (text_ledger, _TEXT),
    "dated_lines": (
        dated_lines,
        f"""
        SELECT * FROM (
          SELECT doc_id, line_no, raw,
                 coalesce(nullif(regexp_extract(raw, '{_LONG}'), ''),
                          nullif(regexp_extract(raw, '{_SHORT}'), '')) AS date,
                 array_to_string(regexp_extract_all(raw, '{_AMOUNT}'), ';') AS amounts
          FROM (SELECT doc_id, unnest(generate_series(1, len(string_split(text, chr(10))))) AS line_no,
                       regexp_replace(unnest(string_split(text, chr(10))), '^\\s+|\\s+$', '', 'g')
                         AS raw
                FROM documents) WHERE raw <> '')
        WHERE date IS NOT NULL OR amounts <> ''
        """,
    ),
    "amount_findall": (
        ungrouped_amounts,
        f"""
        SELECT o_orderkey, array_to_string(regexp_extract_all(
          'of ' || printf('%.2f', o_totalprice) || ' ' || format('{{:,.2f}}', o_totalprice),
          '{_AMOUNT}'), ';') AS amounts FROM orders
        """,
    ),
    "parse_date": (
        parsed_dates,
        """
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
               strftime(o_orderdate, '%Y-02-30') AS odd,
               coalesce(strftime(try_strptime(strftime(o_orderdate, '%m-%d-%y'), '%y-%m-%d'),
                                 '%Y-%m-%d'), strftime(o_orderdate, '%m-%d-%y')) AS month_first
        FROM orders JOIN customer ON o_custkey = c_custkey
        """,
    ),
    "header_map": (
        header_maps,
        """
        SELECT c_custkey AS doc_id,
               CASE c_custkey % 4 WHEN 1 THEN 4 WHEN 2 THEN NULL ELSE 0 END AS "日期",
               CASE c_custkey % 4 WHEN 1 THEN 3 WHEN 2 THEN NULL ELSE 1 END AS "金额",
               CASE c_custkey % 4 WHEN 1 THEN 1 WHEN 2 THEN NULL ELSE 3 END AS "余额",
               CASE c_custkey % 4 WHEN 1 THEN 2 WHEN 2 THEN NULL ELSE 2 END AS "对方",
               CASE c_custkey % 4 WHEN 1 THEN 0 WHEN 2 THEN NULL ELSE 4 END AS "摘要"
        FROM customer
        WHERE c_custkey % 4 <> 2 OR c_custkey IN (SELECT o_custkey FROM orders)
        """,
    ),
    "statement_table": (table_ledger, f"{_TABLE} UNION ALL {_RAW}"),
    "statement_fallback": (statement_ledger, _BOTH),
    "ledger_columns": (
        ledger_columns,
        f"""
        SELECT doc_id, page, "日期", "方向", "金额", coalesce("对方", '') AS "对方", "余额",
               coalesce("摘要", '') AS "摘要", coalesce("对方/摘要", '') AS "对方/摘要"
        FROM ({_BOTH})
        """,
    ),
    "ledger_union": (
        ledger_union,
        f"""
        SELECT doc_id, page, "日期", "方向", "金额", coalesce("对方", '') AS "对方", "余额",
               coalesce("摘要", '') AS "摘要", coalesce("对方/摘要", '') AS "对方/摘要",
               {", ".join(f"CASE WHEN page % 3 > 0 AND o_orderpriority = '{p}' THEN o_orderstatus ELSE '' END AS {chr(34)}{p}{chr(34)}" for p in _PRIORITIES)}
        FROM ({_BOTH}) JOIN orders ON o_orderkey = page
        """,
    ),
}
