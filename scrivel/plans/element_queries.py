"""Queries of the element job: lists of the given pages, and rosters printed from customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrivel.operators.elements import CardLayout, cards, flat_sections, sections
from scrivel.plans.tables import CARDS_PER_PAGE, roster_pages, table
from scrivel.sinks.tables import roster_csv_rows, roster_markdown

MENU = CardLayout(section=("nav", None), card=("li", None), name=("a", None), note=("span", None))


def _rosters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections(roster_pages(table(spark, sf_dir, "customer")))


def menu_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return cards(flat_sections(pages, MENU)).select(
        "page_id", F.col("n").cast("bigint").alias("n"), "name", "note"
    )


def menu_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return sections(pages, MENU).select(
        "page_id", F.col("n_cards").cast("bigint").alias("n_cards")
    )


def roster_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cards(_rosters(spark, sf_dir)).select(
        "page_id",
        "season",
        "cohort",
        F.col("n_cards").cast("bigint").alias("n_cards"),
        F.col("n").cast("bigint").alias("n"),
        "name",
        "note",
    )


def roster_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the roster's CSV export."""
    rows = roster_csv_rows(_rosters(spark, sf_dir))
    return rows.withColumn("序号", F.col("序号").cast("bigint"))


def roster_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    when = F.lit("2024-01-02 03:04:05").cast("timestamp")
    return roster_markdown(_rosters(spark, sf_dir), when).select("page_id", "markdown")


# --- the same results in SQL ---

_NAV = "regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1)"
_PLAIN = (
    "trim(replace(replace(replace(replace(item, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'),"
    " '&amp;', '&'))"
)
_ITEMS = f"regexp_extract_all({_NAV}, '<a [^>]*>([^<]*)</a>', 1)"

_CARDS = f"""
SELECT c_custkey // {CARDS_PER_PAGE} AS page_id, 'Season ' || c_custkey // {CARDS_PER_PAGE} AS season,
       'Group & Co' AS cohort,
       count(*) OVER (PARTITION BY c_custkey // {CARDS_PER_PAGE}) AS n_cards,
       row_number() OVER (PARTITION BY c_custkey // {CARDS_PER_PAGE} ORDER BY c_custkey) AS n,
       c_name AS name, CASE WHEN c_custkey % 3 > 0 THEN lower(c_mktsegment) ELSE '' END AS note
FROM customer
"""

QUERIES = {
    "html_cards": (
        menu_cards,
        f"""
        SELECT page_id, n, {_PLAIN} AS name, '' AS note
        FROM (SELECT page_id, unnest({_ITEMS}) AS item,
                     unnest(generate_series(1, len({_ITEMS}))) AS n FROM pages)
        """,
    ),
    "html_card_count": (
        menu_counts,
        f"SELECT page_id, len(regexp_extract_all({_NAV}, '<li>')) AS n_cards FROM pages "
        "WHERE html LIKE '%<nav>%'",
    ),
    "roster_cards": (roster_cards, _CARDS),
    "roster_table": (
        roster_table,
        f'SELECT n AS "序号", name AS "姓名", note AS "备注" FROM ({_CARDS})',
    ),
    "roster_markdown": (
        roster_texts,
        f"""
        SELECT page_id, '# ' || any_value(season) || ' - Group & Co' || chr(10) || chr(10)
          || '> 抓取时间: 2024-01-02 03:04:05' || chr(10)
          || '> 总人数: ' || any_value(n_cards) || '人' || chr(10) || chr(10)
          || '## 学员名单' || chr(10) || chr(10) || '| 序号 | 姓名 | 备注 |' || chr(10)
          || '|------|------|------|' || chr(10)
          || string_agg('| ' || n || ' | ' || name || ' | '
               || CASE note WHEN '' THEN '-' ELSE note END || ' |' || chr(10), '' ORDER BY n)
          AS markdown
        FROM ({_CARDS}) GROUP BY page_id
        """,
    ),
}
