import csv
import datetime
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from scrivel.operators.elements import CardLayout, cards, flat_sections, sections
from scrivel.sinks.tables import (
    roster_csv_rows,
    roster_json,
    roster_markdown,
    write_csv,
    write_json,
)

CARD = '<article class="x alumni-avatar"><strong class="student-avatar__name"> {} </strong>{}</article>'
NOTE = '<p><span class="student-avatar__note">{}</span></p>'
PAGE = (
    "<html><section class='other'><h2>no</h2></section>"
    '<SECTION class="alumni-directory__section wide"><script>var a="<article>"</script>'
    '<div class="alumni-directory__header"><p>skip</p><p class="alumni-directory__season"> S1 </p>'
    "<h2>Co<b>hort</b> &amp; x</h2></div>"
    + CARD.format("甲<i>乙</i>", NOTE.format("a,b &lt;"))
    + CARD.format("Bo", "")
    + '<article class="alumni-avatar"><br></article>'
    + '</SECTION><section class="alumni-directory__section">'
    + CARD.format("late", "")
    + "</section></html>"
)


def _pages(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "page_id long, html string")


def test_cards_of_the_first_section(spark):
    found = sections(_pages(spark, PAGE, "<p>alumni-directory__section</p>", None, ""))
    assert [(r["season"], r["cohort"], r["n_cards"]) for r in found.collect()] == [
        ("S1", "Cohort & x", 3)
    ]
    got = [(r["n"], r["name"], r["note"]) for r in cards(found).orderBy("n").collect()]
    assert got == [(1, "甲乙", "a,b <"), (2, "Bo", ""), (3, "", "")]


def test_missing_parts(spark):
    bare = '<section class="alumni-directory__section"><p class="alumni-directory__season">s</p>'
    got = sections(_pages(spark, bare)).first()
    assert (got["season"], got["cohort"], got["n_cards"], got["cards"]) == ("", "", 0, [])
    escaped = '<section class="alumni&#45;directory__section">'
    assert sections(_pages(spark, escaped)).count() == 1


def test_unclosed_and_nested_tags(spark):
    layout = CardLayout(section=("ul", None), card=("li", None), name=("b", None), note=("i", None))
    html = "<ul><li><b>one</b><li><b>two</b> <i>n</i></ul><ul><li><b>three</b></ul>"
    got = [(r["name"], r["note"]) for r in cards(sections(_pages(spark, html), layout)).collect()]
    assert sorted(got) == [("one", "n"), ("two", "n")]


def test_pages_are_parsed_once(spark):
    plan = cards(sections(_pages(spark, PAGE)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse(") == 1


def _joined(folder):
    return b"".join(p.read_bytes() for p in sorted(folder.glob("part-*")))


def test_parts_of_a_csv_file_join_to_one(spark, tmp_path):
    """Byte by byte what a program that writes one file writes, with quotes where values need them."""
    rows = [(i, f"n{i}", [None, "", "x", "a,b", 'say "hi"', " spaced ", "two\nlines", "é漢"][i % 8]) for i in range(500)]
    table = spark.createDataFrame(rows, "`序号` long, `姓,名` string, `备注` string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_csv(table.repartition(7).withColumn("at", -F.col("序号")), str(tmp_path / "csv"), ("at",))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "csv").glob("part-*"))) > 2
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(["序号", "姓,名", "备注"])
    writer.writerows([i, n, v or ""] for i, n, v in reversed(rows))
    assert _joined(tmp_path / "csv") == out.getvalue().encode("utf-8-sig")


def test_a_table_without_rows_is_its_header(spark, tmp_path):
    write_csv(spark.createDataFrame([], "a string, b string"), str(tmp_path / "csv"))
    assert _joined(tmp_path / "csv") == "a,b\n".encode("utf-8-sig")


def test_time_of_extraction_is_the_present_by_default(spark):
    found = sections(_pages(spark, PAGE))
    before = datetime.datetime.now().replace(microsecond=0)
    rendered = roster_markdown(found).first()["markdown"]
    told = datetime.datetime.strptime(rendered.split("抓取时间: ")[1][:19], "%Y-%m-%d %H:%M:%S")
    scraped = datetime.datetime.strptime(roster_json(found).first()["scraped_at"], "%Y-%m-%dT%H:%M:%S.%f")
    for time in (told, scraped):
        assert abs((time - before).total_seconds()) % 3600 < 120  # in whatever zone the session is


def test_places_in_values_are_not_filled(spark):
    found = sections(_pages(spark, PAGE)).withColumn("season", F.lit("{cohort} {n_cards}"))
    assert roster_markdown(found).first()["markdown"].startswith("# {cohort} {n_cards} - Cohort & x\n")


def test_exports(spark, tmp_path):
    found = sections(_pages(spark, PAGE))
    when = F.lit("2024-01-02 03:04:05").cast("timestamp")
    assert roster_markdown(found, when).first()["markdown"] == (
        "# S1 - Cohort & x\n\n> 抓取时间: 2024-01-02 03:04:05\n> 总人数: 3人\n\n## 学员名单\n\n"
        "| 序号 | 姓名 | 备注 |\n|------|------|------|\n| 1 | 甲乙 | a,b < |\n| 2 | Bo | - |\n"
        "| 3 |  | - |\n"
    )
    write_csv(roster_csv_rows(found), str(tmp_path / "csv"))
    assert _joined(tmp_path / "csv") == "﻿序号,姓名,备注\n1,甲乙,\"a,b <\"\n2,Bo,\n3,,\n".encode()
    write_json(roster_json(found, when), str(tmp_path / "json"))
    (part,) = (p for p in (tmp_path / "json").glob("part-*") if p.stat().st_size)
    got = json.loads(part.read_text(encoding="utf-8"))
    assert list(got) == ["season", "cohort", "count", "students", "scraped_at"]
    assert got["students"][0] == {"name": "甲乙", "note": "a,b <"}


PARTS = [
    "<ul>", "</ul>", "<UL class=x>", "<li>", "</li>", "<li class='a b'>", "<b>", "</b>", "<b class=\"n\">", "<i>", "</i>", "<br>", "<br/>",
    "<div>", "</div>", "<div class=h>", "<p>", "</p>", "<h2>", "</h2>", "one", " two ", "&amp;", "&lt;x", "&copy", "\n", "<!-- <li> -->", "<!doctype html>",
    "<script>var a = '<li>';</script>", "<style>b{}</style>", "<a href=\"x>y\" class='n'>", "</a>", "</zz>", "<img src=x>",
]
LAYOUTS = [
    CardLayout(section=("ul", None), header=("div", "h"), season=("p", None), cohort=("h2", None), card=("li", None), name=("b", None), note=("i", None)),
    CardLayout(section=("ul", "x"), header=("div", None), season=("p", None), cohort=("h2", None), card=("li", "b"), name=("b", "n"), note=("a", "n")),
]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_expressions_find_what_the_parser_finds(spark, layout):
    """On generated pages: tags left open, closed in any order, hidden, void and with quoted brackets."""
    rng = random.Random(11)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    texts += ["".join(f"<li><b>{i}</b> <i>n{i}</i></li>" for i in range(300)).join(("<ul>", "</ul>")), PAGE, "", None]
    pages = _pages(spark, *texts)
    want, got = (sorted(map(str, find(pages, layout).collect())) for find in (sections, flat_sections))
    assert got == want
    assert len(want) > 100
    plan = cards(flat_sections(pages, layout))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan


def test_expressions_read_a_roster(spark):
    pages = _pages(spark, PAGE)
    assert flat_sections(pages).collect() == sections(pages).collect()
