"""Inputs of the queries: the given tables, and statements, receipts and rosters that Spark
prints from all of their rows. What is printed is parsed back, so the expected result is
the original column."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SALT = "demo"
# Digits of a customer key as a name of four characters.
NAME_DIGITS = "甲乙丙丁戊己庚辛壬癸"
CARDS_PER_PAGE = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame) -> DataFrame:
    """A table dealt out to as many tasks as the session's setting ``spark.scrivel.deal`` says, for files of a single row group, which
    cannot be split; without the setting, as on a cluster, the table as it is read."""
    parts = df.sparkSession.conf.get("spark.scrivel.deal", None)
    return df.repartition(int(parts)) if parts else df


def spread(df: DataFrame) -> DataFrame:
    """Rows from which far more is printed than they hold, dealt out to as many tasks as a shuffle of the session has, or as
    ``spark.scrivel.deal`` says. Their own size would have them read, or joined, by a few tasks only."""
    conf = df.sparkSession.conf
    return df.repartition(int(conf.get("spark.scrivel.deal", None) or conf.get("spark.sql.shuffle.partitions")))


def with_each_of(df: DataFrame, key: str, column: str, settle: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows with each value of ``column`` that rows of their key have, as a join of the table with itself by the key; a null key meets none.

    Only rows of keys that come more than once are joined. ``settle`` writes the table of these keys, so that its size is known.
    """
    again = settle(df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(key))
    several = df.join(again, key, "left_semi")
    met = several.drop(column).join(several.select(key, column), key)
    return df.filter(F.col(key).isNotNull()).join(again, key, "left_anti").unionByName(met)


def printed(c: Column) -> Column:
    """Amount with thousands separators and two decimals."""
    return F.format_number(c, 2)


def stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the envelope of a landed story, with empty and missing fields among them."""
    d = dealt(table(spark, sf_dir, "documents"))
    key = F.col("doc_id")
    record = F.struct(
        key.cast("string").alias("objectID"),
        key.alias("story_id"),
        F.lit("2024-01-01T00:00:00Z").alias("created_at"),
        F.when(key % 3 > 0, F.lit("2024-01-02T00:00:00Z")).alias("updated_at"),
        F.when(key % 5 > 0, F.concat(F.col("source"), F.lit("-"), F.col("lang"))).otherwise(
            F.lit("")
        ).alias("author"),
        F.concat(F.col("lang"), F.lit(" Story By "), F.col("source")).alias("title"),
        F.col("text").alias("story_text"),
        F.when(
            key % 7 > 0, F.concat(F.lit("https://Www."), F.col("source"), F.lit(".example/a?b"))
        ).alias("url"),
        F.col("n_chars").alias("points"),
        F.when(key % 2 == 0, key).alias("num_comments"),
        F.when(
            key % 4 > 0, F.array(F.lit("story"), F.concat(F.lit("author_"), "source"), F.col("lang"))
        ).alias("_tags"),
    )
    return d.select(
        key.alias("doc_id"),
        F.col("source"),
        F.lit("https://data.example/stories").alias("source_url"),
        F.lit("2024-01-03T00:00:00Z").alias("collected_at"),
        record.alias("record"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its customer; the texts to be printed from it."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                              "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    c = c.withColumn("balance", printed(F.col("c_acctbal")))
    joined = dealt(o).join(c, F.col("o_custkey") == F.col("c_custkey"))
    sign = F.when(F.col("o_orderstatus") == "F", "-").otherwise("+")
    day = F.col("o_orderdate")
    forms = ("yyyy-MM-dd", "yyyy年M月d日", "yyyy/M/d", "yy-MM-dd")
    # Only the form that is printed is formatted.
    form = F.col("o_orderkey") % 4
    dates = reduce(lambda c, i: c.when(form == i, F.date_format(day, forms[i])), range(len(forms)), F)
    return joined.withColumns(
        {
            "day": dates,
            "amount": F.concat(sign, printed(F.col("o_totalprice"))),
        }
    )


def statement_pages(payments_: DataFrame) -> DataFrame:
    """A page per order: heading, blank line, the payment, a footer."""
    line = F.concat_ws(" ", "day", "c_name", "amount", "balance")
    text = F.concat(
        F.lit("Statement of account\n \t\n  "), line, F.lit("\t\n"), F.lit("ref. "),
        F.col("o_orderpriority"), F.lit("\n"),
    )
    return payments_.select(
        F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("page"), text.alias("text")
    )


def statement_rows(
    payments_: DataFrame, customers: DataFrame, last_kind_fits: bool = True
) -> DataFrame:
    """Table rows per customer, in four kinds: header first; header second and turned round;
    no header; header first with blank and short rows in between, or short rows only."""
    kind = F.col("o_custkey") % 4
    note = F.col("o_orderpriority")
    day, amount, balance, name = (F.col(c) for c in ("day", "amount", "balance", "c_name"))
    straight = F.array(F.concat(F.lit(" "), day), amount, name, F.concat(balance, F.lit("\t")), note)
    turned = F.array(note, balance, name, amount, day)
    short = (kind == 3) & ((F.col("o_orderkey") % 10 == 0) | F.lit(not last_kind_fits))
    cells = F.when(kind == 1, turned).when(short, F.slice(straight, 1, 3)).otherwise(straight)
    blank = F.array(F.lit(" "), F.lit(None).cast("string"))
    pair = F.when((kind == 3) & (F.col("o_orderkey") % 7 == 0), F.array(blank, cells)).otherwise(
        F.array(cells)
    )
    data = payments_.select(
        F.col("o_custkey").alias("doc_id"),
        F.col("o_orderkey").alias("page"),
        F.lit(0).alias("table_no"),
        F.posexplode(pair).alias("row_no", "cells"),
    )
    words = ["交易日期", "借方金额", "对方户名", "账户余额", "备注"]
    head = F.array(*(F.lit(w) for w in words))
    tail = F.array(*(F.lit(w) for w in ["摘要", "可用余额", "交易对方", "发生额", "记账日期"]))
    title = F.array(F.lit("Statement of"), F.col("c_name"))
    key = F.col("c_custkey") % 4
    headers = (
        customers.filter(key != 2)
        .select(
            F.col("c_custkey").alias("doc_id"),
            F.lit(-1).cast("bigint").alias("page"),
            F.lit(0).alias("table_no"),
            F.posexplode(
                F.when(key == 1, F.array(title, tail))
                .when(key == 3, F.array(blank, head))
                .otherwise(F.array(head))
            ).alias("row_no", "cells"),
        )
    )
    return data.unionByName(headers)


def _box(text: Column, x: float, y: int, jitter: Column) -> Column:
    """Every eleventh screen comes without heights."""
    return F.struct(
        text.alias("text"),
        F.lit(float(x)).alias("x"),
        (F.lit(float(y)) + jitter).alias("y"),
        F.lit(60.0).alias("w"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(0.0)).otherwise(F.lit(20.0)).alias("h"),
    )


def _mixed(boxes: Column, seed: Column) -> Column:
    """Boxes in an order unrelated to their places, the same on every run."""
    keyed = F.transform(
        boxes, lambda b: F.struct(F.xxhash64(seed, b["text"], b["x"], b["y"]).alias("k"), b.alias("b"))
    )
    return F.transform(F.sort_array(keyed), lambda e: e["b"])


def receipt_images(payments_: DataFrame) -> DataFrame:
    """A screen per order: name, amount, balance, then labels with their values above them, and for every fifth
    a label that has its value below, since another label is above."""
    key = F.col("o_orderkey")
    digits = F.lpad((F.col("o_custkey") % 10000).cast("string"), 4, "0")
    name = F.translate(digits, "0123456789", NAME_DIGITS)
    jitter = (F.pmod(key, F.lit(5)) - 2).cast("double")
    # Every third amount is unsigned, so that the transfer type has to tell the direction.
    unsigned = F.concat(F.lit("￥ "), printed(F.col("o_totalprice")))
    amount = F.when(key % 3 == 0, unsigned).otherwise(
        F.concat(F.substring("amount", 1, 1), unsigned)
    )
    kind = F.when(F.col("o_orderstatus") == "F", "汇出汇款").otherwise("汇入汇款")
    tail = F.when(key % 2 == 0, "支行")
    lit = F.lit
    boxes = [
        _box(lit("交易详情"), 150, 40, jitter),
        _box(F.when(key % 4 == 0, F.concat(lit("① "), name)).otherwise(name), 140, 100, jitter),
        _box(amount, 130, 160, -jitter),
        _box(lit("余额"), 120, 220, jitter),
        _box(F.concat(lit("¥"), printed(F.abs("c_acctbal"))), 200, 220, -jitter),
        _box(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), 200, 280, jitter),
        _box(lit("交易时间"), 20, 310, jitter),
        _box(lit("查看往来"), 300, 310, -jitter),
        _box(F.concat("c_mktsegment", lit(" Bank")), 200, 340, jitter),
        _box(lit("付款银行"), 20, 370, jitter),
        _box(tail, 200, 370, jitter),
        _box(F.concat(lit("6225"), F.col("o_custkey").cast("string")), 200, 400, -jitter),
        _box(lit("收款账号"), 20, 430, jitter),
        _box(F.col("o_orderpriority"), 200, 460, jitter),
        _box(lit("附言"), 20, 490, jitter),
        _box(kind, 200, 520, jitter),
        _box(lit("银行交易类型"), 20, 550, jitter),
        _box(F.col("c_name"), 200, 580, jitter),
        _box(lit("付款人"), 20, 610, jitter),
        _box(F.when(key % 5 == 0, "付款账号"), 20, 640, -jitter),
        _box(F.when(key % 5 == 0, F.concat(lit("6226"), F.col("o_custkey").cast("string"))), 200, 670, jitter),
    ]
    present = F.filter(F.array(*boxes), lambda b: b["text"].isNotNull())
    return payments_.select(
        key.alias("doc_id"), F.to_json(_mixed(present, key)).alias("payload")
    )


def text_images(documents: DataFrame, some_bare: bool = True, rest: tuple[str, ...] = ()) -> DataFrame:
    """Whole documents as word boxes, a text line every 30 pixels, slightly out of line and of several heights.

    Unless told otherwise every third document has boxes without heights, in lines exactly the default
    tolerance apart. Columns of ``rest`` stay beside the image.
    """
    lines = F.split("text", "\n")
    bare = F.lit(some_bare) & (F.col("doc_id") % 3 == 0)

    def place(line: Column, i: Column) -> Column:
        words = F.filter(F.split(line, " "), lambda w: w != "")

        def box(w: Column, j: Column) -> Column:
            seed = F.xxhash64(w, j)
            height = F.get(F.array(*(F.lit(h) for h in (0.0, 16.0, 20.0, 24.0))), F.pmod(seed, F.lit(4)).cast("int"))
            centre = (i * 30 + F.pmod(seed, F.lit(9)) - 4).cast("double")
            return F.struct(
                w.alias("text"),
                (j * 40).cast("double").alias("x"),
                F.when(bare, (i * 12).cast("double")).otherwise(centre - height / 2).alias("y"),
                F.lit(36.0).alias("w"),
                F.when(bare, F.lit(0.0)).otherwise(height).alias("h"),
            )

        return F.transform(words, box)

    boxes = F.flatten(F.transform(lines, place))
    return dealt(documents).select("doc_id", *rest, F.to_json(_mixed(boxes, F.col("doc_id"))).alias("payload"))


def odd_payloads(payments_: DataFrame) -> DataFrame:
    """A payload per order: boxes, none, null, blank, broken off, of another kind, or followed by more text."""
    kind = F.col("o_orderkey") % 10
    boxes = F.to_json(F.array(F.struct(F.col("c_name").alias("text"), F.lit(1.0).alias("x"), F.lit(2.0).alias("y"))))
    odd = [
        boxes, F.lit("[]"), F.lit(None).cast("string"), F.lit(" "), F.substring(boxes, 1, 9), F.lit('"text"'),
        F.concat(boxes, F.lit(" oops")), F.concat(boxes, F.lit(","), boxes), F.concat(boxes, F.lit("]")),
        F.concat(F.lit("\n"), boxes, F.lit(" \t")),
    ]
    payload = F.get(F.array(*odd), kind.cast("int"))
    return payments_.select(F.col("o_orderkey").alias("doc_id"), payload.alias("payload"))


def single_boxes(images: DataFrame) -> DataFrame:
    """Boxes landed one by one, as a table of their own."""
    rest = [c for c in images.columns if c != "items"]
    single = images.select(*rest, F.posexplode("items").alias("ord", "box"))
    return single.select(*rest, "ord", "box.*")


def roster_pages(customers: DataFrame) -> DataFrame:
    """Roster pages of twenty customers each, so no page depends on how many there are."""
    card = F.concat(
        F.lit('<article class="alumni-avatar big"><strong class="student-avatar__name"> '),
        F.replace("c_name", F.lit("#"), F.lit("&#35;")),
        F.lit(' </strong><br><span class="student-avatar__note">'),
        F.when(F.col("c_custkey") % 3 > 0, F.lower("c_mktsegment")).otherwise(F.lit("")),
        F.lit("</span></article>"),
    )
    page = F.floor(F.col("c_custkey") / CARDS_PER_PAGE)
    body = F.sort_array(F.collect_list(F.struct("c_custkey", card.alias("card"))))
    html = F.concat(
        F.lit('<html><body><p class="alumni-directory__season">x</p>'
              '<section class="alumni-directory__section"><div class="alumni-directory__header">'
              '<p class="alumni-directory__season">Season '),
        F.col("page_id").cast("string"),
        F.lit("</p><h2>Group &amp; Co</h2></div>"),
        F.array_join(F.transform("body", lambda b: b["card"]), "\n"),
        F.lit('</section><section class="alumni-directory__section"><article class="alumni-avatar">'
              "</article></section></body></html>"),
    )
    return (
        customers.groupBy(page.alias("page_id"))
        .agg(body.alias("body"))
        .select("page_id", html.alias("html"))
    )
