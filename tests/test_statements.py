import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from scrivel.functions.amounts import find_amounts, find_date, parse_date, residual_text
from scrivel.operators import statements as S
from scrivel.operators.skew import running, skew_join
from scrivel.plans.statement_queries import ledger_union
from scrivel.sinks.tables import entry_table, ledger_table

ROWS = "doc_id long, page int, table_no int, row_no int, cells array<string>"
HEAD = ["交易日期", "借方金额", "贷方金额", "账户余额", "对方户名"]


def _rows(spark, *docs):
    rows = [(d, 0, 0, i, cells) for d, doc in enumerate(docs) for i, cells in enumerate(doc)]
    return spark.createDataFrame(rows, ROWS)


def test_find_date(evaluate_all):
    lines = {
        "2024年1月5日 x": "2024年1月5日",
        "a 24-01-15": "24-01-15",
        "card 6225-88-1 then 2024/01/02": "6225-88-1",
        "12024-01-15": "2024-01-15",
        "none": None,
    }
    assert evaluate_all(find_date, lines) == list(lines.values())


def test_parse_date(evaluate_all):
    dates = {
        "2024-1-5": "2024-01-05",
        "2024年01月15日": "2024-01-15",
        "69-1-5": "1969-01-05",
        "68/1/5": "2068-01-05",
        "01-15-24": "01-15-24",
        "2024-13-01": "2024-13-01",
        "2024-02-30": "2024-02-30",
        "2024-01-15 10:00": "2024-01-15 10:00",
        "2024-1- 5": "2024-01-05",
        "0000-01-01": "0000-01-01",
        "٢٠٢٤-01-05": "2024-01-05",
        "２０２４-1-1２": "2024-01-12",
        "٠٠٠٠-01-01": "٠٠٠٠-01-01",
        "": "",
        None: "",
    }
    assert evaluate_all(parse_date, dates) == list(dates.values())


def test_find_amounts(evaluate_all):
    lines = {
        "2024-01-15 -48000.00 123.45": ["000.00", "123.45"],
        "x -1,234.50 9,999.00": ["-1,234.50", "9,999.00"],
        "5172.4": [],
    }
    assert evaluate_all(find_amounts, lines) == list(lines.values())
    plain = r"[+-]?\d+\.\d{2}"
    assert evaluate_all(lambda c: find_amounts(c, plain), ["-48000.00"]) == [["-48000.00"]]


def test_residual_removes_first_occurrences(spark):
    rows = [("1.00 2024-1-2 a 1.00 1.00 2024-1-2", "2024-1-2", ["1.00", "1.00"]), ("x", None, [])]
    lines = spark.createDataFrame(rows, "raw string, date string, amounts array<string>")
    out = lines.select(residual_text(*map(F.col, lines.columns)).alias("r")).collect()
    assert [r["r"] for r in out] == ["a  1.00 2024-1-2", "x"]


def test_last_fitting_header_cell_counts(spark):
    found = S.header_maps(S.clean_cells(_rows(spark, [HEAD]))).first()["header"].asDict()
    assert found == {"日期": 0, "金额": 2, "余额": 3, "对方": 4, "摘要": None}


def test_table_ledger(spark):
    docs = (
        [[" ", None], HEAD, ["2024/1/5", "1", "-1,000.00 ", "5", "甲"], ["short", "2"],
         ["x", "", "", "", "", "extra"]],
        [["title"], HEAD, ["2024-1-6", "", "7.00", "8", "乙"], HEAD],
        [["a", "b"], ["c", None], ["d", "e"]],
        [["alone"]],
    )
    out = S.table_ledger(_rows(spark, *docs)).orderBy("doc_id", "row_no").collect()
    got = [(r["doc_id"], r["日期"], r["方向"], r["金额"], r["对方"], r["原始数据"]) for r in out]
    assert got == [
        (0, "2024-01-05", "支出", "-1000.00", "甲", None),
        (0, "x", None, "", "", None),
        (1, "2024-01-06", "收入", "7.00", "乙", None),
        (1, "交易日期", "收入", "贷方金额", "对方户名", None),
        (2, None, None, None, None, "c | "),
        (2, None, None, None, None, "d | e"),
    ]


def test_text_ledger(spark):
    text = "Heading\n\n 2024年1月5日 甲 -1,000.00 2,000.00 \n5.00\n only 24-1-6\n"
    pages = spark.createDataFrame([(1, 1, text)], "doc_id long, page int, text string")
    out = S.text_ledger(pages).orderBy("line_no").collect()
    got = [(r["日期"], r["方向"], r["金额"], r["余额"], r["对方/摘要"]) for r in out]
    assert got == [
        ("2024-01-05", "支出", "-1000.00", "2000.00", "甲"),
        ("", "收入", "5.00", None, ""),
        ("2024-01-06", None, None, None, "only"),
    ]


def test_documents_fall_back_to_text(spark):
    rows = _rows(spark, [HEAD, ["2024-1-5", "1", "2", "3", "甲"]], [HEAD, ["short"]], [["a"], ["b"]])
    text = "2024-2-2 9.00"
    pages = spark.createDataFrame([(d, 1, text) for d in range(4)], "doc_id long, page int, text string")
    ledger = S.statement_ledger(rows, pages)
    got = {r["doc_id"]: r["金额"] for r in ledger.collect()}
    assert got == {0: "2", 1: "9.00", 2: "9.00", 3: "9.00"}
    table = ledger_table(ledger.drop("line_no", "table_no", "row_no"), "doc_id", "page")
    assert table.columns == ["doc_id", "page", "日期", "方向", "金额", "对方", "余额", "摘要", "对方/摘要"]


def test_columns_are_those_that_entries_have(spark):
    """Against the rule spelled out: names as entries show them first, priority ones in front."""
    rng = random.Random(8)
    names = ["余额", "日期", "金额", "原始数据", "Zins", "备 注", "a`b", "key.dot"]
    fixed = ["日期", "方向", "金额", "余额", "原始数据"]
    for _ in range(3):
        entries = []
        for i in range(60):
            some = rng.sample(names, rng.randint(0, 3))
            entries.append((i, {n: f"v{i}{n}" for n in some}, rng.choice([None, f"d{i}"])))
        rows = [(i, day, None, None, None, None, list(extras) or None, list(extras.values()) or None) for i, extras, day in entries]
        schema = "at long, " + ", ".join(f"`{c}` string" for c in fixed) + ", k array<string>, v array<string>"
        given = spark.createDataFrame(rows, schema).repartition(5).withColumn("extras", F.map_from_arrays("k", "v")).drop("k", "v")
        table = entry_table(given, ("at",), ("at",))
        plain = [({"日期": day} if day else {}) for _, _, day in entries]
        plain = [{**p, **{k: v for k, v in extras.items() if k not in p}} for p, (_, extras, _) in zip(plain, entries, strict=True)]
        seen = list(dict.fromkeys(k for p in plain for k in p))
        first = [c for c in ("日期", "方向", "金额", "对方", "余额", "摘要", "对方/摘要") if c in seen]
        assert table.columns == ["at", *first, *(c for c in seen if c not in first)]
        got = {r[0]: tuple(r)[1:] for r in table.collect()}
        assert got == {i: tuple(p.get(c, "") for c in table.columns[1:]) for i, p in enumerate(plain)}


def test_entries_are_parsed_once(spark, tmp_path):
    """The job that finds the columns and the table read the entries where they were written, not the payments once more."""
    paid = [(k, k % 5 + 1, "FOP"[k % 3], 10.5 * k + 1000, datetime(1995, 2, k), ["1-URGENT", "5-LOW"][k % 2]) for k in range(1, 21)]
    orders = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    customers = [(k, f"Customer#{k}", 7.25 * k, "AUTOMOBILE") for k in range(1, 7)]
    spark.createDataFrame(paid, orders).write.parquet(f"{tmp_path}/orders.parquet")
    schema = "c_custkey long, c_name string, c_acctbal double, c_mktsegment string"
    spark.createDataFrame(customers, schema).write.parquet(f"{tmp_path}/customer.parquet")
    table = ledger_union(spark, str(tmp_path))
    assert not [f for f in table.inputFiles() if "orders.parquet" in f or "customer.parquet" in f]
    got = {r["page"]: r for r in table.collect()}
    assert sorted(got) == [k for k, *_ in paid]
    assert table.columns[:6] == ["doc_id", "page", "日期", "方向", "金额", "对方"]
    for key, customer, status, price, day, priority in paid:
        row, sign = got[key], "-" if status == "F" else "+"
        assert (row["doc_id"], row["日期"], row["金额"]) == (customer, f"{day:%Y-%m-%d}", f"{sign}{price:,.2f}".replace(",", ""))
        assert {p: row[p] for p in ("1-URGENT", "5-LOW")} == {p: status if p == priority and key % 3 else "" for p in ("1-URGENT", "5-LOW")}


def test_entries_without_keys_and_names_of_key_columns(spark):
    none = spark.createDataFrame([], "at long, extras map<string,string>")
    assert entry_table(none, ("at",), ("at",)).columns == ["at"]
    odd = spark.createDataFrame([(1, {"at": "x"})], none.schema)
    with pytest.raises(ValueError, match="at"):
        entry_table(odd, ("at",), ("at",))
    assert entry_table(odd, ("at",)).columns == ["at"]
    with pytest.raises(ValueError, match="more than 1"):
        entry_table(spark.createDataFrame([(1, {"a": "", "b": ""})], none.schema), ("at",), most=1)


def test_rows_before_the_header_do_not_fit_it(spark):
    """The widest rows are the title and the header itself; only what follows counts."""
    wide = ["x"] * 9
    rows = _rows(spark, [wide, HEAD, ["short"]], [wide, HEAD, ["short"], HEAD], [HEAD], [wide, wide])
    facts = {r["doc_id"]: r["fits"] for r in S.document_facts(S.clean_cells(rows)).collect()}
    assert facts == {0: False, 1: True, 2: False, 3: False}
    pages = spark.createDataFrame([(d, 1, "2024-2-2 9.00") for d in range(4)], "doc_id long, page int, text string")
    got = sorted((r["doc_id"], r["金额"], r["line_no"]) for r in S.statement_ledger(rows, pages).collect())
    assert got == [(0, "9.00", 1), (1, "贷方金额", None), (2, "9.00", 1), (3, "9.00", 1)]


def test_one_document_with_most_rows(spark):
    hot = [["x", "1.00"]] * 400
    docs = [[["日期", "金额"], *hot], *([["日期", "金额"], ["y", "2.00"]] for _ in range(100))]
    out = S.table_ledger(_rows(spark, *docs)).groupBy("doc_id", "金额").count().collect()
    assert sorted(tuple(r) for r in out) == [(0, "1.00", 400), *((d, "2.00", 1) for d in range(1, 101))]


def test_a_hot_key_is_split(spark):
    """Both sides of the join are shuffles of its own, so that partitions can be split where they are read."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 60000, 1, 6).selectExpr("if(id % 10 > 0, 1, id) AS k", "id AS v")
        per_key = rows.groupBy("k").agg(F.min("v").alias("least"))
        joined = skew_join(rows, per_key, "k")
        assert joined.count() == 60000
        joined.write.format("noop").mode("overwrite").save()
        plan = joined._jdf.queryExecution()
        assert plan.toRdd().count() == 60000
        assert "skew=true" in plan.executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_skew_join_kinds(spark):
    rows = spark.createDataFrame([(i % 3 and 1, i) for i in range(300)] + [(None, 7)], "k int, v int")
    keys = spark.createDataFrame([(0, "x")], "k int, w string")
    assert skew_join(rows, keys, "k").columns == ["k", "v", "w"]
    assert skew_join(rows, keys, "k").count() == 100
    assert skew_join(rows, keys.select("k"), "k", "left_anti").count() == 201
    assert skew_join(rows, keys, "k", "left").count() == 301


def test_running_across_chunks(spark):
    points = spark.range(-50, 50).selectExpr("pmod(id, 2) AS k", "id AS at")
    total = {r["at"]: r["s"] for r in running(points, ["k"], "at", 8, F.col("at"), "sum", "s").collect()}
    earlier = {r["at"]: r["m"] for r in running(points, ["k"], "at", 8, F.col("at"), "max", "m", before=True).collect()}
    for at in range(-50, 50):
        assert total[at] == sum(a for a in range(-50, at + 1) if abs(a) % 2 == abs(at) % 2)
        assert earlier[at] == (at - 2 if at >= -48 else None)


def test_header_rows_are_limited_before_the_shuffle(spark, tmp_path):
    _rows(spark, [HEAD]).write.parquet(str(tmp_path / "rows"))
    heads = S.header_maps(spark.read.parquet(str(tmp_path / "rows")))
    plan = heads._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan.split("Exchange hashpartitioning", 1)[1]
    assert "WindowGroupLimit" in below_shuffle and "SinglePartition" not in plan
