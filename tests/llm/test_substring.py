import random
import re

import pytest
from pyspark.sql import functions as F

from scrivel.llm.substring import Runs, covered_runs, extended, remove_repeats


def plain(rows, length):
    seen, out = set(), []
    for name, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            window = tuple(words[i : i + length])
            if window in seen:
                gone[i : i + length] = [True] * length
            seen.add(window)
        out.append((name, len(words), sum(gone), " ".join(w for w, g in zip(words, gone, strict=True) if not g)))
    return out


def passages(seed, n):
    """Texts out of few passages that are cut anywhere, with odd words between."""
    rng = random.Random(seed)
    base = [[rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(150)] for _ in range(4)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            at = rng.randint(0, 140)
            words += rng.choice(base)[at : at + rng.randint(4, 50)] + [str(rng.randint(0, 3)) for _ in range(rng.randint(0, 5))]
        rows.append((i, rng.choice([" ", "\n", "\t\r\f"]).join(words)))
    return rows + [(n, ""), (n + 1, "x " * 400), (n + 2, "x " * 7), (n + 3, None), (n + 4, rows[0][1])]


@pytest.mark.parametrize("length", [6, 8, 20])
def test_as_by_brute_force(spark, length):
    rows = passages(length, 150)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = remove_repeats(df, length=length).orderBy("id").collect()
    assert [tuple(r) for r in got] == plain(rows, length)


def test_odd_rows_each_give_a_row(odd_docs, odd_rows):
    clashing = odd_docs.withColumn("seed", F.lit(1)).withColumn("id", F.lit("x")).withColumn("tag", F.lit(2))
    got = remove_repeats(clashing).collect()
    assert sorted(str(r["id"]) for r in got) == sorted(str(r[0]) for r in odd_rows)
    alike = {(r["id"], r["n_words"], r["kept"]) for r in got if r["id"] == 5}
    assert len(alike) == 1
    words = {(r[0], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))) for r in odd_rows}
    assert {(r["id"], r["n_words"]) for r in got} == words


def test_equal_ids_with_different_texts_are_judged_apart(spark):
    long = " ".join(f"w{i}" for i in range(30))
    rows = [(1, long), (2, "a " + long), (2, "short")]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["id"], r["n_removed"], r["kept"]) for r in got) == [(1, 0, long), (2, 0, "short"), (2, 30, "a")]


def test_words_are_separated_by_six_signs_only(spark):
    words = [f"w{i}" for i in range(25)]
    rows = [(1, " ".join(words)), (2, "\x0b\x0c".join(words)), (3, " ".join(words))]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("id").collect()
    assert [(r["n_words"], r["n_removed"]) for r in got] == [(1, 0), (25, 0), (25, 25)]


def test_seeds_longer_than_windows_are_refused():
    with pytest.raises(ValueError, match="seed"):
        Runs(4)


def test_no_documents(no_docs):
    assert remove_repeats(no_docs).collect() == []


@pytest.mark.parametrize("a, b", [(2828654, 3424600), (1522873, 1796841)])
def test_windows_whose_hashes_share_40_bits_are_told_apart(spark, a, b):
    same = "and the bird sat on hill birds walks slow dark until rain came down from all sides at once"
    rows = [(1, f"{a} {same}"), (2, f"{b} {same}"), (3, f"{b} {same} x{b}")]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("id").collect()
    assert [(r["n_removed"], r["kept"]) for r in got] == [(0, rows[0][1]), (0, rows[1][1]), (20, f"x{b}")]
    other = [(1, f"{a} {same} end"), (2, f"{b} {same} end")]
    got = remove_repeats(spark.createDataFrame(other, "doc_id long, text string")).orderBy("id").collect()
    assert [(r["n_removed"], r["kept"]) for r in got] == [(0, other[0][1]), (20, str(b))]


@pytest.mark.parametrize("id", [5, None])
def test_many_texts_of_one_id_are_judged_apart(spark, id):
    shared = [f"s{i}" for i in range(25)]
    rows = [(id, " ".join([f"h{k}x{i}" for i in range(k)] + shared + [f"t{k}x{i}" for i in range(30)])) for k in range(700)]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(k + 55, 25 if k else 0, " ".join(w for w in t.split() if not k or w[0] != "s")) for k, (_, t) in enumerate(rows)]
    assert sorted(tuple(r)[1:] for r in got) == sorted(want)


def test_words_that_collide_under_every_sum_of_powers(spark):
    """The Thue-Morse word and its complement agree in any sum of byte codes times powers of an odd number modulo 2**64."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    word, other = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    same = " ".join(f"w{i}" for i in range(19))
    for order in (f"{{}} {same}", f"{same} {{}}", f"w w w w w w w {{}} {same}"):
        rows = [(1, order.format(word)), (2, order.format(other)), (3, order.format(other))]
        got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("id").collect()
        assert [tuple(r) for r in got] == plain(rows, 20)


def test_many_equal_rows_after_an_earlier_copy(spark):
    """Ranges are those of one row, however many there are."""
    text = " ".join(f"w{i}" for i in range(60))
    for copies in (1, 2000):
        docs = spark.createDataFrame([(1, "x " + text)] + [(2, text)] * copies, "doc_id long, text string").repartition(3)
        ranges = covered_runs(docs, "doc_id", "text", 20)
        lists = ranges.groupBy("id", "tag").agg(F.collect_list(F.struct("start", "many")).alias("r")).collect()
        assert len(lists) == 1
        assert len({tuple(x) for x in lists[0]["r"]}) == len(lists[0]["r"])
        if copies == 1:
            one = len(lists[0]["r"])
        assert len(lists[0]["r"]) == one
        got = remove_repeats(docs).collect()
        assert sorted((r["id"], r["n_removed"]) for r in got) == [(1, 0)] + [(2, 60)] * copies


def test_repeats_are_extended_to_both_sides(spark):
    """Anchors at the same words, more or fewer of them alike on either side."""
    words = [str(i) for i in range(9)]
    cases = [  # own words, the seed's place, other words, its place, start and windows
        (words, 4, words, 4, 0, 5),
        (words, 4, ["x", *words[1:]], 4, 1, 4),
        (words, 4, words[2:7], 2, 2, 1),
        (words, 4, [*words[:6], "x"], 4, 0, 2),
        (words, 0, words[:4], 0, None, None),
    ]
    rows = [(i, 0, at, " ".join(own), (other_at << 8, " ".join(other))) for i, (own, at, other, other_at, *_) in enumerate(cases)]
    pairs = spark.createDataFrame(rows, "id long, tag long, at long, words string, first struct<spot:long,words:string>")
    got = extended(pairs.withColumn("spot", (F.lit(100) * 65536 + F.col("at") * 256).cast("long")), 5).collect()
    want = [(i, 0, 100 + start, many) for i, (*_, start, many) in enumerate(cases) if many]
    assert sorted(tuple(r) for r in got) == want
