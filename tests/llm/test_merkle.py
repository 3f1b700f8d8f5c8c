import hashlib
import random
import re

from pyspark.sql import functions as F

from scrivel.llm.merkle import edited_fingerprints, first_difference, likeness, next_rows, pieces, with_fingerprint


def plain(text):
    """Root and pieces of a text, by walking over its characters."""
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    roots, body = [], []
    for section in re.findall(r"(?s).+?(?:\n\n+|\Z)", text):
        inner, shown = [], []
        for paragraph in re.findall(r"[^\n]+\n*|\n+", section):
            hashes = [md5(x) for x in re.findall(r"[^.!?|\n]{1,160}[.!?|\n]*|[.!?|\n]+", paragraph)]
            inner.append(md5("".join(hashes)))
            shown.append("".join(h[:8] for h in hashes))
        roots.append(md5("".join(inner)))
        body.append(",".join(shown))
    return hashlib.sha256("".join(roots).encode()).hexdigest() + ":" + ";".join(body)


def test_fingerprints_as_by_hand(odd_docs, odd_rows):
    got = with_fingerprint(odd_docs, "text", "f").select("text", "f").collect()
    assert len(got) == len(odd_rows)
    assert all(r["f"] == plain(r["text"] or "") for r in got)


def test_likeness_and_place_of_an_edit(spark):
    texts = ["One. Two. Three.\nFour.\n\nFive.", "One. Two. Three.\nFour.\n\nSix.", "", "One."]
    marks = [plain(t) for t in texts]
    rows = [(a, b) for a in marks for b in marks]
    df = spark.createDataFrame(rows, "a string, b string")
    a, b = F.col("a"), F.col("b")
    got = df.select(likeness(a, b).alias("l"), first_difference(a, b, ";").alias("s"), first_difference(a, b, "[;,]").alias("p"), F.size(pieces(a)).alias("n")).collect()
    same, other, blank, short = got[0], got[1], got[2], got[3]
    assert (same["l"], same["s"], same["p"], same["n"]) == (1.0, None, None, 5)
    assert (other["l"], other["s"], other["p"]) == (0.8, 2, 3)
    assert (blank["l"], blank["s"]) == (0.0, 1)
    assert 0 < short["l"] < 1
    assert got[10]["l"] == 1.0  # empty against empty


def test_every_key_has_the_one_that_follows(spark):
    keys = random.Random(2).sample(range(10**6), 300)
    df = spark.createDataFrame([(k, k % 3) for k in keys] * 2 + [(None, 1)], "id long, mark int").repartition(6)
    got = {(r["id"], r["mark"]): (r["next_id"], r["next_mark"]) for r in next_rows(df, ["id", "mark"]).collect()}
    order = [(None, 1), *sorted((k, k % 3) for k in keys)]
    assert got == dict(zip(order, order[1:] + order[:1], strict=True))


def test_texts_edited_with_the_next_document(spark, odd_docs, odd_rows):
    got = edited_fingerprints(odd_docs.withColumn("mark", F.lit("x")).withColumn("name", F.lit(1))).collect()
    assert len(got) == len(odd_rows)
    rows = [(i, t or "") for i, t in {(r[0], r[1]) for r in odd_rows}]
    alone = sorted(i for i, _ in rows if i is not None and sum(j == i for j, _ in rows) == 1)
    text = dict(rows)
    edited = {r["id"]: r for r in got}
    for a, b in zip(alone, alone[1:], strict=False):
        if b - a == 1:
            half = len(text[a]) // 2
            want = text[a][: len(text[a]) - half] + text[b][:half]
            assert edited[a]["edited"] == want
            assert edited[a]["n_chars"] == len(text[a])
            assert edited[a]["edited_fingerprint"] == plain(want)
            assert (edited[a]["next_id"], edited[a]["next_fingerprint"]) == (b, plain(text[b]))
    assert {r["fingerprint"] for r in got} == {plain(t) for _, t in rows}


def test_one_document_follows_itself_and_none_gives_none(spark, no_docs):
    one = edited_fingerprints(spark.createDataFrame([(1, "abcde")], "doc_id long, text string")).collect()
    assert [(r["edited"], r["next_id"]) for r in one] == [("abcab", 1)]
    assert edited_fingerprints(no_docs).collect() == []
