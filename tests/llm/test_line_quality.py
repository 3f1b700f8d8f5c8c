import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scrivel.llm import line_quality as line_quality_module
from scrivel.llm.line_quality import FEATURES, fit, fit_line_field, line_features, line_quality, marginals


def good_line(rng):
    words = "the of a slow river stone night walks green field near water".split()
    return " ".join(rng.choice(words) for _ in range(rng.randint(5, 14))).capitalize() + "."


def bad_line(rng):
    return rng.choice([lambda: "BUY!! NOW!! " * rng.randint(2, 6), lambda: " | ".join(["home", "login", "cart"] * 3),
                       lambda: "$$$ %%% &&& " * 4])()


def document(rng, good):
    lines = [good_line(rng) for _ in range(rng.randint(1, 6))]
    return "\n".join(lines if good else [bad_line(rng) if rng.random() < 0.8 else x for x in lines] + [bad_line(rng)])


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(3)
    return [(i, document(rng, i % 4 > 0), int(i % 4 > 0)) for i in range(240)]


@pytest.fixture(scope="module")
def field(spark, labelled):
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in labelled], "doc_id long, text string, label string")
    rows = [(i, q, 0) for i, _, q in labelled if i % 3] + [(None, 1, 0), (5, None, 0), (9999, 1, 0), (7, 5, 1)]
    return fit_line_field(docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))


def test_marginals_as_by_summing_over_all_labellings():
    rng = np.random.default_rng(1)
    counts, same, both = np.array([1, 5, 3]), 0.7, -0.4
    good = rng.normal(size=9)
    got, pairs = marginals(good, counts, same, both)
    p = 1 / (1 + np.exp(-good))
    start, pair_at = 0, 0
    for n in counts:
        weight = np.zeros((n, 2))
        joint = np.zeros((max(0, n - 1), 2, 2))
        for code in range(2**n):
            y = [code >> i & 1 for i in range(n)]
            w = np.prod([p[start + i] if v else 1 - p[start + i] for i, v in enumerate(y)])
            w *= np.exp(sum(same * (a == b) + both * (a == b == 1) for a, b in zip(y, y[1:], strict=False)))
            for i, v in enumerate(y):
                weight[i, v] += w
            for i in range(n - 1):
                joint[i, y[i], y[i + 1]] += w
        assert np.allclose(got[start : start + n], weight[:, 1] / weight.sum(axis=1))
        assert np.allclose(pairs[pair_at : pair_at + n - 1], joint / weight[0].sum())
        start, pair_at = start + n, pair_at + n - 1


def test_held_out_documents_are_told_apart(field, labelled):
    held = [(t, q) for i, t, q in labelled if i % 3 == 0]
    score = field.score([t.encode() for t, _ in held])
    assert np.mean((score >= 0.7) == [q == 1 for _, q in held]) > 0.95
    assert ((score >= 0) & (score <= 1)).all()


def test_lines_take_their_neighbours_into_account():
    features, sizes, counts = line_features([b"one\ntwo two", b"", b"alone"])
    assert features.shape == (4, FEATURES)
    assert counts.tolist() == [2, 1, 1]
    assert sizes.tolist() == [3, 7, 0, 5]
    own = (FEATURES - 3) // 3
    assert (features[0, 2 * own : 3 * own] == features[1, :own]).all()
    assert (features[1, own : 2 * own] == features[0, :own]).all()
    assert (features[3, own : 3 * own] == 0).all()


def test_a_long_document_is_scored_whole(field):
    rng = random.Random(8)
    good, bad = ([f(rng) for _ in range(3000)] for f in (good_line, bad_line))
    low, high = field.score(["\n".join(good[:300] + bad).encode(), "\n".join(good + bad[:30]).encode()])
    assert low < 0.5 < high


def test_one_label_or_none_gives_a_constant():
    empty = fit(np.zeros((0, FEATURES)), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert empty.score([b"a", b""]).tolist() == pytest.approx([0.5, 0.5])
    features, sizes, counts = line_features([b"a", b"b"])
    assert fit(features, sizes, counts, np.array([1, 1])).score([b"zzz"])[0] == pytest.approx(0.75)


def test_every_row_is_scored_by_its_text_alone(field, odd_docs, odd_rows, no_docs):
    clashing = odd_docs.withColumn("score", F.lit("x")).withColumn("__id", F.lit(1))
    scored = line_quality(clashing, field)
    assert scored.columns == [*odd_docs.columns, "__id", "score"]
    rows = scored.collect()
    assert len(rows) == len(odd_rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r["text"] or "", r["score"]) == pytest.approx(r["score"])
    assert line_quality(no_docs, field).collect() == []


def test_the_sample_is_bounded_and_does_not_depend_on_partitions(spark, labelled):
    docs = spark.createDataFrame([(i, t) for i, t, _ in labelled], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in labelled], "doc_id long, quality int")
    a = fit_line_field(docs.repartition(7), labels.repartition(3), most=60)
    b = fit_line_field(docs.coalesce(1), labels, most=60)
    assert (a.weights == b.weights).all()
    assert a.offset == b.offset


def test_repeated_rows_of_a_sampled_id_count_once(spark):
    """The fit is that of one row, whatever the number of rows and the lines of the longest text."""
    rng = random.Random(6)
    rows = [(i, document(rng, i % 2 == 1)) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    fits = []
    for extra in ([], [rows[3]] * 300 + [rows[4]] * 300):
        docs = spark.createDataFrame(rows + extra, "doc_id long, text string").repartition(4)
        field = fit_line_field(docs, labels)
        fits.append((field.weights.tolist(), field.same, field.slope))
    assert fits[0] == fits[1]


def test_lines_of_the_sample_are_bounded(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(line_quality_module, "fit", lambda x, sizes, counts, marks: seen.update(n=counts.tolist(), x=len(x)))
    rows = [(i, "a line\n" * (5000 if i == 2 else 10)) for i in range(30)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    fit_line_field(spark.createDataFrame(rows, "doc_id long, text string"), labels, lines=100)
    assert seen["x"] == sum(seen["n"]) <= 100
    assert max(seen["n"]) <= 100
