import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scrivel.llm import copies, importance
from scrivel.llm.importance import Checksums, Features, drawn_texts, importance_resample

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def _runs(text, most=2):
    words = _words(text)
    return [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def _bucket(run, buckets):
    return zlib.crc32(run.encode()) % buckets


def _expected(docs, target, buckets=10_000, least=20, percent=25, seed=7):
    source, wanted = [0] * buckets, [0] * buckets
    for _, text in docs:
        for run in _runs(text):
            source[_bucket(run, buckets)] += 1
    for text in target:
        for run in _runs(text):
            wanted[_bucket(run, buckets)] += 1
    s_all, t_all = sum(source), sum(wanted)
    gains = [
        math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
        for s, t in zip(source, wanted, strict=True)
    ]
    rows = []
    for name, text in docs:
        found = [gains[_bucket(r, buckets)] for r in _runs(text)]
        weight = sum(found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if name is None else name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([name, len(_words(text)), len(found), weight, score])
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    return rows, [(i + 1, *r) for i, r in enumerate(fit[: len(fit) * percent // 100])]


@pytest.mark.parametrize("texts", [["a b", "", "x"], ["NUL\0s are\0 blanks", "ünï Wörd 12-ab_c", " lead and trail "], [""], []])
def test_buckets_of_runs(texts):
    for most in (1, 2, 3):
        bucket, owner, n_words = Features(most, 977).of([t.encode() for t in texts])
        for i, text in enumerate(texts):
            assert sorted(bucket[owner == i].tolist()) == sorted(_bucket(r, 977) for r in _runs(text, most))
        assert n_words.tolist() == [len(_words(t)) for t in texts]


def test_long_texts_are_scanned_in_parts(monkeypatch):
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcé") for _ in range(rng.choice([1, 3, 90]))) for _ in range(300))
    whole = [a.tolist() for a in Features(2, 5003).of([text.encode()])]
    monkeypatch.setattr(importance, "SLICE_BYTES", 50)
    assert [a.tolist() for a in Features(2, 5003).of([text.encode()])] == whole


def test_joined_checksums():
    rng, sums = random.Random(2), Checksums()
    pairs = [(rng.randbytes(rng.randint(0, 50)), rng.randbytes(rng.choice([0, 1, 7, 300, 70_000]))) for _ in range(60)]
    left, right = (np.array([zlib.crc32(p[i]) for p in pairs], np.uint32) for i in (0, 1))
    got = sums.joined(sums.delimited(left), right, np.array([len(b) for _, b in pairs]))
    assert got.tolist() == [zlib.crc32(a + b" " + b) for a, b in pairs]


def test_weights_and_ranks(spark, odd_docs, odd_rows):
    docs = odd_docs.withColumn("rank", F.lit(1)).withColumn("id", F.lit("x")).withColumn("score", F.lit(2)).withColumn("copies", F.lit(3))
    target = [odd_rows[3][1], "stone birds near water", None, ""]
    out = importance_resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent=40)
    got = out.collect()
    rows, drawn = _expected([r[:2] for r in odd_rows], target, percent=40)
    plain = lambda r: (r["id"] or -1, r["n_words"], r["n_features"], r["weight"], r["score"])
    assert sorted(map(plain, got)) == sorted((r[0] or -1, *r[1:]) for r in rows)
    ranked = sorted(((r["rank"], *plain(r)) for r in got if r["rank"]))
    assert [r[0] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [r[5] for r in ranked] == [r[5] for r in drawn]
    texts = drawn_texts(docs, out).collect()
    held = {(r[0], r[1]) for r in odd_rows}
    assert sorted(r["rank"] for r in texts) == [r[0] for r in drawn]
    assert all((r["id"], r["text"]) in held for r in texts)


def test_very_many_copies_of_a_row(spark, monkeypatch):
    monkeypatch.setattr(copies, "COPIES", 7)
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text)] * 50 + [(i, f"{text} {i}") for i in range(2, 40)] + [(99, "short")] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = importance_resample(docs, docs.limit(1), percent=50).collect()
    assert len(got) == len(rows)
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 45))
    mine = [r["rank"] for r in got if r["id"] == 1 and r["rank"]]
    assert sorted(mine) == list(range(min(mine), min(mine) + len(mine)))


def test_empty_tables(spark, no_docs, odd_docs):
    assert importance_resample(no_docs, odd_docs).collect() == []
    assert importance_resample(odd_docs, no_docs).count() == odd_docs.count()
