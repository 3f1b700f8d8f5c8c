import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from scrivel.llm.components import connected_components
from scrivel.llm.simhash import near_links, simhash_dedup, simhash_groups


def plain_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_reachable(nodes, near):
    parent = list(range(len(nodes)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in near:
        a, b = root(i), root(j)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(nodes))]


def test_fingerprints_and_groups_as_by_brute_force(odd_docs, odd_rows):
    clashing = odd_docs.withColumn("fp", F.lit(1)).withColumn("id", F.lit("x")).withColumn("component", F.lit(0))
    got = sorted(tuple(r) for r in simhash_groups(clashing).fillna(-1, "id").fillna(-1, "component_id").collect())
    marks = [plain_fingerprint(r[1]) for r in odd_rows]
    near = [(i, j) for i in range(len(marks)) for j in range(i) if (marks[i] ^ marks[j]).bit_count() <= 3]
    roots = least_reachable(marks, near)
    least = {}
    for root, row in zip(roots, odd_rows, strict=True):
        if row[0] is not None:
            least[root] = min(least.get(root, row[0]), row[0])
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    want = sorted(
        (-1 if row[0] is None else row[0], fp, least.get(root, -1))
        for row, fp, root in zip(odd_rows, signed, roots, strict=True)
    )
    assert got == want


def test_one_document_of_each_group_stays(odd_docs, odd_rows):
    kept = simhash_dedup(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = [tuple(r) for r in kept.collect()]
    assert set(rows) <= set(odd_rows)
    marks = [plain_fingerprint(r[1]) for r in odd_rows]
    near = [(i, j) for i in range(len(marks)) for j in range(i) if (marks[i] ^ marks[j]).bit_count() <= 3]
    assert len(rows) == len(set(least_reachable(marks, near)))


@pytest.mark.parametrize("chunk", [50, 8192])
@pytest.mark.parametrize("radius", [0, 3, 4])
def test_links_join_what_brute_force_joins(spark, chunk, radius):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(12)]
    marks = set(base)
    for b in base[:3]:
        for _ in range(150):
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                b ^= 1 << bit
            marks.add(b)
            b = rng.choice(base[:3])
    marks = np.array(sorted(marks), np.uint64)
    near = np.argwhere(np.triu(np.bitwise_count(marks[:, None] ^ marks[None, :]) <= radius, 1))
    place = {int(m): i for i, m in enumerate(marks.view(np.int64))}
    links = near_links(spark.createDataFrame([(int(m),) for m in marks.view(np.int64)], "fp long"), radius, chunk)
    got = least_reachable(marks, [(place[r["a"]], place[r["b"]]) for r in links.collect()])
    assert got == least_reachable(marks, near.tolist())


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(250)] + [(i, i + 1) for i in range(500, 600)]
    pairs += [(700, i) for i in range(701, 760)] + [(3, 3), (None, 4), (5, None)]
    links = spark.createDataFrame(pairs, "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(links, "a", "b").collect()}
    linked = [(a, b) for a, b in pairs if a is not None and b is not None and a != b]
    want = least_reachable(range(800), linked)
    assert got == {n: want[n] for pair in linked for n in pair}


def test_no_documents(no_docs):
    assert simhash_groups(no_docs).collect() == []
    assert simhash_dedup(no_docs).collect() == []


def test_one_of_rows_alike_in_every_column_stays(spark):
    rows = [(1, "the same few words here", "x")] * 60 + [(1, "the same few words here", "y")] * 2 + [(2, "quite another text stands there now", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    kept = simhash_dedup(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2]
    assert "row_number" not in kept._jdf.queryExecution().optimizedPlan().toString()
