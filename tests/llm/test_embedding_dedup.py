import numpy as np
import pytest
from pyspark.sql import functions as F

from scrivel.llm import embedding_dedup
from scrivel.llm.embedding_dedup import bucket_codes, hadamard, near_vectors, unit

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def brute(vectors):
    v = np.asarray(vectors, np.float32).astype(float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    near = v @ v.T >= 0.9
    np.fill_diagonal(near, False)
    label = np.arange(len(v))
    while True:
        lower = np.array([min([label[i], *label[near[i]]]) for i in range(len(v))])
        if (lower == label).all():
            return near.sum(axis=1).tolist(), label.tolist()
        label = lower


@pytest.fixture(scope="module")
def groups():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 64))
    near = [base[i] + rng.normal(size=(40, 64)) * s for i, s in enumerate((0.05, 0.15, 0.2))]
    return np.concatenate([base, *near, np.repeat(base[5:6], 70, axis=0), base[5:6] * 3])


def test_hadamard_keeps_lengths_and_undoes_itself():
    v = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(hadamard(hadamard(v)), v)
    assert np.allclose((hadamard(v) ** 2).sum(axis=1), (v**2).sum(axis=1))


@pytest.mark.parametrize("width", [2, 3, 4, 24, 64, 128, 256, 768, 1024])
def test_pairs_at_the_limit_meet_in_a_bucket(width):
    rng = np.random.default_rng(1)
    n = 3000 if width < 200 else 1000
    x, _ = unit(rng.normal(size=(n, width)))
    y = rng.normal(size=(n, width))
    y, _ = unit(y - (y * x).sum(axis=1, keepdims=True) * x)
    a, b = bucket_codes(x), bucket_codes(0.9 * x + np.sqrt(0.19) * y)
    met = [bool(set(p) & set(q)) for p, q in zip(a.tolist(), b.tolist(), strict=True)]
    assert np.mean(met) > 0.985


@pytest.mark.parametrize("chunk", [20, 4096])
def test_links_and_components_as_by_brute_force(spark, groups, chunk):
    got = near_vectors(frame(spark, groups), chunk=chunk).orderBy("id").collect()
    links, label = brute(groups)
    assert [r["component_id"] for r in got] == label
    assert all(r["n_links"] <= n for r, n in zip(got, links, strict=True))
    assert sum(r["n_links"] for r in got) >= 0.98 * sum(links)


def test_vectors_without_a_direction_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [None, None, [], [], [0, 0], [0, 0], [nan, 1], [nan, 1], [inf, 1], [None, 1], [None, 1], [1, 2], [1, 2, 0], [-0.0, 1], [0.0, 1]]
    got = near_vectors(frame(spark, vectors)).orderBy("id").collect()
    assert [r["n_links"] for r in got] == [0] * 13 + [1, 1]
    assert [r["component_id"] for r in got] == [*range(14), 13]


def test_repeated_and_null_ids(spark):
    rows = [(None, [1.0, 0.0], 0), (4, [1.0, 0.0], 0), (4, [1.0, 0.0], 0), (None, [0.0, 1.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("class", F.lit(1)).withColumn("n", F.lit("x"))
    got = sorted(map(str, near_vectors(df).collect()))
    assert got == sorted(
        [f"Row(id={i}, n_links={n}, component_id={c})" for i, n, c in ((None, 2, 4), (4, 2, 4), (4, 2, 4), (None, 0, None))]
    )


def test_no_vectors(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_lengths_in_one_table_and_large_buckets(spark, monkeypatch):
    """Each length has tables of its own; stripes of few rows give what stripes of many do."""
    rng = np.random.default_rng(4)
    base = [rng.normal(size=d) for d in (2, 5, 64, 300) for _ in range(2)]
    vectors = [b + rng.normal(size=len(b)) * 0.05 for b in base for _ in range(80)]
    want = None
    for held in (embedding_dedup.HELD, 500):
        monkeypatch.setattr(embedding_dedup, "HELD", held)
        got = [tuple(r) for r in near_vectors(frame(spark, vectors)).orderBy("id").collect()]
        assert want in (None, got)
        want = got
    plain = brute_by_length(vectors)
    assert sum(r[1] for r in got) >= 0.99 * sum(plain)


def brute_by_length(vectors):
    out = np.zeros(len(vectors), int)
    for d in {len(v) for v in vectors}:
        at = [i for i, v in enumerate(vectors) if len(v) == d]
        out[at] = brute([vectors[i] for i in at])[0]
    return out.tolist()


def test_the_exact_setting_finds_every_link(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(12, 8))
    vectors = [b + rng.normal(size=8) * s for b in base for s in (0.1, 0.25, 0.3, 0.35) for _ in range(9)]
    links, label = brute(vectors)
    for chunk in (30, 4096):
        got = near_vectors(frame(spark, vectors), chunk=chunk, exact=True).orderBy("id").collect()
        assert [r["n_links"] for r in got] == links
        assert [r["component_id"] for r in got] == label


def test_pairs_at_the_very_limit_are_judged_alike_in_buckets_of_all_sizes(spark):
    """Cosines of 0.9 but for rounding: few together, and the same among many others."""
    rng = np.random.default_rng(6)
    a = rng.normal(size=(40, 16))
    b = rng.normal(size=(40, 16))
    a, b = unit(a)[0], unit(b - (b * unit(a)[0]).sum(axis=1, keepdims=True) * unit(a)[0])[0]
    pairs = np.concatenate([np.stack([a, 0.9 * a + np.sqrt(0.19) * b], 1).reshape(80, 16)])
    schema = "vec_id long, embedding array<double>"
    rows = lambda v: spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], schema)
    few = [near_vectors(rows(pairs[i : i + 2]), exact=True).agg(F.sum("n_links")).first()[0] for i in range(0, 20, 2)]
    many = near_vectors(rows(pairs), exact=True).orderBy("id").collect()
    v = unit(pairs)[0]
    plain = (np.einsum("ik,jk->ij", v, v) >= 0.9).sum(axis=1) - 1
    assert len({0, 2} | set(few)) == 2
    for i, n in zip(range(0, 20, 2), few, strict=True):
        alone = np.einsum("ij,ij->i", v[i : i + 1], v[i + 1 : i + 2])[0] >= 0.9
        assert n == 2 * alone
        others = int(plain[i]) - int(np.einsum("ik,jk->ij", v[i : i + 1], v[i + 1 : i + 2])[0, 0] >= 0.9)
        assert many[i]["n_links"] == others + alone
