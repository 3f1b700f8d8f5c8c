import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scrivel.llm import fill_middle
from scrivel.llm.fill_middle import fill_in_middle, rearranged, restored, units


def _formed(name, text):
    """Form, cuts and output of one text, spelled out."""
    digest = hashlib.sha256(f"1:{'' if name is None else name}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return "plain", None, None, text
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h[3] % 100 < 20:
        return "spm", low, high - low, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return "psm", low, high - low, f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("slice_bytes", [64, fill_middle.SLICE_BYTES])
def test_forms_and_their_texts(spark, odd_docs, odd_rows, slice_bytes, monkeypatch):
    marked = [(1000, "a <P> b", "en", "s", 1), (1001, "x" * 50 + "<M>", "en", "s", 1), (1002, "<", "en", "s", 1)]
    docs = odd_docs.unionByName(spark.createDataFrame(marked, odd_docs.schema))
    docs = docs.withColumn("output", F.lit(1)).withColumn("id", F.lit("x")).withColumn("form", F.lit(2)).withColumn("of", F.lit(2))
    monkeypatch.setattr(fill_middle, "SLICE_BYTES", slice_bytes)
    out = fill_in_middle(docs).withColumn("back", restored(F.col("output"), F.col("form")))
    got = sorted((repr(r["id"]), r["text"], r["form"], repr(r["prefix_chars"]), repr(r["middle_chars"]), r["output"], r["back"], r["n"]) for r in out.collect())
    want = []
    for name, text, *_ in [*odd_rows, *marked]:
        text = text or ""
        form, low, size, output = _formed(name, text)
        want.append((repr(name), text, form, repr(low), repr(size), output, text, len(text)))
    assert got == sorted(want)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_small_slices_and_long_texts(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("aß漢🙂 <") for _ in range(rng.choice([0, 1, 5, 40, 400]))) for _ in range(60)]
    forms = [rng.choice(["plain", "psm", "spm"]) for _ in texts]
    cuts = [sorted((rng.randint(0, len(t)), rng.randint(0, len(t)))) for t in texts]
    arrays = pa.array(texts), pa.array(forms), *(pa.array(c, pa.int64()) for c in zip(*cuts, strict=True))
    whole = rearranged(*arrays).to_pylist()
    monkeypatch.setattr(fill_middle, "SLICE_BYTES", 100)
    assert rearranged(*arrays).to_pylist() == whole
    assert rearranged(*(a.slice(7, 30) for a in arrays)).to_pylist() == whole[7:37]
    for text, form, (low, high), out in zip(texts, forms, cuts, whole, strict=True):
        p, m, s = text[:low], text[low:high], text[high:]
        assert out == {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]


def test_units_are_code_points():
    texts = ["aß漢🙂", "", "x", "é"]
    assert units(pa.array(["zz", *texts]).slice(1)).to_pylist() == [list(t) for t in texts]


def test_all_plain_and_none_plain(spark, odd_docs):
    assert {r["form"] for r in fill_in_middle(odd_docs, plain=100).collect()} == {"plain"}
    cut = fill_in_middle(odd_docs, plain=0, spm=100).filter("n > 0")
    assert {r["form"] for r in cut.collect()} == {"spm"}


def test_no_documents(no_docs):
    assert fill_in_middle(no_docs).collect() == []
