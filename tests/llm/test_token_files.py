import io
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scrivel.llm.landing import new_path
from scrivel.llm.token_files import (
    TokenFile,
    TokenFileWriter,
    pack,
    read_token_files,
    unpack,
    word_encoder,
    write_token_files,
)

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("bits", [1, 5, 11, 16, 17, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 4097)
    data = pack(ids, bits)
    assert len(data) == -(-len(ids) * bits // 8)
    assert (unpack(data, bits, len(ids)) == ids).all()


@pytest.mark.parametrize(("bits", "block"), [(16, 8), (11, 8), (5, 3), (17, 4096)])
def test_any_range_of_a_file_is_read(bits, block):
    class Held(io.BytesIO):
        def close(self):
            self.kept = self.getvalue()

    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 2**bits, n) for n in (0, 1, 40, 7, 0, 23)]
    out = Held()
    writer = TokenFileWriter(out, bits, block)
    for i, ids in enumerate(docs):
        writer.add([None if i == 1 else i], ids, np.array([len(ids)]))
    assert writer.close() == (6, 71)
    file = TokenFile(pa.BufferReader(out.kept))
    assert file.names.to_pylist() == [0, None, 2, 3, 4, 5]
    ids = np.concatenate(docs)
    for start in range(0, 71, 5):
        for end in range(start, 72, 3):
            assert file.ids(start, end).tolist() == ids[start:end].tolist()


def test_too_large_an_id_is_refused():
    with pytest.raises(ValueError, match="bits"):
        TokenFileWriter(io.BytesIO(), 4).add([1], np.array([16]), np.array([1]))


def test_words_give_the_ids_of_the_whole_text(tokenizer):
    encode, rng = word_encoder(tokenizer), random.Random(5)
    odd = ["Théâtre", "STRASSE", "straße", "ÇA!!", "İstanbul", "ΣΑΣ", "J̌", "áb", "don't", "l'eau,", "12a", "ﬁ", " "]
    for _ in range(400):
        text = rng.choice([" ", "\n"]).join(rng.choice(odd) for _ in range(rng.randint(0, 12)))
        text += "".join(chr(rng.randint(1, 0x24F)) for _ in range(rng.randint(0, 20)))
        ids, _ = encode(text.encode().split())
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_files_hold_all_documents_in_order(spark, odd_docs, odd_rows, tokenizer):
    clashing = odd_docs.withColumn("ids", F.lit(1)).withColumn("id", F.lit("x")).withColumn("part", F.lit(2))
    manifest = write_token_files(clashing, PATH, new_path(spark, "ids"))
    got = sorted(read_token_files(manifest).collect(), key=lambda r: r["start"])
    marks = {r["text"]: r["mark"] for r in odd_docs.select("text", F.xxhash64(F.col("text").cast("binary")).alias("mark")).collect()}
    want = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, marks[r[1]]))
    at = 0
    for row, (name, text, *_) in zip(got, want, strict=True):
        ids = np.frombuffer(row["ids"], "<u4").tolist()
        assert (row["id"], row["start"]) == (name, at)
        assert ids == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        at += len(ids)


def test_no_documents(spark, no_docs):
    manifest = write_token_files(no_docs, PATH, new_path(spark, "ids"))
    assert manifest.count() == 0
    assert read_token_files(manifest).collect() == []


@pytest.mark.parametrize("id", [7, None])
@pytest.mark.parametrize("alike", [False, True])
def test_rows_of_one_id_fill_several_files(spark, tokenizer, id, alike):
    rows = [(id, "same words" if alike else f"text {i}") for i in range(4000)] + [(8, "after")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), PATH, new_path(spark, "ids"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["n_docs"] for r in manifest.collect()]
    assert sum(sizes) == 4001
    assert len(sizes) > 3
    assert max(sizes) < 2000
    got = sorted(read_token_files(manifest).collect(), key=lambda r: r["start"])
    assert [r["id"] for r in got] == [id] * 4000 + [8]
    want = sorted(tuple(tokenizer.encode(t, add_special_tokens=False).ids) + (1,) for _, t in rows)
    assert sorted(tuple(np.frombuffer(r["ids"], "<u4").tolist()) for r in got) == want
