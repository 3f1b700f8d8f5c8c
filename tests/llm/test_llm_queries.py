"""The registered queries and the pipeline, against SQL and against what the tables say."""

import base64
import hashlib
import json
import os
import re
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from scrivel.llm import queries
from scrivel.llm.queries import QUERIES

SF_DIR = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test data")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(SF_DIR / "documents.parquet")


def _values(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(frame.where(frame.notna(), None).itertuples(index=False, name=None), key=repr)


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", [name for name, (_, text) in QUERIES.items() if text])
def test_query_matches_sql(spark, sql, name):
    query, text = QUERIES[name]
    got, want = query(spark, str(SF_DIR)).toPandas(), sql.execute(text).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) > 0
    assert _values(got) == _values(want)


@pytest.mark.parametrize("name", [name for name, (_, text) in QUERIES.items() if not text])
def test_query_has_a_row_for_each_document(spark, documents, name):
    got = QUERIES[name][0](spark, str(SF_DIR)).toPandas()
    assert sorted(got["doc_id"]) == sorted(documents["doc_id"])


def _rows(spark, name):
    return QUERIES[name][0](spark, str(SF_DIR)).toPandas().set_index("doc_id").sort_index()


def _texts(documents):
    return documents.set_index("doc_id").sort_index()["text"].fillna("")


def _sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_token_files_hold_the_ids_of_the_library(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got, start = _rows(spark, "op1_token_files"), 0
    for name, text in _texts(documents).items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        assert tuple(got.loc[name, ["start", "n_tokens", "ids_crc32"]]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_fingerprints_bit_by_bit(spark, documents):
    got = _rows(spark, "op3_simhash")
    marks = {}
    for name, text in _texts(documents).items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        marks[name] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert got["fingerprint"].to_dict() == {name: f"{mark:016x}" for name, mark in marks.items()}
    component = {name: name for name in marks}
    for _ in marks:  # the smallest name spreads over links
        spread = {a: min(component[b] for b in marks if (marks[a] ^ marks[b]).bit_count() <= 3) for a in marks}
        if spread == component:
            break
        component = spread
    assert got["component_id"].to_dict() == component


def test_ids_and_texts_of_byte_pairs(spark, documents):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")) as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = _rows(spark, "op9_byte_bpe")
    for name, text in _texts(documents).items():
        ids = library.encode_ordinary(text)
        assert tuple(got.loc[name]) == (len(ids), _sha256(",".join(map(str, ids))), _sha256(text))


def test_base_spans_of_secrets(spark, documents):
    assign = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    got = _rows(spark, "op10_secret_scan")
    for name, text in _texts(documents).items():
        found = [("assign", m.start(), m.end()) for m in re.finditer(assign, text, re.A) if len(m[2]) >= 12]
        found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        kinds = ["assign", "access", "hex"]
        found.sort(key=lambda s: (s[1], kinds.index(s[0])))
        assert tuple(got.loc[name, ["n_assign", "n_access", "n_hex"]]) == tuple(sum(s[0] == k for s in found) for k in kinds)
        line = [":".join(map(str, s)) for s in found]
        assert got.loc[name, "base_sha256"] == _sha256(",".join(line))
        assert set(line) <= set(filter(None, got.loc[name, "spans"].split(",")))


def test_mixing_deals_its_blocks_to_shards(spark, monkeypatch):
    tables, landed = {}, queries.landed
    monkeypatch.setattr(queries, "landed", lambda df, name: tables.setdefault(name, landed(df, name)))
    got = QUERIES["op8_mixing"][0](spark, str(SF_DIR)).toPandas()
    mix = tables["mix"].toPandas()
    assert mix["words"].sum() == got["taken"].sum()
    assert sorted(mix["shard"].unique()) == list(range(16))
    assert mix.groupby("shard").size().max() - mix.groupby("shard").size().min() <= 1
    assert mix["turn"].nunique() == len(mix)


def test_quality_on_held_out_labels(spark):
    got = QUERIES["op5_line_quality"][0](spark, str(SF_DIR)).toPandas()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got["doc_id"]]).all()
    held = got.merge(pd.read_parquet(SF_DIR / "labels.parquet"), on="doc_id").query("held_out")
    assert (held["predicted"] == held["quality"]).mean() > 0.9


def test_stages_of_the_pipeline(spark, documents, tmp_path):
    docs = spark.read.parquet(str(SF_DIR / "documents.parquet"))
    columns, before = docs.columns, set(documents["doc_id"])
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(SF_DIR)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
        ids = [r[0] for r in docs.select("doc_id").collect()]
        assert ids
        assert set(ids) <= before
        if name != "mixing":
            assert name == "tokens" or len(ids) == len(set(ids))
        before = set(ids)
    labels = pd.read_parquet(SF_DIR / "labels.parquet")
    kept = {r[0] for r in spark.read.parquet(str(tmp_path / "quality")).select("doc_id").collect()}
    judged = labels[labels["doc_id"].isin(documents["doc_id"])]
    assert np.mean([(i in kept) == bool(q) for i, q in zip(judged["doc_id"], judged["quality"], strict=True)]) > 0.9


def test_the_pipeline_runs_as_a_whole(spark):
    rows = corpus_pipeline.run(spark, str(SF_DIR)).collect()
    assert rows
    assert all(len(r["ids"]) == r["n_tokens"] for r in rows)
    json.dumps([r["doc_id"] for r in rows])
