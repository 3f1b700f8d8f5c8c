"""Token ids in files of fixed-width bits.

A file holds the ids of consecutive documents, each id in the fewest bits that the vocabulary needs. Ids lie in
blocks of a fixed number; every block starts at a byte, so any range is read by seeking to its
blocks and unpacking them with numpy. Layout, little-endian throughout:

    blocks      ids, lowest bit first
    tables      doc ids (int64), whether each is there (uint8), first id of each document and the end (int64),
                byte offset of each block and the end (int64)
    footer      position of the tables, documents, ids, blocks, ids per block, bits, magic (7 x int64)

Files are written by tasks under names that no other attempt uses. The manifest, a table that Spark commits, names
those that count, so a task that is run again or lost leaves nothing that is read.
"""

from __future__ import annotations

import io
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from scrivel.llm.landing import landed
from scrivel.llm.pieces import Dictionary, sliced

MAGIC = 0x31534449544946
BLOCK_IDS = 4096
SLICE_BYTES = 8_000_000
MAX_WORDS = 500_000
READ_IDS = 4_000_000
#: Signs that end a word of letters as a token of their own; an apostrophe may join what follows.
_TAIL = b"!\"#$%&*+,-./:;<=>?@|~"


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype("<u4")
    planes = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")[: n * bits]
    weights = np.uint32(1) << np.arange(bits, dtype=np.uint32)
    return (planes.reshape(n, bits) * weights).sum(1, dtype=np.uint32).astype("<u4")


class TokenFileWriter:
    """Takes documents one after another; holds less than a block of ids beside the tables."""

    def __init__(self, out: io.RawIOBase, bits: int, block_ids: int = BLOCK_IDS):
        self.out, self.bits, self.block_ids = out, bits, block_ids
        self.names: list[int | None] = []
        self.first, self.offsets, self.at, self.rest = [0], [0], 0, np.zeros(0, np.int64)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _block(self, ids: np.ndarray) -> None:
        self._put(pack(ids, self.bits))
        self.offsets.append(self.at)

    def add(self, names: list[int | None], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Documents and their ids, laid end to end."""
        if len(ids) and int(ids.max()) >> self.bits:
            raise ValueError(f"id {ids.max()} takes more than {self.bits} bits")
        self.names += names
        self.first += (self.first[-1] + np.cumsum(sizes)).tolist()
        held = np.r_[self.rest, ids]
        whole = len(held) - len(held) % self.block_ids
        for i in range(0, whole, self.block_ids):
            self._block(held[i : i + self.block_ids])
        self.rest = held[whole:]

    def close(self) -> tuple[int, int]:
        """Write the rest; gives the numbers of documents and ids."""
        if len(self.rest):
            self._block(self.rest)
        tables, docs = self.at, len(self.names)
        self._put(np.array([n or 0 for n in self.names], "<i8").tobytes())
        self._put(np.array([n is not None for n in self.names], "u1").tobytes())
        self._put(np.array(self.first, "<i8").tobytes())
        self._put(np.array(self.offsets, "<i8").tobytes())
        foot = [tables, docs, self.first[-1], len(self.offsets) - 1, self.block_ids, self.bits, MAGIC]
        self._put(np.array(foot, "<i8").tobytes())
        self.out.close()
        return docs, self.first[-1]


class TokenFile:
    """Random access to a file: documents, and any range of ids."""

    def __init__(self, file: pa.NativeFile):
        self.file = file
        size = file.size()
        foot = np.frombuffer(file.read_at(56, size - 56), "<i8").tolist()
        if foot[6] != MAGIC:
            raise ValueError("not a file of token ids")
        tables, docs, self.n_ids, blocks, self.block_ids, self.bits, _ = foot
        data = file.read_at(size - 56 - tables, tables)
        names = np.frombuffer(data, "<i8", docs)
        there = np.frombuffer(data, "u1", docs, 8 * docs)
        self.first = np.frombuffer(data, "<i8", docs + 1, 9 * docs)
        self.offsets = np.frombuffer(data, "<i8", blocks + 1, 17 * docs + 8)
        self.names = pa.array(names, mask=there == 0)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids from ``start`` to before ``end``, as unsigned numbers of 32 bits."""
        if start >= end:
            return np.zeros(0, "<u4")
        low, high = start // self.block_ids, -(-end // self.block_ids)
        n = min(high * self.block_ids, self.n_ids) - low * self.block_ids
        begin = int(self.offsets[low])
        data = self.file.read_at(int(self.offsets[high]) - begin, begin)
        per_block = self.block_ids * self.bits
        if per_block % 8:  # blocks end within a byte, so each is unpacked by itself
            cuts = [(int(self.offsets[b]) - begin, min(self.block_ids, self.n_ids - b * self.block_ids)) for b in range(low, high)]
            parts = [unpack(data[at : at + -(-k * self.bits // 8)], self.bits, k) for at, k in cuts]
            ids = np.concatenate(parts)
        else:
            ids = unpack(data, self.bits, n)
        return ids[start - low * self.block_ids : end - low * self.block_ids]


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder as a URI of the file system that Spark would use."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub("^file:/+", "file:///", full)


def _opened(uri: str, write: bool = False):
    system, path = fs.FileSystem.from_uri(uri)
    if not write:
        return system.open_input_file(path)
    system.create_dir(os.path.dirname(path), recursive=True)
    return system.open_output_stream(path)


def word_encoder(tokenizer: Tokenizer):
    """A function from words (UTF-8, no white space inside) to their ids, as ``Dictionary`` wants it.

    The vocabulary's normalizer and splitter never look across white space, so a text's ids are its words'
    ids. Words of letters go to the model directly, in the form that the normalizer and the byte step would give;
    all others go the whole way.
    """
    table = {ord(k): v for k, v in zip((chr(b) for b in range(256)), _byte_signs(), strict=True)}
    tails: dict[bytes, list[int]] = {}

    def generic(words: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        model = tokenizer.model.tokenize
        out: list[list[int]] = []
        later: list[int] = []
        for word in words:
            core = word.rstrip(_TAIL)
            letters = core.lower() if core.isalpha() else b""
            if not letters:
                text = core.decode()
                # Letters with their lower case in the same normal form; the rest may need the normalizer.
                if text.isalpha() and all(c in _PLAIN for c in text if c > "\x7f"):
                    letters = text.lower().encode()
            if not letters:
                later.append(len(out))
                out.append([])
                continue
            ids = [t.id for t in model(letters.decode("latin-1").translate(table))]
            if len(core) < len(word):
                tail = word[len(core) :]
                if tail not in tails:
                    tails[tail] = generic([tail.decode()])[0]
                ids += tails[tail]
            out.append(ids)
        for i, ids in zip(later, generic([words[i].decode() for i in later]), strict=True):
            out[i] = ids
        sizes = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter((i for ids in out for i in ids), np.int32, int(sizes.sum())), sizes

    return encode


#: Letters from U+00C0 to U+017F whose lower case is one letter: composed, so NFC leaves them as they are.
_PLAIN = frozenset(chr(c) for c in range(0xC0, 0x180) if chr(c).isalpha() and chr(c) not in "İŉſ")


def _byte_signs() -> list[str]:
    """The sign that the byte step writes for each byte."""
    step = ByteLevel(add_prefix_space=False, use_regex=False)
    signs = {}
    for text in [chr(c) for c in range(0x80)] + [chr(c) for c in range(0x80, 0x800, 1)] + ["က", "\U00010000"]:
        for byte, sign in zip(text.encode(), step.pre_tokenize_str(text)[0][0], strict=True):
            signs[byte] = sign
    return [signs.get(b, chr(b)) for b in range(256)]


def write_token_files(
    docs: DataFrame, tokenizer_path: str, folder: str, id: str = "doc_id", text: str = "text", end_id: int = 1
) -> DataFrame:
    """Encode whole texts and write them in ascending ``id`` order. Gives the manifest: ``part`` in that order,
    ``path``, ``n_docs``, ``n_ids``, ``bits``.

    ``id`` is a whole number; ``end_id`` closes each document. Null and empty texts are the end id alone. Null
    ids come first; rows of equal ids lie in order of a hash of their texts, repeated rows side by side, and both may fill
    several files. An empty table gives no file and an empty manifest. Other columns are not read. Marks of special tokens are only
    found where the tokenizer's file declares them. ``tokenizer_path`` has to be readable by the workers.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder)
    bits = (Tokenizer.from_file(tokenizer_path).get_vocab_size() - 1).bit_length()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        part = TaskContext.get().partitionId()
        path = f"{folder}/part-{part:08d}-{uuid.uuid4().hex}.ids"
        encode = word_encoder(Tokenizer.from_file(tokenizer_path))
        words, writer = Dictionary(encode), None
        for batch in batches:
            texts = batch.column(1)
            sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
            for begin, end in sliced(sizes, SLICE_BYTES):
                writer = writer or TokenFileWriter(_opened(path, write=True), bits)
                if len(words.number) > MAX_WORDS:
                    words = Dictionary(encode)
                number = words.number.__getitem__
                found = [
                    np.fromiter(map(number, (t.as_py() or b"").split()), np.int64)
                    for t in texts.slice(begin, end - begin)
                ]
                words.learn()
                ids = [np.r_[words.encoded(f), end_id] for f in found]
                names = batch.column(0).slice(begin, end - begin).to_pylist()
                writer.add(names, np.concatenate(ids), np.array([len(i) for i in ids]))
        if writer:
            n_docs, n_ids = writer.close()
            row = {"part": [part], "path": [path], "n_docs": [n_docs], "n_ids": [n_ids], "bits": [bits]}
            yield pa.RecordBatch.from_pydict(row)

    content = F.col(text).cast("binary")
    pair = docs.select(F.col(id).cast("long").alias("id"), content.alias("text"), F.xxhash64(content).alias("mark"))
    # Rows alike in id and text may go to any file, so the task that read them deals out what is left of a hot id.
    spread = pair.withColumn("task", F.spark_partition_id())
    ordered = spread.repartitionByRange("id", "mark", "task").sortWithinPartitions("id", "mark", "text")
    schema = "part long, path string, n_docs long, n_ids long, bits long"
    return landed(ordered.mapInArrow(run, schema), "manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Rows ``id``, ``start`` (ids of all documents before it) and ``ids``, unsigned 32-bit numbers as
    little-endian bytes. Long files are read by several tasks."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    cuts = F.ceil(F.col("n_ids") / F.lit(READ_IDS))
    step = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / cuts))
    ranges = based.withColumn("low", F.explode(F.sequence(F.lit(0), F.col("n_docs") - 1, step))).select(
        "path", "base", "low", F.least(F.col("low") + step, "n_docs").alias("high")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with _opened(row["path"]) as file:
                    held = TokenFile(file)
                    low, high = row["low"], row["high"]
                    first = held.first[low : high + 1]
                    data = held.ids(int(first[0]), int(first[-1])).tobytes()
                    cuts = (4 * (first - first[0])).tolist()
                    ids = [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
                    yield pa.RecordBatch.from_arrays(
                        [held.names.slice(low, high - low), pa.array(row["base"] + first[:-1]), pa.array(ids, pa.binary())],
                        ["id", "start", "ids"],
                    )

    # By number, so that the few rows that stand for large files stay apart.
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(parts, "path", "low").mapInArrow(run, "id long, start long, ids binary")
