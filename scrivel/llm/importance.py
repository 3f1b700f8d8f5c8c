"""Documents drawn by their likeness to a target corpus: hashed word runs, gains per bucket, Gumbel noise.

A slice's distinct words, each between two delimiters, are the dictionary of an Aho-Corasick automaton and carry their CRC-32
and length as payload. A scan emits the payload of every word in order. A checksum of two texts end to end
follows from theirs and the second one's length, so the buckets of word runs are composed from
neighbouring payloads and no run is ever spelled out.

Texts are scanned once. The buckets of their runs are landed, two bytes each, to be counted and, once the counts are known, weighed.
Buckets are a parameter, not data: counts per bucket are the only thing that comes to the driver and goes back to the tasks.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrivel.llm.copies import written_out
from scrivel.llm.landing import landed
from scrivel.llm.pieces import sliced
from scrivel.operators.skew import running

SLICE_BYTES = 4_000_000
_CHUNK = 1024
_DELIMITER, _END = 0x20, -1
# ASCII letters in lower case and digits; everything beyond ASCII belongs to words.
_SIGNS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else _DELIMITER for c in range(256)
)
# Fixed value: the polynomial of CRC-32, lowest power first.
_POLYNOMIAL = 0xEDB88320
_ONES = np.uint32(0xFFFFFFFF)


def _byte_table() -> np.ndarray:
    rest = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        rest = np.where(rest & np.uint32(1), rest >> np.uint32(1) ^ np.uint32(_POLYNOMIAL), rest >> np.uint32(1))
    return rest


class Checksums:
    """CRC-32 of texts put together from the CRC-32 of their parts."""

    def __init__(self):
        self.byte = _byte_table()
        quarters = np.arange(256, dtype=np.uint32) << np.uint32([[0], [8], [16], [24]])
        self.doubled = [self.byte[quarters & np.uint32(255)] ^ quarters >> np.uint32(8)]

    def _by(self, k: int, sums: np.ndarray) -> np.ndarray:
        """Sums carried over 2**k zero bytes; a linear map, looked up for the four bytes of a sum."""
        while len(self.doubled) <= k:
            self.doubled.append(self._by(len(self.doubled) - 1, self.doubled[-1]))
        a, b, c, d = self.doubled[k]
        low, byte = np.uint32(255), np.uint32(8)
        return a[sums & low] ^ b[sums >> byte & low] ^ c[sums >> byte * 2 & low] ^ d[sums >> byte * 3]

    def joined(self, left: np.ndarray, right: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Checksums of texts followed by others of these sizes."""
        moved = left.copy()
        for k in range(int(size.max(initial=0)).bit_length()):
            at = np.flatnonzero(size >> k & 1)
            moved[at] = self._by(k, moved[at])
        return moved ^ right

    def delimited(self, sums: np.ndarray) -> np.ndarray:
        """Checksums of the texts with a delimiter behind."""
        inner = sums ^ _ONES
        return self.byte[(inner ^ np.uint32(_DELIMITER)) & np.uint32(255)] ^ inner >> np.uint32(8) ^ _ONES


def _scanned(signs: bytes) -> np.ndarray:
    """Payloads (length and checksum) of all words, in order; -1 where a document ends, which a NUL marks."""
    distinct = set(signs.split(b" "))
    distinct.discard(b"")
    if not distinct:
        return np.zeros(0, np.int64)
    dictionary = ahocorasick.Automaton()
    for word in distinct:
        payload = _END if word == b"\0" else len(word) << 32 | zlib.crc32(word)
        dictionary.add_word(f" {word.decode('latin-1')} ", payload)
    dictionary.make_automaton()
    return np.fromiter(map(itemgetter(1), dictionary.iter(f" {signs.decode('latin-1')} ")), np.int64)


def _chunks(signs: bytes) -> Iterator[bytes]:
    """A long document cut between words."""
    at = 0
    while len(signs) - at > SLICE_BYTES:
        cut = signs.rfind(b" ", at, at + SLICE_BYTES)
        cut = cut if cut >= at else signs.find(b" ", at)
        if cut < 0:
            break
        yield signs[at:cut]
        at = cut + 1
    yield signs[at:]


def word_payloads(texts: list[bytes]) -> np.ndarray:
    """Payloads of all words of all texts, with -1 behind each text."""
    signs = [t.translate(_SIGNS) for t in texts]
    if len(signs) == 1:
        return np.r_[*map(_scanned, _chunks(signs[0])), _END]
    return _scanned(b" \0 ".join([*signs, b""]))


class Features:
    """Buckets of the runs of 1 to ``most`` consecutive words of texts."""

    def __init__(self, most: int, buckets: int):
        self.most, self.buckets, self.sums = most, buckets, Checksums()

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bucket of every run, the text it is from, and the number of words of each text."""
        payload = word_payloads(texts)
        ends = payload == _END
        words = np.flatnonzero(~ends)
        owner = (np.cumsum(ends) - ends)[words]
        checksum, size = (payload[words] & 0xFFFFFFFF).astype(np.uint32), payload[words] >> 32
        found, owners, run = [checksum], [owner], checksum
        for n in range(1, self.most):
            run = self.sums.joined(self.sums.delimited(run[:-1]), checksum[n:], size[n:])
            inside = owner[n:] == owner[: len(run)]
            found.append(run[inside])
            owners.append(owner[n:][inside])
        buckets = np.concatenate(found) % np.uint32(self.buckets)
        return buckets, np.concatenate(owners), np.bincount(owner, minlength=len(texts))


    def laid(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The buckets text after text, where each text's begin and the last one's end, and the number of words of each."""
        bucket, owner, n_words = self.of(texts)
        ends = np.cumsum(np.bincount(owner, minlength=len(texts)))
        return bucket[np.argsort(owner, kind="stable")], np.r_[0, ends], n_words


def _code(buckets: int) -> np.dtype:
    return np.dtype("<u2" if buckets <= 1 << 16 else "<u4")


def run_buckets(texts: DataFrame, id: str | None, text: str, most: int, buckets: int) -> DataFrame:
    """Rows ``id, tag, n_words, codes``: the buckets of a text's word runs, end to end. Without ``id`` that is null."""
    content = F.col(f"`{text}`")
    name = F.lit(None).cast("long") if id is None else F.col(f"`{id}`")
    given = texts.select(name.alias("id"), F.xxhash64(content).alias("tag"), content.cast("binary").alias("text"))
    code = _code(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(most, buckets)
        for batch in batches:
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_pylist()
            for begin, end in sliced(sizes, SLICE_BYTES):
                part = batch.slice(begin, end - begin)
                laid, cuts, n_words = features.laid([t or b"" for t in part.column("text").to_pylist()])
                offsets = pa.py_buffer((cuts * code.itemsize).astype(np.int32))
                codes = pa.Array.from_buffers(pa.binary(), len(part), [None, offsets, pa.py_buffer(laid.astype(code).tobytes())])
                columns = [part.column("id"), part.column("tag"), pa.array(n_words), codes]
                yield pa.RecordBatch.from_arrays(columns, ["id", "tag", "n_words", "codes"])

    fields = ("id", given.schema["id"].dataType), ("tag", T.LongType()), ("n_words", T.LongType()), ("codes", T.BinaryType())
    return given.mapInArrow(run, T.StructType([T.StructField(*f) for f in fields]))


def _held(codes: pa.Array, code: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All codes of a batch end to end, and where each row's begin and the last one's end."""
    _, offsets, data = codes.buffers()
    cuts = np.frombuffer(offsets, np.int32, len(codes) + 1, 4 * codes.offset).astype(np.int64) // code.itemsize
    laid = np.frombuffer(data, code, int(cuts[-1])) if data else np.zeros(0, code)
    return laid[cuts[0] :], cuts - cuts[0]


def bucket_counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """How many word runs of all rows of :func:`run_buckets` fall into each bucket; tasks count, and their counts are added."""
    code = _code(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            counts += np.bincount(_held(batch.column("codes"), code)[0], minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["bucket", "n"])

    total = np.zeros(buckets, np.int64)
    counted = rows.select("codes").mapInArrow(run, "bucket long, n long")
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():  # a row for each bucket at most
        total[bucket] = n
    return total


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of target over source frequency, rounded down; each bucket counts one more than it holds."""
    s_all, t_all, buckets = int(source.sum()), int(target.sum()), len(source)
    pairs = zip(source.tolist(), target.tolist(), strict=True)
    gains = [
        math.floor(1000 * math.log((float(t + 1) * float(s_all + buckets)) / (float(s + 1) * float(t_all + buckets))))
        for s, t in pairs
    ]
    return np.array(gains, np.int64)


def importance_weights(rows: DataFrame, gains: np.ndarray) -> DataFrame:
    """Rows ``id, tag, n_words, n_features, weight``: the mean gain of a text's runs, rounded down, and 0 without any."""
    code = _code(len(gains))
    names = ("n_words", "n_features", "weight")
    fields = ("id", rows.schema["id"].dataType), ("tag", T.LongType()), *((c, T.LongType()) for c in names)
    schema = T.StructType([T.StructField(*f) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            laid, cuts = _held(batch.column("codes"), code)
            so_far = np.r_[0, np.cumsum(gains[laid])]
            n = np.diff(cuts)
            weight = (so_far[cuts[1:]] - so_far[cuts[:-1]]) // np.maximum(n, 1)
            columns = [batch.column("id"), batch.column("tag"), batch.column("n_words"), pa.array(n), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return rows.mapInArrow(run, schema)


def _noise(id: F.Column, seed: int) -> F.Column:
    """Thousandths of Gumbel noise from a hash of the id, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def importance_resample(
    docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", target_text: str = "text",
    most: int = 2, buckets: int = 10_000, least_words: int = 20, percent: int = 25, seed: int = 7,
) -> DataFrame:
    """Rows ``id, tag, n_words, n_features, weight, score, rank``, one for each document.

    ``percent`` of the documents with ``least_words`` words are drawn, rounded down: those of the highest score, ties to the smaller
    id, then the smaller ``tag`` (a hash of the text). ``rank`` counts them from 1 and is null for all others. The noise in a score depends on ``seed``
    and the id alone, so a run can be repeated.

    Words are runs of ASCII letters, in lower case, ASCII digits and everything beyond ASCII. Null and empty texts have none and
    weigh 0. A null id counts as an empty text in the hash and comes first in ties. Repeated rows each have a row and
    a rank of their own. Without documents there are no rows, without target texts all buckets count one in it. Other columns are not read.

    Scores are whole numbers whose noise puts less than 0.04 % of all ids on one of them, so ranks
    inside a score are counted apart; rows alike in id and text are counted before and written out after.
    """
    found = landed(run_buckets(docs, id, text, most, buckets), "buckets")
    wanted = bucket_counts(run_buckets(target, None, target_text, most, buckets), buckets)
    weighed = importance_weights(found, bucket_gains(bucket_counts(found, buckets), wanted))
    rows = weighed.groupBy(*weighed.columns).agg(F.count("*").alias("copies"))
    scored = landed(rows.withColumn("score", F.col("weight") + _noise(F.col("id"), seed)), "scores")
    fit = scored.filter(F.col("n_words") >= least_words)
    n = fit.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    each = landed(fit.groupBy("score").agg(F.sum("copies").alias("n")).withColumn("place", -F.col("score")), "counts")
    higher = running(each, [], "place", _CHUNK, F.col("n"), "sum", "higher", before=True)
    order = Window.partitionBy("score").orderBy("id", "tag").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("higher") + F.coalesce(F.sum("copies").over(order), F.lit(0))
    ranked = fit.join(higher.select("score", "higher"), "score").withColumn("before", before).select(*scored.columns, "before")
    others = scored.filter(F.col("n_words") < least_words).withColumn("before", F.lit(None).cast("long"))
    written = written_out(ranked.unionByName(others), ["id", "tag"], "before", "copies")
    rank = F.when(F.col("nth") <= n * percent // 100, F.col("nth"))
    return written.select("id", "tag", "n_words", "n_features", "weight", "score", rank.alias("rank"))


def drawn_texts(docs: DataFrame, ranked: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``rank, id, text`` of what :func:`importance_resample` has drawn from ``docs``; equal rows as often as drawn."""
    texts = docs.select(F.col(f"`{id}`").alias("__id"), F.xxhash64(F.col(f"`{text}`")).alias("__tag"), F.col(f"`{text}`").alias("text"))
    single = landed(texts.groupBy("__id", "__tag").agg(F.first("text").alias("text")), "texts")
    same = F.col("id").eqNullSafe(F.col("__id")) & (F.col("tag") == F.col("__tag"))
    return ranked.filter("rank IS NOT NULL").join(single, same).select("rank", "id", "text")
