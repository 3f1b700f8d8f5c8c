"""Exact removal of repeated word sequences by seed and extend.

Every window of ``length`` words is filed under its anchor: the ``seed`` words in it with the smallest hash (winnowing).
Equal windows have equal anchors at equal places, so anchors that occur once cannot hold a repeat and leave early. Neighbouring windows
under one anchor form a run, which carries the match to both sides. Runs whose words agree from end to end match as a whole.
Where runs of one anchor differ, documents fetch the words of one run of each kind; each is joined to the runs that
hold one of its windows first, and the match is extended from the anchor to both sides, word by word, to the
maximal repeat. What remains per document is a list of covered ranges.

Hashes only sort: two anchors of one hash are a larger group, and a window whose hash leads to another one is found out by its words. Words
that are said to agree agree in a cryptographic digest of 128 bits of all of them, or are compared.

Anchors are counted with partial sums before they are shuffled, and runs meet the counts in joins that adaptive
execution may split, so a passage that a third of all documents hold has no task to itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrivel.llm.landing import landed
from scrivel.llm.pieces import sliced

SEED_WORDS = 5
SLICE_BYTES = 2_000_000
#: Bytes of a digest of words.
DIGEST = 16
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_U = np.uint64
_BASE, _WORD_BASE = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


_BYTE_CODE = _mixed(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up = np.cumprod(np.r_[_U(1), np.full(n - 1, self.base, np.uint64)])
            self.down = np.cumprod(np.r_[_U(1), np.full(n - 1, self.inverse, np.uint64)])
        return self.up, self.down

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums of values times powers, from which ``of`` takes any range."""
        up, _ = self.reach(len(values) + 1)
        return np.r_[_U(0), np.cumsum(values * up[: len(values)])]

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * self.down[start]


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes with a blank after each text; starts and ends of the words; the text of each word."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    edge = np.diff(np.r_[True, _BLANK[data]].astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    return data, starts, ends, np.searchsorted(text_ends, starts, side="right")


class Runs:
    """Runs of the windows of texts."""

    def __init__(self, length: int, seed: int = SEED_WORDS):
        if not 0 < seed <= length <= 127:
            raise ValueError("seeds have one word at least and windows, of 127 words at most, hold a seed")
        self.length, self.seed = length, seed
        self.bytes, self.words = _Powers(_BASE), _Powers(_WORD_BASE)

    def of(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        """``text`` (its number), ``start`` (first window), ``many`` (windows), ``place`` (of the seed in the first window), ``seed``,
        and where in ``data`` the words of the run begin and end (``low`` and ``high``)."""
        data, starts, ends, owner = _joined(texts)
        n, seeds = len(starts), self.length - self.seed + 1
        if n < self.length:
            return {}
        hashes = _mixed(self.bytes.of(self.bytes.sums(_BYTE_CODE[data]), starts, ends))
        sums = self.words.sums(hashes)
        at = np.arange(n - self.seed + 1)
        seed_hash = _mixed(self.words.of(sums, at, at + self.seed))
        value, where, width = seed_hash, at, 1
        while width < seeds:  # the first smallest of width seeds, then of more
            step = min(width, seeds - width)
            left = value[:-step] <= value[step:]
            value, where = np.where(left, value[:-step], value[step:]), np.where(left, where[:-step], where[step:])
            width += step
        whole = np.flatnonzero(owner[: n - self.length + 1] == owner[self.length - 1 :])
        if not len(whole):
            return {}
        anchor = where[whole]
        opens = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[whole[1:]] != owner[whole[:-1]])])
        many = np.diff(np.r_[opens, len(whole)])
        first = whole[opens]
        text_first = np.searchsorted(owner, np.arange(len(texts)))
        return {
            "text": owner[first],
            "start": first - text_first[owner[first]],
            "many": many,
            "place": anchor[opens] - first,
            "seed": seed_hash[anchor[opens]].view(np.int64),
            "low": starts[first],
            "high": ends[first + many + self.length - 2],
            "data": data.tobytes(),
        }


def _pairs(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``tag``, the hash of the whole text, tells rows of one id with different texts apart."""
    return docs.select(
        F.col(id).alias("id"),
        F.xxhash64(F.col(text)).alias("tag"),
        F.col(text).cast("binary").alias("text"),
    )


def _batched(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        texts = batch.column("text")
        sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
        for begin, end in sliced(sizes, SLICE_BYTES):
            part = batch.slice(begin, end - begin)
            yield part, [t or b"" for t in part.column("text").to_pylist()]


#: A run's place in one number: its first window, the seed's place in that, and how many windows it has.
_START, _BYTE = 16, 0xFF


def _start(spot: Column) -> Column:
    return F.shiftright(spot, _START)


def _place(spot: Column) -> Column:
    return F.shiftright(spot, 8).bitwiseAND(F.lit(_BYTE)).cast("int")


def _many(spot: Column) -> Column:
    return spot.bitwiseAND(F.lit(_BYTE)).cast("int")


def _row_key(a: str, b: str) -> Column:
    """Equality of id and text of the tables under these names."""
    return F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id")) & (F.col(f"{a}.tag") == F.col(f"{b}.tag"))


def repeated_runs(docs: DataFrame, id: str, text: str, length: int) -> DataFrame:
    """Rows ``seed, id, tag, spot, digest`` of the runs whose anchor occurs more than once; ``digest`` is that of all their words."""
    pairs = _pairs(docs, id, text)
    kind = docs.schema[id].dataType.simpleString()

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(length)
        for _, texts in _batched(batches):
            if found := runs.of([b" ".join(t.split()) for t in texts]):
                yield pa.RecordBatch.from_arrays([pa.array(found["seed"])], ["seed"])

    def spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(length)
        for part, texts in _batched(batches):
            if not (found := runs.of([b" ".join(t.split()) for t in texts])):
                continue
            data, cuts = found["data"], zip(found["low"].tolist(), found["high"].tolist(), strict=True)
            digests = pa.array([sha256(data[a:b]).digest()[:DIGEST] for a, b in cuts], pa.binary())
            own = pa.array(found["text"])
            spot = found["start"] << _START | found["place"] << 8 | found["many"]
            columns = [pa.array(found["seed"]), part.column("id").take(own), part.column("tag").take(own), pa.array(spot), digests]
            yield pa.RecordBatch.from_arrays(columns, ["seed", "id", "tag", "spot", "digest"])

    # Counts are landed before a join, so that both of its sides are plain shuffles that can be split.
    counts = pairs.mapInArrow(seeds, "seed long").groupBy("seed").agg(F.count("*").alias("n"))
    repeated = landed(counts.filter("n > 1").select("seed"), "seeds")

    runs = pairs.mapInArrow(spots, f"seed long, id {kind}, tag long, spot long, digest binary")
    return landed(runs.join(repeated, "seed", "left_semi"), "runs")


def spelled(docs: DataFrame, runs: DataFrame, id: str, text: str, length: int) -> DataFrame:
    """The different ``runs`` (``seed, id, tag, spot``) with their ``words``, fetched from the documents."""
    kind = docs.schema[id].dataType.simpleString()

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, runs in enumerate(batch.column("runs")):
                held = (batch.column("text")[row].as_py() or b"").split()
                seed, spot = (runs.values.field(name) for name in ("seed", "spot"))
                at = spot.to_numpy()
                ends = (at >> _START) + (at & _BYTE) + length - 1
                found = [b" ".join(held[i:j]).decode() for i, j in zip((at >> _START).tolist(), ends.tolist(), strict=True)]
                own = pa.array(np.full(len(at), row))
                columns = [seed, batch.column("id").take(own), batch.column("tag").take(own), spot, pa.array(found, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["seed", "id", "tag", "spot", "words"])

    pairs = _pairs(docs, id, text)
    lists = landed(runs.groupBy("id", "tag").agg(F.collect_set(F.struct("seed", "spot")).alias("runs")), "spots")
    wanted = pairs.alias("p").join(lists.alias("l"), _row_key("p", "l")).select("p.id", "p.tag", "p.text", "l.runs")
    # Rows alike in id and text spell the same words.
    return wanted.mapInArrow(words, f"seed long, id {kind}, tag long, spot long, words string").dropDuplicates(["seed", "id", "tag", "spot"])


def _common(a: Column, b: Column) -> Column:
    """How many elements two arrays have in common from their beginnings on."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False))
    return F.when(differs > 0, differs - 1).otherwise(F.least(F.size(a), F.size(b))).cast("int")


def extended(pairs: DataFrame, length: int) -> DataFrame:
    """Rows ``id, tag, start, many`` of the maximal repeats of runs (``id, tag, spot, words``) in the runs
    (``first``) that they are joined to at the seed, as long as a window at least."""
    own, other = F.split("words", " "), F.split("first.words", " ")
    staged = pairs.select(
        "id", "tag", _start(F.col("spot")).alias("start"), _place(F.col("spot")).alias("at"), own.alias("own"),
        _place(F.col("first.spot")).alias("other_at"), other.alias("other"),
    )
    before = lambda words, at: F.reverse(F.slice(words, F.lit(1), F.col(at)))
    behind = lambda words, at: F.slice(words, F.col(at) + 1, F.size(words))
    met = staged.select(
        "id", "tag", "start", "at",
        _common(before("own", "at"), before("other", "other_at")).alias("left"),
        _common(behind("own", "at"), behind("other", "other_at")).alias("right"),
    )
    many = F.col("left") + F.col("right") - length + 1
    return met.select("id", "tag", (F.col("start") + F.col("at") - F.col("left")).alias("start"), many.alias("many")).filter("many > 0")


def covered_runs(docs: DataFrame, id: str, text: str, length: int) -> DataFrame:
    """Rows ``id, tag, start, many``: windows from ``start`` on whose words also start earlier."""
    runs = repeated_runs(docs, id, text, length)
    # Order of occurrences: id, then start, then tag. Equal words have equal anchors at equal places, so a digest is a key.
    spot = F.struct("id", "spot", "tag")
    kinds = landed(runs.groupBy("digest").agg(F.min(spot).alias("first"), F.first("seed").alias("seed"), F.count("*").alias("n")), "kinds")
    later = F.struct("id", "spot") > F.struct("first.id", "first.spot")
    whole = (
        runs.drop("seed")
        .join(kinds.filter("n > 1").select("digest", "first"), "digest")
        .filter(later)
        .select("id", "tag", _start(F.col("spot")).alias("start"), _many(F.col("spot")).alias("many"))
    )
    several = kinds.groupBy("seed").agg(F.count("*").alias("n")).filter("n > 1")
    mixed = landed(several.select("seed"), "mixed")
    # The first run of each kind stands for all of them, under a number of its own.
    firsts = kinds.select("seed", "first.*").join(mixed, "seed", "left_semi")
    cut = spelled(docs, firsts, id, text, length).withColumn("split", F.split("words", " "))

    def window(nth: Column) -> Column:
        words = F.slice(F.col("split"), nth + 1, F.lit(length))
        return F.struct((_start(F.col("spot")) + nth).alias("start"), F.xxhash64(words).alias("h"), F.xxhash64(F.lit(1), words).alias("g"))

    windows = F.transform(F.sequence(F.lit(0), _many(F.col("spot")) - 1), window).alias("windows")
    own = landed(cut.select("id", "tag", "spot", "words", windows, F.monotonically_increasing_id().alias("kind")), "own")
    parts = own.select("kind", "id", F.explode("windows").alias("w")).select("kind", "id", "w.*")
    earliest = landed(
        parts.groupBy("h", "g")
        .agg(F.count("*").alias("n"), F.min(F.struct("id", "start", "kind")).alias("first"))
        .filter("n > 1")
        .drop("n"),
        "windows",
    )
    met = (
        parts.join(earliest, ["h", "g"])
        .filter(F.struct("id", "start") > F.struct("first.id", "first.start"))
        .select("kind", F.col("first.kind").alias("of"))
        .distinct()
    )
    theirs = own.select(F.col("kind").alias("of"), F.struct("spot", "words").alias("first"))
    both = met.join(own.select("kind", "id", "tag", "spot", "words"), "kind").join(theirs, "of")
    return whole.unionByName(extended(both, length)).distinct()


def remove_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = 20
) -> DataFrame:
    """Rows ``id, n_words, n_removed, kept``: each text without the words of windows of ``length`` words that also
    start earlier, at a smaller id or earlier in the same text. ``kept`` are the rest, joined by blanks.

    Words are separated by 0x20 and 0x09 to 0x0D and compared as they are. Windows are judged on the
    input. Null and empty texts have no words; texts shorter than a window stay. Null ids come first.
    Rows of one id are parts of one document that start together: a window in one of them repeats another's
    if it starts later. Repeated rows are judged alike and each give a row. An empty table gives no rows. Other columns are not read.
    """
    # Landed, so that the shuffles behind them are gone when the texts are shuffled to meet them.
    ranges = landed(covered_runs(docs, id, text, length), "ranges")
    lists = ranges.groupBy("id", "tag").agg(
        F.collect_list(F.col("start") * 128 + F.col("many")).alias("ranges")
    )
    kind = docs.schema[id].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, covered in zip(batch.column("text"), batch.column("ranges"), strict=True):
                words = (text.as_py() or b"").split()
                if covered.is_valid:
                    code = covered.values.to_numpy()
                    ends = code // 128 + code % 128 + length - 1
                    turn = np.zeros(len(words) + 1, np.int64)
                    np.add.at(turn, code // 128, 1)
                    np.add.at(turn, ends, -1)
                    stay = np.flatnonzero(np.cumsum(turn[:-1]) == 0).tolist()
                    out.append((len(words), len(words) - len(stay), b" ".join([words[i] for i in stay]).decode()))
                else:
                    out.append((len(words), 0, b" ".join(words).decode()))
            n, gone, kept = zip(*out, strict=True) if out else ((), (), ())
            columns = [batch.column("id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_removed", "kept"])

    pairs, lists = _pairs(docs, id, text).alias("p"), lists.alias("l")
    same = F.col("p.id").eqNullSafe(F.col("l.id")) & (F.col("p.tag") == F.col("l.tag"))
    schema = T.StructType([
        T.StructField("id", kind), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()),
    ])
    return pairs.join(lists, same, "left").select("p.id", "p.text", "l.ranges").mapInArrow(run, schema)
