"""Near-duplicate documents by SimHash fingerprints compared bit-sliced.

A fingerprint has one bit per position of the shingles' XXH64 hashes, set where more than half of
them are set. Fingerprints at most ``radius`` bits apart are linked; links make groups.

Finding them: the 64 bits are cut into ``radius + 3`` bands. Two fingerprints within the radius agree in
at least three whole bands, so they meet in one of the buckets keyed by three bands. A bucket's members are stored as
bit planes, 64 fingerprints to a machine word, and one fingerprint is compared with 64 others by
a carry-save counter over the planes; a block is left as soon as all its lanes are
beyond the radius. Buckets above ``chunk`` members are dealt out as pairs of chunks, so no task holds
a whole one, and a bucket yields a spanning forest of its links instead of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrivel.llm.components import connected_components
from scrivel.llm.copies import one_of_each
from scrivel.llm.landing import landed

SEED = 42
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_ITEMS = 1 << 17
#: Row v: the bits of byte v, lowest first.
_BYTE_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of one UTF-8 text, as an unsigned number; 0 without words."""
    plain = b" ".join(text.lower().split())  # of bytes: A-Z only, split at 0x20 and 0x09-0x0D
    if not plain:
        return 0
    blanks = np.flatnonzero(np.frombuffer(plain, np.uint8) == 32)
    if len(blanks) < shingle:
        return xxhash.xxh64_intdigest(plain, SEED)
    starts = [0, *(blanks[: len(blanks) - shingle + 1] + 1).tolist()]
    ends = [*blanks[shingle - 1 :].tolist(), len(plain)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(plain[s:e], SEED) for s, e in zip(starts, ends, strict=True)], "<u8")
    columns = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(columns[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id: str, text: str, shingle: int) -> DataFrame:
    """Rows ``id`` and ``fp``, the fingerprint as a signed long, over whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(t or b"", shingle) for t in batch.column(1).to_pylist()]
            fps = pa.array(np.array(marks, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], ["id", "fp"])

    pair = docs.select(F.col(id).alias("id"), F.col(text).cast("binary").alias("text"))
    return pair.mapInArrow(run, f"id {docs.schema[id].dataType.simpleString()}, fp long")


def _planes(blocks: np.ndarray) -> np.ndarray:
    """Blocks of 64 fingerprints to 64 bit planes each: out[bit, block] has a lane per member."""
    out = np.empty((64, len(blocks)), np.uint64)
    for at in range(0, len(blocks), 2048):
        part = np.ascontiguousarray(blocks[at : at + 2048])
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 64, 8), axis=2, bitorder="little")
        lanes = np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little")
        out[:, at : at + 2048] = np.ascontiguousarray(lanes).view("<u8")[:, :, 0].T
    return out


def _within(query: np.ndarray, block: np.ndarray, out: np.ndarray, planes: np.ndarray, radius: int):
    """Compare query i with all lanes of block i. ``out``: lanes not to look at.
    Gives the items that have a lane within the radius, and these lanes."""
    width = max(1, radius.bit_length())
    bias = (1 << width) - 1 - radius  # the counter overflows at the first bit too many
    index = np.arange(len(query))
    count = [np.full(len(query), _ALL if bias >> j & 1 else 0, np.uint64) for j in range(width)]
    for bit in range(64):
        carry = planes[bit][block] ^ (np.uint64(0) - ((query >> np.uint64(bit)) & np.uint64(1)))
        for j in range(width):
            count[j], carry = count[j] ^ carry, count[j] & carry
        out = out | carry
        if bit % 4 == 3:
            live = out != _ALL
            if not live.all():
                query, block, out, index = query[live], block[live], out[live], index[live]
                count = [c[live] for c in count]
                if not len(index):
                    break
    return index, ~out


def _lanes(masks: np.ndarray) -> np.ndarray:
    return np.unpackbits(masks.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)


def linked(fps: np.ndarray, group: np.ndarray, side: np.ndarray, radius: int):
    """Links that span the near fingerprints of each group; rows come sorted by group and side.

    A group with members of side 1 is a pair of chunks: only links across are looked for. Yields
    arrays of row numbers ``a, b``: first matching lane with its query, and neighbouring matches, so
    what matches a query is connected without writing every pair.
    """
    n = len(fps)
    cut = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (side[1:] != side[:-1])])
    size = np.diff(np.r_[cut, n])
    blocks = -(-size // 64)
    first_block = np.r_[0, np.cumsum(blocks)]
    run_of = np.repeat(np.arange(len(cut)), size)
    inside = np.arange(n) - cut[run_of]
    slot = first_block[run_of] * 64 + inside
    store = np.zeros(first_block[-1] * 64, np.uint64)
    row_at = np.full(first_block[-1] * 64, -1)
    store[slot], row_at[slot] = fps, np.arange(n)
    planes = _planes(store.reshape(-1, 64))
    empty = np.packbits((row_at < 0).reshape(-1, 64), axis=1, bitorder="little").view("<u8")[:, 0]
    # The run of lanes that a row is compared with: that of side 1 if there is one, else its own.
    across = np.r_[(group[cut[1:]] == group[cut[:-1]]), False] if len(cut) > 1 else np.zeros(len(cut), bool)
    second = np.r_[False, across[:-1]]
    target = np.where(across, np.arange(len(cut)) + 1, np.arange(len(cut)))[run_of]
    own = target == run_of
    start = first_block[target] + np.where(own, inside // 64, 0)
    todo = np.where(second[run_of], 0, first_block[target + 1] - start)
    ends = np.cumsum(todo)
    for at in range(0, int(ends[-1]) if n else 0, _ITEMS):
        item = np.arange(at, min(at + _ITEMS, int(ends[-1])))
        row = np.searchsorted(ends, item, side="right")
        block = start[row] + item - (ends[row] - todo[row])
        out = empty[block].copy()
        here = own[row] & (block == first_block[target[row]] + inside[row] // 64)
        upto = (inside[row] % 64).astype(np.uint64)  # lanes up to its own were queries before
        out |= np.where(here, _ALL >> (np.uint64(63) - upto), np.uint64(0))
        hit, masks = _within(fps[row], block, out, planes, radius)
        if not len(hit):
            continue
        lane_of, lane = np.nonzero(_lanes(np.ascontiguousarray(masks)))
        other = row_at[block[hit][lane_of] * 64 + lane]
        opens = np.r_[True, lane_of[1:] != lane_of[:-1]]
        a = np.where(opens, row[hit][lane_of], np.r_[0, other[:-1]])
        pairs = np.unique(a * np.int64(n) + other)
        yield pairs // n, pairs % n


def spanning(a: np.ndarray, b: np.ndarray, parent: dict[int, int]) -> list[tuple[int, int]]:
    """Those of the links that join two trees; ``parent`` keeps the trees."""
    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        rx, ry = x, y
        while (up := parent.get(rx, rx)) != rx:
            parent[rx] = parent.get(up, up)
            rx = up
        while (up := parent.get(ry, ry)) != ry:
            parent[ry] = parent.get(up, up)
            ry = up
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            kept.append((x, y))
    return kept


def in_groups(batches: Iterator[pa.RecordBatch], key: str, least: int) -> Iterator[pa.Table]:
    """Rows that come sorted by ``key``, in tables of whole groups with ``least`` rows or more."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < least:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column(key).to_numpy()
        before = np.flatnonzero(keys != keys[-1])
        if len(before):
            whole = int(before[-1]) + 1
            yield table.slice(0, whole)
            held, rows = table.slice(whole).to_batches(), table.num_rows - whole
    if held:
        yield pa.Table.from_batches(held)


def chunked(rows: DataFrame, key: list[str], member: str, chunk: int) -> DataFrame:
    """Rows of keys with two members or more, with ``block``, a hash of key and chunk pair that tasks work on,
    and ``side`` (0 or 1). A key above ``chunk`` members is dealt out as pairs of its chunks; chunks grow with the root of
    its members, since every member is sent once for each chunk."""
    # Landed, so that the join has plain shuffles on both sides, which can be split where a key is hot.
    counts = landed(rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1"), "counts")
    parts = F.least(F.ceil(F.col("n") / F.lit(chunk)), F.ceil(F.sqrt("n") / 8))
    met = rows.join(counts, key).withColumn("parts", parts.cast("int"))
    own = F.pmod(F.xxhash64(F.lit(7), F.col(member)), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = met.withColumn("own", own).withColumn("other", other)
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return dealt.withColumn("side", (F.col("own") > F.col("other")).cast("int")).withColumn(
        "block", F.xxhash64(*key, low, high)
    ).drop("n", "parts", "own", "other")


def near_links(nodes: DataFrame, radius: int = 3, chunk: int = 8192) -> DataFrame:
    """Pairs ``a, b`` that join what links within the radius join (distinct longs ``fp``). A pair is a link
    itself or two links to a third one."""
    bands = radius + 3
    edges = [64 * i // bands for i in range(bands + 1)]
    masks = [sum((1 << edges[i + 1]) - (1 << edges[i]) for i in c) for c in combinations(range(bands), 3)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.explode(
        F.array(*(F.struct(F.lit(i).alias("band"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("bits"))
                  for i, m in enumerate(signed)))
    )
    rows = nodes.select("fp", keys.alias("k")).select("fp", "k.band", "k.bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in in_groups(batches, "block", 1 << 15):
            fps = table.column("fp").to_numpy()
            group, side = (table.column(c).to_numpy() for c in ("block", "side"))
            parent: dict[int, int] = {}
            for a, b in linked(fps.view(np.uint64), group, side, radius):
                kept = np.array(spanning(a, b, parent), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(fps[kept[:, 0]]), pa.array(fps[kept[:, 1]])], ["a", "b"])

    blocks = chunked(rows, ["band", "bits"], "fp", chunk).select("block", "side", "fp")
    return (
        blocks.repartition("block")
        .sortWithinPartitions("block", "side", "fp")
        .mapInArrow(run, "a long, b long")
    )


def simhash_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """Rows ``id, fp, component_id``: the fingerprint and the smallest id reachable over links.

    Null and empty texts, and those without words, have fingerprint 0, linked like any other. A
    text with fewer words than a shingle is one shingle. Repeated rows and ids are each a row of the
    result. A null id is never a component's id; a component of null ids only has a null one. An empty table gives no rows. Other columns are not
    read, whatever their names.
    """
    marks = landed(fingerprints(docs, id, text, shingle), "fingerprints")
    nodes = landed(marks.groupBy("fp").agg(F.min("id").alias("lowest")), "fingerprints")
    tree = connected_components(near_links(nodes.select("fp"), radius), "a", "b")
    root = F.coalesce("component", "fp").alias("root")
    rooted = nodes.join(tree, F.col("fp") == F.col("node"), "left").select("fp", "lowest", root)
    lowest = rooted.groupBy("root").agg(F.min("lowest").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "component_id")
    return marks.join(named, "fp").select("id", "fp", "component_id")


def simhash_dedup(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """One document of each group, with all its columns: that of the smallest id, among repeated ids that
    of the smallest row hash. Documents of null ids come last in their group; of rows that
    are alike in every column one stays."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    row = F.xxhash64(*(c.cast("string") for c in names))
    keyed = docs.withColumn("__mark", F.struct(F.isnull(id).alias("none"), F.col(id).alias("id"), row.alias("row")))
    groups = simhash_groups(keyed, "__mark", text, shingle, radius)
    kept = groups.select(F.col("component_id").alias("__kept")).distinct()
    same = F.col("__mark").eqNullSafe(F.col("__kept"))
    return one_of_each(keyed, "__mark").join(kept, same).select(*names)
