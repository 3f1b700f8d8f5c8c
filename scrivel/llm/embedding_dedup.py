"""Near-duplicate vectors by cross-polytope hashing.

A vector is rotated at random by three rounds of sign flips and the fast Hadamard transform; the hash is the axis it then
lies nearest to, with its sign. ``AXES`` such hashes name a bucket, and several independent ones are kept, more for longer vectors,
whose hashes are finer. A vector also enters the ``PROBES`` buckets of each table that cost it the least, so near vectors meet even where their nearest
axes differ. Vectors that meet are compared exactly, in double precision. Of pairs at a cosine of exactly 0.9 some 0.995 share a
bucket, in simulations at 2 to 1,536 dimensions, and more above. An exact setting compares all with all, in blocks.

Equal vectors are one class with a count. A bucket gives counts of links and a spanning forest, never its pairs; a
pair that shares several buckets counts in the smallest. Buckets above ``chunk`` members are dealt out
as pairs of chunks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrivel.llm.components import connected_components
from scrivel.llm.landing import landed
from scrivel.llm.simhash import chunked, in_groups, spanning

AXES, PROBES = 3, 4
#: Share of the pairs at a cosine of 0.9 that meet in one table at 64 dimensions, the power by which it falls with
#: their number, and the share that is to be missed in all tables; the first two are measured.
MEET, FALL, MISSED = 0.485, 0.25, 0.005
#: Vectors of fewer dimensions are turned in this many: in two or three the rotations are few.
FEWEST, TURNED_IN = 4, 32
SEED = 20240229
#: Buckets up to this size are compared pair by pair, many at once; larger ones as matrices.
SMALL = 48
#: Products that are held at once while a large bucket is compared.
STRIPE = 4_000_000
#: Cells of the tables that tell which rows share a smaller bucket.
HELD = 32_000_000
#: Cosines this near to the limit are taken again, one by one, so that rounding is the same in buckets of all sizes.
NEAR_LIMIT = 1e-12


def hadamard(v: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, scaled to keep lengths; the width is a power of two."""
    n, d = v.shape
    h = 1
    while h < d:
        pair = v.reshape(n, d // (2 * h), 2, h)
        v = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return v / np.sqrt(d)


def turned_width(d: int) -> int:
    return TURNED_IN if d < FEWEST else 1 << (d - 1).bit_length()


def tables_for(d: int) -> int:
    """Tables that miss ``MISSED`` of the pairs at a cosine of 0.9 at most."""
    meet = min(MEET, MEET * (64 / turned_width(d)) ** FALL)
    return math.ceil(math.log(MISSED) / math.log(1 - meet))


def bucket_codes(v: np.ndarray, tables: int | None = None, axes: int = AXES, probes: int = PROBES) -> np.ndarray:
    """Buckets of unit vectors: a row of ``tables * probes`` longs each, smaller tables first."""
    n, d = v.shape
    tables = tables or tables_for(d)
    width = turned_width(d)
    padded = np.zeros((n, width))
    padded[:, :d] = v
    signs = np.random.default_rng([SEED, d]).choice([-1.0, 1.0], size=(tables, axes, 3, width))
    near = min(3, width)
    choices = np.array(list(product(range(near), repeat=axes)))
    codes = np.empty((n, tables, probes), np.int64)
    for t in range(tables):
        tops, costs = [], []
        for a in range(axes):
            turned = padded
            for r in range(3):
                turned = hadamard(turned * signs[t, a, r])
            size = np.abs(turned)
            top = np.argsort(-size, axis=1, kind="stable")[:, :near]
            value = np.take_along_axis(size, top, 1)
            tops.append(2 * top + (np.take_along_axis(turned, top, 1) < 0))
            costs.append((value[:, :1] - value) ** 2)
        cost = sum(costs[a][:, choices[:, a]] for a in range(axes))
        least = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        code = np.zeros((n, len(choices)), np.int64)
        for a in range(axes):
            code = code * (2 * width) + tops[a][:, choices[:, a]]
        best = np.take_along_axis(code, least, 1)
        codes[:, t] = np.sort(best, 1) if best.shape[1] == probes else np.sort(np.resize(best, (n, probes)), 1)
    codes += np.arange(tables)[:, None] * np.int64((2 * width) ** axes)
    return codes.reshape(n, -1)


def unit(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled to length 1 in double precision, and which rows have a direction."""
    v = v.astype(np.float64)
    fine = np.isfinite(v).all(axis=1) & (v != 0).any(axis=1)
    v = np.where(fine[:, None], v, 1.0)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True)), fine


def _plain(vector: Column, kind: str) -> Column:
    """Negative zeros as zeros, so that equal vectors have equal hashes."""
    return F.transform(vector, lambda x: x + F.lit(0).cast(kind))


class _Bucket:
    """Links of the vectors of whole buckets: counts per vector and a forest."""

    def __init__(self, least: float, probes: int):
        self.least, self.probes = least, probes

    def near(self, v, i, j):
        return np.einsum("ij,ij->i", v[i], v[j]) >= self.least

    def small(self, v, n, codes, bucket, i, j, links, edges):
        """Pairs i, j of row numbers."""
        near = self.near(v, i, j)
        i, j = i[near], j[near]
        if not len(i):
            return
        a, b = (codes[k].reshape(len(k), -1, self.probes) for k in (i, j))
        same = (a[:, :, :, None] == b[:, :, None, :]).any(axis=3)
        shared = np.where(same, a, np.iinfo(np.int64).max).min(axis=(1, 2))
        first = shared == bucket[i]
        np.add.at(links, i[first], n[j[first]])
        np.add.at(links, j[first], n[i[first]])
        edges.append((i[first], j[first]))

    def large(self, v, n, codes, bucket, left, right, links, edges):
        """Rows ``left`` against rows ``right``; the same rows for a whole bucket."""
        own = left is right
        rows = left if own else np.r_[left, right]
        before = codes[rows]
        before = np.where(before < bucket[rows[0]], before, -1)
        x, y = (before, before) if own else (before[: len(left)], before[len(left) :])
        shared, counts = np.unique(before, return_counts=True)
        shared = shared[counts > 1] if own else np.intersect1d(x, y)
        shared = shared[shared >= 0]
        s, stripe = 0, max(1, min(1024, STRIPE // len(right)))
        while s < len(left):
            part = left[s : s + stripe]
            names = np.intersect1d(x[s : s + stripe], shared)
            if len(names) * (len(part) + len(right)) > HELD and stripe > 1:
                stripe //= 2
                continue
            product = v[part] @ v[right].T
            near = product >= self.least
            r, c = np.nonzero(np.abs(product - self.least) < NEAR_LIMIT)
            near[r, c] = self.near(v, part[r], right[c])
            if len(names):
                near &= self._holds(x[s : s + stripe], names) @ self._holds(y, names).T == 0
            if own:
                near[np.arange(len(part)), s + np.arange(len(part))] = False
            links[part] += near @ n[right]
            if not own:
                links[right] += n[part] @ near
            # Neighbouring partners of a row, and its first one, connect what the row connects.
            r, c = np.nonzero(near)
            if len(r):
                opens = np.r_[True, r[1:] != r[:-1]]
                a = np.where(opens, part[r], right[np.r_[0, c[:-1]]])
                code = np.unique(a * np.int64(len(v)) + right[c])
                edges.append((code // len(v), code % len(v)))
            s += len(part)

    def _holds(self, before, names):
        """Which of the buckets ``names`` each row is in."""
        holds = np.zeros((len(before), len(names)), np.float32)
        at = np.minimum(np.searchsorted(names, before), len(names) - 1)
        r, c = np.nonzero(names[at] == before)
        holds[r, at[r, c]] = 1
        return holds


def _rectangle(codes: np.ndarray, probes: int) -> np.ndarray:
    """Codes of vectors of several lengths, so of several numbers of tables; the last table stands for those that are missing."""
    most = max(map(len, codes))
    return np.stack([np.r_[c, np.tile(c[-probes:], (most - len(c)) // probes)] for c in codes])


def near_vectors(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", least: float = 0.9, chunk: int = 1024,
    tables: int | None = None, axes: int = AXES, probes: int = PROBES, exact: bool = False,
) -> DataFrame:
    """Rows ``id, n_links, component_id``: how many other rows have a cosine of ``least`` or more, and the smallest id
    reachable over such links. No pair below ``least`` is linked.

    The number of tables follows from the vectors' length unless it is given, for limits of 0.9 and above; lower ones need more.
    With ``exact`` all vectors of a length are one bucket, whose blocks are compared with each other: every
    link is found, at a cost that grows with the square of the number of different vectors.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, vectors of different
    lengths not with each other. Equal rows and repeated ids are rows of their own and link. A null id never names
    a component that has another. An empty table gives no rows. Other columns are not read.
    """
    kind = vectors.schema[vector].dataType.elementType.simpleString()
    rows = vectors.select(F.col(id).alias("id"), _plain(F.col(vector), kind).alias("vector"))
    counted = rows.filter("size(vector) > 0").groupBy("vector").agg(
        F.count("*").alias("n"), F.min("id").alias("lowest")
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            values = lists.values.to_numpy(zero_copy_only=False)
            starts = lists.offsets.to_numpy()
            sizes = np.diff(starts)
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                raw = values[starts[at][:, None] + np.arange(size)]
                v, fine = unit(raw)
                if not fine.any():
                    continue
                raw, at = raw[fine], at[fine]
                codes = np.zeros((len(at), 1), np.int64) if exact else bucket_codes(v[fine], tables, axes, probes)
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).take(pa.array(at)) for c in ("class", "n", "lowest")),
                    pa.array([r.tobytes() for r in raw], pa.binary()),
                    pa.array(list(codes), pa.list_(pa.int64())),
                ], ["class", "n", "lowest", "raw", "codes"])

    id_kind = vectors.schema[id].dataType.simpleString()
    classes = landed(
        counted.select("vector", "n", "lowest", F.xxhash64("vector").alias("class")).mapInArrow(
            hashed, f"class long, n long, lowest {id_kind}, raw binary, codes array<long>"
        ),
        "vectors",
    )
    # A bucket also goes by the vectors' length: codes of different lengths are different hashes.
    entries = classes.select("class", F.length("raw").alias("bytes"), F.explode(F.array_distinct("codes")).alias("bucket"))
    met = chunked(entries, ["bytes", "bucket"], "class", chunk).select("block", "side", "bucket", "class")
    full = met.join(classes.select("class", "n", "raw", "codes"), "class")
    cell = np.dtype("<f4" if kind == "float" else "<f8")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = _Bucket(least, 1 if exact else probes)
        for table in in_groups(batches, "block", 1 << 13):
            table = table.combine_chunks()
            names, n, block, side, bucket = (
                table.column(c).to_numpy() for c in ("class", "n", "block", "side", "bucket")
            )
            codes = _rectangle(table.column("codes").to_numpy(), work.probes)
            links = np.zeros(len(names), np.int64)
            edges: list[tuple[np.ndarray, np.ndarray]] = []
            cut = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            size = np.diff(np.r_[cut, len(block)])
            raw = table.column("raw").to_pylist()
            whole = np.zeros((len(raw), max(map(len, raw)) // cell.itemsize), cell)
            for i, r in enumerate(raw):
                whole[i, : len(r) // cell.itemsize] = np.frombuffer(r, cell)
            v, _ = unit(whole)
            few = cut[(size <= SMALL)]
            for m in range(2, SMALL + 1):
                starts = few[size[size <= SMALL] == m]
                a, b = np.triu_indices(m, 1)
                step = max(1, (1 << 16) // len(a))
                for s in range(0, len(starts), step):
                    i, j = ((starts[s : s + step, None] + k).ravel() for k in (a, b))
                    if side.any():
                        apart = np.repeat(np.add.reduceat(side, cut) > 0, size)
                        ok = ~apart[i] | (side[i] != side[j])
                        i, j = i[ok], j[ok]
                    work.small(v, n, codes, bucket, i, j, links, edges)
            for s, m in zip(cut[size > SMALL].tolist(), size[size > SMALL].tolist(), strict=True):
                members = np.arange(s, s + m)
                right = members[side[s : s + m] == 1]
                left = members[side[s : s + m] == 0] if len(right) else members
                if len(left):
                    work.large(v, n, codes, bucket, left, right if len(right) else left, links, edges)
            some = np.flatnonzero(links)
            yield _told(names[some], None, links[some])
            parent: dict[int, int] = {}
            for i, j in edges:
                kept = np.array(spanning(names[i], names[j], parent), np.int64).reshape(-1, 2)
                yield _told(kept[:, 0], kept[:, 1], None)

    told = landed(
        full.repartition("block").sortWithinPartitions("block", "side").mapInArrow(linked, "a long, b long, links long"),
        "links",
    )
    links = told.filter("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    tree = connected_components(told.filter("b is not null"), "a", "b")
    rooted = classes.join(tree, F.col("class") == F.col("node"), "left").select(
        "class", "n", "lowest", F.coalesce("component", "class").alias("root")
    )
    lowest = rooted.groupBy("root").agg(F.min("lowest").alias("component_id"))
    known = rooted.join(lowest, "root").join(links, "class", "left").select(
        "class",
        F.lit(True).alias("fine"),
        (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        "component_id",
    )
    marked = rows.select("id", F.xxhash64("vector").alias("class"))
    return marked.join(known, "class", "left").select(
        "id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("fine"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )


def _told(a: np.ndarray, b: np.ndarray | None, links: np.ndarray | None) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int64())
    columns = [pa.array(a), none if b is None else pa.array(b), none if links is None else pa.array(links)]
    return pa.RecordBatch.from_arrays(columns, ["a", "b", "links"])
