"""Byte-level BPE by replaying the merges over a whole slice of the corpus at once.

A text is cut into pieces by a pattern; a piece's ids depend on nothing but its bytes. So each task
gathers the distinct pieces of its slice, lays their bytes end to end and applies the merges to all
of them together, in rank order: an index from rank to the positions of its pairs says where a
merge applies, and only the pairs to the left and right of a merged one are looked up again.

The dictionary is one per task on purpose. A corpus-wide one would have to come back to the texts, which takes a
shuffle of the pieces of every task and one of the texts, while replaying a piece again in another task costs
microseconds and nothing else.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from scrivel.llm.columns import Batches, add_column
from scrivel.llm.pieces import Dictionary, sliced, spread

#: Bytes of text whose new pieces are replayed together, and words a task remembers.
SLICE_BYTES = 2_000_000
MAX_WORDS = 200_000
_NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * (1 + max(int(rank) for _, rank in pairs))
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def piece_pattern(pattern: str) -> regex.Pattern:
    """The pattern with white space as Unicode defines it; Python's class has four control characters more."""
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


class Merges:
    """The vocabulary as lookups: ids of bytes, and for a pair of ids the id it merges to."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.rank = {token: i for i, token in enumerate(tokens) if token}
        missing = [b for b in range(256) if bytes([b]) not in self.rank]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes: {missing[:5]}")
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        keys, merged = [], []
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.r_[np.array(keys, np.int64)[order], np.iinfo(np.int64).max]
        self.merged = np.r_[np.array(merged, np.int32)[order], _NONE]

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs' merges; ``_NONE`` where there is none."""
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.merged[at], _NONE)

    def one(self, piece: bytes) -> list[int]:
        """Ids of one piece, always merging the leftmost pair of the lowest rank."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        rank = self.rank.get
        heap = [(r, i) for i in range(len(parts) - 1) if (r := rank(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if parts[i] else -1
            if j < 0 or rank(parts[i] + parts[j]) != r:
                continue
            parts[i], parts[j] = parts[i] + parts[j], b""
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a >= 0 and b >= 0 and (r := rank(parts[a] + parts[b])) is not None:
                    heapq.heappush(heap, (r, a))
        return [self.rank[p] for p in parts if p]

    def replay(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces end to end, and how many each has."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(data)
        if not n:
            return np.zeros(0, np.int32), lengths
        piece_of = np.repeat(np.arange(len(pieces)), lengths)
        last = np.cumsum(lengths)[lengths > 0] - 1
        first = np.r_[0, last[:-1] + 1]
        sym = self.byte[data]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[last], before[first] = -1, -1
        rank = np.full(n, _NONE, np.int32)
        inner = np.flatnonzero(after >= 0)
        rank[inner] = self.of(sym[inner], sym[inner + 1])
        alive = np.ones(n, bool)
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []
        odd: list[np.ndarray] = []

        def add(at: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]])
            ends = np.r_[cuts[1:], len(at)]
            for r, s, e in zip(ranks[cuts].tolist(), cuts.tolist(), ends.tolist(), strict=True):
                if r in index:
                    index[r].append(at[s:e])
                else:
                    index[r] = [at[s:e]]
                    heapq.heappush(heap, r)

        inner = np.flatnonzero(rank != _NONE)
        if len(inner):
            add(inner, rank[inner])
        while heap:
            r = heapq.heappop(heap)
            found = index.pop(r)
            at = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
            at = at[rank[at] == r]
            if not len(at):
                continue
            gone = after[at]
            touching = gone[:-1] == at[1:]
            if touching.any():  # as in "aaa": of pairs that share a symbol, every other one from the left
                opens = np.flatnonzero(np.r_[True, ~touching])
                nth = np.arange(len(at)) - np.repeat(opens, np.diff(np.r_[opens, len(at)]))
                at, gone = at[nth % 2 == 0], gone[nth % 2 == 0]
            right = after[gone]
            has = right >= 0
            # A merge that opens a pair of lower rank, even for a moment, is left to one().
            early = self.of(np.full(int(has.sum()), r, np.int32), sym[right[has]]) < r
            odd.append(piece_of[at[has][early]])
            sym[at] = r
            alive[gone], rank[gone] = False, _NONE
            after[at] = right
            before[right[has]] = at[has]
            left = before[at]
            left = left[left >= 0]
            rank[at] = _NONE
            pairs = np.concatenate([at[has], left])
            new = self.of(sym[pairs], sym[after[pairs]])
            rank[pairs] = new
            odd.append(piece_of[pairs[new < r]])
            keep = new != _NONE
            if keep.any():
                add(*self._distinct(pairs[keep], new[keep]))
        ids, owners = sym[alive], piece_of[alive]
        redo = np.unique(np.concatenate(odd)) if odd else np.zeros(0, np.int64)
        if len(redo):
            stay = ~np.isin(owners, redo)
            again = [(p, self.one(pieces[p])) for p in redo.tolist()]
            owners = np.r_[owners[stay], np.repeat(redo, [len(x) for _, x in again])]
            ids = np.r_[ids[stay], np.array([i for _, x in again for i in x], np.int32)]
            order = np.argsort(owners, kind="stable")
            ids, owners = ids[order], owners[order]
        return ids.astype(np.int32), np.bincount(owners, minlength=len(pieces))

    @staticmethod
    def _distinct(at: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, first = np.unique(at, return_index=True)
        return at, ranks[first]


def piece_ids(merges: Merges, fresh: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the pieces end to end, and how many each has. A piece that is a token is that token."""
    raw = [p.encode() for p in fresh]
    whole = np.array([merges.rank.get(p, -1) for p in raw], np.int64)
    rest = np.flatnonzero(whole < 0)
    ids, sizes = merges.replay([raw[i] for i in rest.tolist()])
    counts = np.ones(len(fresh), np.int64)
    counts[rest] = sizes
    start = np.cumsum(counts) - counts
    laid = np.empty(int(counts.sum()), np.int32)
    laid[start[whole >= 0]] = whole[whole >= 0]
    laid[spread(start[rest], sizes)] = ids
    return laid, counts


class Words:
    """Ids of texts by their words. A text may be cut at any blank that follows something other than white space, because a
    piece begins there whatever comes next; so equal words have equal ids."""

    def __init__(self, merges: Merges, pattern: str):
        self.cut = piece_pattern(pattern).findall
        self.pieces = Dictionary(lambda fresh: piece_ids(merges, fresh))
        self.words = Dictionary(self._encode)

    def numbers(self, text: str) -> np.ndarray:
        """Numbers of the words: a string is a word with a blank before it, a tuple holds any stretch as it is."""
        if _SPACED(text):
            keys = [(part,) for part in _CUTS.split(text)]
        else:
            first, *keys = text.split(" ")
            keys.insert(0, (first,))
        return np.fromiter(map(self.words.number.__getitem__, keys), np.int64, len(keys))

    def _encode(self, fresh: list[str | tuple[str]]) -> tuple[np.ndarray, np.ndarray]:
        number = self.pieces.number.__getitem__
        cut = [self.cut(word[0] if isinstance(word, tuple) else " " + word) for word in fresh]
        flat = np.fromiter((number(p) for found in cut for p in found), np.int64)
        self.pieces.learn()
        of_word = np.repeat(np.arange(len(cut)), [len(found) for found in cut])
        sizes = np.bincount(of_word, weights=np.diff(self.pieces.start)[flat], minlength=len(cut))
        return self.pieces.encoded(flat), sizes.astype(np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts end to end, and how many each has."""
        if len(self.words.number) > MAX_WORDS:
            self.pieces, self.words = Dictionary(self.pieces.encode), Dictionary(self._encode)
        found = [self.numbers(t) for t in texts]
        self.words.learn()
        ids = [self.words.encoded(f) for f in found]
        return np.concatenate([np.zeros(0, np.int32), *ids]), np.array([len(i) for i in ids], np.int64)


_SPACED = re.compile(r"\s ").search
_CUTS = regex.compile(r"(?<=\P{White_Space})(?= )", regex.V1)


def bpe_encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """All rows and columns with ``out``, the ids of the whole text, as array<int>.

    Null and empty texts have no ids. No special token is recognised. Texts of any length and any
    characters are encoded; rows are independent, so ties, repeated and no rows need no rule. A column that is
    called as ``out`` is replaced. ``ranks_path`` has to be readable by the workers.
    """

    def run(batches: Batches) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
        words = Words(Merges(read_ranks(ranks_path)), pattern)
        for batch in batches:
            texts = batch.column("of")
            sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
            for begin, end in sliced(sizes, SLICE_BYTES):
                part = batch.slice(begin, end - begin)
                ids, counts = words.encode([t.as_py() or "" for t in part.column("of")])
                starts = np.r_[0, np.cumsum(counts)].astype(np.int32)
                yield part, pa.ListArray.from_arrays(pa.array(starts), pa.array(ids))

    return add_column(docs, text, out, T.ArrayType(T.IntegerType(), False), run)


def bpe_decode(encoded: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All rows and columns with ``out``, the bytes that the ids stand for. Null ids give null."""

    def run(batches: Batches) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
        tokens = read_ranks(ranks_path)
        size = np.array([len(t) for t in tokens], np.int64)
        laid, start = np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(size) - size
        for batch in batches:
            lists = batch.column("of")
            counts = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_pylist()
            for begin, end in sliced(counts, SLICE_BYTES // 8):
                part = batch.slice(begin, end - begin)
                given = part.column("of").flatten().to_numpy(zero_copy_only=False)
                data = laid[spread(start[given], size[given])].tobytes()
                many = np.r_[0, np.cumsum(counts[begin:end])]
                cuts = np.r_[0, np.cumsum(size[given])][many].tolist()
                there = part.column("of").is_valid().to_pylist()
                plain = [data[a:b] if ok else None for ok, a, b in zip(there, cuts, cuts[1:], strict=False)]
                yield part, pa.array(plain, pa.binary())

    return add_column(encoded, ids, out, T.BinaryType(), run)
