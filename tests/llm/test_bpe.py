import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from scrivel.llm.bpe import Merges, bpe_decode, bpe_encode, piece_pattern, read_ranks

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {token: i for i, token in enumerate(read_ranks(PATH)) if token}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n):
    rng = random.Random(n)
    signs = [10, 13, 32, 0x85, 0x1C, 0x1F, 0xA0, 0x2028, 0x301, 0x1F642, 0x6F22]
    for _ in range(n):
        yield "".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))
        yield "".join(chr(rng.choice([rng.randint(32, 126), rng.randint(1, 0x24F), *signs])) for _ in range(rng.randint(0, 80)))
        yield "".join(rng.choice(["the ", "tion", " ", "  ", "\n", "'s", "12", "!!"]) for _ in range(rng.randint(0, 50)))
        yield rng.choice(["a", "=", "-", "aab", "é", " "]) * rng.randint(1, 900)


def test_ids_as_the_library_gives_them(library):
    merges, cut = Merges(read_ranks(PATH)), piece_pattern(public_tokenizers.PATTERN).findall
    texts = list(odd_texts(150))
    pieces = sorted({p for t in texts for p in cut(t)})
    ids, sizes = merges.replay([p.encode() for p in pieces])
    at = 0
    for piece, size in zip(pieces, sizes.tolist(), strict=True):
        want = library._encode_single_piece(piece)
        assert piece.encode() in merges.rank or ids[at : at + size].tolist() == want
        assert merges.one(piece.encode()) == ids[at : at + size].tolist()
        at += size


def test_a_vocabulary_whose_later_merges_come_first():
    """A merge may open a pair of lower rank; the leftmost lowest pair still goes first."""
    single = [bytes([b]) for b in range(256)]
    rng = random.Random(4)
    for _ in range(60):
        longer = list({"".join(rng.choice("abc") for _ in range(rng.randint(2, 5))).encode() for _ in range(12)})
        rng.shuffle(longer)
        merges = Merges(single + longer)
        words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 14))).encode() for _ in range(40)]
        ids, sizes = merges.replay(words)
        want = [plain(merges.rank, w) for w in words]
        assert ids.tolist() == [i for x in want for i in x]
        assert sizes.tolist() == [len(x) for x in want]


def plain(rank, word):
    parts = [word[i : i + 1] for i in range(len(word))]
    while True:
        pairs = [(rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in rank]
        if not pairs:
            return [rank[p] for p in parts]
        _, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_documents_and_back(odd_docs, odd_rows, library):
    clashing = odd_docs.withColumn("ids", F.lit("x")).withColumn("decoded", F.lit(1)).withColumn("a.b", F.lit(2))
    encoded = bpe_encode(clashing, PATH, public_tokenizers.PATTERN)
    assert encoded.columns == [*odd_docs.columns, "decoded", "a.b", "ids"]
    rows = bpe_decode(encoded, PATH).select("doc_id", "text", "ids", "decoded").collect()
    got = [(r[0], r[1], r[2], bytes(r[3])) for r in rows]
    want = [(r[0], r[1], library.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in odd_rows]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_missing_bytes_are_refused():
    with pytest.raises(ValueError, match="single bytes"):
        Merges([b"a", b"b"])


def test_no_documents(no_docs):
    assert bpe_encode(no_docs, PATH, public_tokenizers.PATTERN).collect() == []
