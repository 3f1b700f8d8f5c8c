"""Fill-in-the-middle forms of texts, put together by Arrow's compute functions over whole batches.

The code points of a batch become units of one flat array over the bytes they stand in; each unit knows its text and
its ordinal there. Units are filtered by the role that their ordinal gives them, the lists are built again around what stays,
and joined to pieces. Where to cut and which form to take are expressions over a hash of the id, so a
run can be repeated and no task has a random state.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrivel.llm.pieces import sliced

#: Bytes of text whose units are held at once; longer texts are cut.
SLICE_BYTES = 2_000_000
# The marks in front of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"


def _counted(values: pa.Array, n: int) -> pa.Array:
    """How often each number below ``n`` stands in ``values``, which ascend, as the offsets of lists."""
    found = pc.value_counts(values)
    held = pc.index_in(pa.array(np.arange(n)), found.field(0))
    sizes = pc.fill_null(pc.take(found.field(1), held), 0)
    return pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(sizes).cast(pa.int32())])


def units(texts: pa.Array) -> pa.ListArray:
    """The code points of each text, as a list over the bytes of the texts themselves."""
    texts = texts.cast(pa.string())
    _, places, data = texts.buffers()
    if not len(texts) or data is None:
        return pa.array([[]] * len(texts), pa.list_(pa.string()))
    ends = pa.Array.from_buffers(pa.int32(), len(texts) + 1, [None, places], offset=texts.offset)
    low, high = ends[0].as_py(), ends[-1].as_py()
    held = pa.Array.from_buffers(pa.uint8(), high - low, [None, data], offset=low)
    begins = pc.indices_nonzero(pc.not_equal(pc.bit_wise_and(held, pa.scalar(0xC0, pa.uint8())), pa.scalar(0x80, pa.uint8())))
    cuts = pa.concat_arrays([pc.add(begins.cast(pa.int32()), pa.scalar(low, pa.int32())), pa.array([high], pa.int32())])
    points = pa.StringArray.from_buffers(len(begins), cuts.buffers()[1], data)
    lengths = pc.utf8_length(texts)
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(lengths).cast(pa.int32())])
    return pa.ListArray.from_arrays(offsets, points)


def _pieces(texts: pa.Array, base: pa.Array, first: pa.Array, second: pa.Array) -> list[pa.Array]:
    """Prefix, middle and suffix of texts, or of parts of texts that begin at unit ``base``."""
    lists = units(texts)
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    of_parent = lambda values: pc.take(values, parent)
    every = pa.array(np.arange(len(flat)))
    ordinal = pc.add(pc.subtract(every, of_parent(lists.offsets.cast(pa.int64()))), of_parent(base))
    in_prefix, in_suffix = pc.less(ordinal, of_parent(first)), pc.greater_equal(ordinal, of_parent(second))
    roles = in_prefix, pc.invert(pc.or_(in_prefix, in_suffix)), in_suffix
    pieces = []
    for role in roles:
        kept = pa.ListArray.from_arrays(_counted(pc.filter(parent, role), len(texts)), pc.filter(flat, role))
        pieces.append(pc.binary_join(kept, ""))
    return pieces


def _long_pieces(text: str, first: int, second: int) -> list[str]:
    """The pieces of one long text, part by part."""
    joined: list[list[str]] = [[], [], []]
    for low in range(0, len(text), SLICE_BYTES // 4):
        part = pa.array([text[low : low + SLICE_BYTES // 4]])
        numbers = (pa.array([n], pa.int64()) for n in (low, first, second))
        for role, piece in zip(joined, _pieces(part, *numbers), strict=True):
            role.append(piece[0].as_py())
    return ["".join(role) for role in joined]


def rearranged(texts: pa.Array, forms: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
    """Each text in its form, cut before the units ``first`` and ``second``; plain texts as they are."""
    done = []
    for begin, end in sliced(pc.binary_length(texts).to_pylist(), SLICE_BYTES):
        part, form, low, high = (c.slice(begin, end - begin) for c in (texts, forms, first, second))
        if pc.all(pc.equal(form, PLAIN)).as_py():
            done.append(part)
            continue
        if pc.max(pc.binary_length(part)).as_py() > SLICE_BYTES:  # one text, and empty ones before it
            each = [_long_pieces(*row) for row in zip(part.to_pylist(), low.to_pylist(), high.to_pylist(), strict=True)]
            prefix, middle, suffix = (pa.array(pieces, pa.string()) for pieces in zip(*each, strict=True))
        else:
            prefix, middle, suffix = _pieces(part, pa.array(np.zeros(len(part), np.int64)), low, high)
        psm = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")
        spm = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, "")
        done.append(pc.if_else(pc.equal(form, PLAIN), part, pc.if_else(pc.equal(form, PSM), psm, spm)))
    return pa.concat_arrays(done) if done else texts


def fill_in_middle(
    docs: DataFrame, id: str = "doc_id", text: str = "text", out: str = "output", seed: int = 1, plain: int = 10, spm: int = 20
) -> DataFrame:
    """Rows ``id, text, n, form, prefix_chars, middle_chars`` and ``out``, one for each document.

    A text of ``n`` code points is cut at two places that a hash of ``seed`` and id gives, each of the n + 1
    equally likely. ``plain`` percent of texts stay as they are, and so do empty texts and those that hold a mark, which could not be told
    from the marks put in; they have null lengths. Of the others ``spm`` percent begin with their suffix, the rest with
    their prefix. A null text counts as empty, a null id as an empty text in the hash. Rows are
    independent: repeated rows come out alike, rows of one id are cut by the same hash, an empty table gives
    no rows. Other columns are not read. Whole texts are cut, however long.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id}`").cast("string"), F.lit(""))), 256)
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), digest.alias("__digest"))
    h = [F.conv(F.substring("__digest", 8 * i + 1, 8), 16, 10).cast("long").alias(f"__h{i + 1}") for i in range(4)]
    rows = rows.select("id", "text", F.length("text").cast("long").alias("n"), *h)
    marked = F.rlike("text", F.lit("|".join((PREFIX, SUFFIX, MIDDLE))))
    form = F.when((F.col("n") == 0) | (F.col("__h3") % 100 >= 100 - plain) | marked, PLAIN).when(F.col("__h4") % 100 < spm, SPM).otherwise(PSM)
    cuts = [F.col(f"__h{i}") % (F.col("n") + 1) for i in (1, 2)]
    rows = rows.select("id", "text", "n", form.alias("form"), F.least(*cuts).alias("__first"), F.greatest(*cuts).alias("__second"))
    arranged = F.arrow_udf(rearranged, "string")("text", "form", "__first", "__second")
    cut = F.col("form") != PLAIN
    return rows.select(
        "id",
        "text",
        "n",
        "form",
        F.when(cut, F.col("__first")).alias("prefix_chars"),
        F.when(cut, F.col("__second") - F.col("__first")).alias("middle_chars"),
        arranged.alias(out),
    )


def restored(output: Column, form: Column) -> Column:
    """The text behind an output of its form."""
    pieces = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    piece = lambda i: F.get(pieces, F.lit(i))
    in_order = {PSM: (1, 3, 2), SPM: (2, 3, 1)}
    cut = F.when(form == PSM, F.concat(*map(piece, in_order[PSM]))).when(form == SPM, F.concat(*map(piece, in_order[SPM])))
    return F.when(form == PLAIN, output).otherwise(cut)
