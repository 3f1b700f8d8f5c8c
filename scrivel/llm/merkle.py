"""Document fingerprints as Merkle trees, with DataFrame functions only.

A text is sections, ended by blank lines; sections are paragraphs, one to a line; paragraphs are pieces: sentences, or
160 characters where none ends. Pieces are hashed, and every level hashes what is below it, so the root tests equality of
whole texts. The fingerprint is the root and, in the tree's form, a short digest of every piece: two fingerprints alone
tell how much they share and in which section and paragraph they begin to differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrivel.llm.landing import landed

SECTION = r"(?s).+?(?:\n\n+|\z)"
PARAGRAPH = r"[^\n]+\n*|\n+"
PIECE = r"[^.!?|\n]{1,160}[.!?|\n]*|[.!?|\n]+"
ROOT_DIGITS, PIECE_DIGITS = 64, 8


def with_fingerprint(rows: DataFrame, text: str, out: str) -> DataFrame:
    """All rows and columns with ``out``: root, a colon, digests of pieces with ``,`` between paragraphs and ``;`` between
    sections. A null text counts as empty, which is a root alone. Equal texts have equal fingerprints."""
    every = F.lit(0)
    sections = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(SECTION), every)
    hashes = F.transform(
        sections,
        lambda s: F.transform(
            F.regexp_extract_all(s, F.lit(PARAGRAPH), every),
            lambda p: F.transform(F.regexp_extract_all(p, F.lit(PIECE), every), lambda x: F.md5(x)),
        ),
    )
    inner = F.transform(
        F.col("__tree"), lambda s: F.md5(F.array_join(F.transform(s, lambda p: F.md5(F.array_join(p, ""))), ""))
    )
    short = F.array_join(
        F.transform(
            F.col("__tree"),
            lambda s: F.array_join(
                F.transform(
                    s, lambda p: F.array_join(F.transform(p, lambda x: F.substring(x, 1, PIECE_DIGITS)), "")
                ),
                ",",
            ),
        ),
        ";",
    )
    fingerprint = F.concat(F.sha2(F.array_join(inner, ""), 256), F.lit(":"), short)
    return rows.withColumn("__tree", hashes).withColumn(out, fingerprint).drop("__tree")


def _body(fingerprint: Column) -> Column:
    return F.substr(fingerprint, F.lit(ROOT_DIGITS + 2))


def pieces(fingerprint: Column) -> Column:
    """The different digests of a fingerprint's pieces."""
    return F.array_distinct(F.regexp_extract_all(_body(fingerprint), F.lit(f"[0-9a-f]{{{PIECE_DIGITS}}}"), F.lit(0)))


def likeness(a: Column, b: Column) -> Column:
    """Twice the shared pieces of two fingerprints over the pieces of both: 1 for equal ones, 0 if nothing is shared."""
    x, y = pieces(a), pieces(b)
    shared = 2.0 * F.size(F.array_intersect(x, y)) / (F.size(x) + F.size(y))
    return F.when(a == b, F.lit(1.0)).otherwise(F.coalesce(shared, F.lit(0.0)))


def first_difference(a: Column, b: Column, separator: str) -> Column:
    """Number, from 1, of the first branch in which two fingerprints differ; null for equal ones. The separator ``;`` gives
    sections, ``[;,]`` paragraphs."""
    x, y = F.split(_body(a), separator), F.split(_body(b), separator)
    same = F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False)))
    return F.when(a != b, F.array_position(same, F.lit(False)))


def next_rows(rows: DataFrame, key: list[str]) -> DataFrame:
    """Each different ``key`` in ascending order with the one that follows, in columns ``next_...``; the first follows the last.

    The order is cut into ranges; neighbours are found inside each, and one row per range, its first key, closes the gaps.
    """
    whole = F.struct(*key)
    ranged = landed(
        rows.select(*key).distinct().repartitionByRange(*key).withColumn("part", F.spark_partition_id()), "order"
    )
    inside = ranged.withColumn("next", F.lead(whole).over(Window.partitionBy("part").orderBy(*key)))
    firsts = ranged.groupBy("part").agg(F.min(whole).alias("first"))
    parts = Window.orderBy("part")
    following = firsts.select(
        "part",
        F.coalesce(F.lead("first").over(parts), F.first("first").over(parts)).alias("following"),
    )
    return inside.join(following, "part").select(
        *key, *(F.coalesce("next", "following")[k].alias(f"next_{k}") for k in key)
    )


def edited_fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``id, n_chars, edited, fingerprint, edited_fingerprint, next_id, next_fingerprint``: each text, the text with its last half
    replaced by as many characters from the start of the next document, and the next document.

    Documents follow each other by id, null ids first, those of one id by a hash of their texts; the first follows
    the last, and one alone itself. Null texts count as empty. Repeated rows stand in one place of the order and each
    give a row. An empty table gives no rows. Other columns are not read.
    """
    plain = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(F.col(id).alias("id"), F.xxhash64(plain).alias("mark"), plain.alias("text"))
    half = F.floor(F.length("text") / 2).alias("half")
    sizes = landed(keyed.select("id", "mark", half).distinct(), "sizes")
    order = next_rows(sizes, ["id", "mark"])
    o, s = order.alias("o"), sizes.alias("s")
    same = F.col("o.id").eqNullSafe(F.col("s.id")) & (F.col("o.mark") == F.col("s.mark"))
    # Keys without nulls, under which all that follows is partitioned alike. Both joins read the same columns of the
    # texts, so these are shuffled once.
    wanted = landed(
        o.join(s, same).select(
            F.isnull("o.id").alias("none"), _name("o.id").alias("name"), "o.mark", "s.half",
            F.isnull("o.next_id").alias("next_none"), _name("o.next_id").alias("next_name"), "o.next_mark",
        ),
        "order",
    )
    key = ["none", "name", "mark"]
    named = keyed.select("id", F.isnull("id").alias("none"), _name("id").alias("name"), "mark", "text")
    d, w = named.alias("d"), wanted.alias("w")
    follows = [F.col(f"d.{k}") == F.col(f"w.next_{k}") for k in key]
    met = d.join(w, follows).select(*(f"w.{k}" for k in key), "w.half", F.col("d.id").alias("next_id"), "d.text")
    # Fingerprints are made where the texts arrive, on both sides, which is cheaper than to send them along.
    one = with_fingerprint(met, "text", "next_fingerprint").select(
        *key, F.expr("substring(text, 1, half)").alias("piece"), "next_id", "next_fingerprint"
    )
    # A repeated row is the same text: one of them is enough as what follows.
    own = named.join(one.dropDuplicates(key), key)
    joined = with_fingerprint(own, "text", "fingerprint").select(
        "id",
        F.length("text").cast("long").alias("n_chars"),
        F.expr("concat(substring(text, 1, length(text) - floor(length(text) / 2)), piece)").alias("edited"),
        "fingerprint",
        "next_id",
        "next_fingerprint",
    )
    return with_fingerprint(joined, "edited", "edited_fingerprint")


def _name(id: str) -> Column:
    return F.coalesce(F.col(id).cast("string"), F.lit(""))
