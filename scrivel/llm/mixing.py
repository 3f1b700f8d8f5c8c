"""Mixing sources to target weights, with DataFrame functions only.

Texts are cut into blocks of words. A source gives as many words as its target: whole passes over all its blocks, and for the
rest a draw in the order of a permutation, which is a hash of the block and the pass. How many blocks of each
source go to which output shard comes from a tree: the counts of all sources are split in two again and again
by multivariate hypergeometric draws, so every shard is a fair sample of the mix and the counts add up exactly.
A shard then takes the next run of each source's permuted blocks and orders its own blocks by another hash.

Sums and ranks along a permutation are taken inside buckets of the hash and carried over by one row per
bucket, so a source that holds a third of all rows is spread like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrivel.llm.copies import one_of_each, written_out
from scrivel.llm.landing import landed

WORD = r"[^\x20\x09-\x0D]+"
#: Leading hexadecimal digits of a block's hash that name its bucket.
BUCKET_DIGITS = 3


def source_targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Rows ``source, source_size, blocks`` with ``target``: words by weight, in order of sources, nulls last, at most
    ``most`` times the source's size; what is cut off goes to the others by weight.

    One row per source is sorted in one task.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    given = F.array(*(F.lit(w) for w in weights))
    weighed = sources.withColumn(
        "weight", F.get(given, (F.row_number().over(everything) - 1) % len(weights)).cast("long")
    ).withColumn("cap", F.col("source_size") * most)
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    total = F.sum("source_size").over(Window.partitionBy(F.lit(0)))
    full = F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))
    # Words per unit of weight if all sources before are full; it is largest where that is true.
    levels = weighed.withColumn("level", (total - full) / rest)
    level = F.max("level").over(Window.partitionBy(F.lit(0)))
    return levels.withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * level)).select(
        "source", "source_size", "blocks", "target"
    )


def _uniform(*parts: Column) -> Column:
    """A number from 0 to 1 that only depends on ``parts``."""
    digits = F.substring(F.md5(F.concat_ws(":", *(p.cast("string") for p in parts)).cast("binary")), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 48)


def _hypergeometric(u: Column, all_: Column, marked: Column, drawn: Column) -> Column:
    """How many of ``marked`` are among ``drawn`` of ``all_``: the value at ``u`` of the distribution.

    Weights follow from their ratios; beyond ten standard deviations they count as nothing.
    """
    n, k, m = (c.cast("double") for c in (all_, marked, drawn))
    mean = m * k / n
    span = F.ceil(10 * F.sqrt(mean * (1 - k / n) * (n - m) / F.greatest(n - 1, F.lit(1.0)))) + 10
    low = F.greatest(F.lit(0).cast("long"), drawn - (all_ - marked), F.floor(mean) - span)
    high = F.least(marked, drawn, F.floor(mean) + span)

    def ratio(x: Column) -> Column:
        return (k - x) * (m - x) / ((x + 1) * F.greatest(n - k - m + x + 1, F.lit(1.0)))

    def add(s: Column, x: Column) -> Column:
        return F.struct((s["w"] * ratio(x)).alias("w"), (s["sum"] + s["w"]).alias("sum"))

    start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
    total = F.aggregate(F.sequence(low, high), start, add, lambda s: s["sum"])

    def find(s: Column, x: Column) -> Column:
        reached = s["x"].isNull() & (s["sum"] + s["w"] >= u * s["total"])
        return F.struct(
            (s["w"] * ratio(x)).alias("w"), (s["sum"] + s["w"]).alias("sum"), s["total"].alias("total"),
            F.when(reached, x).otherwise(s["x"]).alias("x"),
        )

    begin = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), total.alias("total"), F.lit(None).cast("long").alias("x"))
    found = F.aggregate(F.sequence(low, high), begin, find, lambda s: F.coalesce(s["x"], high))
    return F.when((all_ > 0) & (drawn > 0) & (marked > 0), found).otherwise(F.lit(0).cast("long"))


def shard_quotas(counts: DataFrame, shards: int, seed: str) -> DataFrame:
    """Rows ``source, ends``: for each shard the rank in the source's permuted blocks at which its run ends.

    ``counts`` has a row ``source, taken`` for each source. The table of all sources' counts is one row and is
    split level by level; it has as many numbers as there are sources.
    """
    if shards < 1 or shards & (shards - 1):
        raise ValueError("the number of shards is a power of two")
    listed = F.sort_array(F.collect_list(F.struct(F.isnull("source").alias("none"), "source", "taken")))
    nodes = counts.agg(listed.alias("sources")).select(
        F.lit(0).alias("low"), F.lit(shards).alias("high"), "sources",
        F.transform("sources", lambda s: s["taken"]).alias("counts"),
    )
    size = shards
    while size > 1:
        total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, k: a + k)
        start = F.struct(
            total.alias("all"), F.floor(total / 2).alias("drawn"), F.array().cast("array<bigint>").alias("left")
        )

        def draw(s: Column, k: Column) -> Column:
            u = _uniform(F.lit(seed), F.lit("split"), F.col("low"), F.col("high"), F.size(s["left"]))
            got = F.array_append(s["left"], _hypergeometric(u, s["all"], k, s["drawn"]))
            return F.struct(
                (s["all"] - k).alias("all"),
                (s["drawn"] - F.element_at(got, -1)).alias("drawn"),
                got.alias("left"),
            )

        halved = nodes.withColumn("left", F.aggregate("counts", start, draw, lambda s: s["left"]))
        mid = (F.col("low") + F.lit(size // 2)).alias("mid")
        right = F.zip_with("counts", "left", lambda a, b: a - b)
        both = F.array(
            F.struct(F.col("low"), mid.alias("high"), F.col("left").alias("counts")),
            F.struct(mid.alias("low"), F.col("high"), right.alias("counts")),
        )
        nodes = halved.select("sources", F.explode(both).alias("n")).select("sources", "n.*")
        size //= 2
    each = nodes.select("low", F.posexplode("counts").alias("i", "n"), "sources")
    until = F.sum("n").over(Window.partitionBy("i").orderBy("low"))
    ends = each.withColumn("end", until).withColumn("source", F.get("sources", F.col("i"))["source"])
    grouped = ends.groupBy("i").agg(
        F.first("source").alias("source"), F.sort_array(F.collect_list(F.struct("low", "end"))).alias("ends")
    )
    return grouped.select("source", F.transform("ends", lambda e: e["end"]).alias("ends"))


def document_rows(docs: DataFrame, id: str, text: str, source: str, mark: Column | None = None) -> DataFrame:
    """Rows ``id, mark, nth, source, size``: every row by its id, ``mark`` (by default a hash of its text) and its number among alike
    ones, which are counted before they are numbered."""
    words = F.regexp_count(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(WORD)).cast("long")
    mark = F.xxhash64(F.col(f"`{text}`")) if mark is None else mark
    rows = docs.select(F.col(f"`{id}`").alias("id"), mark.alias("mark"), F.col(f"`{source}`").alias("source"), words.alias("size"))
    alike = rows.groupBy("id", "mark", "source", "size").agg(F.count("*").alias("copies"))
    others = Window.partitionBy("id", "mark").orderBy("source", "size").rowsBetween(Window.unboundedPreceding, -1)
    numbered = alike.withColumn("before", F.coalesce(F.sum("copies").over(others), F.lit(0)))
    return written_out(numbered, ["id", "mark", "source"], "before", "copies").select("id", "mark", "nth", "source", "size")


def mix_sources(
    rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, shards: int = 16,
    block_words: int | None = 256, seed: str = "mix",
) -> tuple[DataFrame, DataFrame]:
    """The sources with their targets, and the blocks that the mix takes out of ``document_rows``: ``id, mark, nth, pass,
    block, words, shard, turn``; a shard is read in the order of ``turn``.

    Blocks have ``block_words`` words, a document's last one fewer, and the last block drawn from a source is cut, so its words
    are its target rounded. Without ``block_words`` a block is a whole document and is drawn if at least half of it fits.
    No document is taken more than ``most`` times, in parts or whole. Null sources are one source, the last.
    Documents without words are never taken; sources without words have a target of 0. Rows that are alike are told
    apart by ``nth``. Runs agree: nothing depends on the order of rows. No rows give no blocks.
    """
    length = F.lit(block_words).cast("long") if block_words else F.greatest("size", F.lit(1))
    sized = rows.withColumn("blocks", F.ceil(F.col("size") / length))
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum("blocks").alias("blocks"))
    targets = landed(source_targets(sums, weights, most), "targets")
    total = F.floor(F.col("target") + 0.5)
    passes = targets.filter("source_size > 0").select(
        "source",
        F.floor(total / F.col("source_size")).alias("passes"),
        (total % F.col("source_size")).cast("long").alias("rest"),
    )
    s, p = sized.alias("s"), passes.alias("p")
    joined = s.join(p, F.col("s.source").eqNullSafe(F.col("p.source"))).select("s.*", "p.passes", "p.rest").filter("size > 0")
    last = F.col("passes") + (F.col("rest") > 0).cast("long")
    one = F.lit(1).cast("long")
    each = joined.filter(last > 0).withColumn("pass", F.explode(F.sequence(one, last))).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    )
    key = F.md5(F.concat_ws(":", F.lit(seed), "pass", "id", "nth", "block").cast("binary"))
    words = F.least(length, F.col("size") - F.col("block") * length)
    blocks = each.select(
        "id", "mark", "nth", "source", "pass", "block", words.alias("words"), key.alias("key"),
        F.substring(key, 1, BUCKET_DIGITS).alias("bucket"),
        F.when(F.col("pass") > F.col("passes"), F.col("rest")).alias("rest"),
    )
    inside = Window.partitionBy("source", "bucket").orderBy("key", "id", "mark", "nth", "block")
    drawn = _carried(blocks.filter("rest IS NOT NULL"), inside, "words", "before")
    left = F.col("rest") - F.col("before")
    part = F.least(F.col("words"), left) if block_words else F.when(2 * left >= F.col("words"), F.col("words"))
    some = drawn.withColumn("words", part).filter("words > 0").drop("before")
    taken = landed(blocks.filter("rest IS NULL").unionByName(some).drop("rest"), "blocks")
    ranked = _carried(taken.withColumn("one", F.lit(1).cast("long")), inside, "one", "rank")
    quotas = shard_quotas(taken.groupBy("source").agg(F.count("*").alias("taken")), shards, seed)
    r, q = ranked.alias("r"), quotas.alias("q")
    dealt = r.join(q, F.col("r.source").eqNullSafe(F.col("q.source"))).select("r.*", "q.ends")
    shard = F.size(F.filter("ends", lambda e: e <= F.col("rank")))
    turn = F.md5(F.concat_ws(":", F.lit(seed), F.lit("turn"), "key", "mark", "nth").cast("binary"))
    return targets, dealt.select(
        "id", "mark", "nth", "pass", "block", "words", shard.alias("shard"), turn.alias("turn")
    )


def _carried(blocks: DataFrame, inside, value: str, out: str) -> DataFrame:
    """``out``: the sum of ``value`` over all blocks of the source that come before in the permutation."""
    within = F.coalesce(F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    buckets = blocks.groupBy("source", "bucket").agg(F.sum(value).alias("all"))
    along = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = landed(buckets.select("source", "bucket", F.coalesce(F.sum("all").over(along), F.lit(0)).alias("base")), "buckets")
    b, c = blocks.withColumn(out, within).alias("b"), base.alias("c")
    same = F.col("b.source").eqNullSafe(F.col("c.source")) & (F.col("b.bucket") == F.col("c.bucket"))
    return b.join(c, same).select("b.*", "c.base").withColumn(out, F.col(out) + F.col("base")).drop("base")


def mixed_documents(
    docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", shards: int = 16, **how
) -> DataFrame:
    """The documents of a mix, whole, each as often as it is taken, dealt out and ordered by shard."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    mark = F.xxhash64(*(c.cast("string") for c in names))
    _, taken = mix_sources(landed(document_rows(docs, id, text, source, mark), "rows"), shards=shards, block_words=None, **how)
    # Rows alike in every column are one, which is taken as often as all of them.
    keyed = one_of_each(docs.withColumn("__key", F.struct(F.col(f"`{id}`").alias("id"), mark.alias("mark"))), "__key")
    k, t = keyed.alias("k"), taken.alias("t")
    same = F.col("k.__key.id").eqNullSafe(F.col("t.id")) & (F.col("k.__key.mark") == F.col("t.mark"))
    names = [F.col(f"k.`{c}`") for c in docs.columns]
    dealt = k.join(t, same).select(*names, F.col("t.shard").alias("__shard"), F.col("t.turn").alias("__turn"))
    ordered = dealt.repartition("__shard", F.substring("__turn", 1, 2)).sortWithinPartitions("__shard", "__turn")
    return ordered.select(*(F.col(f"`{c}`") for c in docs.columns))
