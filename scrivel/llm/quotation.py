"""Conversations ordered by replies, from the quotations in them, with DataFrame functions only.

Lines that begin with ``>`` are quoted, once for each such sign. Consecutive quoted lines of one level are a passage.
Passages, and their lines, are normalised and hashed, and so are the unquoted texts of all messages, their paragraphs and
lines. A quotation belongs to the latest earlier message of the conversation that says the same. A message replies to
the message it quotes most, on its outermost level that leads anywhere.

The latest earlier message is found by carrying a maximum along the turns: inside chunks of turns first, then by one row per
chunk, so neither a common line nor a very long conversation makes pairs or has to fit one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrivel.llm.landing import landed

QUOTED = r"^ ?>"
MARKS = r"^ ?(?:> ?)+"
BLANKS = r"[\x20\x09-\x0D]+"
#: Turns that one task looks through for one passage.
CHUNK = 1024


def _normal(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), BLANKS, " "))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\r?\n")


def without_quotes(text: Column) -> Column:
    """The unquoted lines, without blank ones at either end."""
    rest = F.array_join(F.filter(_lines(text), lambda x: ~x.rlike(QUOTED)), "\n")
    return F.regexp_replace(rest, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")


def _hashed(rows: DataFrame) -> DataFrame:
    """``said`` as its hash and length; what is blank says nothing."""
    plain = rows.withColumn("said", _normal(F.col("said"))).filter("said <> ''")
    return plain.withColumn("length", F.length("said")).withColumn("said", F.md5(F.col("said").cast("binary")))


def _sayings(messages: DataFrame) -> DataFrame:
    """Rows ``conv, turn, said`` for the unquoted text of each message, its paragraphs and its lines."""
    reply = F.col("reply")
    units = F.concat(F.array(reply), F.split(reply, r"\n[\x20\x09-\x0D]*\n"), F.split(reply, "\n"))
    rows = messages.select("conv", "turn", F.explode(F.array_distinct(units)).alias("said"))
    return _hashed(rows).select("conv", "turn", "said").distinct()


def quotations(messages: DataFrame) -> DataFrame:
    """Rows ``conv, turn, level, said, weight`` for every quoted passage and line; a passage weighs twice its characters."""
    quoted = messages.filter(F.col("text").rlike(r"(?m)^ ?>"))
    lines = quoted.select("conv", "turn", "copy", F.posexplode(_lines(F.col("text"))).alias("no", "line"))
    marks = F.regexp_extract("line", MARKS, 0)
    leveled = lines.select(
        "conv", "turn", "copy", "no",
        F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
        F.regexp_replace("line", MARKS, "").alias("said"),
    )
    order = Window.partitionBy("conv", "turn", "copy").orderBy("no")
    opens = F.coalesce((F.col("level") != F.lag("level").over(order)).cast("int"), F.lit(1))
    runs = leveled.withColumn("opens", opens).withColumn("run", F.sum("opens").over(order)).filter("level > 0")
    passages = runs.groupBy("conv", "turn", "copy", "run", "level").agg(
        F.sort_array(F.collect_list(F.struct("no", "said"))).alias("all")
    )
    whole = passages.select("conv", "turn", "level", F.array_join(F.transform("all", lambda x: x["said"]), " ").alias("said"))
    return _hashed(whole.withColumn("twice", F.lit(2)).unionByName(
        runs.select("conv", "turn", "level", "said", F.lit(1).alias("twice"))
    )).select("conv", "turn", "level", "said", (F.col("length") * F.col("twice")).cast("long").alias("weight"))


def quotation_links(sayings: DataFrame, quotes: DataFrame) -> DataFrame:
    """``quotes`` with ``origin``, the latest turn before that says the same; those without one are left out."""
    key = ["conv", "said"]
    none = F.lit(None).cast("long")
    both = sayings.select(
        *key, "turn", none.cast("int").alias("level"), none.alias("weight"), F.col("turn").alias("origin")
    ).unionByName(quotes.select(*key, "turn", "level", "weight", none.alias("origin")))
    chunked = landed(both.withColumn("chunk", F.floor(F.col("turn") / F.lit(CHUNK))), "sayings")
    # Of one turn, what it says comes after what it quotes: a message is not its own origin.
    here = Window.partitionBy(*key, "chunk").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    along = Window.partitionBy(*key).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunked.groupBy(*key, "chunk").agg(
        F.max("origin").alias("last"), F.count("level").alias("asked")
    )
    carried = landed(
        chunks.withColumn("before", F.max("last").over(along)).filter("asked > 0").select(*key, "chunk", "before"),
        "chunks",
    )
    found = chunked.withColumn("near", F.max("origin").over(here)).filter("level IS NOT NULL")
    origin = F.coalesce("near", "before")
    return found.join(carried, [*key, "chunk"]).select(
        "conv", "turn", "level", "said", "weight", origin.alias("origin")
    ).filter("origin IS NOT NULL")


def _parents(links: DataFrame) -> DataFrame:
    """Rows ``conv, turn, parent, links``."""
    votes = links.groupBy("conv", "turn", "level", "origin").agg(F.sum("weight").alias("weight"), F.count("*").alias("n"))
    best = F.max(F.struct(-F.col("level"), F.col("weight"), F.col("origin")))
    return votes.groupBy("conv", "turn").agg(best["origin"].alias("parent"), F.sum("n").alias("links"))


def _threads(parents: DataFrame) -> DataFrame:
    """Rows ``conv, turn, thread, depth``: the first message that replies lead to, and how many; by doubling steps."""
    reached = landed(parents.select("conv", "turn", F.col("parent").alias("thread"), F.lit(1).cast("long").alias("depth")), "threads")
    while True:
        a, b = reached.alias("a"), reached.alias("b")
        on = (F.col("a.conv") == F.col("b.conv")) & (F.col("a.thread") == F.col("b.turn"))
        further = landed(
            a.join(b, on, "left").select(
                "a.conv", "a.turn", F.coalesce("b.thread", "a.thread").alias("thread"),
                (F.col("a.depth") + F.coalesce("b.depth", F.lit(0))).alias("depth"),
                F.col("b.thread").isNotNull().alias("moved"),
            ),
            "threads",
        )
        reached = further.drop("moved")
        if not further.filter("moved").head(1):
            return reached


def reply_ordered(
    messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text"
) -> DataFrame:
    """All rows and columns; ``text`` is without quotations, and there are ``parent`` (turn replied to, or null), ``thread``
    (turn that the replies go back to), ``depth`` (replies up to there) and ``links`` (quoted passages and lines found).

    Rows are sorted by conversation, thread and turn, so every message comes after what it replies to.
    ``turn`` is a whole number. Null texts are empty. Quotations of nothing said before in the conversation are
    dropped without a link. Several rows of one turn are one message with all their quotations. Rows with a null conversation
    or turn are threads of their own. Columns called like those added are replaced. An empty table gives no rows.
    """
    added = ("parent", "thread", "depth", "links")
    rows = messages.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(text).alias("text"),
        F.xxhash64(text).alias("copy"), without_quotes(F.col(text)).alias("reply"),
    ).filter("conv IS NOT NULL AND turn IS NOT NULL")
    links = quotation_links(_sayings(rows), quotations(rows.distinct()))
    parents = landed(_parents(links), "parents")
    found = parents.join(_threads(parents), ["conv", "turn"])
    names = [c for c in messages.columns if c not in added]
    own = F.col("m.__turn")
    m = messages.withColumn("__turn", F.col(turn).cast("long")).alias("m")
    f = found.alias("f")
    same = (F.col(f"m.`{conv}`") == F.col("f.conv")) & (own == F.col("f.turn"))
    columns = [without_quotes(F.col(f"m.`{c}`")).alias(c) if c == text else F.col(f"m.`{c}`") for c in names]
    joined = m.join(f, same, "left").select(
        *columns,
        "f.parent",
        F.coalesce("f.thread", own).alias("thread"),
        F.coalesce("f.depth", F.lit(0)).alias("depth"),
        F.coalesce("f.links", F.lit(0)).alias("links"),
    )
    # Sorted as a whole: a range of a long conversation is a partition like any other.
    return joined.orderBy(conv, "thread", turn)
