"""The registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrivel.llm.bpe import bpe_decode, bpe_encode
from scrivel.llm.embedding_dedup import near_vectors
from scrivel.llm.fill_middle import fill_in_middle, restored
from scrivel.llm.importance import importance_resample
from scrivel.llm.landing import landed, new_path
from scrivel.llm.line_quality import fit_line_field, line_quality
from scrivel.llm.merkle import edited_fingerprints, first_difference, likeness
from scrivel.llm.mixing import document_rows, mix_sources
from scrivel.llm.quotation import reply_ordered
from scrivel.llm.secret_scan import KINDS, find_secrets
from scrivel.llm.simhash import simhash_groups
from scrivel.llm.substring import remove_repeats
from scrivel.llm.token_files import read_token_files, write_token_files
from scrivel.llm.warc import payload_records, read_warc, write_warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    manifest = write_token_files(docs, vocabulary, new_path(spark, "ids"), "doc_id", "text", end_id=1)
    return read_token_files(manifest).select(
        F.col("id").alias("doc_id"),
        "start",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = near_vectors(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 0.9)
    return linked.select(
        F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(_table(spark, sf_dir, "documents"), "doc_id", "text", 3, 3)
    mark = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return groups.select(F.col("id").alias("doc_id"), mark.alias("fingerprint"), "component_id")


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(_table(spark, sf_dir, "documents"), "doc_id", "text", length=20)
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return kept.select(F.col("id").alias("doc_id"), "n_words", "n_removed", digest)


OP2_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
), fine AS (
    SELECT vec_id, e FROM v
    WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM fine a JOIN fine b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9
), reached AS (
    SELECT vec_id, vec_id AS other FROM v
    UNION
    SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a
)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE a = v.vec_id) AS n_links,
       min(other) AS component_id, v.vec_id = min(other) AS kept
FROM v JOIN reached r ON r.vec_id = v.vec_id
GROUP BY v.vec_id
"""


OP4_SQL = r"""
WITH d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), starts AS (
    SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS s FROM d WHERE len(w) >= 20
), later AS (
    SELECT doc_id, s
    FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY array_to_string(w[s:s + 19], ' ') ORDER BY doc_id, s) AS nth
          FROM starts)
    WHERE nth > 1
), covered AS (
    SELECT DISTINCT doc_id, unnest(generate_series(s, s + 19)) AS i FROM later
), gone AS (
    SELECT doc_id, list(i) AS gone FROM covered GROUP BY doc_id
), kept AS (
    SELECT doc_id, w, list_filter(w, lambda x, i: NOT list_contains(coalesce(gone, []), i)) AS k
    FROM d LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - len(k))::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256
FROM kept
"""


#: Documents whose id has this remainder of its checksum lend no label.
HELD_OUT = "coalesce(crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2, false)"


def op5_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    field = fit_line_field(docs, _table(spark, sf_dir, "labels").filter(f"NOT {HELD_OUT}"))
    return line_quality(docs, field).select(
        "doc_id", F.expr(HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op6_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = edited_fingerprints(_table(spark, sf_dir, "documents"), "doc_id", "text")
    own, edited, other = (F.col(c) for c in ("fingerprint", "edited_fingerprint", "next_fingerprint"))
    return marked.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(own, edited).alias("near_edited"),
        likeness(own, other).alias("near_next"),
        F.coalesce(first_difference(own, edited, "[;,]"), F.lit(0)).alias("edited_paragraph"),
        F.col("next_id").alias("next_doc_id"),
    )


OP6_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars FROM documents
), e AS (
    SELECT doc_id, text, n_chars, substr(text, 1, n_chars - n_chars // 2) || substr(following, 1, n_chars // 2) AS edited
    FROM (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id),
                             first(text) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS following
          FROM d)
), texts AS (
    SELECT DISTINCT text FROM (SELECT text FROM e UNION ALL SELECT edited FROM e)
), trees AS (
    SELECT text, list_transform(regexp_extract_all(text, '(?s).+?(?:\n\n+|\z)'), lambda s:
        list_transform(regexp_extract_all(s, '[^\n]+\n*|\n+'), lambda p:
            list_transform(regexp_extract_all(p, '[^.!?|\n]{1,160}[.!?|\n]*|[.!?|\n]+'), lambda x: md5(x)))) AS tree
    FROM texts
), bodies AS (
    SELECT text,
           sha256(coalesce(array_to_string(list_transform(tree, lambda s: md5(array_to_string(
               list_transform(s, lambda p: md5(array_to_string(p, ''))), ''))), ''), '')) AS root,
           coalesce(array_to_string(list_transform(tree, lambda s: array_to_string(
               list_transform(s, lambda p: array_to_string(list_transform(p, lambda x: substr(x, 1, 8)), '')), ',')), ';'), '') AS body,
           list_distinct(flatten(flatten(list_transform(tree, lambda s:
               list_transform(s, lambda p: list_transform(p, lambda x: substr(x, 1, 8))))))) AS pieces
    FROM trees
), marked AS (
    SELECT e.doc_id, e.n_chars, e.edited, a.root || ':' || a.body AS fingerprint, a.pieces,
           b.root || ':' || b.body AS edited_fingerprint, b.pieces AS edited_pieces,
           string_split_regex(a.body, '[;,]') AS own_parts, string_split_regex(b.body, '[;,]') AS edited_parts
    FROM e JOIN bodies a ON e.text = a.text JOIN bodies b ON e.edited = b.text
), followed AS (
    SELECT *, coalesce(lead(fingerprint) OVER w, first(fingerprint) OVER w) AS next_fingerprint,
           coalesce(lead(pieces) OVER w, first(pieces) OVER w) AS next_pieces,
           coalesce(lead(doc_id) OVER w, first(doc_id) OVER w) AS next_doc_id
    FROM marked WINDOW w AS (ORDER BY doc_id)
)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, fingerprint, edited_fingerprint,
       CASE WHEN fingerprint = edited_fingerprint THEN 1.0 ELSE
           2.0::DOUBLE * len(list_intersect(pieces, edited_pieces)) / (len(pieces) + len(edited_pieces)) END AS near_edited,
       CASE WHEN fingerprint = next_fingerprint THEN 1.0 ELSE
           2.0::DOUBLE * len(list_intersect(pieces, next_pieces)) / (len(pieces) + len(next_pieces)) END AS near_next,
       CASE WHEN fingerprint = edited_fingerprint THEN 0 ELSE
           list_position(list_transform(generate_series(1, greatest(len(own_parts), len(edited_parts))),
                         lambda i: coalesce(own_parts[i] = edited_parts[i], false)), false)::BIGINT END AS edited_paragraph,
       next_doc_id
FROM followed
"""


LOWER = "abcdefghijklmnopqrstuvwxyz"


def quoting(conversations: DataFrame) -> DataFrame:
    """The turns as messages of a mailing list: all but the first quote the turn of half their number, and under it a line of the
    turn of a quarter; every third conversation quotes in capitals and with wide blanks. The given table has no quotations."""
    c = conversations.select("conv_id", F.col("turn").alias("t"), F.col("text").alias("quoted"))
    once = c.groupBy("conv_id", "t").agg(F.min("quoted").alias("quoted"))
    said = F.when(F.col("conv_id") % 3 == 0, F.translate(F.replace("quoted", F.lit(" "), F.lit("  ")), LOWER, LOWER.upper())).otherwise(F.col("quoted"))
    a, b = (once.select("conv_id", F.col("t").alias(t), said.alias(q)) for t, q in (("t1", "q1"), ("t2", "q2")))
    joined = (
        conversations.withColumn("t1", F.when(F.col("turn") > 0, F.floor(F.col("turn") / 2)))
        .withColumn("t2", F.when(F.col("t1") > 0, F.floor(F.col("turn") / 4)))
        .join(a, ["conv_id", "t1"], "left")
        .join(b, ["conv_id", "t2"], "left")
    )
    deep = F.concat(F.lit("> > "), F.substring_index("q2", "\n", 1), F.lit("\n"))
    near = F.concat(F.lit("> "), F.replace("q1", F.lit("\n"), F.lit("\n> ")), F.lit("\n\n"))
    text = F.concat(F.coalesce(deep, F.lit("")), F.coalesce(near, F.lit("")), F.col("text"))
    return joined.select("conv_id", "turn", "role", text.alias("text"))


def op7_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = reply_ordered(quoting(_table(spark, sf_dir, "conversations")), "conv_id", "turn", "text")
    return ordered.withColumn("parent", F.coalesce("parent", F.lit(-1)))


OP7_SQL = r"""
WITH RECURSIVE once AS (
    SELECT conv_id, turn, CASE WHEN conv_id % 3 = 0 THEN translate(replace(min(text), ' ', '  '), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') ELSE min(text) END AS q
    FROM conversations GROUP BY conv_id, turn
), m AS (
    SELECT c.conv_id, c.turn, c.role,
           coalesce('> > ' || string_split(b.q, chr(10))[1] || chr(10), '')
           || coalesce('> ' || replace(a.q, chr(10), chr(10) || '> ') || chr(10) || chr(10), '') || c.text AS text
    FROM conversations c
    LEFT JOIN once a ON c.conv_id = a.conv_id AND c.turn > 0 AND a.turn = c.turn // 2
    LEFT JOIN once b ON c.conv_id = b.conv_id AND c.turn // 2 > 0 AND b.turn = c.turn // 4
), r AS (
    SELECT conv_id, turn, role, text, regexp_replace(array_to_string(list_filter(string_split_regex(text, '\r?\n'),
               lambda x: NOT regexp_matches(x, '^ ?>')), chr(10)), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS reply
    FROM m
), sayings AS (
    SELECT DISTINCT conv_id, turn, said FROM (
        SELECT conv_id, turn, trim(regexp_replace(lower(unnest(list_concat([reply],
                   string_split_regex(reply, '\n[\x20\x09-\x0D]*\n'), string_split(reply, chr(10))))), '[\x20\x09-\x0D]+', ' ', 'g')) AS said
        FROM r) WHERE said <> ''
), lines AS (
    SELECT conv_id, turn, no, length(regexp_replace(regexp_extract(line, '^ ?(?:> ?)+'), '[^>]', '', 'g')) AS level,
           regexp_replace(line, '^ ?(?:> ?)+', '') AS said
    FROM (SELECT conv_id, turn, unnest(string_split_regex(text, '\r?\n')) AS line,
                 generate_subscripts(string_split_regex(text, '\r?\n'), 1) AS no FROM r WHERE regexp_matches(text, '(?m)^ ?>'))
), runs AS (
    SELECT *, no - row_number() OVER (PARTITION BY conv_id, turn, level ORDER BY no) AS run FROM lines
), quotes AS (
    SELECT conv_id, turn, level, said, length(said) * twice AS weight FROM (
        SELECT conv_id, turn, level, twice, trim(regexp_replace(lower(said), '[\x20\x09-\x0D]+', ' ', 'g')) AS said FROM (
            SELECT conv_id, turn, level, string_agg(said, ' ' ORDER BY no) AS said, 2 AS twice FROM runs WHERE level > 0
            GROUP BY conv_id, turn, level, run
            UNION ALL SELECT conv_id, turn, level, said, 1 FROM runs WHERE level > 0))
    WHERE said <> ''
), links AS (
    SELECT q.conv_id, q.turn, q.level, q.weight, max(s.turn) AS origin
    FROM (SELECT *, row_number() OVER () AS i FROM quotes) q
    JOIN sayings s ON q.conv_id = s.conv_id AND q.said = s.said AND s.turn < q.turn
    GROUP BY q.i, q.conv_id, q.turn, q.level, q.weight
), parents AS (
    SELECT conv_id, turn, max({'a': -level, 'b': weight, 'c': origin}).c AS parent, sum(n)::BIGINT AS links
    FROM (SELECT conv_id, turn, level, origin, sum(weight) AS weight, count(*) AS n FROM links GROUP BY ALL)
    GROUP BY conv_id, turn
), up AS (
    SELECT conv_id, turn, turn AS thread, 0::BIGINT AS depth FROM m
    UNION
    SELECT u.conv_id, u.turn, p.parent, u.depth + 1 FROM up u JOIN parents p ON u.conv_id = p.conv_id AND u.thread = p.turn
), tops AS (
    SELECT conv_id, turn, max({'d': depth, 't': thread}) AS top FROM up GROUP BY conv_id, turn
)
SELECT r.conv_id, r.turn, r.role, r.reply AS text, coalesce(p.parent, -1) AS parent, t.top.t AS thread, t.top.d AS depth, coalesce(p.links, 0) AS links
FROM r JOIN tops t ON r.conv_id = t.conv_id AND r.turn = t.turn
LEFT JOIN parents p ON r.conv_id = p.conv_id AND r.turn = p.turn
"""


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = landed(document_rows(_table(spark, sf_dir, "documents"), "doc_id", "text", "source"), "rows")
    targets, blocks = mix_sources(rows, weights=(1, 2, 3), most=3, shards=16, block_words=256)
    # The columns asked for only need words; the mix is written as it is dealt, so that the query makes all of it.
    dealt = blocks.repartition("shard", F.substring("turn", 1, 2)).sortWithinPartitions("shard", "turn")
    taken = landed(dealt, "mix").groupBy("id", "mark", "nth").agg(F.sum("words").alias("taken"))
    r, t, s = rows.alias("r"), taken.alias("t"), targets.alias("s")
    row = F.col("r.id").eqNullSafe(F.col("t.id")) & (F.col("r.mark") == F.col("t.mark")) & (F.col("r.nth") == F.col("t.nth"))
    return r.join(t, row, "left").join(s, F.col("r.source").eqNullSafe(F.col("s.source"))).select(
        F.col("r.id").alias("doc_id"),
        "r.size",
        "s.source_size",
        "s.target",
        F.coalesce("t.taken", F.lit(0)).alias("taken"),
    )


OP8_SQL = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM d GROUP BY source
), l AS (
    SELECT *, max(level) OVER () AS top FROM (
        SELECT *, (sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER (
                       ORDER BY source_size * 3 / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / sum(weight) OVER (
                       ORDER BY source_size * 3 / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM s)
), t AS (
    SELECT source, source_size, least(source_size * 3.0::DOUBLE, weight * top::DOUBLE) AS target FROM l
), p AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS passes,
           CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT % source_size ELSE 0 END AS rest
    FROM t
), blocks AS (
    SELECT doc_id, d.source, rest, block, least(256, size - 256 * block) AS words,
           md5('mix:' || (passes + 1) || ':' || doc_id || ':1:' || block) AS key
    FROM (SELECT *, unnest(generate_series(0, (size + 255) // 256 - 1)) AS block FROM d) d
    JOIN p ON d.source IS NOT DISTINCT FROM p.source
), drawn AS (
    SELECT doc_id, sum(least(words, greatest(0, rest - before)))::BIGINT AS words FROM (
        SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY key
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM blocks)
    GROUP BY doc_id
)
SELECT d.doc_id, d.size, p.source_size, p.target, (p.passes * d.size + coalesce(drawn.words, 0))::BIGINT AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN drawn ON d.doc_id = drawn.doc_id
"""


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe_encode(docs, ranks, public_tokenizers.PATTERN).select("doc_id", "ids")
    numbers = F.array_join(F.col("ids").cast("array<string>"), ",")
    return bpe_decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(numbers, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secrets")
    base = F.filter("secrets", lambda s: s["kind"].isin(*KINDS[:3]))

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    def line(spans):
        each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(each, ",")

    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in KINDS[:3]),
        F.sha2(line(base), 256).alias("base_sha256"),
        line(F.col("secrets")).alias("spans"),
    )


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    formed = fill_in_middle(_table(spark, sf_dir, "documents"), "doc_id", "text")
    return formed.select(
        F.col("id").alias("doc_id"),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP11_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS digest FROM documents
), h AS (
    SELECT *, ('0x' || substr(digest, 1, 8))::BIGINT AS h1, ('0x' || substr(digest, 9, 8))::BIGINT AS h2,
           ('0x' || substr(digest, 17, 8))::BIGINT AS h3, ('0x' || substr(digest, 25, 8))::BIGINT AS h4 FROM d
), f AS (
    SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
           CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h
), p AS (
    SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM f
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return importance_resample(docs, target, "doc_id", "text", percent=25, seed=7).select(
        F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank"
    )


OP12_SQL = r"""
WITH checks AS (
    SELECT list(list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
                            lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc
    FROM (SELECT unnest(generate_series(0, 255))::BIGINT AS i)
), words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM (SELECT doc_id, text FROM documents UNION ALL SELECT -1 - item_id, text FROM benchmark)
), features AS (
    SELECT doc_id, unnest(list_concat(w, list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]))) AS feature
    FROM words
), counted AS (
    SELECT doc_id, feature, count(*) AS n FROM features GROUP BY ALL
), buckets AS (
    SELECT feature, xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(feature), '..'), lambda h: ('0x' || h)::BIGINT)),
                                    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM (SELECT DISTINCT feature FROM features), checks
), filled AS (
    SELECT doc_id, bucket, sum(n) AS n FROM counted JOIN buckets USING (feature) GROUP BY ALL
), sums AS (
    SELECT bucket, coalesce(sum(n) FILTER (doc_id >= 0), 0) AS s, coalesce(sum(n) FILTER (doc_id < 0), 0) AS t FROM filled GROUP BY bucket
), gains AS (
    SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE))) AS gain
    FROM sums
), weights AS (
    SELECT doc_id, sum(n)::BIGINT AS n_features, floor(sum(n * gain) / sum(n))::BIGINT AS weight FROM filled JOIN gains USING (bucket) GROUP BY doc_id
), scored AS (
    SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM words LEFT JOIN weights USING (doc_id) WHERE doc_id >= 0
), ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () * 25 // 100 AS drawn FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= drawn THEN rank END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = payload_records(_table(spark, sf_dir, "pages"), "page_id", "url", "html", least_bytes=0)
    return read_warc(write_warc(records, new_path(spark, "warc"))).select(
        F.col("id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


OP13_SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages
), f AS (
    SELECT *, min(page_id) OVER (PARTITION BY html) AS response,
           list_transform(generate_series(0, 7), lambda i: ('0x' || substr(digest, 5 * i + 1, 5))::BIGINT) AS groups FROM p
)
SELECT page_id, strlen(html) AS payload_bytes,
       array_to_string(list_transform(generate_series(0, 31), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((groups[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to
FROM f
"""


QUERIES = {
    "op1_token_files": (op1_token_files, None),
    "op2_embeddings": (op2_embeddings, OP2_SQL),
    "op3_simhash": (op3_simhash, None),
    "op4_substring": (op4_substring, OP4_SQL),
    "op5_line_quality": (op5_line_quality, None),
    "op6_merkle": (op6_merkle, OP6_SQL),
    "op7_quotation_linking": (op7_quotation_linking, OP7_SQL),
    "op8_mixing": (op8_mixing, OP8_SQL),
    "op9_byte_bpe": (op9_byte_bpe, None),
    "op10_secret_scan": (op10_secret_scan, None),
    "op11_fill_middle": (op11_fill_middle, OP11_SQL),
    "op12_importance": (op12_importance, OP12_SQL),
    "op13_warc": (op13_warc, OP13_SQL),
}
