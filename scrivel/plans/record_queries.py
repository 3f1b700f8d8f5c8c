"""Queries of the record job: scrubbing, pseudonyms, ingest, rendering."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrivel.functions import text as scrub
from scrivel.functions.charclass import squeeze
from scrivel.functions.pseudonym import domain_hash, pseudonymize, public_tags
from scrivel.operators import records
from scrivel.plans.tables import SALT, dealt, stories, table
from scrivel.session import shared_folder
from scrivel.sinks.records import write_record_files
from scrivel.sources.files import image_manifest, read_json_documents, read_text_files

# Folders that record files are dealt out to: some thousand files in each where there are millions.
FOLDERS = 1024


def _scrubbed(name: str, key: str, column: str, step):
    """A query applying one step to a whole text column."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        texts = dealt(table(spark, sf_dir, name).select(key, column))
        return texts.select(key, step(F.col(column)).alias("cleaned"))

    return query


def pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", pseudonymize(F.col("c_name"), SALT).alias("pseudonym")
    )


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", domain_hash(F.col("url"), SALT).alias("domain")
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    around = F.concat(F.lit("see '"), F.col("url"), F.lit("' or "), F.col("url"), F.lit(" now"))
    return table(spark, sf_dir, "pages").select("page_id", scrub.mask_url(around).alias("cleaned"))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id")
    given = F.array("source", F.concat(F.lit("author_"), key.cast("string")), "lang")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(public_tags(F.when(key % 3 > 0, given)), ",").alias("tags")
    )


def cleaned_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = records.clean_fields(stories(spark, sf_dir), SALT)
    names = ("object_id", "story_id", "updated_at", "author_hash", "title", "story_text", "url_domain_hash", "points", "num_comments")
    fields = (records.flat(name).alias(name) for name in names)
    return clean.select("doc_id", "source", "license_note", *fields, F.array_join(records.flat("tags"), ",").alias("tags"))


def front_matter(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = records.clean_fields(stories(spark, sf_dir), SALT)
    return clean.select("doc_id", records.front_matter(records.flat).alias("front_matter"))


def markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = records.clean_fields(stories(spark, sf_dir), SALT)
    return records.with_markdown(clean, records.flat).select("doc_id", "markdown")


def record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From file to file: stories landed as a JSON file each, read, cleaned, rendered, written as a file each, and these read."""
    raw, clean = shared_folder(spark, "raw"), shared_folder(spark, "clean")
    landed = stories(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("stem"),
        F.to_json(F.struct("source", "source_url", "collected_at", "record")).alias("json"),
    )
    write_record_files(landed, raw, ".json", "json", FOLDERS)
    documents = read_json_documents(spark, raw, folders=FOLDERS)
    write_record_files(records.with_markdown(records.clean_records(documents, SALT)), clean, folders=FOLDERS)
    return read_text_files(spark, clean, ".md", FOLDERS).select("stem", F.col("value").alias("markdown"))


def _cleaned(name: str, key: str, column: str):
    """A query that cleans a whole text column."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        texts = dealt(table(spark, sf_dir, name).select(key, F.col(column).alias("cleaned")))
        return scrub.with_clean_texts(texts, "cleaned")

    return query


def latest_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten latest events, a third of them without one id and a third without both."""
    e = table(spark, sf_dir, "events")
    key = F.col("event_id")
    hits = e.select(
        "ts",
        "event_id",
        F.when(key % 3 == 0, key.cast("string")).otherwise("").alias("objectID"),
        F.when(key % 3 == 1, key).otherwise(0).alias("story_id"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("author"),
    )
    newest = (F.col("ts").desc(), F.col("event_id").desc())
    found = records.ingest_latest(
        hits, *newest, limit=10, source="events", source_url="https://data.example/events"
    )
    return found.select(
        F.col("index").cast("bigint").alias("index"),
        "stem",
        "source",
        F.col("record.author").alias("author"),
    )


def story_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of the ten latest events, which carry keys that no schema knows."""
    texts = table(spark, sf_dir, "events").select(
        "ts",
        "event_id",
        F.concat(
            F.lit('{"objectID": "'), F.col("event_id").cast("string"), F.lit('", "author": "é '),
            "event_type", F.lit('", "_unknown": {"props": '), "props", F.lit(', "none": null}}'),
        ).alias("text"),
    )
    found = records.ingest_latest(
        records.parse_stories(texts, "text"), F.col("ts").desc(), F.col("event_id").desc(), limit=10,
        source="events", source_url="https://data.example/events", collected_at=F.lit("2024-01-03T00:00:00Z"),
    )
    return found.select("stem", records.envelope_json().alias("envelope"))


def scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    endings = F.array(*(F.lit(e) for e in (".PNG", ".jpeg", ".pdf", ".tar.bmp", "", ".heic/x")))
    path = F.concat(
        F.lit("in.png/p"),
        F.col("page_id").cast("string"),
        F.get(endings, (F.col("page_id") % 6).cast("int")),
    )
    return image_manifest(table(spark, sf_dir, "pages").select(path.alias("path")))


# --- the same results in SQL ---

def _replace(pattern: str, by: str) -> Callable[[str], str]:
    return lambda c: f"regexp_replace({c}, '{pattern}', '{by}', 'g')"


def _hash(c: str) -> str:
    return f"'user_' || substr(sha256('demo:' || {c}), 1, 12)"


def _entities(c: str) -> str:
    for name, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        c = f"replace({c}, '&{name};', '{char}')"
    return c


def _entity(c: str) -> str:
    """A marker keeps words apart that only seem to start after a letter beyond ASCII."""
    marked = _replace(r"([\p{L}\p{N}])([A-Z])", r"\1qzqzq\2")(c)
    masked = _replace(r"\b([A-Z][A-Za-z0-9&.-]*(\s+|$)){1,5}", "[ENTITY] ")(marked)
    return f"replace({masked}, 'qzqzq', '')"


_EMAIL = _replace(
    r"[\p{L}\p{N}_][\p{L}\p{N}_.+-]*@[\p{L}\p{N}_.-]+\.[A-Za-z]{2,}\b", "[EMAIL]"
)
_PHONE = _replace(r"\+?[0-9][0-9\s().-]{7,}[0-9]", "[PHONE]")
_URL = _replace(r"https?://[^\s<>\x27\x22]+", "[URL]")
_TAGS = _replace("<[^>]+>", " ")


def _space(c: str) -> str:
    return f"trim({_replace(r'\s+', ' ')(c)})"


def _chain(c: str) -> str:
    for step in (_entities, _TAGS, _EMAIL, _PHONE, _URL, _entity, _space):
        c = step(c)
    return f"nullif({c}, '')"


def _step(name: str, key: str, column: str, step: Callable[[str], str]) -> str:
    return f"SELECT {key}, {step(column)} AS cleaned FROM {name}"


_HOST = r"lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1))"

_STORIES = f"""
SELECT doc_id, source, 'Cleaned sample for coursework; contains public HN metadata with usernames pseudonymized.'
         AS license_note,
       CAST(doc_id AS VARCHAR) AS object_id, doc_id AS story_id,
       CASE WHEN doc_id % 3 > 0 THEN '2024-01-02T00:00:00Z' END AS updated_at,
       CASE WHEN doc_id % 5 > 0 THEN {_hash("(source || '-' || lang)")} END AS author_hash,
       {_chain("(lang || ' Story By ' || source)")} AS title,
       {_chain("text")} AS story_text,
       CASE WHEN doc_id % 7 > 0 THEN {_hash("lower('www.' || source || '.example')")} END
         AS url_domain_hash,
       n_chars AS points,
       CASE WHEN doc_id % 2 = 0 THEN doc_id END AS num_comments,
       CASE WHEN doc_id % 4 > 0 THEN 'story,' || lang ELSE '' END AS tags
FROM documents
"""

_FRONT = """concat_ws(chr(10), '---', 'source: ' || to_json(source),
  'source_url: "https://data.example/stories"', 'collected_at: "2024-01-03T00:00:00Z"',
  'record_id: "' || object_id || '"', 'story_id: ' || story_id,
  'record_created_at: "2024-01-01T00:00:00Z"',
  'anonymized_author: ' || coalesce('"' || author_hash || '"', 'null'),
  'anonymized_url_domain: ' || coalesce('"' || url_domain_hash || '"', 'null'),
  'cleaning_version: "1.1"', 'contains_raw_subject_names: false', '---')"""

_BODY = """concat_ws(chr(10), '```json', '{', '  "source": ' || to_json(source) || ',',
  '  "source_url": "https://data.example/stories",',
  '  "collected_at": "2024-01-03T00:00:00Z",',
  '  "license_note": ' || to_json(license_note) || ',', '  "record": {',
  '    "object_id": "' || object_id || '",', '    "story_id": ' || story_id || ',',
  '    "created_at": "2024-01-01T00:00:00Z",',
  '    "updated_at": ' || coalesce(to_json(updated_at)::VARCHAR, 'null') || ',',
  '    "author_hash": ' || coalesce(to_json(author_hash)::VARCHAR, 'null') || ',',
  '    "title": ' || coalesce(to_json(title)::VARCHAR, 'null') || ',',
  '    "story_text": ' || coalesce(to_json(story_text)::VARCHAR, 'null') || ',',
  '    "url_domain_hash": ' || coalesce(to_json(url_domain_hash)::VARCHAR, 'null') || ',',
  '    "points": ' || points || ',',
  '    "num_comments": ' || coalesce(num_comments::VARCHAR, 'null') || ',',
  CASE WHEN tags = '' THEN '    "tags": []' ELSE concat_ws(chr(10), '    "tags": [',
    '      "story",', '      "' || substr(tags, 7) || '"', '    ]') END,
  '  }', '}', '```', '')"""

QUERIES = {
    "pseudonymize": (
        pseudonyms,
        f"SELECT c_custkey, {_hash('c_name')} AS pseudonym FROM customer",
    ),
    "domain_hash": (
        domains,
        f"SELECT page_id, CASE WHEN {_HOST} <> '' THEN {_hash(_HOST)} END AS domain "
        "FROM pages",
    ),
    "mask_email": (
        _scrubbed("documents", "doc_id", "text", scrub.mask_email),
        _step("documents", "doc_id", "text", _EMAIL),
    ),
    "mask_phone": (
        _scrubbed("documents", "doc_id", "text", scrub.mask_phone),
        _step("documents", "doc_id", "text", _PHONE),
    ),
    "mask_url": (
        links,
        _step("pages", "page_id", "('see ''' || url || ''' or ' || url || ' now')", _URL),
    ),
    "mask_entity": (
        _scrubbed("documents", "doc_id", "text", scrub.mask_entity),
        _step("documents", "doc_id", "text", _entity),
    ),
    "html_decode": (
        _scrubbed("pages", "page_id", "html", scrub.decode_entities),
        _step("pages", "page_id", "html", _entities),
    ),
    "strip_tags": (
        _scrubbed("pages", "page_id", "html", scrub.strip_tags),
        _step("pages", "page_id", "html", _TAGS),
    ),
    "squeeze_space": (
        _scrubbed("pages", "page_id", "html", squeeze),
        _step("pages", "page_id", "html", _space),
    ),
    "clean_text": (
        _cleaned("documents", "doc_id", "text"),
        f"SELECT doc_id, {_chain('text')} AS cleaned FROM documents",
    ),
    "clean_page_text": (
        _cleaned("pages", "page_id", "html"),
        f"SELECT page_id, {_chain('html')} AS cleaned FROM pages",
    ),
    "tag_filter": (
        tags,
        "SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN concat_ws(',', source, lang) ELSE '' END "
        "AS tags FROM documents",
    ),
    "clean_records": (cleaned_records, _STORIES),
    "front_matter": (
        front_matter,
        f"SELECT doc_id, {_FRONT} AS front_matter FROM ({_STORIES})",
    ),
    "record_markdown": (
        markdown,
        f"SELECT doc_id, {_FRONT} || chr(10) || chr(10) || {_BODY} AS markdown FROM ({_STORIES})",
    ),
    "record_files": (
        record_files,
        "SELECT CAST(doc_id AS VARCHAR) AS stem, "
        f"{_FRONT} || chr(10) || chr(10) || {_BODY} AS markdown FROM ({_STORIES})",
    ),
    "raw_ingest": (
        latest_stories,
        """
        SELECT "index",
               printf('%02d_', "index") || CASE event_id % 3 WHEN 2 THEN 'story-' || "index"
                 ELSE CAST(event_id AS VARCHAR) END AS stem,
               'events' AS source, 'user' || user_id AS author
        FROM (SELECT *, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS "index" FROM events)
        WHERE "index" <= 10
        """,
    ),
    "raw_story_files": (
        story_files,
        """
        SELECT printf('%02d_', "index") || event_id AS stem,
               '{' || chr(10) || '  "source": "events",' || chr(10)
               || '  "source_url": "https://data.example/events",' || chr(10)
               || '  "collected_at": "2024-01-03T00:00:00Z",' || chr(10)
               || '  "record": {"objectID": "' || event_id || '", "author": "é ' || event_type
               || '", "_unknown": {"props": ' || props || ', "none": null}}' || chr(10) || '}' AS envelope
        FROM (SELECT *, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS "index" FROM events)
        WHERE "index" <= 10
        """,
    ),
    "image_manifest": (
        scans,
        "SELECT 'in.png/p' || page_id || CASE page_id % 6 WHEN 0 THEN '.PNG' WHEN 1 THEN '.jpeg' "
        "ELSE '.tar.bmp' END AS path FROM pages WHERE page_id % 6 IN (0, 1, 3)",
    ),
}
