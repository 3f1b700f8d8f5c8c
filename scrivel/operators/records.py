"""Story records: ingest, clean, and render as Markdown with front matter.

Everything but the numbering of an ingest is one projection per record, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrivel.functions.charclass import blank_to_null
from scrivel.functions.jsontext import (
    json_number,
    json_object,
    json_string,
    json_string_list,
)
from scrivel.functions.pseudonym import domain_hash, pseudonymize, public_tags
from scrivel.functions.text import with_clean_texts
from scrivel.schemas import STORY

# Fixed values written into every clean record.
LICENSE_NOTE = (
    "Cleaned sample for coursework; contains public HN metadata with usernames pseudonymized."
)
CLEANING_VERSION = "1.1"


def record_key(object_id: Column, story_id: Column, index: Column) -> Column:
    """First usable id, else ``story-{index}``."""
    return F.coalesce(
        blank_to_null(object_id),
        F.nullif(story_id, F.lit(0)).cast("string"),
        F.concat(F.lit("story-"), index.cast("string")),
    )


def parse_stories(texts: DataFrame, column: str) -> DataFrame:
    """Stories as JSON text to their columns, beside ``story``, the text as it came: it has keys that no schema knows."""
    rest = [c for c in texts.columns if c != column]
    parsed = texts.select(*rest, F.col(column).alias("story"), F.from_json(column, STORY).alias("__story"))
    return parsed.select(*rest, "story", "__story.*")


def envelope_json() -> Column:
    """The envelope of an ingested story as JSON, around the story as it came."""
    story = F.coalesce("story", F.to_json("record"))
    return json_object([(name, json_string(F.col(name))) for name in _ENVELOPE] + [("record", story)])


def ingest_latest(
    stories: DataFrame,
    *order: Column,
    limit: int,
    source: str,
    source_url: str,
    collected_at: Column | None = None,
) -> DataFrame:
    """Envelope the first ``limit`` stories, newest first.

    ``stories`` has the columns of :data:`scrivel.schemas.STORY`; missing ones are null. A column ``story``, the
    whole text of a story, is kept.
    ``order`` must end in a unique key. The result adds ``index`` from 1 and the file
    ``stem``. The limit is the feature: it plans as a top-k per task, and only the
    ``limit`` survivors meet in the one task that numbers them.
    """
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    now = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    top = stories.orderBy(*order).limit(limit)
    top = top.withColumn("index", F.row_number().over(Window.orderBy(*order)))
    fields = [
        (F.col(f.name) if f.name in stories.columns else F.lit(None))
        .cast(f.dataType)
        .alias(f.name)
        for f in STORY
    ]
    key = record_key(F.col("record.objectID"), F.col("record.story_id"), F.col("index"))
    text = (F.col("story") if "story" in stories.columns else F.lit(None).cast("string")).alias("story")
    return top.select("index", text, F.struct(*fields).alias("record")).select(
        "index",
        F.format_string("%02d_%s", "index", key).alias("stem"),
        F.lit(source).alias("source"),
        F.lit(source_url).alias("source_url"),
        (now if collected_at is None else collected_at).alias("collected_at"),
        "record",
        "story",
    )


#: The fields of a clean record, in their order.
RECORD = ("object_id", "story_id", "created_at", "updated_at", "author_hash", "title", "story_text",
          "url_domain_hash", "points", "num_comments", "tags")
_ENVELOPE = ("source", "source_url", "collected_at")

Field = Callable[[str], Column]


def nested(name: str) -> Column:
    """A field of the clean record in the column ``record``."""
    return F.col("record")[name]


def flat(name: str) -> Column:
    """A field of the clean record as :func:`clean_fields` gives it."""
    return F.col(f"record_{name}")


def clean_fields(raw: DataFrame, salt: str) -> DataFrame:
    """As :func:`clean_records`, with the fields of the record as columns ``record_...`` of their own, so that whoever reads some of them
    has only those made. Columns of these names are replaced."""
    r = F.col("record")
    fields = {
        "object_id": r["objectID"],
        "story_id": r["story_id"],
        "created_at": r["created_at"],
        "updated_at": r["updated_at"],
        "author_hash": pseudonymize(r["author"], salt),
        "title": r["title"],
        "story_text": r["story_text"],
        "url_domain_hash": domain_hash(r["url"], salt),
        "points": r["points"],
        "num_comments": r["num_comments"],
        "tags": public_tags(r["_tags"]),
    }
    made = [f"record_{name}" for name in RECORD]
    passed = [c for c in raw.columns if c not in (*_ENVELOPE, "record", *made)]
    table = raw.select(
        *(F.col(f"`{c}`") for c in passed),
        *_ENVELOPE,
        F.lit(LICENSE_NOTE).alias("license_note"),
        *(fields[name].alias(f"record_{name}") for name in RECORD),
    )
    return with_clean_texts(table, "record_title", "record_story_text")


def clean_records(raw: DataFrame, salt: str) -> DataFrame:
    """Raw envelopes to clean records; columns beside the envelope pass through.

    The salt has no default: who knows it can rebuild the pseudonyms. Record ids stay, so
    a record can still be looked up at its source.
    """
    fields = clean_fields(raw, salt)
    made = [f"record_{name}" for name in RECORD]
    record = F.struct(*(flat(name).alias(name) for name in RECORD))
    return fields.select(*(F.col(f"`{c}`") for c in fields.columns if c not in made), record.alias("record"))


def front_matter(field: Field = nested) -> Column:
    """Ten ``key: scalar`` lines over the columns of a clean record.

    ``contains_raw_subject_names`` states that masking was applied; it is not measured.
    """
    pairs = [
        ("source", json_string(F.col("source"))),
        ("source_url", json_string(F.col("source_url"))),
        ("collected_at", json_string(F.col("collected_at"))),
        ("record_id", json_string(field("object_id"))),
        ("story_id", json_number(field("story_id"))),
        ("record_created_at", json_string(field("created_at"))),
        ("anonymized_author", json_string(field("author_hash"))),
        ("anonymized_url_domain", json_string(field("url_domain_hash"))),
        ("cleaning_version", F.lit(f'"{CLEANING_VERSION}"')),
        ("contains_raw_subject_names", F.lit("false")),
    ]
    lines = [F.concat(F.lit(f"{key}: "), value) for key, value in pairs]
    return F.concat_ws("\n", F.lit("---"), *lines, F.lit("---"))


def record_json(field: Field = nested) -> Column:
    """A clean record as indented JSON."""
    numbers = ("story_id", "points", "num_comments")
    rendered = {name: (json_number if name in numbers else json_string)(field(name)) for name in RECORD if name != "tags"}
    rendered["tags"] = json_string_list(field("tags"), indent=4)
    body = json_object([(name, rendered[name]) for name in RECORD], indent=2)
    outer = (*_ENVELOPE, "license_note")
    return json_object([(name, json_string(F.col(name))) for name in outer] + [("record", body)])


def with_markdown(clean: DataFrame, field: Field = nested) -> DataFrame:
    """Add ``markdown``: front matter, blank line, fenced JSON of the record."""
    fence = F.concat(F.lit("\n\n```json\n"), record_json(field), F.lit("\n```\n"))
    return clean.withColumn("markdown", F.concat(front_matter(field), fence))
