import html
from html.entities import html5 as entities

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scrivel.functions import text as T
from scrivel.functions.charclass import squeeze, strip

WIDE = "".join(chr(0xFF10 + n) for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 0))

PHONES = {
    "+1 555-010-9999": "[PHONE]",
    "on 2024-01-15 we": "on [PHONE] we",
    "id 48630823": "id 48630823",
    "id 486308230": "id [PHONE]",
    "v 1.2.3.4.5.6": "v [PHONE]",
    "12+3456789012": "12+[PHONE]",
    WIDE: "[PHONE]",
}

ENTITIES = {
    "A B C D E F G": "[ENTITY] [ENTITY] ",
    "FrontierCyber: X to Y": "FrontierCyber: [ENTITY] to [ENTITY] ",
    "üBer Ätna Bar foo": "üBer Ätna [ENTITY] foo",
    "iPhone Case": "iPhone [ENTITY] ",
    "Docker)": "Docker)",
    "[EMAIL] and [URL] A": "[EMAIL] and [URL] [ENTITY] ",
    "①Bar 𠀀Bar x²Bar é": "①Bar 𠀀Bar x²Bar é",
}


@pytest.fixture
def clean_all(spark):
    """Whole chain over texts, in order."""

    def run(texts):
        frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
        return [r["text"] for r in sorted(T.with_clean_texts(frame, "text").collect(), key=lambda r: r["i"])]

    return run


def test_phones(evaluate_all):
    assert evaluate_all(T.mask_phone, PHONES) == list(PHONES.values())


def test_entities(evaluate_all):
    assert evaluate_all(T.mask_entity, ENTITIES) == list(ENTITIES.values())


def test_emails_and_links(evaluate):
    assert evaluate(T.mask_email, "to a.b+c@x-y.co.uk, ü@é.org; a@b") == (
        "to [EMAIL], [EMAIL]; a@b"
    )
    assert evaluate(T.mask_url, "<https://a.b/c?d>'http://e' https:/f") == (
        "<[URL]>'[URL]' https:/f"
    )


def test_entity_references(evaluate_all):
    texts = ["&amp;lt; &copy;", "AT&T &notit; &#x41;&#0;", "&ltB &nbsp;&", "plain", None, "&&amp;#39;"]
    want = [t if t is None else html.unescape(t) for t in texts]
    assert evaluate_all(T.decode_entities, texts) == want


def test_empty_texts_are_null(clean_all):
    assert clean_all([None, "", "   ", "\t　\x1c", "<br>"]) == [None] * 5


def test_space_follows_unicode_rules(evaluate):
    assert evaluate(strip, "　\x1f a  b\x85") == "a  b"
    assert evaluate(squeeze, "　a\x1c\r\n b ") == "a b"


# Worked out by hand, reference by reference and mask by mask.
CHAINS = {
    "Ask Tom &amp; <b>Ann</b> at tom@mail.example.": "[ENTITY] & [ENTITY] at [EMAIL].",
    "call 0049 (30) 1234-567 or see http://a.example/x?y=1 now": "call [PHONE] or see [URL] now",
    "&lt;i&gt;plain&lt;/i&gt;": "plain",
    "year 2024, page 12345678": "year 2024, page 12345678",
    "Été Bar baz": "Été [ENTITY] baz",
    "a\tb\u3000 c": "a b c",
    "mail me: x.y+z@a-b.co": "mail me: [EMAIL]",
    "&#72;ello &#x41;lice!": "[ENTITY] Alice!",
}

PIECES = st.sampled_from(
    ["a", "Bar", "É", "𠀀", "𝐀", "①", "²", "_", "-", ".", "+", "@", "x@y.com", ".b@c.de", " ", "\t", "\n", "\x1c", "\xa0",
     "1", "12", "5550109999", WIDE, "(", ")", "<", ">", "<b>", "&", "&amp;", "&lt", "&#39;", "&copy", "&notit;", "&#x1F642;",
     "&#128;", "&#xD800;", "&#0;", "&#99999999;", "&Aacutex", "AT&T", "https://x.y/z", '"', "'", "中文", ";"]
)
TEXTS = st.lists(st.lists(PIECES, min_size=1, max_size=14).map("".join), min_size=200, max_size=300)


def test_whole_chain(clean_all):
    assert clean_all(CHAINS) == list(CHAINS.values())


def test_all_names_of_references(evaluate_all):
    """Each with a semicolon, without one, and followed by letters."""
    names = [n.rstrip(";") for n in entities]
    texts = [f"x&{n}{end}" for n in names for end in (";", "", "q;", " ")] + ["&zz;", "&Q", "&é;", "&1;", "&[;"]
    assert evaluate_all(T.decode_entities, texts) == [html.unescape(t) for t in texts]


def test_each_step_stands_once_in_the_plan(spark):
    frame = spark.createDataFrame([("a", "b")], "title string, text string")
    plan = T.with_clean_texts(frame, "title", "text")._jdf.queryExecution().optimizedPlan().toString()
    for pattern in (T.TAG, T.PHONE, T._PIECES):
        assert plan.count(pattern) == 2  # one for each column
    assert "Python" not in plan


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(TEXTS)
def test_references_as_the_standard_library_reads_them(evaluate_all, texts):
    assert evaluate_all(T.decode_entities, texts) == [html.unescape(t) for t in texts]


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(TEXTS)
def test_what_cleaned_texts_have_in_common(clean_all, texts):
    cleaned = clean_all(texts)
    for text in filter(None, cleaned):
        assert text == " ".join(text.split())
        assert "<b>" not in text


@pytest.mark.parametrize("step", [T.strip_tags, T.mask_email, T.mask_phone, T.mask_entity, T.decode_entities])
def test_masks_stay_in_the_jvm(spark, step):
    plan = spark.range(9).select(step(F.col("id").cast("string")))
    assert "Python" not in plan._jdf.queryExecution().optimizedPlan().toString()
