"""Repeated elements of HTML pages: one row per card of a page's first matching section."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrivel.functions.charclass import blank_to_null, strip
from scrivel.functions.text import decode_entities
from scrivel.schemas import SECTION

Tag = tuple[str, str | None]


@dataclass(frozen=True)
class CardLayout:
    """Tag and class (None: any) of each part. The defaults are fixed values, those of the roster
    page."""

    section: Tag = ("section", "alumni-directory__section")
    header: Tag = ("div", "alumni-directory__header")
    season: Tag = ("p", "alumni-directory__season")
    cohort: Tag = ("h2", None)
    card: Tag = ("article", "alumni-avatar")
    name: Tag = ("strong", "student-avatar__name")
    note: Tag = ("span", "student-avatar__note")


ROSTER = CardLayout()

_VOID = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr".split()
)
_HIDDEN = frozenset(("script", "style", "template"))


class _SectionEnds(Exception):
    """The section is read."""


class _SectionParser(HTMLParser):
    """Collects texts while reading; an end tag closes the nearest open tag of its name."""

    def __init__(self, layout: CardLayout) -> None:
        super().__init__(convert_charrefs=True)
        self.layout = layout
        self.open: list[tuple[str, list[str]]] = []
        self.section: dict | None = None
        self.section_depth = self.header_depth = 0
        self.header_seen = False
        self.cards: list[tuple[int, dict]] = []
        self.sinks: list[tuple[int, list[str]]] = []

    def _is(self, wanted: Tag, tag: str, classes: list[str]) -> bool:
        return tag == wanted[0] and (wanted[1] is None or wanted[1] in classes)

    def _sink(self) -> list[str]:
        sink: list[str] = []
        self.sinks.append((len(self.open), sink))
        return sink

    def handle_starttag(self, tag: str, attrs: list) -> None:
        classes = (dict(attrs).get("class") or "").split()
        self.open.append((tag, classes))
        here, lay = len(self.open), self.layout
        if self.section is None:
            if self._is(lay.section, tag, classes):
                self.section = {"season": None, "cohort": None, "cards": []}
                self.section_depth = here
        else:
            if not self.header_seen and self._is(lay.header, tag, classes):
                self.header_seen, self.header_depth = True, here
            elif self.header_depth:
                for field in ("season", "cohort"):
                    if self.section[field] is None and self._is(getattr(lay, field), tag, classes):
                        self.section[field] = self._sink()
            for _, card in self.cards:
                for field in ("name", "note"):
                    if card[field] is None and self._is(getattr(lay, field), tag, classes):
                        card[field] = self._sink()
            if self._is(lay.card, tag, classes):
                card = {"name": None, "note": None}
                self.section["cards"].append(card)
                self.cards.append((here, card))
        if tag in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.open), 0, -1):
            if self.open[depth - 1][0] == tag:
                self._close(depth)
                return

    def _close(self, depth: int) -> None:
        del self.open[depth - 1 :]
        self.sinks = [s for s in self.sinks if s[0] < depth]
        self.cards = [c for c in self.cards if c[0] < depth]
        if self.header_depth >= depth:
            self.header_depth = 0
        if self.section is not None and self.section_depth >= depth:
            raise _SectionEnds

    def handle_data(self, data: str) -> None:
        if self.sinks and not any(tag in _HIDDEN for tag, _ in self.open):
            for _, sink in self.sinks:
                sink.append(data)

    def result(self) -> dict | None:
        if self.section is None:
            return None
        text = lambda sink: "".join(sink or ()).strip()
        return {
            "season": text(self.section["season"]),
            "cohort": text(self.section["cohort"]),
            "cards": [
                {"name": text(c["name"]), "note": text(c["note"])} for c in self.section["cards"]
            ],
        }


def _parse(html: str | None, layout: CardLayout) -> dict | None:
    if not html:
        return None
    parser = _SectionParser(layout)
    try:
        parser.feed(html)
        parser.close()
    except _SectionEnds:  # the rest of the page is not read
        pass
    return parser.result()


def _may_match(html: Column, layout: CardLayout) -> Column:
    """Cheap native test that no page with a matching section fails."""
    tag, css = layout.section
    hit = F.rlike(html, F.lit(f"(?i)<{re.escape(tag)}"))
    if css is None:
        return hit
    spelled = F.contains(html, F.lit(css)) | F.rlike(html, F.lit(r"(?i)class\s*=[^>]*&"))
    return hit & spelled


def extract_section(html: Column, layout: CardLayout = ROSTER) -> Column:
    """The page's first matching section as :data:`scrivel.schemas.SECTION`, null if there is none.

    Pages that cannot match stay in the JVM; the others pass through Python in Arrow batches.
    """

    @F.pandas_udf(SECTION)
    def parse(pages: pd.Series) -> pd.DataFrame:
        found = [_parse(page, layout) for page in pages]
        blank = {"season": None, "cohort": None, "cards": None}
        return pd.DataFrame([f or blank for f in found], columns=["season", "cohort", "cards"])

    return parse(F.when(_may_match(html, layout), html))


# A page as hidden elements, comments, tags and text; a sign that begins none of them is text.
_HIDDEN_ELEMENT = r"<(?:script|style)\b[^>]*+>.*?</(?:script|style)\s*+>"
_TAG = r"</?[A-Za-z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
_TOKEN = rf"(?is){_HIDDEN_ELEMENT}|<!--.*?-->|<[!?][^>]*+>|{_TAG}|[^<]++|<"
_CLASS = r"(?is)\sclass\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"']++))"

_OPEN_CARD = "struct<at:int,depth:int,name:array<string>,name_depth:int,note:array<string>,note_depth:int>"
_DONE_CARD = "struct<at:int,name:array<string>,note:array<string>>"
_STATE = {
    "tags": "array<string>", "section": "int", "ended": "boolean", "header": "int", "header_seen": "boolean",
    "season": "array<string>", "season_depth": "int", "cohort": "array<string>", "cohort_depth": "int",
    "open": f"array<{_OPEN_CARD}>", "done": f"array<{_DONE_CARD}>", "n": "int",
}


def _tokens(html: Column, layout: CardLayout) -> Column:
    """Tags with their names and the parts of the layout that they begin, and texts; of a page with a single section only what stands before
    its end."""
    tag = re.escape(layout.section[0])
    until_end = F.regexp_extract(html, rf"(?is)\A.*</{tag}\s*+>", 0)
    single = (F.regexp_count(html, F.lit(rf"(?i)<{tag}\b")) == 1) & F.rlike(until_end, F.lit(rf"(?i)<{tag}\b"))
    region = F.when(single, until_end).otherwise(html)
    read = F.regexp_extract_all(region, F.lit(_TOKEN), F.lit(0))
    is_tag = lambda t: F.rlike(t, F.lit(r"\A</?[A-Za-z]"))

    def named(t: Column) -> Column:
        return F.struct(
            t.alias("text"),
            F.when(is_tag(t) & ~F.rlike(t, F.lit(rf"(?is)\A{_HIDDEN_ELEMENT}\z")), F.lower(F.regexp_extract(t, r"\A</?([A-Za-z][^\s/>]*+)", 1))).alias("tag"),
            F.startswith(t, F.lit("</")).alias("ends"),
        )

    def classed(t: Column) -> Column:
        given = F.concat(*(F.regexp_extract(t["text"], _CLASS, i) for i in (1, 2, 3)))
        wanted = any(css is not None for _, css in vars(layout).values())
        classes = F.when(t["tag"].isNotNull() & ~t["ends"], F.split(strip(decode_entities(given)), r"\s+")) if wanted else F.lit(None).cast("array<string>")
        return F.struct(t["text"].alias("text"), t["tag"].alias("tag"), t["ends"].alias("ends"), classes.alias("classes"))

    def parts(t: Column) -> Column:
        begins = lambda tag, css: (t["tag"] == tag) & ~t["ends"] & (F.lit(True) if css is None else F.array_contains(t["classes"], css))
        marks = (F.coalesce(begins(*getattr(layout, part)), F.lit(False)).alias(part) for part in vars(layout))
        is_text = t["tag"].isNull() & ~F.rlike(t["text"], F.lit(r"(?is)\A<(?:[!?]|script\b|style\b)"))
        return F.struct(
            F.when(is_text, t["text"]).alias("text"), t["tag"].alias("tag"), t["ends"].alias("ends"),
            F.coalesce(t["tag"].isin(*sorted(_VOID)), F.lit(False)).alias("void"), *marks,
        )

    return F.transform(F.transform(F.transform(read, named), classed), parts)


def _folded(tokens: Column) -> Column:
    """The section out of the tokens, with a stack of open tags: an end tag closes the nearest open tag of its name."""
    empty = {name: F.lit(None).cast(kind) for name, kind in _STATE.items()}
    empty |= {name: F.array().cast(_STATE[name]) for name in ("tags", "open", "done")}
    empty |= {name: F.lit(0) for name in ("section", "header", "season_depth", "cohort_depth", "n")}
    empty |= {name: F.lit(False) for name in ("ended", "header_seen")}
    changed = lambda a, **new: F.struct(*((new[name] if name in new else a[name]).alias(name) for name in _STATE))
    fresh = F.array().cast("array<string>")

    def fields(c: Column, **new: Column) -> Column:
        names = ("at", "depth", "name", "name_depth", "note", "note_depth")
        return F.struct(*((new[n] if n in new else c[n]).alias(n) for n in names))

    def text(a: Column, t: Column) -> Column:
        hidden = F.exists(a["tags"], lambda x: x.isin(*sorted(_HIDDEN)))
        more = lambda pieces, depth: F.when(depth > 0, F.array_append(pieces, t["text"])).otherwise(pieces)
        heard = changed(
            a,
            season=more(a["season"], a["season_depth"]),
            cohort=more(a["cohort"], a["cohort_depth"]),
            open=F.transform(a["open"], lambda c: fields(c, name=more(c["name"], c["name_depth"]), note=more(c["note"], c["note_depth"]))),
        )
        return F.when(hidden | (a["section"] == 0), a).otherwise(heard)

    def begun(a: Column, t: Column) -> Column:
        here = F.size(a["tags"]) + 1
        inside = a["section"] > 0
        header = inside & ~a["header_seen"] & t["header"]
        in_header = inside & ~header & (a["header"] > 0)
        opens = lambda field: in_header & t[field] & a[field].isNull()

        def heard(c: Column) -> Column:
            new = {f: c[f].isNull() & t[f] for f in ("name", "note")}
            given = {f: F.when(new[f], fresh).otherwise(c[f]) for f in new}
            depths = {f"{f}_depth": F.when(new[f], here).otherwise(c[f"{f}_depth"]) for f in new}
            return fields(c, **given, **depths)

        none = F.lit(None).cast("array<string>")
        card = F.struct(a["n"].alias("at"), here.alias("depth"), none.alias("name"), F.lit(0).alias("name_depth"), none.alias("note"), F.lit(0).alias("note_depth"))
        cards = F.transform(a["open"], heard)
        return changed(
            a,
            tags=F.array_append(a["tags"], t["tag"]),
            section=F.when(~inside & t["section"], here).otherwise(a["section"]),
            header=F.when(header, here).otherwise(a["header"]),
            header_seen=a["header_seen"] | header,
            open=F.when(inside & t["card"], F.array_append(cards, card)).otherwise(cards),
            n=a["n"] + F.when(inside & t["card"], 1).otherwise(0),
            **{f: F.when(opens(f), fresh).otherwise(a[f]) for f in ("season", "cohort")},
            **{f"{f}_depth": F.when(opens(f), here).otherwise(a[f"{f}_depth"]) for f in ("season", "cohort")},
        )

    def closed(a: Column, depth: Column) -> Column:
        """Everything closed that was opened at ``depth`` or later."""
        still = lambda at: F.when(at >= depth, 0).otherwise(at)
        shut = F.filter(a["open"], lambda c: c["depth"] >= depth)
        done = F.transform(shut, lambda c: F.struct(c["at"].alias("at"), c["name"].alias("name"), c["note"].alias("note")))
        left = F.filter(a["open"], lambda c: c["depth"] < depth)
        return changed(
            a,
            tags=F.slice(a["tags"], F.lit(1), depth - 1),
            ended=(a["section"] > 0) & (a["section"] >= depth),
            header=still(a["header"]),
            season_depth=still(a["season_depth"]),
            cohort_depth=still(a["cohort_depth"]),
            open=F.transform(left, lambda c: fields(c, name_depth=still(c["name_depth"]), note_depth=still(c["note_depth"]))),
            done=F.when(F.size(shut) > 0, F.concat(a["done"], done)).otherwise(a["done"]),
        )

    def end(a: Column, t: Column) -> Column:
        from_end = F.array_position(F.reverse(a["tags"]), t["tag"])
        depth = (F.size(a["tags"]) - from_end + 1).cast("int")
        return F.when(from_end > 0, closed(a, depth)).otherwise(a)

    def step(a: Column, t: Column) -> Column:
        return (
            F.when(a["ended"], a)
            .when(t["text"].isNotNull(), text(a, t))
            .when(t["tag"].isNull(), a)
            .when(t["ends"], end(a, t))
            .when(t["void"], closed(begun(a, t), F.size(a["tags"]) + 1))
            .otherwise(begun(a, t))
        )

    return F.aggregate(tokens, F.struct(*(c.alias(name) for name, c in empty.items())), step)


def flat_sections(pages: DataFrame, layout: CardLayout = ROSTER, html: str = "html") -> DataFrame:
    """As :func:`sections`, by expressions alone.

    For pages of plain tags, which may be left open or closed in any order. The parser differs on comments, tags and
    hidden elements that never end, and on elements other than scripts and styles whose content is not markup.
    """
    rest = [c for c in pages.columns if c != html]
    some = pages.filter(_may_match(F.col(html), layout)).withColumn("__tokens", _tokens(F.col(html), layout)).drop(html)
    told = some.withColumn("__section", _folded(F.col("__tokens"))).drop("__tokens")
    text = lambda pieces: strip(F.array_join(F.transform(F.coalesce(pieces, F.array().cast("array<string>")), decode_entities), ""))
    card = lambda c: F.struct(text(c["name"]).alias("name"), text(c["note"]).alias("note"))
    s = F.col("__section")
    left = F.transform(s["open"], lambda c: F.struct(c["at"].alias("at"), c["name"].alias("name"), c["note"].alias("note")))
    found = told.withColumn("__cards", F.sort_array(F.concat(s["done"], left)))
    # Dropped by exploding a list of one or no section: a filter would be pushed down and fold every page twice.
    kept = F.explode(F.filter(F.array(s), lambda x: x["section"] > 0)).alias("section")
    parts = found.select(*(F.col(f"`{c}`") for c in rest), "__cards", kept)
    return parts.select(
        *(F.col(f"`{c}`") for c in rest),
        text(F.col("section.season")).alias("season"),
        text(F.col("section.cohort")).alias("cohort"),
        F.size("__cards").alias("n_cards"),
        F.transform("__cards", card).alias("cards"),
    )


def sections(
    pages: DataFrame, layout: CardLayout = ROSTER, html: str = "html"
) -> DataFrame:
    """Replace the page by ``season, cohort, n_cards, cards``; pages without section are dropped.

    They are dropped by exploding a list of one or no section: a filter would be pushed below the
    projection and parse every page a second time.
    """
    rest = [c for c in pages.columns if c != html]
    parsed = F.array(extract_section(F.col(html), layout))
    found = pages.filter(_may_match(F.col(html), layout)).select(
        *rest, F.explode(F.filter(parsed, lambda s: s["cards"].isNotNull())).alias("section")
    )
    return found.select(
        *rest,
        "section.season",
        "section.cohort",
        F.size("section.cards").alias("n_cards"),
        "section.cards",
    )


def cards(found: DataFrame) -> DataFrame:
    """One row per card, numbered ``n`` from 1 in page order.

    The outer form keeps Spark from adding a size filter, which would parse pages twice.
    """
    rest = [c for c in found.columns if c != "cards"]
    single = found.select(*rest, F.posexplode_outer("cards").alias("at", "card"))
    return single.filter("card IS NOT NULL").select(
        *rest, (F.col("at") + 1).alias("n"), "card.name", "card.note"
    )


def note_or(default: str) -> Column:
    return F.coalesce(blank_to_null(F.col("note")), F.lit(default))
